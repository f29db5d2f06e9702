import random

import rows as R
from pyspark.sql import functions as F

from paylake import schemas as S
from paylake.operators.latest import dominant_values, latest, latest_columns
from paylake.operators.quality import rejected_ids
from paylake.plans import silver


def by_id(frame, key="transaction_id"):
    return {row[key]: row for row in frame.collect()}


def test_latest_skips_nulls_per_column(spark):
    bronze = R.payments(
        spark,
        {"id": "1", "state": "a", "reference": "r1", S.INGESTED: R.at(1)},
        {"id": "1", "state": "b", S.INGESTED: R.at(2)},
        {"id": "1", "card_type": "2", S.INGESTED: R.at(3)},
        {"id": "1", "state": "never", S.INGESTED: None},
    )
    row = by_id(silver.payments(bronze))[1]
    assert (row.payment_state, row.reference, row.card_type) == ("b", "r1", "2")


def test_unreadable_latest_time_is_null(spark):
    bronze = R.payments(
        spark,
        {"id": "1", "created_at": "2025-10-01", S.INGESTED: R.at(1)},
        {"id": "1", "created_at": "x", S.INGESTED: R.at(2)},
        {"id": "2", "created_at": "2025-10-01", S.INGESTED: R.at(1)},
        {"id": "2", "created_at": None, S.INGESTED: R.at(2)},
    )
    rows = by_id(silver.payments(bronze))
    assert rows[1].created_at is None
    assert rows[2].created_at is not None


def test_ties_follow_update_time_then_creation_time(spark):
    bronze = R.payments(
        spark,
        {"id": "1", "state": "old", "updated_at": "2025-10-01 10:00:00"},
        {"id": "1", "state": "new", "updated_at": "01/10/2025 11:00:00"},
        {"id": "2", "state": "old", "created_at": "2025-10-01 10:00:00"},
        {"id": "2", "state": "new", "created_at": "2025-10-01 11:00:00"},
    )
    rows = by_id(silver.payments(bronze))
    assert (rows[1].payment_state, rows[2].payment_state) == ("new", "new")


def test_result_does_not_depend_on_partitioning(spark):
    generator = random.Random(7)
    data = [
        {
            "id": str(generator.randrange(20)),
            "state": generator.choice(["a", "b", None]),
            "details": generator.choice(["x", "y", None]),
            "merchant_id": str(generator.randrange(4)),
        }
        for _ in range(400)
    ]
    results = []
    for partitions in (1, 3, 7):
        generator.shuffle(data)
        frame = silver.payments(R.payments(spark, *data).repartition(partitions))
        results.append(sorted(map(str, frame.collect())))
    assert results[0] == results[1] == results[2]


def test_latest_against_brute_force(spark):
    generator = random.Random(11)
    columns = ["state", "card_type", "reference", "details"]
    data = [
        {
            "id": str(generator.randrange(40)),
            S.INGESTED: generator.choice([None, *map(R.at, range(30))]),
            "updated_at": generator.choice([None, "2025-10-01", "2025-10-02", "x"]),
            "created_at": f"2025-09-{n % 28 + 1:02d} 00:00:{n % 60:02d}",
            **{name: generator.choice([None, f"{name}{n}"]) for name in columns},
        }
        for n in range(1500)
    ]
    got = by_id(silver.payments(R.payments(spark, *data).repartition(5)))

    def order(row):
        updated = {None: "", "x": ""}.get(row["updated_at"], row["updated_at"])
        return row[S.INGESTED], updated, row["created_at"]

    for key in range(40):
        rows = [row for row in data if row["id"] == str(key) and row[S.INGESTED]]
        for name, column in zip(columns, ["payment_state", *columns[1:]]):
            given = sorted((row for row in rows if row[name]), key=order)
            tied = {row[name] for row in given if order(row) == order(given[-1])} or {None}
            assert got[key][column] in tied


def test_dominant_values_against_brute_force(spark):
    generator = random.Random(3)
    data = [(generator.randrange(30), generator.choice([None, 1, 2, 3, 4]), generator.randrange(3))
            for _ in range(2000)]
    frame = spark.createDataFrame(data, "k int, a bigint, b bigint")
    got = {row.k: (row.a, row.b) for row in dominant_values(frame, ["k"], ["a", "b"]).collect()}
    for key in range(30):
        expected = []
        for position in (1, 2):
            values = [row[position] for row in data if row[0] == key and row[position] is not None]
            expected.append(min(set(values), key=lambda v: (-values.count(v), v)))
        assert got[key] == tuple(expected)


def test_unknown_merchant_stays(spark):
    rows = by_id(silver.payments(R.payments(spark, {"id": "1", "merchant_id": "x"})))
    assert rows[1].merchant_id is None


def test_bad_ids_are_kept_out_and_reported(spark):
    ids = ["12", "12.5", " 12", "-3", "18446744073709551615", "x", "", None]
    bronze = R.payments(spark, *[{"id": value} for value in ids])
    assert [row.transaction_id for row in silver.payments(bronze).collect()] == [12]
    rejected = rejected_ids(bronze)
    assert rejected.count() == 7
    reasons = {row.id: row._reason for row in rejected.collect()}
    assert reasons["18446744073709551615"] == "id out of range"
    assert reasons[None] == "missing id"
    assert reasons["-3"] == "id is not a number"


def test_one_row_per_snapshot_day(spark):
    bronze = R.link_transactions(
        spark, {"id": "1", S.SNAPSHOT: R.DAY_1}, {"id": "1", S.SNAPSHOT: R.DAY_2}, {"id": "1"}
    )
    assert silver.link_transactions(bronze).count() == 2
    assert silver.link_transactions(bronze, R.DAY_2).count() == 1
    assert silver.link_transactions(bronze, R.DAY_1, R.DAY_3).count() == 2


def test_merchants_typed_and_fingerprinted(spark):
    bronze = R.merchants(
        spark,
        {"id": "5", "acquirer_id": "7", "name": "", "state": "active"},
        {"id": "6", "name": "shop", "state": "active", "updated_at": "2025-10-01"},
    )
    frame = silver.merchants(bronze)
    assert frame.schema.simpleString() == S.SILVER_MERCHANTS.simpleString()
    rows = by_id(frame, "merchant_id")
    assert rows[5].merchant_name is None and rows[5].acquirer_id == 7
    assert rows[5].dim_fingerprint != rows[6].dim_fingerprint


def test_merchants_without_core_column_are_empty_but_typed(spark):
    bronze = R.merchants(spark, {"id": "5", "name": "x"}).drop(S.INGESTED)
    frame = silver.merchants(bronze)
    assert frame.count() == 0
    assert frame.schema.simpleString() == S.SILVER_MERCHANTS.simpleString()


def test_schemas(spark):
    for frame, contract in (
        (silver.payments(R.payments(spark)), S.SILVER_PAYMENTS),
        (silver.link_transactions(R.link_transactions(spark)), S.SILVER_LINK_TX),
    ):
        assert frame.schema.simpleString() == contract.simpleString()
        assert frame.count() == 0


def test_columns_merged_together_are_as_if_merged_alone(spark):
    generator = random.Random(5)
    data = [(generator.randrange(40), n, generator.choice([None, n % 9]), *[generator.choice([None, n, n + 1]) for _ in "abc"])
            for n in range(1500)]
    frame = spark.createDataFrame(data, "k int, id int, t int, a int, b int, c int").repartition(5)
    expected = frame.groupBy("k").agg(*[F.expr(f"{latest(c, 't', 'struct(t, id)')} AS {c}") for c in "abc"])
    for together in ([], ["a"], ["a", "c"], ["a", "b", "c"]):
        aggregates, found = latest_columns({c: c for c in "abc"}, "t", "struct(t, id)", together)
        merged = frame.groupBy("k").agg(*aggregates).select("k", *found)
        assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, expected.collect()))


def test_values_are_counted_in_one_row_before_the_shuffle(spark):
    """The columns of a row come apart only where its key is: above both shuffles of the plan."""
    rows = spark.range(100).selectExpr("id % 7 AS k", "id % 3 AS a", "id % 2 AS b")
    text = dominant_values(rows, ["k"], ["a", "b"])._jdf.queryExecution().executedPlan().toString()
    assert 0 < text.index("Generate") < text.index("Exchange") and text.count("Exchange hashpartitioning") == 2
