import datetime as dt
import re

import rows as R

from paylake import schemas as S
from paylake.operators.merge import empty
from paylake.plans import gold, silver, views
from paylake.plans.increments import LOGS, FactIncrements, differences, transaction_versions
from paylake.session import fresh_path
from paylake.sinks import tables as sink
from paylake.sources.tables import of_days


def transactions(spark, *rows):
    return silver.link_transactions(R.link_transactions(spark, *rows))


def payments(spark, *rows):
    return silver.payments(R.payments(spark, *rows))


def merchants(spark, *rows):
    return gold.dim_merchants(silver.merchants(R.merchants(spark, *rows)))


def fact(spark, links, pays, shops=({"id": "9", "name": "shop"},)):
    frame = gold.fact_transactions(
        transactions(spark, *links), payments(spark, *pays), merchants(spark, *shops)
    )
    return {row.transaction_id: row for row in frame.collect()}


def test_reference_comes_from_json_strings_only(spark):
    details = {
        1: '{"payment_reference": "a", "paymentReference": "b"}',
        2: '{"payment_reference": "", "paymentReference": "b"}',
        3: '{"payment_reference": 5, "reference": "c"}',
        4: '{"payment_reference": 5}',
        5: "bad", 6: "[1]", 7: "null", 8: None,
    }
    links = [{"id": str(i), "payment_details": text, "linkpay_reference": "col"}
             for i, text in details.items()]
    links.append({"id": "9", "payment_details": "bad", "linkpay_reference": ""})
    got = {r.transaction_id: r.payment_reference
           for r in gold.payment_references(transactions(spark, *links)).collect()}
    assert got == {1: "a", 2: "b", 3: "c", 4: "col", 5: "col", 6: "col", 7: "col", 8: "col", 9: None}


def test_two_snapshots_are_one_fact_row(spark):
    links = [
        {"id": "1", "linkpay_reference": "old", S.SNAPSHOT: R.DAY_1},
        {"id": "1", "linkpay_reference": "new", S.SNAPSHOT: R.DAY_2},
    ]
    rows = fact(spark, links, [])
    assert len(rows) == 1 and rows[1].payment_reference == "new" and rows[1].hasPayment == 0


def test_final_payment_is_the_latest_non_null_per_column(spark):
    pays = [
        {"id": "1", "reference": "r", "state": "initial", "card_type": "1", "merchant_id": "9",
         "created_at": "2025-10-01 10:00:00"},
        {"id": "2", "reference": "r", "state": "SETTLED", "created_at": "2025-10-01 10:00:00",
         "updated_at": "2025-10-01 12:00:00"},
        {"id": "3", "reference": "r", "state": "failed"},
    ]
    links = [{"id": "7", "linkpay_reference": "r", "created_at": "2025-10-01 09:59:30"}]
    row = fact(spark, links, pays)[7]
    assert (row.payment_state, row.payment_method_sk, row.hasPayment) == (1, 1, 1)
    assert row.TimeFromStartToEndSeconds == 2 * 3600 + 30
    assert row.merchant_sk is not None


def test_unmatched_sides_stay_null(spark):
    pays = [{"id": "1", "reference": "r", "state": "odd", "merchant_id": "404",
             "created_at": "2025-10-01"}, {"id": "2", "reference": None, "state": "settled"}]
    links = [{"id": "1", "linkpay_reference": "r"}, {"id": "2"}, {"id": "3", "linkpay_reference": "q"}]
    rows = fact(spark, links, pays)
    assert rows[1].hasPayment == 1 and rows[1].payment_state is None
    assert rows[1].merchant_sk is None and rows[1].payment_method_sk is None
    assert rows[1].TimeFromStartToEndSeconds is None
    assert rows[2].hasPayment == 0 and rows[3].hasPayment == 0


def test_no_card_is_labelled_in_the_view_only(spark):
    pays = [{"id": "1", "reference": "r", "state": "settled", "created_at": "2025-10-01"}]
    links = [{"id": "1", "linkpay_reference": "r"}, {"id": "2"}]
    frame = gold.fact_transactions(
        transactions(spark, *links), payments(spark, *pays), merchants(spark)
    )
    rates = views.failure_rate_by_payment_method(frame).collect()
    assert [(r.payment_method, r.total_reached_provider) for r in rates] == [("ACH transfer", 1)]


def test_dim_merchants_merges_days(spark):
    shops = [
        {"id": "9", "name": "first", "state": "active", "updated_at": "2025-10-01 00:00:00"},
        {"id": "9", "name": None, "state": "blocked", "updated_at": "2025-10-02 00:00:00",
         S.SNAPSHOT: R.DAY_2},
        {"id": "8", "name": "quiet", S.SNAPSHOT: R.DAY_3},
    ]
    rows = {r.merchant_id: r for r in merchants(spark, *shops).collect()}
    assert (rows[9].merchant_name, rows[9].merchant_state) == ("first", "blocked")
    assert rows[9].scd_start_date == R.DAY_2 and rows[9].scd_end_date == dt.date(9999, 12, 31)
    assert rows[8].scd_start_date == R.DAY_3 and rows[8].updated_at_raw is None


def test_calendar(spark):
    calendar = gold.dim_date(spark)
    assert calendar.count() == 14976
    assert calendar.where("is_weekend = 1").count() == 4280
    row = calendar.where("date_key = 20251005").first()
    assert (row.full_date, row.day_of_week, row.is_weekend, row.is_holiday) == (dt.date(2025, 10, 5), 7, 1, 0)


def test_incremental_equals_full_with_late_payments(spark):
    """A payment that arrives later, a changed reference, a repeated transaction."""
    links = [
        {"id": "1", "linkpay_reference": "a", "created_at": "2025-10-01"},
        {"id": "2", "linkpay_reference": "b", "created_at": "2025-10-01"},
        {"id": "3", "linkpay_reference": None, "created_at": "2025-10-01"},
        {"id": "2", "linkpay_reference": "c", "created_at": "2025-10-02", S.SNAPSHOT: R.DAY_2},
        {"id": "4", "linkpay_reference": "a", "created_at": None, S.SNAPSHOT: R.DAY_2},
    ]
    pays = [
        {"id": "10", "reference": "a", "state": "initial", "created_at": "2025-10-01 08:00:00"},
        {"id": "10", "reference": "a", "state": "settled", "updated_at": "2025-10-02 08:00:00",
         "created_at": "2025-10-01 08:00:00", S.SNAPSHOT: R.DAY_2},
        {"id": "11", "reference": "c", "state": "failed", "created_at": "2025-10-01", S.SNAPSHOT: R.DAY_1},
    ]
    tx, pay, shops = transactions(spark, *links), payments(spark, *pays), merchants(spark)
    late = [{"id": "10", "reference": "a", "state": "initial", "created_at": "2025-10-01 08:00:00"}, pays[2]]
    increments(spark, (of_days(tx, R.DAY_1), payments(spark, *late), shops), (tx, pay, shops))


def increments(spark, *states):
    """Loads that lead from each state (transactions, payments, merchants) to the next: the fact is that of the state."""
    root = fresh_path(spark, "increments")
    loads = FactIncrements(spark, root, f"{root}/fact", buckets=4)
    before = [frame.where("false") for frame in states[0]]
    for state in states:
        loads.record(*zip(before, state))
        loads.apply(state[2])
        assert loads.pending() == []
        full = gold.fact_transactions(*state)
        assert sorted(map(str, sink.read_fact(spark, f"{root}/fact").collect())) == sorted(map(str, full.collect()))
        before = state


def test_withdrawn_transactions_and_snapshots(spark):
    """A transaction that is gone, one whose latest snapshot is gone, one that lost its reference."""
    links = [
        {"id": "1", "linkpay_reference": "a", "created_at": "2025-10-01"},
        {"id": "2", "linkpay_reference": "b", "created_at": "2025-10-01"},
        {"id": "3", "linkpay_reference": "c", "created_at": "2025-10-01"},
        {"id": "2", "linkpay_reference": "a", "created_at": "2025-10-03", S.SNAPSHOT: R.DAY_2},
        {"id": "4", "linkpay_reference": "b", "created_at": None, S.SNAPSHOT: R.DAY_2},
    ]
    pays = [{"id": "1", "reference": ref, "state": "settled", "created_at": "2025-10-01"} for ref in "ab"]
    pays[1]["id"] = "2"
    after = [links[0], {"id": "3", "linkpay_reference": None, "created_at": "2025-10-01"}, links[1]]
    states = [
        (transactions(spark, *rows), payments(spark, *paid), merchants(spark))
        for rows, paid in ((links, pays), (after, pays[:1]), ([], []), (links, pays[1:]))
    ]
    increments(spark, *states)


def test_a_failed_run_is_applied_by_the_next(spark):
    root = fresh_path(spark, "increments")
    loads = FactIncrements(spark, root, f"{root}/fact", buckets=4)
    tx = transactions(spark, *[{"id": str(i), "linkpay_reference": f"r{i}", "created_at": "2025-10-01"} for i in range(9)])
    pay, shops = payments(
        spark, {"id": "1", "reference": "r1", "state": "settled", "merchant_id": "9", "created_at": "2025-10-01"}
    ), merchants(spark)
    none = [frame.where("false") for frame in (tx, pay, shops)]
    loads.record((none[0], tx.where("transaction_id < 5")))
    loads.record((tx.where("transaction_id < 5"), tx), (none[1], pay))
    assert loads.pending() == [1, 2]
    loads.apply(shops)
    full = gold.fact_transactions(tx, pay, shops)
    fact = sink.read_fact(spark, f"{root}/fact")
    assert sorted(map(str, fact.collect())) == sorted(map(str, full.collect()))
    # The mark was lost: the loads are applied once more.
    sink.drop_partitions(spark, root, ["done"])
    loads.apply(shops)
    assert sorted(map(str, sink.read_fact(spark, f"{root}/fact").collect())) == sorted(map(str, full.collect()))
    # Folded logs say the same.
    for name in ("versions", "references", "payments"):
        asked = {"versions": "transaction_id", "references": "payment_reference", "payments": "reference"}[name]
        keys = spark.createDataFrame([(v,) for v in ([1, 2] if name == "versions" else ["r1", "r2"])], [asked])
        before = sorted(map(str, loads.lookup(name, keys, 2).collect()))
        loads.compact(name)
        assert sorted(map(str, loads.lookup(name, keys, 2).collect())) == before and before
    late = merchants(spark, {"id": "9", "name": "late"})
    loads.record(merchants=(shops, late))
    loads.apply(late)
    full = gold.fact_transactions(tx, pay, late)
    assert full.where("merchant_sk IS NOT NULL").count() == 1
    assert sorted(map(str, sink.read_fact(spark, f"{root}/fact").collect())) == sorted(map(str, full.collect()))
    loads.record(merchants=(late, shops))
    loads.apply(shops)
    assert sink.read_fact(spark, f"{root}/fact").where("merchant_sk IS NOT NULL").count() == 0


def test_a_lookup_reads_only_the_buckets_of_its_keys(spark):
    root = fresh_path(spark, "increments")
    loads = FactIncrements(spark, root, f"{root}/fact", buckets=64)
    tx = transactions(spark, *[{"id": str(i), "linkpay_reference": f"r{i}", "created_at": "2025-10-01"} for i in range(300)])
    pay, shops = payments(spark, *[{"id": str(i), "reference": f"r{i}"} for i in range(300)]), merchants(spark)
    loads.record((tx.where("false"), tx), (pay.where("false"), pay))
    loads.apply(shops)
    found = loads.lookup("payments", spark.createDataFrame([("r7",)], "reference string"), 1)
    assert found.count() == 1
    text = found._sc._jvm.PythonSQLUtils.explainString(found._jdf.queryExecution(), "formatted")
    assert "PartitionFilters" in text and "_bucket" in text.split("PartitionFilters")[1][:200]
    files = {f.split("_bucket=")[1].split("/")[0] for f in spark.read.parquet(f"{root}/logs/payments").where("_bucket = 3").inputFiles()}
    assert len(files) > 1  # the table has many buckets, the lookup's plan filters on one


def test_increment_sees_new_merchants_and_withdrawn_payments(spark):
    tx = transactions(spark, *[{"id": str(i), "linkpay_reference": ref, "created_at": "2025-10-01"}
                               for i, ref in enumerate("abcd")])
    pays = [{"id": "1", "reference": "a", "state": "settled", "merchant_id": "9", "created_at": "2025-10-01"},
            {"id": "3", "reference": "c", "state": "initial", "merchant_id": "8", "created_at": "2025-10-01"},
            {"id": "5", "reference": "d", "state": "settled", "merchant_id": "8", "created_at": "2025-10-01"}]
    withdrawn = [{"id": "2", "reference": "b", "state": "settled", "merchant_id": "8", "created_at": "2025-10-01",
                  S.SNAPSHOT: R.DAY_2},
                 {"id": "3", "reference": "c", "state": "settled", "merchant_id": "8", "created_at": "2025-10-01",
                  "updated_at": "2025-10-02", S.SNAPSHOT: R.DAY_2}]
    shops = [{"id": "8", "name": "old"}, {"id": "9", "name": "new", S.SNAPSHOT: R.DAY_2}]
    known = merchants(spark, *shops)
    states = [(tx, payments(spark, *pays, *withdrawn), merchants(spark, shops[0])), (tx, payments(spark, *pays), known)]
    increments(spark, *states)


def test_a_first_load_reads_each_document_once(spark):
    """Nothing was stored before: no row is compared, and no document is parsed again for that."""
    path = fresh_path(spark, "silver")
    links = [{"id": str(i), "payment_details": f'{{"reference": "P{i}"}}' if i else None} for i in range(3)]
    sink.replace_partitions(transactions(spark, *links), path, silver.LINK_TX_KEY)
    stored = spark.read.schema(S.SILVER_LINK_TX).parquet(path)
    sides = [transaction_versions(frame) for frame in (empty(spark, S.SILVER_LINK_TX), stored)]
    for before, after, alive in ((*sides, True), (*reversed(sides), False)):
        found = differences(before, after, LOGS["versions"])
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert not re.search(r"Filter (?!\(true OR )", plan) and len(re.findall("Project.*parseJson", plan)) == 1
        rows = {(r.transaction_id, r.payment_reference, r._alive) for r in found.collect()}
        assert rows == {(0, None, alive), (1, "P1", alive), (2, "P2", alive)}
