import datetime as dt
import glob

import pyarrow.parquet as pq
import rows as R
from pyspark.sql import functions as F

from paylake import schemas as S
from paylake.plans import silver
from paylake.session import fresh_path
from paylake.sinks import tables as sink
from paylake.sources.daily_files import day_range
from paylake.sources.tables import read_drifted, read_table, table_exists


def links(spark, *rows):
    return silver.link_transactions(R.link_transactions(spark, *rows))


def content(frame):
    return sorted(map(str, frame.collect()))


def test_reload_changes_nothing_and_other_days_stay(spark):
    path = fresh_path(spark, "t")
    rows = links(spark, *[{"id": str(i), S.SNAPSHOT: d} for i in range(9) for d in (R.DAY_1, R.DAY_2)])
    sink.replace_partitions(rows, path, silver.LINK_TX_KEY)
    before = content(read_table(spark, path, S.SILVER_LINK_TX))
    sink.replace_partitions(rows.where(f"{S.SNAPSHOT} = date '2025-10-02'"), path, silver.LINK_TX_KEY)
    assert content(read_table(spark, path, S.SILVER_LINK_TX)) == before
    assert len(before) == 18


def test_ensure_table(spark):
    path = fresh_path(spark, "t")
    assert not table_exists(spark, path)
    assert read_table(spark, path, S.BRONZE_PAYMENTS).count() == 0
    sink.ensure_table(spark, path, S.BRONZE_PAYMENTS)
    assert table_exists(spark, path)
    assert read_table(spark, path, S.BRONZE_PAYMENTS).count() == 0
    assert read_drifted(spark, path, S.BRONZE_PAYMENTS).columns == S.BRONZE_PAYMENTS.fieldNames()
    sink.replace_partitions(R.payments(spark, {"id": "1"}), path)
    sink.ensure_table(spark, path, S.BRONZE_PAYMENTS)
    assert read_table(spark, path, S.BRONZE_PAYMENTS).count() == 1


def test_replace_source_files(spark):
    path = fresh_path(spark, "t")
    sink.replace_partitions(
        R.payments(spark, {"id": "1", S.SOURCE_FILE: "a"}, {"id": "2", S.SOURCE_FILE: "b"},
                   {"id": "3", S.SOURCE_FILE: "a", S.SNAPSHOT: R.DAY_2}),
        path,
    )
    again = R.payments(spark, {"id": "4", S.SOURCE_FILE: "a"})
    for _ in range(2):
        sink.replace_source_files(again, path, S.BRONZE_PAYMENTS)
        rows = read_table(spark, path, S.BRONZE_PAYMENTS).collect()
        # Also the row that the file had on a day it has none on any more.
        assert sorted((r.id, r[S.SOURCE_FILE]) for r in rows) == [("2", "b"), ("4", "a")]
    sink.replace_source_files(
        R.payments(spark, {"id": "5", S.SOURCE_FILE: "c", S.SNAPSHOT: R.DAY_3}), path, S.BRONZE_PAYMENTS
    )
    sink.replace_source_files(again.where("false"), path, S.BRONZE_PAYMENTS, ["a", "c", "unknown"])
    assert [r.id for r in read_table(spark, path, S.BRONZE_PAYMENTS).collect()] == ["2"]


def test_drift(spark):
    path = fresh_path(spark, "t")
    sink.replace_partitions(R.payments(spark, {"id": "1"}), path)
    later = R.payments(spark, {"id": "2", S.SNAPSHOT: R.DAY_2}).withColumn("fee", F.lit("5"))
    sink.replace_partitions(later, path)
    frame = read_drifted(spark, path, S.BRONZE_PAYMENTS)
    assert frame.columns == S.BRONZE_PAYMENTS.fieldNames() + ["fee"]
    assert {r.id: r.fee for r in frame.collect()} == {"1": None, "2": "5"}


def test_append_missing_twice(spark):
    path = fresh_path(spark, "t")
    sink.append_missing(links(spark, {"id": "1", "state": "a"}), path, S.SILVER_LINK_TX, silver.LINK_TX_KEY)
    more = links(spark, {"id": "1", "state": "b"}, {"id": "2", "state": "b"})
    for _ in range(2):
        sink.append_missing(more, path, S.SILVER_LINK_TX, silver.LINK_TX_KEY)
        rows = read_table(spark, path, S.SILVER_LINK_TX).collect()
        assert {r.transaction_id: r.state for r in rows} == {1: "a", 2: "b"} and len(rows) == 2


def test_upsert_days(spark):
    path = fresh_path(spark, "t")
    first = links(spark, {"id": "1", "state": "a"}, {"id": "2", "state": "a"},
                  {"id": "1", "state": "a", S.SNAPSHOT: R.DAY_2})
    sink.upsert_days(first, path, S.SILVER_LINK_TX, silver.LINK_TX_KEY)
    sink.upsert_days(links(spark, {"id": "1", "state": "b"}), path, S.SILVER_LINK_TX, silver.LINK_TX_KEY)
    rows = read_table(spark, path, S.SILVER_LINK_TX).collect()
    assert sorted((r.transaction_id, str(r[S.SNAPSHOT]), r.state) for r in rows) == [
        (1, "2025-10-01", "b"), (1, "2025-10-02", "a"), (2, "2025-10-01", "a"),
    ]


def fact_row(transaction, start, state=1):
    return (f"k{transaction}", transaction, f"r{transaction}", 1, state, None, None, 5, start)


def test_fact_rows_may_change_their_period(spark):
    """A row moves from one day to another; a day left empty keeps nothing behind."""
    day = lambda n: dt.datetime(2025, 10, n, 9, 0, 0)
    path = fresh_path(spark, "fact")
    rows = [fact_row(1, day(1)), fact_row(2, day(2)), fact_row(3, day(2)), fact_row(4, None), fact_row(5, day(9))]
    sink.write_fact(spark.createDataFrame(rows, S.FACT_TRANSACTIONS), path)
    changes = [fact_row(1, day(2), 2), fact_row(4, day(3), 2), fact_row(3, None, 2), fact_row(6, day(6), 2)]
    for _ in range(2):
        sink.upsert_fact(spark.createDataFrame(changes, S.FACT_TRANSACTIONS), path)
        got = {r.transaction_id: (r[S.GATING_TS], r.payment_state) for r in sink.read_fact(spark, path).collect()}
        assert got == {
            1: (day(2), 2), 2: (day(2), 1), 3: (None, 2), 4: (day(3), 2), 5: (day(9), 1), 6: (day(6), 2),
        }
        assert sink.read_fact(spark, path).count() == 6


def test_only_touched_periods_are_rewritten(spark):
    import glob
    import os

    path = fresh_path(spark, "fact")
    day = lambda n: dt.datetime(2025, 10, n, 9, 0, 0)
    sink.write_fact(spark.createDataFrame([fact_row(n, day(n)) for n in (1, 2, 3)], S.FACT_TRANSACTIONS), path)
    files = {f: os.path.getmtime(f) for f in glob.glob(f"{path}/*/*.parquet")}
    sink.upsert_fact(spark.createDataFrame([fact_row(2, day(2), 4)], S.FACT_TRANSACTIONS), path)
    kept = [f for f in files if os.path.exists(f)]
    assert len(kept) == 2 and not any("2025-10-02" in f for f in kept)


def test_create_or_replace(spark):
    path = fresh_path(spark, "lake")
    sink.create_or_replace(spark.range(3), path)
    sink.create_or_replace(spark.range(2), path)
    assert spark.read.parquet(path).count() == 2


def test_a_failed_write_leaves_the_old_extract(spark):
    """Nor does a swap that stopped half way lose it."""
    import os

    import pytest

    path = fresh_path(spark, "lake")
    sink.create_or_replace(spark.range(3), path)
    broken = spark.range(5).selectExpr("assert_true(id < 4) AS ok", "id")
    with pytest.raises(Exception, match="is not true"):
        sink.create_or_replace(broken, path)
    assert spark.read.parquet(path).count() == 3
    os.rename(path, path + "-former")
    sink.create_or_replace(spark.range(4), path)
    assert spark.read.parquet(path).count() == 4
    assert not os.path.exists(path + "-former") and not os.path.exists(path + "-new")


def test_changed_and_withdrawn_fact_rows(spark):
    day = lambda n: dt.datetime(2025, 10, n, 9, 0, 0)
    path = fresh_path(spark, "fact")
    rows = [fact_row(1, day(1)), fact_row(2, day(2)), fact_row(3, day(2)), fact_row(4, None), fact_row(5, day(9))]
    sink.write_fact(spark.createDataFrame(rows, S.FACT_TRANSACTIONS), path)
    changes = spark.createDataFrame([fact_row(1, day(2), 2), fact_row(6, None, 2)], S.FACT_TRANSACTIONS)
    gone = spark.createDataFrame([(4,), (5,)], "transaction_id long")
    starts = spark.createDataFrame([(day(1),), (None,), (day(9),)], "start timestamp")
    for _ in range(2):
        sink.change_fact(changes, gone, starts, path)
        got = {r.transaction_id: r[S.GATING_TS] for r in sink.read_fact(spark, path).collect()}
        assert got == {1: day(2), 2: day(2), 3: day(2), 6: None}


def test_a_day_without_rows_is_emptied(spark, tmp_path):
    path = str(tmp_path / "days")
    rows = spark.sql("SELECT id, date_add(date '2025-10-01', cast(id % 3 AS int)) AS _snapshot_date FROM range(9)")
    sink.replace_partitions(rows, path, ["id"])
    days = day_range("2025-10-01", "2025-10-02")
    sink.replace_partitions(rows.where("id % 3 = 0"), path, ["id"], loaded=days)
    assert sorted(r.id for r in spark.read.schema(rows.schema).parquet(path).collect()) == [0, 2, 3, 5, 6, 8]
    sink.replace_partitions(rows.where("false"), path, ["id"], loaded=days)
    assert sorted(r.id for r in spark.read.schema(rows.schema).parquet(path).collect()) == [2, 5, 8]


def test_raw_rows_are_written_without_dictionaries(spark, tmp_path):
    path = str(tmp_path / "raw")
    sink.replace_partitions(R.payments(spark, *[{"id": str(i), "state": "a"} for i in range(50)]), path)
    assert read_table(spark, path, S.BRONZE_PAYMENTS).where("state = 'a'").count() == 50
    for file in glob.glob(f"{path}/*/*.parquet"):
        columns = pq.ParquetFile(file).metadata.row_group(0)
        for n in range(columns.num_columns):
            assert not columns.column(n).has_dictionary_page and columns.column(n).compression == "ZSTD"
