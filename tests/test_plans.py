"""The physical plans: what is pushed down, what is shuffled, what happens with hot keys."""

import re

import pytest
from pyspark.sql import functions as F

from paylake import fixtures as X
from paylake import schemas as S
from paylake.operators import quality
from paylake.operators.joins import heavy_keys, lookup_join
from paylake.plans import extracts, gold, silver, views
from paylake.queries import _fact, _merchants, _stored, registered
from paylake.session import fresh_path
from paylake.sinks import tables as sink
from paylake.sources.tables import of_days, read_table


def plan(frame, mode="formatted"):
    explain = frame._sc._jvm.PythonSQLUtils.explainString
    return explain(frame._jdf.queryExecution(), mode)


# Queries that are one plan from the test tables to the result.
WRITING = {
    "backfill_range", "bronze_link_tx_day", "bronze_link_tx_full", "extract_payments", "fact_high_water_mark",
    "fact_increment", "ingest_available_now", "scan_missing_day", "schema_drift_union", "silver_insert_missing",
    "silver_upsert", "sink_partition_replace", "sink_replace_by_file", "sink_file_on_other_days", "views_for_role",
    "bucketed_match", "lake_quarantine", "lake_full_load",
}
LAZY = sorted(set(registered()) - WRITING)


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join_and_no_python(spark, sf_dir, name):
    text = plan(registered()[name](spark, sf_dir))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Window"):
        if operator == "Window" and name == "scan_csv_strings":
            continue  # windows over one split's lines
        assert operator not in text, operator


def test_no_hints_force_a_broadcast(spark, sf_dir, setting):
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    setting("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    assert "BroadcastHashJoin" not in plan(_fact(spark, sf_dir))


def test_result_is_the_same_without_broadcast(spark, sf_dir, setting):
    expected = sorted(map(str, _fact(spark, sf_dir).collect()))
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    setting("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    assert sorted(map(str, _fact(spark, sf_dir).collect())) == expected


def test_cutoff_and_columns_reach_the_scan(spark, sf_dir):
    frame = extracts.link_transactions(X.stage_link_transactions(spark, sf_dir), X.EXTRACT_SINCE)
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(o_orderdate", plan(frame))
    narrow = plan(views.never_reached_psp_overall(_fact(spark, sf_dir)))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", narrow)
    assert all("s_name" not in schema and "s_acctbal" not in schema for schema in schemas)


def test_day_is_a_partition_filter(spark, sf_dir):
    path = fresh_path(spark, "bronze")
    sink.replace_partitions(X.bronze_payments(spark, sf_dir).drop(*X.PAYMENT_TIEBREAK), path)
    stored = read_table(spark, path, S.BRONZE_PAYMENTS)
    assert re.search(r"PartitionFilters: \[.*_snapshot_date", plan(silver.payments(stored, "2025-10-03")))
    assert re.search(r"PartitionFilters: \[.*_snapshot_date", plan(of_days(stored, "2025-10-02", "2025-10-04")))


def test_views_aggregate_before_they_join(spark, sf_dir):
    fact, merchants = _stored(_fact(spark, sf_dir), "fact"), _stored(_merchants(spark, sf_dir), "m")
    for view in (views.failure_rate_by_provider, views.payment_failure_rates, views.abandoned_by_merchant):
        simple = plan(view(fact, merchants), "simple")
        join = simple.index("Join")
        assert simple.index("HashAggregate", join) > join
        assert "transaction_id" not in simple


def test_silver_join_adds_no_shuffle(spark, sf_dir, setting):
    """Latest values: one shuffle; counted values: two; joining them: none."""
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    rows = _stored(X.bronze_payments(spark, sf_dir), "bronze")
    frame = silver.payments(rows, tiebreak=X.PAYMENT_TIEBREAK)
    assert plan(frame, "simple").count("Exchange hashpartitioning") == 3


def hot_transactions(spark, rows):
    """A third of the rows share one reference, a third have none."""
    return spark.range(rows).selectExpr(
        "id AS transaction_id",
        "CASE id % 3 WHEN 0 THEN 'hot' WHEN 1 THEN NULL ELSE concat('r', id) END AS payment_reference",
    )


def final_payments(spark, rows):
    keys = spark.range(rows).selectExpr("CASE WHEN id = 0 THEN 'hot' ELSE concat('r', id) END AS k", "id")
    return keys.groupBy(F.expr("k AS pay_reference")).agg(F.expr("max(id) AS v"))


def executed(frame):
    frame.write.format("noop").mode("overwrite").save()
    frame.collect()
    return frame._jdf.queryExecution().executedPlan().toString()


def test_hot_reference_is_split_and_missing_references_are_spread(spark, setting):
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    setting("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    setting("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "100KB")
    setting("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "2")
    setting("spark.sql.adaptive.advisoryPartitionSizeInBytes", "100KB")
    setting("spark.sql.shuffle.partitions", "16")
    rows = 300_000
    left = hot_transactions(spark, rows).repartition(12)
    joined = lookup_join(left, final_payments(spark, rows), "payment_reference", "pay_reference", "transaction_id")
    assert "skew=true" in executed(joined)
    got = joined.selectExpr("count(*)", "count(v)", "count(distinct transaction_id)").first()
    assert tuple(got) == (rows, 2 * rows // 3, rows)

    # Rows without a reference: no partition gets more than its share.
    salted = left.where("payment_reference IS NULL").selectExpr(
        "payment_reference", "pmod(xxhash64(transaction_id), 4096) AS _salt"
    ).repartition(16, "payment_reference", "_salt")
    sizes = [r["count"] for r in salted.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 16 and max(sizes) < 2 * sum(sizes) / 16


def test_hot_reference_is_split_before_it_is_grouped(spark, setting):
    """The increment's restriction to affected references, with a third of all payments on one."""
    for key, value in {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
        "spark.sql.shuffle.partitions": "16",
    }.items():
        setting(key, value)
    rows = 200_000
    payments = spark.range(0, rows, 1, 12).selectExpr(
        "id AS transaction_id", "'settled' AS payment_state", "'1' AS card_type", "id % 50 AS merchant_id",
        "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('r', id) END AS reference",
        "timestamp '2025-10-01' + make_dt_interval(0, 0, 0, id) AS created_at",
        "cast(NULL AS timestamp) AS updated_at", "date '2025-10-01' AS _snapshot_date",
    )
    affected = spark.range(rows).selectExpr("CASE WHEN id % 2 = 0 THEN 'hot' ELSE concat('r', id) END AS reference")
    final = gold.payment_final(payments.join(affected, "reference", "left_semi"))
    assert "skew=true" in executed(final)
    hot = final.where("pay_reference = 'hot'").first()
    assert hot.final_merchant_id == (rows - 2) % 50  # 199,998 is the last multiple of three
    assert final.count() == 1 + sum(1 for i in range(rows) if i % 2 and i % 3)


def test_heavy_merchants_leave_the_shuffle(spark, setting):
    """Only heavy keys are looked up aside; no row is repeated for ordinary ones."""
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    setting("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    left = spark.range(20_000).selectExpr(
        "id AS tx", "CASE WHEN id % 3 = 0 THEN 1 WHEN id % 7 = 0 THEN 5000 WHEN id % 11 > 0 THEN id END AS m"
    )
    right = spark.range(1000).selectExpr("id AS merchant", "nullif(id, 1) * 10 AS sk")
    heavy = heavy_keys(left, "m")
    assert sorted(heavy) == [1, 5000]
    for how in ("left", "inner"):
        joined = lookup_join(left, right, "m", "merchant", "tx", heavy, how)
        expected = left.join(right, F.expr("m = merchant"), how)
        columns = ["tx", "m", "merchant", "sk"]
        assert joined.columns == columns
        assert sorted(map(str, joined.collect())) == sorted(map(str, expected.select(columns).collect()))
    text = plan(lookup_join(left, right, "m", "merchant", "tx", heavy), "simple")
    assert "Generate" not in text
    # Heavy rows are spread like those without a key: no partition gets more than its share.
    keyed = left.selectExpr("*", "CASE WHEN m NOT IN (1, 5000) THEN m END AS _key").selectExpr(
        "_key", "CASE WHEN _key IS NULL THEN pmod(xxhash64(tx), 4096) ELSE 0 END AS _salt"
    ).repartition(16, "_key", "_salt")
    sizes = [r["count"] for r in keyed.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 16 and max(sizes) < 2 * sum(sizes) / 16


def test_no_heavy_keys(spark):
    assert heavy_keys(spark.range(0).selectExpr("id AS m"), "m") == []
    assert heavy_keys(spark.range(9).selectExpr("cast(NULL AS int) AS m"), "m") == []


def test_lookup_join_keeps_repeated_right_rows(spark):
    left = spark.createDataFrame([(1, 10), (2, 11), (3, None)], "tx int, k int")
    right = spark.createDataFrame([(10, "a"), (10, "b")], "rk int, v string")
    for heavy in ([], [10], [10, 11]):
        inner = lookup_join(left, right, "k", "rk", "tx", heavy, how="inner")
        assert sorted((r.tx, r.v) for r in inner.collect()) == [(1, "a"), (1, "b")]
        assert lookup_join(left, right, "k", "rk", "tx", heavy).count() == 4


def test_buckets_join_without_a_shuffle(spark, sf_dir):
    text = plan(registered()["bucketed_match"](spark, sf_dir), "simple")
    assert "SortMergeJoin" in text and "Exchange" not in text


def test_late_rows_prune_the_periods_of_the_fact(spark):
    import datetime as dt

    path = fresh_path(spark, "fact")
    day = lambda n: dt.datetime(2025, 10, n, 9, 0, 0)
    row = lambda t, start: (f"k{t}", t, f"r{t}", 1, 1, None, None, 5, start)
    sink.write_fact(spark.createDataFrame([row(n, day(n)) for n in range(1, 20)] + [row(99, None)], S.FACT_TRANSACTIONS), path)
    load = [row(5, day(5)), row(50, day(5)), row(30, day(30)), row(98, None), row(99, None)]
    frame = spark.createDataFrame(load, S.FACT_TRANSACTIONS)
    fact = read_table(spark, path, sink.FACT_STORED)
    text = plan(sink.same_periods(fact, sink._with_period(frame, "day")), "simple")
    assert "dynamicpruning" in text
    sink.append_newer_fact(frame, path)
    ids = sorted(r.transaction_id for r in sink.read_fact(spark, path).collect())
    assert ids == sorted([*range(1, 20), 30, 50, 98, 99])
    sink.append_newer_fact(frame, path)
    assert sink.read_fact(spark, path).count() == len(ids)


def test_checks_scan_once(spark, sf_dir):
    frame = X.table(spark, sf_dir, "lineitem")
    text = plan(quality.checks(frame, "t", ["l_shipdate"], [["l_orderkey"], ["l_partkey", "l_suppkey"]]), "simple")
    # One shuffle by key, one of the single result row.
    assert text.count("FileScan") == 1 and text.count("Exchange") == 2


def test_hot_id_is_merged_before_the_shuffle(spark, setting):
    """A third of all rows carry one id: the reducer gets one partial row per map task."""
    setting("spark.sql.adaptive.enabled", "false")
    bronze = spark.range(0, 60_000, 1, 6).selectExpr(
        "CASE WHEN id % 3 = 0 THEN '1' ELSE cast(id AS string) END AS id", "cast(id % 5 AS string) AS merchant_id",
        "'1' AS acquirer_id", "cast(id AS string) AS state", "'1' AS card_type", "'r' AS reference",
        "'o' AS order_reference", "'d' AS details", "'2025-10-01' AS created_at", "'2025-10-01' AS updated_at",
        "timestamp '2025-10-01' + make_dt_interval(0, 0, 0, id) AS _ingested_at", "'f' AS _source_file",
        "date '2025-10-01' AS _snapshot_date",
    )
    frame = silver.payments(bronze)
    text = plan(frame, "simple")
    assert text.count("partial_max_by") >= 2 and "partial_count" in text
    row = frame.where("transaction_id = 1").first()
    assert row.payment_state == "59997" and row.merchant_id == 1
    assert frame.count() == 40_000  # "1" itself is among the other ids


def test_a_large_day_is_written_by_several_tasks(spark, setting):
    import glob

    setting("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    rows = spark.range(0, 60_000, 1, 12).selectExpr(
        "id AS transaction_id", "sha2(cast(id AS string), 256) AS state",
        "CASE WHEN id % 10 < 8 THEN date '2025-10-01' ELSE date_add(date '2025-10-01', cast(id % 10 AS int)) END AS _snapshot_date",
    )
    path = fresh_path(spark, "large-day")
    sink.replace_partitions(rows, path, ["transaction_id"])
    files = {d: len(glob.glob(f"{path}/_snapshot_date=2025-10-{d}/*.parquet")) for d in ("01", "09", "10")}
    assert files["01"] > 4, files
    assert spark.read.parquet(path).count() == 60_000


def test_payment_final_leaves_missing_references_out_before_the_shuffle(spark, sf_dir):
    stored = _stored(silver.payments(X.bronze_payments(spark, sf_dir), tiebreak=X.PAYMENT_TIEBREAK), "silver")
    text = plan(gold.payment_final(stored))
    assert re.search(r"PushedFilters: \[IsNotNull\(reference\)\]", text)
