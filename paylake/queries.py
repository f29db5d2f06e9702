"""The registered queries: name to ``(spark, sf_dir) -> DataFrame``.

Every query starts from the test tables and covers all their rows.  Queries about
sources and sinks write to a fresh folder below the shared folder and give the
table as read back.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paylake import fixtures as X
from paylake import schemas as S
from paylake.operators import quality
from paylake.operators.merge import align
from paylake.plans import bronze, extracts, gold, silver, views
from paylake.plans.increments import FactIncrements
from paylake.plans.lakehouse import Lakehouse
from paylake.session import configure, fresh_path
from paylake.sinks import tables as sink
from paylake.sources.daily_files import DailyFiles, day_range, read_days
from paylake.sources.tables import of_days, read_drifted, read_table
from paylake.streaming.arrivals import ingest_available

Query = Callable[[SparkSession, str], DataFrame]

SPLIT_DAY = "2025-10-04"
NEXT_DAY = "2025-10-05"
ONE_DAY = "2025-10-03"
WIDE_RANGE = ("2025-09-20", "2025-10-20")


# ---- shared inputs ----------------------------------------------------------


def _silver_payments(spark: SparkSession, d: str) -> DataFrame:
    return silver.payments(X.bronze_payments(spark, d), tiebreak=X.PAYMENT_TIEBREAK)


def _silver_link_tx(spark: SparkSession, d: str) -> DataFrame:
    return silver.link_transactions(X.bronze_link_transactions(spark, d))


def _silver_merchants(spark: SparkSession, d: str) -> DataFrame:
    return silver.merchants(X.bronze_merchants(spark, d))


def _merchants(spark: SparkSession, d: str) -> DataFrame:
    return gold.dim_merchants(_silver_merchants(spark, d))


def _fact(spark: SparkSession, d: str, merchants: DataFrame | None = None) -> DataFrame:
    return gold.fact_transactions(
        _silver_link_tx(spark, d), _silver_payments(spark, d), merchants or _merchants(spark, d)
    )


def _stored(frame: DataFrame, name: str) -> DataFrame:
    """``frame`` written to the shared folder and read back: its lineage ends here."""
    path = fresh_path(frame.sparkSession, name)
    frame.write.options(**sink.PACKED).parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def _from_day(day: str):
    return F.col(S.SNAPSHOT) >= F.lit(day).cast("date")


def _daily_files(frame: DataFrame, prefix: str, columns: list[str]) -> DailyFiles:
    """``frame`` as daily CSV files: one folder of part files per day, packed, in one write."""
    folder = fresh_path(frame.sparkSession, "files")
    _write_daily(frame, folder, prefix, columns)
    return DailyFiles(folder, f"file={prefix}")


def _write_daily(frame: DataFrame, folder: str, prefix: str, columns: list[str]) -> None:
    name = F.concat(F.lit(f"{prefix}-"), F.date_format(S.SNAPSHOT, "yyyyMMdd"), F.lit(".csv"))
    (
        frame.select(*columns, name.alias("file"))
        .write.partitionBy("file").option("header", True).option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False).option("compression", "gzip")
        # Half the time for a quarter more bytes.
        .option("zlib.compress.level", "BEST_SPEED").csv(folder)
    )


# ---- sources ----------------------------------------------------------------


def scan_csv_strings(spark: SparkSession, d: str) -> DataFrame:
    """Text columns from CSV with quotes, JSON and line breaks inside fields."""
    rows = X.bronze_link_transactions(spark, d).withColumn(
        "payment_details", F.replace("payment_details", F.lit("not json"), F.lit('not\n"json"'))
    )
    files = _daily_files(rows, "link_transactions", S.LINK_TX_COLUMNS)
    return read_days(spark, files, *WIDE_RANGE, S.BRONZE_LINK_TX).drop(S.INGESTED)


def scan_daily_files(spark: SparkSession, d: str) -> DataFrame:
    files = _daily_files(X.bronze_payments(spark, d), "payments", S.PAYMENT_COLUMNS)
    return read_days(spark, files, X.FIRST_DAY, X.LAST_DAY, S.BRONZE_PAYMENTS).drop(S.INGESTED)


def scan_missing_day(spark: SparkSession, d: str) -> DataFrame:
    """A month of days, two of which have a file."""
    files = _daily_files(X.bronze_merchants(spark, d), "merchants", S.MERCHANT_COLUMNS)
    rows = read_days(spark, files, *WIDE_RANGE, S.BRONZE_MERCHANTS)
    return rows.groupBy(S.SNAPSHOT).agg(F.count("*").alias("rows"), F.count("name").alias("named"))


def _landing(spark: SparkSession, d: str) -> str:
    path = fresh_path(spark, "landing")
    sink.replace_partitions(bronze.landed_link_transactions(X.bronze_link_transactions(spark, d)), path)
    return path


def bronze_link_tx_day(spark: SparkSession, d: str) -> DataFrame:
    return bronze.link_transactions_day(spark, _landing(spark, d), ONE_DAY).drop(S.INGESTED)


def bronze_link_tx_full(spark: SparkSession, d: str) -> DataFrame:
    return bronze.link_transactions_full(spark, _landing(spark, d), X.LAST_DAY).drop(S.INGESTED)


def extract_link_tx(spark: SparkSession, d: str) -> DataFrame:
    return extracts.link_transactions(X.stage_link_transactions(spark, d), X.EXTRACT_SINCE)


def extract_merchants(spark: SparkSession, d: str) -> DataFrame:
    return extracts.merchants(X.stage_merchants(spark, d))


def extract_payments(spark: SparkSession, d: str) -> DataFrame:
    """Through the lake sink, as the extract job runs it."""
    path = fresh_path(spark, "extract")
    rows = extracts.payments(X.stage_payments(spark, d), X.stage_merchants(spark, d), X.EXTRACT_SINCE)
    sink.create_or_replace(rows, path)
    return spark.read.schema(rows.schema).parquet(path)


def ingest_available_now(spark: SparkSession, d: str) -> DataFrame:
    files = _daily_files(X.bronze_merchants(spark, d), "merchants", S.MERCHANT_COLUMNS)
    table = fresh_path(spark, "bronze")
    ingest_available(spark, files, table, S.BRONZE_MERCHANTS, fresh_path(spark, "progress"))
    return read_table(spark, table, S.BRONZE_MERCHANTS).drop(S.INGESTED)


# ---- silver -----------------------------------------------------------------


def silver_payments_day(spark: SparkSession, d: str) -> DataFrame:
    return silver.payments(X.bronze_payments(spark, d), ONE_DAY, tiebreak=X.PAYMENT_TIEBREAK)


def silver_merchants_empty(spark: SparkSession, d: str) -> DataFrame:
    """Bronze as it should be, and bronze without one of the columns needed."""
    complete = X.bronze_merchants(spark, d)
    inputs = {"complete": complete, "without _ingested_at": complete.drop(S.INGESTED)}
    counts = [
        silver.merchants(rows).agg(F.count("*").alias("rows")).select(F.lit(name).alias("bronze"), "rows")
        for name, rows in inputs.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def quarantine_bad_ids(spark: SparkSession, d: str) -> DataFrame:
    raw = X.with_unusable_ids(X.bronze_payments(spark, d))
    return quality.rejected_ids(raw).select("id", "_reason", "reference", "details", S.SNAPSHOT)


# ---- sinks ------------------------------------------------------------------


def _outdated(rows: DataFrame, column: str = "state") -> DataFrame:
    return rows.withColumn(column, F.lit("old"))


def sink_partition_replace(spark: SparkSession, d: str) -> DataFrame:
    """An outdated table, some of whose days are loaded again, twice."""
    rows, path = _silver_link_tx(spark, d), fresh_path(spark, "silver")
    sink.replace_partitions(_outdated(rows), path, silver.LINK_TX_KEY)
    for _ in range(2):
        sink.replace_partitions(rows.where(_from_day(SPLIT_DAY)), path, silver.LINK_TX_KEY)
    return read_table(spark, path, S.SILVER_LINK_TX)


def sink_partition_emptied(spark: SparkSession, d: str) -> DataFrame:
    """A table whose later days are delivered again; one of them has no rows any more."""
    rows, path = _silver_link_tx(spark, d), fresh_path(spark, "silver")
    sink.replace_partitions(_outdated(rows), path, silver.LINK_TX_KEY)
    again = rows.where(_from_day(SPLIT_DAY) & ~F.col(S.SNAPSHOT).isin(F.to_date(F.lit(NEXT_DAY))))
    sink.replace_partitions(again, path, silver.LINK_TX_KEY, loaded=day_range(SPLIT_DAY, X.LAST_DAY))
    return read_table(spark, path, S.SILVER_LINK_TX)


def sink_file_on_other_days(spark: SparkSession, d: str) -> DataFrame:
    """Files whose rows are spread over days; some come again with fewer days, one with none."""
    part = (F.col("id").cast("bigint") % 5).cast("string")
    rows = X.bronze_link_transactions(spark, d).withColumn(S.SOURCE_FILE, F.concat(F.lit("part-"), part))
    path = fresh_path(spark, "bronze")
    sink.replace_partitions(_outdated(rows), path)
    again = rows.where(F.col(S.SOURCE_FILE).isin("part-0", "part-1") & ~_from_day(SPLIT_DAY))
    sink.replace_source_files(again, path, S.BRONZE_LINK_TX, ["part-0", "part-1", "part-2"])
    return read_table(spark, path, S.BRONZE_LINK_TX).select(
        "id", "state", "linkpay_reference", S.SOURCE_FILE, S.SNAPSHOT
    )


def sink_replace_by_file(spark: SparkSession, d: str) -> DataFrame:
    """Three files per day, one of which is delivered again."""
    part = (F.col("id").cast("bigint") % 3).cast("string")
    name = F.concat(F.lit("part-"), part, F.lit("-"), F.date_format(S.SNAPSHOT, "yyyyMMdd"))
    rows = X.bronze_link_transactions(spark, d).withColumn(S.SOURCE_FILE, name)
    path = fresh_path(spark, "bronze")
    sink.replace_partitions(_outdated(rows), path)
    again = rows.where(F.col(S.SOURCE_FILE).startswith("part-0-"))
    sink.replace_source_files(again, path, S.BRONZE_LINK_TX)
    return read_table(spark, path, S.BRONZE_LINK_TX).select(
        "id", "state", "linkpay_reference", S.SOURCE_FILE, S.SNAPSHOT
    )


def schema_drift_union(spark: SparkSession, d: str) -> DataFrame:
    """Early days lack a column of the contract, later days bring a new one."""
    rows, path = X.bronze_link_transactions(spark, d), fresh_path(spark, "bronze")
    early = rows.where(~_from_day(SPLIT_DAY)).drop("linkpay_reference")
    late = rows.where(_from_day(SPLIT_DAY)).withColumn("channel", F.concat(F.lit("channel-"), "state"))
    sink.replace_partitions(align(early, S.BRONZE_LINK_TX), path)
    sink.replace_partitions(late, path)
    return read_drifted(spark, path, S.BRONZE_LINK_TX).drop(S.INGESTED, S.SOURCE_FILE)


def silver_insert_missing(spark: SparkSession, d: str) -> DataFrame:
    """All days are offered; days the table holds keep their rows."""
    rows, path = _silver_link_tx(spark, d), fresh_path(spark, "silver")
    sink.replace_partitions(_outdated(rows.where(~_from_day(SPLIT_DAY))), path, silver.LINK_TX_KEY)
    days = day_range(X.FIRST_DAY, X.LAST_DAY)
    sink.append_missing(rows, path, S.SILVER_LINK_TX, silver.LINK_TX_KEY, days)
    return read_table(spark, path, S.SILVER_LINK_TX)


def silver_upsert(spark: SparkSession, d: str) -> DataFrame:
    """Card payments of the later days are written again."""
    rows = _stored(_silver_payments(spark, d), "silver-input")
    path = fresh_path(spark, "silver")
    sink.replace_partitions(_outdated(rows, "payment_state"), path, silver.PAYMENT_KEY)
    again = rows.where(_from_day(SPLIT_DAY) & F.col("card_type").isNotNull())
    sink.upsert_days(again, path, S.SILVER_PAYMENTS, silver.PAYMENT_KEY)
    return read_table(spark, path, S.SILVER_PAYMENTS)


def backfill_range(spark: SparkSession, d: str) -> DataFrame:
    """Several days from bronze to silver in one job."""
    path = fresh_path(spark, "silver")
    rows = silver.payments(
        X.bronze_payments(spark, d), "2025-10-02", "2025-10-06", tiebreak=X.PAYMENT_TIEBREAK
    )
    sink.replace_partitions(rows, path, silver.PAYMENT_KEY)
    return read_table(spark, path, S.SILVER_PAYMENTS)


# ---- gold -------------------------------------------------------------------


def dim_date(spark: SparkSession, d: str) -> DataFrame:
    """The calendar with the number of payments initiated per day.

    It begins before the test tables do; a day or NULL outside it would still be a row.
    """
    started = (
        X.stage_link_transactions(spark, d)
        .groupBy(F.to_date("created_at").alias("_day")).agg(F.count("*").alias("initiated"))
    )
    calendar = gold.dim_date(spark, start="1990-01-01")
    return (
        calendar.join(started, F.col("full_date") == F.col("_day"), "full").drop("_day")
        .withColumn("initiated", F.coalesce("initiated", F.lit(0).cast("bigint")))
    )


def _used(dimension: DataFrame, counts: DataFrame, key: str) -> DataFrame:
    return (
        dimension.join(counts, F.col(key) == F.col("_value"), "left").drop("_value")
        .withColumn("payments", F.coalesce("payments", F.lit(0).cast("bigint")))
    )


def dim_payment_method(spark: SparkSession, d: str) -> DataFrame:
    """The methods with the payments that carry their value; no value matches none."""
    counts = _silver_payments(spark, d).groupBy(F.col("card_type").alias("_value")).agg(
        F.count("*").alias("payments")
    )
    return _used(gold.dim_payment_method(spark), counts, "original_value")


def dim_payment_state(spark: SparkSession, d: str) -> DataFrame:
    """The states with the payments in each."""
    counts = _silver_payments(spark, d).groupBy(F.lower("payment_state").alias("_value")).agg(
        F.count("*").alias("payments")
    )
    return _used(gold.dim_payment_state(spark), counts, "payment_state_name")


def fact_transactions(spark: SparkSession, d: str) -> DataFrame:
    return _fact(spark, d).select(S.FACT_COLUMNS)


def _parts(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Stored silver tables and the merchant dimension."""
    return (
        _stored(_silver_link_tx(spark, d), "silver-link-tx"),
        _stored(_silver_payments(spark, d), "silver-payments"),
        _stored(_merchants(spark, d), "dim-merchants"),
    )


def fact_increment(spark: SparkSession, d: str) -> DataFrame:
    """A fact of the first days, brought up to date with a load of the following days.

    That load also repeats two early days: transactions of one and payments of the other are
    withdrawn, and states change.  Half of the merchants are delivered with it only.  The test
    orders spread over seven years, hence the coarser partitions.
    """
    transactions, payments, merchants = _parts(spark, d)
    root = fresh_path(spark, "increments")
    increments = FactIncrements(spark, root, f"{root}/fact", "month", buckets=8)
    none = [frame.where("false") for frame in (transactions, payments, merchants)]
    early = merchants.where("merchant_id % 2 = 0")
    first = [of_days(frame, X.FIRST_DAY, SPLIT_DAY) for frame in (transactions, payments)]
    increments.record((none[0], first[0]), (none[1], first[1].withColumn("payment_state", F.lit("initial"))), (none[2], early))
    increments.apply(early)

    day = F.to_date(F.lit(X.SECOND_DAY))
    reloaded = F.col(S.SNAPSHOT).isin(day, F.date_add(day, 1)) | _from_day(NEXT_DAY)
    second = [
        transactions.where(~((F.col(S.SNAPSHOT) == day) & (F.col("transaction_id") % 3 == 0))),
        payments.where(~((F.col(S.SNAPSHOT) == F.date_add(day, 1)) & (F.col("transaction_id") % 4 == 0))),
    ]
    known = [first[0], first[1].withColumn("payment_state", F.lit("initial"))]
    # Days that the load is not about keep the state they have.
    increments.record(
        (known[0].where(reloaded), second[0].where(reloaded)), (known[1].where(reloaded), second[1].where(reloaded)),
        (early, merchants),
    )
    increments.apply(merchants)
    return sink.read_fact(spark, f"{root}/fact").select(S.FACT_COLUMNS)


def fact_high_water_mark(spark: SparkSession, d: str) -> DataFrame:
    """The first days' fact and, appended, the following days' transactions that it does not hold.

    Some start before its newest transaction, and some of the first days' are offered again.
    """
    transactions, payments, merchants = _parts(spark, d)
    path = fresh_path(spark, "fact")
    first = of_days(transactions, X.FIRST_DAY, SPLIT_DAY)
    sink.write_fact(gold.fact_transactions(first, payments, merchants), path, "month")
    following = of_days(transactions, SPLIT_DAY, X.LAST_DAY)
    sink.append_newer_fact(gold.fact_transactions(following, payments, merchants), path, "month")
    return sink.read_fact(spark, path).select(S.FACT_COLUMNS)


def bucketed_match(spark: SparkSession, d: str) -> DataFrame:
    """Every payment of every transaction's reference, from tables bucketed by the reference."""
    transactions, payments, _ = _parts(spark, d)
    initiated = gold.payment_references(transactions).where("payment_reference IS NOT NULL")
    paid = payments.where("reference IS NOT NULL").select(
        "reference", F.col("transaction_id").alias("payment_id"), "payment_state", S.SNAPSHOT
    )
    left, right = (
        sink.write_bucketed(frame, f"{name}_{uuid.uuid4().hex}", fresh_path(spark, name), key, 16)
        for frame, name, key in (
            (initiated, "transactions_by_reference", "payment_reference"), (paid, "payments_by_reference", "reference"),
        )
    )
    joined = left.hint("merge").join(right, F.col("payment_reference") == F.col("reference"))
    return joined.select("transaction_id", "payment_reference", "payment_id", "payment_state", S.SNAPSHOT)


# ---- the stored lake --------------------------------------------------------


def _incoming(spark: SparkSession, d: str, spoiled: bool = False) -> str:
    """A folder with all daily files of the three entities."""
    folder = fresh_path(spark, "incoming")
    payments = X.bronze_payments(spark, d)
    for name, rows, columns in (
        ("payments", X.with_unusable_ids(payments) if spoiled else payments, S.PAYMENT_COLUMNS),
        ("link_transactions", X.bronze_link_transactions(spark, d), S.LINK_TX_COLUMNS),
        ("merchants", X.bronze_merchants(spark, d), S.MERCHANT_COLUMNS),
    ):
        _write_daily(rows, f"{folder}/{name}", name, columns)
    return folder


def lake_quarantine(spark: SparkSession, d: str) -> DataFrame:
    """Rows read, accepted and rejected per day by a run of the lake, as stored, and the reasons' counts."""
    folder = _incoming(spark, d, spoiled=True)
    lake = Lakehouse(spark, fresh_path(spark, "lake"), "file=", buckets=8)
    lake.load_bronze(folder, X.FIRST_DAY, X.LAST_DAY)
    lake.build_silver(X.FIRST_DAY, X.LAST_DAY)
    reasons = lake.rejected("payments").groupBy(S.SNAPSHOT).agg(
        F.count_if(F.col("_reason") == "missing id").alias("missing_ids"),
        F.count_if(F.col("_reason") == "id out of range").alias("ids_out_of_range"),
    )
    return lake.load_counts("payments").join(reasons, S.SNAPSHOT, "left")


def lake_full_load(spark: SparkSession, d: str) -> DataFrame:
    """Two runs with options: a lagged one, and one of another day that takes all that ever landed."""
    folder = _incoming(spark, d)
    lake = Lakehouse(spark, fresh_path(spark, "lake"), "file=", buckets=8)
    lake.run_day(folder, "2025-10-12", lag_days=10)
    lake.run_day(folder, "2025-10-12", override="20251005", full_load=True)
    days = lake.silver("link_transactions").groupBy("transaction_id").agg(F.max(S.SNAPSHOT).alias("latest_day"))
    return lake.fact().join(days, "transaction_id").select("transaction_id", "payment_reference", "hasPayment", "latest_day")


# ---- views ------------------------------------------------------------------


def _view(name: str) -> Query:
    def query(spark: SparkSession, d: str) -> DataFrame:
        merchants = _merchants(spark, d)
        return views.VIEWS[name](_fact(spark, d, merchants), merchants)

    return query


def views_for_role(spark: SparkSession, d: str) -> DataFrame:
    """Rows of every view a role sees; the views share one stored tally of the fact."""
    shared = _stored(views.tally(_fact(spark, d)), "tally")
    merchants = _stored(_merchants(spark, d), "dim-merchants")
    counts = [
        view.agg(F.count("*").alias("rows")).select(
            F.lit(role).alias("role"), F.lit(name).alias("view_name"), "rows"
        )
        for role in views.ROLES
        for name, view in views.views_for_role(role, shared, merchants).items()
    ]
    return reduce(DataFrame.unionByName, counts)


def completion_by_hour(spark: SparkSession, d: str) -> DataFrame:
    """Hours need a time of day, which only the events table has."""
    events = X.table(spark, d, "events")
    return views.completion_by_hour(events, "ts", "event_type = 'purchase'")


# ---- checks -----------------------------------------------------------------


def _stored_gold(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame, DataFrame]:
    """Stored silver payments, transactions and merchants, the dimension, and the fact built on them."""
    transactions, payments, dimension = _parts(spark, d)
    shops = _stored(_silver_merchants(spark, d), "silver-merchants")
    fact = _stored(gold.fact_transactions(transactions, payments, dimension), "fact")
    return payments, transactions, shops, dimension, fact


def dq_not_null(spark: SparkSession, d: str) -> DataFrame:
    payments, transactions, shops, dimension, fact = _stored_gold(spark, d)
    return reduce(DataFrame.unionByName, [
        quality.not_null(transactions, "link_transactions", ["transaction_id", "reference"]),
        quality.not_null(payments, "payments", ["transaction_id", "reference", "merchant_id", "card_type"]),
        quality.not_null(shops, "merchants", ["merchant_id", "merchant_name"]),
        quality.not_null(dimension, "dim_merchants", ["merchant_sk"]),
        quality.not_null(fact, "fact_transactions", ["sk", "transaction_id", "payment_reference", "merchant_sk"]),
    ])


def dq_unique(spark: SparkSession, d: str) -> DataFrame:
    """Declared keys, and some columns known to repeat: one scan and one shuffle per table."""
    payments, _, shops, dimension, fact = _stored_gold(spark, d)
    return reduce(DataFrame.unionByName, [
        quality.checks(X.bronze_link_transactions(spark, d), "raw_link_transactions", unique_keys=[["id"]]),
        quality.checks(X.bronze_payments(spark, d), "raw_payments", unique_keys=[["id"]]),
        quality.checks(payments, "payments", unique_keys=[silver.PAYMENT_KEY]),
        quality.checks(shops, "merchants", unique_keys=[silver.MERCHANT_KEY]),
        quality.checks(dimension, "dim_merchants", unique_keys=[["merchant_sk"], ["merchant_name"]]),
        quality.checks(fact, "fact_transactions", unique_keys=[["sk"], ["payment_method_sk"]]),
    ])


def dq_tables(spark: SparkSession, d: str) -> DataFrame:
    """All declared tests of a table together."""
    payments, transactions, shops, dimension, fact = _stored_gold(spark, d)
    return reduce(DataFrame.unionByName, [
        quality.checks(transactions, "link_transactions", ["transaction_id", "reference"], [silver.LINK_TX_KEY, ["reference"]]),
        quality.checks(payments, "payments", ["transaction_id", "card_type"], [silver.PAYMENT_KEY, ["reference"]]),
        quality.checks(shops, "merchants", ["merchant_id", "merchant_name"], [silver.MERCHANT_KEY]),
        quality.checks(dimension, "dim_merchants", ["merchant_sk"], [["merchant_sk"], ["merchant_name"]]),
        quality.checks(fact, "fact_transactions", ["sk", "payment_reference"], [["sk"], ["payment_reference", "payment_state"]]),
    ])


def dq_timestamp_order(spark: SparkSession, d: str) -> DataFrame:
    return reduce(DataFrame.unionByName, [
        quality.timestamp_order(rows, name, "created_at", "updated_at")
        for name, rows in (
            ("link_transactions", _silver_link_tx(spark, d)),
            ("payments", _silver_payments(spark, d)),
            ("merchants", _silver_merchants(spark, d)),
        )
    ])


def registered() -> dict[str, Query]:
    entries: dict[str, Query] = {
        # sources
        "scan_csv_strings": scan_csv_strings,
        "scan_daily_files": scan_daily_files,
        "scan_missing_day": scan_missing_day,
        "bronze_link_tx_day": bronze_link_tx_day,
        "bronze_link_tx_full": bronze_link_tx_full,
        "extract_link_tx": extract_link_tx,
        "extract_merchants": extract_merchants,
        "extract_payments": extract_payments,
        "ingest_available_now": ingest_available_now,
        # silver
        "silver_link_tx": _silver_link_tx,
        "silver_payments": _silver_payments,
        "silver_payments_day": silver_payments_day,
        "silver_merchants": _silver_merchants,
        "silver_merchants_empty": silver_merchants_empty,
        "quarantine_bad_ids": quarantine_bad_ids,
        # sinks and increments
        "sink_partition_replace": sink_partition_replace,
        "sink_partition_emptied": sink_partition_emptied,
        "sink_replace_by_file": sink_replace_by_file,
        "sink_file_on_other_days": sink_file_on_other_days,
        "schema_drift_union": schema_drift_union,
        "silver_insert_missing": silver_insert_missing,
        "silver_upsert": silver_upsert,
        "backfill_range": backfill_range,
        "fact_increment": fact_increment,
        "fact_high_water_mark": fact_high_water_mark,
        "bucketed_match": bucketed_match,
        "lake_quarantine": lake_quarantine,
        "lake_full_load": lake_full_load,
        # gold
        "dim_date": dim_date,
        "dim_payment_method": dim_payment_method,
        "dim_payment_state": dim_payment_state,
        "dim_merchants": _merchants,
        "payment_reference": lambda spark, d: gold.payment_references(_silver_link_tx(spark, d)),
        "payment_final": lambda spark, d: gold.payment_final(_silver_payments(spark, d)),
        "fact_transactions": fact_transactions,
        # questions beyond the views
        "match_rate_kpi": lambda spark, d: views.match_rate_kpi(_fact(spark, d)),
        "outcome_by_method": lambda spark, d: views.outcome_by_method(_fact(spark, d)),
        "failure_rate_by_payment_method_filtered":
            lambda spark, d: views.failure_rate_by_payment_method_filtered(_fact(spark, d)),
        "method_switches": lambda spark, d: views.method_switches(_silver_payments(spark, d)),
        "completion_by_weekday": lambda spark, d: views.completion_by_weekday(_fact(spark, d)),
        "completion_by_hour": completion_by_hour,
        "views_for_role": views_for_role,
        # checks
        "dq_not_null": dq_not_null,
        "dq_unique": dq_unique,
        "dq_tables": dq_tables,
        "dq_timestamp_order": dq_timestamp_order,
    }
    entries |= {name: _view(name) for name in views.VIEWS}
    return {name: _configured(query) for name, query in entries.items()}


def _configured(query: Query) -> Query:
    """The session is set up before the first expression of the query is built."""
    return lambda spark, d: query(configure(spark), d)
