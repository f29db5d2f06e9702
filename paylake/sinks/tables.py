"""Table writers.

A load replaces whole partitions: Spark stages the new files and puts them in
place when all tasks have succeeded, so lost executors and retried tasks leave
no trace, and loading the same day twice gives the same table.  Other days are
not touched.

Typed rows are arranged by ``rebalance`` before they are written: files of one
size, few for small days and many for large ones, and no task ever writes a whole
day.  Files are sorted by key, which makes Parquet's min/max statistics selective.
Raw rows come from files of one day each and are written as they were split.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paylake import schemas as S
from paylake.operators.merge import empty, only_missing, upserted
from paylake.session import fresh_path
from paylake.sources.tables import read_drifted, read_table, table_exists

# Stored tables are read more often than written: the smaller codec.
PACKED = {"compression": "zstd"}
# Raw rows are texts most of which differ: dictionaries are built and then given up.
RAW = {**PACKED, "parquet.enable.dictionary": "false"}
# The one partition of a table that is always written as a whole.
VERSION = "_version"


def _arranged(frame: DataFrame, partition: str, sort_by: list[str]) -> DataFrame:
    return frame.hint("rebalance", F.col(partition)).sortWithinPartitions(partition, *sort_by)


def replace_partitions(
    frame: DataFrame,
    path: str,
    sort_by: list[str] | None = None,
    partition: str = S.SNAPSHOT,
    loaded: Iterable | None = None,
) -> None:
    """Replace the partitions ``frame`` has rows for, keep all others.

    ``loaded`` are the partition values that this load is about: those that ``frame`` has
    no rows for are emptied.  Without ``sort_by`` the rows are written as they are
    partitioned: no shuffle.
    """
    rows = _arranged(frame, partition, sort_by) if sort_by else frame
    folders = [f"{path}/{partition}={_partition_text(value)}" for value in loaded or ()]
    before = {folder: _file_names(frame.sparkSession, folder) for folder in folders}
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").options(**(PACKED if sort_by else RAW))
        .partitionBy(partition)
        .parquet(path)
    )
    # A replaced partition has new files; one that still has its old ones got no rows.
    contract = T.StructType([field for field in frame.schema.fields if field.name != partition])
    for folder, names in before.items():
        if names and _file_names(frame.sparkSession, folder) == names:
            empty(frame.sparkSession, contract).write.mode("overwrite").parquet(folder)


def _file_names(spark: SparkSession, folder: str) -> set[str]:
    """The names of the files in a folder; none if it does not exist."""
    path = _hadoop_path(spark, folder)
    store = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return {f.getPath().getName() for f in store.listStatus(path)} if store.exists(path) else set()


# Which source file has rows on which days of a table; beside the table.
FILE_INDEX = "-files"
FILE_DAYS = T.StructType([T.StructField(S.SOURCE_FILE, T.StringType()), T.StructField(S.SNAPSHOT, T.DateType())])


def replace_source_files(
    frame: DataFrame, path: str, contract: T.StructType, files: Iterable[str] | None = None
) -> None:
    """Replace the rows of the source files ``frame`` has rows of, on whatever days they are.

    Name the ``files`` if one of them may have no rows any more.  The days a file ever wrote are
    kept in a small table, which is made from the table's files the first time; only those days
    are read and rewritten, the rows of other files with them.
    """
    spark = frame.sparkSession
    known = _days_of_files(spark, path, contract)
    brought = frame.select(FILE_DAYS.fieldNames()).distinct()
    names = brought.select(S.SOURCE_FILE).distinct()
    if files is not None:
        names = names.unionByName(spark.createDataFrame([(f,) for f in files], T.StructType(FILE_DAYS.fields[:1]))).distinct()
    before = known.join(names, S.SOURCE_FILE, "left_semi").select(S.SNAPSHOT)
    days = set(_partition_values(before.unionByName(brought.select(S.SNAPSHOT)), S.SNAPSHOT))
    stored = read_drifted(spark, path, contract)
    kept = stored.where(_is_one_of(S.SNAPSHOT, days)).join(names, S.SOURCE_FILE, "left_anti").select(stored.columns)
    # First what is new to the index: a file listed with too many days does no harm.
    only_missing(brought, known, FILE_DAYS.fieldNames()).write.mode("append").parquet(path + FILE_INDEX)
    replace_partitions(kept.unionByName(frame, allowMissingColumns=True), path, loaded=days)


def _days_of_files(spark: SparkSession, path: str, contract: T.StructType) -> DataFrame:
    if not table_exists(spark, path + FILE_INDEX):
        found = read_table(spark, path, contract).select(FILE_DAYS.fieldNames()).distinct()
        swapped(found, path + FILE_INDEX)
    return spark.read.schema(FILE_DAYS).parquet(path + FILE_INDEX)


def ensure_table(spark: SparkSession, path: str, contract: T.StructType, partition: str = S.SNAPSHOT) -> None:
    """Create an empty table unless there is one."""
    if not table_exists(spark, path):
        empty(spark, contract).write.partitionBy(partition).parquet(path)


def _stored_days(
    frame: DataFrame, path: str, contract: T.StructType, days: Iterable[dt.date] | None
) -> DataFrame:
    """The table's rows on ``days``, or on the days of ``frame`` if they are not given."""
    known = _partition_values(frame, S.SNAPSHOT) if days is None else list(days)
    return read_table(frame.sparkSession, path, contract).where(_is_one_of(S.SNAPSHOT, known))


def append_missing(
    frame: DataFrame,
    path: str,
    contract: T.StructType,
    keys: list[str],
    days: Iterable[dt.date] | None = None,
) -> None:
    """Append the rows whose key the table does not hold yet.

    ``keys`` contain the snapshot day, so only the days of ``frame`` are read.
    Give them as ``days`` if they are known: finding them computes ``frame`` once
    more.
    """
    stored = _stored_days(frame, path, contract, days)
    missing = only_missing(frame, stored, keys).select(contract.fieldNames())
    _arranged(missing, S.SNAPSHOT, keys).write.mode("append").options(**PACKED).partitionBy(S.SNAPSHOT).parquet(path)


def upsert_days(
    frame: DataFrame,
    path: str,
    contract: T.StructType,
    keys: list[str],
    days: Iterable[dt.date] | None = None,
) -> None:
    """Put ``frame`` in, the last write per key wins; rewrites only its days.

    All of ``days`` must have rows in ``frame`` or in the table, see
    :func:`append_missing`.
    """
    stored = _stored_days(frame, path, contract, days)
    replace_partitions(upserted(stored, frame.select(contract.fieldNames()), keys), path, keys)


def rebuild(frame: DataFrame, path: str) -> None:
    """Write a small table anew, e.g. a dimension.

    The table is a single partition: like any partition it is built aside and
    swapped in when complete, so a failed build leaves the old table in place.
    """
    rows = frame.selectExpr("*", f"'current' AS {VERSION}")
    replace_partitions(rows, path, partition=VERSION, loaded=["current"])


def create_or_replace(frame: DataFrame, target: str) -> None:
    """Write a lake extract anew.

    ``target`` is a folder, or ``catalog.database.table`` of a configured Iceberg
    catalog, which then swaps the table in one step.
    """
    if "/" in target:
        swapped(frame, target)
    else:
        (
            frame.writeTo(target).using("iceberg")
            .tableProperty("format-version", "2").createOrReplace()
        )


def swapped(frame: DataFrame, path: str, partition: str | None = None) -> None:
    """Write a folder anew, aside, and put it in place when it is complete.

    A write that fails leaves the former version readable.  Where a store cannot replace a
    folder in one step, the former version is moved away first; if that is as far as it got,
    the next write moves it back.
    """
    spark = frame.sparkSession
    target, aside, former = (_hadoop_path(spark, path.rstrip("/") + end) for end in ("", "-new", "-former"))
    store = target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if store.exists(former):
        if store.exists(target):
            store.delete(former, True)
        else:
            _renamed(store, former, target)
    writer = frame.write.mode("overwrite").options(**PACKED)
    (writer.partitionBy(partition) if partition else writer).parquet(aside.toString())
    if store.exists(target):
        _renamed(store, target, former)
    _renamed(store, aside, target)
    store.delete(former, True)


def _hadoop_path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _renamed(store, source, target) -> None:
    if not store.rename(source, target):
        raise OSError(f"{source.toString()} could not be renamed to {target.toString()}")


def write_bucketed(frame: DataFrame, name: str, path: str, key: str, buckets: int) -> DataFrame:
    """A table of the session catalog whose rows are dealt into buckets by ``key``, sorted within.

    Two tables with as many buckets join on their keys without a shuffle.  Rows without a key
    match nothing and would all be in one bucket: leave them out.
    """
    (
        frame.repartition(buckets, key).write.format("parquet").mode("overwrite").options(**PACKED)
        .bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name)
    )
    return frame.sparkSession.table(name)


# ---- fact -------------------------------------------------------------------

FACT_STORED = T.StructType([*S.FACT_TRANSACTIONS.fields, T.StructField(S.START_PERIOD, T.DateType())])


def _with_period(fact: DataFrame, grain: str) -> DataFrame:
    """The fact's partition column: the day, or the first day of the month or week,
    a payment was started."""
    day = F.to_date(S.GATING_TS)
    return fact.withColumn(S.START_PERIOD, day if grain == "day" else F.trunc(day, grain))


def write_fact(fact: DataFrame, path: str, grain: str = "day") -> None:
    """The whole fact, partitioned by the period a payment was started in."""
    rows = _arranged(_with_period(fact, grain), S.START_PERIOD, ["sk"])
    swapped(rows, path, S.START_PERIOD)


def read_fact(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, S.FACT_TRANSACTIONS)


def upsert_fact(changes: DataFrame, path: str, grain: str = "day") -> None:
    """Insert or replace the rows of ``changes`` by transaction.

    Only periods that lose or gain a row are rewritten.  ``changes`` usually
    derives from the table itself and is used several times, so it is first
    written to the shared folder.
    """
    spark = changes.sparkSession
    staged_path = fresh_path(spark, "fact-changes")
    _with_period(changes, grain).write.options(**PACKED).parquet(staged_path)
    staged = spark.read.schema(FACT_STORED).parquet(staged_path)

    stored = read_table(spark, path, FACT_STORED)
    # Where a transaction was until now, if that is not where it is going.
    moved = (
        stored.select("transaction_id", F.col(S.START_PERIOD).alias("_from"))
        .join(staged.select("transaction_id", F.col(S.START_PERIOD).alias("_to")), "transaction_id")
        .where(~F.col("_from").eqNullSafe(F.col("_to")))
    )
    left = _partition_values(moved, "_from")
    touched = set(left) | set(_partition_values(staged, S.START_PERIOD))
    in_touched = _is_one_of(S.START_PERIOD, touched)
    result = upserted(stored.where(in_touched), staged, ["transaction_id"])
    remaining = left
    if left:
        kept = result.where(_is_one_of(S.START_PERIOD, left))
        remaining = _partition_values(kept, S.START_PERIOD)
    replace_partitions(result, path, ["sk"], S.START_PERIOD)
    # A period all rows have moved away from got no new files and is as it was.
    for period in set(left) - set(remaining):
        folder = f"{path}/{S.START_PERIOD}={_partition_text(period)}"
        empty(spark, S.FACT_TRANSACTIONS).write.mode("overwrite").parquet(folder)


def change_fact(
    rows: DataFrame, gone: DataFrame, starts: DataFrame, path: str, grain: str = "day"
) -> None:
    """Insert or replace ``rows`` by transaction, delete the transactions ``gone``.

    ``starts`` are the start times that changed transactions had until now, so only the periods
    that lose or gain a row are read and rewritten.
    """
    spark = rows.sparkSession
    staged_path = fresh_path(spark, "fact-changes")
    _with_period(rows, grain).write.options(**PACKED).parquet(staged_path)
    staged = spark.read.schema(FACT_STORED).parquet(staged_path)
    left = _with_period(starts.withColumnRenamed(starts.columns[0], S.GATING_TS), grain)
    # One value per period.
    touched = set(_partition_values(staged, S.START_PERIOD)) | set(_partition_values(left, S.START_PERIOD))
    if not touched:
        return
    out = staged.select("transaction_id").unionByName(gone.select("transaction_id"))
    stored = read_table(spark, path, FACT_STORED).where(_is_one_of(S.START_PERIOD, touched))
    result = only_missing(stored, out, ["transaction_id"]).unionByName(staged)
    replace_partitions(result, path, ["sk"], S.START_PERIOD, touched)


def append_newer_fact(rows: DataFrame, path: str, grain: str = "day") -> None:
    """The high-water load: appends the rows of transactions the fact does not hold yet.

    Rows that start after the newest period of the fact are new.  Late ones, and those without
    a start, are looked up in the periods they would belong to: which these are is known only
    when the load runs, and prunes the fact's partitions then.
    """
    spark = rows.sparkSession
    staged_path = fresh_path(spark, "fact-load")
    _with_period(rows, grain).write.options(**PACKED).parquet(staged_path)
    staged = spark.read.schema(FACT_STORED).parquet(staged_path)
    fact = read_table(spark, path, FACT_STORED)
    mark = fact.agg(F.max(S.START_PERIOD).alias("mark")).selectExpr("coalesce(mark, date '1970-01-01')")
    newer = staged.where(F.col(S.START_PERIOD) > mark.scalar())
    late = staged.where(F.col(S.START_PERIOD).isNull() | (F.col(S.START_PERIOD) <= mark.scalar()))
    known = same_periods(fact, late).select("transaction_id")
    missing = newer.unionByName(only_missing(late, known, ["transaction_id"])).select(FACT_STORED.fieldNames())
    _arranged(missing, S.START_PERIOD, ["sk"]).write.mode("append").options(**PACKED).partitionBy(S.START_PERIOD).parquet(path)


def same_periods(fact: DataFrame, late: DataFrame) -> DataFrame:
    """The fact's rows in periods that ``late`` has rows in; other partitions are not read.

    The periods are a small stored table, at most one row each, so Spark can broadcast it and
    use it as a filter on the partitions.
    """
    spark = late.sparkSession
    path = fresh_path(spark, "periods")
    counts = late.groupBy(S.START_PERIOD).agg(F.count("*").alias("_rows"))
    counts.coalesce(1).write.parquet(path)
    # Spark prunes by a side that is filtered by a comparison.
    periods = spark.read.schema(counts.schema).parquet(path).where(F.col("_rows") > 0).select(S.START_PERIOD)
    dated = fact.join(periods.where(F.col(S.START_PERIOD).isNotNull()), S.START_PERIOD, "left_semi")
    undated = fact.where(F.col(S.START_PERIOD).isNull()).join(
        periods.where(F.col(S.START_PERIOD).isNull()).select(F.lit(1).alias("_any")), how="left_semi"
    )
    return dated.select(fact.columns).unionByName(undated.select(fact.columns))


def drop_partitions(spark: SparkSession, path: str, names: Iterable[str]) -> None:
    """Removes whole partitions (``column=value``) of a table."""
    for name in names:
        folder = _hadoop_path(spark, f"{path}/{name}")
        folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)


def _is_one_of(column: str, values) -> Column:
    """Also true for a NULL in the column if NULL is among ``values``."""
    known = F.coalesce(F.col(column).isin([v for v in values if v is not None]), F.lit(False))
    return known | F.col(column).isNull() if None in values else known


def _partition_text(period) -> str:
    return "__HIVE_DEFAULT_PARTITION__" if period is None else str(period)


def _partition_values(frame: DataFrame, column: str) -> list:
    """The distinct days or periods in ``frame``, however many rows each has."""
    return [row[0] for row in frame.select(column).distinct().collect()]
