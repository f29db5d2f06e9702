"""Files that arrived since the last run, loaded with exactly-once effect.

The stream only watches the folder: it reads names, not contents.  Each batch
reloads the days it saw completely and replaces their partitions, so a day that
arrives in several parts ends up right, and a batch that is repeated after a
failure changes nothing.  A stream knows a file by its path alone; a file that was
written again is noticed by its time or length, kept in a table beside the checkpoint.
"""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paylake.session import fresh_path
from paylake.sinks.tables import replace_partitions, swapped
from paylake.sources.daily_files import DAY_FORMAT, DAY_IN_PATH, DailyFiles, day_range, read_days
from paylake.sources.tables import table_exists

LISTING = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("modificationTime", T.TimestampType()),
    T.StructField("length", T.LongType()),
    T.StructField("content", T.BinaryType()),
])


def ingest_available(
    spark: SparkSession,
    files: DailyFiles,
    table: str,
    contract: T.StructType,
    checkpoint: str,
    max_files: int = 1000,
) -> None:
    """Load every file not yet seen by ``checkpoint``, then stop."""
    arrivals = (
        spark.readStream.format("binaryFile").schema(LISTING)
        .option("maxFilesPerTrigger", max_files)
        .load(f"{files.folder.rstrip('/')}/{files.prefix}-*.csv")
        .select(F.regexp_extract("path", DAY_IN_PATH, 1).alias("day"))
    )

    def load(batch: DataFrame, batch_id: int) -> None:
        names = batch.distinct().collect()  # one row per day
        for first, last in _runs([dt.datetime.strptime(row.day, DAY_FORMAT).date() for row in names]):
            rows = read_days(spark, files, first, last, contract)
            replace_partitions(rows, table, loaded=day_range(first, last))

    # Listed before anything is read: what changes from now on differs from the list.
    listed = _listing(spark, files)
    known = f"{checkpoint.rstrip('/')}-files"
    if table_exists(spark, known):
        # Older times count, too: a file may be replaced by an earlier version of itself.
        seen = spark.read.schema(listed.schema).parquet(known).selectExpr(
            "path", "modificationTime AS _time", "length AS _length"
        )
        again = listed.join(seen, "path").where("modificationTime <> _time OR length <> _length")
        load(again.select(F.regexp_extract("path", DAY_IN_PATH, 1).alias("day")), -1)

    query = (
        arrivals.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    # One row per file, however many runs there were.
    swapped(listed, known)


def _listing(spark: SparkSession, files: DailyFiles) -> DataFrame:
    """Path, time and length of the files there are now, as a table of its own."""
    path = fresh_path(spark, "listing")
    try:
        found = spark.read.format("binaryFile").schema(LISTING).load(f"{files.folder.rstrip('/')}/{files.prefix}-*.csv")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        found = spark.createDataFrame([], LISTING)
    found.select("path", "modificationTime", "length").write.parquet(path)
    return spark.read.schema("path string, modificationTime timestamp, length long").parquet(path)


def _runs(days: list[dt.date]) -> list[tuple[dt.date, dt.date]]:
    """Consecutive days as (first, last) ranges."""
    ranges: list[tuple[dt.date, dt.date]] = []
    for day in sorted(days):
        if ranges and day - ranges[-1][1] == dt.timedelta(days=1):
            ranges[-1] = (ranges[-1][0], day)
        else:
            ranges.append((day, day))
    return ranges
