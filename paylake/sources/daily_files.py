"""Daily snapshot files ``<prefix>-YYYYMMDD.csv``, read as text columns only.

Many days are one scan.  A day may be a single file or a folder of part files.
Files with the same header are read together; headers may differ between days,
columns a file lacks are NULL in its rows.  Days without a file, and empty files,
simply contribute no rows.
"""

from __future__ import annotations

import datetime as dt
import re
from collections import defaultdict
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paylake import schemas as S
from paylake.functions import blank_to_null
from paylake.operators.merge import empty, union_drifting
from paylake.sources.tables import is_missing_path

# A header is one small read of the start of a file; several are read at a time.
HEADERS_AT_ONCE = 8
DAY_FORMAT = "%Y%m%d"
DAY_IN_PATH = r"-(\d{8})\.csv(?:/[^/]*)?$"
# How the name of a day's file or folder ends, and how long that is.
DAY_END, DAY_END_LENGTH = r"^-\d{8}\.csv$", 13


@dataclass(frozen=True)
class DailyFiles:
    """Where the files of one entity lie."""

    folder: str
    prefix: str

    def path(self, day: dt.date) -> str:
        return f"{self.folder.rstrip('/')}/{self.prefix}-{day.strftime(DAY_FORMAT)}.csv"


def snapshot_day(run_day: str | dt.date, lag_days: int = 0, override: str | None = None) -> dt.date:
    """The day whose file a run loads: ``override`` (YYYYMMDD) or the run day less a lag."""
    if override:
        return dt.datetime.strptime(override, DAY_FORMAT).date()
    return as_day(run_day) - dt.timedelta(days=lag_days)


def as_day(day: str | dt.date) -> dt.date:
    return day if isinstance(day, dt.date) else dt.date.fromisoformat(day)


def day_range(first: str | dt.date, last: str | dt.date) -> list[dt.date]:
    start, end = as_day(first), as_day(last)
    return [start + dt.timedelta(days=n) for n in range((end - start).days + 1)]


def days_present(spark: SparkSession, files: DailyFiles, days: list[dt.date]) -> list[dt.date]:
    """Those of ``days`` for which a non-empty file exists.

    The folder is listed by Spark; file contents are not read.
    """
    try:
        listing = spark.read.format("binaryFile").load(
            f"{files.folder.rstrip('/')}/{files.prefix}-*.csv"
        )
        found = (
            listing.where(F.col("length") > 0)
            .select(F.regexp_extract("path", DAY_IN_PATH, 1).alias("day"))
            .distinct().collect()  # one row per day
        )
    except AnalysisException as error:
        if not is_missing_path(error):
            raise
        return []
    texts = {row.day for row in found}
    return [day for day in days if day.strftime(DAY_FORMAT) in texts]


def _lineage(rows: DataFrame) -> DataFrame:
    """The rows with lineage in place of the path.

    Searching a whole path by a pattern costs several times what reading the row does: here only
    the end of the folder's name is looked at.  The day's name is the folder's, or else the file's.
    """
    columns = [f"`{name}`" for name in rows.columns if name != "_path"]
    folder = "substring_index(substring_index(_path, '/', -2), '/', 1)"
    named = rows.selectExpr(
        *columns,
        f"CASE WHEN right({folder}, {DAY_END_LENGTH}) RLIKE r'{DAY_END}' THEN {folder} "
        f"ELSE substring_index(_path, '/', -1) END AS _day_file",
    )
    year, month, day = (f"cast(substr(_day_file, {at}, {size}) AS int)" for at, size in ((-12, 4), (-8, 2), (-6, 2)))
    return named.selectExpr(
        *columns,
        f"current_timestamp() AS {S.INGESTED}",
        f"substring_index(_day_file, '=', -1) AS {S.SOURCE_FILE}",
        f"make_date({year}, {month}, {day}) AS {S.SNAPSHOT}",
    )


def days_with_open_quotes(spark: SparkSession, paths: list[str]) -> set[str]:
    """Days (YYYYMMDD) that have a file with a quoted line break: a line with an odd number of quotes."""
    quotes = F.octet_length("value") - F.octet_length(F.replace("value", F.lit('"'), F.lit("")))
    found = (
        spark.read.text(paths).where(quotes % 2 == 1)
        .select(F.regexp_extract("_metadata.file_path", DAY_IN_PATH, 1).alias("day"))
        .distinct().collect()  # one row per day
    )
    return {row.day for row in found}


def read_text_columns(spark: SparkSession, paths: list[str], columns: list[str]) -> DataFrame:
    """All ``columns`` as text, plus the file path; empty fields are NULL, ``NA`` stays text.

    Files are read in splits.  A quoted line break makes a file unsplittable: the files of
    such a day are read whole, one task each, so large days have to come as part files.
    """
    schema = T.StructType([T.StructField(name, T.StringType()) for name in columns])
    broken = days_with_open_quotes(spark, paths)
    parts = []
    for multiline in (False, True):
        chosen = [path for path in paths if (re.search(DAY_IN_PATH, path).group(1) in broken) == multiline]
        if chosen:
            reader = spark.read.schema(schema).option("header", True).option("escape", '"')
            if multiline:
                # Only LF ends a line: a CR inside quotes is text.
                reader = reader.option("multiLine", True).option("lineSep", "\n")
            else:
                reader = reader.option("enforceSchema", False)
            parts.append(reader.csv(chosen).select("*", F.col("_metadata.file_path").alias("_path")))
    rows = union_drifting(parts)
    # A CR before the end of a line belongs to the line end.
    texts = [f"`{c}`" for c in columns[:-1]] + [f"rtrim('\r', `{columns[-1]}`)"]
    return rows.selectExpr(*[f"{blank_to_null(t)} AS `{c}`" for c, t in zip(columns, texts)], "_path")


def read_days(
    spark: SparkSession,
    files: DailyFiles,
    first: str | dt.date,
    last: str | dt.date | None = None,
    contract: T.StructType | None = None,
) -> DataFrame:
    """Rows of the days ``first`` to ``last`` with lineage columns.

    Columns of ``contract`` always exist, unknown columns follow as text.
    """
    days = days_present(spark, files, day_range(first, last or first))
    by_header: dict[tuple[str, ...], list[str]] = defaultdict(list)
    paths = [files.path(day) for day in days]
    with ThreadPoolExecutor(HEADERS_AT_ONCE) as pool:
        headers = pool.map(lambda path: spark.read.option("header", True).csv(path).columns, paths)
    for path, header in zip(paths, headers):
        if header:
            by_header[tuple(header)].append(path)
    parts = [
        _lineage(read_text_columns(spark, paths, list(header)))
        for header, paths in by_header.items()
    ]
    if contract is None:
        if not parts:
            return empty(spark, T.StructType(S.LINEAGE))
        return union_drifting(parts)
    parts.insert(0, empty(spark, contract))
    rows = union_drifting(parts)
    extra = [name for name in rows.columns if name not in contract.fieldNames()]
    return rows.select(*contract.fieldNames(), *[f"`{name}`" for name in extra])
