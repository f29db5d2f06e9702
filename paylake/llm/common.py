"""Helpers that several operators share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paylake.session import fresh_path

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Words as the similarity contracts count them: runs without blanks.
BLANK_WORD = r"[^\x20\x09-\x0D]+"


# Copies of one row that are put out by one task at a time.
COPIES_AT_ONCE = 4096


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all other letters as they are."""
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


# Paths that the innermost ``scratch`` block deletes when it ends.
_scratch: list[list[str]] = []


def stored(frame: DataFrame, name: str) -> DataFrame:
    """``frame`` written to the shared folder and read back: its lineage ends here."""
    path = fresh_path(frame.sparkSession, name)
    if _scratch:
        _scratch[-1].append(path)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Deletes, at its end, what was stored within.

    Results have to be stored by :func:`kept`, so that nothing needs the deleted files any more.
    """
    _scratch.append([])
    try:
        yield
    finally:
        for path in _scratch.pop():
            _delete(spark, path)


def kept(frame: DataFrame, name: str) -> DataFrame:
    """Like ``stored``, but outliving the innermost ``scratch`` block: it belongs to the one around, if any."""
    inner = _scratch.pop() if _scratch else None
    try:
        return stored(frame, name)
    finally:
        if inner is not None:
            _scratch.append(inner)


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def with_running_sums(frame: DataFrame, order: list[Column], sums: dict[str, str]) -> DataFrame:
    """``frame`` with, per entry of ``sums`` (new name: column), the sum over all rows before in ``order``.

    Rows are dealt by range and summed up per partition; only one row per partition meets in one
    task.  ``order`` has to tell all rows apart.
    """
    line, part = unused("line", frame.columns, sums), unused("part", frame.columns, sums)
    dealt = stored(
        frame.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(line, F.monotonically_increasing_id()),
        "ordered",
    ).withColumn(part, F.shiftright(line, 33))
    before = Window.partitionBy(part).orderBy(line).rowsBetween(Window.unboundedPreceding, -1)
    parts = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    totals = dealt.groupBy(part).agg(*[F.sum(column).alias(name) for name, column in sums.items()])
    offsets = totals.select(F.col(part).alias("_" + part), *[F.sum(name).over(parts).alias("_" + name) for name in sums])
    inside = dealt.select("*", *[F.sum(column).over(before).alias(name) for name, column in sums.items()])
    zero = F.lit(0)
    return inside.join(offsets, F.col(part) == F.col("_" + part)).select(
        *frame.columns,
        *[(F.coalesce(F.col(name), zero) + F.coalesce(F.col("_" + name), zero)).alias(name) for name in sums],
    )


def each_copy(rows: DataFrame, copies: str, number: str) -> DataFrame:
    """Every row as often as its column ``copies`` says, with the ``number`` of the copy from 0.

    A row of very many copies is put out by many tasks.
    """
    some = rows.where(F.col(copies) <= COPIES_AT_ONCE).withColumn(
        number, F.explode(F.sequence(F.lit(0).cast("long"), F.col(copies) - 1))
    )
    step = F.lit(COPIES_AT_ONCE).cast("long")
    many = (
        rows.where(F.col(copies) > COPIES_AT_ONCE)
        .withColumn("_from", F.explode(F.sequence(F.lit(0).cast("long"), F.col(copies) - 1, step)))
        .repartition("_from")
        .withColumn(number, F.explode(F.sequence("_from", F.least(F.col("_from") + step, F.col(copies)) - 1)))
        .drop("_from")
    )
    return some.unionByName(many)


def discard(frame: DataFrame) -> None:
    """Deletes the files of a stored frame that nothing reads any more."""
    for folder in {file.rsplit("/", 1)[0] for file in frame.inputFiles()[:1]}:
        _delete(frame.sparkSession, folder)


def unused(name: str, *taken: Iterable[str]) -> str:
    """``name``, with underscores in front until no given column has it in any case."""
    names = {c.lower() for columns in taken for c in columns}
    while name.lower() in names:
        name = "_" + name
    return name


def row_key(id_column: str = "doc_id", text: str = "text") -> Column:
    """What tells documents apart: the id and a hash of the text.

    Rows alike in both are one document, given twice; a NULL id is an id of its own.
    """
    return F.struct(F.col(id_column).alias("id"), F.xxhash64(F.col(text)).alias("text"))
