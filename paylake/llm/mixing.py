"""Mixing sources to target weights by a low-discrepancy schedule of equal blocks.

Each source's documents are shuffled by a hash and laid end to end; the stream is cut
evenly into blocks of about equally many words.  Slot n of the schedule belongs to the source
in whose interval of cumulative weights the n-th point of a golden-ratio sequence
lies, so every stretch of the schedule holds the sources in their proportions.  The
j-th slot of a source takes its j-th block and starts over after the last one, until its
target is reached: the last slot takes the part of its block that is still due.  A source whose
interval got fewer slots than that, most of all a very small one, gets the rest at the end.
So each source comes within a word of its target.

All running sums have two levels (within a bucket, then over the buckets), so a
source with most of the rows is spread over many tasks; rows that are alike are summed up as
one, and rows without an id are told apart by their texts.

Defined cases: NULL or empty texts have size 0 and are never taken; repeated rows
are separate documents; NULL is a source of its own, the last one; an empty table
gives no rows; columns other than ``doc_id``, ``text`` and ``source`` are ignored.
"""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paylake.llm.common import BLANK_WORD, each_copy, kept, scratch, stored, with_running_sums

BLOCK_WORDS = 64
MOST_REPEATS = 3
CYCLE_OF_WEIGHTS = (1, 2, 3)

# The golden-ratio sequence in whole numbers: multiples of GOLDEN modulo POINTS.
POINTS = 1 << 31
GOLDEN = 1327217885
# A point finds its source by the cell it lies in; POINTS / CELLS points per cell.
CELL = POINTS // 1024

# A source's stream is summed up in this many buckets of the 48-bit shuffle order.
BUCKET = (1 << 48) // 8192
# Slots whose ranks are counted together, at least.
SHORTEST_RUN = 4096


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(BLANK_WORD)), F.lit(0)).cast("long")


def source_targets(sized: DataFrame) -> DataFrame:
    """One row per source: its number in order, weight, size, target, and the total size.

    With sources ordered by cap / weight, a source that is the first not cut would get
    its weight times (total - caps before it) / (weights from it on).  The largest of
    these levels is the one at which nothing is left over.
    """
    weights = F.array(*[F.lit(w).cast("long") for w in CYCLE_OF_WEIGHTS])
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.lit(1).cast("long").alias("_one"))
    weighed = (
        with_running_sums(sources, [F.col("source").asc_nulls_last()], {"number": "_one"})
        .withColumn("weight", F.get(weights, F.col("number") % len(CYCLE_OF_WEIGHTS)))
        .withColumn("cap", F.col("source_size") * MOST_REPEATS)
        .drop("_one")
    )
    summed = stored(
        with_running_sums(
            weighed, [F.col("cap") / F.col("weight"), F.col("number")], {"caps_before": "cap", "weights_before": "weight"}
        ),
        "levels",
    )
    whole = summed.agg(F.sum("source_size").alias("total"), F.sum("weight").alias("weights"))
    total, all_weights = whole.first()  # two numbers
    still_open = F.lit(all_weights or 0) - F.col("weights_before")
    level = summed.agg(F.max((F.lit(total or 0) - F.col("caps_before")) / still_open)).first()[0]
    target = F.least(F.lit(level or 0.0) * F.col("weight"), F.col("cap").cast("double"))
    return summed.select(
        "source", "number", "weight", "source_size", target.alias("target"), F.lit(total or 0).cast("long").alias("total")
    )


def schedule(targets: DataFrame, block: int) -> DataFrame:
    """The slots: ``slot``, the number of its source, and its ``rank`` among that source's."""
    summed = stored(with_running_sums(targets, [F.col("number")], {"before": "target"}), "bounds")
    total, of_targets = summed.agg(F.max("total"), F.sum("target")).first()  # two numbers
    point = lambda column: F.round(column / F.lit(of_targets or 1.0) * POINTS).cast("long")
    bounds = (
        summed.select("number", point(F.col("before")).alias("low"), point(F.col("before") + F.col("target")).alias("high"))
        .where("high > low")
        .selectExpr("number", "low", "high", f"explode(sequence(low div {CELL}, (high - 1) div {CELL})) AS cell")
    )
    length = -(-(total or 0) // block)
    run = max(SHORTEST_RUN, isqrt(length))
    slots = (
        targets.sparkSession.range(length)
        .selectExpr("id AS slot", f"((id + 1) % {POINTS}) * {GOLDEN} % {POINTS} AS point")
        .selectExpr("slot", "point", f"point div {CELL} AS cell")
        .join(bounds, "cell")
        .where("point >= low AND point < high")
        .selectExpr("slot", "number", f"slot div {run} AS run")
    )
    counts = slots.groupBy("number", "run").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("number").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("number", "run", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    place = F.row_number().over(Window.partitionBy("number", "run").orderBy("slot")) - 1
    return (
        slots.withColumn("place", place).join(before, ["number", "run"])
        .select("slot", "number", (F.col("before") + F.col("place")).alias("rank"))
    )


def block_start(k: str) -> str:
    """The first word of block ``k`` of a source: the first blocks are one word longer than the others."""
    return f"(({k}) * (source_size div blocks) + least({k}, source_size % blocks))"


def block_of(word: str) -> str:
    """The block that holds a word of a source's stream."""
    base, longer = "(source_size div blocks)", "(source_size % blocks)"
    return (
        f"(CASE WHEN ({word}) < {longer} * ({base} + 1) THEN ({word}) div ({base} + 1) "
        f"ELSE {longer} + (({word}) - {longer} * ({base} + 1)) div {base} END)"
    )


def block_times(slots: DataFrame, targets: DataFrame, block: int) -> DataFrame:
    """How often each block of a source is taken as a whole, ``times``, and its last part, ``words``.

    Blocks end at whole words, as evenly as can be.  A source is due ``full`` whole blocks, one
    after the other, and then ``words`` words of the next.
    """
    due = stored(
        targets.where("source_size > 0").selectExpr(
            "number", "source_size", f"(source_size + {block - 1}) div {block} AS blocks",
            "cast(floor(target) AS bigint) AS due",
        ).selectExpr("*", "due div source_size AS rounds", "due % source_size AS rest")
        .selectExpr("*", f"{block_of('rest')} AS inner")
        .selectExpr("*", "rounds * blocks + inner AS full", f"rest - {block_start('inner')} AS words"),
        "due",
    )
    given = slots.groupBy("number").agg(F.count(F.lit(1)).alias("slots"))
    missing = (
        due.join(given, "number", "left")
        .selectExpr("number", "coalesce(slots, 0) AS slots", "full").where("slots < full")
        .selectExpr("number", "full - slots AS copies", "slots")
    )
    late = each_copy(missing, "copies", "copy").selectExpr("number", "slots + copy AS rank")
    taken = (
        slots.select("number", "rank").unionByName(late).join(due.select("number", "blocks", "full"), "number")
        .where("rank < full").groupBy("number", F.expr("rank % blocks AS block")).agg(F.count(F.lit(1)).alias("times"))
    )
    last = due.where("words > 0").selectExpr("number", "full % blocks AS block", "words")
    return taken.join(last, ["number", "block"], "full").selectExpr(
        "number", "block", "coalesce(times, 0) AS times", "coalesce(words, 0) AS words"
    )


def streams(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """Documents of some size, with the word at which they start in their source's stream.

    Rows that are alike are one row with a number of ``copies``, laid one after the other.
    """
    named = targets.select(F.col("source").alias("name"), "number", "source_size", "target")
    placed = (
        sized.where("size > 0").groupBy("doc_id", "source", "size", "place").agg(F.count(F.lit(1)).alias("copies"))
        .join(named, F.col("source").eqNullSafe(F.col("name"))).drop("name")
        .withColumn("bucket", F.expr(f"place div {BUCKET}"))
    )
    words = F.col("size") * F.col("copies")
    earlier = Window.partitionBy("number").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        placed.groupBy("number", "bucket").agg(F.sum(words).alias("words"))
        .select("number", "bucket", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("before"))
    )
    within = (
        Window.partitionBy("number", "bucket").orderBy("place", "doc_id", "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    laid = (
        placed.withColumn("inside", F.coalesce(F.sum(words).over(within), F.lit(0)))
        .join(before, ["number", "bucket"])
        .withColumn("first", F.col("before") + F.col("inside"))
        .drop("bucket", "before", "inside", "place")
    )
    return each_copy(laid, "copies", "copy").withColumn("start", F.col("first") + F.col("copy") * F.col("size")).drop(
        "copies", "copy", "first"
    )


def mix(docs: DataFrame, block: int = BLOCK_WORDS) -> DataFrame:
    """Per document: ``doc_id, source, size, source_size, target, taken``.

    ``size`` is in words, ``target`` that of its source, ``taken`` the words the schedule
    takes of the document, repeats counted.
    """
    with scratch(docs.sparkSession):
        return kept(_mixed(docs, block), "mix")


def _mixed(docs: DataFrame, block: int) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    seed = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.md5(text))
    sized = stored(
        docs.select(
            "doc_id", "source", word_count(F.col("text")).alias("size"),
            F.conv(F.substring(F.md5(seed), 1, 12), 16, 10).cast("long").alias("place"),
        ),
        "sized",
    )
    targets = stored(source_targets(sized), "targets")
    times = block_times(stored(schedule(targets, block).select("number", "rank"), "slots"), targets, block)
    cut = streams(sized, targets).withColumn("blocks", F.expr(f"(source_size + {block - 1}) div {block}"))
    pieces = cut.withColumn("block", F.explode(F.expr(f"sequence({block_of('start')}, {block_of('start + size - 1')})")))
    begin, end = block_start("block"), block_start("block + 1")
    whole = f"least(start + size, {end}) - greatest(start, {begin})"
    part = f"greatest(0L, least(start + size, {begin} + words) - greatest(start, {begin}))"
    taken = (
        pieces.join(times, ["number", "block"], "left")
        .groupBy("number", "start", "doc_id", "source", "size", "source_size", "target")
        .agg(F.coalesce(F.sum(F.expr(f"({whole}) * times + {part}")), F.lit(0)).alias("taken"))
        .drop("number", "start")
    )
    named = targets.select(F.col("source").alias("name"), "source_size", "target")
    empty = (
        sized.where("size = 0").join(named, F.col("source").eqNullSafe(F.col("name")))
        .select("doc_id", "source", "size", "source_size", "target", F.lit(0).cast("long").alias("taken"))
    )
    return taken.unionByName(empty)
