"""Benchmark decontamination by winnowing.

Fingerprints: of every ``WINDOW`` words in a row the k-gram with the smallest hash is
kept.  Two texts that share that many words in a row share a fingerprint, so joining
the fingerprints finds every document with a shared span.  Hits are then extended: all
windows of the documents found are compared as a whole (by 128 bits), and those that
occur in an item are merged into spans.

An item shorter than a window is one window of its own length; lengths are dealt with
one by one, and only those that occur.  Windows that occur in the same items have the
same set id, so a passage shared by a thousand items joins a document once for the
whole set and not once for each of its windows and items.

Defined cases: a NULL text has no words; a document or item without words has no hits.
Items with a NULL id make hits and are not listed or counted.  Items of equal id are
one item with several texts.  Documents alike in id and text get the same result, each.
Empty tables give no rows or no hits.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylake.llm.common import kept, lower_ascii, row_key, scratch, stored, unused


def _runs_without(*ranges: tuple[int, int]) -> str:
    """Runs of characters outside all ``ranges``, as a pattern.

    The class names its characters one by one: Java finds those in a table, but tries ranges one
    after the other for each character of a text, which took ten times as long.
    """
    return "[^" + "".join(rf"\x{c:02X}" for first, last in ranges for c in range(first, last + 1)) + "]+"


# [^\x00-\x2F\x3A-\x60\x7B-\x7F]+
WORD = _runs_without((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))
# The same words before A-Z become lower case, to be counted.
ANY_CASE_WORD = _runs_without((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F))
WINDOW = 13
KGRAM = 8

# A document is contaminated if at least one of this many words is hit.
ONE_OF = 20

Pair = Callable[[Column, Column], Column]


def words(text: Column) -> Column:
    """The words of a text in lower case; none for NULL."""
    return F.regexp_extract_all(lower_ascii(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(ANY_CASE_WORD)), F.lit(0)).cast("long")


def kgram(length: int) -> int:
    """The k-gram length that represents windows of ``length`` words."""
    return KGRAM if length >= WINDOW else length // 2 + 1


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once however often ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _joined(a: Column, b: Column, by: int, pair: Pair) -> Column:
    """``pair`` of each element of ``a`` and the element ``by`` places on in ``b``."""
    n = F.greatest(F.size(b) - by, F.lit(0))
    return F.zip_with(F.slice(a, F.lit(1), n), F.slice(b, F.lit(by + 1), n), pair)


def _folded(values: Column, width: int, pair: Pair) -> Column:
    """Every ``width`` elements in a row folded into one, in log(width) steps."""

    def add(power: Column, done: Column | None, covered: int, span: int) -> Column:
        if not width & span:
            return double(power, done, covered, span)
        if done is None:
            return double(power, power, span, span)
        return _let(
            _joined(done, power, covered, pair), lambda more: double(power, more, covered + span, span)
        )

    def double(power: Column, done: Column | None, covered: int, span: int) -> Column:
        if covered == width:
            return done
        return _let(_joined(power, power, span, pair), lambda twice: add(twice, done, covered, 2 * span))

    return _let(values, lambda power: add(power, None, 0, 1))


def with_fingerprints(frame: DataFrame, length: int) -> DataFrame:
    """Adds ``fps``: for each window of ``length`` ``words`` its smallest k-gram hash."""
    hashes = F.transform("words", lambda w: F.xxhash64(w))
    grams = _folded(hashes, kgram(length), lambda x, y: F.xxhash64(x, y))
    return frame.withColumn("fps", _folded(grams, length - kgram(length) + 1, lambda x, y: F.least(x, y)))


def windows(frame: DataFrame, length: int) -> DataFrame:
    """One row per window of ``length`` words: ``length, start, fp`` and 128 bits ``w1, w2``."""
    others = [c for c in frame.columns if c != "words"]
    of = lambda i: F.slice("words", i, length)
    # Not a filter: that would be moved below the join that finds the few texts of interest.
    places = F.when(F.size("fps") > 0, F.sequence(F.lit(1), F.size("fps"))).otherwise(F.array().cast("array<int>"))
    return with_fingerprints(frame, length).select(
        *others,
        F.posexplode(F.arrays_zip(
            F.col("fps").alias("fp"),
            F.transform(places, lambda i: F.xxhash64(of(i))).alias("w1"),
            F.transform(places, lambda i: F.xxhash64(F.lit(length), of(i))).alias("w2"),
        )).alias("start", "w"),
    ).select(*others, F.lit(length).alias("length"), "start", "w.fp", "w.w1", "w.w2")


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def spans_of_hits(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents with hits: ``key``, ``spans`` (start, end in words, merged) and ``item_ids``."""
    items = (
        benchmark.select("item_id", words(F.col("text")).alias("words")).where(F.size("words") > 0)
        .withColumn("length", F.least(F.size("words"), F.lit(WINDOW)))
    )
    # At most WINDOW different numbers.
    lengths = sorted(r[0] for r in items.select("length").distinct().collect()) or [WINDOW]
    of_items = stored(
        _union([
            windows(items.where(F.col("length") == n).drop("length"), n).drop("start") for n in lengths
        ]).distinct(),
        "item-windows",
    )
    prints = stored(of_items.select("length", "fp").distinct(), "item-prints")

    # Windows with the same items get the same set: sums of hashes have a fixed size.
    window = ["length", "fp", "w1", "w2"]
    bits = lambda seed: F.sum(F.xxhash64(F.lit(seed), "item_id").cast("decimal(20,0)"))
    listed = of_items.where("item_id IS NOT NULL")
    sets = listed.groupBy(*window).agg(
        F.md5(F.concat_ws(",", F.count(F.lit(1)), bits(1), bits(2))).alias("set")
    )
    shown = sets.groupBy("set").agg(F.min(F.struct(*window)).alias("w")).select("set", "w.*")
    set_items = listed.join(shown, window).select("set", "item_id")
    item_windows = stored(
        of_items.select(*window).distinct().join(sets, window, "left"), "window-sets"
    )

    texts = docs.select(row_key().alias("key"), "text")
    split = texts.withColumn("words", words(F.col("text"))).drop("text")
    found = (
        _union([
            with_fingerprints(split, n).select(
                "key", F.lit(n).alias("length"), F.explode(F.array_distinct("fps")).alias("fp")
            )
            for n in lengths
        ])
        .join(prints, ["length", "fp"]).select("key").distinct()
    )
    suspects = (
        texts.join(found, "key", "left_semi").withColumn("words", words(F.col("text"))).drop("text")
    )
    hits = stored(
        _union([windows(suspects, n) for n in lengths]).join(item_windows, window)
        .select("key", "start", (F.col("start") + F.col("length")).alias("end"), "set"),
        "hits",
    )
    merged = F.aggregate(
        F.array_sort("all"),
        F.expr("array_remove(array(struct(0 AS start, 0 AS end)), struct(0 AS start, 0 AS end))"),
        lambda spans, s: F.when(
            (F.size(spans) > 0) & (F.element_at(spans, -1)["end"] >= s["start"]),
            F.concat(
                F.slice(spans, F.lit(1), F.size(spans) - 1),
                F.array(F.struct(
                    F.element_at(spans, -1)["start"].alias("start"),
                    F.greatest(F.element_at(spans, -1)["end"], s["end"]).alias("end"),
                )),
            ),
        ).otherwise(F.concat(spans, F.array(F.struct(s["start"].alias("start"), s["end"].alias("end"))))),
    )
    spans = hits.groupBy("key").agg(F.collect_set(F.struct("start", "end")).alias("all")).select(
        "key", merged.alias("spans")
    )
    named = (
        hits.where("set IS NOT NULL").select("key", "set").distinct()
        .join(set_items, "set").select("key", "item_id").distinct()
        .groupBy("key").agg(F.array_sort(F.collect_list(F.col("item_id").cast("string"))).alias("item_ids"))
    )
    return spans.join(named, "key", "left")


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per document: ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated, spans, item_ids``."""
    counted = docs.select("doc_id", row_key().alias("key"), word_count(F.col("text")).alias("n_words"))
    n_hit = F.aggregate("spans", F.lit(0), lambda n, s: n + s["end"] - s["start"])
    none = F.array().cast("array<string>")
    return (
        counted.join(spans_of_hits(docs, benchmark), "key", "left")
        .withColumn("item_ids", F.coalesce("item_ids", none))
        .select(
            "doc_id", "n_words",
            F.coalesce(n_hit, F.lit(0)).cast("long").alias("n_hit"),
            F.size("item_ids").cast("long").alias("n_items"),
            F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
            "spans", "item_ids",
        )
        .withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * ONE_OF >= F.col("n_words")))
    )


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated, with their columns."""
    with scratch(docs.sparkSession):
        bad = kept(
            spans_of_hits(docs, benchmark)
            .select("key", F.aggregate("spans", F.lit(0), lambda n, s: n + s["end"] - s["start"]).alias("n_hit")),
            "hit-documents",
        )
    key, hit = unused("decontamination_key", docs.columns), unused("decontamination_hit", docs.columns)
    keyed = docs.withColumn(key, row_key())
    bad = bad.select(F.col("key").alias(key), F.col("n_hit").alias(hit))
    keep = F.col(hit).isNull() | (F.col(hit) * ONE_OF < word_count(F.col("text")))
    return keyed.join(bad, key, "left").where(keep).select(*docs.columns)
