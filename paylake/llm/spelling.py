"""Spelling variants: words one edit apart, grouped under their most frequent form.

Words are points in the space of letter counts, where one edit moves a point by an L1
distance of at most two.  Per length, a k-d tree cuts that space into cells; it is fitted to a
sample of the words (``SAMPLE``), which decides only how even cells are.  Every word goes to
its cell, and as a query to the cells that its box search reaches: those of its own length
behind its own, and those of words one letter longer.  A cell of many words is cut into
blocks, a block with many queries into chunks; each is searched with a k-d tree of its own
(:mod:`paylake.llm.kdtrees`).  What is found is added up per word before it is shuffled, so
pairs are never listed.

Defined cases: a NULL or empty text has no words; a NULL id counts as an empty one in the
hash that spoils words; repeated rows count each; among equally frequent near words the first
in code-point order is the form; an empty table has no words.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylake.llm import kdtrees
from paylake.llm.common import lower_ascii, stored

SHORTEST = 7
LEAST = 2
# A form is at least so many times as frequent as the word.
TIMES = 10
SPOILED = 31

# Words the cells are fitted to, at about: some megabytes on the driver.
SAMPLE = 200_000
# A cell that holds fewer words of the sample is not split.
LEAST_SAMPLED = 64
# Code points of the words of a block, and of the queries of a chunk.
BLOCK, CHUNK = 1 << 18, 1 << 20

ROUTED = "length int, cell int, point boolean, word string, n long"
NEAR = "word string, n_near long, best_n long, best string"


# ---- words ------------------------------------------------------------------


def spoiled(doc_id: Column, run: Column) -> Column:
    """The run as it is read: some, by a hash of document and run, lose a letter."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run))
    at = (h % F.length(run)).cast("int")
    return F.when(h % SPOILED == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))).otherwise(run)


def words(docs: DataFrame) -> DataFrame:
    """``word, n``: words of at least SHORTEST letters that occur at least LEAST times."""
    # A shorter run gives no word: it can only lose a letter.
    pattern = F.lit(rf"[a-zÀ-ÿ]{{{SHORTEST},}}")
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all(lower_ascii(F.col("text")), pattern, 0)).alias("run"))
    return (
        runs.select(spoiled(F.col("doc_id"), F.col("run")).alias("word"))
        .where(F.length("word") >= SHORTEST)
        .groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= LEAST)
    )


# ---- cells ------------------------------------------------------------------


def fitted_cells(found: DataFrame) -> dict[int, object]:
    """Per length a tree whose leaves are numbers of cells; a length without one is a single cell."""
    total = found.count()
    if not total:
        return {}
    part = min(1.0, SAMPLE / total)
    bound = int(part * (1 << 30))
    chosen = found.where(F.pmod(F.xxhash64("word"), F.lit(1 << 30)) <= bound).select("word").toArrow()
    by_length: dict[int, list[str]] = {}
    for word in chosen.column("word").to_pylist():
        by_length.setdefault(len(word), []).append(word)
    trees = {}
    for length, sampled in by_length.items():
        numbers = iter(range(len(sampled) + 1))
        trees[length] = kdtrees.build(
            kdtrees.letter_counts(kdtrees.codes(sampled, length)),
            lambda n, length=length: n * length / part <= BLOCK or n < 2 * LEAST_SAMPLED,
            lambda rows, numbers=numbers: next(numbers),
        )
    return trees


def _route(trees: dict[int, object]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            given, n = batch.column("word"), batch.column("n").to_numpy()
            texts = given.to_pylist()
            lengths = np.array([len(word) for word in texts])
            for length in np.unique(lengths).tolist():
                rows = np.flatnonzero(lengths == length)
                counts = kdtrees.letter_counts(kdtrees.codes([texts[i] for i in rows], length))
                own = np.zeros(len(rows), np.int64)
                for cell, members in kdtrees.reach(trees.get(length, 0), counts, 0, 0):
                    own[members] = cell
                targets = [(length, own, np.arange(len(rows)), True)]
                for cell, members in kdtrees.reach(trees.get(length, 0), counts, 1, 1):
                    members = members[own[members] < cell]
                    targets.append((length, np.full(len(members), cell), members, False))
                for cell, members in kdtrees.reach(trees.get(length + 1, 0), counts, 1, 0):
                    targets.append((length + 1, np.full(len(members), cell), members, False))
                picked = rows[np.concatenate([members for _, _, members, _ in targets])]
                yield pa.record_batch(
                    [
                        pa.array(np.concatenate([np.full(len(m), t) for t, _, m, _ in targets]), pa.int32()),
                        pa.array(np.concatenate([cells for _, cells, _, _ in targets]), pa.int32()),
                        pa.array(np.concatenate([np.full(len(m), point) for _, _, m, point in targets])),
                        given.take(pa.array(picked)),
                        pa.array(n[picked], pa.int64()),
                    ],
                    ["length", "cell", "point", "word", "n"],
                )

    return route


def dealt(routed: DataFrame) -> DataFrame:
    """Each routed word with the block and chunk it is a point or a query of."""
    sizes = routed.groupBy("length", "cell").agg(
        F.count_if("point").alias("_points"), F.count_if(~F.col("point")).alias("_queries")
    ).where("_points > 0")
    blocks = F.ceil(F.col("_points") * F.col("length") / BLOCK).cast("int")
    # Words of a cell are queries of the blocks behind their own.
    asked = F.col("_queries") + F.when(blocks > 1, F.col("_points")).otherwise(0)
    chunks = F.greatest(F.lit(1), F.ceil(asked * F.col("length") / CHUNK)).cast("int")
    sizes = sizes.select("length", "cell", blocks.alias("_blocks"), chunks.alias("_chunks"))
    rows = routed.join(sizes, ["length", "cell"]).select(
        "*", F.pmod(F.xxhash64("word"), "_blocks").cast("int").alias("_own"),
        F.pmod(F.xxhash64("word", F.lit(1)), "_chunks").cast("int").alias("_chunk"),
    )
    places = F.expr(
        "CASE WHEN point THEN concat("
        "transform(sequence(0, _chunks - 1), c -> struct(_own AS block, c AS chunk, true AS point)), "
        "transform(filter(sequence(0, _blocks - 1), b -> b > _own), b -> struct(b AS block, _chunk AS chunk, false AS point))) "
        "ELSE transform(sequence(0, _blocks - 1), b -> struct(b AS block, _chunk AS chunk, false AS point)) END"
    )
    return rows.select("length", "cell", "word", "n", F.explode(places).alias("_at")).select(
        "length", "cell", "_at.block", "_at.chunk", "_at.point", "word", "n"
    )


def _search(table: pa.Table) -> pa.Table:
    """Near words of one chunk, added up per word."""
    point = table.column("point").to_numpy()
    order = np.argsort(~point, kind="stable")
    given = np.array(table.column("word").to_pylist(), dtype=object)[order]
    n = table.column("n").to_numpy()[order]
    points, queries = given[: point.sum()].tolist(), given[point.sum() :].tolist()
    first = table.column("chunk")[0].as_py() == 0
    a, b = kdtrees.near_pairs(points, queries, first) if points else (np.zeros(0, np.int64),) * 2
    word, near = np.concatenate([a, b]), np.concatenate([b, a])
    rank = np.empty(len(given), np.int64)
    rank[np.argsort(given, kind="stable")] = np.arange(len(given))
    ordered = np.lexsort((rank[near], -n[near], word))
    word, near = word[ordered], near[ordered]
    found, starts, counts = np.unique(word, return_index=True, return_counts=True)
    best = near[starts]
    return pa.table({
        "word": pa.array(given[found], pa.string()), "n_near": pa.array(counts, pa.int64()),
        "best_n": pa.array(n[best], pa.int64()), "best": pa.array(given[best], pa.string()),
    })


def near_words(found: DataFrame) -> DataFrame:
    """``word, n_near, best_n, best`` of the words that have a near word."""
    routed = stored(found.mapInArrow(_route(fitted_cells(found)), ROUTED), "routed")
    partial = dealt(routed).groupBy("length", "cell", "block", "chunk").applyInArrow(_search, NEAR)
    first = F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word"))
    return partial.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(first).alias("_best")).select(
        "word", "n_near", (-F.col("_best.n")).alias("best_n"), F.col("_best.word").alias("best")
    )


# ---- forms ------------------------------------------------------------------


def with_roots(links: DataFrame) -> DataFrame:
    """``word, root`` for links (word, form) without cycles: forms are followed to the last.

    Each round doubles the steps taken; forms are TIMES as frequent as their words, so few are needed.
    """
    rooted = stored(links.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = rooted.select(F.col("word").alias("_word"), F.col("root").alias("_root"))
        further = stored(
            rooted.join(onward, F.col("root") == F.col("_word"), "left").select(
                "word", F.coalesce("_root", "root").alias("root"), F.col("_root").isNotNull().alias("moved")
            ),
            "roots",
        )
        if further.where("moved").isEmpty():
            return further.select("word", "root")
        rooted = further.select("word", "root")


def spelling_variants(found: DataFrame) -> DataFrame:
    """Words (``word, n``, each once) with their form, root and number of near words."""
    found = stored(found.select("word", F.col("n").cast("long").alias("n")), "words")
    near = near_words(found).withColumnRenamed("word", "_word")
    is_form = F.col("best_n") >= TIMES * F.col("n")
    judged = stored(
        found.join(near, F.col("word") == F.col("_word"), "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(is_form, F.col("best")).alias("form"), F.when(is_form, F.col("best_n")).alias("form_n"),
        ),
        "judged",
    )
    roots = with_roots(judged.where("form IS NOT NULL")).withColumnRenamed("word", "_word")
    return judged.join(roots, F.col("word") == F.col("_word"), "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
