"""Exact top-k search by refined histograms of scores.

Queries and rows meet in tiles of bounded size, about square, so that neither side is copied
more often than it has to be.  All scores are computed, once; a tile keeps, per query, its
k best rows (what lies below cannot be among the k best of all, nor can ties of larger ids).
Histograms of the kept scores are added up over all tiles, which locates the bin of the k-th
score; the next round splits that bin, until bins are single values.  Then rows above the k-th
score and, by smallest id, as many as are needed at it are taken.

Vectors are compared as whole numbers, floor(256 * x); sums are exact, and cut to 64 bits.

Defined cases: rows whose vector is NULL, holds NULL or a number that is not finite, or
whose id is NULL take no part.  Only vectors of equal length are compared.  Repeated rows
are rows of their own: they are queries and candidates each.  Fewer than k candidates are
all given.  Empty tables give no rows.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paylake.llm.common import stored

SCALE = 256
K = 5

# Widths of the bins of each round, as powers of two.
SHIFTS = (12, 6, 0)

# Queries and rows of a tile, at most about.
TILE_QUERIES, TILE_ROWS = 8192, 8192
# Queries of a tile that are scored at a time.
QUERIES_AT_ONCE = 512
# Small tables are cut into this many slots of rows, if each has LEAST_ROWS.
SLOTS, LEAST_ROWS = 32, 256

ROWS = "vec_id long, v array<double>"


def _quantised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, vectors = [], []
        for i, v in zip(batch.column("vec_id").to_pylist(), batch.column("v"), strict=True):
            if i is None or not v.is_valid or v.values.null_count:
                continue
            x = v.values.to_numpy(zero_copy_only=False).astype(np.float64)
            if np.isfinite(x).all():
                ids.append(i)
                vectors.append(np.floor(x * SCALE))
        yield pa.record_batch(
            [pa.array(ids, pa.int64()), pa.array(vectors, pa.list_(pa.float64()))], ["vec_id", "v"]
        )


def quantised(rows: DataFrame) -> DataFrame:
    """The rows that take part: ``uid, vec_id, dim, v``."""
    whole = rows.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("v"))
    return stored(
        whole.mapInArrow(_quantised, ROWS).select(
            F.monotonically_increasing_id().alias("uid"), "vec_id", F.size("v").alias("dim"), "v"
        ),
        "vectors",
    )


def _scores(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Inner products as 64-bit numbers, exact."""
    if not q.size or not c.size:
        return np.zeros((len(q), len(c)), np.int64)
    if float(np.abs(q).max()) * float(np.abs(c).max()) * q.shape[1] < 2**53:
        return (q @ c.T).astype(np.int64)
    exact = np.vectorize(int, otypes=[object])
    product = exact(q).dot(exact(c).T)
    return np.clip(product, -(2**63), 2**63 - 1).astype(np.int64)


def _matrix(column: pa.ChunkedArray, n: int) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy()
    return flat.reshape(n, -1) if len(flat) else np.zeros((n, 0))


KEPT = pa.schema([(name, pa.int64()) for name in ("quid", "query_id", "uid", "vec_id", "score")])


def _kept(k: int):
    """The k best rows of one tile for each of its queries, ties by smallest id."""

    def tile(queries: pa.Table, rows: pa.Table) -> pa.Table:
        parts = [KEPT.empty_table()]
        if len(queries) and len(rows):
            matrix = _matrix(rows["v"], len(rows))
            uid, vec_id = rows["uid"].to_numpy(), rows["vec_id"].to_numpy()
            for at in range(0, len(queries), QUERIES_AT_ONCE):
                asked = queries.slice(at, QUERIES_AT_ONCE)
                quid, names = asked["uid"].to_numpy(), asked["vec_id"].to_numpy()
                scores = _scores(_matrix(asked["v"], len(asked)), matrix)
                columns: list[list[np.ndarray]] = [[] for _ in KEPT]
                for i in range(len(asked)):
                    own, other = scores[i], np.flatnonzero(uid != quid[i])
                    if len(other) > k:
                        kth = np.partition(own[other], len(other) - k)[len(other) - k]
                        other = other[own[other] >= kth]
                    # From the highest score down; -1 - x is in reverse order and never overflows.
                    best = other[np.lexsort((uid[other], vec_id[other], -1 - own[other]))[:k]]
                    found = (np.full(len(best), quid[i]), np.full(len(best), names[i]), uid[best], vec_id[best], own[best])
                    for column, value in zip(columns, found, strict=True):
                        column.append(value)
                parts.append(pa.table([np.concatenate(column) for column in columns], schema=KEPT))
        return pa.concat_tables(parts)

    return tile


def top_k(rows: DataFrame, is_query: str, k: int = K) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the k best rows for each row with ``is_query``.

    ``rows`` has ``vec_id, embedding``; ``is_query`` is a condition on ``vec_id``.
    """
    base = quantised(rows)
    queries = base.where(is_query)
    n_queries, n_rows = queries.count(), base.count()
    blocks = max(1, -(-n_queries // TILE_QUERIES))
    slots = max(1, -(-n_rows // TILE_ROWS), min(SLOTS, -(-n_rows // LEAST_ROWS)))
    queries = queries.withColumn("block", F.pmod(F.xxhash64("uid"), F.lit(blocks)).cast("int")).withColumn(
        "slot", F.explode(F.sequence(F.lit(0), F.lit(slots - 1)))
    )
    candidates = base.withColumn("slot", F.pmod(F.xxhash64("uid"), F.lit(slots)).cast("int")).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    )
    tile = ["dim", "block", "slot"]
    candidates = candidates.toDF(*candidates.columns)
    kept = stored(
        queries.groupBy(*tile).cogroup(candidates.groupBy(*tile)).applyInArrow(
            _kept(k), "quid long, query_id long, uid long, vec_id long, score long"
        ),
        "tile-best",
    )
    state = kth_scores(kept, k).withColumnRenamed("quid", "_quid")
    reached = kept.join(state, F.col("quid") == F.col("_quid")).where(F.col("score") >= F.col("kth"))
    order = Window.partitionBy("quid").orderBy(F.col("score").desc(), "vec_id", "uid")
    return (
        reached.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def kth_scores(kept: DataFrame, k: int) -> DataFrame:
    """``quid, kth``: each query's k-th highest score, or its lowest, by histograms of ever narrower bins."""
    # Of each query: the bin of its k-th score, and how many are needed of that bin.
    state, before = None, None
    for shift in SHIFTS:
        bin_of = F.shiftright("score", shift).alias("bin")
        if state is None:
            added = kept.groupBy("quid", bin_of).agg(F.count(F.lit(1)).alias("n")).withColumn("need", F.lit(k))
        else:
            within = kept.join(state.withColumnRenamed("bin", "_bin"), "quid").where(
                F.shiftright("score", before) == F.col("_bin")
            )
            added = within.groupBy("quid", "need", bin_of).agg(F.count(F.lit(1)).alias("n"))
        down = Window.partitionBy("quid").orderBy(F.col("bin").desc())
        above = F.coalesce(F.sum("n").over(down.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        last = F.min("bin").over(Window.partitionBy("quid"))
        reached = added.withColumn("above", above).withColumn("last", last).where(
            (F.col("above") < F.col("need")) & ((F.col("above") + F.col("n") >= F.col("need")) | (F.col("bin") == F.col("last")))
        )
        state = stored(reached.select("quid", "bin", (F.col("need") - F.col("above")).cast("int").alias("need")), "kth-bins")
        before = shift
    return state.select("quid", F.col("bin").alias("kth"))
