"""Merkle manifest of a dataset: leaves in id order per source, proofs, and checks of them.

Each row is a leaf, a hash of its columns.  The place of a leaf among those of its source is
a rank in a compressed bitmap of the source's ids (:mod:`paylake.llm.bitmaps`); nothing is
sorted.  The tree of a source then grows two levels a round: nodes are dealt by (source,
place / 256) into arrays of slots, each array is one row and gives one node of the next
round.  The subroots of all sources form a tree of the same shape.  On the way down each
node gets the siblings on its path to the root, and each leaf its proof.

No group is larger than 256 nodes or 2^16 ids, however large a source is; the driver holds
the number of rounds and the root.

Defined cases: a NULL column counts as ``-``, so it differs from an empty one.  Leaves
without an id come first in their source, those without a source form the first source.
Rows of the same source and id are ordered by their leaf hash; repeated rows are leaves of
their own.  An empty table has an empty manifest.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paylake.llm.bitmaps import bitmap_index, ranks
from paylake.llm.common import lower_ascii, stored

FANOUT = 16
# Levels that one round climbs, and the nodes of an array of slots.
LEVELS = 2
SLOTS = FANOUT**LEVELS
COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]

# Repeats of one row that are put out by one task at a time.
COPIES_AT_ONCE = 4096

NODE = "tree string, pos long, digest binary"
PATH = "tree string, pos long, subroot binary, path binary"
PROVED = (
    "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
)


# ---- leaves -----------------------------------------------------------------


def leaf_hash(values: list[Column]) -> Column:
    """SHA-256 over the length and text of each value, as hex."""
    texts = [value.cast("string") for value in values]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*parts), 256)


def tampered_text(doc_id: Column, text: Column) -> Column:
    """The text that a tampered copy of the row has; NULL where the row is left alone."""
    return F.when((F.crc32(doc_id.cast("string")) % 5 == 0) & text.isNotNull(), lower_ascii(text))


def leaves(docs: DataFrame) -> DataFrame:
    """``tree, doc_id, leaf, bent``: the hash of each row and that of its tampered copy, if there is one."""
    row = {name: F.col(name) for name in COLUMNS}
    bent = tampered_text(row["doc_id"], row["text"])
    changed = F.when(bent.isNotNull() & (bent != row["text"]), leaf_hash([*[row[c] for c in COLUMNS[:-1]], bent]))
    return docs.select(
        # No source sorts first, before an empty one.
        F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("tree"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.unhex(leaf_hash([row[c] for c in COLUMNS])).alias("leaf"),
        F.unhex(changed).alias("bent"),
    )


# ---- places -----------------------------------------------------------------


def _starts(distinct: DataFrame) -> DataFrame:
    """``distinct`` (tree, doc_id, leaf, bent, copies) with the place of the first copy of each, ``start``."""
    ids = stored(
        distinct.groupBy("tree", "doc_id").agg(F.sum("copies").alias("copies"), F.count("*").alias("texts")), "ids"
    )
    known = ids.where("doc_id IS NOT NULL")
    index = bitmap_index(known, "tree", "doc_id", "copies", ids.where("doc_id IS NULL"))
    starts = ranks(index, known, "tree", "doc_id").unionByName(
        ids.where("doc_id IS NULL").select("tree", "doc_id", F.lit(0).cast("long").alias("start"))
    )
    placed = ids.join(starts, (ids.tree == starts.tree) & ids.doc_id.eqNullSafe(starts.doc_id)).select(
        ids.tree.alias("_tree"), ids.doc_id.alias("_id"), "texts", "start"
    )
    placed = distinct.join(placed, (F.col("tree") == F.col("_tree")) & F.col("doc_id").eqNullSafe(F.col("_id")))
    placed = stored(placed.drop("_tree", "_id"), "placed")

    # Different rows of one id: their place among each other is a rank, too, of their hashes.
    contested = placed.where("texts > 1").select(
        "leaf", "copies",
        F.concat_ws("\n", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "tree").alias("_group"),
        F.conv(F.substring(F.hex("leaf"), 1, 15), 16, 10).cast("long").alias("_key"),
    )
    keys = contested.groupBy("_group", "_key").agg(F.sum("copies").alias("copies"))
    inner = ranks(bitmap_index(keys, "_group", "_key", "copies"), keys, "_group", "_key")
    # Hashes whose first 60 bits are equal, if there ever are any.
    alike = Window.partitionBy("_group", "_key").orderBy("leaf").rowsBetween(Window.unboundedPreceding, -1)
    offsets = contested.withColumn("_before", F.coalesce(F.sum("copies").over(alike), F.lit(0))).join(
        inner.withColumnRenamed("start", "_inner"), ["_group", "_key"]
    ).select("_group", F.col("leaf").alias("_leaf"), (F.col("_inner") + F.col("_before")).alias("_offset"))
    group = F.concat_ws("\n", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "tree")
    several = placed.where("texts > 1").withColumn("_of", group).join(
        offsets, (F.col("_of") == F.col("_group")) & (F.col("leaf") == F.col("_leaf"))
    )
    columns = ["tree", "doc_id", "leaf", "bent", "copies"]
    return placed.where("texts = 1").select(*columns, "start").unionByName(
        several.select(*columns, (F.col("start") + F.col("_offset")).alias("start"))
    )


def placed_leaves(docs: DataFrame) -> DataFrame:
    """All leaves with their place in their source: ``tree, pos, doc_id, leaf, bent``."""
    distinct = stored(
        leaves(docs).groupBy("tree", "doc_id", "leaf").agg(F.first("bent").alias("bent"), F.count("*").alias("copies")),
        "leaves",
    )
    started = _starts(distinct)

    def dealt(rows: DataFrame, first: str, copies: str) -> DataFrame:
        each = F.explode(F.sequence(F.col(first), F.col(first) + F.col(copies) - 1))
        return rows.select("tree", each.alias("pos"), "doc_id", "leaf", "bent")

    some = dealt(started.where(f"copies <= {COPIES_AT_ONCE}"), "start", "copies")
    step = F.lit(COPIES_AT_ONCE).cast("long")
    end = F.col("start") + F.col("copies")
    many = (
        started.where(f"copies > {COPIES_AT_ONCE}")
        .select("*", end.alias("_end"), F.explode(F.sequence(F.col("start"), end - 1, step)).alias("_from"))
        .repartition("_from", "leaf")
        .withColumn("_n", F.least(step, F.col("_end") - F.col("_from")))
    )
    return some.unionByName(dealt(many, "_from", "_n"))


# ---- trees ------------------------------------------------------------------


def _parent(children: list[bytes]) -> bytes:
    return hashlib.sha256("".join([child.hex() for child in children]).encode()).digest()


def _climb(nodes: list[bytes], n: int) -> list[list[bytes]]:
    """The levels of one array of slots, lowest first; ``n`` nodes are on the lowest level of its whole tree."""
    levels = [nodes]
    for _ in range(LEVELS):
        if n == 1:
            break
        nodes = [_parent(nodes[i : i + FANOUT]) for i in range(0, len(nodes), FANOUT)]
        levels.append(nodes)
        n = -(-n // FANOUT)
    return levels


def _up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        tops = [
            _climb(digests, n)[-1][0]
            for digests, n in zip(batch.column("digests").to_pylist(), batch.column("n").to_pylist(), strict=True)
        ]
        yield pa.record_batch(
            [batch.column("tree"), batch.column("block"), pa.array(tops, pa.binary())], ["tree", "pos", "digest"]
        )


def _rounds(n: str) -> Column:
    """Rounds until ``n`` nodes have become one; at least one, which leaves a lone node as it is."""
    # 256 to the power of the rounds covers n: eight more bits of n - 1 each.
    return F.expr(f"int(ceil(length(bin({n} - 1)) / 8.0))")


def slot_arrays(nodes: DataFrame, sizes: DataFrame, keep: list[str]) -> DataFrame:
    """Nodes dealt into arrays of slots: ``tree, block, n, digests`` and an array of each of ``keep``."""
    fields = [F.col("digest"), *[F.col(name) for name in keep]]
    arrays = nodes.groupBy("tree", F.expr(f"pos div {SLOTS}").alias("block")).agg(
        F.array_sort(F.collect_list(F.struct((F.col("pos") % SLOTS).alias("slot"), *fields))).alias("_slots")
    )
    chosen = [F.col("_slots.digest").alias("digests"), *[F.col(f"_slots.{name}").alias(name) for name in keep]]
    return arrays.join(sizes.select("tree", "n"), "tree").select("tree", "block", "n", *chosen)


def grow(nodes: DataFrame, keep: list[str]) -> tuple[list[DataFrame], DataFrame]:
    """The slot arrays of each round, and per tree its root and size: ``tree, digest, n, rounds``."""
    nodes = stored(nodes, "nodes")
    sizes = stored(
        nodes.groupBy("tree").agg(F.count("*").alias("n")).withColumn("rounds", _rounds("n")), "sizes"
    )
    last = sizes.agg(F.max("rounds")).first()[0] or 0  # one number
    arrays, roots, open_sizes = [], [], sizes
    for number in range(1, last + 1):
        arrays.append(stored(slot_arrays(nodes, open_sizes, keep if number == 1 else []), "slots"))
        grown = stored(arrays[-1].select("tree", "block", "n", "digests").mapInArrow(_up, NODE), "nodes")
        done = sizes.where(F.col("rounds") == number)
        roots.append(grown.join(done, "tree").select("tree", "digest", "n", "rounds"))
        open_sizes = sizes.where(F.col("rounds") > number).select(
            "tree", F.expr(f"(n + {SLOTS**number - 1}) div {SLOTS**number}").alias("n")
        )
        nodes = grown.join(open_sizes.select("tree"), "tree")
    whole = roots[0] if roots else sizes.selectExpr("tree", "cast(NULL AS binary) AS digest", "n", "rounds")
    for part in roots[1:]:
        whole = whole.unionByName(part)
    return arrays, stored(whole, "roots")


# ---- paths ------------------------------------------------------------------
# A path is a text of steps, from a node towards the root: the slot of the node in its run,
# the number of its siblings, and their digests.


def _step(run: list[bytes], slot: int) -> bytes:
    return bytes([slot, len(run) - 1]) + b"".join(run[:slot]) + b"".join(run[slot + 1 :])


def _steps(path: bytes) -> Iterator[tuple[int, list[str]]]:
    at = 0
    while at < len(path):
        slot, n = path[at], path[at + 1]
        yield slot, [path[i : i + 32].hex() for i in range(at + 2, at + 2 + 32 * n, 32)]
        at += 2 + 32 * n


def proof_text(path: bytes) -> str:
    """The siblings of all steps, level by level, left to right."""
    return "".join("".join(siblings) for _, siblings in _steps(path))


def fold(node: str, path: bytes) -> str:
    """The root that follows from a node (hex) and the siblings on its path."""
    for slot, siblings in _steps(path):
        whole = "".join(siblings[:slot]) + node + "".join(siblings[slot:])
        node = hashlib.sha256(whole.encode()).hexdigest()
    return node


def _own_steps(levels: list[list[bytes]], i: int) -> bytes:
    """The steps of the ``i``-th lowest node within its array of slots."""
    steps = []
    for nodes in levels[:-1]:
        run = i - i % FANOUT
        steps.append(_step(nodes[run : run + FANOUT], i - run))
        i //= FANOUT
    return b"".join(steps)


def _down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From the path of an array's node to the paths of the nodes in it."""
    names = ("tree", "block", "n", "digests", "subroot", "path")
    for batch in batches:
        trees, places, subroots, paths = [], [], [], []
        for tree, block, n, digests, subroot, path in zip(*[batch.column(c).to_pylist() for c in names], strict=True):
            levels = _climb(digests, n)
            for i in range(len(digests)):
                trees.append(tree)
                places.append(block * SLOTS + i)
                subroots.append(subroot)
                paths.append(_own_steps(levels, i) + path)
        yield pa.record_batch(
            [pa.array(trees, pa.string()), pa.array(places, pa.int64()), pa.array(subroots, pa.binary()),
             pa.array(paths, pa.binary())], ["tree", "pos", "subroot", "path"],
        )


def descend(arrays: list[DataFrame], tops: DataFrame) -> DataFrame:
    """The lowest slot arrays with the path of each: ``tops`` has tree, rounds, and each tree's subroot and path."""
    names = ["tree", F.lit(0).cast("long").alias("pos"), "subroot", "path"]
    paths = None
    for number in range(len(arrays), 0, -1):
        entering = tops.where(F.col("rounds") == number).select(*names)
        paths = entering if paths is None else paths.unionByName(entering)
        joined = arrays[number - 1].join(paths.withColumnRenamed("pos", "block"), ["tree", "block"])
        if number == 1:
            return joined
        paths = stored(
            joined.select("tree", "block", "n", "digests", "subroot", "path").mapInArrow(_down, PATH), "paths"
        )
    return tops.withColumnRenamed("rounds", "block")


def _prove(root: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    names = ("n", "digests", "doc_id", "bent", "subroot", "path")

    def prove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(7)]
            for n, digests, ids, bents, subroot, path in zip(*[batch.column(c).to_pylist() for c in names], strict=True):
                levels = _climb(digests, n)
                known: dict[tuple[int, str], str] = {}
                for i, (leaf, doc_id, bent) in enumerate(zip(digests, ids, bents, strict=True)):
                    if i % FANOUT == 0:
                        # What the leaves of a run share: the steps above them, as text.
                        above = path if len(levels) < 3 else _own_steps(levels[1:], i // FANOUT) + path
                        above_text = proof_text(above)
                    own = _own_steps(levels[:2], i)
                    node = fold((bent or leaf).hex(), own)
                    if (i // FANOUT, node) not in known:
                        known[i // FANOUT, node] = fold(node, above)
                    folded = known[i // FANOUT, node]
                    proof = hashlib.sha256((proof_text(own) + above_text).encode()).hexdigest()
                    row = (doc_id, leaf.hex(), subroot.hex(), root, proof, folded, folded == root)
                    for column, value in zip(out, row, strict=True):
                        column.append(value)
            types = [pa.int64(), *[pa.string()] * 5, pa.bool_()]
            columns = [pa.array(values, type_) for values, type_ in zip(out, types, strict=True)]
            yield pa.record_batch(columns, [field.split()[0] for field in PROVED.split(", ")])

    return prove


# ---- manifest ---------------------------------------------------------------


def _ordered(subroots: DataFrame) -> DataFrame:
    """One node per source, numbered in the order of the sources.

    Names are dealt by range and counted per partition; only the partitions' counts meet.
    """
    numbered = stored(
        subroots.repartitionByRange("tree").sortWithinPartitions("tree")
        .withColumn("_line", F.monotonically_increasing_id()),
        "subroots",
    ).withColumn("_part", F.shiftright("_line", 33))
    counts = numbered.groupBy("_part").agg(F.count("*").alias("_n"))
    # One row per partition, not per source.
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    place = F.col("_before") + F.col("_line").bitwiseAND((1 << 33) - 1)
    return numbered.join(offsets, "_part").select(F.lit("all").alias("tree"), place.alias("pos"), "digest", F.col("tree").alias("name"))


def manifest(docs: DataFrame) -> DataFrame:
    """Per row its leaf, subroot, root and proof, and what the proof says of a tampered copy."""
    placed = placed_leaves(docs).withColumnRenamed("leaf", "digest")
    arrays, subroots = grow(placed, ["doc_id", "bent"])
    top_arrays, roots = grow(_ordered(subroots), ["name"])
    found = roots.select("digest").first()  # one digest
    root = found[0].hex() if found else ""
    start = roots.select("tree", "rounds", F.col("digest").alias("subroot"), F.lit(b"").alias("path"))
    if not top_arrays:
        return docs.sparkSession.createDataFrame([], PROVED)
    by_source = stored(
        descend(top_arrays, start).mapInArrow(_named, "tree string, subroot binary, path binary"), "source-paths"
    )
    tops = subroots.select("tree", "rounds").join(by_source, "tree")
    lowest = descend(arrays, tops).select("n", "digests", "doc_id", "bent", "subroot", "path")
    return lowest.mapInArrow(_prove(root), PROVED)


def _named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The path of each source's subroot, by the source's name."""
    columns = ("n", "digests", "name", "path")
    for batch in batches:
        names, subroots, paths = [], [], []
        for n, digests, sources, path in zip(*[batch.column(c).to_pylist() for c in columns], strict=True):
            levels = _climb(digests, n)
            for i, (source, digest) in enumerate(zip(sources, digests, strict=True)):
                names.append(source)
                subroots.append(digest)
                paths.append(_own_steps(levels, i) + path)
        yield pa.record_batch(
            [pa.array(names, pa.string()), pa.array(subroots, pa.binary()), pa.array(paths, pa.binary())],
            ["tree", "subroot", "path"],
        )
