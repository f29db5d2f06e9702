"""Similarity join of documents on word shingles, exact: Jaccard similarity of 0.8 or more.

Documents with the same set of shingles are one node from the start.  Nodes meet in
tiles: nodes that share one of the shingles in their prefix, the first fifth of a set in a
common order, and are of similar size.  Sizes are cut into bands as wide as the similarity
allows; a node is at home in the tile of its own band and a visitor in that of the next, so
any two nodes that can be similar meet in exactly one of the bands.  Two sets that are similar
enough always share a shingle of their prefixes.  In a tile, sizes, places in the prefix and
hashed bitmaps (one parity bit per hash; the bits that differ are a lower bound of the elements
that differ) bound the overlap from above; what passes is intersected exactly.

The common order has shingles of rare words first: unrelated documents seldom share one of
these.  Shingles that were seen often come last.  Either affects the speed only.

Groups of copies: first, in a few rounds, each node is checked against leaders that it shares
minimum hashes with.  Then only tiles in which several components are left are searched for
further links, all of them between those components.  Large tiles are cut into blocks
and each pair of blocks is a task of its own.

Defined cases: NULL texts and texts without words have no shingles and are linked with
nothing.  A text of fewer than five words is one shingle.  Rows alike in text are
linked.  A NULL id is no smallest id; a group of NULL ids has a NULL component.  Empty
tables give no rows.  Columns other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, GroupedData, Window
from pyspark.sql import functions as F

from paylake.llm.common import discard, kept, scratch, stored, unused
from paylake.llm.components import components
from paylake.llm.shingles import digest, mixed, scored_sets, shingle_sets

# Similarity: NUMERATOR / DENOMINATOR or more.
NUMERATOR, DENOMINATOR = 8, 10

# A shingle in so many texts of one batch of rows is reported as frequent, ...
LOCAL = 8
# ... and so many of them, and of the most frequent words, are known to every task: 8 bytes each.
MOST_FREQUENT = 1 << 18
MOST_WORDS = 1 << 17

# Minimum hashes of a set, one per part of the range of hashes; two of them make a key.
PARTS = 16

# Bits of the filter of shingles that several nodes share; fixed, whatever their number.
FILTER_BITS = 1 << 26
FILTER_ROW = 1 << 15

# Leaders of a tile, and rounds, as long as they link something.
LEADERS = 3
LEADER_ROUNDS = 2

# Tiles of more nodes are compared by bitmaps in blocks of BLOCK nodes.
SMALL_TILE = 64
BLOCK = 1024

# Node lists up to this length (16 bytes each) may be sent to all executors.
SMALL_LIST = 1 << 18

# Bits of a bitmap per element, and at least.  The more, the closer the bound.
BITS_PER_ELEMENT = 4
SMALLEST_BITMAP = 64

# Rows that are dealt with at a time in Python.
ROWS_AT_ONCE = 1000


def least_overlap(nx, ny):
    """The smallest intersection at which sets of these sizes are similar enough."""
    total = (nx + ny) * NUMERATOR
    return -(-total // (NUMERATOR + DENOMINATOR))


def prefix_length(n: int) -> int:
    return n - -(-n * NUMERATOR // DENOMINATOR) + 1


def bitmap(hashes: np.ndarray) -> bytes:
    """One parity bit per hash value, in a power of two of bits."""
    bits = max(SMALLEST_BITMAP, 1 << (len(hashes) * BITS_PER_ELEMENT - 1).bit_length())
    places = (hashes >> np.uint64(20)).astype(np.int64) & (bits - 1)
    return np.packbits((np.bincount(places, minlength=bits) & 1).astype(np.uint8)).tobytes()


def _portions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, len(batch), ROWS_AT_ONCE):
            yield batch.slice(at, ROWS_AT_ONCE)


WORD, SHINGLE = 0, 1


def _frequent_of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words, with how often they occur, and shingles of several texts, with the number of texts."""
    for batch in batches:
        sets, words = [np.empty(0, np.uint64)], [np.empty(0, np.uint64)]
        for s, _, hashes in scored_sets(batch.column("text")):
            sets.append(s)
            words.append(hashes)
        found, counts = np.unique(np.concatenate(sets), return_counts=True)
        often = counts >= LOCAL
        known, times = np.unique(np.concatenate(words), return_counts=True)
        repeated = times > 1
        tokens = np.concatenate([found[often], known[repeated]]).view(np.int64)
        kinds = np.repeat([SHINGLE, WORD], [often.sum(), repeated.sum()])
        yield pa.record_batch(
            [pa.array(kinds, pa.int32()), pa.array(tokens), pa.array(np.concatenate([counts[often], times[repeated]]))],
            ["kind", "token", "n"],
        )


def frequencies(docs: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The shingles found most often, the most frequent one last; frequent words in order, and their scores.

    A word's score grows with the logarithm of its frequency; words that are not listed have none.
    """
    counted = stored(
        docs.select("text").mapInArrow(_frequent_of_batches, "kind int, token long, n long")
        .groupBy("kind", "token").agg(F.sum("n").alias("n")),
        "frequent",
    )

    def top(kind: int, limit: int) -> pa.Table:
        return counted.where(F.col("kind") == kind).orderBy(F.col("n").desc(), "token").limit(limit).toArrow()

    shingles = top(SHINGLE, MOST_FREQUENT).column("token").to_numpy().view(np.uint64)[::-1].copy()
    words = top(WORD, MOST_WORDS)
    tokens, n = words.column("token").to_numpy().view(np.uint64), words.column("n").to_numpy()
    order = np.argsort(tokens)
    return shingles, tokens[order], np.minimum(255, 5 * np.log2(np.maximum(n[order], 1))).astype(np.uint8)


def minimum_keys(s: np.ndarray) -> np.ndarray:
    """Pairs of the smallest hashes in each part of the range; similar sets share most of them."""
    starts = np.arange(PARTS, dtype=np.uint64) << np.uint64(60)
    at = np.searchsorted(s, starts)
    ends = np.append(at[1:], len(s))
    least = np.where(at < ends, s[np.minimum(at, len(s) - 1)], starts)
    return mixed(least[::2] + mixed(least[1::2])).view(np.int64)


PROFILE = "doc_id long, text_hash long, node binary, n long, keys array<long>, prefix array<long>, bits binary"


def profiles(docs: DataFrame) -> DataFrame:
    """Per document: its node (a digest of its set), the set's size, minimum hashes, prefix and bitmap."""
    found, words, scores = frequencies(docs)
    by_hash = np.argsort(found)
    # The hashes in order, and how frequent each is.
    last = docs.sparkSession.sparkContext.broadcast((found[by_hash], by_hash, words, scores))

    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, rank, known, known_scores = last.value

        def score(hashes: np.ndarray) -> np.ndarray:
            if not len(known):
                return np.zeros(len(hashes), np.int64)
            at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
            return np.where(known[at] == hashes, known_scores[at], 0).astype(np.int64)

        for batch in _portions(batches):
            nodes, sizes, keys, prefixes, bits = [], [], [], [], []
            for s, weights, _ in scored_sets(batch.column("text"), score):
                if not len(s):
                    for column in (nodes, keys, prefixes, bits):
                        column.append(None)
                    sizes.append(0)
                    continue
                order = weights
                if len(frequent):
                    at = np.minimum(np.searchsorted(frequent, s), len(frequent) - 1)
                    order = np.where(frequent[at] == s, (1 << 20) + rank[at], weights)
                # Equal weights stay in the order of the hashes, which is that of the set.
                first = s[np.argsort(order, kind="stable")[: prefix_length(len(s))]]
                nodes.append(digest(s))
                sizes.append(len(s))
                keys.append(minimum_keys(s))
                prefixes.append(first.view(np.int64))
                bits.append(bitmap(s))
            yield pa.record_batch(
                [
                    batch.column("doc_id"), batch.column("text_hash"), pa.array(nodes, pa.binary()),
                    pa.array(sizes, pa.int64()), pa.array(keys, pa.list_(pa.int64())),
                    pa.array(prefixes, pa.list_(pa.int64())), pa.array(bits, pa.binary()),
                ],
                ["doc_id", "text_hash", "node", "n", "keys", "prefix", "bits"],
            )

    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    return stored(rows.mapInArrow(profile, PROFILE), "profiles")


def _sets_of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _portions(batches):
        sets = [s.view(np.int64) for s in shingle_sets(batch.column("text"))]
        yield pa.record_batch(
            [batch.column("node"), pa.array(sets, pa.list_(pa.int64()))], ["node", "hashes"]
        )


def _sets(docs: DataFrame, known: DataFrame, nodes: DataFrame) -> DataFrame:
    """The whole set of each of ``nodes``, from the text of one of its documents."""
    one = known.join(nodes, "node", "left_semi").groupBy("node").agg(
        F.min(F.struct("doc_id", "text_hash")).alias("of")
    )
    if nodes.count() <= SMALL_LIST:
        one = F.broadcast(one)
    texts = docs.select(F.struct("doc_id", F.xxhash64("text").alias("text_hash")).alias("of"), "text")
    return (
        texts.join(one, "of").dropDuplicates(["node"]).select("node", "text")
        .mapInArrow(_sets_of_batches, "node binary, hashes array<long>")
    )


def _overlaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _portions(batches):
        x, y = batch.column("hx"), batch.column("hy")
        keep = []
        for i in range(len(batch)):
            a, b = x[i].values.to_numpy(), y[i].values.to_numpy()
            shared = len(np.intersect1d(a, b, assume_unique=True))
            keep.append(DENOMINATOR * shared >= NUMERATOR * (len(a) + len(b) - shared))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def verified(docs: DataFrame, known: DataFrame, pairs: DataFrame) -> DataFrame:
    """Those of the distinct ``pairs`` (a, b) that are similar enough."""
    pairs = stored(pairs, "pairs")
    nodes = stored(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct(), "pair-nodes")
    sets = stored(_sets(docs, known, nodes), "sets")
    left = sets.select(F.col("node").alias("a"), F.col("hashes").alias("hx"))
    right = sets.select(F.col("node").alias("b"), F.col("hashes").alias("hy"))
    links = stored(
        pairs.join(left, "a").join(right, "b").select("a", "b", "hx", "hy")
        .mapInArrow(_overlaps, "a binary, b binary"),
        "links",
    )
    discard(sets)
    return links


def _differing(xs: list[bytes], ys: list[bytes]) -> np.ndarray:
    """Bits that differ between the bitmaps of each x and each y; widths differ by halves."""
    width = min(min(map(len, xs)), min(map(len, ys))) // 8

    def folded(all_bits: list[bytes]) -> np.ndarray:
        out = np.empty((len(all_bits), width), np.uint64)
        for i, bits in enumerate(all_bits):
            row = np.frombuffer(bits, np.uint64)
            out[i] = np.bitwise_xor.reduce(row.reshape(-1, width), axis=0) if len(row) > width else row
        return out

    a, b = folded(xs), folded(ys)
    out = np.empty((len(a), len(b)), np.int32)
    for i in range(len(a)):
        out[i] = np.bitwise_count(a[i] ^ b).sum(axis=1, dtype=np.int32)
    return out


def tile_pairs(
    n: np.ndarray, place: np.ndarray, label: np.ndarray, bits: list[bytes],
    x: np.ndarray, y: np.ndarray,
) -> tuple[np.ndarray, np.ndarray]:
    """Places of pairs, one of ``x`` and one of ``y``, that may be similar enough."""
    nx, ny = n[x][:, None], n[y][None, :]
    need = least_overlap(nx, ny)
    rest = np.minimum(nx - place[x][:, None], ny - place[y][None, :])
    may = (rest >= need) & (label[x][:, None] != label[y][None, :])
    # Each band's bitmaps are of one width, or two.
    wx = np.array([len(bits[i]) for i in x])
    wy = np.array([len(bits[i]) for i in y])
    for u in np.unique(wx):
        for v in np.unique(wy):
            rows, cols = np.flatnonzero(wx == u), np.flatnonzero(wy == v)
            block = may[np.ix_(rows, cols)]
            if block.any():
                rows, cols = rows[block.any(axis=1)], cols[block.any(axis=0)]
                differ = _differing([bits[x[i]] for i in rows], [bits[y[j]] for j in cols])
                sizes = n[x[rows]][:, None] + n[y[cols]][None, :]
                may[np.ix_(rows, cols)] &= (sizes - differ) // 2 >= need[np.ix_(rows, cols)]
    i, j = np.nonzero(may)
    return x[i], y[j]


def _tile(table: pa.Table) -> pa.Table:
    n = table.column("n").to_numpy()
    place = table.column("place").to_numpy()
    block = table.column("block").to_numpy()
    label = np.unique(np.array(table.column("root").to_pylist(), object), return_inverse=True)[1]
    bits = table.column("bits").to_pylist()
    first, second = block.min(), block.max()
    order = np.argsort(n, kind="stable")
    x, y = order[block[order] == first], order[block[order] == second]
    i, j = tile_pairs(n, place, label, bits, x, y)
    home = table.column("home").to_numpy()
    at_home = home[i] | home[j]
    i, j = i[at_home], j[at_home]
    node = table.column("node").combine_chunks()
    a, b = node.take(pa.array(i)), node.take(pa.array(j))
    swap = pc.less(b, a)
    out = pa.table({"a": pc.if_else(swap, b, a), "b": pc.if_else(swap, a, b)})
    return out.filter(pc.not_equal(out["a"], out["b"])).group_by(["a", "b"]).aggregate([])


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of nodes of small tiles, each tile a row, that sizes and places allow."""
    for batch in batches:
        sizes = np.array([len(members) for members in batch.column("members")])
        flat = batch.column("members").flatten()
        node, root = flat.field("node").to_numpy(zero_copy_only=False), flat.field("root").to_numpy(zero_copy_only=False)
        n, place = flat.field("n").to_numpy(), flat.field("place").to_numpy()
        home = flat.field("home").to_numpy(zero_copy_only=False)
        starts = np.cumsum(sizes) - sizes
        found = set()
        for size in np.unique(sizes):
            low, high = np.triu_indices(size, 1)
            first = starts[sizes == size]
            a, b = (first[:, None] + low).ravel(), (first[:, None] + high).ravel()
            rest = np.minimum(n[a] - place[a], n[b] - place[b])
            may = (home[a] | home[b]) & (rest >= least_overlap(n[a], n[b]))
            a, b = a[may], b[may]
            other = root[a] != root[b]
            found.update((min(x, y), max(x, y)) for x, y in zip(node[a[other]], node[b[other]]))
        pairs = sorted(found)
        yield pa.record_batch(
            [pa.array([x for x, _ in pairs], pa.binary()), pa.array([y for _, y in pairs], pa.binary())], ["a", "b"]
        )


def _between_components(shared: DataFrame, roots: DataFrame | None, nodes: DataFrame) -> DataFrame:
    """Pairs of nodes of different components that meet in a tile and may be similar."""
    labelled = _labelled(shared, roots)
    low_high = [F.min("root").alias("low"), F.max("root").alias("high")]
    mixed_tokens = labelled.groupBy("token").agg(*low_high).where("low != high").select("token")
    # Each node is at home in its band and a visitor in the next.
    banded = stored(
        labelled.join(mixed_tokens, "token").withColumn("own", _band("n"))
        .withColumn("band", F.explode(F.array("own", F.col("own") + 1)))
        .select("token", "band", (F.col("own") == F.col("band")).alias("home"), "node", "root", "n", "place"),
        "banded",
    )
    tiles = stored(
        banded.groupBy("token", "band").agg(*low_high, F.count(F.lit(1)).alias("rows"), F.max("home").alias("lived_in"))
        .where("low != high AND lived_in").select("token", "band", "rows"),
        "mixed",
    )
    members = F.collect_list(F.struct("node", "root", "n", "place", "home")).alias("members")
    met = (
        banded.join(tiles.where(F.col("rows") <= SMALL_TILE), ["token", "band"]).groupBy("token", "band").agg(members)
        .select("members").mapInArrow(_met, "a binary, b binary").distinct()
    )
    blocks = F.ceil(F.col("rows") / BLOCK).cast("int")
    large = tiles.where(F.col("rows") > SMALL_TILE).select("token", "band", blocks.alias("blocks"))
    own = F.pmod(F.hash("node"), F.col("blocks"))
    dealt = (
        banded.join(large, ["token", "band"]).withColumn("block", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "token", "band", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
            "block", "node", "n", "place", "root", "home",
        )
        .join(nodes.select("node", "bits"), "node")
    )
    tiled = dealt.groupBy("token", "band", "low", "high").applyInArrow(_tile, "a binary, b binary")
    return _likely(met, nodes).union(tiled).distinct()


def _likely(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Those of the pairs whose sizes and bitmaps allow enough overlap."""
    left = nodes.select(F.col("node").alias("a"), F.col("n").alias("nx"), F.col("bits").alias("bx"))
    right = nodes.select(F.col("node").alias("b"), F.col("n").alias("ny"), F.col("bits").alias("by"))
    return (
        pairs.join(left, "a").join(right, "b").select("a", "b", "nx", "ny", "bx", "by")
        .mapInArrow(_possible, "a binary, b binary")
    )


def _token_rows(keep: np.ndarray | None):
    """Rows (token, node, n, place) of the prefixes; with ``keep``, a filter's bits, of tokens that it passes."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _portions(batches):
            prefix = batch.column("prefix")
            lengths = np.array([len(p) for p in prefix])
            tokens = prefix.flatten().to_numpy()
            passed = np.flatnonzero(_passes(keep, tokens))
            doc = np.repeat(np.arange(len(batch)), lengths)[passed]
            place = passed - (np.cumsum(lengths) - lengths)[doc]
            yield pa.record_batch(
                [
                    pa.array(tokens[passed]), batch.column("node").take(pa.array(doc)),
                    batch.column("n").take(pa.array(doc)), pa.array(place, pa.int64()),
                ],
                ["token", "node", "n", "place"],
            )

    return rows


def _passes(bits: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    at = tokens & (FILTER_BITS - 1)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0


def _filter(tokens: DataFrame) -> np.ndarray:
    """A filter of fixed size that passes all ``tokens``, and some others."""
    at = F.col("token").bitwiseAND(FILTER_BITS - 1)
    rows = (
        tokens.select(F.shiftright(at, 15).alias("row"), at.bitwiseAND(FILTER_ROW - 1).alias("bit"))
        .groupBy("row").agg(F.bitmap_construct_agg("bit").alias("bits")).collect()  # at most FILTER_BITS / FILTER_ROW rows
    )
    whole = np.zeros(FILTER_BITS // 8, np.uint8)
    for row in rows:
        whole[row["row"] * FILTER_ROW // 8 : (row["row"] + 1) * FILTER_ROW // 8] = np.frombuffer(row["bits"], np.uint8)
    return whole


def _shared(wide: DataFrame) -> DataFrame:
    """Prefix tokens that several nodes have: ``token, node, n, place``, each node once."""
    # Narrow rows first: most tokens occur in one node only, and go no further.
    narrow = wide.where("n > 0").select(F.xxhash64("node").alias("uid"), F.explode("prefix").alias("token"))
    several = stored(
        narrow.groupBy("token").agg(F.min("uid").alias("low"), F.max("uid").alias("high")).where("low != high").select("token"),
        "several",
    )
    keep = wide.sparkSession.sparkContext.broadcast(_filter(several))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _token_rows(keep.value)(batches)

    likely = wide.where("n > 0").select("node", "n", "prefix").mapInArrow(rows, "token long, node binary, n long, place long")
    return stored(likely.join(several, "token").dropDuplicates(["token", "node"]), "tiles")


def _possible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose sizes and bitmaps allow enough overlap."""
    for batch in batches:
        nx, ny = batch.column("nx").to_numpy(), batch.column("ny").to_numpy()
        differ = np.fromiter(
            (
                _differing([x], [y])[0, 0]
                for x, y in zip(batch.column("bx").to_pylist(), batch.column("by").to_pylist(), strict=True)
            ),
            np.int64, len(batch),
        )
        need = least_overlap(nx, ny)
        keep = (np.minimum(nx, ny) >= need) & ((nx + ny - differ) // 2 >= need)
        yield batch.select(["a", "b"]).filter(pa.array(keep))


def _leading(labelled: DataFrame, nodes: DataFrame, number: int, tried: DataFrame | None) -> DataFrame:
    """Pairs of a node and a leader that may be similar, each once: ``a`` is the smaller one.

    The leaders of a key are the LEADERS nodes of the smallest hashes of this round.  A node
    takes the LEADERS leaders of other components that it meets most often.
    """
    smallest = [
        F.min(F.struct(F.xxhash64("node", F.lit(number * LEADERS + i)).alias("h"), "node", "root", "n"))
        for i in range(LEADERS)
    ]
    leaders = stored(labelled.groupBy("key").agg(F.array_distinct(F.array(*smallest)).alias("leaders")), "leaders")
    led = labelled.join(leaders, "key").select(
        "node", "root", "n", F.explode("leaders").alias("l")
    ).where((F.col("root") != F.col("l.root")) & (
        F.least("n", "l.n") * DENOMINATOR >= F.greatest("n", "l.n") * NUMERATOR
    ))
    times = led.groupBy("node", F.col("l.node").alias("leader")).agg(F.count(F.lit(1)).alias("times"))
    often = Window.partitionBy("node").orderBy(F.col("times").desc(), "leader")
    best = times.withColumn("nth", F.row_number().over(often)).where(F.col("nth") <= LEADERS).select(
        F.least("leader", "node").alias("a"), F.greatest("leader", "node").alias("b")
    ).distinct()
    if tried is not None:
        best = best.join(tried, ["a", "b"], "left_anti")
    return stored(_likely(best, nodes), "leading")


def _band(n: str) -> Column:
    """Sizes whose ratio is within the similarity are in the same band or in neighbouring ones."""
    return F.floor(F.log(F.col(n).cast("double")) / F.log(F.lit(DENOMINATOR / NUMERATOR)) + F.lit(1e-9))


def _labelled(rows: DataFrame, roots: DataFrame | None) -> DataFrame:
    """``rows`` with the ``root`` of each node's component."""
    if roots is None:
        return rows.withColumn("root", F.col("node"))
    return rows.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))


def similar_groups(docs: DataFrame) -> DataFrame:
    """Per document: ``doc_id, text_hash, n_shingles, component_id`` and ``node``, its set's digest."""
    with scratch(docs.sparkSession):
        return kept(_similar_groups(docs), "groups")


def _similar_groups(docs: DataFrame) -> DataFrame:
    wide = profiles(docs)
    known = stored(wide.select("doc_id", "text_hash", "node", "n"), "known")
    one = wide.where("n > 0").groupBy("node")
    nodes = stored(one.agg(F.first("n").alias("n"), F.first("bits").alias("bits")), "nodes")
    # What the leader rounds need goes before the tiles are made.
    with scratch(docs.sparkSession):
        links, tried, roots = (
            kept(found, name) for found, name in zip(_led(docs, one, nodes, known), ("links", "tried", "roots"))
        )
    # All that is left, between components.
    shared = _shared(wide)
    discard(wide)
    more = _between_components(shared, roots, nodes)
    further = verified(docs, known, more.join(tried, ["a", "b"], "left_anti"))
    if further.take(1):
        roots = stored(components(links.union(further)), "roots")

    labelled = known.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = labelled.where("n > 0").groupBy("root").agg(F.min("doc_id").alias("least"))
    return labelled.join(least, "root", "left").select(
        "doc_id", "text_hash", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("doc_id")).alias("component_id"), "node",
        "root",
    )


def _led(docs: DataFrame, one: GroupedData, nodes: DataFrame, known: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rounds of leaders, few pairs that join most of what belongs together: links, pairs tried, and roots."""
    meeting = stored(
        one.agg(F.first("n").alias("n"), F.first("keys").alias("keys"))
        .select("node", "n", F.explode("keys").alias("key")).where("key IS NOT NULL"),
        "meeting",
    )
    roots, links, tried = None, None, None
    for number in range(LEADER_ROUNDS):
        asked = _leading(stored(_labelled(meeting, roots), "labelled"), nodes, number, tried)
        tried = asked if tried is None else stored(tried.union(asked), "tried")
        new = verified(docs, known, asked)
        links = new if links is None else stored(links.union(new), "links")
        roots = stored(components(links), "roots")
        if not new.take(1):
            break
    return links, tried, roots


def one_of_each_group(docs: DataFrame) -> DataFrame:
    """The documents without those similar to another: the one of the smallest id stays.

    Texts without words stay, each of them.
    """
    groups = similar_groups(docs)
    kept_of = unused("kept", docs.columns)
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")
    keepers = groups.where("n_shingles > 0").groupBy("root").agg(F.min(order).alias("k")).select(
        F.struct("k.doc_id", "k.text_hash").alias(kept_of)
    )
    key = F.struct("doc_id", F.xxhash64("text").alias("text_hash"))
    worded = F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    keyed = docs.withColumn(kept_of, key)
    with_words = keyed.where(worded).join(keepers, kept_of).dropDuplicates([kept_of])
    return with_words.select(*docs.columns).union(docs.where(~worded))
