"""The Merkle manifest against one that sorts and hashes in plain Python."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from paylake.llm import bitmaps, manifest
from paylake.llm.queries import registered


def H(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row):
    parts = []
    for value in row:
        text = None if value is None else str(value)
        parts.append("-" if text is None else f"{len(text.encode())}:{text}")
    return H("".join(parts))


def lowered(text):
    return None if text is None else "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def tree(nodes):
    """Root, and per node the (slot, siblings) of its steps."""
    steps = [[] for _ in nodes]
    members, level = [[i] for i in range(len(nodes))], list(nodes)
    while len(level) > 1:
        above, up = [], []
        for at in range(0, len(level), 16):
            run = level[at : at + 16]
            for slot in range(len(run)):
                for i in members[at + slot]:
                    steps[i].append((slot, run[:slot] + run[slot + 1 :]))
            above.append([i for m in members[at : at + 16] for i in m])
            up.append(H("".join(run)))
        members, level = above, up
    return level[0], steps


def brute(rows):
    """rows: (doc_id, source, lang, n_chars, text)"""
    by_source = defaultdict(list)
    for row in rows:
        by_source[row[1]].append((row[0] is not None, row[0] or 0, leaf_of(row), row))
    sources = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for source in sources:
        by_source[source].sort(key=lambda r: r[:3])
        trees[source] = tree([r[2] for r in by_source[source]])
    root, upper = tree([trees[s][0] for s in sources])
    out = []
    for number, source in enumerate(sources):
        subroot, steps = trees[source]
        for (_, _, leaf, row), own in zip(by_source[source], steps):
            path = own + upper[number]
            proof = H("".join("".join(s) for _, s in path))
            bent = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0
            node = leaf_of((*row[:4], lowered(row[4]))) if bent else leaf
            for slot, siblings in path:
                node = H("".join(siblings[:slot]) + node + "".join(siblings[slot:]))
            out.append((row[0], leaf, subroot, root, proof, node, node == root))
    return out


def same(frame, rows):
    assert Counter(map(tuple, frame.collect())) == Counter(brute(rows))


COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def test_documents(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select(COLUMNS).collect()
    same(registered()["op12_merkle_manifest"](spark, sf_dir), [tuple(r) for r in rows])


@pytest.fixture(scope="module")
def build(spark):
    def make(rows):
        schema = "doc_id long, source string, lang string, n_chars long, text string, tree string, pos long, leaf string"
        return manifest.manifest(spark.createDataFrame([(*r, "x", 1, "y") for r in rows], schema))

    return make


def test_odd_rows(build):
    rng = random.Random(3)
    rows = [
        (None, None, None, None, None), (None, None, "en", 1, "A"), (None, "s", "en", 1, "A"), (None, "s", "en", 1, "A"),
        (5, "s", None, 0, ""), (5, "s", None, None, ""), (5, "s", "", 0, None), (5, "", "", 0, None),
        (-7, "s", "de", 3, "Ünï KÖLN ſ"), (2**63 - 1, "s", "en", 2, "Z" * 100_000), (-(2**63), "s", "en", 2, "Zz"),
    ]
    rows += [(rng.choice([rng.randrange(40), rng.randrange(-(2**62), 2**62)]), "t", "en", 4, rng.choice("AbC")) for _ in range(700)]
    rows += [(9, "one", "en", 4, "same")] * 300  # a repeated row that fills more than one array
    rows += [(i, f"source {i}", "en", 4, "Alone") for i in range(300)]  # sources of a lone leaf
    same(build(rows), rows)


def test_few_rows(build):
    for n in (1, 16, 17, 256, 257):
        rows = [(i * 3, "s", "en", 1, f"Text {i}") for i in range(n)]
        same(build(rows), rows)
    assert build([]).count() == 0


def test_more_copies_than_are_put_out_at_once(build, monkeypatch):
    monkeypatch.setattr(manifest, "COPIES_AT_ONCE", 7)
    rows = [(1, "s", "en", 1, "A")] * 45 + [(2, "s", "en", 1, "B")] * 3 + [(None, "s", "en", 1, "B")] * 20
    same(build(rows), rows)


def test_ranks_of_dense_and_sparse_ids(spark):
    rng = random.Random(5)
    ids = {("a", i) for i in range(0, 200_000, 3)} | {("b", rng.randrange(-(2**63), 2**63)) for _ in range(2000)}
    rows = [(g, i, rng.choice([1, 1, 4])) for g, i in ids]
    frame = spark.createDataFrame(rows, "g string, i long, w long")
    got = {(r.g, r.i): r.start for r in bitmaps.ranks(bitmaps.bitmap_index(frame, "g", "i", "w"), frame, "g", "i").collect()}
    expected, before = {}, Counter()
    for g, i, w in sorted(rows):
        expected[g, i] = before[g]
        before[g] += w
    assert got == expected


@pytest.mark.parametrize("n", [1, 5119, 5120, 65536])
def test_container(n):
    lows = np.random.default_rng(n).permutation(1 << 16)[:n].astype(np.int64)
    asked = np.arange(1 << 16)
    expected = np.searchsorted(np.sort(lows), asked)
    assert (bitmaps.ranks_in(bitmaps.packed(lows), asked) == expected).all()
