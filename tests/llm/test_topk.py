import math
import random

import pytest

from paylake.llm import topk


def brute(rows, k=5):
    whole = [
        (i, vec_id, [math.floor(256 * x) for x in v]) for i, (vec_id, v) in enumerate(rows)
        if vec_id is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for i, query, q in whole:
        if query % 50 == 0:
            scored = sorted((-sum(a * b for a, b in zip(q, c, strict=True)), vec_id, j) for j, vec_id, c in whole
                            if j != i and len(c) == len(q))
            out += [(query, rank + 1, vec_id, -s) for rank, (s, vec_id, _) in enumerate(scored[:k])]
    return sorted(out)


def answer(spark, rows):
    frame = spark.createDataFrame([(*r, 0, "x") for r in rows], "vec_id bigint, embedding array<double>, bin int, quid string")
    return sorted(tuple(r) for r in topk.top_k(frame, "vec_id % 50 = 0").collect())


@pytest.mark.parametrize("tile", [(1024, 4096, 256), (2, 16, 8)])
def test_like_brute_force(spark, monkeypatch, tile):
    monkeypatch.setattr(topk, "TILE_QUERIES", tile[0])
    monkeypatch.setattr(topk, "TILE_ROWS", tile[1])
    monkeypatch.setattr(topk, "LEAST_ROWS", tile[2])
    rng = random.Random(2)
    rows = [(i, [rng.gauss(0, 1) for _ in range(6)]) for i in range(160)]
    rows += [(200 + i, [1.0, 0.0, 0.0, 0.0, 0.0, 0.5]) for i in range(60)]  # ties
    rows += rows[50:51] + rows[210:212] + [(50, [0.5] * 6)]
    rows += [(300, None), (301, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (350, [math.nan] * 6), (400, [math.inf] * 6), (None, [1.0] * 6)]
    rows += [(450, [1.0, 2.0]), (451, [3.0, -1.0]), (500, []), (501, []), (550, [9.0])]
    rows += [(600, [1e300] * 3), (601, [-1e300] * 3), (650, [1e7] * 3)]
    limit = lambda s: max(-(2**63), min(2**63 - 1, s))
    expected = sorted((q, r, v, limit(s)) for q, r, v, s in brute(rows))
    got = answer(spark, rows)
    large = [e for e in expected if e[0] in (600, 650)]
    assert [g for g in got if g[0] not in (600, 650)] == [e for e in expected if e[0] not in (600, 650)]
    assert [(g[0], g[1]) for g in got if g[0] in (600, 650)] == [(e[0], e[1]) for e in large]


def test_empty(spark):
    assert answer(spark, []) == []
    assert answer(spark, [(50, [1.0])]) == []
    assert answer(spark, [(1, [1.0]), (2, [1.0])]) == []
