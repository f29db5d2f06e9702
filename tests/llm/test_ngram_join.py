import random
from collections import defaultdict

import pytest

from paylake.llm import ngram_join as J


def brute(rows):
    sets = []
    for _, text in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        w = [x for x in __import__("re").split(r"[\x20\x09-\x0D]+", low) if x]
        sets.append(frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset())
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                parent[find(i)] = find(j)
    least = defaultdict(list)
    for i, row in enumerate(rows):
        least[find(i)].append(row[0])
    smallest = lambda ids: min((x for x in ids if x is not None), default=None)
    return sorted(
        ((row[0], len(sets[i]), smallest(least[find(i)])) for i, row in enumerate(rows)), key=str
    )


def changed(text, share, rng):
    w = text.split()
    for _ in range(max(1, int(len(w) * share))):
        w[rng.randrange(len(w))] = f"z{rng.randrange(99999)}"
    return " ".join(w)


def corpus(prose, odd):
    rng = random.Random(5)
    rows = [*odd, (None, "no id here"), (106, "ONE"), (107, "one\x1ctwo"), (108, "a b c d e"), (109, "A b  c\td\ne")]
    passage = prose(60, 900)
    rows += [(i, prose(rng.randrange(3, 120), i) + " " + passage) for i in range(200, 320)]
    for group in range(12):
        base, size = prose(rng.randrange(8, 300), 1000 + group), rng.choice([2, 3, 40])
        for k in range(size):
            rows.append((1000 + 100 * group + k, changed(base, rng.choice([0.002, 0.01, 0.02, 0.03]), rng)))
    # A chain: each is similar to the next only.
    chain = prose(200, 77).split()
    rows += [(3000 + k, " ".join(chain[4 * k : 4 * k + 100])) for k in range(20)]
    rows += [(4000 + k, prose(150, 78)) for k in range(30)]
    return rows + rows[20:25]


@pytest.mark.parametrize("block, frequent", [(J.BLOCK, J.LOCAL), (16, 10**9)])
def test_like_brute_force(make_docs, prose, odd, monkeypatch, block, frequent):
    # The second time with small blocks and no order by frequency.
    monkeypatch.setattr(J, "BLOCK", block)
    monkeypatch.setattr(J, "SMALL_TILE", 4 if block == 16 else J.SMALL_TILE)
    monkeypatch.setattr(J, "LOCAL", frequent)
    rows = corpus(prose, odd)
    got = J.similar_groups(make_docs(rows)).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)


def test_one_of_each_group(make_docs, odd, prose):
    text = prose(50, 1)
    rows = [*odd, (7, text), (5, text + " end"), (9, prose(50, 2)), (5, text + " end"), (None, text)]
    docs = make_docs(rows)
    kept = J.one_of_each_group(docs)
    assert kept.columns == docs.columns
    ids = sorted(str(r["doc_id"]) for r in kept.collect())
    assert ids == sorted(["101", "102", "103", "None", "104", "105", "5", "9"])


def test_empty(make_docs):
    assert J.similar_groups(make_docs([])).count() == 0
    assert J.one_of_each_group(make_docs([])).count() == 0
    only = J.similar_groups(make_docs([(1, None), (2, "")])).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in only) == [(1, 0, 1), (2, 0, 2)]


def test_threshold_is_met_exactly(make_docs):
    # 9 and 9 shingles, 8 shared: 8 of 10.
    a = " ".join(f"a{i}" for i in range(13))
    b = " ".join(f"a{i}" for i in range(1, 14))
    got = J.similar_groups(make_docs([(1, a), (2, b)])).collect()
    assert {r["component_id"] for r in got} == {1}
    c = " ".join(f"c{i}" for i in range(12))  # 8 and 8, 7 shared: 7 of 9
    d = " ".join(f"c{i}" for i in range(1, 13))
    got = J.similar_groups(make_docs([(1, c), (2, d)])).collect()
    assert {r["component_id"] for r in got} == {1, 2}
