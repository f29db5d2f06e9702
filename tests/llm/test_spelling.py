"""Spelling variants against pairwise comparison in plain Python."""

import random
import re
import zlib
from collections import Counter

import pytest

from paylake.llm import kdtrees, spelling
from paylake.llm.queries import registered


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(counts):
    out = {}
    for word, n in counts.items():
        others = [other for other in counts if near(word, other)]
        best = min(others, key=lambda o: (-counts[o], o), default=None)
        form = best if best is not None and counts[best] >= 10 * n else None
        out[word] = [form, word, n, len(others), counts[form] if form else None]
    for word, row in out.items():
        while out[row[1]][0]:
            row[1] = out[row[1]][0]
    return {(word, *row) for word, row in out.items()}


def counted(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                counts[run] += 1
    return {word: n for word, n in counts.items() if n >= 2}


def got(frame):
    rows = frame.select("word", "form", "root", "n", "n_near", "form_n").collect()
    assert len(rows) == len({r.word for r in rows})
    return set(map(tuple, rows))


def variants_of(rng, word, alphabet):
    i, c = rng.randrange(len(word)), rng.choice(alphabet)
    return rng.choice([word[:i] + word[i + 1 :], word[:i] + c + word[i:], word[:i] + c + word[i + 1 :]])


@pytest.fixture(scope="module")
def vocabulary():
    rng = random.Random(11)
    alphabet = "abcdeéöÿz"
    counts = {}
    for _ in range(60):
        word = "".join(rng.choice(alphabet) for _ in range(rng.randrange(7, 13)))
        counts[word] = rng.choice([2, 30, 500, 9000])
        for _ in range(6):
            word = variants_of(rng, word, alphabet)
            counts.setdefault(word, rng.choice([2, 2, 3, 25, 300]))
    # Anagrams cannot be told apart by their counts, very long words have large ones.
    for _ in range(40):
        counts.setdefault("".join(rng.sample("aabbccddee", 10)), rng.choice([2, 20]))
    counts |= {"q" * 3000: 5, "q" * 3001: 70, "q" * 2999 + "r": 5, "r" + "q" * 2999: 5, "Q" * 8: 2}
    return counts


@pytest.mark.parametrize("block, chunk, sampled", [(1 << 18, 1 << 20, 64), (400, 1 << 20, 2), (150, 300, 1000), (200, 150, 1)])
def test_against_all_pairs(spark, monkeypatch, vocabulary, block, chunk, sampled):
    """However words are cut into cells, blocks and chunks."""
    monkeypatch.setattr(spelling, "BLOCK", block)
    monkeypatch.setattr(spelling, "CHUNK", chunk)
    monkeypatch.setattr(spelling, "LEAST_SAMPLED", sampled)
    monkeypatch.setattr(kdtrees, "LEAF_POINTS", 5)
    frame = spark.createDataFrame([(w, n, "x") for w, n in vocabulary.items()], "word string, n long, best string")
    assert got(spelling.spelling_variants(frame)) == brute(vocabulary)


def test_cells_fitted_to_few_words(spark, monkeypatch, vocabulary):
    """Cells fitted to a part of the words: lengths without a tree, cells without words."""
    monkeypatch.setattr(spelling, "SAMPLE", len(vocabulary) // 3)
    monkeypatch.setattr(spelling, "LEAST_SAMPLED", 1)
    monkeypatch.setattr(spelling, "BLOCK", 100)
    frame = spark.createDataFrame(list(vocabulary.items()), "word string, n long")
    assert got(spelling.spelling_variants(frame)) == brute(vocabulary)


def test_odd_documents(spark, make_docs, odd):
    rows = [*odd, (1, "Ünïcodés ÜNÏCODÉS unïcodés x" * 3), (2, "A" * 20_000), (3, "A" * 20_000), (None, "wordword " * 50)]
    rows += [(i, "Katalogen katalogen, Catalogen! catalogens×catalogens ÷÷÷÷÷÷÷") for i in range(60)]
    found = spelling.spelling_variants(spelling.words(make_docs(rows)))
    assert got(found) == brute(counted(rows))
    assert spelling.spelling_variants(spelling.words(make_docs([]))).count() == 0


def test_documents(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    found = got(registered()["op11_spelling_variants"](spark, sf_dir))
    counts = counted(rows)
    assert {(r[0], r[3]) for r in found} == set(counts.items())
    chosen = set(sorted(counts)[::97])
    by_length = {}
    for word in counts:
        by_length.setdefault(len(word), []).append(word)
    for row in found:
        if row[0] in chosen:
            k = len(row[0])
            around = [w for d in (-1, 0, 1) for w in by_length.get(k + d, [])]
            assert row[4] == sum(near(row[0], w) for w in around), row
