import hashlib
import re

from pyspark.sql import functions as F

from paylake.llm import decontamination as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items):
    out = []
    for row in docs:
        w = words(row[1])
        hit, ids = set(), set()
        for item_id, text in items:
            i = words(text)
            n = min(len(i), 13)
            wins = {tuple(i[s : s + n]) for s in range(len(i) - n + 1)} if n else set()
            for s in range(len(w) - n + 1):
                if n and tuple(w[s : s + n]) in wins:
                    hit |= set(range(s, s + n))
                    if item_id is not None:
                        ids.add(str(item_id))
        sha = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
        out.append((row[0], len(w), len(hit), len(ids), sha, bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def cases(prose, odd):
    items = [
        (1, prose(40, 1)), (2, prose(13, 2)), (3, prose(12, 3)), (4, "w1 w2 w3"), (5, "Lonely"), (6, None), (7, ""),
        (None, prose(20, 8)), (9, prose(40, 1)), (9, prose(15, 9)), (10, prose(6, 10)), (11, prose(40, 1)), (11, prose(40, 1)),
    ]
    docs = [
        *odd, (1, prose(100, 50) + " " + prose(40, 1) + " " + prose(30, 51)),
        (2, "  ".join(prose(40, 1).upper().split()[5:17])), (3, "..".join(prose(40, 1).split()[5:18])),
        (4, prose(300, 60) + "\n" + prose(13, 2)), (5, prose(12, 3)), (6, prose(10, 61) + " w1, W2; w3 " + prose(10, 62)),
        (7, "x lonely y"), (8, prose(20, 8)), (9, prose(15, 9) + " " + prose(6, 10) + " " + prose(6, 10)),
        (10, prose(400, 63)), (11, prose(40, 1) + " " + prose(40, 1)), (1, prose(13, 2)), (12, prose(20000, 64) + " " + prose(13, 2)),
    ]
    return docs + docs[7:9], items


def test_like_brute_force(spark, make_docs, prose, odd):
    docs, items = cases(prose, odd)
    bench = spark.createDataFrame(items, "item_id bigint, text string").selectExpr("*", "'x' AS key", "1 AS length")
    found = D.contamination(make_docs(docs), bench)
    columns = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert sorted((tuple(r) for r in found.select(columns).collect()), key=str) == brute(docs, items)
    kept = D.clean(make_docs(docs), bench)
    assert kept.columns == make_docs(docs).columns
    expected = sorted((str(b[0]) for b in brute(docs, items) if not b[5]))
    assert sorted(str(r[0]) for r in kept.collect()) == expected


def test_words_are_found_without_trying_ranges(spark, make_docs):
    """Java tries the ranges of a class one by one for each character of a text."""
    assert "-" not in D.WORD + D.ANY_CASE_WORD
    text = "".join(f"{chr(c)}aZ9{chr(c)}" for c in [*range(0x0, 0x250), 0x2028, 0xD7FF, 0xE000, 0x1F600])
    docs = make_docs([(1, text), (2, None), (3, "...")])
    found = docs.select("doc_id", D.words(F.col("text")), D.word_count(F.col("text"))).collect()
    assert sorted(map(tuple, found)) == [(1, words(text), len(words(text))), (2, [], 0), (3, [], 0)]


def test_empty_tables(spark, make_docs):
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert D.contamination(make_docs([]), none).count() == 0
    row = D.contamination(make_docs([(1, "a b c")]), none).first()
    assert (row["n_words"], row["n_hit"], row["n_items"], row["contaminated"]) == (3, 0, 0, False)
    one = spark.createDataFrame([(1, "a b")], "item_id bigint, text string")
    assert D.clean(make_docs([]), one).count() == 0
