import random

from paylake.llm import secrets as S


def token(rng):
    return "".join(rng.choice("0123456789abcdef") for _ in range(40))


def rows(prose):
    rng = random.Random(3)
    out, planted = [], {}
    for i in range(100):
        text = prose(60, i)
        text += " antidisestablishmentarian pneumonoultramicroscopicsilicovolcanoconiosis /usr/share/dictionaries/words"
        text += " 4111111111111111 "
        if i % 5 == 0:
            planted[i] = token(rng)
            text += f' the token = "{planted[i]}" {prose(5, i)} TOKEN = "{planted[i].upper()}"!!'
        out.append((i, text))
    return out, planted


def test_masks_secrets_only(make_docs, odd, prose):
    found, planted = rows(prose)
    docs = make_docs(found + odd + found[5:6])
    got = S.masked(docs)
    assert got.columns == docs.columns
    before, after = dict(found + odd), got.collect()
    assert len(after) == len(found) + len(odd) + 1
    for r in after:
        i, text = r["doc_id"], before[r["doc_id"]]
        if i in planted:
            text = text.replace(planted[i], S.MASK).replace(planted[i].upper(), S.MASK)
        assert r["text"] == text
        if i in planted:
            assert r["n_chars"] == len(text)
    counts = {r["doc_id"]: r for r in S.secrets(docs).collect()}
    assert all(counts[i]["n_secrets"] == (2 if i in planted else 0) for i, _ in found)
    start, end = map(int, counts[5]["spans"].split(",")[0].split(":"))
    assert dict(found)[5][start:end] == planted[5]
    assert (counts[101]["n_candidates"], counts[101]["spans"]) == (0, "")


def test_given_findings_and_missing_labels(spark, make_docs):
    a, b = "abcdefabcdefabcdef", "QRSTQRSTQRSTQRSTQ"
    docs = make_docs([(i, f"x {a} y" if i % 2 else f"x {b} y") for i in range(40)])
    findings = spark.createDataFrame([(i, 2, i % 2) for i in range(20)], "doc_id bigint, start int, label int")
    got = {r["doc_id"]: r["n_secrets"] for r in S.secrets(docs, findings).collect()}
    assert got == {i: i % 2 for i in range(40)}
    # No labelled secrets: the strict rule decides alone.
    assert sum(r["n_secrets"] for r in S.secrets(docs).collect()) == 0


def test_what_a_name_is_given_is_a_candidate(make_docs):
    text = {
        1: 'password = "a.$1!@#:b c"', 2: "MY_API_KEY=abc123def456ghi789 x", 3: "pwd: s3cr3t", 4: "the token is a word",
        5: "MY_VERY_LONG_PRODUCTION_API_KEY=k1 x", 6: "x QUJDREVGR0hJSktMTU5PUA== y", 7: "token = 'q9' secret: \"un",
    }
    got = {}
    for r in S.candidates(make_docs(list(text.items()))).collect():
        i = r["key"]["id"]
        assert text[i][r["start"] : r["end"]] == r["value"]
        got.setdefault(i, []).append(r["value"])
    assert got == {1: ["a.$1!@#:b c"], 2: ["abc123def456ghi789"], 3: ["s3cr3t"], 5: ["k1"],
                   6: ["QUJDREVGR0hJSktMTU5PUA=="], 7: ["q9", "un"]}
    # Without labelled findings of both kinds the strict rule decides.
    clean = {r["doc_id"]: r["text"] for r in S.masked(make_docs([(i, text[i]) for i in (1, 2, 3, 5)])).collect()}
    assert clean == {1: 'password = "[secret]"', 2: "MY_API_KEY=[secret] x", 3: "pwd: [secret]",
                     5: "MY_VERY_LONG_PRODUCTION_API_KEY=[secret] x"}


def test_dictionary_covers_rare_words_far_from_candidates(make_docs):
    common = " ".join(f"common{chr(97 + i // 26)}{chr(97 + i % 26)} " * 3 for i in range(200))
    rows = [(1, f"x configurationManagerFactory y {common}"), (2, "configuration of the manager"),
            (3, "a factory, a configuration, a manager, a factory"), (4, "y 0123456789abcdefabcdef z")]
    docs = make_docs(rows)
    got = S.with_features(S.with_coverage(S.candidates(docs), S.dictionary(docs))).collect()
    assert {r["key"]["id"]: r["covered"] for r in got} == {1: 1.0, 4: 0.0}


def test_empty_and_long(make_docs):
    assert S.secrets(make_docs([])).count() == 0 and S.masked(make_docs([])).count() == 0
    long = make_docs([(1, "A" * 200000), (2, " ".join(["q" * 20] * 5000))])
    assert {r["doc_id"]: r["n_candidates"] for r in S.secrets(long).collect()} == {1: 1, 2: 5000}
