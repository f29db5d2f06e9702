import hashlib
import random
import re

from paylake.llm import pii

# The patterns as the contract writes them.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


def valid(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        return 12 <= len(digits) <= 19 and luhn(digits)
    return kind != "phone" or 9 <= len(digits) <= 15


def brute(text):
    found = sorted(
        (m.start(), i, m.end(), kind)
        for i, (kind, p) in enumerate(PATTERNS.items()) for m in re.finditer(p, text or "") if valid(kind, m[0])
    )
    listed = ",".join(f"{kind}:{start}:{end}" for start, _, end, kind in found)
    return [sum(f[1] == i for f in found) for i in range(4)], listed


PIECES = ["a@b.c", "@", ".", "x.y", "_", "1.2.3.4", "256", "001", "4111111111111111", "4111 1111 1111 1111", "4111-1111-1111-1111",
          "+1 (555) 555-5555", "+", "(", ")", " ", "-", "é", "𝒳", "9", "12", "378282246310005", "b.c@d-e.f.g", "%", "\n", "--", "word"]


def test_base_spans_like_brute_force(make_docs, odd):
    rng = random.Random(11)
    rows = [(i, "".join(rng.choice(PIECES) for _ in range(rng.randrange(1, 40)))) for i in range(400)]
    rows += odd + rows[:3]
    got = pii.personal_data(make_docs(rows)).collect()
    expected = sorted(((r[0], *brute(r[1])[0], hashlib.sha256(brute(r[1])[1].encode()).hexdigest()) for r in rows), key=str)
    assert sorted(((r["doc_id"], r["n_email"], r["n_ip"], r["n_card"], r["n_phone"], r["base_sha256"]) for r in got), key=str) == expected
    for r in got:
        listed = [s for s in r["spans"].split(",") if s]
        assert len(listed) == r["n_email"] + r["n_ip"] + r["n_card"] + r["n_phone"] + r["n_term"]


def test_long_texts_do_not_go_back_and_forth(make_docs):
    rows = [(1, "a" * 300000), (2, "1 " * 100000), (3, "1." * 100000), (4, "+1" + "." * 200000), (5, "a@" + "b." * 100000),
            (6, "mail a@b.cd " * 5000)]
    got = {r["doc_id"]: r for r in pii.personal_data(make_docs(rows)).collect()}
    # The plain patterns would take hours for these.
    ips = ",".join(f"ip:{8 * k}:{8 * k + 7}" for k in range(25000))
    expected = {1: "", 2: "", 3: ips, 4: "", 5: f"email:0:{len(rows[4][1]) - 1}", 6: brute(rows[5][1])[1]}
    for i, listed in expected.items():
        assert got[i]["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()


def test_terms_that_give_an_entity_away(make_docs, prose):
    rows = [(i, f"{prose(30, i)} call Zebulon about it +1 (555) 555-0100 please {prose(5, i)}") for i in range(4)]
    rows += [(10 + i, f"{prose(30, 50 + i)} call about it please {prose(5, i)}") for i in range(200)]
    got = {r["doc_id"]: r for r in pii.personal_data(make_docs(rows)).collect()}
    for i in range(4):
        text = dict(rows)[i]
        shown = {text[int(a) : int(b)] for kind, a, b in (s.split(":") for s in got[i]["spans"].split(",")) if kind == "term"}
        assert "Zebulon" in shown and not {"call", "about", "please"} & shown
    assert all(got[10 + i]["spans"] == "" for i in range(200))
    clean = {r["doc_id"]: r["text"] for r in pii.sanitised(make_docs(rows)).collect()}
    assert "Zebulon" not in clean[0] and "[phone]" in clean[0] and "call" in clean[0]
    assert clean[12] == dict(rows)[12]


def shown(rows, got):
    """Per document the texts of its term spans."""
    texts = dict(rows)
    return {r["doc_id"]: [texts[r["doc_id"]][int(a) : int(b)] for kind, a, b in (
        s.split(":") for s in r["spans"].split(",") if s) if kind == "term"] for r in got}


def test_a_single_document_is_enough_and_copies_count_once(make_docs):
    rows = [(i, "call about it please") for i in range(100)]
    rows += [(200, "call Zebulon about +1 (555) 555-0100 please")]
    assert shown(rows, pii.personal_data(make_docs(rows)).collect())[200] == ["Zebulon"]
    # The same row five times over is one document, on all sides.
    again = shown(rows, pii.personal_data(make_docs(rows + rows[-1:] * 4)).collect())
    assert again[200] == ["Zebulon"]


def test_terms_of_whole_documents_in_all_documents(make_docs):
    rows = [(i, "call about it please") for i in range(200)]
    far = "about please call " * 30
    rows += [(300 + i, f"Zebulon {far} +1 (555) 555-0100 {far} 1.2.3.4 {far} Zebulon") for i in range(8)]
    rows += [(400, f"call Zebulon please {far}")]
    got = shown(rows, pii.personal_data(make_docs(rows)).collect())
    assert all(got[300 + i] == ["Zebulon", "Zebulon"] for i in range(8))
    # The term gives the number away where that is not shown, too.
    assert got[400] == ["Zebulon"] and got[0] == []
    clean = {r["doc_id"]: r["text"] for r in pii.sanitised(make_docs(rows)).collect()}
    assert not any("Zebulon" in text for text in clean.values()) and clean[0] == rows[0][1]


def test_words_of_an_entity_are_no_terms_of_it(make_docs):
    rows = [(i, "call about it please") for i in range(50)] + [(60, "call zeb.ulon@mail.example 1.2.3.4 please")]
    assert shown(rows, pii.personal_data(make_docs(rows)).collect())[60] == []


def test_empty(make_docs, odd):
    assert pii.personal_data(make_docs([])).count() == 0
    docs = make_docs(odd)
    assert sorted(map(str, pii.sanitised(docs).collect())) == sorted(map(str, docs.collect()))
