from paylake.llm import urls as U


def judged(spark, rows, **more):
    frame = spark.createDataFrame([(i, u, "h", "t", 0) for i, u in rows], "page_id bigint, url string, host string, t1 string, labels int")
    return {r["page_id"]: r for r in U.filtered(frame, **more).collect()}


def test_hosts_paths_and_rules(spark):
    got = judged(spark, [
        (1, "https://A.Example.ORG/es/x"), (2, "http://example.org/es"), (3, "http://x.example.org/en/12.html"),
        (4, "http://notexample.org/es/"), (5, "http://a.com/fr/?q"), (6, "http://com/de/1#x"), (7, "ftp://h.net?x/org/"),
        (8, None), (9, "no scheme"), (10, "a://b://c/d"), (11, "://"), (12, "http://org"), (13, "http://example.com/EN/1"),
        (14, "http://ÀB.org/\nx"), (None, "http://a.com/fr/"),
    ])
    shown = {i: (r["host"], r["path"], r["rule"]) for i, r in got.items()}
    assert shown == {
        1: ("a.example.org", "/es/x", "example.org/es/"), 2: ("example.org", "/es", "org/"),
        3: ("x.example.org", "/en/12.html", "example.org/en/1"), 4: ("notexample.org", "/es/", "org/"),
        5: ("a.com", "/fr/", "com/fr/"), 6: ("com", "/de/1", "com/de/"), 7: ("h.net", "", None), 8: ("", "", None),
        9: ("", "", None), 10: ("b:", "//c/d", None), 11: ("", "", None), 12: ("org", "", None),
        13: ("example.com", "/EN/1", None), 14: ("Àb.org", "/\nx", "org/"), None: ("a.com", "/fr/", "com/fr/"),
    }
    assert {r["verdict"] for r in got.values() if r["rule"] is None} <= {"allow", "block"}
    assert [got[i]["verdict"] for i in (1, 2, 3, 5, 6)] == ["block", "allow", "block", "allow", "block"]


def test_templates_learn_from_labels(spark):
    rules = [("block", "h.net", "/bad/1"), ("allow", "h.net", "/good/1")]
    rows = [(i, f"http://h.net/bad/{i}/{i}x.html") for i in range(100, 300)]
    rows += [(i, f"http://h.net/good/{i}/y") for i in range(300, 500)] + [(i, f"http://h.net/good/1{i}/y") for i in range(500, 560)]
    got = judged(spark, rows, rules=rules)
    assert {got[i]["verdict"] for i in range(200, 300)} == {"block"}
    assert {got[i]["verdict"] for i in range(300, 500)} == {"allow"}
    # A template whose labels are all alike has no need of further segments.
    assert {got[i]["template"] for i in range(100, 300)} == {"bad/*"}


def test_a_blocked_branch_among_very_many(spark):
    """However many branches a host has, one that differs keeps its verdict."""
    rules = [("block", "h.net", "/spam/1"), ("allow", "h.net", "/name")]
    rows = [(i, f"http://h.net/name{i % 200}x/{i}") for i in range(600)]
    rows += [(1000 + i, f"http://h.net/spam/{i}x") for i in range(100, 140)] + [(2000 + i, f"http://h.net/spam/z{i}") for i in range(20)]
    got = judged(spark, rows, rules=rules)
    assert {got[2000 + i]["verdict"] for i in range(20)} == {"block"}
    assert {got[2000 + i]["template"] for i in range(20)} == {"spam/*"}


def test_deep_paths(spark):
    """Labels that differ in the sixth segment only, and segments that all paths share."""
    rules = [("block", "h.net", "/a/b/c/d/e/bad/1"), ("allow", "h.net", "/a/b/c/d/e/good/1")]
    rows = [(i, f"http://h.net/a/b/c/d/e/{'bad' if i % 2 else 'good'}/{i}x/y") for i in range(100, 300)]
    rows += [(300, "http://h.net/a/b/c/d/e"), (301, "http://h.net/a/b/c/d/e/other/1"), (302, "http://h.net/~/*"), (303, "http://h.net" + "/x" * 5000)]
    got = judged(spark, rows, rules=rules)
    assert {got[i]["verdict"] for i in range(200, 300) if i % 2} == {"block"}
    assert {got[i]["verdict"] for i in range(200, 300, 2)} == {"allow"}
    # Branches without labels are like their siblings, so the way there is a wildcard.
    assert {got[i]["template"] for i in range(201, 300, 2)} == {"~/~/~/~/~/bad/*"}
    # Paths without labels go where most of their siblings go; their own "~" and "*" are no wildcards.
    assert {got[i]["template"] for i in (302, 303)} == {"~/~/~/~/~/~", "~/~/~/~/~/~/*"}


def test_repeated_rows(spark):
    rules = [("block", "h.net", "/b"), ("allow", "h.net", "/a")]
    rows = [(1, "http://h.net/b/x"), (1, "http://h.net/b/x"), (2, "http://h.net/a"), (3, "http://h.net/c"), (None, None), (None, None)]
    frame = spark.createDataFrame(rows, "page_id long, url string")
    assert U.filtered(frame, rules=rules).count() == 6


def test_similar_branches_are_merged(spark):
    rules = [("block", "h.net", "/a/b"), ("block", "h.net", "/c/b"), ("allow", "h.net", "/")]
    rows = [(i, f"http://h.net/{'ac'[i % 2]}/{'bd'[i // 2 % 2]}{i}") for i in range(80)]
    got = judged(spark, rows, rules=rules)
    assert {r["template"].split("/")[0] for r in got.values()} == {"~"}


def test_empty(spark):
    assert judged(spark, []) == {}
    assert judged(spark, [(1, "http://a.net/x")])[1]["verdict"] == "allow"
