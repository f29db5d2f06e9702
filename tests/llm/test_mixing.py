from paylake.llm import mixing as M


def test_edges_and_bounds(make_docs, prose, odd):
    rows = [(i, prose(50 + i % 7, i), f"s{i % 5}") for i in range(300)]
    rows += [(i, prose(40, i), "s0") for i in range(300, 700)] + [(700 + i, prose(30, i), None) for i in range(90)]
    rows += [(*r, "s1") for r in odd] + rows[:5]
    docs = make_docs(rows)
    got = M.mix(docs).collect()
    assert len(got) == len(rows)
    assert sum(r["size"] for r in got) == sum(len((r[1] or "").split()) for r in rows)
    taken, target = {}, {}
    for r in got:
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
        target[r["source"]] = r["target"]
    total = sum(r["size"] for r in got)
    assert abs(sum(target.values()) - total) < 1e-6 * total
    for source, words in taken.items():
        assert target[source] - 1 < words <= target[source]
    assert sorted(map(str, got)) == sorted(map(str, M.mix(docs.repartition(7)).collect()))


def test_sources_smaller_than_a_block(make_docs, prose):
    """Sources of few words come as near their target as large ones, whatever the block."""
    sizes = [("a", 200), ("b", 1), ("c", 2), ("d", 10), ("e", 65), ("f", 100), ("g", 64), ("h", 5000), (None, 128)]
    rows = [(i, prose(n, i), s) for i, (s, n) in enumerate(sizes)]
    for block in (1, 7, 64, 1000):
        got = M.mix(make_docs(rows), block).collect()
        for r in got:
            assert r["target"] - 1 < r["taken"] <= min(r["target"], 3 * r["size"]), (block, r)


def test_many_rows_without_an_id_and_many_copies(make_docs, prose, monkeypatch):
    from paylake.llm import common

    monkeypatch.setattr(common, "COPIES_AT_ONCE", 10)
    rows = [(None, prose(20, i), "s") for i in range(300)] + [(None, "one two three", "s")] * 200 + [(1, "x y", "t")] * 35
    docs = make_docs(rows)
    places = {r["place"] for r in docs.selectExpr("md5(text) AS place").distinct().collect()}
    got = M.mix(docs).collect()
    assert len(got) == len(rows) and len(places) == 302
    for source in "st":
        part = [r for r in got if r["source"] == source]
        assert part[0]["target"] - 1 < sum(r["taken"] for r in part) <= part[0]["target"]
        assert all(r["taken"] <= 3 * r["size"] for r in part)
    assert sorted(map(str, got)) == sorted(map(str, M.mix(docs.repartition(5)).collect()))


def test_very_long_text(make_docs):
    docs = make_docs([(1, "w " * 300_000, "s"), (2, "a b c", "s"), (3, "d", "t")])
    got = {r["doc_id"]: r for r in M.mix(docs).collect()}
    assert got[1]["size"] == 300_000 and got[1]["taken"] + got[2]["taken"] == int(got[1]["target"])


def test_targets_stop_at_three_times_the_size(spark):
    sizes = [("a", 100000), ("b", 10), ("c", 2000), ("d", 0), (None, 50)]
    rows = M.source_targets(spark.createDataFrame(sizes, "source string, size bigint")).collect()
    got = {r["source"]: (r["weight"], r["target"]) for r in rows}
    assert {s: w for s, (w, _) in got.items()} == {"a": 1, "b": 2, "c": 3, "d": 1, None: 2}
    assert (got["b"][1], got["c"][1], got["d"][1], got[None][1]) == (30, 6000, 0, 150)
    assert got["a"][1] == 102060 - 6180


def test_empty(make_docs, odd):
    assert M.mix(make_docs([])).count() == 0
    wordless = [r for r in odd if not (r[1] or "").strip()]
    assert [(r["size"], r["taken"]) for r in M.mix(make_docs(wordless)).collect()] == [(0, 0)] * 3


def test_schedule_keeps_proportions_in_every_stretch(spark):
    sizes = spark.createDataFrame([("a", 60000), ("b", 60000), ("c", 60000)], "source string, size bigint")
    slots = M.schedule(M.source_targets(sizes), 10).orderBy("slot").collect()
    assert [r["slot"] for r in slots] == list(range(18000))
    for at in (0, 5000, 17000):
        part = [r["number"] for r in slots[at : at + 600]]
        assert [abs(part.count(k) - 100 * (k + 1)) <= 4 for k in range(3)] == [True] * 3
    for number in range(3):
        assert [r["rank"] for r in slots if r["number"] == number] == list(range(len([r for r in slots if r["number"] == number])))
