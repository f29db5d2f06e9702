import json

from paylake.llm import tool_calls as T

SCHEMAS = {"get": {"x": ("integer", True), "after": ("call", False), "more": ("call", False)}, "put": {"s": ("string", False)}}
CALLS = "conv_id bigint, turn bigint, place int, call_id string, name string, arguments string, key string, label string"
RESULTS = "conv_id bigint, turn bigint, call_id string, content string, at string"


def formatted(spark, calls, results, schemas=SCHEMAS):
    frame = T.format_calls(
        spark.createDataFrame([(*c, "k", "l") for c in calls], CALLS),
        spark.createDataFrame([(*r, "z") for r in results], RESULTS), schemas,
    )
    return [(r["conv_id"], r["position"], r["call_id"], r["valid"], json.loads(r["record"]), r["record"])
            for r in frame.orderBy("conv_id", "position").collect()]


def test_links_validates_and_writes_canonically(spark):
    got = formatted(
        spark,
        [
            (1, 0, 0, "a", "get", '{"x": 1}'), (1, 2, 0, "b", "get", ' {"x" : 2,  "after":"a"} '),
            (1, 4, 0, "c", "get", '{"x": "2", "zz": null, "after": "gone"}'), (1, 5, 0, "d", "none", "{}"),
            (1, 6, 0, "e", "put", "not json"), (1, 7, 0, "f", "put", None), (1, 8, 0, "g", "put", '{"s": "é\\n\\"q\\""}'),
            (1, 8, 1, "g", "put", '{"s": "later"}'), (1, 9, 0, None, "put", "{}"),
        ],
        [(1, 1, "a", 'r "1"\n'), (1, 3, "b", None), (1, 9, "g", "done"), (1, 10, "lone", "x"), (1, 11, "g", "again"), (1, 12, None, "y")],
    )
    errors = {r[2]: r[4]["errors"] for r in got if r[2]}
    assert errors == {
        "a": [], "b": [], "c": ["type:x", "unknown:zz", "reference:gone"], "d": ["tool"], "e": ["arguments"],
        "f": ["arguments"], "g": [], "lone": [],
    }
    assert {r[2]: r[3] for r in got if r[2]} == {"a": True, "b": True, "c": False, "d": False, "e": False, "f": False, "g": True, "lone": False}
    by = {r[2]: r for r in got}
    assert by["b"][5] == '{"arguments":{"after":"a","x":2},"call_id":"b","errors":[],"name":"get","result":null}'
    assert by["g"][4]["arguments"] == {"s": 'é\n"q"'} and by["g"][4]["result"] == "done"
    assert by["e"][4]["arguments"] == "not json" and by["lone"][4]["name"] is None
    assert [r[1] for r in got] == list(range(10))
    for r in got:
        assert json.dumps(r[4], sort_keys=True, separators=(",", ":"), ensure_ascii=False) == r[5]


def test_order_puts_calls_after_what_they_need(spark):
    call = lambda conv, turn, place, name, after, more=None: (
        conv, turn, place, name, "get", json.dumps({"x": 1} | ({"after": after} if after else {}) | ({"more": more} if more else {}))
    )
    got = formatted(spark, [
        call(1, 1, 0, "a", "c"), call(1, 1, 1, "b", None), call(1, 1, 2, "c", "d"), call(1, 2, 0, "d", None),
        call(1, 2, 1, "e", "a", "b"), call(1, 3, 0, "f", "e"),
        call(2, 1, 0, "p", "q"), call(2, 1, 1, "q", "p"), call(2, 1, 2, "r", "r"), call(2, 2, 0, "s", None),
    ], [])
    order = [r[2] for r in got if r[0] == 1]
    place = {c: i for i, c in enumerate(order)}
    assert place["a"] > place["c"] > place["d"] and place["e"] > max(place["a"], place["b"]) and place["f"] > place["e"]
    assert order[0] == "b"
    assert [r[2] for r in got if r[0] == 2] == ["p", "q", "r", "s"]
    assert [r[4]["errors"] for r in got if r[0] == 2] == [["cycle"], ["cycle"], ["cycle"], []]


def test_long_chains_beside_a_cycle_take_few_rounds(spark, monkeypatch):
    """A chain of forward references, many short ones, and a cycle with calls that need it."""
    rounds = []
    keep = T.stored
    monkeypatch.setattr(T, "stored", lambda frame, name: (rounds.append(name), keep(frame, name))[1])
    call = lambda conv, turn, name, after: (conv, turn, 0, name, "get", json.dumps({"x": 1} | ({"after": after} if after else {})))
    n = 1000
    calls = [call(1, t, f"c{t}", f"c{t + 1}" if t < n - 1 else None) for t in range(n)]
    calls += [call(10 + k, t, f"d{t}", "d1" if t == 0 else None) for k in range(200) for t in range(2)]
    calls += [call(5, 0, "p", "q"), call(5, 1, "q", "p"), call(5, 2, "r", "p"), call(5, 3, "s", None)]
    got = formatted(spark, calls, [])
    assert [r[2] for r in got if r[0] == 1] == [f"c{t}" for t in range(n - 1, -1, -1)]
    assert all([r[2] for r in got if r[0] == 10 + k] == ["d1", "d0"] for k in range(200))
    assert [(r[2], r[4]["errors"]) for r in got if r[0] == 5] == [("p", ["cycle"]), ("q", ["cycle"]), ("r", ["cycle"]), ("s", [])]
    assert rounds.count("met") <= 12


def test_long_conversation_and_empty(spark):
    calls = [(5, t, 0, f"c{t}", "get", json.dumps({"x": t} | ({"after": f"c{t - 1}"} if t else {}))) for t in range(700)]
    got = formatted(spark, calls, [(5, 1, "c0", "r")])
    assert [r[2] for r in got] == [f"c{t}" for t in range(700)] and [r[1] for r in got] == list(range(700))
    assert formatted(spark, [], []) == []
    assert len(formatted(spark, [], [(1, 0, "a", "x")])) == 1


def test_turns_of_plain_conversations(spark):
    rows = [(1, 0, "system", "s"), (1, 1, "user", None), (1, 2, "assistant", "a"), (1, 3, "user", "x y"), (1, 3, "user", "x y"),
            (2, 0, "assistant", "alone"), (None, 0, "user", "n"), (3, 0, None, "t")]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    calls, results = T.from_turns(turns)
    got = T.format_calls(calls, results, T.TURN_TOOLS).collect()
    assert {(r["call_id"], r["valid"], r["copies"]) for r in got if r["conv_id"] == 1} == {
        ("c1-0", False, 1), ("c1-1", False, 2), ("c1-3", False, 2)
    }
    assert len(got) == 5
