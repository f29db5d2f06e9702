"""Chat formatting: links tool calls to their results and writes them in canonical JSON.

Calls and results are joined by conversation and identifier.  Arguments are checked
against the schemas of the tools; an argument of type ``call`` names another call that
this one depends on.  Within a conversation calls are put in an order in which each comes
after those it depends on: their own order wherever that is possible, and calls that
refer to later ones move behind them.  Only conversations with such a call are looked at.
In each round, a reference to a call that refers to one other is replaced by a reference to
that one, so a chain of n calls takes about log2(n) rounds.  Calls whose references are all
settled drop out; when a round settles none, those left lead into a cycle.  One record per
call or lone result is given, never a whole conversation, so a conversation may be of any length.

Canonical JSON has its keys sorted and no blanks.

Defined cases: the first call, or result, of an identifier counts, by turn, place and
content; repeated ones are counted in ``copies``.  NULL identifiers are never linked.
Arguments that are no JSON object are an error and are written as a text.  A result
without a call and a call without a result are records without the other.  References
to missing calls and cycles are errors; calls in a cycle, or that need one, keep their place.
Empty tables give no rows.  Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paylake.llm.common import stored

# Type names of schemas and how Spark names such a value.
TYPES = {
    "string": "STRING", "integer": "BIGINT", "number": "BIGINT|DOUBLE|DECIMAL.*", "boolean": "BOOLEAN",
    "object": "OBJECT<.*", "array": "ARRAY<.*", "call": "STRING",
}
Schemas = dict[str, dict[str, tuple[str, bool]]]

# Turns of a conversation that are numbered together.
TURNS_OF_A_RUN = 256


def _first(rows: DataFrame, content: list[str]) -> DataFrame:
    known = rows.where("conv_id IS NOT NULL AND call_id IS NOT NULL").groupBy("conv_id", "call_id").agg(
        F.min(F.struct("turn", *content)).alias("f"), F.count(F.lit(1)).alias("copies")
    ).select("conv_id", "call_id", "f.*", "copies")
    lone = rows.where("conv_id IS NULL OR call_id IS NULL").select(
        "conv_id", "call_id", "turn", *content, F.lit(1).cast("long").alias("copies")
    )
    return known.unionByName(lone)


def argument_errors(schemas: Schemas) -> Column:
    """What is wrong with ``arguments`` of the tool ``name``: an array of texts, sorted."""
    value = F.try_parse_json("arguments")
    is_object = F.coalesce(F.schema_of_variant(value).startswith("OBJECT<"), F.lit(False))
    keys = F.coalesce(F.json_object_keys("arguments"), F.array().cast("array<string>"))
    out = F.lit(None).cast("array<string>")
    for tool, fields in sorted(schemas.items()):
        found = []
        for name, (kind, required) in sorted(fields.items()):
            given = F.array_contains(keys, name)
            of_kind = F.schema_of_variant(F.try_variant_get(value, f"$.{name}", "variant")).rlike(f"^(?:{TYPES[kind]})$")
            found.append(F.when(given & ~F.coalesce(of_kind, F.lit(False)), F.lit(f"type:{name}")))
            if required:
                found.append(F.when(~given, F.lit(f"missing:{name}")))
        unknown = F.transform(
            F.array_except(keys, F.array(*[F.lit(n) for n in sorted(fields)]).cast("array<string>")),
            lambda k: F.concat(F.lit("unknown:"), k),
        )
        errors = F.array_sort(F.concat(F.array_compact(F.array(*found)) if found else F.array(), unknown))
        out = F.when(F.col("name") == tool, errors).otherwise(out)
    return F.when(~is_object, F.array(F.lit("arguments"))).otherwise(F.coalesce(out, F.array(F.lit("tool"))))


def references(calls: DataFrame, schemas: Schemas) -> DataFrame:
    """``conv_id, call_id, ref_id``: which calls a call depends on, by its arguments."""
    out = F.array().cast("array<string>")
    for tool, fields in sorted(schemas.items()):
        refs = [F.get_json_object("arguments", f"$.{n}") for n, (kind, _) in sorted(fields.items()) if kind == "call"]
        if refs:
            out = F.when(F.col("name") == tool, F.array_compact(F.array(*refs))).otherwise(out)
    return calls.where("conv_id IS NOT NULL AND call_id IS NOT NULL").select(
        "conv_id", "call_id", F.explode(F.array_distinct(out)).alias("ref_id")
    )


# More steps than any reference is counted as: in a cycle they double without an end.
MOST_STEPS = 1 << 40


def ordered(calls: DataFrame, edges: DataFrame) -> DataFrame:
    """``conv_id, call_id, at, in_cycle`` for calls that may move: ``at`` is (turn, place, level)."""
    key = ["conv_id", "call_id"]
    own = F.struct("turn", "place", F.lit(0).cast("long").alias("level"))
    spot = calls.where("conv_id IS NOT NULL AND call_id IS NOT NULL").select(*key, own.alias("at"))
    ref_spot = spot.select("conv_id", F.col("call_id").alias("ref_id"), F.col("at").alias("ref_at"))
    both = stored(edges.join(spot, key).join(ref_spot, ["conv_id", "ref_id"]), "references")
    moving = stored(both.where("ref_at >= at").select("conv_id").distinct(), "moving")
    links = stored(
        both.join(moving, "conv_id").select(*key, "ref_id", F.lit(1).cast("long").alias("steps")), "links"
    )
    places = stored(spot.join(links.select(*key).union(links.select("conv_id", "ref_id")).distinct(), key), "places")
    still = links.select(*key).distinct().count()
    while still:
        # What each call referred to is: its place so far, and its reference if it has just one.
        of_ref = links.groupBy(*key).agg(
            F.count(F.lit(1)).alias("refs"), F.min(F.struct("ref_id", "steps")).alias("next")
        )
        known = places.join(of_ref, key, "left").select(
            "conv_id", F.col("call_id").alias("ref_id"), F.col("at").alias("ref_at"),
            F.coalesce("refs", F.lit(0)).alias("refs"), "next",
        )
        met = stored(links.join(known, ["conv_id", "ref_id"]), "met")
        behind = F.struct(
            F.col("ref_at.turn").alias("turn"), F.col("ref_at.place").alias("place"),
            F.least(F.col("ref_at.level") + F.col("steps"), F.lit(MOST_STEPS)).alias("level"),
        )
        after = met.groupBy(*key).agg(F.max(behind).alias("after"))
        places = stored(
            places.join(after, key, "left").select(*key, F.greatest("at", F.coalesce("after", "at")).alias("at")), "places"
        )
        lone = F.col("refs") == 1
        links = stored(
            met.where("refs > 0").select(
                *key, F.when(lone, F.col("next.ref_id")).otherwise(F.col("ref_id")).alias("ref_id"),
                F.when(lone, F.least(F.col("steps") + F.col("next.steps"), F.lit(MOST_STEPS))).otherwise(F.col("steps")).alias("steps"),
            ).groupBy(*key, "ref_id").agg(F.max("steps").alias("steps")),
            "links",
        )
        left = links.select(*key).distinct().count()
        if left == still:
            break
        still = left
    stuck = links.select(*key).distinct().withColumn("stuck", F.lit(True))
    return places.join(stuck, key, "left").select(*key, "at", F.coalesce("stuck", F.lit(False)).alias("in_cycle"))


def format_calls(calls: DataFrame, results: DataFrame, schemas: Schemas) -> DataFrame:
    """One row per call or lone result: ``conv_id, position, call_id, valid, record``.

    ``calls`` has ``conv_id, turn, place, call_id, name, arguments`` (JSON), ``results``
    has ``conv_id, turn, call_id, content``.  ``position`` counts from 0 in a conversation.
    """
    calls = stored(_first(calls, ["place", "name", "arguments"]), "calls")
    results = _first(results, ["content"])
    edges = references(calls, schemas)
    known = calls.select("conv_id", F.col("call_id").alias("ref_id"))
    lost = edges.join(known, ["conv_id", "ref_id"], "left_anti").groupBy("conv_id", "call_id").agg(
        F.array_sort(F.collect_set(F.concat(F.lit("reference:"), "ref_id"))).alias("lost")
    )
    moved = ordered(calls, edges)
    none = F.array().cast("array<string>")
    described = (
        calls.withColumn("errors", argument_errors(schemas))
        .join(moved, ["conv_id", "call_id"], "left").join(lost, ["conv_id", "call_id"], "left")
        .withColumn("in_cycle", F.coalesce("in_cycle", F.lit(False)))
        .withColumn("errors", F.concat(
            "errors", F.coalesce("lost", none), F.when(F.col("in_cycle"), F.array(F.lit("cycle"))).otherwise(none)
        ))
        .withColumn("own", F.struct("turn", "place", F.lit(0).cast("long").alias("level")))
        .withColumn("at", F.when(F.col("at").isNull() | F.col("in_cycle"), F.col("own")).otherwise(F.col("at")))
    )
    of_results = results.select(
        F.col("conv_id").alias("r_conv"), F.col("call_id").alias("r_call"), F.col("turn").alias("r_turn"),
        "content", F.col("copies").alias("r_copies"),
    )
    same = (F.col("conv_id") == F.col("r_conv")) & (F.col("call_id") == F.col("r_call"))
    linked = described.join(of_results, same, "full_outer")
    is_call = F.col("copies").isNotNull()
    parsed = F.to_json(F.try_parse_json("arguments"))
    quoted = lambda c: F.when(F.col(c).isNotNull(), F.regexp_extract(F.to_json(F.array(c)), r"(?s)^.(.*).$", 1))
    record = F.concat(
        F.lit('{"arguments":'), F.coalesce(parsed, quoted("arguments"), F.lit("null")),
        F.lit(',"call_id":'), F.coalesce(quoted("call_id"), F.lit("null")),
        F.lit(',"errors":'), F.coalesce(F.to_json("errors"), F.lit("[]")),
        F.lit(',"name":'), F.coalesce(quoted("name"), F.lit("null")),
        F.lit(',"result":'), F.coalesce(quoted("content"), F.lit("null")), F.lit("}"),
    )
    rows = linked.select(
        F.coalesce("conv_id", "r_conv").alias("conv_id"), F.coalesce("call_id", "r_call").alias("call_id"),
        F.when(is_call, F.col("at")).otherwise(
            F.struct(F.col("r_turn").alias("turn"), F.lit(0).alias("place"), F.lit(0).cast("long").alias("level"))
        ).alias("at"),
        F.coalesce("own", F.struct(F.col("r_turn").alias("turn"), F.lit(0).alias("place"), F.lit(0).cast("long").alias("level"))).alias("own"),
        (is_call & F.col("r_copies").isNotNull() & (F.size("errors") == 0)).alias("valid"),
        (F.coalesce("copies", F.lit(0)) + F.coalesce("r_copies", F.lit(0))).alias("copies"),
        record.alias("record"),
    )
    # Numbered in two steps, so that a long conversation is many tasks.
    rows = stored(rows.withColumn("run", F.floor(F.coalesce("at.turn", F.lit(-1)) / TURNS_OF_A_RUN)), "records")
    within = Window.partitionBy("conv_id", "run").orderBy("at", "own", "call_id", "record")
    earlier = Window.partitionBy("conv_id").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    before = rows.groupBy("conv_id", "run").agg(F.count(F.lit(1)).alias("n")).select(
        F.col("conv_id").alias("b_conv"), F.col("run").alias("b_run"),
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"),
    )
    return (
        rows.withColumn("nth", F.row_number().over(within) - 1)
        .join(before, F.col("conv_id").eqNullSafe(F.col("b_conv")) & (F.col("run") == F.col("b_run")))
        .select("conv_id", (F.col("before") + F.col("nth")).alias("position"), "call_id", "valid", "copies", "record")
    )


# The tools that a plain conversation is read as using.
TURN_TOOLS: Schemas = {
    "answer": {"question": ("string", True), "words": ("integer", True), "after": ("call", False)},
    "configure": {"prompt": ("string", True)},
}


def from_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A plain conversation as calls and results.

    A user's turn calls ``answer`` and mostly depends on the call two turns before; by a rule of
    the conversation and the turn, some depend on the call two turns after, some on none, and some
    give their number of words as a text.  A system's turn calls ``configure``; an assistant's
    turn is the result of the turn before.
    """
    c = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text")
    call_id = lambda turn: F.concat(F.lit("c"), F.col("conv_id").cast("string"), F.lit("-"), turn.cast("string"))
    words = F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0))
    rule = F.coalesce(F.pmod(F.col("conv_id") * 31 + F.col("turn"), F.lit(7)), F.lit(6))
    after = F.when(rule.isin(0, 1, 2), call_id(F.col("turn") + 2)).when(
        (rule != 4) & (F.col("turn") >= 2), call_id(F.col("turn") - 2)
    )
    asked = lambda count: F.to_json(F.struct(F.col("text").alias("question"), count.alias("words"), after.alias("after")))
    calls = c.where("role IN ('user', 'system')").select(
        "conv_id", "turn", F.lit(0).alias("place"), call_id(F.col("turn")).alias("call_id"),
        F.when(F.col("role") == "user", "answer").otherwise("configure").alias("name"),
        F.when((F.col("role") == "user") & (rule == 5), asked(words.cast("string")))
        .when(F.col("role") == "user", asked(words))
        .otherwise(F.to_json(F.struct(F.col("text").alias("prompt")))).alias("arguments"),
    )
    results = c.where("role = 'assistant'").select(
        "conv_id", "turn", call_id(F.col("turn") - 1).alias("call_id"), F.col("text").alias("content")
    )
    return calls, results
