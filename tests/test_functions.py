import datetime as dt

import pytest
from pyspark.sql import functions as F

from paylake.functions import (
    document_text,
    iso_seconds,
    json_string,
    parse_timestamp,
    parse_uint,
    percentage,
    seconds_between,
    surrogate_key,
)
from paylake.operators.privacy import masked_method, masked_provider, volume_class


def evaluate(spark, expression, values, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    result = rows.repartition(3).selectExpr("i", f"{expression} AS y").orderBy("i").collect()
    return [row.y for row in result]


def test_parse_uint(spark):
    texts = ["12", "007", "0", "9223372036854775807", "12.5", " 12", "12 ", "-3", "+3", "1 2",
             "18446744073709551615", "x", "1e3", "", "١٢", "\t5", "5\n", None]
    assert evaluate(spark, parse_uint("x"), texts) == [12, 7, 0, 9223372036854775807] + [None] * 14


def test_parse_uint_tries_no_cast_that_fails(spark):
    """A failing cast raises inside, and here outside, too."""
    texts = ["00009223372036854775807", "9223372036854775808", "0009999999999999999999", "0" * 30, "999999999999999999",
             "18446744073709551615", "1 2", "12.5", "1e3", "1٢3", "1\n"]
    cast = parse_uint("x").replace("try_cast", "cast")
    expected = [2**63 - 1, None, None, 0, 10**18 - 1] + [None] * 6
    assert evaluate(spark, cast, texts) == evaluate(spark, parse_uint("x"), texts) == expected


def test_parse_timestamp(spark):
    noon = dt.datetime(2025, 10, 1, 12, 0, 0)
    cases = {
        "2025-10-01 12:00:00": noon,
        "2025-10-01T12:00:00Z": noon,
        "2025-10-01T12:00:00.5+02:00": dt.datetime(2025, 10, 1, 10, 0, 0),
        "2025-10-01 12:00:00.999": noon,
        "2025-10-01": dt.datetime(2025, 10, 1),
        "1759320000": noon,
        "1759320000123": noon,
        "20251001120000": noon,
        "20251001": dt.datetime(2025, 10, 1),
        "01/10/2025 12:00:00": noon,
        "01/10/2025 12:00": noon,
        "01/10/2025": dt.datetime(2025, 10, 1),
        "01.10.2025 12:00:00": noon,
        "2025/10/01 12:00:00": noon,
        "01-10-2025": dt.datetime(2025, 10, 1), "01-10-2025 12:00:00": noon,
        "01/10/2025 12:00:00 PM": noon, "01/10/2025 1:02:03am": dt.datetime(2025, 10, 1, 1, 2, 3),
        "2025/10/01 12:00:00 AM": dt.datetime(2025, 10, 1),
        "1 Oct 2025": dt.datetime(2025, 10, 1), "01 Oct 2025 12:00:00": noon, "1 October 2025": dt.datetime(2025, 10, 1),
        "Wed, 01 Oct 2025 12:00:00": noon, "Oct 1, 2025": dt.datetime(2025, 10, 1), "Oct 1 2025 12:00:00": noon,
        "October 1, 2025": dt.datetime(2025, 10, 1), "Wednesday, October 1 2025": dt.datetime(2025, 10, 1),
        "1 Xyz 2025": None, "40 Oct 2025": None, "Wednesday": None,
        "x": None, "": None, "12:00": None, "2025": None, "2025-13-45": None,
        "2025-10-01 25:00:00": None, "32/10/2025": None,
    }
    assert evaluate(spark, parse_timestamp("x"), list(cases)) == list(cases.values())


def test_iso_seconds(spark):
    assert evaluate(spark, iso_seconds("x"), ["2025-10-01T12:00:00.5+02:00", " 2025-10-01 ", "?"]) == [
        "2025-10-01T10:00:00", "2025-10-01T00:00:00", None,
    ]


def test_json_string(spark):
    documents = ['{"k": "v"}', '{"k": ""}', '{"k": 5}', '{"a": "v"}', "bad", "[1]", "null",
                 '{"k": null}', '{"k": {"k": "v"}}', '{"k": "a", "k": "b"}', None]
    rows = spark.createDataFrame([(i, d) for i, d in enumerate(documents)], "i int, x string")
    got = rows.selectExpr("i", "try_parse_json(x) AS d").selectExpr("i", f"{json_string('d', 'k')} AS y")
    assert [r.y for r in got.orderBy("i").collect()] == [
        "v", "", None, None, None, None, None, None, None, "b", None,
    ]


def test_document_text(spark):
    texts = ['{"b": "é", "a": [1, 2]}', "[1]", '"abc"', "true", "5", "null", "bad", "", None]
    got = evaluate(spark, document_text("try_parse_json(trim(x))"), texts)
    assert got == ['{"a":[1,2],"b":"é"}', "[1]", "abc", "True", "5", None, None, None, None]


@pytest.mark.parametrize("part, whole, expected", [
    (1, 800, 0.12), (3, 800, 0.38), (1, 3, 33.33), (0, 5, 0.0), (5, 0, None), (None, 5, None),
])
def test_percentage(spark, part, whole, expected):
    rows = spark.createDataFrame([(part, whole)], "p bigint, w bigint")
    assert rows.selectExpr(f"{percentage('p', 'w')} AS y").first().y == expected


def test_seconds_between(spark):
    row = spark.sql(
        "SELECT timestamp '2025-10-01 00:00:00.9' a, timestamp '2025-10-01 00:00:01.1' b, "
        "cast(NULL AS timestamp) c"
    ).selectExpr(
        f"{seconds_between('a', 'b')} AS ab", f"{seconds_between('a', 'c')} AS ac",
        f"{seconds_between('b', 'a')} AS ba",
    ).first()
    assert (row.ab, row.ac, row.ba) == (1, None, -1)


def test_surrogate_key(spark):
    import hashlib

    row = spark.range(1).selectExpr(
        f"{surrogate_key('12')} AS one", f"{surrogate_key('12', 'cast(NULL AS string)')} AS two",
        f"{surrogate_key('1', '23')} AS split", f"{surrogate_key('12', '3')} AS other",
    ).first()
    assert row.one == int(hashlib.md5(b"12").hexdigest()[:15], 16)
    assert row.two == int(hashlib.md5(b"12|").hexdigest()[:15], 16)
    assert row.split != row.other


def test_masks(spark):
    assert evaluate(spark, masked_method("x"), ["Visa", "Mastercard", "ACH transfer", None]) == [
        "Payment_Method_A", "Payment_Method_B", "Other_Method", "Other_Method",
    ]
    masked = evaluate(spark, masked_provider("x"), ["abc", "abc", None])
    assert masked == ["Provider_BA7816", "Provider_BA7816", None]
    assert evaluate(spark, volume_class("x"), [0, 9, 10, 99, 100], "bigint") == [
        "Low_Volume", "Low_Volume", "Medium_Volume", "Medium_Volume", "High_Volume",
    ]


def test_concat_gives_null(spark):
    assert spark.range(1).select(F.expr("concat('a', NULL)")).first()[0] is None


def test_what_tasks_sort_is_bounded(spark, setting):
    """Splits and merged shuffle partitions stay small; smaller ones that a session has are kept."""
    from paylake import session

    for given, kept in (("128MB", 16 << 20), ("4m", 4 << 20)):
        for key in session.AT_MOST:
            setting(key, given)
        session._configured.discard(spark)
        session.configure(spark)
        assert {session._bytes(spark, spark.conf.get(key)) for key in session.AT_MOST} == {kept}
