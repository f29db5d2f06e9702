"""Small hand-made bronze rows."""

from __future__ import annotations

import datetime as dt

from paylake import schemas as S

DAY_1, DAY_2, DAY_3 = (dt.date(2025, 10, day) for day in (1, 2, 3))
LOADED = dt.datetime(2025, 10, 1, 6, 0, 0)


def _frame(spark, contract, rows):
    defaults = {S.INGESTED: LOADED, S.SOURCE_FILE: "f.csv", S.SNAPSHOT: DAY_1}
    return spark.createDataFrame(
        [tuple({**defaults, **row}.get(name) for name in contract.fieldNames()) for row in rows],
        contract,
    )


def payments(spark, *rows):
    return _frame(spark, S.BRONZE_PAYMENTS, rows)


def link_transactions(spark, *rows):
    return _frame(spark, S.BRONZE_LINK_TX, rows)


def merchants(spark, *rows):
    return _frame(spark, S.BRONZE_MERCHANTS, rows)


def at(second):
    return LOADED + dt.timedelta(seconds=second)
