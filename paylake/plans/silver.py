"""Bronze text rows to typed silver rows: one per id and snapshot day.

Rows of one id and day are merged column by column: the latest non-NULL value by
load time wins.  Load time has second resolution and is the same for all rows of
a file, so ties are settled by the update time, the creation time and a hash of
the row; the result does not depend on partitioning.

The partial results that cross the shuffle hold the order once for the columns
that rows usually have all of, and once for each other column.  Times are parsed
before the aggregate: the order is four 8-byte numbers, not texts.

Rows without a usable id are left out here; ``operators.quality.rejected_ids``
gives them back.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from paylake import schemas as S
from paylake.functions import blank_to_null, merchant_fingerprint, parse_timestamp, parse_uint
from paylake.operators.latest import dominant_values, latest_columns
from paylake.operators.merge import align
from paylake.sources.tables import of_days

Day = str | dt.date
PAYMENT_KEY = ["transaction_id", S.SNAPSHOT]
LINK_TX_KEY = ["transaction_id", S.SNAPSHOT]
MERCHANT_KEY = ["merchant_id", S.SNAPSHOT]


def _typed(
    bronze: DataFrame,
    key: str,
    columns: list[str],
    hashed: list[str],
    tiebreak: list[str] | None,
) -> DataFrame:
    """Rows with a usable id, their typed columns, parsed times and order."""
    last = ", ".join(tiebreak) if tiebreak else f"xxhash64({', '.join(hashed)})"
    parsed = bronze.selectExpr(
        f"{parse_uint('id')} AS {key}",
        *columns,
        "created_at IS NOT NULL AS _has_created",
        "updated_at IS NOT NULL AS _has_updated",
        f"{parse_timestamp('created_at')} AS _created",
        f"{parse_timestamp('updated_at')} AS _updated",
        S.INGESTED,
        S.SNAPSHOT,
        f"{last} AS _last" if not tiebreak else f"struct({last}) AS _last",
    )
    return parsed.where(f"{key} IS NOT NULL").selectExpr(
        "*", f"struct({S.INGESTED}, _updated, _created, _last) AS _order"
    )


def _merged(rows: DataFrame, key: list[str], columns: list[str], together: list[str]) -> DataFrame:
    """One row per key: the latest value of each column and of both times.

    A time is the parsed form of the latest text: NULL if that is unreadable, even if an earlier
    one is not.
    """
    times = ("created", "updated")
    aggregates, found = latest_columns(
        {name: name for name in columns} | {f"{name}_at": f"_{name}" for name in times}, S.INGESTED, "_order",
        together, {f"{name}_at": f"_has_{name}" for name in times},
    )
    return rows.groupBy(*key).agg(*aggregates).select(*key, *found)


def link_transactions(
    bronze: DataFrame,
    first: Day | None = None,
    last: Day | None = None,
    tiebreak: list[str] | None = None,
) -> DataFrame:
    """Initiated payments."""
    rows = _typed(
        of_days(bronze, first, last), "transaction_id",
        ["state", "linkpay_reference AS reference", "payment_details AS details"],
        S.LINK_TX_COLUMNS, tiebreak,
    )
    merged = _merged(rows, LINK_TX_KEY, ["state", "reference", "details"], ["state", "reference", "created_at"])
    return merged.select(S.SILVER_LINK_TX.fieldNames())


def payments(
    bronze: DataFrame,
    first: Day | None = None,
    last: Day | None = None,
    tiebreak: list[str] | None = None,
) -> DataFrame:
    """Real payments; merchant and acquirer are the dominant values of the merged rows."""
    rows = _typed(
        of_days(bronze, first, last), "transaction_id",
        [
            f"{parse_uint('merchant_id')} AS merchant_id",
            f"{parse_uint('acquirer_id')} AS acquirer_id",
            "state AS payment_state", "card_type", "reference", "order_reference", "details",
        ],
        S.PAYMENT_COLUMNS, tiebreak,
    )
    merged = _merged(
        rows, PAYMENT_KEY, ["payment_state", "card_type", "reference", "order_reference", "details"],
        ["payment_state", "reference", "order_reference", "details", "created_at"],
    )
    # Both sides are already partitioned by the key: the join adds no shuffle.
    dominant = dominant_values(rows, PAYMENT_KEY, ["merchant_id", "acquirer_id"])
    return merged.join(dominant, PAYMENT_KEY, "left").select(S.SILVER_PAYMENTS.fieldNames())


def merchants(
    bronze: DataFrame,
    first: Day | None = None,
    last: Day | None = None,
    tiebreak: list[str] | None = None,
) -> DataFrame:
    """Merchants with a fingerprint of their attributes.

    While bronze lacks one of the columns needed, the result is empty but fully
    typed, so that everything built on it keeps working.
    """
    needed = {"id", "name", "state", "created_at", "updated_at", S.INGESTED, S.SNAPSHOT}
    if not needed <= set(bronze.columns):
        return align(bronze.where("false").select(), S.SILVER_MERCHANTS)
    if "acquirer_id" not in bronze.columns:
        bronze = bronze.selectExpr("*", "cast(NULL AS string) AS acquirer_id")
    rows = _typed(
        of_days(bronze, first, last), "merchant_id",
        [
            f"{parse_uint('acquirer_id')} AS acquirer_id",
            f"{blank_to_null('name')} AS merchant_name",
            "state",
        ],
        S.MERCHANT_COLUMNS, tiebreak,
    )
    merged = _merged(rows, MERCHANT_KEY, ["acquirer_id", "merchant_name", "state"], ["acquirer_id", "state", "created_at"])
    fingerprint = f"{merchant_fingerprint()} AS dim_fingerprint"
    return merged.selectExpr("*", fingerprint).select(S.SILVER_MERCHANTS.fieldNames())
