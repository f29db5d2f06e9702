"""Extracts from the typed staging lake to the reporting lake: full rebuilds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylake import schemas as S
from paylake.operators.joins import heavy_keys, lookup_join

SINCE = "2025-09-01 00:00:00"


def _since(frame: DataFrame, since: str) -> DataFrame:
    """Rows created at or after ``since``, compared in the column's own type so
    that the filter reaches the file scan."""
    return frame.where(F.col("created_at") >= F.lit(since).cast(frame.schema["created_at"].dataType))


def link_transactions(stage: DataFrame, since: str = SINCE) -> DataFrame:
    return _since(stage, since).select(*S.LINK_TX_COLUMNS)


def merchants(stage: DataFrame) -> DataFrame:
    return stage.select("id", "created_at", "updated_at", "acquirer_id", "name", "state")


def payments(stage_payments: DataFrame, stage_merchants: DataFrame, since: str = SINCE) -> DataFrame:
    """Payments of known merchants, with the merchant's acquirer in place of their own."""
    acquirers = stage_merchants.selectExpr("id AS _merchant", "acquirer_id")
    chosen = _since(stage_payments, since).drop("acquirer_id")
    joined = lookup_join(
        chosen, acquirers, "merchant_id", "_merchant",
        spread_by="id", heavy=heavy_keys(stage_payments, "merchant_id"), how="inner",
    )
    return joined.select(
        "id", "created_at", "updated_at", "merchant_id", "acquirer_id",
        "reference", "order_reference", "state", "card_type", "details",
    )
