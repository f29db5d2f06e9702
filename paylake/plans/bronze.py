"""Daily files to bronze: text columns plus lineage, one partition per snapshot day."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from paylake import schemas as S
from paylake.functions import document_text, iso_seconds
from paylake.operators.merge import align
from paylake.sources.daily_files import DailyFiles, read_days
from paylake.sources.tables import read_landing

Day = str | dt.date
COLLECTION = "link_transactions_raw"


def payments(spark: SparkSession, files: DailyFiles, first: Day, last: Day | None = None) -> DataFrame:
    return read_days(spark, files, first, last, S.BRONZE_PAYMENTS)


def merchants(spark: SparkSession, files: DailyFiles, first: Day, last: Day | None = None) -> DataFrame:
    return read_days(spark, files, first, last, S.BRONZE_MERCHANTS)


def landed_link_transactions(rows: DataFrame) -> DataFrame:
    """Raw link transactions as documents: six fixed columns, readable JSON, ISO times."""
    parsed = align(rows, S.BRONZE_LINK_TX).selectExpr(
        "*", "try_parse_json(trim(payment_details)) AS _document"
    )
    return parsed.selectExpr(
        "id",
        f"{iso_seconds('created_at')} AS created_at",
        f"{iso_seconds('updated_at')} AS updated_at",
        "state",
        "linkpay_reference",
        f"{document_text('_document')} AS payment_details",
        *S.LINEAGE_COLUMNS,
    )


def land_link_transactions(
    spark: SparkSession, files: DailyFiles, first: Day, last: Day | None = None
) -> DataFrame:
    return landed_link_transactions(read_days(spark, files, first, last, S.BRONZE_LINK_TX))


def _bronze(landed: DataFrame, label: str) -> DataFrame:
    return landed.selectExpr(
        *S.LINK_TX_COLUMNS,
        f"current_timestamp() AS {S.INGESTED}",
        f"{label} AS {S.SOURCE_FILE}",
        S.SNAPSHOT,
    )


def link_transactions_day(spark: SparkSession, landing: str, day: Day) -> DataFrame:
    """One landed day."""
    landed = read_landing(spark, landing, S.BRONZE_LINK_TX, day)
    return _bronze(landed, f"'landing:{COLLECTION}:{day}'")


def link_transactions_days(spark: SparkSession, landing: str, first: Day, last: Day) -> DataFrame:
    """A range of landed days in one scan, each row labelled with its day."""
    landed = read_landing(spark, landing, S.BRONZE_LINK_TX, first, last)
    return _bronze(landed, f"concat('landing:{COLLECTION}:', {S.SNAPSHOT})")


def link_transactions_full(spark: SparkSession, landing: str, run_day: Day) -> DataFrame:
    """Everything ever landed, as one snapshot of ``run_day``."""
    landed = read_landing(spark, landing, S.BRONZE_LINK_TX).drop(S.SNAPSHOT)
    return _bronze(
        landed.selectExpr("*", f"date '{run_day}' AS {S.SNAPSHOT}"), f"'landing:{COLLECTION}:ALL'"
    )
