"""Table contracts.  One definition serves table creation, loading and typing."""

from __future__ import annotations

from pyspark.sql import types as T

SNAPSHOT = "_snapshot_date"
INGESTED = "_ingested_at"
SOURCE_FILE = "_source_file"

LINEAGE = [
    T.StructField(INGESTED, T.TimestampType()),
    T.StructField(SOURCE_FILE, T.StringType()),
    T.StructField(SNAPSHOT, T.DateType()),
]
LINEAGE_COLUMNS = [field.name for field in LINEAGE]


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(name, T.StringType()) for name in names]


# Business columns of the raw files.
LINK_TX_COLUMNS = [
    "id", "created_at", "updated_at", "state", "linkpay_reference", "payment_details",
]
PAYMENT_COLUMNS = [
    "id", "merchant_id", "acquirer_id", "state", "card_type",
    "reference", "order_reference", "details", "created_at", "updated_at",
]
MERCHANT_COLUMNS = ["id", "acquirer_id", "name", "state", "created_at", "updated_at"]

BRONZE_LINK_TX = T.StructType(_strings(*LINK_TX_COLUMNS) + LINEAGE)
BRONZE_PAYMENTS = T.StructType(_strings(*PAYMENT_COLUMNS) + LINEAGE)
BRONZE_MERCHANTS = T.StructType(_strings(*MERCHANT_COLUMNS) + LINEAGE)

SILVER_LINK_TX = T.StructType([
    T.StructField("transaction_id", T.LongType()),
    T.StructField("state", T.StringType()),
    T.StructField("reference", T.StringType()),
    T.StructField("details", T.StringType()),
    T.StructField("created_at", T.TimestampType()),
    T.StructField("updated_at", T.TimestampType()),
    T.StructField(SNAPSHOT, T.DateType()),
])
SILVER_PAYMENTS = T.StructType([
    T.StructField("transaction_id", T.LongType()),
    T.StructField("merchant_id", T.LongType()),
    T.StructField("acquirer_id", T.LongType()),
    T.StructField("payment_state", T.StringType()),
    T.StructField("card_type", T.StringType()),
    T.StructField("reference", T.StringType()),
    T.StructField("order_reference", T.StringType()),
    T.StructField("details", T.StringType()),
    T.StructField("created_at", T.TimestampType()),
    T.StructField("updated_at", T.TimestampType()),
    T.StructField(SNAPSHOT, T.DateType()),
])
SILVER_MERCHANTS = T.StructType([
    T.StructField("merchant_id", T.LongType()),
    T.StructField(SNAPSHOT, T.DateType()),
    T.StructField("acquirer_id", T.LongType()),
    T.StructField("merchant_name", T.StringType()),
    T.StructField("state", T.StringType()),
    T.StructField("created_at", T.TimestampType()),
    T.StructField("updated_at", T.TimestampType()),
    T.StructField("dim_fingerprint", T.LongType()),
])

DIM_MERCHANTS = T.StructType([
    T.StructField("merchant_sk", T.LongType()),
    T.StructField("merchant_id", T.LongType()),
    T.StructField("merchant_name", T.StringType()),
    T.StructField("merchant_state", T.StringType()),
    T.StructField("acquirer_id", T.LongType()),
    T.StructField("scd_start_date", T.DateType()),
    T.StructField("scd_end_date", T.DateType()),
    T.StructField("updated_at_raw", T.TimestampType()),
])

# The fact carries its start time as a technical column, so that a later load
# can find the newest transaction it already holds; START_DAY is derived from it
# and partitions the stored table.
GATING_TS = "_gating_ts"
START_PERIOD = "_start_period"
FACT_COLUMNS = [
    "sk", "transaction_id", "payment_reference", "hasPayment", "payment_state",
    "merchant_sk", "payment_method_sk", "TimeFromStartToEndSeconds",
]
FACT_TRANSACTIONS = T.StructType([
    T.StructField("sk", T.StringType()),
    T.StructField("transaction_id", T.LongType()),
    T.StructField("payment_reference", T.StringType()),
    T.StructField("hasPayment", T.IntegerType()),
    T.StructField("payment_state", T.IntegerType()),
    T.StructField("merchant_sk", T.LongType()),
    T.StructField("payment_method_sk", T.IntegerType()),
    T.StructField("TimeFromStartToEndSeconds", T.LongType()),
    T.StructField(GATING_TS, T.TimestampType()),
])
