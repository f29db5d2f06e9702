"""The star schema: four dimensions and one fact.

A transaction is matched to the final payment of its reference.  The reference
comes from the JSON details (three spellings) or, failing those, from the
reference column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paylake import schemas as S
from paylake.functions import blank_to_null, json_string, row_digest, seconds_between, surrogate_key
from paylake.operators.joins import lookup_join
from paylake.operators.latest import latest, latest_columns

# Calendar range, dimension rows, spellings of the JSON reference.
CALENDAR_START = "2000-01-01"
CALENDAR_END = "2040-12-31"
OPEN_END = "9999-12-31"
PAYMENT_METHODS = "(1, '1', 'Visa'), (2, '2', 'Mastercard'), (3, NULL, 'ACH transfer')"
PAYMENT_STATES = (
    "(1, 'settled', 1, 1), (2, 'initial', 0, 0), (3, 'failed', 1, 1), "
    "(4, 'voided', 1, 1), (5, 'refunded', 1, 1), (6, 'waiting_for_sca', 0, 0)"
)
REFERENCE_KEYS = ["payment_reference", "paymentReference", "reference"]


# ---- dimensions -------------------------------------------------------------


def dim_date(spark: SparkSession, start: str = CALENDAR_START, end: str = CALENDAR_END) -> DataFrame:
    """One row per calendar day, Monday = 1; no holiday calendar is known."""
    days = spark.range(1).selectExpr(f"explode(sequence(date '{start}', date '{end}')) AS full_date")
    return days.selectExpr(
        "cast(date_format(full_date, 'yyyyMMdd') AS int) AS date_key",
        "full_date",
        "year(full_date) AS year",
        "month(full_date) AS month",
        "day(full_date) AS day",
        "weekday(full_date) + 1 AS day_of_week",
        "cast(weekday(full_date) >= 5 AS int) AS is_weekend",
        "0 AS is_holiday",
    ).sortWithinPartitions("date_key")


def dim_payment_method(spark: SparkSession) -> DataFrame:
    return spark.sql(
        f"SELECT * FROM VALUES {PAYMENT_METHODS} "
        "AS t(payment_method_sk, original_value, payment_method_name)"
    )


def dim_payment_state(spark: SparkSession) -> DataFrame:
    """States 2 and 6 count as not having reached the provider.

    The abandonment view still reports state 6 with a payment as "reached, then
    abandoned"; both readings are kept as they are used.
    """
    return spark.sql(
        f"SELECT * FROM VALUES {PAYMENT_STATES} "
        "AS t(payment_state_sk, payment_state_name, is_final_state, is_payment_reached_provider)"
    )


def _latest(time: str, order: str, **columns: str) -> list[Column]:
    return [F.expr(f"{latest(value, time, order)} AS {name}") for name, value in columns.items()]


def dim_merchants(silver_merchants: DataFrame) -> DataFrame:
    """Current attributes per merchant: the latest non-NULL value of each, over all days."""
    staged = silver_merchants.where("merchant_id IS NOT NULL").selectExpr(
        "*", f"coalesce(updated_at, cast({S.SNAPSHOT} AS timestamp)) AS _ts"
    )
    merged = staged.groupBy("merchant_id").agg(
        *_latest(
            "_ts", f"struct(_ts, {S.SNAPSHOT})",
            merchant_name="merchant_name", merchant_state="state",
            acquirer_id="acquirer_id", updated_at_raw="updated_at",
        ),
        F.expr("max(_ts) AS _start"),
    )
    return merged.selectExpr(
        f"{surrogate_key('merchant_id')} AS merchant_sk",
        "merchant_id",
        "merchant_name",
        "merchant_state",
        "acquirer_id",
        "to_date(_start) AS scd_start_date",
        f"date '{OPEN_END}' AS scd_end_date",
        "updated_at_raw",
    )


# ---- fact -------------------------------------------------------------------


def referenced(silver_link_tx: DataFrame) -> DataFrame:
    """Each snapshot of a transaction with its reference and start in one column, ``_row``.

    The reference is read before any rows are shuffled, so the JSON text stays
    on the map side.
    """
    candidates = [blank_to_null(json_string("_document", key)) for key in REFERENCE_KEYS]
    candidates.append(blank_to_null("reference"))
    parsed = silver_link_tx.selectExpr(
        "transaction_id", "reference", "created_at", S.SNAPSHOT,
        "try_parse_json(details) AS _document",
    )
    return parsed.selectExpr(
        "transaction_id",
        f"struct(coalesce({', '.join(candidates)}) AS payment_reference, created_at AS tx_started_at) AS _row",
        S.SNAPSHOT,
    )


def payment_references(silver_link_tx: DataFrame) -> DataFrame:
    """(transaction_id, payment_reference, tx_started_at), latest snapshot per transaction."""
    newest = referenced(silver_link_tx).groupBy("transaction_id").agg(F.expr(f"max_by(_row, {S.SNAPSHOT}) AS _row"))
    return newest.select("transaction_id", "_row.*")


def payment_final(silver_payments: DataFrame) -> DataFrame:
    """State, method, merchant and time of the last payment per reference.

    Payments without a reference match nothing and are left out before the
    shuffle, where they would form one large group.
    """
    dated = silver_payments.where("reference IS NOT NULL").selectExpr(
        "*", "coalesce(updated_at, created_at) AS _ts"
    )
    aggregates, found = latest_columns(
        {"final_state": "payment_state", "final_method": "card_type", "final_merchant_id": "merchant_id"},
        "_ts", f"struct(_ts, transaction_id, {S.SNAPSHOT})", together=["final_state", "final_merchant_id"],
    )
    merged = dated.groupBy(F.expr("reference AS pay_reference")).agg(*aggregates, F.expr("max(_ts) AS final_state_ts"))
    return merged.select("pay_reference", *found, "final_state_ts")


def _with_keys(final: DataFrame, merchants: DataFrame, heavy_merchants: Sequence[int]) -> DataFrame:
    """Final payments with the dimension keys in place of the raw values.

    A NULL method keeps a NULL key: the method join is a plain equality, and the
    views name such payments themselves.
    """
    spark = final.sparkSession
    states = dim_payment_state(spark).selectExpr(
        "lower(payment_state_name) AS _state_name", "payment_state_sk AS payment_state"
    )
    methods = dim_payment_method(spark).select("original_value", "payment_method_sk")
    keys = merchants.selectExpr("merchant_id AS _merchant_id", "merchant_sk")
    known = (
        final.join(states, F.expr("lower(coalesce(final_state, '')) = _state_name"), "left")
        .join(methods, F.expr("final_method = original_value"), "left")
    )
    known = lookup_join(
        known, keys, "final_merchant_id", "_merchant_id", spread_by="pay_reference", heavy=heavy_merchants
    )
    return known.select(
        "pay_reference", "payment_state", "payment_method_sk", "merchant_sk", "final_state_ts"
    )


def shaped(
    transactions: DataFrame, final: DataFrame, merchants: DataFrame, heavy_merchants: Sequence[int] = ()
) -> DataFrame:
    """Fact rows of transactions and the final payments of their references."""
    matched = lookup_join(
        transactions, _with_keys(final, merchants, heavy_merchants), "payment_reference", "pay_reference",
        spread_by="transaction_id",
    )
    return matched.selectExpr(
        f"{row_digest('transaction_id', 'payment_reference')} AS sk",
        "transaction_id",
        "payment_reference",
        "cast(pay_reference IS NOT NULL AS int) AS hasPayment",
        "payment_state",
        "merchant_sk",
        "payment_method_sk",
        f"{seconds_between('tx_started_at', 'final_state_ts')} AS TimeFromStartToEndSeconds",
        f"tx_started_at AS {S.GATING_TS}",
    )


def fact_transactions(
    silver_link_tx: DataFrame,
    silver_payments: DataFrame,
    merchants: DataFrame,
    heavy_merchants: Sequence[int] = (),
) -> DataFrame:
    """The whole fact: one row per initiated payment, plus its start time (technical).

    ``heavy_merchants`` (see ``operators.joins.heavy_keys``) do not change the result; where
    payments are stored, finding them reads one column.
    """
    return shaped(
        payment_references(silver_link_tx), payment_final(silver_payments), merchants, heavy_merchants
    )
