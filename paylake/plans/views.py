"""The analyst views, full and limited.

Each view first counts the fact per dimension key and joins labels to those few
counts.  The fact itself is never joined: no shuffle of the fact, and a merchant
that owns a third of all transactions is one partial count per task.

Any view also takes a tally (see :func:`tally`) in place of the fact, so that
several views can share one pass.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paylake import schemas as S
from paylake.functions import percentage
from paylake.operators.privacy import masked_method, masked_provider, volume_class
from paylake.plans.gold import dim_payment_method, dim_payment_state

# State keys the views refer to, and the name of payments without a card.
SETTLED, FAILED, ABANDONED = 1, 3, 6
NEVER_COMPLETED = (FAILED, ABANDONED)
NO_CARD = "ACH transfer"
TALLY_KEYS = ["merchant_sk", "payment_method_sk", "hasPayment", "payment_state"]


def tally(fact: DataFrame) -> DataFrame:
    """The fact counted by everything the views look at; a drop-in for the fact."""
    return fact.groupBy(*TALLY_KEYS).agg(F.expr("count(*) AS _n"))


REACHED = "hasPayment = 1"
NOT_COMPLETED = f"hasPayment = 1 AND payment_state IN {NEVER_COMPLETED}"
METHOD_NAME = f"coalesce(nullif(payment_method_name, ''), '{NO_CARD}')"
MERCHANT_LABEL = "coalesce(merchant_name, cast(merchant_sk AS string))"


def _sum_where(rows: DataFrame, condition: str, name: str) -> Column:
    weight = "_n" if "_n" in rows.columns else "1L"
    return F.expr(f"sum(CASE WHEN {condition} THEN {weight} ELSE 0L END) AS {name}")


def _counts(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(
        _sum_where(rows, REACHED, "_reached"), _sum_where(rows, NOT_COMPLETED, "_failed")
    )


def _with_method(counts: DataFrame) -> DataFrame:
    methods = dim_payment_method(counts.sparkSession).selectExpr(
        "payment_method_sk AS _method_sk", "payment_method_name"
    )
    return counts.join(methods, F.expr("payment_method_sk = _method_sk"), "left")


def _with_merchant(counts: DataFrame, merchants: DataFrame) -> DataFrame:
    names = merchants.selectExpr("merchant_sk AS _merchant_sk", "merchant_name")
    return counts.join(names, F.expr("merchant_sk = _merchant_sk"), "left")


def _method(masked: bool) -> str:
    return masked_method("payment_method_name") if masked else METHOD_NAME


def _provider(masked: bool) -> str:
    return masked_provider("merchant_name") if masked else MERCHANT_LABEL


# ---- never reached ----------------------------------------------------------


def never_reached_psp_overall(fact: DataFrame) -> DataFrame:
    """Initiated payments without a payment, or whose state counts as not reached."""
    counts = fact.groupBy("hasPayment", "payment_state").agg(_sum_where(fact, "true", "_n"))
    states = dim_payment_state(fact.sparkSession).select("payment_state_sk", "is_payment_reached_provider")
    labelled = counts.join(states, F.expr("payment_state = payment_state_sk"), "left")
    unreached = "hasPayment = 0 OR coalesce(is_payment_reached_provider, 0) = 0"
    return labelled.agg(F.expr(
        f"coalesce(sum(CASE WHEN {unreached} THEN _n END), 0L) "
        "AS total_initiated_payments_never_reached_psp"
    ))


# ---- failure rates ----------------------------------------------------------


def payment_failure_rates(fact: DataFrame, merchants: DataFrame, masked: bool = False) -> DataFrame:
    """Per method and provider, only where something was not completed."""
    counts = _counts(fact.where(REACHED), "merchant_sk", "payment_method_sk")
    grouped = (
        _with_merchant(_with_method(counts), merchants)
        .groupBy(F.expr(f"{_method(masked)} AS payment_method"), F.expr(f"{_provider(masked)} AS provider"))
        .agg(F.expr("sum(_reached) AS _reached"), F.expr("sum(_failed) AS never_completed"))
        .where("never_completed > 0")
    )
    return grouped.selectExpr(
        "payment_method",
        "provider",
        f"{volume_class('_reached') if masked else '_reached'} AS reached_provider",
        "never_completed",
        f"{percentage('never_completed', '_reached')} AS never_complete_rate_pct",
    )


def payment_failure_rates_limited(fact: DataFrame, merchants: DataFrame) -> DataFrame:
    return payment_failure_rates(fact, merchants, masked=True)


def _rates(labelled: DataFrame, label: str, name: str) -> DataFrame:
    grouped = labelled.groupBy(F.expr(f"{label} AS {name}")).agg(
        F.expr("sum(_reached) AS total_reached_provider"),
        F.expr("sum(_failed) AS total_never_completed"),
    )
    rate = percentage("total_never_completed", "total_reached_provider")
    return grouped.selectExpr("*", f"{rate} AS never_complete_rate_pct")


def _worst_first(rates: DataFrame) -> DataFrame:
    return rates.orderBy(F.expr("never_complete_rate_pct").desc_nulls_last(), F.desc("total_reached_provider"))


def failure_rate_by_payment_method(fact: DataFrame, masked: bool = False) -> DataFrame:
    """Per method over all transactions; a method nothing reached has a NULL rate."""
    labelled = _with_method(_counts(fact, "payment_method_sk"))
    return _worst_first(_rates(labelled, _method(masked), "payment_method"))


def failure_rate_by_payment_method_limited(fact: DataFrame) -> DataFrame:
    return failure_rate_by_payment_method(fact, masked=True)


def failure_rate_by_payment_method_filtered(fact: DataFrame) -> DataFrame:
    """The dashboard's selection: methods with at least one payment that reached a provider."""
    return failure_rate_by_payment_method(fact).where("total_reached_provider > 0")


def failure_rate_by_provider(fact: DataFrame, merchants: DataFrame, masked: bool = False) -> DataFrame:
    """Per provider, only those something reached."""
    labelled = _with_merchant(_counts(fact, "merchant_sk"), merchants)
    rates = _rates(labelled, _provider(masked), "provider")
    return _worst_first(rates.where("total_reached_provider > 0"))


def failure_rate_by_provider_limited(fact: DataFrame, merchants: DataFrame) -> DataFrame:
    return failure_rate_by_provider(fact, merchants, masked=True)


# ---- abandonment ------------------------------------------------------------


def abandoned_by_merchant(fact: DataFrame, merchants: DataFrame, masked: bool = False) -> DataFrame:
    """Payments that got as far as strong customer authentication and no further."""
    stuck = fact.where(f"coalesce(hasPayment, 0) = 1 AND payment_state = {ABANDONED}")
    counts = stuck.groupBy("merchant_sk").agg(_sum_where(stuck, "true", "_n"))
    return (
        _with_merchant(counts, merchants)
        .groupBy(F.expr(f"{_provider(masked)} AS merchant"))
        .agg(F.expr("sum(_n) AS reached_then_abandoned"))
        .orderBy(F.desc("reached_then_abandoned"))
    )


def abandoned_by_merchant_limited(fact: DataFrame, merchants: DataFrame) -> DataFrame:
    return abandoned_by_merchant(fact, merchants, masked=True)


# ---- questions answered beyond the stored views ------------------------------


def match_rate_kpi(fact: DataFrame) -> DataFrame:
    """Share of initiated payments with a payment record; the goal is 90 percent."""
    totals = fact.agg(_sum_where(fact, "true", "initiated"), _sum_where(fact, REACHED, "matched"))
    return totals.selectExpr("*", f"{percentage('matched', 'initiated')} AS match_rate_pct")


def outcome_by_method(fact: DataFrame) -> DataFrame:
    """Initiated payments by method and outcome."""
    outcome = (
        f"CASE WHEN hasPayment = 0 THEN 'no_payment' WHEN payment_state = {SETTLED} THEN 'completed' "
        f"WHEN payment_state = {ABANDONED} THEN 'abandoned' ELSE 'other' END AS outcome"
    )
    counts = fact.groupBy("payment_method_sk", F.expr(outcome)).agg(_sum_where(fact, "true", "_n"))
    return (
        _with_method(counts)
        .groupBy(F.expr(f"{METHOD_NAME} AS payment_method"), "outcome")
        .agg(F.expr("sum(_n) AS payments"))
    )


def method_switches(silver_payments: DataFrame) -> DataFrame:
    """References paid with more than one method: how many, the first and the last.

    Methods are merged first, references second, so the state per reference is as
    small as the number of methods.
    """
    dated = silver_payments.where("reference IS NOT NULL AND card_type IS NOT NULL").selectExpr(
        "reference AS payment_reference", "card_type",
        f"struct(coalesce(updated_at, created_at) AS ts, transaction_id, {S.SNAPSHOT}) AS _at",
    ).where("_at.ts IS NOT NULL")
    per_method = dated.groupBy("payment_reference", "card_type").agg(
        F.expr("min(_at) AS _first"), F.expr("max(_at) AS _last")
    )
    per_reference = per_method.groupBy("payment_reference").agg(
        F.expr("count(*) AS methods"),
        F.expr("min_by(card_type, _first) AS first_method"),
        F.expr("max_by(card_type, _last) AS final_method"),
    )
    return per_reference.where("methods > 1").selectExpr(
        "*", "cast(first_method != final_method AS int) AS finalised_differently"
    )


def _completion(rows: DataFrame, *keys: str) -> DataFrame:
    totals = rows.groupBy(*keys).agg(
        F.expr("sum(_n) AS initiated"), F.expr("sum(_done) AS completed")
    )
    return totals.selectExpr("*", f"{percentage('completed', 'initiated')} AS completion_rate_pct")


def completion_by_weekday(fact: DataFrame) -> DataFrame:
    """Completed share by the weekday a payment was started on, Monday = 1; NULL without a time."""
    daily = fact.groupBy(F.expr(f"weekday({S.GATING_TS}) + 1 AS day_of_week")).agg(
        F.expr("count(*) AS _n"), F.expr(f"count_if(payment_state = {SETTLED}) AS _done")
    )
    weekend = daily.withColumn("is_weekend", F.expr("cast(day_of_week >= 6 AS int)"))
    return _completion(weekend, "day_of_week", "is_weekend")


def completion_by_hour(journeys: DataFrame, started_at: str, completed: str) -> DataFrame:
    """Completed share by the hour of day of ``started_at``; ``completed`` is a condition."""
    hourly = journeys.groupBy(F.expr(f"hour({started_at}) AS hour_of_day")).agg(
        F.expr("count(*) AS _n"), F.expr(f"count_if({completed}) AS _done")
    )
    return _completion(hourly, "hour_of_day")


# ---- roles ------------------------------------------------------------------

Builder = Callable[[DataFrame, DataFrame], DataFrame]

VIEWS: dict[str, Builder] = {
    "never_reached_psp_overall": lambda fact, merchants: never_reached_psp_overall(fact),
    "payment_failure_rates": payment_failure_rates,
    "payment_failure_rates_limited": payment_failure_rates_limited,
    "abandoned_by_merchant": abandoned_by_merchant,
    "abandoned_by_merchant_limited": abandoned_by_merchant_limited,
    "failure_rate_by_payment_method": lambda fact, merchants: failure_rate_by_payment_method(fact),
    "failure_rate_by_payment_method_limited":
        lambda fact, merchants: failure_rate_by_payment_method_limited(fact),
    "failure_rate_by_provider": failure_rate_by_provider,
    "failure_rate_by_provider_limited": failure_rate_by_provider_limited,
}

# Which role sees which view.
ROLES: dict[str, list[str]] = {
    "analyst_full": [
        "never_reached_psp_overall", "payment_failure_rates", "abandoned_by_merchant",
        "failure_rate_by_payment_method", "failure_rate_by_provider",
    ],
    "analyst_limited": [
        "never_reached_psp_overall", "payment_failure_rates_limited",
        "abandoned_by_merchant_limited", "failure_rate_by_payment_method_limited",
        "failure_rate_by_provider_limited",
    ],
}


def views_for_role(role: str, fact: DataFrame, merchants: DataFrame) -> dict[str, DataFrame]:
    """The views of ``role``, built on the fact or on a tally of it."""
    if role not in ROLES:
        raise ValueError(f"unknown role {role!r}; known: {sorted(ROLES)}")
    return {name: VIEWS[name](fact, merchants) for name in ROLES[role]}


def register_views(spark: SparkSession, role: str, fact: DataFrame, merchants: DataFrame) -> list[str]:
    """Make the views of ``role`` available to SQL in this session, and no others."""
    for name in VIEWS:
        spark.catalog.dropTempView(name)
    for name, view in views_for_role(role, fact, merchants).items():
        view.createOrReplaceTempView(name)
    return ROLES[role]
