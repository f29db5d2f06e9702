import pytest

from paylake.plans import views
from paylake.queries import _fact, _merchants, _stored


@pytest.fixture(scope="module")
def gold_tables(spark, sf_dir):
    return _stored(_fact(spark, sf_dir), "fact"), _stored(_merchants(spark, sf_dir), "merchants")


def collected(frame):
    return sorted(map(str, frame.collect()))


def test_measured_values(gold_tables, sf_dir):
    if not sf_dir.endswith("sf0.001"):
        pytest.skip("values of sf0.001")
    fact, merchants = gold_tables
    totals = fact.selectExpr(
        "count(*)", "count(distinct sk)", "sum(hasPayment)", "count(merchant_sk)",
        "count(payment_method_sk)", "sum(TimeFromStartToEndSeconds)",
    ).first()
    assert tuple(totals) == (1500, 1500, 1424, 1334, 1371, 89673091200)
    states = {r.payment_state: r["count"] for r in fact.groupBy("payment_state").count().collect()}
    assert states == {1: 223, 2: 234, 3: 257, 4: 251, 5: 217, 6: 242, None: 76}
    assert views.never_reached_psp_overall(fact).first()[0] == 552
    assert views.match_rate_kpi(fact).first().match_rate_pct == 94.93
    methods = {
        r.payment_method: (r.total_reached_provider, r.total_never_completed, r.never_complete_rate_pct)
        for r in views.failure_rate_by_payment_method(fact).collect()
    }
    assert methods == {
        "Visa": (815, 286, 35.09), "Mastercard": (556, 195, 35.07), "ACH transfer": (53, 18, 33.96),
    }
    classes = views.payment_failure_rates_limited(fact, merchants).groupBy("reached_provider").count()
    assert {r.reached_provider: r["count"] for r in classes.collect()} == {
        "Low_Volume": 8, "Medium_Volume": 19, "High_Volume": 1,
    }


def test_full_and_limited_agree_on_totals(gold_tables):
    fact, merchants = gold_tables
    for full, limited, column in (
        (views.failure_rate_by_provider, views.failure_rate_by_provider_limited, "total_reached_provider"),
        (views.abandoned_by_merchant, views.abandoned_by_merchant_limited, "reached_then_abandoned"),
        (views.payment_failure_rates, views.payment_failure_rates_limited, "never_completed"),
    ):
        assert (
            full(fact, merchants).selectExpr(f"sum({column})").first()[0]
            == limited(fact, merchants).selectExpr(f"sum({column})").first()[0]
        )


def test_views_agree_with_the_fact(gold_tables):
    fact, merchants = gold_tables
    abandoned = views.abandoned_by_merchant(fact, merchants).selectExpr("sum(reached_then_abandoned)").first()[0]
    assert abandoned == fact.where("hasPayment = 1 AND payment_state = 6").count()
    reached = views.failure_rate_by_provider(fact, merchants).selectExpr("sum(total_reached_provider)").first()[0]
    assert reached == fact.where("hasPayment = 1").count()


@pytest.mark.parametrize("name", sorted(views.VIEWS))
def test_a_tally_replaces_the_fact(gold_tables, name):
    fact, merchants = gold_tables
    assert collected(views.VIEWS[name](views.tally(fact), merchants)) == collected(
        views.VIEWS[name](fact, merchants)
    )


def test_order(gold_tables):
    fact, merchants = gold_tables
    rates = [
        (r.never_complete_rate_pct, r.total_reached_provider)
        for r in views.failure_rate_by_provider(fact, merchants).collect()
    ]
    assert rates == sorted(rates, key=lambda pair: (-pair[0], -pair[1]))


def test_null_rates_come_last(spark):
    fact = spark.sql(
        "SELECT 1L merchant_sk, m payment_method_sk, h hasPayment, s payment_state "
        "FROM VALUES (1, 1, 1), (2, 0, NULL) AS t(m, h, s)"
    )
    rows = views.failure_rate_by_payment_method(fact).collect()
    assert [(r.payment_method, r.never_complete_rate_pct) for r in rows] == [("Visa", 0.0), ("Mastercard", None)]
    assert [r.payment_method for r in views.failure_rate_by_payment_method_filtered(fact).collect()] == ["Visa"]


def test_empty_fact(spark, gold_tables):
    fact, merchants = gold_tables
    empty = fact.where("false")
    assert views.never_reached_psp_overall(empty).first()[0] == 0
    assert views.failure_rate_by_provider(empty, merchants).count() == 0


def test_roles_see_only_their_views(spark, gold_tables):
    fact, merchants = gold_tables
    names = views.register_views(spark, "analyst_limited", views.tally(fact), merchants)
    present = {t.name for t in spark.catalog.listTables() if t.isTemporary}
    assert set(names) <= present and "failure_rate_by_provider" not in present
    assert spark.sql("SELECT * FROM never_reached_psp_overall").count() == 1
    views.register_views(spark, "analyst_full", views.tally(fact), merchants)
    present = {t.name for t in spark.catalog.listTables() if t.isTemporary}
    assert "failure_rate_by_provider" in present and "failure_rate_by_provider_limited" not in present
    with pytest.raises(ValueError):
        views.views_for_role("intern", fact, merchants)
