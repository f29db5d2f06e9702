"""Bronze rows and staging rows derived from the test tables.

Used by the registered queries, the tests and the benchmark.  Every row of the
source tables takes part; the remainders below only decide which variant of a
field a row gets (card type, JSON shape, missing merchant, ...).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from paylake import schemas as S
from paylake.session import configure

FIRST_DAY = "2025-10-01"
SECOND_DAY = "2025-10-02"
LAST_DAY = "2025-10-07"
DAYS = 7
# Columns that settle ties between payment rows with the same creation time.
PAYMENT_TIEBREAK = ["_part", "_price"]
# The extracts' time cutoff that suits the dates of the test tables.
EXTRACT_SINCE = "1998-01-01 00:00:00"

# The columns used of each table; with a schema Spark opens no file
# to find one.
TABLES = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_extendedprice double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_orderstatus string, o_orderdate timestamp_ntz",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "events": "event_id bigint, ts timestamp_ntz, event_type string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def _text(name: str) -> str:
    return f"cast({name} AS string) AS {name}"


def _snapshot(key: str) -> str:
    return f"date_add(date '{FIRST_DAY}', cast({key} % {DAYS} AS int)) AS {S.SNAPSHOT}"


# ---- payments <- lineitem ---------------------------------------------------


def _payments(items: DataFrame) -> DataFrame:
    """One raw payment per line item.  (order, line number) repeats, so ids do too."""
    return items.selectExpr(
        "l_orderkey * 10 + l_linenumber AS id",
        # No supplier has such a key: payments of unknown merchants.
        "CASE WHEN l_suppkey % 23 = 0 THEN l_suppkey + 10000000 ELSE l_suppkey END AS merchant_id",
        "l_suppkey % 5 AS acquirer_id",
        "CASE concat(l_returnflag, l_linestatus) WHEN 'AF' THEN 'settled' WHEN 'AO' THEN 'initial' "
        "WHEN 'RF' THEN 'refunded' WHEN 'RO' THEN 'failed' WHEN 'NF' THEN 'voided' "
        "WHEN 'NO' THEN 'WAITING_FOR_SCA' END AS state",
        "CASE l_linenumber % 3 WHEN 1 THEN '1' WHEN 2 THEN '2' END AS card_type",
        "concat('PAY-', l_orderkey) AS reference",
        "concat('ORD-', l_orderkey) AS order_reference",
        "concat('{\"part\": ', l_partkey, '}') AS details",
        "l_shipdate AS created_at",
        "CASE WHEN l_linenumber % 2 = 0 THEN l_shipdate + interval 1 day END AS updated_at",
        _snapshot("l_orderkey"),
        "l_partkey AS _part",
        "l_extendedprice AS _price",
    )


def stage_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payments as the staging lake holds them, with types."""
    return _payments(table(spark, sf_dir, "lineitem")).select(*S.PAYMENT_COLUMNS)


def bronze_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _payments(table(spark, sf_dir, "lineitem")).selectExpr(
        _text("id"), _text("merchant_id"), _text("acquirer_id"),
        "state", "card_type", "reference", "order_reference", "details",
        _text("created_at"), _text("updated_at"),
        f"cast(created_at AS timestamp) AS {S.INGESTED}",
        f"'lineitem' AS {S.SOURCE_FILE}",
        S.SNAPSHOT,
        *PAYMENT_TIEBREAK,
    )


# ---- link transactions <- orders --------------------------------------------


def _link_transactions(orders: DataFrame) -> DataFrame:
    """One initiated payment per order, with six shapes of the JSON details."""
    return orders.selectExpr(
        "o_orderkey AS id",
        "o_orderdate AS created_at",
        "CASE WHEN o_orderkey % 50 = 1 THEN o_orderdate - interval 1 day "
        "WHEN o_orderkey % 4 != 0 THEN o_orderdate + interval 1 day END AS updated_at",
        "o_orderstatus AS state",
        "CASE WHEN o_orderkey % 10 != 0 THEN concat('PAY-', o_orderkey) END AS linkpay_reference",
        "CASE o_orderkey % 6 "
        "WHEN 0 THEN concat('{\"payment_reference\": \"PAY-', o_orderkey, '\"}') "
        "WHEN 1 THEN concat('{\"paymentReference\": \"PAY-', o_orderkey, '\"}') "
        "WHEN 2 THEN concat('{\"reference\": \"PAY-', o_orderkey, '\"}') "
        "WHEN 3 THEN concat('{\"payment_reference\": ', o_orderkey, '}') "
        "WHEN 4 THEN 'not json' END AS payment_details",
        _snapshot("o_orderkey"),
    )


def stage_link_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _link_transactions(table(spark, sf_dir, "orders")).select(*S.LINK_TX_COLUMNS)


def bronze_link_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _link_transactions(table(spark, sf_dir, "orders")).selectExpr(
        _text("id"), _text("created_at"), _text("updated_at"),
        "state", "linkpay_reference", "payment_details",
        f"cast(created_at AS timestamp) AS {S.INGESTED}",
        f"'orders' AS {S.SOURCE_FILE}",
        S.SNAPSHOT,
    )


# ---- merchants <- supplier --------------------------------------------------


def stage_merchants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The merchants' first snapshot."""
    return table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey AS id",
        "cast(s_nationkey AS bigint) AS acquirer_id",
        "CASE WHEN s_suppkey % 17 = 0 THEN '' ELSE s_name END AS name",
        "CASE WHEN s_acctbal < 0 THEN 'blocked' ELSE 'active' END AS state",
        "timestamp_ntz '2025-09-01 00:00:00' AS created_at",
        "CASE WHEN s_suppkey % 5 != 0 THEN timestamp_ntz '2025-10-01 00:00:00' END AS updated_at",
    )


def bronze_merchants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two snapshots in one scan; the second renews the even keys one day later."""
    return (
        stage_merchants(spark, sf_dir)
        .selectExpr("*", "explode(array(0, 1)) AS _later")
        .where("_later = 0 OR id % 2 = 0")
        .selectExpr(
            _text("id"), _text("acquirer_id"), "name",
            "CASE _later WHEN 1 THEN 'renewed' ELSE state END AS state",
            _text("created_at"),
            "cast(updated_at + make_dt_interval(_later) AS string) AS updated_at",
            f"timestamp '{FIRST_DAY}' AS {S.INGESTED}",
            f"'supplier' AS {S.SOURCE_FILE}",
            f"date_add(date '{FIRST_DAY}', _later) AS {S.SNAPSHOT}",
        )
    )


def with_unusable_ids(bronze: DataFrame) -> DataFrame:
    """The same rows, some with an id that must not reach silver."""
    spoiled = (
        "CASE cast(id AS bigint) % 11 WHEN 0 THEN concat(' ', id) WHEN 1 THEN concat('-', id) "
        "WHEN 2 THEN concat(id, '.5') WHEN 3 THEN '18446744073709551615' WHEN 4 THEN NULL "
        "ELSE id END AS id"
    )
    others = [name for name in bronze.columns if name != "id"]
    return bronze.selectExpr(spoiled, *others)
