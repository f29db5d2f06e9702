"""The registered queries in plain SQL, for an independent engine (DuckDB).

Written from the definitions, not from the Spark plans: views join the whole
fact to the dimensions and group by the labels, latest values use one ordered
aggregate over all rows.
"""

from __future__ import annotations

FIRST_DAY = "date '2025-10-01'"
SPLIT_DAY = "date '2025-10-04'"


def _key(text: str) -> str:
    return f"('0x' || substr(md5({text}), 1, 15))::bigint"


def _text(time: str) -> str:
    return f"strftime({time}, '%Y-%m-%d %H:%M:%S')"


def _pct(part: str, whole: str) -> str:
    return f"round_even({part} * 100.0::double / nullif({whole}, 0)::double, 2)"


# ---- raw rows ---------------------------------------------------------------

RAW_PAYMENTS = f"""
raw_payments AS (
  SELECT l_orderkey * 10 + l_linenumber AS id,
    CASE WHEN l_suppkey % 23 = 0 THEN l_suppkey + 10000000 ELSE l_suppkey END AS merchant_id,
    l_suppkey % 5 AS acquirer_id,
    CASE l_returnflag || l_linestatus WHEN 'AF' THEN 'settled' WHEN 'AO' THEN 'initial'
      WHEN 'RF' THEN 'refunded' WHEN 'RO' THEN 'failed' WHEN 'NF' THEN 'voided'
      WHEN 'NO' THEN 'WAITING_FOR_SCA' END AS state,
    CASE l_linenumber % 3 WHEN 1 THEN '1' WHEN 2 THEN '2' END AS card_type,
    'PAY-' || l_orderkey::varchar AS reference, 'ORD-' || l_orderkey::varchar AS order_reference,
    '{{"part": ' || l_partkey::varchar || '}}' AS details,
    l_shipdate AS created_at,
    CASE WHEN l_linenumber % 2 = 0 THEN l_shipdate + interval 1 day END AS updated_at,
    ({FIRST_DAY} + (l_orderkey % 7)::int)::date AS _snapshot_date,
    l_partkey AS part, l_extendedprice AS price
  FROM lineitem)"""

RAW_LINK_TX = f"""
raw_link_tx AS (
  SELECT o_orderkey AS id, o_orderdate AS created_at,
    CASE WHEN o_orderkey % 50 = 1 THEN o_orderdate - interval 1 day
         WHEN o_orderkey % 4 <> 0 THEN o_orderdate + interval 1 day END AS updated_at,
    o_orderstatus AS state,
    CASE WHEN o_orderkey % 10 <> 0 THEN 'PAY-' || o_orderkey::varchar END AS linkpay_reference,
    CASE o_orderkey % 6
      WHEN 0 THEN '{{"payment_reference": "PAY-' || o_orderkey::varchar || '"}}'
      WHEN 1 THEN '{{"paymentReference": "PAY-' || o_orderkey::varchar || '"}}'
      WHEN 2 THEN '{{"reference": "PAY-' || o_orderkey::varchar || '"}}'
      WHEN 3 THEN '{{"payment_reference": ' || o_orderkey::varchar || '}}'
      WHEN 4 THEN 'not json' END AS payment_details,
    ({FIRST_DAY} + (o_orderkey % 7)::int)::date AS _snapshot_date
  FROM orders)"""

STAGE_MERCHANTS = """
stage_merchants AS (
  SELECT s_suppkey AS id, s_nationkey::bigint AS acquirer_id,
    CASE WHEN s_suppkey % 17 = 0 THEN '' ELSE s_name END AS name,
    CASE WHEN s_acctbal < 0 THEN 'blocked' ELSE 'active' END AS state,
    timestamp '2025-09-01 00:00:00' AS created_at,
    CASE WHEN s_suppkey % 5 <> 0 THEN timestamp '2025-10-01 00:00:00' END AS updated_at
  FROM supplier)"""

RAW_MERCHANTS = f"""{STAGE_MERCHANTS},
raw_merchants AS (
  SELECT *, {FIRST_DAY} AS _snapshot_date FROM stage_merchants
  UNION ALL
  SELECT id, acquirer_id, name, 'renewed', created_at, updated_at + interval 1 day, date '2025-10-02'
  FROM stage_merchants WHERE id % 2 = 0)"""

# ---- silver -----------------------------------------------------------------


def _last(column: str, order: str, name: str | None = None) -> str:
    return f"arg_max({column}, {order}) FILTER (WHERE {column} IS NOT NULL) AS {name or column}"


_PAY_ORDER = "row(created_at, part, price)"
SILVER_PAYMENTS = f"""{RAW_PAYMENTS},
silver_payments AS (
  SELECT id AS transaction_id, mode(merchant_id ORDER BY merchant_id) AS merchant_id,
    mode(acquirer_id ORDER BY acquirer_id) AS acquirer_id,
    {_last('state', _PAY_ORDER, 'payment_state')}, {_last('card_type', _PAY_ORDER)},
    {_last('reference', _PAY_ORDER)}, {_last('order_reference', _PAY_ORDER)},
    {_last('details', _PAY_ORDER)}, {_last('created_at', _PAY_ORDER)},
    {_last('updated_at', _PAY_ORDER)}, _snapshot_date
  FROM raw_payments GROUP BY id, _snapshot_date)"""

SILVER_LINK_TX = f"""{RAW_LINK_TX},
silver_link_tx AS (
  SELECT id AS transaction_id, state, linkpay_reference AS reference, payment_details AS details,
    created_at, updated_at, _snapshot_date
  FROM raw_link_tx)"""

SILVER_MERCHANTS = f"""{RAW_MERCHANTS},
silver_merchants AS (
  SELECT id AS merchant_id, _snapshot_date, acquirer_id, nullif(name, '') AS merchant_name, state,
    created_at, updated_at,
    {_key("id::varchar || '|' || coalesce(acquirer_id::varchar, '') || '|' || coalesce(name, '') || '|' "
          "|| coalesce(state, '') || '|' || coalesce(" + _text("created_at") + ", '') || '|' "
          "|| coalesce(" + _text("updated_at") + ", '')")} AS dim_fingerprint
  FROM raw_merchants)"""

# ---- gold -------------------------------------------------------------------

METHODS = """
dim_payment_method(payment_method_sk, original_value, payment_method_name) AS (
  VALUES (1, '1', 'Visa'), (2, '2', 'Mastercard'), (3, NULL, 'ACH transfer'))"""

STATES = """
dim_payment_state(payment_state_sk, payment_state_name, is_final_state, is_payment_reached_provider) AS (
  VALUES (1, 'settled', 1, 1), (2, 'initial', 0, 0), (3, 'failed', 1, 1),
         (4, 'voided', 1, 1), (5, 'refunded', 1, 1), (6, 'waiting_for_sca', 0, 0))"""

CALENDAR = """
dim_date AS (
  SELECT strftime(d, '%Y%m%d')::int AS date_key, d::date AS full_date, year(d)::int AS year,
    month(d)::int AS month, day(d)::int AS day, isodow(d)::int AS day_of_week,
    (isodow(d) >= 6)::int AS is_weekend, 0 AS is_holiday
  FROM generate_series(timestamp '2000-01-01', timestamp '2040-12-31', interval 1 day) AS g(d))"""

_MERCHANT_ORDER = "row(ts, _snapshot_date)"
DIM_MERCHANTS = f"""{SILVER_MERCHANTS},
dim_merchants AS (
  SELECT {_key('merchant_id::varchar')} AS merchant_sk, merchant_id,
    {_last('merchant_name', _MERCHANT_ORDER)}, {_last('state', _MERCHANT_ORDER, 'merchant_state')},
    {_last('acquirer_id', _MERCHANT_ORDER)}, max(ts)::date AS scd_start_date,
    date '9999-12-31' AS scd_end_date, {_last('updated_at', _MERCHANT_ORDER, 'updated_at_raw')}
  FROM (SELECT *, coalesce(updated_at, _snapshot_date::timestamp) AS ts FROM silver_merchants)
  GROUP BY merchant_id)"""


def _json_text(key: str) -> str:
    return (
        f"nullif(CASE WHEN json_valid(details) AND json_type(details, '$.{key}') = 'VARCHAR' "
        f"THEN json_extract_string(details, '$.{key}') END, '')"
    )


REFERENCES = f"""{SILVER_LINK_TX},
tx AS (
  SELECT transaction_id,
    coalesce({_json_text('payment_reference')}, {_json_text('paymentReference')},
             {_json_text('reference')}, nullif(reference, '')) AS payment_reference,
    created_at AS tx_started_at
  FROM silver_link_tx)"""

_FINAL_ORDER = "row(ts, transaction_id, _snapshot_date)"
FINAL = f"""{SILVER_PAYMENTS},
final AS (
  SELECT reference AS pay_reference, {_last('payment_state', _FINAL_ORDER, 'final_state')},
    {_last('card_type', _FINAL_ORDER, 'final_method')},
    {_last('merchant_id', _FINAL_ORDER, 'final_merchant_id')}, max(ts) AS final_state_ts
  FROM (SELECT *, coalesce(updated_at, created_at) AS ts FROM silver_payments)
  WHERE reference IS NOT NULL GROUP BY reference)"""

FACT = f"""{REFERENCES}, {FINAL}, {DIM_MERCHANTS}, {METHODS}, {STATES},
fact AS (
  SELECT md5(t.transaction_id::varchar || '|' || coalesce(t.payment_reference, '')) AS sk,
    t.transaction_id, t.payment_reference, (p.pay_reference IS NOT NULL)::int AS "hasPayment",
    s.payment_state_sk AS payment_state, m.merchant_sk, k.payment_method_sk,
    date_diff('second', t.tx_started_at, p.final_state_ts) AS "TimeFromStartToEndSeconds",
    t.tx_started_at AS _gating_ts
  FROM tx t
  LEFT JOIN final p ON p.pay_reference = t.payment_reference
  LEFT JOIN dim_payment_state s ON s.payment_state_name = lower(coalesce(p.final_state, ''))
  LEFT JOIN dim_payment_method k ON k.original_value = p.final_method
  LEFT JOIN dim_merchants m ON m.merchant_id = p.final_merchant_id)"""

# What is left after days were delivered again: of one day without some transactions, of the
# next without some payments, and states of two early days that nothing has corrected.
_AFTER_RELOAD = FACT.replace(
    "FROM silver_link_tx)",
    "FROM silver_link_tx WHERE NOT (_snapshot_date = date '2025-10-02' AND transaction_id % 3 = 0))",
).replace(
    "FROM (SELECT *, coalesce(updated_at, created_at) AS ts FROM silver_payments)",
    "FROM (SELECT * REPLACE (CASE WHEN _snapshot_date IN (date '2025-10-01', date '2025-10-04') THEN 'initial' "
    "ELSE payment_state END AS payment_state), coalesce(updated_at, created_at) AS ts FROM silver_payments "
    "WHERE NOT (_snapshot_date = date '2025-10-03' AND transaction_id % 4 = 0))",
)

FACT_COLUMNS = (
    'sk, transaction_id, payment_reference, "hasPayment", payment_state, merchant_sk, '
    'payment_method_sk, "TimeFromStartToEndSeconds"'
)

# ---- views ------------------------------------------------------------------

_METHOD = "coalesce(nullif(k.payment_method_name, ''), 'ACH transfer')"
_METHOD_MASKED = (
    "CASE k.payment_method_name WHEN 'Visa' THEN 'Payment_Method_A' "
    "WHEN 'Mastercard' THEN 'Payment_Method_B' ELSE 'Other_Method' END"
)
_MERCHANT = "coalesce(m.merchant_name, f.merchant_sk::varchar)"
_MERCHANT_MASKED = "'Provider_' || substr(upper(sha256(m.merchant_name)), 1, 6)"
_JOIN_METHOD = "LEFT JOIN dim_payment_method k ON k.payment_method_sk = f.payment_method_sk"
_JOIN_MERCHANT = "LEFT JOIN dim_merchants m ON m.merchant_sk = f.merchant_sk"
_REACHED = 'count(*) FILTER (WHERE f."hasPayment" = 1)'
_FAILED = 'count(*) FILTER (WHERE f."hasPayment" = 1 AND f.payment_state IN (3, 6))'


def _failure_rates(method: str, provider: str, reached: str) -> str:
    return f"""SELECT {method} AS payment_method, {provider} AS provider, {reached} AS reached_provider,
      {_FAILED} AS never_completed, {_pct(_FAILED, _REACHED)} AS never_complete_rate_pct
    FROM fact f {_JOIN_METHOD} {_JOIN_MERCHANT} WHERE f."hasPayment" = 1
    GROUP BY 1, 2 HAVING {_FAILED} > 0"""


def _rate_by(label: str, name: str, join: str, having: str = "") -> str:
    return f"""SELECT {label} AS {name}, {_REACHED} AS total_reached_provider,
      {_FAILED} AS total_never_completed, {_pct(_FAILED, _REACHED)} AS never_complete_rate_pct
    FROM fact f {join} GROUP BY 1 {having} ORDER BY 4 DESC NULLS LAST, 2 DESC"""


def _abandoned(label: str) -> str:
    return f"""SELECT {label} AS merchant, count(*) AS reached_then_abandoned
    FROM fact f {_JOIN_MERCHANT}
    WHERE coalesce(f."hasPayment", 0) = 1 AND f.payment_state = 6 GROUP BY 1 ORDER BY 2 DESC"""


_VOLUME = f"CASE WHEN {_REACHED} < 10 THEN 'Low_Volume' WHEN {_REACHED} < 100 THEN 'Medium_Volume' ELSE 'High_Volume' END"

VIEWS = {
    "never_reached_psp_overall": """SELECT count(*) AS total_initiated_payments_never_reached_psp
      FROM fact f LEFT JOIN dim_payment_state s ON s.payment_state_sk = f.payment_state
      WHERE f."hasPayment" = 0 OR coalesce(s.is_payment_reached_provider, 0) = 0""",
    "payment_failure_rates": _failure_rates(_METHOD, _MERCHANT, _REACHED),
    "payment_failure_rates_limited": _failure_rates(_METHOD_MASKED, _MERCHANT_MASKED, _VOLUME),
    "abandoned_by_merchant": _abandoned(_MERCHANT),
    "abandoned_by_merchant_limited": _abandoned(_MERCHANT_MASKED),
    "failure_rate_by_payment_method": _rate_by(_METHOD, "payment_method", _JOIN_METHOD),
    "failure_rate_by_payment_method_limited": _rate_by(_METHOD_MASKED, "payment_method", _JOIN_METHOD),
    "failure_rate_by_provider": _rate_by(_MERCHANT, "provider", _JOIN_MERCHANT, f"HAVING {_REACHED} > 0"),
    "failure_rate_by_provider_limited": _rate_by(
        _MERCHANT_MASKED, "provider", _JOIN_MERCHANT, f"HAVING {_REACHED} > 0"
    ),
}
ROLE_VIEWS = {
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


def _with(ctes: str, query: str) -> str:
    return f"WITH {ctes.strip()}\n{query}"


# ---- checks -----------------------------------------------------------------


def _nulls(table: str, source: str, columns: list[str]) -> list[str]:
    return [
        f"SELECT 'not_null' AS \"check\", '{table}.{c}' AS subject, "
        f"count(*) FILTER (WHERE {c} IS NULL) AS violations FROM {source}"
        for c in columns
    ]


def _repeats(table: str, source: str, keys: list[str]) -> str:
    present = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    return (
        f"SELECT 'unique' AS \"check\", '{table}.{'+'.join(keys)}' AS subject, count(*) AS violations "
        f"FROM (SELECT {', '.join(keys)} FROM {source} WHERE {present} "
        f"GROUP BY {', '.join(keys)} HAVING count(*) > 1)"
    )


def _unordered(table: str, source: str) -> str:
    return (
        f"SELECT 'timestamp_order' AS \"check\", '{table}.created_at<updated_at' AS subject, "
        f"count(*) FILTER (WHERE NOT (created_at < updated_at)) AS violations FROM {source}"
    )


def _union(selects: list[str]) -> str:
    return "\nUNION ALL\n".join(selects)


# ---- all queries ------------------------------------------------------------


def sql() -> dict[str, str]:
    payment_text = (
        "id::varchar AS id, merchant_id::varchar AS merchant_id, acquirer_id::varchar AS acquirer_id, "
        f"state, card_type, reference, order_reference, details, {_text('created_at')} AS created_at, "
        f"{_text('updated_at')} AS updated_at"
    )
    silver_link_columns = "transaction_id, state, reference, details, created_at, updated_at, _snapshot_date"
    stage_payment = (
        "p.id, p.created_at, p.updated_at, p.merchant_id, m.acquirer_id, p.reference, "
        "p.order_reference, p.state, p.card_type, p.details"
    )
    landed = (
        "id::varchar AS id, strftime(created_at, '%Y-%m-%dT%H:%M:%S') AS created_at, "
        "strftime(updated_at, '%Y-%m-%dT%H:%M:%S') AS updated_at, state, linkpay_reference, "
        "CASE WHEN json_valid(payment_details) THEN json(payment_details)::varchar END AS payment_details"
    )
    queries = {name: _with(FACT, query) for name, query in VIEWS.items()}
    queries |= {
        # sources
        "scan_csv_strings": _with(RAW_LINK_TX, f"""
          SELECT id::varchar AS id, {_text('created_at')} AS created_at, {_text('updated_at')} AS updated_at,
            state, linkpay_reference, replace(payment_details, 'not json', 'not' || chr(10) || '"json"') AS payment_details,
            'link_transactions-' || strftime(_snapshot_date, '%Y%m%d') || '.csv' AS _source_file, _snapshot_date
          FROM raw_link_tx"""),
        "scan_daily_files": _with(RAW_PAYMENTS, f"""
          SELECT {payment_text}, 'payments-' || strftime(_snapshot_date, '%Y%m%d') || '.csv' AS _source_file,
            _snapshot_date FROM raw_payments"""),
        "scan_missing_day": _with(RAW_MERCHANTS, """
          SELECT _snapshot_date, count(*) AS "rows", count(nullif(name, '')) AS named
          FROM raw_merchants GROUP BY 1"""),
        "bronze_link_tx_day": _with(RAW_LINK_TX, f"""
          SELECT {landed}, 'landing:link_transactions_raw:2025-10-03' AS _source_file, _snapshot_date
          FROM raw_link_tx WHERE _snapshot_date = date '2025-10-03'"""),
        "bronze_link_tx_full": _with(RAW_LINK_TX, f"""
          SELECT {landed}, 'landing:link_transactions_raw:ALL' AS _source_file,
            date '2025-10-07' AS _snapshot_date FROM raw_link_tx"""),
        "extract_link_tx": _with(RAW_LINK_TX, """
          SELECT id, created_at, updated_at, state, linkpay_reference, payment_details
          FROM raw_link_tx WHERE created_at >= timestamp '1998-01-01'"""),
        "extract_merchants": _with(STAGE_MERCHANTS, """
          SELECT id, created_at, updated_at, acquirer_id, name, state FROM stage_merchants"""),
        "extract_payments": _with(f"{RAW_PAYMENTS}, {STAGE_MERCHANTS}", f"""
          SELECT {stage_payment} FROM raw_payments p JOIN stage_merchants m ON m.id = p.merchant_id
          WHERE p.created_at >= timestamp '1998-01-01'"""),
        # silver
        "silver_link_tx": _with(SILVER_LINK_TX, f"SELECT {silver_link_columns} FROM silver_link_tx"),
        "silver_payments": _with(SILVER_PAYMENTS, "SELECT * FROM silver_payments"),
        "silver_payments_day": _with(
            SILVER_PAYMENTS, "SELECT * FROM silver_payments WHERE _snapshot_date = date '2025-10-03'"
        ),
        "silver_merchants": _with(SILVER_MERCHANTS, "SELECT * FROM silver_merchants"),
        "silver_merchants_empty": _with(SILVER_MERCHANTS, """
          SELECT 'complete' AS bronze, count(*) AS "rows" FROM silver_merchants
          UNION ALL SELECT 'without _ingested_at', 0"""),
        "quarantine_bad_ids": _with(RAW_PAYMENTS, """
          SELECT CASE id % 11 WHEN 0 THEN ' ' || id::varchar WHEN 1 THEN '-' || id::varchar
              WHEN 2 THEN id::varchar || '.5' WHEN 3 THEN '18446744073709551615' END AS id,
            CASE id % 11 WHEN 3 THEN 'id out of range' WHEN 4 THEN 'missing id'
              ELSE 'id is not a number' END AS _reason,
            reference, details, _snapshot_date
          FROM raw_payments WHERE id % 11 <= 4"""),
        # sinks
        "sink_partition_replace": _with(SILVER_LINK_TX, f"""
          SELECT transaction_id, CASE WHEN _snapshot_date >= {SPLIT_DAY} THEN state ELSE 'old' END AS state,
            reference, details, created_at, updated_at, _snapshot_date FROM silver_link_tx"""),
        "sink_partition_emptied": _with(SILVER_LINK_TX, f"""
          SELECT transaction_id, CASE WHEN _snapshot_date >= {SPLIT_DAY} THEN state ELSE 'old' END AS state,
            reference, details, created_at, updated_at, _snapshot_date FROM silver_link_tx
          WHERE _snapshot_date <> date '2025-10-05'"""),
        "sink_replace_by_file": _with(RAW_LINK_TX, f"""
          SELECT id::varchar AS id, CASE WHEN id % 3 = 0 THEN state ELSE 'old' END AS state, linkpay_reference,
            'part-' || (id % 3)::varchar || '-' || strftime(_snapshot_date, '%Y%m%d') AS _source_file,
            _snapshot_date FROM raw_link_tx"""),
        "sink_file_on_other_days": _with(RAW_LINK_TX, f"""
          SELECT id::varchar AS id, CASE WHEN id % 5 < 2 THEN state ELSE 'old' END AS state, linkpay_reference,
            'part-' || (id % 5)::varchar AS _source_file, _snapshot_date FROM raw_link_tx
          WHERE id % 5 > 2 OR id % 5 < 2 AND _snapshot_date < {SPLIT_DAY}"""),
        "schema_drift_union": _with(RAW_LINK_TX, f"""
          SELECT id::varchar AS id, {_text('created_at')} AS created_at, {_text('updated_at')} AS updated_at, state,
            CASE WHEN _snapshot_date >= {SPLIT_DAY} THEN linkpay_reference END AS linkpay_reference,
            payment_details, CASE WHEN _snapshot_date >= {SPLIT_DAY} THEN 'channel-' || state END AS channel,
            _snapshot_date FROM raw_link_tx"""),
        "silver_insert_missing": _with(SILVER_LINK_TX, f"""
          SELECT transaction_id, CASE WHEN _snapshot_date < {SPLIT_DAY} THEN 'old' ELSE state END AS state,
            reference, details, created_at, updated_at, _snapshot_date FROM silver_link_tx"""),
        "silver_upsert": _with(SILVER_PAYMENTS, f"""
          SELECT * REPLACE (CASE WHEN _snapshot_date >= {SPLIT_DAY} AND card_type IS NOT NULL
            THEN payment_state ELSE 'old' END AS payment_state) FROM silver_payments"""),
        "backfill_range": _with(SILVER_PAYMENTS, """
          SELECT * FROM silver_payments
          WHERE _snapshot_date BETWEEN date '2025-10-02' AND date '2025-10-06'"""),
        "ingest_available_now": _with(RAW_MERCHANTS, f"""
          SELECT id::varchar AS id, acquirer_id::varchar AS acquirer_id, nullif(name, '') AS name, state,
            {_text('created_at')} AS created_at, {_text('updated_at')} AS updated_at,
            'merchants-' || strftime(_snapshot_date, '%Y%m%d') || '.csv' AS _source_file, _snapshot_date
          FROM raw_merchants"""),
        # gold
        "dim_date": _with(f"{CALENDAR.replace('2000-01-01', '1990-01-01')}, {RAW_LINK_TX}", """
          SELECT d.*, coalesce(n.initiated, 0) AS initiated FROM dim_date d
          FULL JOIN (SELECT created_at::date AS started, count(*) AS initiated FROM raw_link_tx GROUP BY 1) n
            ON n.started = d.full_date"""),
        "dim_payment_method": _with(f"{METHODS}, {SILVER_PAYMENTS}", """
          SELECT k.payment_method_sk, k.original_value, k.payment_method_name, count(p.transaction_id) AS payments
          FROM dim_payment_method k LEFT JOIN silver_payments p ON p.card_type = k.original_value
          GROUP BY 1, 2, 3"""),
        "dim_payment_state": _with(f"{STATES}, {SILVER_PAYMENTS}", """
          SELECT s.payment_state_sk, s.payment_state_name, s.is_final_state, s.is_payment_reached_provider,
            count(p.transaction_id) AS payments
          FROM dim_payment_state s LEFT JOIN silver_payments p ON lower(p.payment_state) = s.payment_state_name
          GROUP BY 1, 2, 3, 4"""),
        "dim_merchants": _with(DIM_MERCHANTS, "SELECT * FROM dim_merchants"),
        "payment_reference": _with(REFERENCES, "SELECT * FROM tx"),
        "payment_final": _with(FINAL, "SELECT * FROM final"),
        "fact_transactions": _with(FACT, f"SELECT {FACT_COLUMNS} FROM fact"),
        "fact_increment": _with(_AFTER_RELOAD, f"SELECT {FACT_COLUMNS} FROM fact"),
        "fact_high_water_mark": _with(FACT, f"SELECT {FACT_COLUMNS} FROM fact"),
        "bucketed_match": _with(FACT, """
          SELECT t.transaction_id, t.payment_reference, p.transaction_id AS payment_id, p.payment_state, p._snapshot_date
          FROM tx t JOIN silver_payments p ON p.reference = t.payment_reference"""),
        # the stored lake
        "lake_quarantine": _with(RAW_PAYMENTS, """
          SELECT _snapshot_date, count(*) AS bronze_rows, count(*) FILTER (WHERE id % 11 > 4) AS accepted_rows,
            count(*) FILTER (WHERE id % 11 <= 4) AS rejected_rows,
            count(DISTINCT id) FILTER (WHERE id % 11 > 4) AS silver_rows,
            count(*) FILTER (WHERE id % 11 = 4) AS missing_ids, count(*) FILTER (WHERE id % 11 = 3) AS ids_out_of_range
          FROM raw_payments GROUP BY 1"""),
        "lake_full_load": _with(FACT, """
          SELECT transaction_id, payment_reference, "hasPayment", date '2025-10-05' AS latest_day
          FROM fact JOIN silver_link_tx USING (transaction_id)
          WHERE _snapshot_date IN (date '2025-10-02', date '2025-10-05')"""),
        # questions beyond the views
        "match_rate_kpi": _with(FACT, f"""
          SELECT count(*) AS initiated, {_REACHED} AS matched, {_pct(_REACHED, 'count(*)')} AS match_rate_pct
          FROM fact f"""),
        "outcome_by_method": _with(FACT, f"""
          SELECT {_METHOD} AS payment_method,
            CASE WHEN f."hasPayment" = 0 THEN 'no_payment' WHEN f.payment_state = 1 THEN 'completed'
              WHEN f.payment_state = 6 THEN 'abandoned' ELSE 'other' END AS outcome, count(*) AS payments
          FROM fact f {_JOIN_METHOD} GROUP BY 1, 2"""),
        "failure_rate_by_payment_method_filtered": _with(
            FACT, _rate_by(_METHOD, "payment_method", _JOIN_METHOD, f"HAVING {_REACHED} > 0")
        ),
        "method_switches": _with(SILVER_PAYMENTS, """
          SELECT reference AS payment_reference, count(DISTINCT card_type) AS methods,
            arg_min(card_type, row(ts, transaction_id, _snapshot_date)) AS first_method,
            arg_max(card_type, row(ts, transaction_id, _snapshot_date)) AS final_method,
            (arg_min(card_type, row(ts, transaction_id, _snapshot_date))
              <> arg_max(card_type, row(ts, transaction_id, _snapshot_date)))::int AS finalised_differently
          FROM (SELECT *, coalesce(updated_at, created_at) AS ts FROM silver_payments)
          WHERE reference IS NOT NULL AND card_type IS NOT NULL AND ts IS NOT NULL
          GROUP BY reference HAVING count(DISTINCT card_type) > 1"""),
        "completion_by_weekday": _with(FACT, f"""
          SELECT isodow(f._gating_ts)::int AS day_of_week, (isodow(f._gating_ts) >= 6)::int AS is_weekend,
            count(*) AS initiated,
            count(*) FILTER (WHERE f.payment_state = 1) AS completed,
            {_pct('count(*) FILTER (WHERE f.payment_state = 1)', 'count(*)')} AS completion_rate_pct
          FROM fact f GROUP BY 1, 2"""),
        "completion_by_hour": f"""
          SELECT hour(ts)::int AS hour_of_day, count(*) AS initiated,
            count(*) FILTER (WHERE event_type = 'purchase') AS completed,
            {_pct("count(*) FILTER (WHERE event_type = 'purchase')", 'count(*)')} AS completion_rate_pct
          FROM events GROUP BY 1""",
        # checks
        "dq_not_null": _with(FACT, _union(
            _nulls("link_transactions", "silver_link_tx", ["transaction_id", "reference"])
            + _nulls("payments", "silver_payments", ["transaction_id", "reference", "merchant_id", "card_type"])
            + _nulls("merchants", "silver_merchants", ["merchant_id", "merchant_name"])
            + _nulls("dim_merchants", "dim_merchants", ["merchant_sk"])
            + _nulls("fact_transactions", "fact", ["sk", "transaction_id", "payment_reference", "merchant_sk"])
        )),
        "dq_unique": _with(FACT, _union([
            _repeats("raw_link_transactions", "raw_link_tx", ["id"]),
            _repeats("raw_payments", "raw_payments", ["id"]),
            _repeats("payments", "silver_payments", ["transaction_id", "_snapshot_date"]),
            _repeats("merchants", "silver_merchants", ["merchant_id", "_snapshot_date"]),
            _repeats("dim_merchants", "dim_merchants", ["merchant_sk"]),
            _repeats("dim_merchants", "dim_merchants", ["merchant_name"]),
            _repeats("fact_transactions", "fact", ["sk"]),
            _repeats("fact_transactions", "fact", ["payment_method_sk"]),
        ])),
        "dq_tables": _with(FACT, _union(
            _nulls("link_transactions", "silver_link_tx", ["transaction_id", "reference"])
            + _nulls("payments", "silver_payments", ["transaction_id", "card_type"])
            + _nulls("merchants", "silver_merchants", ["merchant_id", "merchant_name"])
            + _nulls("dim_merchants", "dim_merchants", ["merchant_sk"])
            + _nulls("fact_transactions", "fact", ["sk", "payment_reference"])
            + [
                _repeats("link_transactions", "silver_link_tx", ["transaction_id", "_snapshot_date"]),
                _repeats("link_transactions", "silver_link_tx", ["reference"]),
                _repeats("payments", "silver_payments", ["transaction_id", "_snapshot_date"]),
                _repeats("payments", "silver_payments", ["reference"]),
                _repeats("merchants", "silver_merchants", ["merchant_id", "_snapshot_date"]),
                _repeats("dim_merchants", "dim_merchants", ["merchant_sk"]),
                _repeats("dim_merchants", "dim_merchants", ["merchant_name"]),
                _repeats("fact_transactions", "fact", ["sk"]),
                _repeats("fact_transactions", "fact", ["payment_reference", "payment_state"]),
            ]
        )),
        "dq_timestamp_order": _with(f"{SILVER_LINK_TX}, {SILVER_PAYMENTS}, {SILVER_MERCHANTS}", _union([
            _unordered("link_transactions", "silver_link_tx"),
            _unordered("payments", "silver_payments"),
            _unordered("merchants", "silver_merchants"),
        ])),
        "views_for_role": _with(FACT, _union([
            f"SELECT '{role}' AS role, '{name}' AS view_name, count(*) AS \"rows\" FROM ({VIEWS[name]})"
            for role, names in ROLE_VIEWS.items() for name in names
        ])),
    }
    return queries
