"""Data-quality checks.  Each gives rows of (check, subject, violations)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylake.functions import parse_uint


def _tall(counts: DataFrame, check: str) -> DataFrame:
    entries = ", ".join(f"'{name}', `{name}`" for name in counts.columns)
    return counts.selectExpr(
        f"'{check}' AS check", f"stack({len(counts.columns)}, {entries}) AS (subject, violations)"
    )


def not_null(frame: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """NULLs per column, all columns in one pass."""
    counts = frame.agg(*[
        F.expr(f"count_if({name} IS NULL) AS `{table}.{name}`") for name in columns
    ])
    return _tall(counts, "not_null")


def unique(frame: DataFrame, table: str, keys: list[str]) -> DataFrame:
    """Number of non-NULL keys that occur more than once."""
    repeated = (
        frame.where(" AND ".join(f"{key} IS NOT NULL" for key in keys))
        .groupBy(*keys).agg(F.expr("count(*) AS _n")).where("_n > 1")
    )
    return _tall(repeated.agg(F.expr(f"count(*) AS `{table}.{'+'.join(keys)}`")), "unique")


def checks(
    frame: DataFrame, table: str, not_null_columns: Sequence[str] = (), unique_keys: Sequence[Sequence[str]] = ()
) -> DataFrame:
    """All not-null and unique checks of a table in one scan and one shuffle.

    Each key is a grouping set; NULLs are counted in the empty one.
    """
    if not unique_keys:
        return not_null(frame, table, list(not_null_columns))
    columns = list(dict.fromkeys(name for key in unique_keys for name in key))
    outside = [sum(1 << (len(columns) - 1 - i) for i, name in enumerate(columns) if name not in key) for key in unique_keys]
    grouped = frame.groupingSets(
        [[], *[[F.col(name) for name in key] for key in unique_keys]], *[F.col(name) for name in columns]
    ).agg(
        F.expr("count(*) AS _n"), F.expr("grouping_id() AS _set"),
        *[F.expr(f"count_if({name} IS NULL) AS _null{i}") for i, name in enumerate(not_null_columns)],
    )
    whole = (1 << len(columns)) - 1
    counts = [
        F.expr(f"coalesce(sum(CASE WHEN _set = {whole} THEN _null{i} END), 0) AS `not_null {table}.{name}`")
        for i, name in enumerate(not_null_columns)
    ] + [
        F.expr(
            f"count_if(_set = {number} AND _n > 1 AND {' AND '.join(f'{name} IS NOT NULL' for name in key)}) "
            f"AS `unique {table}.{'+'.join(key)}`"
        )
        for number, key in zip(outside, unique_keys)
    ]
    found = grouped.agg(*counts)
    entries = ", ".join(f"'{n.split(' ', 1)[0]}', '{n.split(' ', 1)[1]}', `{n}`" for n in found.columns)
    return found.selectExpr(f"stack({len(found.columns)}, {entries}) AS (check, subject, violations)")


def timestamp_order(frame: DataFrame, table: str, earlier: str, later: str) -> DataFrame:
    """Rows where ``earlier`` is not before ``later``; rows lacking either pass."""
    counts = frame.agg(
        F.expr(f"count_if(NOT ({earlier} < {later})) AS `{table}.{earlier}<{later}`")
    )
    return _tall(counts, "timestamp_order")


REASON = "_reason"


def flagged_ids(bronze: DataFrame, id_column: str = "id") -> DataFrame:
    """All rows, with the reason why an id is not a usable number; NULL for those that silver takes."""
    reason = (
        f"CASE WHEN {parse_uint(id_column)} IS NOT NULL THEN NULL "
        f"WHEN {id_column} IS NULL THEN 'missing id' "
        f"WHEN {id_column} RLIKE '^[0-9]+$' THEN 'id out of range' "
        f"ELSE 'id is not a number' END AS {REASON}"
    )
    return bronze.selectExpr("*", reason)


def rejected_ids(bronze: DataFrame, id_column: str = "id") -> DataFrame:
    """Rows kept out of silver because their id is not a usable number."""
    return flagged_ids(bronze.where(f"{parse_uint(id_column)} IS NULL"), id_column)
