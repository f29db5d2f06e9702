"""Latest and dominant values per key.

Every aggregate here is merged map-side before the shuffle and keeps a state of
fixed size per key, so a key that holds a large share of all rows reaches its
reducer as one partial result per map task.  No window and no collected list is
used.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest(value: str, time: str, order: str) -> str:
    """The latest non-NULL ``value``, as a SQL aggregate.

    Rows with a NULL ``value`` or ``time`` do not take part, so columns of one
    key may come from different rows.  ``order`` is a struct that starts with
    ``time`` and goes on with tie-breakers; it has to order all rows of a key.
    """
    return f"max_by({value}, CASE WHEN {value} IS NOT NULL AND {time} IS NOT NULL THEN {order} END)"


def latest_columns(
    values: dict[str, str], time: str, order: str, together: Sequence[str] = (), given: dict[str, str] | None = None
) -> tuple[list[Column], list[Column]]:
    """:func:`latest` of several columns: the aggregates, and what makes the columns of them.

    ``values`` maps names to expressions, ``given`` those whose NULLs count, too, to what tells
    that a row has one.  Every aggregate holds an order, which is most of what is sorted and
    shuffled.  The columns in ``together`` share one for the rows that have all of them; other
    rows are merged column by column, as are other columns.  Any choice gives the same result.
    """
    has = {name: (given or {}).get(name, f"{value} IS NOT NULL") for name, value in values.items()}
    timed, all_given = f"{time} IS NOT NULL", " AND ".join(has[name] for name in together) or "false"
    aggregates, found = [], []
    if together:
        row = ", ".join(f"{values[name]} AS {name}" for name in together)
        aggregates.append(F.expr(f"max(CASE WHEN {timed} AND {all_given} THEN struct({order} AS o, {row}) END) AS _together"))
    for name, value in values.items():
        alone = f"{timed} AND {has[name]}" + (f" AND NOT ({all_given})" if name in together else "")
        aggregates.append(F.expr(f"max(CASE WHEN {alone} THEN struct({order} AS o, {value} AS v) END) AS _of_{name}"))
        # Of a tie the larger value.
        later = f"greatest(struct(_together.o AS o, _together.{name} AS v), _of_{name})" if name in together else f"_of_{name}"
        found.append(F.expr(f"{later}.v AS {name}"))
    return aggregates, found


def dominant_values(rows: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Per key the most frequent non-NULL value of each column, the smallest on a tie.

    Values must be non-negative numbers.  Rows are counted per key and combination of values
    before they are shuffled, so a key comes to its task once per combination, however many rows
    it has; there the counts of each value are added up and compared, both without a shuffle.  A
    single ``mode`` would hold all distinct values of a key in memory.
    """
    slots = ", ".join(f"{slot}, {name}" for slot, name in enumerate(columns))
    combined = rows.groupBy(*keys, *columns).agg(F.expr("count(*) AS _n")).repartition(*keys)
    counted = (
        combined.selectExpr(*keys, "_n", f"stack({len(columns)}, {slots}) AS (_slot, _value)")
        .where("_value IS NOT NULL")
        .groupBy(*keys, "_slot", "_value")
        .agg(F.expr("sum(_n) AS _n"))
    )
    return counted.groupBy(*keys).agg(*[
        F.expr(f"max_by(_value, CASE WHEN _slot = {slot} THEN struct(_n, -_value) END) AS {name}")
        for slot, name in enumerate(columns)
    ])
