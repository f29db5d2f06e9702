"""Lookup joins that stay balanced when one key holds much of the left side.

Both inputs of the join are plain shuffles, whatever computed them, which is the shape the
adaptive skew join needs to split a large partition; Spark broadcasts the right side instead
if its measured size is below ``spark.sql.autoBroadcastJoinThreshold``.  On top of that,

* rows without a key never match and are spread by a salt;
* keys known to be heavy are looked up in those rows of the right side that have them, at
  most one per key, and then travel spread like rows without a key.

No row of either side is repeated.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALT = "_salt"
PARTS = 4096
# A key is heavy if it holds at least this share of the rows.
HEAVY_SHARE = 0.01


def heavy_keys(rows: DataFrame, key: str, share: float = HEAVY_SHARE) -> list:
    """Keys with at least ``share`` of the rows that have one: never more than 1 / ``share`` keys.

    Counts are added up before they are shuffled; only the key column is read.
    """
    counts = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_n"))
    total = counts.agg(F.sum("_n")).scalar()
    return [row[0] for row in counts.where(F.col("_n") >= F.lit(share) * total).collect()]


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    spread_by: str,
    heavy: Sequence = (),
    how: str = "left",
) -> DataFrame:
    """Equi join that keeps all columns of both sides; ``right`` has each key at most once.

    ``spread_by`` names a column of the left side that differs between rows with
    the same key.  Column names of the two sides must not overlap.  ``heavy`` are
    keys to be taken out of the shuffle; any choice gives the same result.
    """
    keyed, names = left.selectExpr("*", f"{left_key} AS _key"), right.columns
    if heavy:
        # As many rows as there are heavy keys, if the right side has each key once.
        few = right.where(F.col(right_key).isin(list(heavy))).toDF(*[f"_heavy_{name}" for name in names])
        known = left.join(F.broadcast(few), F.col(left_key) == F.col(f"_heavy_{right_key}"), "left")
        keyed = known.withColumn("_key", F.when(~F.col(left_key).isin(list(heavy)), F.col(left_key)))
    salted = keyed.selectExpr("*", f"CASE WHEN _key IS NULL THEN pmod(xxhash64({spread_by}), {PARTS}) ELSE 0 END AS {SALT}")
    # Not a literal: Spark would fold that, join by the key alone and put all rows without one into one task.
    zero = f"pmod(xxhash64({right_key}), 1) AS _zero"
    plain = right.selectExpr("*", zero).toDF(*[f"_plain_{name}" for name in names], "_zero")
    matches = (F.col("_key") == F.col(f"_plain_{right_key}")) & (F.col(SALT) == F.col("_zero"))
    joined = salted.join(plain, matches, "left" if heavy else how)
    of_right = [
        F.coalesce(f"_plain_{name}", f"_heavy_{name}") if heavy else F.col(f"_plain_{name}") for name in names
    ]
    found = joined.select(*left.columns, *[column.alias(name) for column, name in zip(of_right, names)])
    return found.where(F.col(right_key).isNotNull()) if heavy and how == "inner" else found
