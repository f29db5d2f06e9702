"""Merging a load into rows that are already there."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def align(frame: DataFrame, contract: T.StructType) -> DataFrame:
    """Exactly the columns of ``contract``, by name: absent ones NULL, others dropped."""
    present = set(frame.columns)
    return frame.selectExpr(*[
        f"cast({f'`{field.name}`' if field.name in present else 'NULL'} "
        f"AS {field.dataType.simpleString()}) AS `{field.name}`"
        for field in contract.fields
    ])


def empty(spark: SparkSession, contract: T.StructType) -> DataFrame:
    """No rows, fully typed; the optimizer drops it from any union."""
    return align(spark.sql("SELECT 1 WHERE false"), contract)


def union_drifting(frames: list[DataFrame]) -> DataFrame:
    """Union by name; a column some frames lack is NULL in their rows."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def only_missing(load: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``load`` whose key ``target`` does not hold yet."""
    return load.join(target.select(*keys), keys, "left_anti").select(load.columns)


def upserted(target: DataFrame, load: DataFrame, keys: list[str]) -> DataFrame:
    """``target`` with the rows of ``load`` put in, replacing those with the same key."""
    return only_missing(target, load, keys).unionByName(load)
