"""Stored tables: Parquet folders partitioned by snapshot day or start day."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from paylake import schemas as S
from paylake.operators.merge import align, empty


def of_days(
    frame: DataFrame, first: str | dt.date | None, last: str | dt.date | None = None
) -> DataFrame:
    """Rows of the snapshot days from ``first`` to ``last``; a partition filter on stored tables."""
    if first is None:
        return frame
    return frame.where(f"{S.SNAPSHOT} BETWEEN date '{first}' AND date '{last or first}'")


def is_missing_path(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def table_exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.schema(T.StructType([])).parquet(path)
        return True
    except AnalysisException as error:
        if not is_missing_path(error):
            raise
        return False


def read_table(spark: SparkSession, path: str, contract: T.StructType) -> DataFrame:
    """The table in its contract's columns; an absent table has no rows.

    The contract is the read schema: no file is opened to find one, and columns
    an old file lacks are NULL.
    """
    if not table_exists(spark, path):
        return empty(spark, contract)
    return spark.read.schema(contract).parquet(path).select(contract.fieldNames())


def read_drifted(spark: SparkSession, path: str, contract: T.StructType) -> DataFrame:
    """The table with all columns any of its files has, the contract's first."""
    if not table_exists(spark, path):
        return empty(spark, contract)
    try:
        stored = spark.read.option("mergeSchema", True).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        return empty(spark, contract)  # the table exists but holds no file yet
    extra = [field for field in stored.schema.fields if field.name not in contract.fieldNames()]
    return align(stored, T.StructType(contract.fields + extra))


def read_delivered(spark: SparkSession, path: str) -> DataFrame | None:
    """The table with just the columns its files have; None while it has no file."""
    if not table_exists(spark, path):
        return None
    try:
        return spark.read.option("mergeSchema", True).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        return None


def read_landing(
    spark: SparkSession,
    path: str,
    contract: T.StructType,
    first: str | dt.date | None = None,
    last: str | dt.date | None = None,
) -> DataFrame:
    """Landed documents of a range of days, or all of them; days are a partition filter."""
    return of_days(read_table(spark, path, contract), first, last)
