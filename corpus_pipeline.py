"""The corpus pipeline: from raw documents to a mix of good, distinct and clean ones.

Each stage is ``(spark, docs, sf_dir) -> DataFrame``; its result is written as Parquet to
the shared folder and read again as the next stage's documents, so a lost executor costs
the tasks of one stage.  All but the last keep the columns of ``documents``:

* ``quality``  documents that the quality classifier rejects go;
* ``distinct``  of each group of similar documents the one of the smallest id stays;
* ``decontaminated``  documents contaminated with benchmark passages go;
* ``secrets``  secrets are masked in the text, and ``n_chars`` follows;
* ``mix``  per document its size, its source's size and target, and the words that the mix takes.

NULL texts, repeated rows, empty tables and further columns are dealt with as the
operators say; the classifier judges empty texts like others, and the mix never takes them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from paylake.llm import decontamination, mixing, ngram_join, quality, secrets
from paylake.llm.common import discard, kept, scratch, table
from paylake.session import configure


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.good_documents(docs, table(configure(spark), sf_dir, "labels"))


def keep_distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    configure(spark)
    return ngram_join.one_of_each_group(docs)


def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.clean(docs, table(configure(spark), sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    configure(spark)
    return secrets.masked(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    configure(spark)
    return mixing.mix(docs)


STAGES = [
    ("quality", keep_good),
    ("distinct", keep_distinct),
    ("decontaminated", keep_clean),
    ("secrets", mask_secrets),
    ("mix", mix),
]

# A classifier and connected components are beyond SQL; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; what stages leave behind on the way is deleted."""
    docs, last = table(configure(spark), sf_dir, "documents"), None
    for name, stage in STAGES:
        with scratch(spark):
            docs = kept(stage(spark, docs, sf_dir), name)
        if last is not None:
            discard(last)
        last = docs
    return docs
