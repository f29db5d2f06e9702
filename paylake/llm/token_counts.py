"""Token counts of documents in flat, unindexed token files.

A flat file is nothing but token ids, little-endian, each document followed by a separator
id.  Files are read in blocks of bounded size, each by a task of its own.  A block gives
the number of its separators, what lies before the first and after the last, and the
lengths between; a prefix scan over the blocks of a file numbers the documents and adds
up those that run over block boundaries.

``write_flat`` makes such files from documents, with one of the public tokenizers.  A task
writes a file of its own; only files that are named in the manifest, which Spark commits,
belong to the result, so a task may run again at any time.  The manifest has no places of
documents, only their order.

Defined cases: a NULL or empty text has no tokens, and a count of 0.  What follows the last
separator of a file is a document, if it is not empty.  Repeated rows are documents of
their own.  Files whose size is no whole number of ids are refused.  Empty tables give no
rows.  Other columns are ignored.
"""

from __future__ import annotations

import base64
import uuid
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paylake.llm.common import stored
from paylake.session import fresh_path

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# How the public vocabulary splits texts before merging; a fixed value.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# The first id that the vocabulary leaves free ends a document.
SEPARATOR = 50256
ID_TYPE = "<u2"

BLOCK_IDS = 1 << 22

MANIFEST = "file string, place long, doc_id long"


@cache
def _encoding(vocabulary: str):
    import tiktoken

    with open(vocabulary, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("flat", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})


def token_ids(text: str | None, vocabulary: str = VOCABULARY) -> list[int]:
    return _encoding(vocabulary).encode_ordinary(text) if text else []


def write_flat(docs: DataFrame, folder: str, vocabulary: str = VOCABULARY) -> DataFrame:
    """Writes flat files below ``folder`` and gives the manifest: ``file, place, doc_id``, stored."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        name = f"{uuid.uuid4().hex}.ids"
        place = 0
        with store.open_output_stream(f"{base}/{name}") as out:
            for batch in batches:
                for text in batch.column("text"):
                    ids = token_ids(text.as_py(), vocabulary)
                    ids.append(SEPARATOR)
                    out.write(np.array(ids, ID_TYPE).tobytes())
                n = len(batch)
                yield pa.record_batch(
                    [pa.array([f"{folder}/{name}"] * n), pa.array(range(place, place + n), pa.int64()), batch.column("doc_id")],
                    ["file", "place", "doc_id"],
                )
                place += n

    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return stored(rows.mapInArrow(write, MANIFEST), "manifest")


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    width = np.dtype(ID_TYPE).itemsize
    for batch in batches:
        ids = []
        for file in batch.column("file").to_pylist():
            store, path = fs.FileSystem.from_uri(file)
            size = store.get_file_info(path).size
            if size is None or size % width:
                raise ValueError(f"{file} is no file of whole ids: {size} bytes")
            ids.append(size // width)
        yield pa.record_batch([batch.column("file"), pa.array(ids, pa.int64())], ["file", "ids"])


BLOCKS = "file string, block long, ids long, separators long, head long, tail long, inner array<long>"


def _scanned(separator: int, block: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = np.dtype(ID_TYPE).itemsize
        for batch in batches:
            for file, number, n in zip(*(batch.column(c).to_pylist() for c in ("file", "block", "n")), strict=True):
                store, path = fs.FileSystem.from_uri(file)
                with store.open_input_file(path) as source:
                    raw = source.read_at(n * width, number * block * width)
                at = np.flatnonzero(np.frombuffer(raw, ID_TYPE) == separator)
                head = int(at[0]) if len(at) else n
                tail = n - int(at[-1]) - 1 if len(at) else n
                inner = (np.diff(at) - 1).astype(np.int64)
                yield pa.record_batch(
                    [
                        pa.array([file]), pa.array([number], pa.int64()), pa.array([n], pa.int64()),
                        pa.array([len(at)], pa.int64()), pa.array([head], pa.int64()), pa.array([tail], pa.int64()),
                        pa.array([inner], pa.list_(pa.int64())),
                    ],
                    ["file", "block", "ids", "separators", "head", "tail", "inner"],
                )

    return scan


def count_tokens(files: DataFrame, separator: int = SEPARATOR, block: int = BLOCK_IDS) -> DataFrame:
    """Per document of the files in column ``file``: ``file, place, n_tokens``, without the separator."""
    sized = stored(files.select("file").distinct().mapInArrow(_sizes, "file string, ids long"), "file-sizes")
    blocks = sized.where("ids > 0").select(
        "file", "ids", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("ids") - 1) / block))).alias("block")
    ).select("file", "block", F.least(F.lit(block), F.col("ids") - F.col("block") * block).alias("n"))
    scanned = stored(blocks.repartition("file", "block").mapInArrow(_scanned(separator, block), BLOCKS), "blocks")

    in_order = Window.partitionBy("file").orderBy("block")
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    # Blocks between two separators are a segment; its ids so far are carried on.
    segment = F.coalesce(F.sum(F.when(F.col("separators") > 0, 1).otherwise(0)).over(before), F.lit(0))
    summaries = scanned.select("file", "block", "separators", "head", "tail").withColumn("segment", segment).withColumn(
        "place", F.coalesce(F.sum("separators").over(before), F.lit(0))
    )
    in_segment = Window.partitionBy("file", "segment").orderBy("block")
    # The tail of the block that begins a segment belongs to the segment before by number.
    opened = F.lag(F.when(F.col("separators") > 0, F.col("tail"))).over(in_order)
    carried = (
        summaries.withColumn("opened", opened)
        .withColumn("carry", F.coalesce(F.first("opened", ignorenulls=True).over(in_segment.rowsBetween(Window.unboundedPreceding, 0)), F.lit(0))
                    + F.coalesce(F.sum(F.when(F.col("separators") == 0, F.col("head"))).over(in_segment.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    )
    first = carried.where("separators > 0").select("file", "place", (F.col("carry") + F.col("head")).alias("n_tokens"))
    inner = (
        scanned.select("file", "block", F.posexplode("inner").alias("i", "n_tokens"))
        .join(summaries.select("file", "block", "place"), ["file", "block"])
        .select("file", (F.col("place") + F.col("i") + 1).alias("place"), "n_tokens")
    )
    final = F.row_number().over(Window.partitionBy("file").orderBy(F.col("block").desc()))
    rest = carried.withColumn("final", final).where("final = 1").select(
        "file", (F.col("place") + F.col("separators")).alias("place"),
        F.when(F.col("separators") > 0, F.col("tail")).otherwise(F.col("carry") + F.col("head")).alias("n_tokens"),
    ).where("n_tokens > 0")
    return first.unionByName(inner).unionByName(rest)


def document_tokens(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """Per document: ``doc_id, n_tokens``, by way of flat files in the shared folder."""
    manifest = write_flat(docs, fresh_path(docs.sparkSession, "flat"), vocabulary)
    return manifest.join(count_tokens(manifest), ["file", "place"]).select("doc_id", "n_tokens")
