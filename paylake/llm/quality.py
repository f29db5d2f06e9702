"""Quality by regularised quadratic discriminant analysis of document statistics.

Each text becomes a vector of transformed statistics of its whole length.  The sums and
products of the vectors per class are added up by Spark; a class's covariance is shrunk
towards the pooled one and that towards its diagonal.  A score compares the log densities
of the two classes: squared Mahalanobis distances by the inverse Cholesky factors, which
are computed once, plus log determinants and log priors.

Labels are used of rows whose crc32 of the id as text is not divisible by ``FOLDS``; the
others are held out.  The id, the label, language and source are no inputs of a score.

Defined cases: NULL is like the empty text, which has a vector like any other.  NULL ids
and NULL labels are not learnt from; a NULL id is not held out.  Several labels of an id all
count, and so does each row of a repeated id.  Where a class has no labels, all scores are
the share of good labels with one of each added.  Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from paylake.llm.common import stored, unused
from paylake.llm.shingles import PIECE, text_buffer, words_of

FOLDS = 5
THRESHOLD = 0.3

# Shares of the pooled covariance in a class's, and of its diagonal in the pooled one.
TOWARDS_POOLED = 0.1
TOWARDS_DIAGONAL = 0.1
# Added to variances, in units of the pooled ones.
LEAST_VARIANCE = 0.01
# Statistics that hardly differ are scaled as if they differed by so much.
LEAST_SPREAD = 1e-3
# Log odds are cut at this distance from 0.
MOST_LOG_ODDS = 30.0

_UPPER = np.zeros(256, bool)
_UPPER[ord("A") : ord("Z") + 1] = True
_LETTER = np.zeros(256, bool)
_LETTER[ord("a") : ord("z") + 1] = True
_LETTER |= _UPPER
_LETTER[0x80:] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[ord("0") : ord("9") + 1] = True
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".,;:'\"()-"]] = True
_LOUD = np.zeros(256, bool)
_LOUD[[ord(c) for c in "!?"]] = True
_PRINTED = np.zeros(256, bool)
_PRINTED[0x21:0x7F] = True
_SYMBOL = _PRINTED & ~_LETTER & ~_DIGIT & ~_STOP & ~_LOUD

STATISTICS = (
    "words", "word_length", "word_spread", "upper", "symbols", "loud", "stops", "digits",
    "distinct", "repeats", "capitals", "line", "odd_ends", "commonest",
)


def _rate(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """Shares, transformed so that their spread does not depend on their size."""
    return np.arcsin(np.sqrt(np.minimum(part / np.maximum(whole, 1), 1)))


def _statistics(raw: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    n = len(bounds) - 1
    which = np.repeat(np.arange(n), np.diff(bounds))
    bytes_of = np.bincount(which * 256 + raw, minlength=n * 256).reshape(n, 256)
    starts, lengths, hashes, doc = words_of(raw, bounds)
    count = np.bincount(doc, minlength=n)
    some = np.maximum(count, 1)
    mean = np.bincount(doc, lengths, n) / some
    spread = np.sqrt(np.maximum(np.bincount(doc, lengths.astype(float) ** 2, n) / some - mean**2, 0))
    again = np.flatnonzero((hashes[1:] == hashes[:-1]) & (doc[1:] == doc[:-1])) + 1
    order = np.lexsort((hashes, doc))
    new = np.ones(len(order), bool)
    new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (doc[order][1:] != doc[order][:-1])
    first = np.flatnonzero(new)
    times = np.diff(np.append(first, len(order)))
    commonest = np.zeros(n, np.int64)
    np.maximum.at(commonest, doc[order][first], times)
    distinct = np.bincount(doc[order][first], minlength=n)
    last = raw[starts + lengths - 1]
    seen = lambda kinds: bytes_of[:, kinds].sum(axis=1)
    letters, printed = seen(_LETTER), seen(_LETTER | _PRINTED)
    return np.column_stack([
        np.log1p(count),
        np.log1p(mean),
        np.log1p(spread),
        _rate(seen(_UPPER), letters),
        _rate(seen(_SYMBOL), printed),
        _rate(seen(_LOUD), printed),
        _rate(seen(_STOP), printed),
        _rate(seen(_DIGIT), printed),
        np.log1p(distinct) / np.log1p(some),
        _rate(np.bincount(doc[again], minlength=n), some),
        _rate(np.bincount(doc[_UPPER[raw[starts]]], minlength=n), some),
        np.log1p(count / (bytes_of[:, 0x0A] + 1)),
        _rate(np.bincount(doc[_SYMBOL[last] | _LOUD[last]], minlength=n), some),
        _rate(commonest, some),
    ])


def statistics(texts: pa.Array) -> np.ndarray:
    """The vectors of the texts, one row each."""
    raw, bounds = text_buffer(texts)
    parts, at = [np.empty((0, len(STATISTICS)))], 0
    while at < len(texts):
        to = max(int(np.searchsorted(bounds, bounds[at] + PIECE, "right")) - 1, at + 1)
        parts.append(_statistics(raw[bounds[at] : bounds[to]], bounds[at : to + 1] - bounds[at]))
        at = to
    return np.concatenate(parts)


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = statistics(batch.column("text"))
        lists = pa.ListArray.from_arrays(
            pa.array(np.arange(len(rows) + 1, dtype=np.int32) * len(STATISTICS)), pa.array(rows.ravel())
        )
        yield pa.record_batch([batch.column("doc_id"), lists], ["doc_id", "x"])


def vectors(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the vector ``x`` of each document, stored."""
    found = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_vectors, "doc_id long, x array<double>")
    return stored(found, "vectors")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == 0, F.lit(False))


@dataclass(frozen=True)
class Model:
    """Two Gaussian classes in standardised space, or only the share of good labels."""

    prior: float
    center: np.ndarray | None = None
    scale: np.ndarray | None = None
    means: tuple[np.ndarray, ...] = ()
    # Inverse Cholesky factors of the two covariances, and halves of their log determinants.
    factors: tuple[np.ndarray, ...] = ()
    volumes: tuple[float, ...] = ()

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.center is None:
            return np.full(len(x), self.prior)
        z = (x - self.center) / self.scale
        log_density = [
            -0.5 * np.sum(((z - m) @ f.T) ** 2, axis=1) - v
            for m, f, v in zip(self.means, self.factors, self.volumes, strict=True)
        ]
        odds = np.log(self.prior / (1 - self.prior)) + log_density[1] - log_density[0]
        return 1 / (1 + np.exp(-np.clip(odds, -MOST_LOG_ODDS, MOST_LOG_ODDS)))


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        good = batch.column("quality").to_numpy()
        x = batch.column("x").flatten().to_numpy().reshape(-1, len(STATISTICS))
        for label in (0, 1):
            own = x[good == label]
            sums = np.concatenate([[len(own)], own.sum(axis=0), (own.T @ own).ravel()])
            yield pa.record_batch(
                [pa.array([label] * len(sums)), pa.array(range(len(sums))), pa.array(sums)], ["label", "k", "v"]
            )


def fit(found: DataFrame, labels: DataFrame) -> Model:
    """The model of the labelled rows that are not held out, all of them."""
    known = labels.select(F.col("doc_id").cast("long"), F.col("quality").cast("int")).where(
        "quality IN (0, 1)"
    ).where(~held_out(F.col("doc_id")))
    d = len(STATISTICS)
    sums = np.zeros((2, 1 + d + d * d))
    moments = found.join(known, "doc_id").select("quality", "x").mapInArrow(_moments, "label long, k long, v double")
    for row in moments.groupBy("label", "k").agg(F.sum("v").alias("v")).collect():  # two rows for each k
        sums[row["label"], row["k"]] = row["v"]
    counts = sums[:, 0]
    prior = float((counts[1] + 1) / (counts.sum() + 2))
    if counts.min() == 0:
        return Model(prior)
    means = sums[:, 1 : 1 + d] / counts[:, None]
    within = [
        sums[k, 1 + d :].reshape(d, d) / counts[k] - np.outer(means[k], means[k]) for k in (0, 1)
    ]
    pooled = (counts[0] * within[0] + counts[1] * within[1]) / counts.sum()
    center = (counts @ means) / counts.sum()
    scale = np.sqrt(np.maximum(np.diag(pooled), LEAST_SPREAD**2))
    pooled = pooled / np.outer(scale, scale)
    pooled = (1 - TOWARDS_DIAGONAL) * pooled + TOWARDS_DIAGONAL * np.diag(np.diag(pooled))
    factors, volumes = [], []
    for k in (0, 1):
        own = within[k] / np.outer(scale, scale)
        # Few rows lean on the pooled covariance more.
        share = max(TOWARDS_POOLED, d / (counts[k] + d))
        covariance = (1 - share) * own + share * pooled + LEAST_VARIANCE * np.eye(d)
        lower = np.linalg.cholesky(covariance)
        factors.append(np.linalg.inv(lower))
        volumes.append(float(np.log(np.diag(lower)).sum()))
    return Model(
        prior, center, scale, tuple((means - center) / scale), tuple(factors), tuple(volumes)
    )


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per document: ``doc_id, held_out, score, predicted``."""
    found = vectors(docs)
    model = fit(found, labels)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("x").flatten().to_numpy().reshape(-1, len(STATISTICS))
            yield pa.record_batch([batch.column("doc_id"), pa.array(model.scores(x))], ["doc_id", "score"])

    return found.mapInArrow(score, "doc_id long, score double").select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def good_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that the classifier does not reject, with their columns."""
    model = fit(vectors(docs), labels)
    name = unused("score", docs.columns)
    schema = StructType([*docs.schema.fields, StructField(name, DoubleType())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = model.scores(statistics(batch.column("text")))
            yield pa.record_batch([*batch.columns, pa.array(scores)], [*batch.schema.names, name])

    return docs.mapInArrow(score, schema).where(F.col(name) >= threshold).select(*docs.columns)
