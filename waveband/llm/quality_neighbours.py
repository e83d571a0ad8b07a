"""Quality by the votes of the nearest labelled documents.

Terms are byte n-grams (orders 1 to 3, hashed to ``BUCKETS``) by the logarithm of their count, and
shape terms: in which of sixteen steps the text's length, its shares of marks, capitals and digits,
of different byte 7-grams and of words that equal the one before lie. Weighted by inverse document frequency and projected on
the leading right singular vectors of the labelled sample, they make the latent-semantic vectors.
The labelled vectors are broadcast; each block of documents is multiplied with all of them, so the
cosines are exact, and the ``neighbours`` nearest vote, each by a power of its similarity.

The labelled sample is bounded: the ``per_label`` (at most 1000) rows of each label with the smallest
hash of the id, and of what a repeated id brings the different rows of smallest hash; votes are weighted back to the labels' shares in the labelled rows. Labels,
language, source and id are never inputs of a score.

Defined cases: null and empty texts have shape terms only and are scored like others; without a
labelled row every score is 0.5; a document with several labels votes with each; rows are scored
one by one, so repeated rows and ids make no difference. Whole texts are read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waveband.llm import flat, samples
from waveband.llm.shared import written

ORDERS = (1, 2, 3)
BUCKETS = 1 << 11
STEPS = 16
SHAPES = 6
SHAPE_WEIGHT = 0.8
ROWS = 512
_MARKS = np.zeros(256, bool)
_MARKS[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = True
_MARKS[[0x2E, 0x2C]] = False  # full stop and comma belong to prose


def _share(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(mask)])
    return (sums[offsets[1:]] - sums[offsets[:-1]]) / np.maximum(np.diff(offsets), 1)


def _terms(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Term weights before inverse document frequency: a row for each text."""
    n = len(offsets) - 1
    counts = np.zeros(n * BUCKETS, np.int64)
    for order in ORDERS:
        row, bucket = flat.gram_buckets(data, offsets, order, BUCKETS)
        counts += np.bincount(row * BUCKETS + bucket, minlength=n * BUCKETS)
    terms = np.log1p(counts.reshape(n, BUCKETS).astype(np.float32))
    terms /= np.maximum(np.linalg.norm(terms, axis=1, keepdims=True), 1e-6)
    row, gram = flat.gram_buckets(data, offsets, 7, 1 << 20)
    own = np.sort(row * (1 << 20) + gram)
    different = np.bincount(own[np.append(True, own[1:] != own[:-1])] >> 20, minlength=n) if len(own) else np.zeros(n)
    many = np.bincount(row, minlength=n)
    starts, ends = flat.word_spans(~flat.BLANK[data], offsets)
    words, bounds = flat.word_hashes(data, starts, ends), flat.word_bounds(starts, offsets)
    again = np.zeros(len(words) + 1, np.int64)
    np.cumsum(np.append(False, words[1:] == words[:-1])[: len(words)], out=again[1:])
    shares = [
        np.log2(np.diff(offsets) + 1.0) / 20,
        np.sqrt(_share(_MARKS[data], offsets)) * 1.5,
        np.sqrt(_share((data >= 0x41) & (data <= 0x5A), offsets)),
        np.sqrt(_share((data >= 0x30) & (data <= 0x39), offsets)),
        np.where(many > 0, different / np.maximum(many, 1), 1.0),
        np.sqrt((again[bounds[1:]] - again[bounds[:-1]]) / np.maximum(np.diff(bounds), 1)),
    ]
    shape = np.zeros((n, SHAPES * STEPS), np.float32)
    for k, share in enumerate(shares):
        # a text stands between two steps, so near values stay near
        at = np.clip(share, 0, 1) * (STEPS - 1)
        low = np.floor(at).astype(np.int64)
        shape[np.arange(n), k * STEPS + low] = 1 - (at - low)
        shape[np.arange(n), k * STEPS + np.minimum(low + 1, STEPS - 1)] += at - low
    return np.concatenate([terms, shape * SHAPE_WEIGHT], axis=1)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def _fit(terms: np.ndarray, dimensions: int) -> tuple[np.ndarray, np.ndarray]:
    """The projection with inverse document frequencies in it, and the vectors of the sample."""
    seen = (terms > 0).sum(0)
    weight = np.log((len(terms) + 1) / (seen + 1)) + 0.25
    weight[BUCKETS:] = 1
    weighted = (terms * weight).astype(np.float64)
    values, vectors = np.linalg.eigh(weighted.T @ weighted)
    leading = vectors[:, np.argsort(-values)[:dimensions]]
    projection = (weight[:, None] * leading).astype(np.float32)
    return projection, _unit(terms @ projection)


def score(docs: DataFrame, labels: DataFrame, keep: tuple[str, ...] = ("doc_id",), doc_id: str = "doc_id", text: str = "text",
          label: str = "quality", per_label: int = 1000, dimensions: int = 64, neighbours: int = 25, power: int = 8) -> DataFrame:
    """Columns ``keep`` and ``score`` of every row: how likely the label is 1."""
    known = labels.where(F.col(label).isin(0, 1)).select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("label"))
    totals = {r["label"]: r["count"] for r in known.where(~samples.held_out("id")).groupBy("label").count().collect()}
    chosen = known.where(samples.bounded(known, "id", "label", per_label)).distinct()  # a bounded table, so it is broadcast
    found = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).join(F.broadcast(chosen), "id")
    texts = samples.different(written(found, "sample"), "label", "id", "text", per_label).select("text", "label", "hash")

    def features(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end, data, offsets in flat.slices(batch.column(0), max_rows=ROWS):
                terms = _terms(data, offsets).astype("<f4")
                part = batch.slice(begin, end - begin)
                yield pa.RecordBatch.from_arrays([part.column(1), part.column(2), pa.array([t.tobytes() for t in terms], pa.binary())], names=["label", "hash", "terms"])

    rows = sorted(texts.mapInArrow(features, "label int, hash long, terms binary").collect())
    model = None
    if rows:
        terms = np.frombuffer(b"".join(bytes(r["terms"]) for r in rows), "<f4").reshape(len(rows), -1)
        own = np.array([r["label"] for r in rows])
        projection, vectors = _fit(terms, dimensions)
        share = np.array([totals.get(x, 0) / max(1, (own == x).sum()) for x in (0, 1)])
        model = projection, vectors.T.copy(), own, (share / max(share.sum(), 1e-12))[own]
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most 2 x per_label vectors

    source = docs.select(text, *keep)
    schema = T.StructType([*source.schema.fields[1:], T.StructField("score", T.DoubleType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end, data, offsets in flat.slices(batch.column(0), max_rows=ROWS):
                scores = np.full(end - begin, 0.5)
                if shared.value is not None:
                    projection, vectors, own, weight = shared.value
                    cosines = _unit(_terms(data, offsets) @ projection) @ vectors
                    near = np.argpartition(-cosines, min(neighbours, cosines.shape[1]) - 1, axis=1)[:, :neighbours]
                    vote = np.maximum(np.take_along_axis(cosines, near, 1), 1e-6).astype(np.float64) ** power * weight[near]
                    scores = (vote * own[near]).sum(1) / vote.sum(1)
                kept = [batch.column(i + 1).slice(begin, end - begin) for i in range(len(keep))]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(scores)], names=schema.names)

    return source.mapInArrow(run, schema)
