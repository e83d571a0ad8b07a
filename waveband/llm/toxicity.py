"""Toxicity by logistic regression with the FTRL-proximal rule.

Features are the hashed word n-grams (one and two words) and skip-grams (two words with one between
them) of a text, in ``2 ** BITS`` buckets. Words are the runs of ASCII letters, digits
and all non-ASCII characters after lower-casing A-Z; a word longer than four (six) bytes also counts by
its first four (six), so that endings of the same stem share a weight. A feature's value is the root of its
occurrences for each word of the text (so that a long text has no more weight than a short one, and a stem
that clean texts have once by chance isn't one that makes up a fiftieth of a text), times ``SCALE``; the share is
taken as a power of two, down to ``2 ** -LEVELS``. Each coordinate has a rate of its
own, from the sum of its squared gradients, and L1 keeps most weights at zero: what is broadcast is a list of
the others, and a score is the logistic function of their sum over a text's features and a bias.

The labelled sample is bounded: the ``per_label`` (2000) rows of each label with the smallest hash of the
id, at most 2 ** BITS half bytes of features each (131 KB, so 524 MB if all texts were that long). A row of the rarer label weighs ``balance`` times (as a power)
what the other label has more. The sample is gone through ``epochs`` times in a seeded order.
Labels, language, source and id are never inputs of a score; rows whose
crc32 of the id, modulo 3, is 1 are never learnt from.

Defined cases: a null or empty text has the bias only; without a labelled row every score is 0.5; a
document with both labels is learnt from with both; rows are scored one by one, so repeated rows and ids
make no difference. Whole texts are read; a task holds some 100 bytes for each word of a slice of texts
(1 MB, or one longer text).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waveband.llm import flat, samples
from waveband.llm.shared import written

BITS = 18
STEMS = (4, 6)
#: shares of a text are told apart down to 2 ** -LEVELS
LEVELS = 14
SCALE = 10.0
#: words that may stand between the two of a pair: none for n-grams, one for skip-grams
SKIPS = (0, 1)


def learns(doc_id: str) -> Column:
    return ~samples.held_out(doc_id, 3, 1)


def _parts(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each kind of feature: the row and the bucket of its occurrences."""
    low = flat.LOWER[data]
    starts, ends = flat.word_spans(flat.ALNUM[low], offsets)
    words = flat.word_hashes(low, starts, ends)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(flat.word_bounds(starts, offsets)))
    bucket = lambda x: (flat.mix(x) & np.uint64((1 << BITS) - 1)).astype(np.int64)
    yield row, bucket(words + np.uint64(1))
    for size in STEMS:
        longer = ends - starts > size
        yield row[longer], bucket(flat.word_hashes(low, starts[longer], starts[longer] + size) + np.uint64(size * 1000))
    for skip in SKIPS:
        n = max(len(words) - 1 - skip, 0)
        second = words[skip + 1 : skip + 1 + n]
        own = row[:n] == row[skip + 1 : skip + 1 + n]
        yield row[:n][own], bucket(words[:n][own] * np.uint64(3) + flat.mix(second[own] + np.uint64(skip + 2)))


def _levels(count: np.ndarray, n_words: np.ndarray) -> np.ndarray:
    """How often the number of words can be halved without getting below the count, at most ``LEVELS`` times."""
    level = np.zeros(len(count), np.int64)
    for k in range(1, LEVELS + 1):
        level += n_words >= count << k
    return level


def _features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, bucket and level of the features of each text, each once, in order."""
    n = len(offsets) - 1
    parts = _parts(data, offsets)
    if n == 1:
        many, n_words = np.zeros(1 << BITS, np.int64), None
        for _, bucket in parts:
            n_words = len(bucket) if n_words is None else n_words  # the words come first
            many += np.bincount(bucket, minlength=1 << BITS)
        buckets = np.flatnonzero(many)
        return np.zeros(len(buckets), np.int64), buckets, _levels(many[buckets], np.full(len(buckets), n_words))
    keys = [(row << BITS) | bucket for row, bucket in parts]
    n_words = np.bincount(keys[0] >> BITS, minlength=n)
    found, many = np.unique(np.concatenate(keys), return_counts=True)
    row = found >> BITS
    return row, found & ((1 << BITS) - 1), _levels(many, n_words[row])


def _value(level: np.ndarray) -> np.ndarray:
    return SCALE * np.sqrt(0.5**level)


def _packed(buckets: np.ndarray, level: np.ndarray) -> bytes:
    """A text's features as numbers, or as half a byte for each bucket (0 if it isn't there) if that is shorter."""
    if 4 * len(buckets) < 1 << (BITS - 1):
        return (buckets << 4 | level).astype("<i4").tobytes()
    there = np.zeros(1 << BITS, np.uint8)
    there[buckets] = level + 1
    return (there[::2] << 4 | there[1::2]).tobytes()


def _unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    if len(data) < 1 << (BITS - 1):
        both = np.frombuffer(data, "<i4").astype(np.int64)
        return both >> 4, both & 15
    half = np.frombuffer(data, np.uint8)
    there = np.stack([half >> 4, half & 15], axis=1).ravel()
    buckets = np.flatnonzero(there)
    return buckets, there[buckets].astype(np.int64) - 1


def _weight(z: np.ndarray, n: np.ndarray, alpha: float, beta: float, l1: float, l2: float) -> np.ndarray:
    """The weights that minimise the proximal problem: zero where the sum of gradients stays within L1."""
    return np.where(np.abs(z) <= l1, 0.0, (np.sign(z) * l1 - z) / ((beta + np.sqrt(n)) / alpha + l2))


def train(texts: list[bytes], labels: list[int], epochs: int, alpha: float, beta: float, l1: float, l2: float,
          balance: float) -> tuple[np.ndarray, np.ndarray, float]:
    """Buckets and values of the weights that aren't zero, and the bias, from packed texts. The last coordinate is the bias, without L1 and L2."""
    size = 1 << BITS
    z, n = np.zeros(size + 1), np.zeros(size + 1)
    many = [max(1, labels.count(k)) for k in (0, 1)]
    weigh = [(max(many) / many[k]) ** balance for k in (0, 1)]
    bias = lambda: -z[size] / ((beta + np.sqrt(n[size])) / alpha)
    order = np.random.default_rng(1)
    for _ in range(epochs):
        for i in order.permutation(len(texts)):
            own, level = _unpacked(texts[i])
            at, value = np.append(own, size), np.append(_value(level), 1.0)
            now = np.append(_weight(z[own], n[own], alpha, beta, l1, l2), bias())
            gradient = (1 / (1 + np.exp(-np.clip(now @ value, -35, 35))) - labels[i]) * weigh[labels[i]] * value
            grown = n[at] + gradient * gradient
            z[at] += gradient - (np.sqrt(grown) - np.sqrt(n[at])) / alpha * now
            n[at] = grown
    weights = _weight(z[:size], n[:size], alpha, beta, l1, l2)
    kept = np.flatnonzero(weights)
    return kept, weights[kept], float(bias())


def score(docs: DataFrame, labels: DataFrame, keep: tuple[str, ...] = ("doc_id",), doc_id: str = "doc_id", text: str = "text",
          label: str = "toxic", per_label: int = 2000, epochs: int = 10, alpha: float = 3.0, beta: float = 1.0, l1: float = 8.0,
          l2: float = 1.0, balance: float = 0.5) -> DataFrame:
    """Columns ``keep`` and ``score`` of every row: how likely the label is 1."""
    known = labels.where(F.col(label).isin(0, 1)).select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("label"))
    chosen = known.where(samples.bounded(known, "id", "label", per_label, learns("id"))).distinct()  # a bounded table, so it is broadcast
    texts = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).join(F.broadcast(chosen), "id")
    sample = samples.different(written(texts, "sample"), "label", "id", "text", per_label).select("text", "label", "hash")

    def features(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end, data, offsets in flat.slices(batch.column(0)):
                row, bucket, level = _features(data, offsets)
                cuts = np.searchsorted(row, np.arange(end - begin + 1))
                packed = [_packed(bucket[a:b], level[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
                part = batch.slice(begin, end - begin)
                yield pa.RecordBatch.from_arrays([part.column(1), part.column(2), pa.array(packed, pa.binary())], names=["label", "hash", "features"])

    rows = sorted(sample.mapInArrow(features, "label int, hash long, features binary").collect())
    model = None
    if rows:
        model = train([bytes(r["features"]) for r in rows], [r["label"] for r in rows], epochs, alpha, beta, l1, l2, balance)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # the weights that aren't zero, 2 ** BITS at most

    source = docs.select(text, *keep)
    schema = T.StructType([*source.schema.fields[1:], T.StructField("score", T.DoubleType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = np.zeros(1 << BITS)
        if shared.value is not None:
            weights[shared.value[0]] = shared.value[1]
        for batch in batches:
            for begin, end, data, offsets in flat.slices(batch.column(0)):
                scores = np.full(end - begin, 0.5)
                if shared.value is not None:
                    row, bucket, level = _features(data, offsets)
                    total = np.bincount(row, weights[bucket] * _value(level), minlength=end - begin) + shared.value[2]
                    scores = 1 / (1 + np.exp(-np.clip(total, -700, 700)))
                kept = [batch.column(i + 1).slice(begin, end - begin) for i in range(len(keep))]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(scores)], names=schema.names)

    return source.mapInArrow(run, schema)
