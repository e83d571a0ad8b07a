"""Language identification with a string kernel.

Kernel: two texts are as alike as the share of byte n-grams (orders 2 to 4, lower-cased A-Z,
presence only, hashed to ``buckets``) that both have: the blended spectrum, divided by the root of
the product of the two counts. Nyström: ``landmarks`` training texts stand for all; a text's kernel
values with them, times the inverse root of the landmarks' own kernel matrix, are its features.
One-versus-rest kernel ridge regression on those gives one column of weights for each language,
so scoring a batch is two matrix products.

The training sample is bounded: the ``per_language`` (300, at most 1000) labelled rows of each
language with the smallest hash of the id, and of what a repeated id brings the different rows. Only text is an input of a prediction.

Defined cases: null text or one without a letter is ``und`` with score 0; so is every row if
there is no labelled row to learn from; equal scores go to the language first in order; rows are
scored one by one, so repeated rows and ids make no difference. Whole texts are read.
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

ORDERS = (2, 3, 4)
BUCKETS = 1 << 13
ROWS = 512


def _letters(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Whether each row has a letter."""
    low = flat.LOWER[data]
    sums = np.concatenate([[0], np.cumsum((low >= 0x61) & (low <= 0x7A))])
    found = sums[offsets[1:]] > sums[offsets[:-1]]
    for i in np.flatnonzero(~found & (np.diff(offsets) > 0)):
        found[i] = any(c.isalpha() for c in data[offsets[i] : offsets[i + 1]].tobytes().decode())
    return found


def _presence(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of zeros and ones for each text: which n-gram buckets it has."""
    low = flat.LOWER[data]
    there = np.zeros((len(offsets) - 1, BUCKETS), np.float32)
    for order in ORDERS:
        row, bucket = flat.gram_buckets(low, offsets, order, BUCKETS)
        there[row, bucket] = 1
    return there


def _kernel(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    sizes = np.sqrt(np.maximum(left.sum(1), 1))[:, None] * np.sqrt(np.maximum(right.sum(1), 1))[None, :]
    return (left @ right.T) / sizes


def _train(presence: np.ndarray, labels: list[str], landmarks: int, ridge: float) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages, landmark rows, and weights of the kernel values."""
    languages = sorted(set(labels))
    own = np.array([languages.index(x) for x in labels])
    each = max(1, landmarks // max(1, len(languages)))
    chosen = np.concatenate([np.flatnonzero(own == k)[:each] for k in range(len(languages))])
    marks = presence[chosen]
    values, vectors = np.linalg.eigh(_kernel(marks, marks).astype(np.float64))
    root = vectors / np.sqrt(np.maximum(values, 1e-6)) @ vectors.T
    features = _kernel(presence, marks).astype(np.float64) @ root
    target = np.where(own[:, None] == np.arange(len(languages))[None, :], 1.0, -1.0)
    weights = np.linalg.solve(features.T @ features + ridge * np.eye(len(chosen)), features.T @ target)
    return languages, marks, (root @ weights).astype(np.float32)


def predict(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
            per_language: int = 300, landmarks: int = 128, ridge: float = 0.1) -> DataFrame:
    """Columns ``keep``, ``lang_pred`` and ``score`` of every row; learnt from the rows that aren't held out."""
    with_letter = F.col(text).rlike(r"\p{L}")
    found = docs.where(samples.bounded(docs, doc_id, lang, per_language) & with_letter).select(
        F.col(text).alias("text"), F.col(lang).alias("lang"), F.col(doc_id).alias("id"))
    chosen = samples.different(written(found, "sample"), "lang", "id", "text", per_language).select("text", "lang", "hash")

    def features(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end, data, offsets in flat.slices(batch.column(0), max_rows=ROWS):
                bits = np.packbits(_presence(data, offsets).astype(bool), axis=1)
                part = batch.slice(begin, end - begin)
                yield pa.RecordBatch.from_arrays([part.column(1), part.column(2), pa.array([b.tobytes() for b in bits], pa.binary())], names=["lang", "hash", "bits"])

    rows = sorted(chosen.mapInArrow(features, "lang string, hash long, bits binary").collect())
    model = None
    if rows:
        presence = np.unpackbits(np.frombuffer(b"".join(bytes(r["bits"]) for r in rows), np.uint8).reshape(len(rows), -1), axis=1)
        model = _train(presence.astype(np.float32), [r["lang"] for r in rows], landmarks, ridge)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # landmarks x buckets numbers

    source = docs.select(text, *keep)
    schema = T.StructType([*source.schema.fields[1:], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end, data, offsets in flat.slices(batch.column(0), max_rows=ROWS):
                names, scores = ["und"] * (end - begin), np.zeros(end - begin)
                if shared.value is not None:
                    languages, marks, weights = shared.value
                    letters = _letters(data, offsets)
                    votes = _kernel(_presence(data, offsets), marks) @ weights
                    best = votes.argmax(1)
                    names = [languages[b] if known else "und" for b, known in zip(best.tolist(), letters.tolist(), strict=True)]
                    scores = np.where(letters, np.clip((votes.max(1).astype(np.float64) + 1) / 2, 0, 1), 0.0)
                kept = [batch.column(i + 1).slice(begin, end - begin) for i in range(len(keep))]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=schema.names)

    return source.mapInArrow(run, schema)
