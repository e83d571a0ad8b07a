"""Encode texts to SentencePiece ids and back, on whole columns.

The model file's bytes are broadcast (a bounded vocabulary file); each Python worker builds
one coder from them and keeps it, with a bounded cache of words.

Defined cases: a null text is the empty text, which has the begin and end id only; U+2581
reads as a space when decoded, as in the library; rows are coded one by one, so repeated
rows and ids make no difference. Texts are coded in slices of about 1 MB, or one text where
that is longer.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from waveband.llm import flat
from waveband.llm.piece_bpe import PieceCoder

DIGESTS = T.StructType(
    [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
)
_coders: dict[str, PieceCoder] = {}


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _model(spark: SparkSession, path: str | None):
    with open(path or default_model(), "rb") as file:
        return spark.sparkContext.broadcast(file.read())


def _coder(model: bytes) -> PieceCoder:
    key = hashlib.sha256(model).hexdigest()
    if key not in _coders:
        _coders.clear()
        _coders[key] = PieceCoder(model)
    return _coders[key]


def _framed(coder: PieceCoder, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Ids with begin and end of each text, one after the other, and their counts."""
    ids, sizes = coder.encode(texts)
    framed = np.empty(len(ids) + 2 * len(texts), np.int32)
    stop = np.cumsum(sizes + 2)
    inner = np.ones(len(framed), bool)
    inner[stop - 1] = inner[stop - sizes - 2] = False
    framed[inner] = ids
    framed[stop - sizes - 2], framed[stop - 1] = coder.begin, coder.end
    return framed, sizes + 2


def encode(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), text: str = "text", model: str | None = None) -> DataFrame:
    """Columns ``keep`` and ``ids``, the ids with begin and end."""
    source = docs.select(text, *keep)
    schema = T.StructType([*source.schema.fields[1:], T.StructField("ids", T.ArrayType(T.IntegerType()))])
    shared = _model(docs.sparkSession, model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(shared.value)
        for batch in batches:
            for begin, end, _, _ in flat.slices(batch.column(0)):
                part = batch.slice(begin, end - begin)
                ids, sizes = _framed(coder, [t or "" for t in part.column(0).to_pylist()])
                offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
                yield pa.RecordBatch.from_arrays([*part.columns[1:], pa.ListArray.from_arrays(offsets, pa.array(ids))], names=schema.names)

    return source.mapInArrow(run, schema)


def decode(encoded: DataFrame, keep: tuple[str, ...] = ("doc_id",), ids: str = "ids", model: str | None = None) -> DataFrame:
    """Columns ``keep`` and ``decoded``, the text of the ids; null ids are an empty sequence."""
    source = encoded.select(ids, *keep)
    schema = T.StructType([*source.schema.fields[1:], T.StructField("decoded", T.StringType())])
    shared = _model(encoded.sparkSession, model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(shared.value)
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                sequences = [s or [] for s in part.column(0).to_pylist()]
                flat_ids = np.fromiter((i for s in sequences for i in s), np.int64)
                texts = coder.decode(flat_ids, np.array([len(s) for s in sequences]))
                yield pa.RecordBatch.from_arrays([*part.columns[1:], pa.array(texts, pa.string())], names=schema.names)

    return source.mapInArrow(run, schema)


def round_trip(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), text: str = "text", model: str | None = None) -> DataFrame:
    """Columns ``keep`` with counts and digests of the ids and of the decoded text, coded in one pass."""
    source = docs.select(text, *keep)
    schema = T.StructType([*source.schema.fields[1:], *DIGESTS.fields])
    shared = _model(docs.sparkSession, model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(shared.value)
        for batch in batches:
            for begin, end, _, _ in flat.slices(batch.column(0)):
                part = batch.slice(begin, end - begin)
                ids, sizes = _framed(coder, [t or "" for t in part.column(0).to_pylist()])
                raw, stop = ids.astype("<u4").tobytes(), 4 * np.cumsum(sizes)
                of_ids = [hashlib.sha256(raw[b - 4 * n : b]).hexdigest() for b, n in zip(stop.tolist(), sizes.tolist(), strict=True)]
                of_texts = [hashlib.sha256(t.encode()).hexdigest() for t in coder.decode(ids, sizes)]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[1:], pa.array(sizes.astype(np.int64)), pa.array(of_ids), pa.array(of_texts)], names=schema.names)

    return source.mapInArrow(run, schema)
