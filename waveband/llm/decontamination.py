"""Benchmark decontamination with an FM-index per shard of documents.

Benchmark items are cut into windows of ten consecutive words (an item of one to nine
words is one window). Items are hashed by a Spark job and dealt by hash to blocks of about half of
``block_words`` words (no more than those of one item, if that is larger); one block at a time comes to the
driver, is broadcast for its pass over the documents, and goes. Each task indexes its documents slice by slice, searches all windows backwards
through the wavelet ranks, locates the occurrences by sampled suffix positions and
merges them into spans of words.

Words are compared by a 64-bit hash, after lower-casing A-Z. Words that no window has
can't be part of an occurrence, so a run of them is one separator in the index, and runs
of window words shorter than the shortest window are left out.

Defined cases: null text has no words, in documents and items; items without words have
no windows; several items may hold the same window and all count; items with one id count
once; a null item id reads as the empty string. Rows are judged one by one, so repeated
rows and ids make no difference; an empty benchmark leaves every document clean.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waveband.llm import flat
from waveband.llm.fm_index import FMIndex
from waveband.llm.shared import fresh_name, written

WINDOW = 10
BLOCK_WORDS = 250_000
SHARD_BYTES = 4 << 20

SPANS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
ITEMS = T.ArrayType(T.StringType())


@dataclass(frozen=True)
class Windows:
    """The windows of one block: symbols by position in ``vocabulary`` plus one."""

    vocabulary: np.ndarray
    phrases: list[np.ndarray]  # of one length each
    owners: list[list[np.ndarray]]  # for each phrase its items' positions in ids
    ids: list[str]

    @property
    def shortest(self) -> int:
        return min((p.shape[1] for p in self.phrases), default=0)


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    low = flat.LOWER[data]
    starts, ends = flat.word_spans(flat.ALNUM[low], offsets)
    return starts, ends, flat.word_hashes(low, starts, ends)


def _windows(items: list[tuple[str, np.ndarray]]) -> Windows:
    vocabulary = np.unique(np.concatenate([h for _, h in items])) if items else np.zeros(0, np.uint64)
    ids: dict[str, int] = {}
    found: dict[int, dict[bytes, list[int]]] = {}
    for name, hashes in items:
        owner = ids.setdefault(name, len(ids))
        symbols = np.searchsorted(vocabulary, hashes) + 1
        size = min(WINDOW, len(symbols))
        for window in np.lib.stride_tricks.sliding_window_view(symbols, size):
            owners = found.setdefault(size, {}).setdefault(window.astype(np.int64).tobytes(), [])
            if owner not in owners[-1:]:
                owners.append(owner)
    return Windows(
        vocabulary,
        [np.frombuffer(b"".join(w), np.int64).reshape(-1, size) for size, w in found.items()],
        [[np.array(o) for o in w.values()] for w in found.values()],
        list(ids),
    )


def _hashed(benchmark: DataFrame, item_id: str, text: str) -> DataFrame:
    """``(item, n, words)`` of the items that have words: their hashes as bytes."""
    source = benchmark.select(F.col(text).alias("text"), F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end, data, offsets in flat.slices(batch.column(0)):
                starts, _, hashes = _words(data, offsets)
                bounds = flat.word_bounds(starts, offsets)
                words = pa.array([hashes[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(1).slice(begin, end - begin), pa.array(np.diff(bounds)), words], names=["item", "n", "words"])

    return source.mapInArrow(run, "item string, n long, words binary").where("n > 0")


def window_blocks(benchmark: DataFrame, item_id: str, text: str, block_words: int) -> tuple[int, Iterator[Windows]]:
    """How many blocks there are, and the windows of each in turn; at least one block."""
    items = written(_hashed(benchmark, item_id, text), "items")
    total = items.agg(F.sum("n")).collect()[0][0] or 0
    many = 1 if total <= block_words else -(-2 * total // block_words)

    def blocks() -> Iterator[Windows]:
        for k in range(many):
            # a block's hashes, some eight bytes for each of its words
            rows = items.where(F.pmod(F.xxhash64("words"), F.lit(many)) == k).select("item", "words").collect()
            rows.sort(key=lambda r: (r["item"], bytes(r["words"])))
            yield _windows([(r["item"], np.frombuffer(r["words"], np.uint64)) for r in rows])

    return many, blocks()


def _occurrences(symbols: np.ndarray, row: np.ndarray, windows: Windows) -> Iterator[tuple[np.ndarray, np.ndarray, int, list[np.ndarray]]]:
    """For each window length: word positions of the occurrences, their phrases, the length, the phrases' owners."""
    known = symbols > 0
    edge = np.ones(len(symbols), bool)
    edge[1:] = row[1:] != row[:-1]
    first = known & (edge | ~np.concatenate([[False], known[:-1]]))
    last = known & (np.append(edge[1:], True) | ~np.append(known[1:], False))
    begin, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    long = end - begin >= windows.shortest
    begin, size = begin[long], (end - begin)[long]
    if not len(begin):
        return
    # the runs one after the other, each with a separator behind it
    stop = np.cumsum(size + 1)
    word = np.arange(stop[-1]) + np.repeat(begin - (stop - size - 1), size + 1)
    text = symbols[np.minimum(word, len(symbols) - 1)]
    text[stop - 1] = 0
    index = FMIndex(text, len(windows.vocabulary))
    for phrases, owners in zip(windows.phrases, windows.owners, strict=True):
        low, high = index.rows_of(phrases)
        hits = np.flatnonzero(high > low)
        if not len(hits):
            continue
        count = (high - low)[hits]
        rows = np.arange(count.sum()) + np.repeat(low[hits] - np.cumsum(count) + count, count)
        yield word[index.locate(rows)], np.repeat(hits, count), phrases.shape[1], owners


def _scan(column: pa.Array, windows: Windows) -> Iterator[tuple]:
    """For each slice: first row, end row, bytes, offsets, word starts and ends, word bounds of the rows, hit words, items by row."""
    for begin, end, data, offsets in flat.slices(column, SHARD_BYTES):
        starts, ends, hashes = _words(data, offsets)
        bounds = flat.word_bounds(starts, offsets)
        hit = np.zeros(len(starts) + 1, np.int64)
        items: dict[int, set[int]] = {}
        if len(starts) and len(windows.vocabulary):
            at = np.minimum(np.searchsorted(windows.vocabulary, hashes), len(windows.vocabulary) - 1)
            symbols = np.where(windows.vocabulary[at] == hashes, at + 1, 0)
            row = np.repeat(np.arange(end - begin), np.diff(bounds))
            for position, phrase, size, owners in _occurrences(symbols, row, windows):
                np.add.at(hit, position, 1)
                np.subtract.at(hit, position + size, 1)
                pairs = np.unique(np.stack([row[position], phrase], axis=1), axis=0)
                for r, p in pairs.tolist():
                    items.setdefault(r, set()).update(owners[p].tolist())
        yield begin, end, data, offsets, starts, ends, bounds, np.cumsum(hit[:-1]) > 0, items


def _runs(hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edges = np.diff(np.concatenate([[0], hit.view(np.int8), [0]]))
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def _cut(raw: bytes, starts: np.ndarray, ends: np.ndarray, hit: np.ndarray) -> str:
    """The text without the bytes from the first to the last word of each run of hit words."""
    parts, at = [], 0
    for a, b in zip(*_runs(hit), strict=True):
        parts.append(raw[at : starts[a]])
        at = int(ends[b - 1])
    return b"".join([*parts, raw[at:]]).decode()


def _passes(docs: DataFrame, benchmark: DataFrame, text: str, item_id: str, item_text: str, block_words: int,
            keep_text: bool, cut: str | None) -> tuple[DataFrame, str, str, str]:
    """The rows of ``docs`` with words, merged spans and items, after one pass for each block of windows.

    With ``cut`` the last pass removes the spans from the texts, and sets the column of that name (if there) to the length.
    """
    words, spans, items = (fresh_name(docs, n) for n in ("n_words", "spans", "items"))
    many, blocks = window_blocks(benchmark, item_id, item_text, block_words)
    added = [T.StructField(words, T.LongType()), T.StructField(spans, SPANS), T.StructField(items, ITEMS)]
    n, at = len(docs.columns), docs.columns.index(text)
    out = docs
    for k, windows_ in enumerate(blocks):
        block = docs.sparkSession.sparkContext.broadcast(windows_)
        final = k == many - 1
        kept = [i for i in range(n) if keep_text or not final or i != at]
        schema = T.StructType([docs.schema.fields[i] for i in kept] + added)
        sized = docs.columns.index(cut) if final and cut in docs.columns else None
        names = schema.names

        def run(batches: Iterable[pa.RecordBatch], block=block, final=final, kept=kept, sized=sized, names=names) -> Iterator[pa.RecordBatch]:
            windows = block.value
            for batch in batches:
                for begin, end, data, offsets, starts, ends, bounds, hit, found in _scan(batch.column(at), windows):
                    columns = batch.slice(begin, end - begin).columns
                    row_spans, row_items = [[] for _ in range(end - begin)], [[] for _ in range(end - begin)]
                    for r, owners in found.items():
                        row_items[r] = [windows.ids[i] for i in owners]
                    if len(columns) > n:  # what earlier blocks have found
                        for r, (old, names_) in enumerate(zip(columns[n + 1].to_pylist(), columns[n + 2].to_pylist(), strict=True)):
                            for s in old:
                                hit[bounds[r] + s["start"] : bounds[r] + s["end"]] = True
                            row_items[r] = sorted({*row_items[r], *names_})
                    for r in np.unique(np.searchsorted(bounds, np.flatnonzero(hit), "right") - 1):
                        own = hit[bounds[r] : bounds[r + 1]]
                        row_spans[r] = [{"start": int(a), "end": int(b)} for a, b in zip(*_runs(own), strict=True)]
                    if final and cut is not None and hit.any():
                        texts = columns[at].to_pylist()
                        sizes = columns[sized].to_pylist() if sized is not None else []
                        for r in (r for r, s in enumerate(row_spans) if s):
                            own = slice(bounds[r], bounds[r + 1])
                            raw = data[offsets[r] : offsets[r + 1]].tobytes()
                            texts[r] = _cut(raw, starts[own] - offsets[r], ends[own] - offsets[r], hit[own])
                            if sized is not None:
                                sizes[r] = len(texts[r])
                        columns[at] = pa.array(texts, columns[at].type)
                        if sized is not None:
                            columns[sized] = pa.array(sizes, columns[sized].type)
                    span_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
                    yield pa.RecordBatch.from_arrays(
                        [*(columns[i] for i in kept), pa.array(np.diff(bounds)), pa.array(row_spans, span_type), pa.array(row_items, pa.list_(pa.string()))],
                        names=names,
                    )

        out = out.mapInArrow(run, schema)
        if not final:
            out = written(out, "windows")
            block.destroy()
    return out, words, spans, items


def locate(docs: DataFrame, benchmark: DataFrame, keep: tuple[str, ...] = ("doc_id",), text: str = "text",
           item_id: str = "item_id", item_text: str = "text", block_words: int = BLOCK_WORDS) -> DataFrame:
    """Columns ``keep`` of every row with ``n_words``, ``spans`` (words, end exclusive) and ``items`` (sorted ids)."""
    found, words, spans, items = _passes(docs.select(text, *keep), benchmark, text, item_id, item_text, block_words, False, None)
    return found.select(*keep, F.col(words).alias("n_words"), F.col(spans).alias("spans"), F.sort_array(items).alias("items"))


def remove(docs: DataFrame, benchmark: DataFrame, text: str = "text", length: str = "n_chars",
           item_id: str = "item_id", item_text: str = "text", block_words: int = BLOCK_WORDS) -> DataFrame:
    """All rows and columns of ``docs``; located spans are gone from the texts, and ``length`` follows where it is a column."""
    return _passes(docs, benchmark, text, item_id, item_text, block_words, True, length)[0].select(*docs.columns)


def digest(located: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    hits = F.coalesce(F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["start"]), F.lit(0).cast("long"))
    return located.select(
        *keep, "n_words", hits.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"),
    )
