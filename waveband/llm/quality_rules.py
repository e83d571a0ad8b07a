"""Quality rules, line first: judge every line, remove those that fail, then reject
documents that lose too much.

A line (between ``\\n``) that has words fails by the first of three rules that fits:

* punctuation: at least ``min_marks`` characters of ``[#*$%&|<>!]``, and at least
  ``marks_percent`` of them for each 100 words;
* navigation: at least ``min_bars`` lone separator words (:data:`BARS`), or the line stands in a
  menu: ``menu_lines`` or more lines in a row (lines without words don't count) of at most
  ``menu_words`` words that end in a letter, a digit or a character beyond ASCII, not in a stop;
* boilerplate: it equals an earlier line of the text and has ``min_repeat_words``
  words or more, or has at most ``max_phrase_words`` words and holds a phrase of
  :data:`BOILERPLATE`.

A document is kept unless the base rules fail (under 20 words, or over 30 % of the
words in repeated 8-word windows) or the lines left hold less than
``keep_percent`` of its word characters.

Defined cases: null text counts as empty and is rejected by the base rules; a text
without failing lines stays as it is, byte for byte; rows are judged one by one, so
repeated rows and equal or null ids make no difference. Whole texts are read; memory
is bounded by a slice of about 1 MB, or by one text where that is longer.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from waveband.llm import flat

#: Marks of the base rule, and those that count for a line.
SYMBOLS = b"#*$%&|<>"
MARKS = b"#*$%&|<>!"
#: Lone words that part the items of a menu.
BARS = ("|", ">", "/", "»", "›", "·", "•")
#: Phrases of page furniture in four languages, matched in lower-cased (A-Z) lines.
BOILERPLATE = (
    "all rights reserved",
    "cookie policy",
    "enable javascript",
    "privacy policy",
    "sign up for our newsletter",
    "skip to content",
    "terms of use",
    "use of cookies",
    "alle rechte vorbehalten",
    "allgemeine nutzungsbedingungen",
    "cookie-richtlinie",
    "javascript aktivieren",
    "newsletter abonnieren",
    "verwendung von cookies",
    "zum inhalt springen",
    "abonnez-vous",
    "aller au contenu",
    "activer javascript",
    "conditions d'utilisation",
    "politique de confidentialité",
    "tous droits réservés",
    "utilisation de cookies",
    "habilite javascript",
    "ir al contenido",
    "política de cookies",
    "política de privacidad",
    "suscríbete a nuestro",
    "términos de uso",
    "todos los derechos reservados",
)
WINDOW = 8


@dataclass(frozen=True)
class Rules:
    min_marks: int = 6
    marks_percent: int = 40
    min_bars: int = 3
    menu_lines: int = 5
    menu_words: int = 3
    min_repeat_words: int = 1
    max_phrase_words: int = 30
    keep_percent: int = 50
    min_words: int = 20
    repeat_percent: int = 30


RESULT = T.StructType(
    [T.StructField(n, T.LongType()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    + [T.StructField("base_failed", T.BooleanType()), T.StructField("kept", T.BooleanType())]
    + [T.StructField(n, T.LongType()) for n in ("n_lines", "n_lines_removed", "chars_left")]
)


def _table(marks: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(marks)] = True
    return table


_SYMBOL, _MARK = _table(SYMBOLS), _table(MARKS)


def _between(mask: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """How many bytes of the mask each span holds."""
    sums = np.zeros(len(mask) + 1, np.int64)
    np.cumsum(mask, out=sums[1:])
    return sums[ends] - sums[starts]


def _lone(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, words: tuple[str, ...]) -> np.ndarray:
    """The starts of those words that equal one of a few."""
    found = []
    for word in words:
        code = word.encode()
        at = starts[ends - starts == len(code)]
        for k, byte in enumerate(code):
            at = at[data[at + k] == byte]
        found.append(at)
    return np.concatenate(found)


def _in_menu(item: np.ndarray, row: np.ndarray, least: int) -> np.ndarray:
    """Of lines in order, those that stand with ``least`` items or more of their row in a row."""
    new = np.ones(len(item), bool)
    new[1:] = (item[1:] != item[:-1]) | (row[1:] != row[:-1])
    run = np.cumsum(new) - 1
    return item & (np.bincount(run, minlength=1)[run] >= least)


def _repeated_words(words: list[bytes]) -> int:
    """Words inside 8-word windows that the text has twice or more."""
    first: dict[tuple[bytes, ...], int] = {}
    hit = bytearray(len(words))
    for i, window in enumerate(zip(*(words[k:] for k in range(WINDOW)), strict=False)):
        at = first.setdefault(window, i)
        if at != i:
            hit[at : at + WINDOW] = hit[i : i + WINDOW] = b"\x01" * WINDOW
    return sum(hit)


def _rows_with_equal_windows(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Rows whose 8-word windows may repeat; no row with a repeated window is missing."""
    if len(hashes) <= WINDOW:
        return np.zeros(0, np.int64)
    n = len(hashes) - WINDOW + 1
    key = np.zeros(n, np.uint64)
    for k in range(WINDOW):
        key = key * np.uint64(0x9E3779B97F4A7C15) + hashes[k : n + k]
    row = np.searchsorted(bounds, np.arange(n), "right") - 1
    inside = np.arange(n) + WINDOW <= bounds[row + 1]
    row, key = row[inside], flat.mix(key[inside] + row[inside].astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))
    ordered = np.sort(key)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    return np.unique(row[np.isin(key, twice)]) if len(twice) else np.zeros(0, np.int64)


def _measure(column: pa.Array, rules: Rules) -> Iterator[tuple[int, int, dict[str, np.ndarray], dict[int, bytes]]]:
    """For each slice: its rows, their figures, and the text left of those rows that lose a line."""
    for begin, end, data, offsets in flat.slices(column):
        in_word = ~flat.BLANK[data]
        starts, ends = flat.word_spans(in_word, offsets)
        bounds = flat.word_bounds(starts, offsets)
        n_words = np.diff(bounds)
        letters = in_word & ((data & 0xC0) != 0x80)
        word_chars = _between(letters, offsets[:-1], offsets[1:])

        # lines: a row's lines start at its start and after each line feed
        feeds = np.flatnonzero(data == 0x0A)
        line_start = np.sort(np.concatenate([offsets[:-1], feeds + 1]), kind="stable")
        line_end = np.sort(np.concatenate([feeds, offsets[1:]]), kind="stable")
        line_row = np.repeat(np.arange(len(offsets) - 1), _between(data == 0x0A, offsets[:-1], offsets[1:]) + 1)
        line_words = np.searchsorted(starts, line_end) - np.searchsorted(starts, line_start)
        marks = _between(_MARK[data], line_start, line_end)
        bar = np.zeros(len(data) + 1, bool)
        bar[_lone(data, starts, ends, BARS)] = True
        bars = _between(bar[: len(data)], line_start, line_end)

        hashes = flat.word_hashes(data, line_start, line_end)
        repeat = np.zeros(len(line_start), bool)
        worded = np.flatnonzero(line_words > 0)
        key = flat.mix(hashes[worded] + line_row[worded].astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))
        ordered = np.sort(key)
        twice = ordered[1:][ordered[1:] == ordered[:-1]]
        seen: set[tuple[int, bytes]] = set()
        for i in worded[np.isin(key, twice)] if len(twice) else ():
            line = (int(line_row[i]), data[line_start[i] : line_end[i]].tobytes())
            repeat[i] = line in seen
            seen.add(line)

        fails = (marks >= rules.min_marks) & (100 * marks >= rules.marks_percent * line_words)
        fails |= bars >= rules.min_bars
        last = data[ends[np.searchsorted(starts, line_end[worded]) - 1] - 1]  # the last byte of each line's last word
        item = (line_words[worded] <= rules.menu_words) & flat.ALNUM[flat.LOWER[last]]
        fails[worded] |= _in_menu(item, line_row[worded], rules.menu_lines)
        fails |= repeat & (line_words >= rules.min_repeat_words)
        low = flat.LOWER[data].tobytes()
        for phrase in BOILERPLATE:
            at = low.find(phrase.encode())
            while at >= 0:
                i = int(np.searchsorted(line_start, at, "right")) - 1
                if at + len(phrase) <= line_end[i] and line_words[i] <= rules.max_phrase_words:
                    fails[i] = True
                at = low.find(phrase.encode(), at + 1)
        fails &= line_words > 0

        chars = _between(letters, line_start, line_end)
        lost = np.bincount(line_row[fails], chars[fails], len(offsets) - 1).astype(np.int64)
        repeats = np.zeros(len(n_words), np.int64)
        for i in _rows_with_equal_windows(flat.word_hashes(data, starts, ends), bounds):
            repeats[i] = _repeated_words(data[offsets[i] : offsets[i + 1]].tobytes().split())
        base_failed = (n_words < rules.min_words) | (100 * repeats > rules.repeat_percent * n_words)
        left = word_chars - lost
        figures = {
            "n_words": n_words,
            "word_chars": word_chars,
            "n_symbols": _between(_SYMBOL[data], offsets[:-1], offsets[1:]),
            "n_dup_lines": np.bincount(line_row[repeat], minlength=len(n_words)),
            "n_repeat_words": repeats,
            "base_failed": base_failed,
            "kept": ~base_failed & (100 * left >= rules.keep_percent * word_chars),
            "n_lines": np.bincount(line_row[worded], minlength=len(n_words)),
            "n_lines_removed": np.bincount(line_row[fails], minlength=len(n_words)),
            "chars_left": left,
        }
        first_line = np.searchsorted(line_row, np.arange(len(n_words) + 1))
        cleaned = {
            int(i): b"\n".join(
                data[line_start[k] : line_end[k]].tobytes()
                for k in range(first_line[i], first_line[i + 1])
                if not fails[k]
            )
            for i in np.unique(line_row[fails])
        }
        yield begin, end, figures, cleaned


def judge(
    docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), text: str = "text", rules: Rules = Rules()
) -> DataFrame:
    """Columns ``keep`` of every row, with the figures and verdicts of :data:`RESULT`."""
    source = docs.select(text, *keep)
    schema = T.StructType([*source.schema.fields[1:], *RESULT.fields])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end, figures, _ in _measure(batch.column(0), rules):
                kept = [batch.column(i + 1).slice(begin, end - begin) for i in range(len(keep))]
                figured = [pa.array(figures[f.name]) for f in RESULT.fields]
                yield pa.RecordBatch.from_arrays([*kept, *figured], names=schema.names)

    return source.mapInArrow(run, schema)


def clean(docs: DataFrame, text: str = "text", length: str = "n_chars", rules: Rules = Rules()) -> DataFrame:
    """The rows that are kept, with every column; failing lines are gone from the text.

    Where a text changes, the column ``length`` (if there is one) is set to its new code points.
    """
    schema = docs.schema
    at = schema.names.index(text)
    sized = schema.names.index(length) if length in schema.names else None

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end, figures, cleaned in _measure(batch.column(at), rules):
                columns = batch.slice(begin, end - begin).columns
                kept = np.flatnonzero(figures["kept"])
                if any(figures["kept"][i] for i in cleaned):
                    texts = columns[at].to_pylist()
                    sizes = columns[sized].to_pylist() if sized is not None else []
                    for i, value in cleaned.items():
                        texts[i] = value.decode()
                        if sized is not None:
                            sizes[i] = len(texts[i])
                    columns[at] = pa.array(texts, columns[at].type)
                    if sized is not None:
                        columns[sized] = pa.array(sizes, columns[sized].type)
                taken = pa.array(kept)
                yield pa.RecordBatch.from_arrays([c.take(taken) for c in columns], names=schema.names)

    return docs.mapInArrow(run, schema)
