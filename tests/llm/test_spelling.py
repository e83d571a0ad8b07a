"""Spelling variants against plain versions; crowded chunks; defined cases."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest

pytest.importorskip("waveband.llm")
from waveband.llm import spelling  # noqa: E402


def near(a: str, b: str) -> bool:
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_words(texts, least_length=5, least_n=3):
    found = Counter()
    for i, text in texts:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            found[run] += len(run) >= least_length
    return {w: n for w, n in found.items() if n >= least_n}


def plain_variants(words):
    out = {}
    for w, n in words.items():
        others = sorted((o for o in words if near(w, o)), key=lambda o: (-words[o], o))
        form = others[0] if others and words[others[0]] >= 2 * n else None
        out[w] = (n, len(others), form, words[form] if form else None)
    roots = {}
    for w in words:
        roots[w] = w
        while out[roots[w]][2]:
            roots[w] = out[roots[w]][2]
    return {w: (*v, roots[w]) for w, v in out.items()}


def rows(frame):
    return {r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in frame.collect()}


def made_up(seed: int, many: int):
    draw = random.Random(seed)
    words = {}
    for _ in range(many):
        word = "".join(draw.choice("abÿÀ") for _ in range(draw.randint(1, 7)))
        words[word] = draw.choice([3, 4, 6, 9, 12, 30, 100])
    return words


@pytest.mark.parametrize("crowded", [0, 3, 4096])
def test_variants_equal_the_plain_version_however_crowded(spark, crowded):
    words = made_up(crowded, 250)
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    got = spelling.variants(frame, crowded=crowded)
    assert rows(got) == plain_variants(words) and got.count() == len(words)


def test_counted_words_equal_the_plain_version(spark):
    draw = random.Random(3)
    some = ["Straße", "NAÏVE", "naïve", "École", "école", "abcde", "abcdef", "abcd", "x1abcdey", "Größe", "ÿÿÿÿÿ", "日本abcde語"]
    texts = [(draw.choice([None, 1, 2, 3, 97, 4711]), " ".join(draw.choices(some, k=400))) for _ in range(40)] + [(5, None), (6, ""), (7, " \n")]
    got = spelling.counted(spark.createDataFrame(texts, "doc_id long, text string"))
    assert {r["word"]: r["n"] for r in got.collect()} == plain_words(texts)


def test_forms_lead_to_a_root(spark):
    words = {"house": 100, "houses": 40, "housess": 9, "housesss": 3, "mouse": 100, "table": 7}
    got = rows(spelling.variants(spark.createDataFrame(list(words.items()), "word string, n long")))
    assert got["housesss"] == (3, 1, "housess", 9, "house")
    assert got["houses"] == (40, 2, "house", 100, "house") and got["house"][2] is None and got["mouse"] == (100, 1, None, None, "mouse")
    assert got["table"] == (7, 0, None, None, "table")


def test_a_crowded_chunk_brings_no_more_than_its_near_words(spark):
    """All words share their first half: the rows that meet grow with the near pairs, not with the square of the group."""
    draw = random.Random(8)
    ends = {"".join(draw.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(8)) for _ in range(3000)}
    words = [("sharedup" + e, 3) for e in ends] + [("sharedupzzzzzzzz", 9), ("sharedupzzzzzzz", 50), ("sharedupzzzzzzzy", 3)]
    frame = spark.createDataFrame(words, "word string, n long")
    keyed = spelling._keyed(frame)
    dense = spelling._by_rest(keyed)
    met = dense.where("short").join(dense.where("NOT short").select("key"), "key").count()
    got = rows(spelling.variants(frame))
    assert got["sharedupzzzzzzzz"][1:] == (2, "sharedupzzzzzzz", 50, "sharedupzzzzzzz")
    # a word meets itself at each place of each half, and its near words
    assert met < 40 * len(words)


def test_no_words(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, word string, n int, form string")
    got = spelling.variants(spelling.counted(empty))
    assert got.count() == 0 and got.columns == ["word", "n", "n_near", "form", "form_n", "root"]


def test_clashing_columns_repeated_rows_and_a_very_long_text(spark):
    long = "letter " * 200_000 + "lettre " * 3
    docs = spark.createDataFrame([(1, long, "w", 5, "f", "r"), (1, "lettre", "w", 5, "f", "r"), (1, "lettre", "w", 5, "f", "r")],
                                 "doc_id long, text string, word string, n long, form string, run string")
    texts = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert {r["word"]: r["n"] for r in spelling.counted(docs).collect()} == plain_words(texts)
