"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing column names."""

from __future__ import annotations

import hashlib
import re

import duckdb
import pytest

pytest.importorskip("waveband.llm")
from waveband.llm import (  # noqa: E402
    decontamination,
    jaccard_join,
    language_id,
    license_scan,
    personal_data,
    quality_neighbours,
    quality_rules,
    sentencepiece_coding,
    url_filter,
    warc,
)
from waveband.llm.oracle import ORACLE_SQL  # noqa: E402
from waveband.llm.shared import new_folder  # noqa: E402
from tests.llm import brute  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, node long, spans string, n_words long, _spans int, found string, grp int"
PROSE = " ".join(f"word{i} and the other{i % 7}" for i in range(40))
LONG = " ".join(f"item{i} of a long text" for i in range(60_000))


def rows():
    extra = ("x", None, 0.5, 7, "s", 3, 9, "f", 1)
    texts = [PROSE, PROSE, None, "", " \n\t ", LONG, "é", "a b", PROSE + " tail", "x " * 300, "\u0001 a@b.co \u0001", "中文 字符", "123 456"]
    made = [(i, t, "en" if i % 2 else "de", *extra) for i, t in enumerate(texts)]
    return [*made, made[0], (None, PROSE, None, *extra), (None, None, None, *extra), (5, "another text under an id that is there", "en", *extra)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3, "n_words", "doc_id")


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def benchmark(spark):
    items = [(1, " ".join(PROSE.split()[8:24])), (1, "unseen words"), (2, None), (3, ""), (None, "é"), (4, "a b")]
    return spark.createDataFrame(items, "item_id long, text string")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(0, 1, 0), (1, 1, 0), (6, 0, 0), (7, 0, None), (7, 1, 0), (9, None, 0), (None, 1, 0), (99, 1, 0)], "doc_id long, quality int, toxic int")


def test_quality_rules(docs, none):
    got = {(r["doc_id"], r["n_words"]): r for r in quality_rules.judge(docs).collect()}
    assert got[(None, 0)]["base_failed"] and not got[(2, 0)]["kept"] and not got[(4, 0)]["kept"]
    assert got[(0, 160)]["kept"] and got[(5, 300_000)]["n_repeat_words"] == 0 and got[(5, 300_000)]["kept"]
    assert got[(9, 300)]["n_repeat_words"] == 300 and not got[(9, 300)]["kept"]
    kept = quality_rules.clean(docs)
    assert kept.schema == docs.schema
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(["0", "0", "1", "5", "8", "None"])
    assert quality_rules.judge(none).count() == 0 == quality_rules.clean(none).count()


def test_lines_that_fail_go_from_the_text(spark):
    good = PROSE + "."
    text = "\n".join([good, "Home | About | Shop | Help", "One line.", "One line.", "Please read our Privacy Policy", "", "a## b## c## d##"])
    one = quality_rules.clean(spark.createDataFrame([(1, text, 5)], "doc_id long, text string, n_chars int")).collect()[0]
    assert one["text"] == f"{good}\nOne line.\n" and one["n_chars"] == len(good) + 11


def test_menus_and_furniture_of_four_languages_go(spark):
    good = PROSE + "."
    menu = ["Start", "Über uns", "", "Café", "Kontakt 24", "Alle Themen"]
    pages = {
        1: ([good, *menu, "One line more."], [good, "", "One line more."]),
        2: ([good, *menu[:4], "One line more."], None),  # three items are no menu
        3: ([good, *menu[:4], "A stop.", *menu[4:]], None),  # nor are five with a sentence between them
        4: ([good, "Home · News • Sport", "Start / Mode / Reisen / Wetter", "a/b / c"], [good, "Home · News • Sport", "a/b / c"]),
        5: ([good, "© Verlag - Alle Rechte vorbehalten", "Tous droits réservés.", "Lea la Política de privacidad", "Conditions d'utilisation"], [good]),
        6: ([*menu, *menu, *([good] * 1)], [good, "", ""]),
        7: ([good, "Alpha Beta", "Gamma"], None),
        8: (["Delta", "Epsilon", "Zeta", good], None),  # the menu of one text doesn't reach into the next
    }
    docs = spark.createDataFrame([(i, "\n".join(lines)) for i, (lines, _) in pages.items()], "doc_id long, text string").coalesce(1)
    got = {r["doc_id"]: r["text"] for r in quality_rules.clean(docs).collect()}
    for i, (lines, left) in pages.items():
        assert got[i] == brute.cleaned("\n".join(lines)), i
        if left is None:
            assert got[i] == "\n".join(lines)
        elif i != 6:
            assert got[i] == "\n".join(left)
    assert "Start" not in got[6] and good in got[6]
    judged = quality_rules.judge(docs).toPandas()
    con = duckdb.connect()
    con.register("documents", docs.toPandas())
    want = con.execute(ORACLE_SQL["op9_quality_rules"]).df()
    assert sorted(want.columns) == sorted(judged.columns)
    names = sorted(judged.columns)
    assert judged.sort_values("doc_id")[names].values.tolist() == want.sort_values("doc_id")[names].values.tolist()


def test_decontamination(docs, none, benchmark):
    for block_words in (decontamination.BLOCK_WORDS, 3):
        got = decontamination.locate(docs, benchmark, block_words=block_words).collect()
        found = {(r["doc_id"], r["n_words"]): ([tuple(s) for s in r["spans"]], r["items"]) for r in got}
        assert len(got) == docs.count()
        assert found[(0, 160)] == ([(8, 24)], ["1"]) == found[(None, 160)]
        assert found[(6, 1)] == ([(0, 1)], [""]) and found[(7, 2)] == ([(0, 2)], ["4"])
        assert found[(2, 0)] == ([], []) == found[(5, 300_000)]
        cut = decontamination.remove(docs, benchmark, block_words=block_words)
        assert cut.schema == docs.schema
        texts = {(r["doc_id"], r["text"]): r["n_chars"] for r in cut.collect()}
        words = PROSE.split()
        left = " ".join(words[:8]) + "  " + " ".join(words[24:])
        assert texts[(0, left)] == len(left) and (6, "") in texts and (2, None) in texts and (5, LONG) in texts
    assert decontamination.locate(docs, benchmark.limit(0)).where("size(spans) > 0").count() == 0
    assert decontamination.locate(none, benchmark).count() == 0


def test_jaccard_join(docs, none):
    got = sorted(((r[0], r[1], r[2]) for r in jaccard_join.join(docs).collect()), key=str)
    found = {(i, n): c for i, n, c in got}
    assert len(got) == docs.count()
    assert found[(0, 125)] == found[(1, 125)] == found[(8, 126)] == 0 and found[(None, 125)] is None
    assert found[(2, 0)] == 2 and found[(3, 0)] == 3 and found[(4, 0)] == 4 and found[(7, 1)] == 7 and found[(None, 0)] is None
    assert found[(9, 1)] == 9 and (5, 6) in found
    assert jaccard_join.join(none).count() == 0


def test_language_id(docs, none):
    got = {(r["doc_id"]): r for r in language_id.predict(docs).collect()}
    assert got[2]["lang_pred"] == got[3]["lang_pred"] == got[12]["lang_pred"] == "und" and got[12]["score"] == 0
    assert got[11]["lang_pred"] in ("en", "de") and 0 <= got[5]["score"] <= 1
    assert language_id.predict(none).count() == 0
    unlabelled = docs.drop("lang").selectExpr("*", "cast(null as string) as lang")
    assert {r["lang_pred"] for r in language_id.predict(unlabelled).collect()} == {"und"}


def test_quality_neighbours(docs, none, labels):
    got = quality_neighbours.score(docs, labels).collect()
    assert len(got) == docs.count() and all(0 <= r["score"] <= 1 for r in got)
    assert {r["score"] for r in quality_neighbours.score(docs, labels.limit(0)).collect()} == {0.5}
    assert quality_neighbours.score(none, labels).count() == 0


def test_sentencepiece(docs, none):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_coding.default_model())
    got = sorted(tuple(r) for r in sentencepiece_coding.round_trip(docs.where("doc_id IS NOT NULL")).collect())
    want = []
    for r in docs.where("doc_id IS NOT NULL").collect():
        ids = library.encode(r["text"] or "", add_bos=True, add_eos=True)
        raw = b"".join(i.to_bytes(4, "little") for i in ids)
        want.append((r["doc_id"], len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    assert got == sorted(want)
    coded = sentencepiece_coding.encode(docs, keep=("doc_id", "text"))
    back = sentencepiece_coding.decode(coded, keep=("text",)).collect()
    assert all((r["text"] or "") == r["decoded"] for r in back)
    assert sentencepiece_coding.round_trip(none).count() == 0


def test_license_scan(spark, docs, none):
    text = "Intro.\nPermission is hereby granted, free of charge, to any person obtaining a copy; x y.\nThe software is provided \"as is\", without warranty of any kind.\nLicensed under CC BY-NC 4.0."
    got = license_scan.scan(spark.createDataFrame([(1, text), (2, None), (3, text)], "doc_id long, text string")).collect()
    assert [(r["doc_id"], r["licenses"], r["n_matches"], r["restricted"]) for r in got] == [
        (1, "CC-BY-NC-4.0,MIT", 2, True), (2, "", 0, False), (3, "CC-BY-NC-4.0,MIT", 2, True)]
    assert license_scan.scan(docs).count() == docs.count() and license_scan.scan(none).count() == 0


def test_personal_data(docs, none):
    got = {(r["doc_id"]): r for r in personal_data.find(docs).collect()}
    assert got[10]["spans"] == "email:2:8" and got[2]["spans"] == "" == got[5]["spans"]
    masked = personal_data.mask(docs)
    assert masked.schema.simpleString() == docs.schema.simpleString()
    texts = {r["doc_id"]: (r["text"], r["n_chars"]) for r in masked.collect()}
    assert texts[10] == ("\u0001 <EMAIL> \u0001", 11) and texts[2] == (None, None) and texts[8][0] == PROSE + " tail"
    assert personal_data.find(none).count() == 0 == personal_data.mask(none).count()


def test_url_filter(spark):
    urls = [None, "", "no host", "http://A.net/x", "http://net", "http://a.example.net/en/1?q=1&r=2#f", "ftp://Example.COM/de/x", "http://x.org/fr/", "http://x.org/es/",
            "http://notexample.com/de/1", "http://y.example.com\n/de/1", "a://b://c/d", "HTTP://ÄB.Org/fr/é#x", "://net/"]
    rows = [(i, u, "h", 0.5) for i, u in enumerate(urls)] + [(3, urls[3], "h", 0.5), (None, urls[7], "h", 0.5)]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, probability double")
    got = url_filter.judge(pages).collect()
    assert len(got) == len(rows)
    for r in got:
        if r["page_id"] is None:
            continue
        host, path = "", ""
        if (m := re.match(r"(?s).*?://([^/?#]*)([^?#]*)", urls[r["page_id"]] or "")):
            host, path = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in m[1]), m[2]
        fits = [(len(x), x, v) for x, v in url_filter.RULES for h, _, p in [x.partition("/")] if (host == h or host.endswith("." + h)) and path.startswith("/" + p)]
        assert (r["host"], r["path"]) == (host, path)
        assert r["rule"] == (max(fits)[1] if fits else None)
        assert r["verdict"] == max(fits)[2] if fits else r["verdict"] in ("allow", "block")
    assert url_filter.judge(pages.limit(0)).count() == 0
    undecided = url_filter.judge(pages.where("page_id IN (0, 1, 9)")).collect()
    assert {r["verdict"] for r in undecided} == {"allow"}


def test_warc(spark):
    tricky = "WARC/1.1\r\nWARC-Type: response\r\n\r\n\r\n\r\nWARC/1.1\r\n\r\n"
    rows = [(5, "http://a/\r\nX: y", "same"), (2, None, "same"), (9, "u", None), (7, "v", ""), (3, "w", tricky), (4, "w", tricky + "é"), (None, "z", "same"), (2, "again", "same"), (8, "b", "only")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3, "page_id")
    path = new_folder(spark, "test-warc")
    warc.write(pages, path, records_per_file=2)
    records = warc.read(spark, path)
    got = sorted(((r["record_id"], r["record_type"], r["refers_to"], r["payload_bytes"], r["payload_digest"]) for r in warc.resolve(records).collect()), key=str)
    digest = lambda t: warc._digest((t or "").encode())
    want = [(2, "response", None, 4, digest("same"))] * 2 + [
        (5, "revisit", 2, 4, digest("same")), (9, "revisit", 7, 0, digest("")), (7, "response", None, 0, digest("")), (8, "response", None, 4, digest("only")),
        (3, "response", None, len(tricky), digest(tricky)), (4, "response", None, len(tricky) + 2, digest(tricky + "é")), (None, "response", None, 4, digest("same"))]
    assert got == sorted(want, key=str)
    payloads = {r["record_id"]: bytes(r["payload"]) for r in records.collect() if r["record_type"] == "response"}
    assert payloads[3] == tricky.encode() and payloads[4] == (tricky + "é").encode()
    empty = new_folder(spark, "test-warc")
    warc.write(pages.limit(0), empty)
    assert warc.resolve(warc.read(spark, empty)).count() == 0


def _plain_verdicts(rows):
    """``(id, original or None, digest)`` of each row by counting."""
    firsts = {}
    for id_, _, html in rows:
        if id_ is not None:
            firsts[html or ""] = min(id_, firsts.get(html or "", id_))
    named = lambda id_, html: firsts[html] if id_ is not None and firsts[html] != id_ else None
    return sorted(((id_, named(id_, html or ""), warc._digest((html or "").encode())) for id_, _, html in rows), key=str)


def test_warc_with_bitmaps_of_any_size(spark):
    """Bitmaps of 64 bits are full of rows that only look like revisits; a third of the rows has one payload."""
    rows = [(i, f"u{i}", "hot" if i % 3 == 0 else f"text {i % 200}") for i in range(600)] + [(None, "x", "hot"), (3, "y", "other"), (7, None, None), (8, None, "")]
    pages = spark.createDataFrame([(*r, "a", "b", 1) for r in rows], "page_id long, url string, html string, digest string, original string, size int").repartition(5, "page_id")
    for words in (1, 1 << 18):
        path = new_folder(spark, "test-warc")
        warc.write(pages, path, words=words)
        got = warc.read(spark, path).collect()
        assert sorted(((r["record_id"], r["refers_to"], r["payload_digest"]) for r in got), key=str) == _plain_verdicts(rows)
        assert all(warc._digest(bytes(r["payload"])) == r["payload_digest"] for r in got if r["record_type"] == "response")
        assert all(bytes(r["payload"]) == b"" for r in got if r["record_type"] == "revisit")


def test_warc_files_are_bounded_by_bytes(spark):
    import gzip
    import os

    rows = [(i, f"u{i}", f"{i} " * (300_000 if i % 50 == 0 else 10)) for i in range(200)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    path = new_folder(spark, "test-warc")
    warc.write(pages, path, records_per_file=40, file_bytes=2_000_000)
    local = path.removeprefix("file://")
    sizes = [len(gzip.open(os.path.join(local, f)).read()) for f in os.listdir(local) if f.endswith(".gz")]
    assert len(sizes) >= 7 and max(sizes) < 2_200_000
    got = {r["record_id"]: bytes(r["payload"]).decode() for r in warc.read(spark, path).collect()}
    assert got == {i: html for i, _, html in rows}


def test_warc_headers_of_revisits(spark):
    pages = spark.createDataFrame([(1, "http://a/", "x"), (2, "http://b/", "x")], "page_id long, url string, html string")
    path = new_folder(spark, "test-warc")
    warc.write(pages, path)
    text = "".join(r["value"] for r in spark.read.text(path, wholetext=True).collect())
    assert "WARC-Refers-To-Target-URI: http://a/\r\n" in text and f"WARC-Refers-To-Date: {warc.DATE}\r\n" in text


def test_warc_shuffles_no_payload(spark):
    pages = spark.createDataFrame([(i, f"u{i}", "same" if i % 3 == 0 else f"{i}") for i in range(300)], "page_id long, url string, html string")
    digested = warc.with_digests(pages)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with tables that are too large for it
    try:
        plan = warc.records(digested, digested.drop("payload"))._jdf.queryExecution().toString()
        moved = warc.revisits(digested.drop("payload"))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    physical = plan[plan.index("== Physical Plan"):]
    assert "payload" in physical and "SortMergeJoin" not in physical  # only bits of the bitmap meet the payloads
    assert physical.count("Exchange hashpartitioning") == 1
    bits = physical[physical.index("Exchange hashpartitioning") : physical.index("\n   +- ")]
    assert "FileScan" in bits and "payload" not in bits
    assert "Exchange hashpartitioning(digest" in moved
