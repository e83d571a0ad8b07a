"""The methods against plain versions, an exact library, and held-out rows."""

from __future__ import annotations

import hashlib
import random
import textwrap

import numpy as np
import pyarrow as pa
import pytest

pytest.importorskip("waveband.llm")
from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

from tests.llm import brute  # noqa: E402
from waveband.llm import components, decontamination, flat, jaccard_join, license_scan, personal_data, sentencepiece_coding, url_filter  # noqa: E402
from waveband.llm.fm_index import FMIndex  # noqa: E402
from waveband.llm.piece_bpe import PieceCoder  # noqa: E402
from waveband.llm.queries import QUERIES  # noqa: E402

SF = "/root/testdata/sf0.01"
TEXT = st.text(alphabet="ab1Z \t\n\v.é中\u0001-", max_size=30)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), TEXT), max_size=8), st.integers(1, 40))
def test_words_are_found_in_slices(texts, limit):
    found = []
    for _, _, data, offsets in flat.slices(pa.array(texts, pa.string()), limit, max_rows=3):
        starts, ends = flat.word_spans(~flat.BLANK[data], offsets)
        bounds = flat.word_bounds(starts, offsets)
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            found.append([data[s:e].tobytes().decode() for s, e in zip(starts[a:b], ends[a:b], strict=True)])
    assert found == [brute.BLANK.findall(t or "") for t in texts]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 4), max_size=80), st.lists(st.lists(st.integers(1, 4), min_size=3, max_size=3), min_size=1, max_size=6), st.integers(1, 9))
def test_fm_index_locates_every_occurrence(symbols, phrases, sample_every):
    text = np.array([*symbols, 0])
    index = FMIndex(text, 4, sample_every)
    low, high = index.rows_of(np.array(phrases))
    for phrase, a, b in zip(phrases, low, high, strict=True):
        want = [i for i in range(len(symbols) - 2) if symbols[i : i + 3] == phrase]
        assert sorted(index.locate(np.arange(a, b)).tolist()) == want


def _coder():
    import sentencepiece

    path = sentencepiece_coding.default_model()
    with open(path, "rb") as file:
        return PieceCoder(file.read(), max_words=2000), sentencepiece.SentencePieceProcessor(model_file=path)


def test_coder_equals_the_library():
    coder, library = _coder()
    pick = random.Random(3)
    parts = [library.id_to_piece(i) for i in range(259, 32000, 3)] + ["▁", " ", "  ", "\n", "\t", "é", "中", "😀", "\u0000", "  " * 40, "." * 25, "http://", "<s>", "<0x41>"]
    texts = ["".join(pick.choice(parts) for _ in range(pick.randrange(25))) for _ in range(2500)]
    texts += [" " * n for n in range(90)] + [" " * n + "the" for n in range(70)] + ["etaoin" * 3000, "x" * 3000, " " * 3000, "中" * 3000]
    for at in range(0, len(texts), 300):
        part = texts[at : at + 300]
        ids, sizes = coder.encode(part)
        want = library.encode(part)
        assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == want
        assert coder.decode(ids, sizes) == library.decode(want)
    for _ in range(1500):
        ids = [pick.randrange(32000) if pick.random() < 0.5 else pick.randrange(259) for _ in range(pick.randrange(12))]
        assert coder.decode(np.array(ids, np.int64), np.array([len(ids)])) == [library.decode(ids)]


def _near_copies(pick, groups, size, words):
    texts = []
    for g in range(groups):
        base = [f"w{pick.randrange(60)}" for _ in range(words)]
        for _ in range(size):
            copy = list(base)
            for _ in range(pick.randrange(6)):
                copy[pick.randrange(words)] = f"x{pick.randrange(10**6)}"
            texts.append(" ".join(copy))
    return texts


@pytest.mark.parametrize("steps", [(8, 64), (0, 0)])
def test_jaccard_join_equals_all_pairs(spark, steps):
    pick = random.Random(11)
    common = " ".join(f"c{i}" for i in range(60))
    texts = _near_copies(pick, 3, 60, 90) + _near_copies(pick, 12, 4, 40) + _near_copies(pick, 10, 5, 12)
    texts += [common + " " + " ".join(f"u{pick.randrange(10**6)}" for _ in range(pick.randrange(1, 30))) for _ in range(60)]
    texts += ["a b", "a  B", "", "a", "a b c", "A b c d", *texts[:20]]
    pick.shuffle(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4, "doc_id")
    got = {r[0]: (r[1], r[2]) for r in jaccard_join.join(docs, steps=steps).collect()}
    assert got == brute.components(dict(enumerate(texts)))


@pytest.mark.parametrize("percent", [50, 80, 90, 97])
def test_pools_need_no_more_than_any_partner_can_give(spark, percent):
    sizes = range(1, 160)
    rows = spark.range(1, 160).withColumnRenamed("id", "n")
    for pool, plain in ((jaccard_join._POOL, lambda n, f: min(n, f + f // 2 + 8)), (jaccard_join._SECOND, lambda n, f: min(n, 3 * f + 8))):
        pools = {n: plain(n, n - (n * percent + 99) // 100 + 1) for n in range(1, 400)}
        want = {n: min(
            min(pools[n] - n + i, pools[m] - m + i, i)
            for m in range(1, 400) if 100 * min(m, n) >= percent * max(m, n) for i in [-(-percent * (n + m) // (100 + percent))]) for n in sizes}
        assert {r[0]: r[1] for r in rows.selectExpr("n", jaccard_join._need(pool, percent)).collect()} == want


@pytest.mark.parametrize(("words", "edits"), [(120, 5), (40, 3)])
def test_pairs_of_a_group_of_near_copies_grow_with_the_group(spark, monkeypatch, words, edits):
    """Components that are paired, and nodes that are, stay a small multiple of the group's size, not of its square."""
    seen = {}
    for name in ("_groups", "_across"):
        real = getattr(jaccard_join, name)
        monkeypatch.setattr(jaccard_join, name, lambda *a, real=real, name=name: seen.setdefault(name, real(*a)))
    made = {}
    for many in (300, 1200):
        draw, seen_now = random.Random(many), seen.clear()
        base = [f"w{draw.randrange(5000)}" for _ in range(words)]
        texts = []
        for i in range(many):
            own = list(base)
            for _ in range(draw.randint(0, edits)):
                own[draw.randrange(words)] = f"x{draw.randrange(10**9)}"
            texts.append((i, " ".join(own)))
        jaccard_join.join(spark.createDataFrame(texts, "doc_id long, text string").repartition(8)).count()
        made[many] = seen["_groups"].count(), seen["_across"].count()
        assert seen_now is None and made[many][0] <= 8 * many and made[many][1] <= 3 * many, made
    assert made[1200][0] <= 6 * made[300][0] + 1000


def _shared_edits(draw, many):
    """Near copies that each have some of twelve edits, and one of their own: few link with any one of them, many with each other."""
    base = [f"w{draw.randrange(5000)}" for _ in range(150)]
    texts = []
    for _ in range(many):
        own = list(base)
        for k in range(12):
            if draw.random() < 0.5:
                own[6 + 12 * k] = f"y{k}"
        own[draw.randrange(150)] = f"x{draw.randrange(10**9)}"
        texts.append(" ".join(own))
    return texts


def test_pairs_of_near_copies_with_shared_edits_grow_with_the_group(spark, monkeypatch):
    """Components are joined in rounds before they are paired, so links inside a group are not verified by the square."""
    made, real = [], jaccard_join._across
    monkeypatch.setattr(jaccard_join, "_across", lambda *a: made.append(real(*a)) or made[-1])
    texts = _shared_edits(random.Random(5), 1200)
    got = jaccard_join.join(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(8), words=5, percent=80)
    assert len({r["component_id"] for r in got.collect()}) < 100 and made[0].count() < 1200


@pytest.mark.parametrize(("words", "percent"), [(5, 80), (3, 90)])
def test_rounds_give_the_components_of_all_pairs(spark, monkeypatch, words, percent):
    monkeypatch.setattr(jaccard_join, "CROWD", 2)
    monkeypatch.setattr(jaccard_join, "LEAST_JOINED", 0.5)  # two rounds or three
    pick = random.Random(8)
    texts = _shared_edits(pick, 60) + _near_copies(pick, 3, 10, 60) + ["a b", "", "a b c d e", "a b c d e f", *_shared_edits(pick, 1)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4, "doc_id")
    got = {r[0]: (r[1], r[2]) for r in jaccard_join.join(docs, words=words, percent=percent).collect()}
    assert got == brute.components(dict(enumerate(texts)), words=words, percent=percent)


def test_a_round_writes_its_links_and_labels_only(spark, monkeypatch):
    """No round brings components to their end or writes its rows anew, which took half of the join's time on many small partitions."""
    monkeypatch.setattr(jaccard_join, "CROWD", 2)
    names, inside, led, rounds, lead = [], [], [], jaccard_join._rounds, jaccard_join._led
    for module in (jaccard_join, components):
        monkeypatch.setattr(module, "written", lambda df, name, real=module.written: names.append(name) or real(df, name))

    def counted(*a):
        begin = len(names)
        found = rounds(*a)
        inside.extend(names[begin:])
        return found

    monkeypatch.setattr(jaccard_join, "_rounds", counted)
    monkeypatch.setattr(jaccard_join, "_led", lambda *a: led.append(1) or lead(*a))
    jaccard_join.join(spark.createDataFrame(list(enumerate(_shared_edits(random.Random(8), 60))), "doc_id long, text string").repartition(4), words=5, percent=80)
    assert led and len(inside) <= 2 + 2 * len(led), inside


def test_jaccard_join_of_short_texts_that_share_a_passage(spark):
    pick = random.Random(2)
    new = lambda n: [f"w{pick.randrange(10**9)}" for _ in range(n)]
    texts = []
    for shared, own in ((18, (0, 2)), (19, (0, 1)), (19, (0, 2)), (28, (1, 2))) * 12:
        base = new(shared + 2)
        texts += [base + new(n) for n in own]
        for _ in range(12):  # near copies of each other that share the passage only
            other = base[: 2 + shared * 7 // 10] + new(20)
            texts += [other + new(1), other + new(1)]
    texts = [" ".join(t) for t in texts]
    pick.shuffle(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4, "doc_id")
    got = {r[0]: (r[1], r[2]) for r in jaccard_join.join(docs).collect()}
    want = brute.components(dict(enumerate(texts)))
    assert [i for i in want if got[i] != want[i]] == []


def test_personal_data_equals_the_plain_patterns(spark):
    pick = random.Random(5)
    parts = ["a.b@c-d.co.uk", "@x.y", "a@b", "1.2.3.4", "300.1.1.1", "1.2.3.4.5.6.7.8", "001.02.3.255", "4111 1111 1111 1111", "4111-1111-1111-1112",
             "+1 (555) 010-9999", "+12", "+49 30 1234567.", "5555555555554444", "GB82 WEST 1234 5698 7654 32", "iban GB82WEST12345698765432", "DE00500105175407324931",
             " ", " ", "é", "中", "\n", "9", "12", ".", "-", "+", "@", "\u0001", "x", "%", "token = \"9233A8ECF7C5B09FE5949719B6B82BC439E9\""]
    texts = ["".join(pick.choice(parts) for _ in range(pick.randrange(14))) for _ in range(1500)] + ["1" * 3000, "a" * 3000 + "@", "a.a" * 2000 + "@b" + ".c" * 3000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    found = {r["doc_id"]: r for r in personal_data.find(docs).collect()}
    masked = {r["doc_id"]: r["text"] for r in personal_data.mask(docs).collect()}
    ranks = {k.name: i for i, k in enumerate(personal_data.KINDS)}
    for i, text in enumerate(texts):
        base = brute.base_spans(text)
        listed = ",".join(f"{k}:{s}:{e}" for s, _, k, e in base)
        assert found[i]["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest(), (text, found[i]["spans"])
        spans = [(int(s), ranks[k], k, int(e)) for k, s, e in (x.split(":") for x in found[i]["spans"].split(",") if x)]
        assert spans == sorted(spans) and [s for s in spans if s[1] < 4] == base
        assert masked[i] == brute.masked(text, spans)
    extra = personal_data.find(spark.createDataFrame(
        [(1, "my IBAN: GB82 WEST 1234 5698 7654 32."), (2, "GB82 WEST 1234 5698 7654 33"), (3, "token = \"9233A8ECF7C5B09FE5949719B6B82BC439E9\""),
         (4, "9233A8ECF7C5B09FE5949719B6B82BC439E9")], "doc_id long, text string")).collect()
    assert [r["spans"] for r in sorted(extra, key=lambda r: r["doc_id"])] == ["iban:9:36", "", "secret:9:45", ""]


def test_language_of_held_out_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    got = QUERIES["op4_language_id"](spark, SF).join(docs, "doc_id").where("held_out").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in got) >= 0.98 * len(got) > 100


def test_quality_of_held_out_rows(spark):
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    got = QUERIES["op1_quality_neighbours"](spark, "/root/testdata/sf0.1").join(labels, "doc_id").where("held_out").collect()
    good, bad = [r for r in got if r["quality"] == 1], [r for r in got if r["quality"] == 0]
    assert sum(r["predicted"] for r in good) >= 0.98 * len(good) and sum(r["predicted"] for r in bad) <= 0.15 * len(bad)


def test_url_verdicts_learn_the_rules(spark):
    pages = QUERIES["op2_url_filter"](spark, "/root/testdata/sf0.1").collect()
    assert all(r["verdict"] in ("allow", "block") for r in pages)
    unlisted = [r for r in pages if r["rule"] is None]
    # hosts that the rules only ever block, and those that they only ever allow
    for host, verdict in ((".example.com", "block"), (".example.org", "allow")):
        of_host = [r["verdict"] for r in unlisted if r["host"].endswith(host)]
        assert sum(v == verdict for v in of_host) >= 0.9 * len(of_host) > 100


@pytest.mark.parametrize("broadcast_rows", [50_000, 0])
def test_url_suffixes_count_beyond_the_sample(spark, monkeypatch, broadcast_rows):
    monkeypatch.setattr(url_filter, "BROADCAST_ROWS", broadcast_rows)
    # the mark in the path decides; but for it, the URLs of blocked and allowed hosts look the same
    urls = [f"http://h{i:04}.net/x{'ab'[i * 7919 % 1009 % 2]}/{k}" for i in range(400) for k in range(8)]
    urls += [f"http://h{i:04}.net/xc/9" for i in range(400)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").repartition(3)
    got = {r["page_id"]: r["verdict"] for r in url_filter.judge(pages, rules=(("net/xa", "block"), ("net/xb", "allow")), per_label=40).collect()}
    want = {3200 + i: "block" if i * 7919 % 1009 % 2 == 0 else "allow" for i in range(400)}
    assert len(got) == len(urls) and sum(got[i] == v for i, v in want.items()) >= 390


def test_licence_sentences_are_normalised():
    for sentence in license_scan.SENTENCES:
        assert license_scan._sentences(sentence.upper() + ".") == [sentence]
    assert {i for rule, _ in license_scan.RULES for i in rule} == set(license_scan.SENTENCES.values())


MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY."""
BSD2 = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."""
BSD3 = BSD2 + """

3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0"""
GPL = "This {0} is free software{1} you can redistribute it and/or modify it under the terms of the GNU {2} Public License as published by the Free Software Foundation{3} either version {4} of the License, or (at your option) any later version."
TEXTS = {
    "MIT": MIT, "BSD-2-Clause": BSD2, "BSD-3-Clause": BSD3, "Apache-2.0": APACHE,
    "GPL-2.0": GPL.format("program", ";", "General", ";", "2"), "GPL-3.0": GPL.format("program", ":", "General", ",", "3"),
    "LGPL-2.1": GPL.format("library", ";", "Lesser General", ";", "2.1"), "AGPL-3.0": GPL.format("program", ":", "Affero General", ",", "3"),
    "CC-BY-SA-4.0": "This work is licensed under the Creative Commons Attribution-ShareAlike 4.0 International License.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
}


def test_canonical_licences_wrapped_or_not(spark):
    rows = []
    for name, text in TEXTS.items():
        for width in (20, 40, 72, 10**6):
            for begin in ("", "# ", " * "):
                lines = [begin + line for part in text.split("\n") for line in (textwrap.wrap(part, width, break_long_words=False, break_on_hyphens=False) or [""])]
                rows.append((name, "\n".join(["a line before", *lines, "a line behind"])))
    rows.append(("MIT", "a line\nReleased under the MIT License\nand another"))
    for holder in ("Example Widgets Ltd", "the University of Somewhere", "Jean-Luc O'Neill and the other authors"):
        for width in (25, 70, 10**6):
            text = TEXTS["BSD-3-Clause"].replace("the copyright holder", holder)
            rows.append(("BSD-3-Clause", "\n".join(line for part in text.split("\n") for line in (textwrap.wrap(part, width, break_long_words=False) or [""]))))
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    for r in license_scan.scan(docs).collect():
        assert (r["licenses"], r["n_matches"], r["restricted"]) == (r["doc_id"], 1, "GPL" in r["doc_id"])
    assert {i for rule, _ in license_scan.ALL_RULES for i in rule} == set(license_scan.ALL_SENTENCES.values())
    assert all(license_scan._sentences(s.upper() + ".") == [s] for s in license_scan.ALL_SENTENCES)


def test_the_licence_query_knows_the_whole_rule_set(spark, tmp_path):
    """Canonical texts, wrapped and with a holder's name, through the query and through its SQL."""
    import duckdb

    from waveband.llm.oracle import ORACLE_SQL

    texts = [t.replace("the copyright holder", "Some Holder Inc") for t in TEXTS.values()]
    texts += ["\n".join(line for part in t.split("\n") for line in (textwrap.wrap(part, 30) or [""])) for t in texts]
    texts += ["", "one;\n;\n\ntwo: three.\n \n#\nfour", "Released under the MIT License", " a.b c:d ;", "x.\n\n.\ny;z\r\nw.", None, "Neither the name of nor the names of its contributors."]
    path = str(tmp_path / "documents.parquet")
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(path)
    got = {tuple(r.asDict().items()) for r in QUERIES["op8_license_scan"](spark, str(tmp_path)).collect()}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{path}/*.parquet')")
    done = con.execute(ORACLE_SQL["op8_license_scan"])
    names = [d[0] for d in done.description]
    want = {tuple(zip(names, row, strict=True)) for row in done.fetchall()}
    assert {tuple(sorted(x)) for x in got} == {tuple(sorted(x)) for x in want}
    by_id = {dict(x)["doc_id"]: dict(x)["licenses"] for x in got}
    assert [by_id[k] for k in range(2 * len(TEXTS))] == list(TEXTS) * 2


def test_very_many_spans_in_one_text(spark):
    """What a text with n spans costs grows with n and little more: a text of 160,000 addresses is found and masked whole."""
    many = 160_000
    docs = spark.createDataFrame([(1, " ".join(f"u{i}@ex.org" for i in range(many)))], "doc_id long, text string")
    assert personal_data.find(docs).collect()[0]["n_email"] == many
    assert personal_data.mask(docs).collect()[0]["text"] == " ".join(["<EMAIL>"] * many)


def test_running_values_equal_the_plain_ones(spark):
    import itertools

    from pyspark.sql import functions as F

    draw = random.Random(2)
    rows = [[draw.randrange(9) for _ in range(n)] for n in (*range(12), 50, 1000)]
    frame = spark.createDataFrame([(r,) for r in rows], "v array<int>")
    for fold, plain in ((lambda a, b: a + b, int.__add__), (F.greatest, max)):
        got = frame.select("v", personal_data._running(F.col("v"), fold).alias("r")).collect()
        assert len(got) == len(rows)
        for r in got:
            assert r["r"] == list(itertools.accumulate(r["v"], plain, initial=0))[:-1]


def test_benchmark_blocks_hold_every_item_once(spark):
    items = [(k, " ".join(f"w{k % 40}x{j}" for j in range(k % 13))) for k in range(300)] + [(None, "lone words"), (7, None)]
    frame = spark.createDataFrame(items, "item_id long, text string")
    for block_words in (10**6, 100, 3):
        many, blocks = decontamination.window_blocks(frame, "item_id", "text", block_words)
        found = list(blocks)
        assert len(found) == many and (many == 1) == (block_words == 10**6)
        names = [name for block in found for name in block.ids]
        assert sorted(set(names), key=str) == sorted({"" if k is None else str(k) for k, t in items if t})
        assert len(names) == len(set(names))


def test_links_within_a_component_go_after_a_round(spark, monkeypatch):
    """Components of a chain, a group with three leaders, and scattered links; and of a group that has met no link is left."""
    tables, write = [], components.written

    def counted(df, name):
        found = write(df, name)
        tables.append((name, found.count()))
        return found

    monkeypatch.setattr(components, "written", counted)
    group = [(n, lead) for n in range(3, 300) for lead in (0, 1, 2)] + [(0, 1), (1, 2), (7, 7)]
    found = components.smallest_reachable(spark.createDataFrame(group, "a long, b long"))
    assert {tuple(r) for r in found.collect()} == {(n, 0) for n in range(300)}
    links = [n for name, n in tables if name == "links"]
    assert links[0] == len(group) - 1 and len(links) > 1 and links[1] == 0

    dice = random.Random(5)
    chain = [(n, n + 1) for n in range(1000, 1120)]
    hubs = [(3000 + n, 2000 + n % 40) for n in range(200)] + [(3000 + n, 2000 + dice.randrange(40)) for n in range(30)]
    scattered = [(dice.randrange(-80, 80) * 7, dice.randrange(-80, 80) * 7) for _ in range(70)]
    pairs = chain + hubs + scattered
    label = {n: n for pair in pairs for n in pair}
    for _ in range(len(label)):
        for a, b in pairs:
            label[a] = label[b] = min(label[a], label[b])
    expected = {(n, of) for n, of in label.items() if any(n in (a, b) and a != b for a, b in pairs)}
    assert {tuple(r) for r in components.smallest_reachable(spark.createDataFrame(pairs, "a long, b long")).collect()} == expected
