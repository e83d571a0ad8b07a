"""Toxicity: features and weights against plain versions, held-out rows, defined cases, and the bounded sample."""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pytest

pytest.importorskip("waveband.llm")
from waveband.llm import samples, toxicity  # noqa: E402
from waveband.llm.queries import QUERIES, table  # noqa: E402
from tests.llm import brute  # noqa: E402

SF = "/root/testdata/sf0.1"


def plain_features(text: str) -> dict[tuple, float]:
    """What a text's features stand for, without hashing, and their values."""
    words = [w.encode() for w in brute.ALNUM.findall(brute.lower(text))]
    found = Counter(("word", w) for w in words)
    found.update((size, w[:size]) for size in toxicity.STEMS for w in words if len(w) > size)
    found.update(("pair", skip, a, b) for skip in toxicity.SKIPS for a, b in zip(words, words[skip + 1 :], strict=False))
    share = {f: max(2.0**-14, 2.0 ** -math.floor(math.log2(len(words) / n))) for f, n in found.items()}
    return {f: 10 * math.sqrt(min(1.0, s)) for f, s in share.items()}


def features(texts: list[str]) -> list[dict[int, float]]:
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])]).astype(np.int64)
    row, bucket, level = toxicity._features(data, offsets)
    return [dict(zip(bucket[row == k].tolist(), toxicity._value(level[row == k]).tolist(), strict=True)) for k in range(len(texts))]


def test_features_are_those_of_the_plain_version():
    texts = ["You are so naïve, naïve you", "", "one", "a b a b a b", "STUPID stupidly stupid", "日本 语 x", "many " * 40_000 + "few"]
    got = features(texts)
    for text, own in zip(texts, got, strict=True):
        assert sorted(own.values()) == pytest.approx(sorted(plain_features(text).values()))  # no two of these few share a bucket
        assert features([text]) == [own]  # alone, by the way of long texts
    assert got[4] == features(["stupid stupidly Stupid"])[0] != got[2]


def plain_train(texts, labels, epochs, alpha, beta, l1, l2, balance):
    """FTRL-proximal one coordinate at a time."""
    z, n = {}, {}
    many = [max(1, labels.count(0)), max(1, labels.count(1))]

    def weight(i):
        one, two = (0, 0) if i == "bias" else (l1, l2)
        at = z.get(i, 0.0)
        return 0.0 if abs(at) <= one and i != "bias" else -(at - math.copysign(one, at)) / ((beta + math.sqrt(n.get(i, 0.0))) / alpha + two)

    order = np.random.default_rng(1)
    for _ in range(epochs):
        for k in order.permutation(len(texts)):
            own = {**texts[k], "bias": 1.0}
            now = {i: weight(i) for i in own}
            error = (1 / (1 + math.exp(-sum(now[i] * x for i, x in own.items()))) - labels[k]) * (max(many) / many[labels[k]]) ** balance
            for i, x in own.items():
                g = error * x
                before = n.get(i, 0.0)
                z[i] = z.get(i, 0.0) + g - (math.sqrt(before + g * g) - math.sqrt(before)) / alpha * now[i]
                n[i] = before + g * g
    return {i: w for i in z if i != "bias" and (w := weight(i))}, weight("bias")


def test_weights_are_those_of_the_plain_version():
    rng = np.random.default_rng(5)
    texts = [np.unique(rng.integers(0, 60, 12)) for _ in range(80)]
    levels = [rng.integers(0, 15, len(t)) for t in texts]
    labels = [int(7 in t) for t in texts]
    args = (4, 0.7, 1.0, 0.5, 1.0, 0.5)
    buckets, values, bias = toxicity.train([toxicity._packed(*own) for own in zip(texts, levels, strict=True)], labels, *args)
    plain, plain_bias = plain_train([{i: 10 * 2 ** (-k / 2) for i, k in zip(*map(np.ndarray.tolist, own), strict=True)} for own in zip(texts, levels, strict=True)], labels, *args)
    assert buckets.tolist() == sorted(plain) and bias == pytest.approx(plain_bias)
    assert values.tolist() == pytest.approx([plain[i] for i in sorted(plain)])
    assert len(plain) < 60  # L1 leaves weights out
    assert buckets[values.argmax()] == 7


def test_packed_features_come_back():
    for own in (np.arange(0), np.array([0, 5, (1 << toxicity.BITS) - 1]), np.arange(0, 1 << toxicity.BITS, 3)):
        level = np.arange(len(own)) % (toxicity.LEVELS + 1)
        packed = toxicity._packed(own, level)
        got = toxicity._unpacked(packed)
        assert len(packed) <= 1 << (toxicity.BITS - 1) and [x.tolist() for x in got] == [own.tolist(), level.tolist()]


def test_held_out_rows(spark):
    got = QUERIES["op12_toxicity"](spark, SF).collect()
    toxic = {r["doc_id"]: r["toxic"] for r in table(spark, SF, "labels").collect()}
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and r["predicted"] == (r["score"] >= 0.7) for r in got)
    own = [(r["predicted"], r["score"], toxic[r["doc_id"]]) for r in got if r["held_out"] and r["doc_id"] in toxic]
    clean, bad = [p for p, _, t in own if not t], [p for p, _, t in own if t]
    assert sum(clean) <= 0.01 * len(clean) and sum(bad) >= 0.9 * len(bad)
    ranked = sorted(own, key=lambda r: r[1])
    auc = (sum(k for k, r in enumerate(ranked) if r[2]) - len(bad) * (len(bad) - 1) / 2) / len(bad) / len(clean)
    assert auc > 0.97


SCHEMA = "doc_id long, text string, score double, label int, hash long, features string"


def test_defined_cases(spark):
    extra = (0.1, 1, 2, "f")
    texts = {i: f"plain words about matter {i}" + " you idiot" * (i % 2) for i in range(60)}
    long = "some calm prose " * 100_000
    rows = [(i, t, *extra) for i, t in texts.items()] + [(100, None, *extra), (101, "", *extra), (102, long, *extra), (None, "you idiot", *extra), (7, "another text", *extra), (1, texts[1], *extra)]
    docs = spark.createDataFrame(rows, SCHEMA)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(60)] + [(100, 0, 0), (102, 0, 0), (3, 0, 1), (3, 1, 1), (None, 1, 1), (5, None, 1), (999, 1, 1)], "doc_id long, toxic int, hash int")
    got = toxicity.score(docs, labels, keep=("doc_id", "label", "hash"), l1=0.5)
    assert got.columns == ["doc_id", "label", "hash", "score"] and got.count() == len(rows)
    scores = {(r["doc_id"], n): r["score"] for n, r in enumerate(got.collect())}
    assert all(0 <= s <= 1 for s in scores.values())
    by = [(r["doc_id"], r["score"]) for r in got.collect()]
    assert len({s for i, s in by if i in (100, 101)}) == 1
    assert min(s for i, s in by if i is None) > 0.5 > dict(by)[102]
    none = labels.where("toxic = 7")
    assert {r["score"] for r in toxicity.score(docs, none).collect()} == {0.5}
    assert toxicity.score(docs.where("doc_id = -1"), labels).count() == 0


def test_rows_with_held_back_ids_are_never_learnt_from(spark):
    ids = [i for i in range(400) if zlib.crc32(str(i).encode()) % 3 == 1]
    docs = spark.createDataFrame([(i, "you idiot") for i in ids], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in ids], "doc_id long, toxic int")
    assert {r["score"] for r in toxicity.score(docs, labels).collect()} == {0.5}


# ---- the bounded sample ----------------------------------------------------------------------

def test_the_smallest_of_each_label_whatever_the_cells(spark):
    rows = [(k % 3, f"{i}") for i in range(3000) for k in (i,)] + [(None, "x"), (9, "lone")]
    frame = spark.createDataFrame(rows, "label int, id string").repartition(200)
    hashed = frame.withColumn("h", samples.order_hash("id"))
    got = samples.smallest(hashed, "label", samples.F.col("h"), 100).collect()
    every = hashed.collect()
    for name in (0, 1, 2, 9):
        want = sorted(r["h"] for r in every if r["label"] == name)[:100]
        assert sorted(r["h"] for r in got if r["label"] == name) == want
    assert all(r["label"] is not None for r in got)


def test_one_id_with_a_third_of_all_rows_takes_one_place(spark):
    frame = spark.range(6000).selectExpr("1 AS label", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE CAST(id AS STRING) END AS id", "'same' AS text").repartition(200)
    hashed = frame.withColumn("h", samples.order_hash("id"))
    want = sorted({r["h"] for r in hashed.collect()})
    for many in (5, 50, 1500):
        bound = samples._bounds(hashed.select("label", samples.F.col("h").alias("order")), many)[1]
        assert sum(h <= bound for h in want) == many
    got = samples.different(frame, "label", "id", "text", 1000)
    assert got.count() == 1000 == got.select("id").distinct().count()


def test_rows_that_reach_a_task_do_not_grow_with_partitions(spark):
    """What is counted and sorted for the bound is one cell's rows, not the first rows of each input partition."""
    frame = spark.range(200_000).select(samples.F.lit(1).alias("label"), samples.F.xxhash64("id").alias("order")).repartition(200)
    cell = samples._cell("order")
    most = frame.groupBy(cell.alias("cell")).count().agg(samples.F.max("count")).collect()[0][0]
    assert most < 60
    bound = samples._bounds(frame, 1000)[1]
    assert frame.where(samples.F.col("order") <= bound).count() == 1000
