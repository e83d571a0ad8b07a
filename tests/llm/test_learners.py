"""Quality and language against plain versions: cosines and votes one by one, the kernel by sets; what a repeated id brings."""

from __future__ import annotations

import numpy as np
import pytest

pytest.importorskip("waveband.llm")
from waveband.llm import flat, language_id, quality_neighbours, samples  # noqa: E402
from waveband.llm.queries import table  # noqa: E402

SF = "/root/testdata/sf0.001"


def learnt_rows(spark, texts, labels):
    """The rows ``(label, hash, text)`` that aren't held out, in the operators' order."""
    frame = spark.createDataFrame([(i, t, labels[i]) for i, t in texts.items() if i in labels and labels[i] is not None], "id long, text string, label string")
    rows = frame.where(~samples.held_out("id")).withColumn("hash", samples.order_hash("id", "text")).collect()
    return sorted((r["label"], r["hash"], r["text"] or "") for r in rows)


def test_quality_scores_equal_votes_counted_one_by_one(spark):
    docs, marks = table(spark, SF, "documents"), table(spark, SF, "labels")
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    labels = {r["doc_id"]: None if r["quality"] is None else str(r["quality"]) for r in marks.collect()}
    rows = learnt_rows(spark, texts, labels)

    def terms(text):
        raw = np.frombuffer(text.encode(), np.uint8)
        return quality_neighbours._terms(raw, np.array([0, len(raw)]))[0]

    projection, vectors = quality_neighbours._fit(np.array([terms(t) for _, _, t in rows]), 64)
    own = [int(label) for label, _, _ in rows]
    got = {r["doc_id"]: r["score"] for r in quality_neighbours.score(docs, marks).collect()}
    for i, text in list(texts.items())[::4]:
        v = terms(text) @ projection
        length = sum(float(x) ** 2 for x in v) ** 0.5
        cosines = sorted(((sum(float(a) * float(b) for a, b in zip(v, w, strict=True)) / max(length, 1e-9), k) for w, k in zip(vectors, own, strict=True)), reverse=True)[:25]
        # every labelled row is in the sample, so the labels' weights are alike
        votes = [(max(c, 1e-6) ** 8, k) for c, k in cosines]
        assert got[i] == pytest.approx(sum(v * k for v, k in votes) / sum(v for v, _ in votes), abs=2e-3)


def test_languages_equal_a_kernel_of_sets(spark):
    docs = table(spark, SF, "documents")
    rows_ = docs.collect()
    texts = {r["doc_id"]: r["text"] or "" for r in rows_}
    rows = learnt_rows(spark, {i: t for i, t in texts.items() if any(c.isalpha() for c in t)}, {r["doc_id"]: r["lang"] for r in rows_})

    def grams(text):
        low = flat.LOWER[np.frombuffer(text.encode(), np.uint8)]
        found = set()
        for order in language_id.ORDERS:
            found |= set(flat.gram_buckets(low, np.array([0, len(low)]), order, language_id.BUCKETS)[1].tolist())
        return found

    def kernel(a, b):
        return len(a & b) / (max(len(a), 1) * max(len(b), 1)) ** 0.5

    languages = sorted({label for label, _, _ in rows})
    sets = [grams(t) for _, _, t in rows]
    each = 128 // len(languages)
    marks = [k for name in languages for k in [i for i, r in enumerate(rows) if r[0] == name][:each]]
    square = np.array([[kernel(sets[a], sets[b]) for b in marks] for a in marks])
    values, vectors = np.linalg.eigh(square)
    root = vectors @ np.diag(1 / np.sqrt(np.maximum(values, 1e-6))) @ vectors.T
    features = np.array([[kernel(s, sets[m]) for m in marks] for s in sets]) @ root
    target = np.array([[1.0 if r[0] == name else -1.0 for name in languages] for r in rows])
    weights = np.linalg.solve(features.T @ features + 0.1 * np.eye(len(marks)), features.T @ target)
    got = {r["doc_id"]: r for r in language_id.predict(docs).collect()}
    for i, text in list(texts.items())[::4]:
        if any(c.isalpha() for c in text):
            own = grams(text)
            votes = np.array([kernel(own, sets[m]) for m in marks]) @ root @ weights
            assert got[i]["score"] == pytest.approx(min(max((votes.max() + 1) / 2, 0), 1), abs=5e-3)
            assert got[i]["lang_pred"] == languages[int(votes.argmax())] or np.sort(votes)[-1] - np.sort(votes)[-2] < 1e-2


def test_an_id_with_a_third_of_all_rows_does_not_fill_the_sample(spark):
    """Its equal rows count once, and of its different ones no more than the bound come to the driver."""
    words = {"en": "the and with from that", "de": "der und mit von das"}
    rows = [(k, f"{words[lang]} {lang}{k}", lang) for k in range(1, 200) for lang in [("en", "de")[k % 2]]]
    hot = next(k for k in range(1000, 2000) if spark.range(1).select(samples.F.lit(k).alias("id")).where(~samples.held_out("id")).count())
    rows += [(hot, f"{words['en']} same", "en")] * 60 + [(hot, f"{words['en']} other {k}", "en") for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(20)
    marks = spark.createDataFrame([(k, k % 2) for k in range(1, 200)] + [(hot, 1)] * 90, "doc_id long, quality int")
    found = docs.withColumnRenamed("doc_id", "id").where("lang = 'en'")
    assert samples.different(found, "lang", "id", "text", 30).count() == 30
    got = language_id.predict(docs, per_language=30).collect()
    assert len(got) == len(rows) and sum(r["lang_pred"] == "en" for r in got) == sum(lang == "en" for _, _, lang in rows)
    assert len(quality_neighbours.score(docs, marks, per_label=30).collect()) == len(rows)
