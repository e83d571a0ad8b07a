"""The pipeline against a plain version, stage by stage, over whole sf0.001 and awkward rows."""

from __future__ import annotations

import hashlib
import re

import pytest

pytest.importorskip("waveband.llm")
import corpus_pipeline  # noqa: E402
from tests.llm import brute  # noqa: E402
from tests.llm.test_edges import SCHEMA, rows  # noqa: E402
from waveband.llm import personal_data, sentencepiece_coding  # noqa: E402

SF = "/root/testdata/sf0.001"


def _spans(spark, texts):
    docs = spark.createDataFrame(sorted(texts.items()), "doc_id long, text string")
    ranks = {k.name: i for i, k in enumerate(personal_data.KINDS)}
    return {r["doc_id"]: [(int(s), ranks[k], k, int(e)) for k, s, e in (x.split(":") for x in r["spans"].split(",") if x)] for r in personal_data.find(docs).collect()}


def test_run_equals_the_plain_version(spark):
    import sentencepiece

    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    items = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    texts = {i: c for i, t in texts.items() if (c := brute.cleaned(t)) is not None}
    texts = {i: texts[i] for i, (_, first) in brute.components(texts, words=5, percent=80).items() if i == first}
    texts = {i: brute.without_hits(t, items) for i, t in texts.items()}
    spans = _spans(spark, texts)
    for i, t in texts.items():
        assert [s for s in spans[i] if s[1] < 4] == brute.base_spans(t)
    texts = {i: brute.masked(t, spans[i]) for i, t in texts.items()}
    library = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_coding.default_model())
    want = []
    for i, t in sorted(texts.items()):
        ids = library.encode(t, add_bos=True, add_eos=True)
        raw = b"".join(x.to_bytes(4, "little") for x in ids)
        want.append((i, len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    got = sorted(tuple(r) for r in corpus_pipeline.run(spark, SF).collect())
    assert got == want and 0 < len(got) < 200


def test_stages_take_awkward_rows(spark):
    docs = spark.createDataFrame(rows(), SCHEMA).repartition(3, "n_words", "doc_id")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.schema.simpleString() == docs.schema.simpleString(), name
        got = out.collect()
        if name == "jaccard_join":
            ids = [r["doc_id"] for r in got]
            assert sorted(i for i in ids if i is not None) == [0, 2, 3, 4, 5, 5, 6, 7, 9, 10, 11, 12] and ids.count(None) == 2
        elif name != "quality_rules":
            assert len(got) == docs.count()
        assert stage(spark, docs.limit(0), SF).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == docs.count()


def test_rows_are_kept_by_row_and_not_by_id(spark):
    """A copy under an id that has another text too goes alone; that other text stays."""
    a, b = (" ".join(f"{x}{k}" for k in range(30)) for x in "ab")
    docs = spark.createDataFrame([(1, a, 1), (5, a, 2), (5, b, 3), (5, b, 3), (6, None, 4), (6, None, 4), (6, "", 5), (7, None, 6), (None, a, 7)], "doc_id long, text string, key int")
    got = corpus_pipeline.keep_one_of_each_group(spark, docs, SF).collect()
    assert sorted(((r["doc_id"], r["text"]) for r in got if r["doc_id"]), key=str) == sorted([(1, a), (5, b), (6, None), (6, ""), (7, None)], key=str)
    assert [r["key"] for r in got if r["doc_id"] is None] == [7]


def test_near_copies_go(spark):
    """Isolated edits that leave 80 percent of the five-word shingles, as planted copies have."""
    words = [f"w{k}" for k in range(200)]
    edited = [("x" if k in (20, 60, 100, 140) else w) for k, w in enumerate(words)]
    far = [("x" if k % 20 == 7 else w) for k, w in enumerate(words)]
    docs = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate((words, edited, far))], "doc_id long, text string")
    assert sorted(r["doc_id"] for r in corpus_pipeline.keep_one_of_each_group(spark, docs, SF).collect()) == [0, 2]


def test_texts_are_shuffled_once_to_keep_one_of_each_group(spark):
    docs = spark.createDataFrame(rows(), SCHEMA)
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}  # as with tables that are too large for it
    before = {k: spark.conf.get(k) for k in settings}
    kept = corpus_pipeline.keep_one_of_each_group(spark, docs, "")
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        query = kept.select("*")._jdf.queryExecution()
        mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
        blocks = query.explainString(mode).split("\n\n")
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    # a partial aggregate has a text as the value of first
    dealt = [b for b in blocks if re.search(r"\) Exchange\nInput \[\d+\]: \[.*\b(text|valueSet)#", b)]
    assert len(dealt) == 1, "\n\n".join(dealt)
