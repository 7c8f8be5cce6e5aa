"""Settings that must not change results, and bounds that must bound."""

import numpy as np
from pyspark.sql import functions as F

from fairground.llm import ann, chat, quality


def test_transcripts_under_small_files(spark):
    """A setting that cuts files leaves blocks of segments apart."""
    says = ["User: how are you %d?", "Assistant: fine, thanks %d.", "hello there %d", "System: be brief %d"]
    rows = spark.createDataFrame([(7, i, None, says[i % 4] % i) for i in range(400)], "conv_id long, turn long, role string, text string")
    want = sorted(map(str, chat.format_transcripts(spark, rows, block=16).collect()))
    name = "spark.sql.files.maxRecordsPerFile"
    spark.conf.set(name, 50)
    try:
        assert sorted(map(str, chat.format_transcripts(spark, rows, block=16).collect())) == want
    finally:
        spark.conf.unset(name)


def test_many_rows_under_one_labelled_id(spark, monkeypatch):
    """Rows that are gathered keep to the bound though all share two ids."""
    texts = ["good words of a calm text %d", "BAD!!! spam $$$ click %d"]
    docs = spark.createDataFrame([(i % 2, texts[i % 2] % i, "en", "s", 20) for i in range(1500)], "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(0, 1, 0), (1, 0, 0)], "doc_id long, quality int, toxic int")
    gathered = []
    plain = quality.Examples.of
    monkeypatch.setattr(quality.Examples, "of", staticmethod(lambda table, *a: (gathered.append(table.num_rows), plain(table, *a))[1]))
    out = quality.score_documents(spark, docs, labels, quality.Settings(labelled=100, rounds=1)).collect()
    assert len(out) == 1500 and 40 < gathered[0] < 200
    assert {r.keep for r in out if r.doc_id == 0} == {True} and {r.keep for r in out if r.doc_id == 1} == {False}


def test_many_vectors_under_one_id_and_copies(spark):
    """The sample keeps to its bound: by vectors, and copies once."""
    rng = np.random.default_rng(0)
    rows = [(3, v.tolist()) for v in rng.normal(size=(1500, 8))] + [(i, [1.0] * 8) for i in range(1500)]
    data = spark.createDataFrame(rows, "id long, v array<double>").withColumn("w", F.size("v"))
    learned = []
    original = ann.learn

    def learn(sample, *a, **k):
        learned.append(len(sample))
        return original(sample, *a, **k)

    ann.learn = learn
    try:
        ann.classifiers(data, {8: 3000}, ann.Settings(sample=300))
    finally:
        ann.learn = original
    assert len(learned) == 1 and 80 < learned[0] <= 300
