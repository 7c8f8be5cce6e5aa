"""Nearest neighbours, transcripts and the pipeline."""

import numpy as np
from samples import ODD

from fairground.llm import ann, chat


def vectors(spark, x, ids=None):
    ids = range(len(x)) if ids is None else ids
    return spark.createDataFrame([(int(i), None if v is None else [float(c) if c is not None else None for c in v], 0) for i, v in zip(ids, x)], "vec_id long, embedding array<float>, label int")


def exact(x, q, k):
    n = np.sqrt((x**2).sum(1))
    score = x @ x[q] / (n * n[q])
    score[q] = -9
    return np.lexsort((np.arange(len(x)), -score))[:k], score


def test_recall(spark):
    from pyspark.sql import functions as F

    rng = np.random.default_rng(0)
    centres = rng.standard_normal((30, 16)) * 2
    x = np.float32(centres[rng.integers(0, 30, 3000)] + rng.standard_normal((3000, 16)))
    settings = ann.Settings(sample=1500, block=128, query_block=16)
    rows = ann.nearest(spark, vectors(spark, x), F.col("vec_id") % 50 == 0, settings=settings).collect()
    found = {}
    for r in rows:
        found.setdefault(r.query_id, []).append(r)
    assert set(found) == set(range(0, 3000, 50))
    hits = 0
    for q, own in found.items():
        best, score = exact(np.float64(x), q, 5)
        own.sort(key=lambda r: r.rank)
        assert [r.rank for r in own] == [1, 2, 3, 4, 5]
        assert np.allclose([r.score for r in own], score[[r.vec_id for r in own]], atol=1e-12)
        assert all((-a.score, a.vec_id) < (-b.score, b.vec_id) for a, b in zip(own, own[1:]))
        hits += len({r.vec_id for r in own} & set(best.tolist()))
    assert hits >= 0.9 * 5 * len(found)


def test_ties_and_unusable(spark):
    from pyspark.sql import functions as F

    x = [[1, 0], [1, 0], [1, 0], [1, 0], [1, 0], [1, 0], [1, 0], [0, 1], None, [0, 0], [None, 1], [float("nan"), 1], [float("inf"), 1], [1, 2, 3], [2, 4, 7]]
    rows = ann.nearest(spark, vectors(spark, x), F.col("vec_id").isin(0, 3, 7, 8, 9, 10, 13)).collect()
    got = {}
    for r in sorted(rows, key=lambda r: r.rank):
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert got == {0: [1, 2, 3, 4, 5], 3: [0, 1, 2, 4, 5], 7: [0, 1, 2, 3, 4], 13: [14]}
    few = ann.nearest(spark, vectors(spark, [[1, 0], [1, 1]]), F.lit(True)).collect()
    assert sorted((r.query_id, r.rank, r.vec_id) for r in few) == [(0, 1, 1), (1, 1, 0)]
    assert ann.nearest(spark, vectors(spark, [None]), F.lit(True)).count() == 0
    assert ann.nearest(spark, vectors(spark, [[1, 0]]).limit(0), F.lit(True)).count() == 0


def test_parallel_vectors_go_by_id(spark):
    """Sixty vectors with cosine 1 to each other, not equal: the smallest ids are the nearest."""
    from pyspark.sql import functions as F

    x = [[float(1 << (i % 12)), 0.0] for i in range(60)] + [[-1.0, 0.5]] * 3
    rows = ann.nearest(spark, vectors(spark, x).withColumns({"w": F.lit("own"), "part": F.lit(1)}), F.col("vec_id").isin(0, 30)).collect()
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in rows}
    assert [got[0, n] for n in range(1, 6)] == [(n, 1.0) for n in range(1, 6)] and [got[30, n] for n in range(1, 6)] == [(n - 1, 1.0) for n in range(1, 6)]


def clustered(n, seed):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((60, 24)) * 3
    return np.float32(centres[rng.integers(0, 60, n)] + rng.standard_normal((n, 24)))


def test_few_vectors_are_compared_where_there_is_structure(spark):
    """Recall by learned partitions of one and of two levels, and the share of vectors that a query is compared with."""
    from pyspark.sql import functions as F

    x = clustered(6000, 3)
    for settings in (ann.Settings(), ann.Settings(most_parts=8, parts_factor=0.8, sample=2000)):
        data = vectors(spark, x).select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("v"), F.size("embedding").alias("w"))
        node = ann.classifiers(data, {24: len(x)}, settings)[24]
        assert bool(node.inner) == (settings.most_parts == 8)
        sizes = np.bincount(node.file(np.float64(x), settings.most_parts), minlength=settings.most_parts**2)
        row, part = node.route(np.float64(x[::50]), settings.most_parts, settings.least_probes)
        assert len(set(zip(row.tolist(), part.tolist()))) == len(row)
        assert sizes[part].sum() / (len(x) * len(x[::50])) <= 0.3
        rows = ann.nearest(spark, vectors(spark, x), F.col("vec_id") % 50 == 0, settings=settings).collect()
        hits = sum(r.vec_id in exact(np.float64(x), r.query_id, 5)[0] for r in rows)
        assert hits >= 0.9 * 5 * len(x[::50])


def test_recall_on_the_table(spark):
    import os

    import pytest
    from pyspark.sql import functions as F

    if not os.path.isdir("/root/testdata/sf0.1"):
        pytest.skip("no test tables")
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    x = np.stack([np.float64(r.embedding) for r in rows.orderBy("vec_id").collect()])
    got = ann.nearest(spark, rows, F.col("vec_id") % 50 == 0).collect()
    hits = sum(r.vec_id in exact(x, r.query_id, 5)[0] for r in got)
    assert len(got) == 5 * len(x[::50]) and hits >= 0.9 * len(got)


def test_sampling_survives_any_size(spark):
    """One row in 10**12 is a share that a hash can still draw."""
    from fairground.llm.common import drawn

    many = spark.range(1 << 18)
    assert 0.20 < many.where(drawn(0.25, "id")).count() / (1 << 18) < 0.30 and spark.range(9).where(drawn(1.0, "id")).count() == 9
    # Of ten billion rows 8192 are drawn: the share is no longer one in a million, and it is not none.
    share = 8192 / 1e10
    assert not many.where(drawn(share, "id")).count() and str(int(share * (1 << 62))) in drawn(share, "id")._jc.toString()


def test_parts_are_balanced():
    rng = np.random.default_rng(1)
    x = ann.unit(rng.standard_normal((500, 8)))
    sizes = np.bincount(ann.balanced_parts(ann.neighbour_graph(x, 8), 8, rng), minlength=8)
    assert sizes.max() - sizes.min() <= 3


def viterbi_slowly(score, start, step):
    best, back = start + score[0], []
    for row in score[1:]:
        ways = best[:, None] + step
        back.append(ways.argmax(0))
        best = ways.max(0) + row
    path = [int(best.argmax())]
    for b in reversed(back):
        path.append(int(b[path[-1]]))
    return path[::-1]


def test_viterbi():
    rng = np.random.default_rng(2)
    sizes = np.array([9, 4, 4, 1])
    score, start, step = rng.random((18, 3)), rng.random(3), rng.random((3, 3))
    first = np.array([0, 9, 13, 17])
    got = chat.viterbi(score, first, sizes, np.tile(start, (4, 1)), step, np.full(4, -1))
    assert got.tolist() == [s for f, n in zip(first, sizes) for s in viterbi_slowly(score[f : f + n], start, step)]


def conversation(spark, *rows):
    return spark.createDataFrame(list(rows), "conv_id long, turn long, role string, text string")


def test_transcripts(spark):
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", "short question?" if t % 2 == 0 else "a much longer answer with\nseveral lines\nof text " * 3) for c in range(30) for t in range(9)]
    hidden = [(99, t, None, r[3]) for t, r in enumerate(rows[:9])]
    marked = [(100, 0, None, "System: You are kind\nUser: hi?\nAssistant: hello\n- there"), (100, 1, None, None), (None, None, "user", "alone"), (101, 0, "user", ODD[5]), (100, 1, None, None)]
    table = conversation(spark, *rows, *hidden, *marked)
    whole = chat.format_transcripts(spark, table).collect()
    roles = {(r.conv_id, r.turn, r.segment): r for r in whole}
    assert [roles[99, t, 0].role for t in range(9)] == ["user", "assistant"] * 4 + ["user"]
    assert [(roles[100, 0, s].role, roles[100, 0, s].text) for s in range(3)] == [("system", "You are kind"), ("user", "hi?"), ("assistant", "hello\n- there")]
    assert roles[100, 0, 1].rendered == "<|user|>\nhi?\n<|end|>" and (None, None, 0) in roles and len(whole) == len(rows) + 9 + 2 + 5
    key = lambda r: (r.conv_id is None, r.conv_id or 0, r.turn or 0, r.segment, r.text, r.role)
    assert sorted(whole, key=key) == sorted(chat.format_transcripts(spark, table, block=2).collect(), key=key)
    assert chat.format_transcripts(spark, table.limit(0)).count() == 0


def test_one_hot_turn_is_decoded_in_blocks(spark):
    """Rows without conversation and turn, and repeats of one turn, against Viterbi over each conversation as a whole."""
    from pyspark.sql import functions as F

    rng = np.random.default_rng(5)
    texts = ["short?", "a long answer\nwith lines " * 4, "User: hi\nAssistant: well\nUser: so?", "System: be kind", "- a\n- b", None]
    hot = [(None, None, None, texts[i]) for i in rng.integers(0, 6, 90)] + [(7, 1, None, texts[i]) for i in rng.integers(0, 6, 60)] + [(7, int(t), None, texts[i]) for t, i in enumerate(rng.integers(0, 6, 9))]
    known = [(c, t, ["user", "assistant"][t % 2], texts[t % 2]) for c in range(20, 30) for t in range(6)]
    table = conversation(spark, *hot, *known).withColumns({"block": F.lit("own"), "at": F.lit(1)})
    segs = chat.segments(table)
    hmm = chat.fit(segs)
    rows = segs.withColumn("score", chat.emissions(hmm)).collect()
    low = lambda x: (x is not None, x or 0)
    rows.sort(key=lambda r: (low(r.conv_id), low(r.turn), r.tie, r.row, r.segment))
    want = []
    for conv in {r.conv_id for r in rows}:
        own = [r for r in rows if r.conv_id == conv]
        path = viterbi_slowly(np.array([r.score for r in own]), hmm.start, hmm.step)
        want += [(conv, r.turn, r.segment, chat.ROLES[s], r.text) for r, s in zip(own, path)]
    key = lambda r: tuple(map(str, r))
    for block in (3, 2048):
        got = [tuple(r)[:5] for r in chat.format_transcripts(spark, table, block=block).collect()]
        assert sorted(got, key=key) == sorted(want, key=key)


def test_pipeline(spark, make, tmp_path):
    import corpus_pipeline

    text = " ".join(f"w{i % 97}x{i % 13}" for i in range(200))
    leak = " ".join(f"item{i}" for i in range(30))
    docs = make(text, text + " tail", "mail me at a.b@c.example.com now " + " ".join(f"z{i}" for i in range(30)), "before " + leak, "", None)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(0, leak)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "near_duplicates", "benchmark_decontamination", "personal_data", "sequence_packing"]
    now = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, str(tmp_path))
        assert now.columns == docs.columns
    rows = {r.doc_id: r for r in now.collect()}
    assert set(rows) == {0, 2, 4, 5} and "a.b@c" not in rows[2].text and rows[2].n_chars == len(rows[2].text) and rows[5].text is None
    assert {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} == {0, 2, 4, 5}


def test_registered_queries():
    import __spark_entry__ as entry

    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 11)) and "pipeline" in entry.queries()


def test_join_against_sql(spark):
    import os

    import duckdb
    import pytest

    from fairground.llm import queries

    folder = "/root/testdata/sf0.001"
    if not os.path.isdir(folder):
        pytest.skip("no test tables")
    db = duckdb.connect()
    db.execute(f"create view documents as select * from '{folder}/documents.parquet'")
    want = sorted(db.execute(queries.ORACLE_SQL["op9_ngram_join"]).fetchall())
    assert sorted(tuple(r) for r in queries.op9_ngram_join(spark, folder).collect()) == want
