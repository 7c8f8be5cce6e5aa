import hashlib
import re
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from samples import ODD

from fairground.llm import periodic
from fairground.llm.queries import op11_periodic_runs, planted_periods


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def slow_runs(words, min_length, min_power):
    """Each stretch that keeps a period, period by period; the first found is the smallest."""
    out, n = {}, len(words)
    for q in range(1, n // min_power + 1):
        i = 0
        while i + q < n:
            if words[i] == words[i + q]:
                j = i
                while j + q < n and words[j] == words[j + q]:
                    j += 1
                if j + q - i >= max(min_length, min_power * q):
                    out.setdefault((i, j + q), q)
                i = j
            i += 1
    return sorted(((s, e - s, q) for (s, e), q in out.items()), key=lambda r: (r[0], r[2]))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 2) | st.integers(0, 40), max_size=50), st.integers(1, 9), st.integers(1, 12)), min_size=1, max_size=4), st.sampled_from([(6, 4), (2, 2), (6, 3), (9, 5), (12, 4), (3, 6)]))
def test_runs_equal_a_slow_search(parts, kind):
    docs = [words[: p // 2] + (words * t)[: p * t] + words[p:] for words, p, t in parts]
    bounds = np.concatenate([[0], np.cumsum([len(d) for d in docs])])
    got = periodic.find_runs(np.array(sum(docs, []), np.int64), bounds, *kind)
    want = [(s + int(bounds[i]), s + n + int(bounds[i]), q) for i, d in enumerate(docs) for s, n, q in slow_runs(d, *kind)]
    assert [tuple(r) for r in got.tolist()] == want


def test_overlap_of_the_contract():
    assert periodic.min_overlap(6, 4) == 5 and periodic.min_overlap(2, 2) == 1


def test_masking_keeps_words_of_repeated_grams_only():
    words = np.array([1, 2, 3, 9, 1, 2, 3, 8, 7, 1, 2, 3])
    doc = np.array([0] * 9 + [1] * 3)
    assert periodic.masked(words, doc, 3).tolist() == [True] * 3 + [False] + [True] * 3 + [False] * 5


def test_one_word_very_often():
    x = np.zeros(100_000, np.int64)
    assert periodic.find_runs(x, np.array([0, len(x)])).tolist() == [[0, len(x), 1]]


def direct(doc_id, text):
    """What the registered query states of a document, word by word."""
    words, h = words_of(text), zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n, g = len(words), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = slow_runs(words, 6, 4)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2])) if runs else (None, None, None)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None, sha(lines), sha(kept))


TEXTS = ["a b " * 5, "x " * 9 + "y z " * 4, "\x1c \x85 é é é é é é é", "q\tq\nq\x0bq\x0cq\rq", "a b c d " * 3 + "e " + "a b c d " * 4, "one two three four five six " * 40]


def test_query_equals_a_slow_version(spark, make, tmp_path):
    docs = make(*ODD[:-5], *ODD[-4:], *TEXTS * 12, *[" ".join(f"w{(i * j) % 23}" for j in range(60)) for i in range(60)])
    docs = docs.union(docs.where("doc_id = 20")).unionByName(docs.where("doc_id in (12, 21)").withColumn("doc_id", F.lit(None).cast("long")))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    rows = op11_periodic_runs(spark, str(tmp_path)).collect()
    order = lambda r: tuple((v is not None, v) for v in r)
    want = [direct(r.doc_id, r.text) for r in docs.collect()]
    assert sorted(map(tuple, rows), key=order) == sorted(want, key=order)
    assert sum(r.n_runs > 0 for r in rows) > 60


def test_planted_periods_stand_where_they_should(spark, make):
    docs = make(*[" ".join(f"w{i}" for i in range(n)) for n in range(120)])
    got = {r.doc_id: r.text for r in planted_periods(docs).collect()}
    for i in range(120):
        h, words = zlib.crc32(str(i).encode()), [f"w{j}" for j in range(i)]
        if h % 10 == 0 and i:
            a, g = (h // 10) % i, h // 10
            p = 1 + (i - a) // (3 + g % 8)
            words = [words[j] if j < a else words[a + (j - a) % p] for j in range(i)]
        assert got[i] == " ".join(words)


def test_columns_stay_and_names_do_not_clash(spark, make):
    docs = make("a a a a a a a b", None).withColumns({"runs": F.lit(7), "collapsed": F.lit("x"), "whole_text": F.lit("y")})
    rows = periodic.periodic_runs(docs).orderBy("doc_id").collect()
    assert rows[0].runs == 7 and rows[0].collapsed == "x" and rows[0].whole_text == "y"
    assert [tuple(r) for r in rows[0].runs_] == [(0, 7, 1)] and rows[0].collapsed_ == "a b"
    assert rows[1].runs_ == [] and rows[1].collapsed_ == "" and rows[1].text is None
    assert periodic.periodic_runs(docs.limit(0)).count() == 0
