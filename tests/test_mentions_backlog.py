"""Names in texts against a naive search, and admission under a budget against a day-by-day simulation."""

import random
import re
import unicodedata
from datetime import date, timedelta

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from test_operators import comuni

from fairground.operators import backlog, mentions, places

NAMES = [("Asti", "Asti"), ("San Damiano", "San Damiano d'Asti"), ("San Damiano d'Asti", "San Damiano d'Asti"), ("Rocca", "Rocca A"), ("rocca", "Rocca B"), ("Forlì", "Forlì"), ("damiano d", "X"), ("", "nobody"), ("!!", "nobody")]


def words(text):
    plain = "".join(c for c in unicodedata.normalize("NFKD", (text or "").lower()) if not unicodedata.combining(c))
    return [w for w in re.split(r"[^\w]+", plain) if w]


def naive(text):
    names, out, at, held = {}, [], 0, words(text)
    for n, place in NAMES:
        if words(n):
            names.setdefault(tuple(words(n)), set()).add(place)
    while at < len(held):
        fit = [n for n in names if tuple(held[at : at + len(n)]) == n]
        if fit:
            best = max(fit, key=len)
            out.append((at, len(best), " ".join(best), tuple(sorted(names[best]))))
            at += len(best)
        else:
            at += 1
    return out


def texts(n=120):
    rng = random.Random(4)
    bits = "San san DAMIANO damiano d' d'Asti asti Asti, (Asti) Rocca-Asti forli Forlì fiera x".split()
    return [None, "", "   ", "astigiano", "Asti" * 3, *[" ".join(rng.choice(bits) for _ in range(rng.randint(0, 40))) for _ in range(n)], "San Damiano " * 3000]


@pytest.mark.parametrize("bound", [200_000, 3])
def test_names_equal_a_naive_search(spark, monkeypatch, bound):
    monkeypatch.setattr(mentions, "BROADCAST_NAMES", bound)
    monkeypatch.setattr(mentions, "SLICE", 17)
    rows = spark.createDataFrame(list(enumerate(texts())), "id long, testo string").withColumn("nome", F.lit("clash"))
    names = mentions.dictionary(spark.createDataFrame(NAMES, "nome string, comune string"))
    got = {}
    for r in mentions.mentions(rows, ["id"], "testo", names).collect():
        got.setdefault(r.id, []).append((r.inizio, r.parole, r.nome, tuple(r.comuni)))
        assert r.ambiguo == (r.nome == "rocca")
    assert {k: sorted(v) for k, v in got.items()} == {i: naive(x) for i, x in enumerate(texts()) if naive(x)}


def test_nothing_to_find(spark):
    rows = spark.createDataFrame([(1, "Asti")], "id long, testo string")
    none = mentions.dictionary(spark.createDataFrame([], "nome string, comune string"))
    assert mentions.mentions(rows, ["id"], "testo", none).count() == 0
    some = mentions.dictionary(spark.createDataFrame(NAMES, "nome string, comune string"))
    assert mentions.mentions(rows.limit(0), ["id"], "testo", some).count() == 0


def test_places_resolve_through_a_mention(spark):
    c = comuni(spark)
    known = spark.createDataFrame([("Teatro Alfieri", "Asti")], "nome string, comune string")
    rows = spark.createDataFrame([(1, "Asti", None), (2, "Teatro Comunale di Calosso", None), (3, "presso il teatro alfieri", "Calosso"), (4, "altrove", "Calosso"), (5, None, None)], "id long, luogo string, fonte string")
    out = mentions.resolve_places(rows, "id", places.place_keys(c), mentions.names_of(c, known), "luogo", F.col("fonte"), F.lit("comune"))
    got = {r.id: (r.comune, r.penalty) for r in out.collect()}
    assert got == {1: ("Asti", 0), 2: ("Calosso", 0), 3: ("Asti", 0), 4: ("Calosso", -3), 5: (None, None)}
    assert set(out.columns) == {"id", "luogo", "fonte", "comune", "km", "minuti", "fascia", "penalty"}


def simulate(rows, budget, until, rise):
    """Day by day, with the list of those that wait."""
    out, waiting = {}, []
    today = min((d for _, d, _ in rows if d), default=until)
    while today <= until:
        waiting += [r for r in rows if r[1] == today]
        waiting.sort(key=lambda r: (-((r[2] or 0) + rise * (today - r[1]).days), r[1], r[0]))
        out |= {r[0]: today for r in waiting[:budget]}
        waiting = waiting[budget:]
        today += timedelta(1)
    return out


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 9), st.integers(0, 4)), max_size=60), st.integers(0, 7), st.integers(0, 3))
def test_plan_equals_a_simulation(drawn, budget, rise):
    start, until = date(2026, 8, 1), date(2026, 8, 14)
    rows = sorted((start + timedelta(d), p) for d, p in drawn)
    rows = [(i, d, p) for i, (d, p) in enumerate(rows)]
    cells, place = {}, {}
    for i, d, p in rows:
        key = (d, p - rise * d.toordinal())
        cells[key] = cells.get(key, 0) + 1
        place[i] = (*key, cells[key])
    made = backlog.plan([(*k, n) for k, n in cells.items()], budget, until)
    got = {i: day for i, (d, r, n) in place.items() for dd, rr, after, upto, day in made if (d, r) == (dd, rr) and after < n <= upto}
    assert got == simulate(rows, budget, until, rise)


@pytest.mark.parametrize("budget, rise", [(7, 0), (13, 2), (0, 0), (1000, 1)])
def test_schedule_equals_a_simulation(spark, budget, rise):
    rng = random.Random(8)
    rows = [(f"a{i:03}", date(2026, 8, rng.randint(1, 9)) if i % 20 else None, rng.choice([None, 0, 1, 5])) for i in range(200)]
    df = spark.createDataFrame(rows, "artifact_id string, giorno date, priorita int").withColumn("_upto", F.lit("kept"))
    got = {r.artifact_id: r.ammesso_il for r in backlog.schedule(df.drop("_upto"), budget, "2026-08-11", rise=rise).collect()}
    want = simulate(rows, budget, date(2026, 8, 11), rise)
    assert got == {i: want.get(i) for i, *_ in rows}


def test_running_sums_over_ranges(spark):
    df = spark.range(1000).withColumn("n", F.col("id") % 3)
    got = sorted((r.id, r._upto) for r in backlog.running(df, ["id"], F.col("n")).collect())
    total = 0
    for i, upto in got:
        total += i % 3
        assert upto == total
    first, rest = backlog.admit(df, 10, [F.desc("id")])
    assert sorted(r.id for r in first.collect()) == list(range(990, 1000)) and rest.count() == 990
