"""Nearest places against all pairs; seasons, stretches of errors and what follows from them against slow versions."""

import math
import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from fairground.operators import attention, geo, queue
from test_operators import comuni, table

from fairground import schemas


def air(a, b):
    (la, oa), (lb, ob) = ([math.radians(x) for x in p] for p in (a, b))
    h = math.sin((lb - la) / 2) ** 2 + math.cos(la) * math.cos(lb) * math.sin((ob - oa) / 2) ** 2
    return 2 * geo.RADIUS * math.asin(math.sqrt(min(1.0, h)))


@pytest.mark.parametrize("seed, n", [(1, 3), (2, 60), (3, 700)])
def test_nearest_equals_all_pairs(spark, seed, n):
    rng = random.Random(seed)
    spot = lambda wide: (rng.uniform(-90, 90), rng.uniform(-180, 180)) if wide else (rng.uniform(44, 46), rng.uniform(7, 10))
    places = [(f"p{i:03}", *spot(i % 7 == 0)) for i in range(n)] + [("polo", 90.0, 12.0), ("data", -16.0, 180.0), ("nessuno", None, 3.0), ("p000b", 45.0, 8.0)]
    points = [(i, *spot(i % 2)) for i in range(120)] + [(900, 89.9, -100.0), (901, -16.0, -179.99), (902, None, None), (903, 91.0, 0.0), (904, 45.0, 8.0), (905, 45.0, 8.0), (906, -90.0, 0.0)]
    out = geo.nearest(spark.createDataFrame(points, "id int, lat double, lon double"), spark.createDataFrame(places, "comune string, lat double, lon double")).collect()
    assert len(out) == len(points)
    for r in out:
        if r.lat is None or abs(r.lat) > 90:
            assert r.comune is None
            continue
        best = min((air((r.lat, r.lon), p[1:]), p[0]) for p in places if p[1] is not None)
        assert r.aria == pytest.approx(best[0], abs=1e-6) and air((r.lat, r.lon), next(p[1:] for p in places if p[0] == r.comune)) == pytest.approx(best[0], abs=1e-6)
    none = geo.nearest(spark.createDataFrame(points, "id int, lat double, lon double"), spark.createDataFrame([], "comune string, lat double, lon double"))
    assert none.where("comune is not null").count() == 0


def test_roads_and_bands(spark):
    road = geo.by_road(F.col("aria"))
    rows = spark.createDataFrame([(10.0,), (38.46,), (38.47,), (57.0,), (80.0,)], "aria double").select(*(c.alias(n) for n, c in road.items())).collect()
    assert [r.fascia for r in rows] == ["A", "A", "B", "B", None] and rows[0].km == 13.0 and rows[0].minuti == pytest.approx(13 / 55 * 60)


def test_seasons_wrap_the_turn_of_the_year(spark):
    today, rng = date(2026, 11, 1), random.Random(2)
    rows = [(s, today - timedelta(rng.randint(1, 1300))) for s in "abcdef" for _ in range(3)] + [("new", today - timedelta(200)), ("leap", date(2024, 2, 29)), ("next", today + timedelta(9)), ("year", date(2025, 1, 20)), ("none", None)]
    df = spark.createDataFrame([(s, d.isoformat() if d else None) for s, d in rows], "source_id string, data_inizio string")
    since, until = F.lit(today), F.lit(today + timedelta(400))
    stretches = attention.seasons(df, since, until)
    days = spark.createDataFrame([(today + timedelta(i),) for i in range(0, 400)] + [(None,)], "giorno date")
    got = sorted((r.source_id, r.giorno) for r in attention.in_season(days, stretches).collect())
    want = set()
    for s in {s for s, _ in rows}:
        past = [d for x, d in rows if x == s and d and d < today and (d.year, d.month, d.day) >= (today.year - 3, today.month, today.day)]
        if past and (today - min(past)).days >= 300:
            for d in past:
                for y in range(1, 6):
                    at = date(d.year + y, d.month, 28 if (d.month, d.day) == (2, 29) and (d.year + y) % 4 else d.day)
                    want |= {(s, today + timedelta(i)) for i in range(400) if -60 <= (today + timedelta(i) - at).days <= 5}
    assert got == sorted(want)
    assert ("year", date(2026, 12, 25)) in want and ("new", date(2027, 4, 1)) not in want
    # Stretches of a source neither touch nor overlap.
    spans = sorted((r.source_id, r.inizio, r.fine) for r in stretches.collect())
    assert all(a[0] != b[0] or (b[1] - a[2]).days > 1 for a, b in zip(spans, spans[1:]))


def test_visits_and_priority_by_season(spark):
    stretches = spark.createDataFrame([("comune-asti", date(2026, 8, 1), date(2026, 9, 1))], "source_id string, inizio date, fine date")
    sources = table(spark, schemas.SOURCES, {"source_id": "comune-asti", "last_run": "2026-08-20 10:00:00", "tier": "T1_html"}, {"source_id": "x", "last_run": "2026-08-20", "tier": "T1_html"}, {"source_id": "y", "tier": "T1_html"})
    today = F.lit("2026-08-22").cast("date")
    out = {r.source_id: (r.in_stagione, str(r.prossima_visita)) for r in attention.next_visits(sources, stretches, today).collect()}
    assert out == {"comune-asti": (True, "2026-08-23"), "x": (False, "2026-09-07"), "y": (False, "2026-08-22")}
    plain = {r.source_id: r.priorita for r in queue.by_priority(sources, comuni(spark), today).collect()}
    more = {r.source_id: r.priorita for r in queue.by_priority(sources, comuni(spark), today, season=stretches).collect()}
    assert more["comune-asti"] == plain["comune-asti"] + 25 and more["x"] == plain["x"]


def slow_stretch(rows):
    out = {}
    for s in {r[0] for r in rows}:
        seq = sorted((t, k) for x, t, k in rows if x == s)
        n = 1
        while n < len(seq) and seq[-n - 1][1] == seq[-1][1]:
            n += 1
        out[s] = (seq[-1][1], seq[-n][0], seq[-1][0], n, n == len(seq))
    return out


MESSAGES = {"riuscita": None, "permanente": "HTTP 404", "blocco": "captcha richiesto", "transitorio": "timeout", "struttura": "nessun annuncio estratto"}


@pytest.mark.parametrize("seed", [1, 2])
def test_stretches_merge_batch_by_batch(spark, seed):
    rng = random.Random(seed)
    at = lambda h: datetime(2026, 1, 1) + timedelta(hours=h)
    rows = [(f"s{rng.randint(0, 9)}", at(rng.randint(0, 60)), rng.choice(list(MESSAGES)[: rng.randint(1, 5)])) for _ in range(200)] + [(f"w{i}", at(i), "permanente") for i in range(6)]
    df = lambda part: spark.createDataFrame([(s, t, MESSAGES[k]) for s, t, k in part] + [(None, at(0), None)], "source_id string, ts timestamp, errore string")
    as_rows = lambda out: {r.source_id: (r.classe, r.dal, r.al, r.n, r.intera) for r in out.collect()}
    assert as_rows(attention.last_stretch(df(rows))) == slow_stretch(rows)
    cuts = [at(0), at(17), at(40), at(99)]
    state = None
    for a, b in zip(cuts, cuts[1:]):
        part = attention.last_stretch(df([r for r in rows if a <= r[1] < b]))
        state = part if state is None else attention.continued(state, part)
    assert as_rows(state) == slow_stretch(rows)


def test_verdicts_of_errors(spark):
    t0 = datetime(2026, 1, 1)
    rows = [("a", "permanente", 0, 14, 3), ("b", "permanente", 0, 13, 30), ("c", "blocco", 0, 40, 2), ("d", "blocco", 0, 40, 9), ("e", "struttura", 0, 2, 1), ("f", "transitorio", 0, 99, 9), ("g", "riuscita", 0, 1, 1)]
    df = spark.createDataFrame([(s, k, t0 + timedelta(a), t0 + timedelta(b), n) for s, k, a, b, n in rows], "source_id string, classe string, dal timestamp, al timestamp, n long")
    out = {r.source_id: (r.stato, r.segnalata, (r.riprova_dal - t0.date()).days) for r in attention.verdicts(df).collect()}
    assert out == {"a": ("rotta", True, 44), "b": ("attiva", False, 13), "c": ("attiva", False, 54), "d": ("attiva", False, 70), "e": ("attiva", True, 2), "f": ("attiva", False, 99), "g": ("attiva", False, 1)}
    src = table(spark, schemas.SOURCES, *({"source_id": s, "stato": "rotta" if s == "g" else "esclusa" if s == "b" else "attiva"} for s in "abgz"))
    after = {r.source_id: r.stato for r in attention.mark_broken(src, attention.verdicts(df)).collect()}
    assert after == {"a": "rotta", "b": "esclusa", "g": "attiva", "z": "attiva"}
    kinds = spark.createDataFrame([(m,) for m in ("HTTP 403", "404 Not Found", "504", None, "dominio scaduto", "Too Many Requests")], "m string").select(attention.error_kind(F.col("m")).alias("k")).collect()
    assert [r.k for r in kinds] == ["blocco", "permanente", "transitorio", None, "permanente", "blocco"]
