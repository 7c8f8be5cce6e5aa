"""Graded matching and field-wise merging against slow versions."""

import random
import time
from datetime import datetime, timedelta

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fairground.operators import matching, merging, tiles
from fairground.streaming import jobs


def pieces(words):
    return {("^" + w + "$")[i : i + 3] for w in words for i in range(len(w))}


def dice(a, b):
    return 2 * len(a & b) / (len(a) + len(b)) if a and b else 0.0


def slow_score(a, b):
    wa, wb = (set(x[0].lower().split()) for x in (a, b))
    ga, gb, gs = pieces(wa), pieces(wb), pieces(wa & wb)
    title = max(dice(ga, gb), 2 * len(gs) / (len(gs) + min(len(ga), len(gb))) if gs else 0.0)
    total, weight = 0.6 * title, 0.6
    for i in (1, 2):
        x, y = (pieces(set((r[i] or "").lower().split())) for r in (a, b))
        if x and y:
            total, weight = total + 0.2 * dice(x, y), weight + 0.2
    return round(total / weight, 6)


WORDS = "sagra sagre zucca zucchina fiera fiere vino vini teatro asti concerto concerti jazz blues".split()


def rows_of(seed, n=70):
    rng = random.Random(seed)
    return [(i, rng.choice("xy") if i % 9 else None, " ".join(rng.sample(WORDS, rng.randint(0, 5))), rng.choice([None, "", "Piazza Roma", "piazza roma", "piazza rome", "teatro"]), rng.choice([None, "pro loco", "Pro Loco Asti", "comune"])) for i in range(n)]


@pytest.mark.parametrize("seed, doubt, certain", [(1, 0.7, 0.85), (2, 0.7, 0.85), (3, 0.55, 0.6), (4, 0.9, 0.95)])
def test_scores_equal_all_pairs(spark, seed, doubt, certain):
    rows = rows_of(seed)
    df = spark.createDataFrame(rows, "id long, g string, titolo_normalizzato string, luogo string, organizzatore string")
    got = {(r.a, r.b): (r.punteggio, r.esito) for r in matching.scored_pairs(df, ["g"], doubt=doubt, certain=certain).collect()}
    key = lambda r: (r[1], *(tuple(sorted(set((r[i] or "").lower().split()))) for i in (2, 3, 4)))
    heads, want = {}, {}
    for r in rows:
        if key(r)[1]:
            if key(r) in heads:
                want[heads[key(r)][0], r[0]] = 1.0
            else:
                heads[key(r)] = r
    kept = sorted(heads.values())
    for i, a in enumerate(kept):
        for b in kept[i + 1 :]:
            if a[1] == b[1] and (score := slow_score(a[2:], b[2:])) >= doubt:
                want[a[0], b[0]] = score
    assert got == {k: (v, "duplicato" if v >= certain else "possibile_duplicato") for k, v in want.items()}
    assert len(want) > 10


def test_bound_never_loses_a_pair():
    for fields in range(3):
        t = matching.least_title(fields)
        assert abs((0.6 * t + 0.2 * fields) / (0.6 + 0.2 * fields) - 0.7) < 1e-9
    assert matching.least_title(0) > matching.least_title(1) > matching.least_title(2) > 0.49


def test_doubt_goes_to_review(spark):
    df = spark.createDataFrame([("a", "sagra zucca", "piazza roma", "pro loco"), ("b", "sagra zucche", "piazza roma", None), ("c", "sagra zucca", "piazza roma", "pro loco"), ("d", "altro vino", None, None), ("e", "sagra zuppa", "piazza roma", "pro loco")], "id string, titolo_normalizzato string, luogo string, organizzatore string").withColumn("g", F.lit("x"))
    pairs = matching.scored_pairs(df, ["g"])
    events = df.select(F.col("id").alias("event_id"), F.when(F.col("id") == "e", "ok").otherwise("nuovo").alias("stato"), F.lit("").alias("note"))
    out = {r.event_id: (r.stato, r.note) for r in matching.held_for_review(events, pairs).collect()}
    scores = {(r.a, r.b): r.esito for r in pairs.collect()}
    assert scores["a", "c"] == "duplicato" and ("a", "d") not in scores
    assert out["a"] == ("nuovo", "") and out["c"] == ("nuovo", "") and out["d"] == ("nuovo", "") and out["e"][0] == "ok"
    held = {b for (_, b), v in scores.items() if v == "possibile_duplicato"} - {b for (_, b), v in scores.items() if v == "duplicato"}
    assert {k for k, v in out.items() if v[0] == "quarantena"} == held - {"e"}
    assert {r.id: r.canonical for r in matching.same_event(df, pairs).collect()}["c"] == "a"
    assert matching.scored_pairs(df.limit(0), ["g"]).count() == 0


FIELDS = ["titolo", "prezzo", "url_immagine"]
SIGHTINGS = "prova int, meta int, k int, source_id string, tier string, confidenza double, visto timestamp, url string, titolo string, prezzo double, url_immagine string"


def sightings(n=600):
    rng = random.Random(5)
    maybe = lambda *v: rng.choice([None, *v])
    day = datetime(2026, 8, 1)
    return [(i % 12, rng.randint(0, 1), rng.randint(0, 4), f"s{rng.randint(0, 6)}", maybe("T0", "T1", "T2"), maybe(50.0, 80.0), maybe(day, day + timedelta(1)), maybe("u", "v"), maybe(" ", "A", "B"), maybe(1.0, 2.0), maybe("", "i")) for i in range(n)]


def slow_merge(rows):
    far = datetime(1, 1, 1)
    order = lambda r: (r[4] or "~", -(r[5] if r[5] is not None else -1.0), -((r[6] or far) - far).total_seconds(), r[3])
    out = {}
    for key in {(r[0], r[2]) for r in rows}:
        mine = [r for r in rows if (r[0], r[2]) == key]
        each = {}
        for i, f in ((8, "titolo"), (9, "prezzo"), (10, "url_immagine")):
            having = [r for r in mine if r[i] is not None and str(r[i]).strip()]
            best = min(having, key=lambda r: (order(r), r[i])) if having else None
            each[f] = (best[i], best[3]) if best else (None, None)
        out[key] = (each, tuple(sorted({r[3] for r in mine})))
    return out


def as_dict(rows):
    return {(r.prova, r.k): ({f: (r[f], r[f + "_fonte"]) for f in FIELDS}, tuple(r.fonti)) for r in rows.collect()}


def test_merge_equals_a_slow_one_and_halves_equal_the_whole(spark):
    """Twelve trials at once: each splits its sightings at random."""
    df = spark.createDataFrame(sightings(), SIGHTINGS)
    keys = ["prova", "k"]
    whole = as_dict(merging.merged(df, keys, FIELDS))
    assert whole == slow_merge(sightings())
    halves = [merging.states(df.where(f"meta = {i}"), keys, FIELDS) for i in (0, 1)]
    # The second half counts twice: a batch that is done again changes nothing.
    both = merging.combine(halves[0].unionByName(halves[1]).unionByName(halves[1]), keys)
    assert as_dict(merging.finish(both, keys)) == whole
    assert as_dict(merging.finish(merging.combine(both, keys), keys)) == whole
    assert merging.merged(df.limit(0), keys, FIELDS).count() == 0


def test_a_merge_partial_step_shuffles_one_row_a_task(spark):
    plan = merging.merged(spark.createDataFrame(sightings(), SIGHTINGS), ["k"], FIELDS)._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and plan.count("Exchange") <= 2


def test_streams_merge_into_the_same_state(spark, tmp_path):
    df = spark.createDataFrame(sightings(), SIGHTINGS)
    for half in (0, 1):
        df.where(f"meta = {half}").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = jobs.read_stream(spark, f"{tmp_path}/in", df.schema, "visto")
    merge = merging.into_state(f"{tmp_path}/state", ["prova", "k"], FIELDS)
    jobs.into_table(stream, merge, f"{tmp_path}/checkpoint").awaitTermination()
    # The same batch again, as after a crash between the write and the commit.
    merge(df.where("meta = 1"), 1)
    got = as_dict(merging.finish(merging.compact(spark, f"{tmp_path}/state", ["prova", "k"]), ["prova", "k"]))
    assert got == as_dict(merging.merged(df, ["prova", "k"], FIELDS))


@pytest.mark.parametrize("chunk, dense, pairs", [(7, 0.0, 3), (20, 1.0, 50), (1000, 1 / 256, 5)])
def test_scores_do_not_depend_on_tiles(spark, monkeypatch, chunk, dense, pairs):
    """Chunks of any size, all pieces counted by matrices or none, pairs taken a few at a time."""
    df = spark.createDataFrame(rows_of(5, 150), "id long, g string, titolo_normalizzato string, luogo string, organizzatore string")
    want = sorted(matching.scored_pairs(df, ["g"], doubt=0.6).collect())
    monkeypatch.setattr(matching, "CHUNK", chunk)
    got = sorted(matching.scored_pairs(df, ["g"], doubt=0.6).collect())
    assert len(want) > 100 and got == want
    rows = [(r[2], r[3] or "", r[4] or "") for r in rows_of(5, 150) if r[2]]
    plain = lambda x: " ".join(sorted(set(x.lower().split())))
    batch = pa.RecordBatch.from_arrays([pa.array([plain(r[i]) for r in rows]) for i in range(3)], ["title", "place", "organiser"])
    needed = [matching.least_title(n, 0.6) for n in range(3)]
    monkeypatch.setattr(tiles, "DENSE", dense)
    monkeypatch.setattr(tiles, "PAIRS", pairs)
    half = len(rows) // 2
    once = {(x, y): v for i, j, s in tiles.scores(batch, None, needed, (0.6, 0.2), 0.6) for x, y, v in zip(i.tolist(), j.tolist(), s.tolist(), strict=True)}
    over = {(x, y + half): v for i, j, s in tiles.scores(batch.slice(0, half), batch.slice(half), needed, (0.6, 0.2), 0.6) for x, y, v in zip(i.tolist(), j.tolist(), s.tolist(), strict=True)}
    assert {(min(k), max(k)): round(v, 6) for k, v in once.items() if round(v, 6) >= 0.6} == {(x, y): v for x in range(len(rows)) for y in range(x + 1, len(rows)) if (v := slow_score(rows[x], rows[y])) >= 0.6}
    assert {k: round(v, 6) for k, v in over.items()} == {(x, y): round(v, 6) for k, v in once.items() for x, y in [sorted(k)] if x < half <= y}


def test_titles_of_common_pieces(spark):
    """Titles of one block of which nearly all share pieces are compared in time, and scored as one by one."""
    rng = random.Random(9)
    syllables = "an en in on un re de te le ti al ar".split()
    word = lambda: "".join(rng.choices(syllables, k=rng.randint(1, 4)))
    rows = [(i, "x", " ".join(word() for _ in range(20)), f"{word()} {word()}", rng.choice(["s1", "s2", "s13"])) for i in range(6000)]
    df = spark.createDataFrame(rows, "id long, g string, titolo_normalizzato string, luogo string, organizzatore string")
    began = time.perf_counter()
    got = {(r.a, r.b): r.punteggio for r in matching.scored_pairs(df, ["g"], doubt=0.8).collect()}
    assert time.perf_counter() - began < 90
    drawn = [tuple(sorted(rng.sample(range(6000), 2))) for _ in range(3000)] + rng.sample(sorted(got), min(300, len(got)))
    assert got and {p: s for p in drawn if (s := slow_score(rows[p[0]][2:], rows[p[1]][2:])) >= 0.8} == {p: got[p] for p in drawn if p in got}
