"""Column functions against literal expectations."""

import pytest
from pyspark.sql import functions as F

from fairground.functions import dates, filters, scores, urls
from fairground.functions import text as T


def one(spark, column, **values):
    row = spark.range(1).select(*(F.lit(v).alias(k) for k, v in values.items()))
    return row.select(column.alias("out")).first()["out"]


c = F.col


@pytest.mark.parametrize("raw,shown", [("SAGRA DEL TARTUFO!!!", "Sagra del Tartufo!"), ("  Festa   d'estate ?? ", "Festa d'estate ?"), ("", ""), (None, ""), ("12", "12"), ("🎉 Festa", "Festa"), ("a" * 130, "a" * 120), ("x " * 70, ("x " * 60).strip())])
def test_title_display(spark, raw, shown):
    assert one(spark, T.title_display(c("t").cast("string")), t=raw) == shown


def test_title_key(spark):
    key = lambda t, p=None: one(spark, T.title_key(c("t"), c("p").cast("string")), t=t, p=p)
    assert key("Sagra della Rana Vimercate", "Vimercate") == key("Vimercate: la Sagra della Rana", "Vimercate") == "della rana"
    assert key("53° Fiera") == "fiera" and key("53ª Fiera") == "53a fiera"
    assert key("Caffè però però") == "caffe pero pero"
    assert key("") == ""


@pytest.mark.parametrize(
    "a,b,same",
    [("fiorinchiostro", "fiorinchiostro mercato mostra", True), ("evento", "benefico evento grande serata", False), ("sagra tartufo", "nocciola sagra", False), ("concerto piazza", "comune concerto del piazza rock", False), ("", "", False)],
)
def test_titles_similar(spark, a, b, same):
    assert one(spark, T.titles_similar(c("a"), c("b")), a=a, b=b) is same


@pytest.mark.parametrize(
    "a,b,da,db,sa,sb,same",
    [
        ("cammino gruppi", "asl cammino cn1 gruppi promossi", None, None, ["s"], ["s"], True),
        ("culturale evento", "culturale evento", "uno due tre", "quattro cinque sei", ["s"], ["s"], False),
        ("uno", "altro", "stessa descrizione", "Stessa descrizione ", ["x"], ["y"], True),
        ("culturale evento", "culturale evento", None, None, ["x"], ["y"], False),
    ],
)
def test_events_duplicate(spark, a, b, da, db, sa, sb, same):
    row = spark.createDataFrame([(a, b, da, db, sa, sb)], "a string, b string, da string, db string, sa array<string>, sb array<string>")
    assert row.select(T.events_duplicate(c("a"), c("b"), c("da"), c("db"), c("sa"), c("sb"))).first()[0] is same


@pytest.mark.parametrize("raw,shown", [("21", "21:00"), ("21.30", "21:30"), ("9:5", "09:05"), ("", None), (None, None)])
def test_clock_time(spark, raw, shown):
    assert one(spark, dates.clock_time(c("t").cast("string")), t=raw) == shown


def test_dates(spark):
    span = lambda column: (lambda r: r and (r["start"], r["end"]))(column)
    assert span(one(spark, dates.numeric_range(c("t")), t="dal 12/09/2026 - 14/09/2026")) == ("2026-09-12", "2026-09-14")
    assert span(one(spark, dates.long_month_range(c("t")), t="11 Giugno 2026 - 1 Novembre 2026")) == ("2026-06-11", "2026-11-01")
    assert span(one(spark, dates.short_month_range(c("t")), t="3 set. 2026")) == ("2026-09-03", "2026-09-03")
    assert one(spark, dates.long_month_range(c("t")), t="niente") is None
    as_of = F.lit("2026-08-22").cast("date")
    assert span(one(spark, dates.day_month(c("t"), as_of), t="21 agosto")) == ("2027-08-21", "2027-08-21")
    assert span(one(spark, dates.day_month(c("t"), as_of), t="22 agosto")) == ("2026-08-22", "2026-08-22")
    assert span(one(spark, dates.day_month(c("t"), as_of), t="31 febbraio")) == ("2026-02-31", "2026-02-31")
    assert one(spark, dates.tooltip_date(c("t")), t="Giovedì 3 settembre 2026 alle ore 15:52") == "2026-09-03"
    assert one(spark, dates.tooltip_time(c("t")), t="Giovedì 3 settembre 2026 alle ore 15:52") == "15:52"
    assert one(spark, dates.mail_date(c("t")), t="Sat, 05 Sep 2026 23:30:00 +0200") == "2026-09-05"
    assert one(spark, dates.weekday_code(c("t")), t="Martedì") == "TU" and one(spark, dates.weekday_code(c("t")), t="boh") is None


def rule(spark, freq, days, ordinal, months, until=None):
    row = spark.createDataFrame([(freq, days, ordinal, months, until)], "f string, d array<string>, o int, m array<int>, u string")
    return tuple(row.select(dates.rrule_text(c("f"), c("d"), c("o"), c("m"), c("u")), dates.rule_words(c("f"), c("d"), c("o"), c("m"))).first())


def test_rules(spark):
    months = [m for m in range(1, 13) if m != 8]
    assert rule(spark, "mensile", ["SU"], 1, months) == ("FREQ=MONTHLY;BYDAY=1SU;BYMONTH=1,2,3,4,5,6,7,9,10,11,12", "prima domenica del mese, escluso agosto")
    assert rule(spark, "mensile", ["SA"], -1, list(range(1, 13)))[0] == "FREQ=MONTHLY;BYDAY=-1SA"
    assert rule(spark, "settimanale", ["MO", "TH"], None, [6, 7], "2026-07-31") == ("FREQ=WEEKLY;BYDAY=MO,TH;BYMONTH=6,7;UNTIL=20260731", "ogni lunedì e giovedì, solo giugno, luglio")
    assert rule(spark, "annuale", ["MO"], None, [])[0] is None


def test_occurrences(spark):
    row = spark.createDataFrame([("FREQ=MONTHLY;BYDAY=1SU", "2026-01-01", ["2026-10-04"])], "r string, d string, e array<string>")
    out = row.select(dates.occurrences(c("r"), F.to_date("d"), c("e"), F.lit("2026-08-01").cast("date"), F.lit(120))).first()[0]
    assert out == ["2026-08-02", "2026-09-06", "2026-11-01"]


@pytest.mark.parametrize("day,state", [("2026-08-01", "attiva"), ("2026-01-01", "da_verificare"), ("2024-01-01", "sospesa")])
def test_decay(spark, day, state):
    assert one(spark, dates.decay_state(F.to_date(c("d")), F.lit("2026-08-22").cast("date")), d=day) == state


@pytest.mark.parametrize(
    "text,image,reason",
    [
        ("Buon Natale e felice anno nuovo a tutti!", False, "schema_non_evento"), ("Grande festa del 2019, che serata indimenticabile!", False, "solo_date_passate"), ("Foto", False, "nessun_segnale_di_evento"), ("Foto", True, None),
        ("Sagra domani", False, "testo_troppo_corto_senza_immagine"), ("Sagra del tartufo il 3 ottobre 2026 in piazza del mercato", False, None), (None, False, "nessun_segnale_di_evento"), ("LUNEDÌ 3 grande serata in piazza con musica e cena per tutti", False, None),
    ],
)
def test_text_reason(spark, text, image, reason):
    assert one(spark, filters.text_reason(c("t").cast("string"), c("i"), F.lit("2026-08-22").cast("date")), t=text, i=image) == reason


def test_scores(spark):
    today = F.lit("2026-08-22").cast("date")
    p = lambda last: one(spark, scores.source_priority(F.lit("A"), F.lit(3), F.lit(0.0), c("l").cast("string"), F.lit(1), today), l=last)
    assert p(None) == p("2025-08-22T10:00:00") == 100 + 365 * 3 - 5
    assert one(spark, scores.queue_priority(F.lit("B"), F.lit("teatro"))) == 48
    penalty = lambda a, b, k: one(spark, scores.place_penalty(c("a").cast("string"), c("b").cast("string"), c("k").cast("string")), a=a, b=b, k=k)
    assert [penalty("x", "y", None), penalty(None, "y", "comune"), penalty(None, "y", "proloco"), penalty(None, "y", "aggregatore"), penalty(None, "y", None), penalty(None, None, "comune")] == [0, -3, -3, -10, -10, None]
    assert one(spark, scores.hamming_hex(F.lit("ffffffffffffffff"), F.lit("fffffffffffffff0"))) == 4


def test_urls(spark):
    verdict = lambda u: one(spark, urls.social_verdict(c("u").cast("string")), u=u)
    assert verdict("https://www.facebook.com/groups/1") == "gruppo_facebook"
    assert verdict("https://instagram.com/p/abc") == "permalink_post_da_risolvere"
    assert verdict("https://www.facebook.com/12345/") == "id_numerico_da_risolvere"
    assert verdict("https://m.facebook.com/ProLocoX/") == "ok" and verdict(None) == "scarto" and verdict("https://x.it") == "scarto"
    assert one(spark, urls.social_url(c("u")), u="http://m.facebook.com/ProLocoX/events?x=1") == "https://www.facebook.com/ProLocoX"
    assert one(spark, urls.social_handle(c("u")), u="https://www.facebook.com/people/Pro-Loco/100") == "Pro-Loco-100"
    assert one(spark, urls.author_handle(c("u"), F.lit("facebook")), u="https://www.facebook.com/profile.php?id=77&x=1") == "profile.php?id=77"
    assert one(spark, urls.author_handle(c("u"), F.lit("facebook")), u="https://www.facebook.com/ProLocoBUBBIO?__cft__=1") == "prolocobubbio"
    assert one(spark, urls.post_id(c("u"), F.lit("t")), u="/x/posts/123?y") == "123"
    assert one(spark, urls.further_url(c("u")), u="www.comune.it/x") == "https://www.comune.it/x" and one(spark, urls.further_url(c("u")), u="C:\\x") is None
    base = "https://a.it/ev/lista.html?x=1"
    for href, want in [("/b", "https://a.it/b"), ("c", "https://a.it/ev/c"), ("//z.it/q", "https://z.it/q"), ("?p=2", "https://a.it/ev/lista.html?p=2"), ("http://k.it", "http://k.it"), ("../d", "https://a.it/d")]:
        assert one(spark, urls.absolute(c("h"), F.lit(base)), h=href) == want


def test_posts(spark):
    assert one(spark, T.clean_post(c("t")), t="Facebook\n·\nSegui\n12 h\nt͏\nSagra domani\n\nAltro...") == "Sagra domani"
    subject, channel = T.subject_and_channel(c("s"), c("k"))
    assert (one(spark, subject, s="comune-sant'anna-alta-facebook", k="comune"), one(spark, channel, s="comune-x-facebook", k="comune")) == ("Comune di Sant'Anna Alta", "facebook")


def test_small_url_and_name_functions(spark):
    handle = lambda u: one(spark, urls.followed_handle(c("u")), u=u)
    assert handle("https://www.facebook.com/ProLocoX/") == "ProLocoX" and handle("/profile.php?id=77&x=1") == "profile.php?id=77" and handle("https://www.instagram.com/pro.loco?hl=it") == "pro.loco"
    assert one(spark, urls.page_town(c("u")), u="Via Roma 1, San Damiano d'Asti, Italy") == "San Damiano d'Asti" and one(spark, urls.page_town(c("u")), u="Via Roma 1") is None
    assert one(spark, urls.town_url(c("n"), c("p")), n="Nizza Monferrato", p="AT") == "https://www.comune.nizzamonferrato.at.it/"
    assert one(spark, urls.handle_url(F.lit("instagram"), c("h")), h="x") == "https://www.instagram.com/x"
    assert one(spark, T.comune_of_subject(c("s")), s="Asti - Teatro Alfieri - sala") == "Asti" and one(spark, T.comune_of_subject(c("s")), s="Teatro") is None
    assert one(spark, T.append_note(c("n"), F.lit("b")), n="a") == "a | b" and one(spark, T.append_note(F.lit(None).cast("string"), F.lit("b"))) == "b"


def test_image_functions():
    import numpy as np

    from fairground.operators import images

    rng = np.random.default_rng(0)
    grey = rng.random((32, 32)) * 255
    assert len(images.perceptual_hash(grey)) == 16 and images.perceptual_hash(grey) == images.perceptual_hash(grey * 0.5 + 3)
    noisy = int(images.perceptual_hash(grey), 16) ^ int(images.perceptual_hash(grey + rng.random((32, 32))), 16)
    assert noisy.bit_count() <= 4
    flat, split = np.full((50, 50), 90.0), np.hstack([np.zeros((50, 25)), np.full((50, 25), 255.0)])
    assert images.edge_share(flat) == 0 and 0 < images.edge_share(split) < 0.1
