"""Parsers on small payloads made here."""

import json

from pyspark.sql import functions as F

from fairground.sources import feeds, markup


def payload(spark, text, **more):
    row = {"source_id": "s", "url": "https://a.it/ev", "payload": text} | more
    return spark.createDataFrame([tuple(row.values())], ", ".join(f"{k} string" for k in row))


def test_ical(spark):
    text = "BEGIN:VCALENDAR\r\nBEGIN:VEVENT\r\nSUMMARY:Sagra\\, la \r\n grande\r\nDTSTART;TZID=Europe/Rome:20260912T2130\r\nLOCATION:Piazza\r\nEND:VEVENT\r\nBEGIN:VEVENT\r\nDTSTART:20260101\r\nEND:VEVENT\r\nBEGIN:VEVENT\r\nSUMMARY:Due\r\nDTSTART;VALUE=DATE:20261003\r\nDTEND:20261004\r\nURL:https://b.it\r\nEND:VEVENT\r\nEND:VCALENDAR"
    rows = feeds.parse_ical(payload(spark, text)).orderBy("data_inizio").collect()
    assert [(r.titolo, r.data_inizio, r.data_fine, r.ora_inizio, r.url) for r in rows] == [("Sagra, la grande", "2026-09-12", "2026-09-12", "21:30", "https://a.it/ev"), ("Due", "2026-10-03", "2026-10-04", None, "https://b.it")]
    assert feeds.parse_ical(payload(spark, "")).count() == 0


def test_rss_and_atom(spark):
    rss = "<rss><channel><item><title>Festa &amp; fiera</title><link>https://a.it/1</link><description><![CDATA[In piazza]]></description><pubDate>Sat, 05 Sep 2026 23:30:00 +0200</pubDate></item><item><title>Senza</title></item></channel></rss>"
    rows = feeds.parse_rss(payload(spark, rss)).orderBy("text").collect()
    assert [(r.text, r.url, str(r.context_date)) for r in rows] == [("Festa & fiera\nIn piazza", "https://a.it/1", "2026-09-05"), ("Senza", "https://a.it/ev", "None")]
    atom = '<feed xmlns="http://www.w3.org/2005/Atom"><entry><title>Uno</title><link href="https://a.it/u"/><content>Testo</content><updated>2026-01-02T03:04:05Z</updated></entry></feed>'
    row = feeds.parse_rss(payload(spark, atom)).first()
    assert (row.text, row.url, str(row.context_date)) == ("Uno\nTesto", "https://a.it/u", "2026-01-02")


def test_jsonld(spark):
    a = {"@type": "Event", "name": "Mostra &egrave; qui", "startDate": "2026-09-12T10:00", "location": {"address": [{"addressLocality": "Asti"}]}}
    b = {"@graph": [{"@type": ["Thing", "Event"], "name": "Due", "startDate": "2026-10-01", "endDate": "2026-10-02", "location": "Alba", "url": "https://b.it"}, {"@type": "Place", "name": "no"}]}
    c = [{"@type": "Event", "name": "Tre", "startDate": "2026-11-01", "location": {"name": "Teatro"}}, {"@type": "Event", "name": "Senza data"}]
    html = "".join(f'<script type="application/ld+json">{x}</script>' for x in (json.dumps(a), "{rotto", json.dumps(b), json.dumps(c)))
    rows = feeds.parse_jsonld(payload(spark, html)).orderBy("data_inizio").collect()
    assert [(r.titolo, r.data_inizio, r.data_fine, r.luogo_testuale, r.url) for r in rows] == [("Mostra è qui", "2026-09-12", "2026-09-12", "Asti", "https://a.it/ev"), ("Due", "2026-10-01", "2026-10-02", "Alba", "https://b.it"), ("Tre", "2026-11-01", "2026-11-01", "Teatro", "https://a.it/ev")]


def test_cards(spark):
    html = """<div class="card-wrapper x"><a href="/d/1"><h3 class="card-title">Fiera</h3></a><span class="data">12/09/2026 - 14/09/2026</span></div>
    <div class="card-wrapper"><h3><a href="due">Mostra</a></h3><span class="card-day">11 Giugno 2026 - 1 Novembre 2026</span><p class="text-paragraph-card"> Bella </p></div>
    <div class="card-wrapper"><h3 class="card-title">Sagra 2027</h3><span class="card-date">5</span><span class="card-day">maggio</span></div><div class="card-wrapper"><p>vuoto</p></div>"""
    rows = markup.parse_cards(payload(spark, html), F.lit("2026-08-22").cast("date")).orderBy("titolo").collect()
    assert [(r.titolo, r.data_inizio, r.data_fine, r.url, r.descrizione) for r in rows] == [("Fiera", "2026-09-12", "2026-09-14", "https://a.it/d/1", None), ("Mostra", "2026-06-11", "2026-11-01", "https://a.it/due", "Bella"), ("Sagra 2027", "2027-05-05", "2027-05-05", "https://a.it/ev", None)]
    stamped = "".join(f'<div class="card-wrapper"><h3 class="card-title">T{i}</h3><span class="card-date">22</span><span class="card-day">agosto</span></div>' for i in range(2))
    assert markup.parse_cards(payload(spark, stamped), F.lit("2026-08-22").cast("date")).count() == 0


def test_pages_and_details(spark):
    good = '<html><head><meta property="og:image" content="/i.jpg"></head><body><nav>lunedì</nav><p>Sabato 3 ottobre grande festa</p></body></html>'
    row = markup.parse_pages(payload(spark, good)).first()
    assert row.text == "Sabato 3 ottobre grande festa" and row.image_urls == ["https://a.it/i.jpg"]
    assert markup.parse_pages(payload(spark, "<p>Solo sabato</p>")).count() == 0
    links = spark.createDataFrame([("s", "https://a.it/d")], "source_id string, url string")
    index, empty = payload(spark, good), payload(spark, "<p>x</p>", url="https://a.it/d")
    assert markup.follow_details(index, links, empty).select("url").collect() == [("https://a.it/ev",)]


def test_chat_posts_and_mail(spark):
    updates = json.dumps([{"channel_post": {"message_id": 5, "text": "Sagra", "chat": {"username": "ProLoco"}}}, {"message": {"message_id": 6, "caption": "no", "chat": {"username": "altri"}}}])
    assert [(r.url, r.text) for r in feeds.parse_chat_updates(payload(spark, updates), F.lit("@proloco")).collect()] == [("https://t.me/ProLoco/5", "Sagra")]
    posts = json.dumps([{"href": "https://www.facebook.com/ProLocoX?a=1", "permalink": "/x/posts/9", "testo": "Facebook\nFesta", "immagineUrls": ["a"]}, {"href": "https://www.facebook.com/ProLocoX?a=2", "permalink": "/x/posts/9", "testo": "Festa", "immagineUrls": ["a", "b"]}])
    row = feeds.parse_posts(payload(spark, posts, piattaforma="facebook")).first()
    assert (row.post_id, row.handle, row.text, row.image_urls) == ("9", "prolocox", "Festa", ["a", "b"])
    mail = b"Subject: Sagra\r\nFrom: Pro Loco <info@proloco.it>\r\nContent-Type: text/html; charset=utf-8\r\n\r\n<p>Domani in piazza</p>"
    mails = spark.createDataFrame([("s", "u", bytearray(mail))], "source_id string, url string, content binary")
    assert [r.text for r in markup.parse_mail(mails, "ProLoco.it").collect()] == ["Sagra\nDomani in piazza"] and markup.parse_mail(mails, "altri").count() == 0


def test_csv(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text("﻿Comune;Facebook\n Asti ;https://facebook.com/asti\n", encoding="utf-8")
    assert feeds.read_csv(spark, str(path), ["Comune", "Facebook", "Instagram"]).collect() == [("Asti", "https://facebook.com/asti", None)]
