"""Registered queries over landed payloads: calendars, feeds, structured data, cards and links made from the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from fairground.functions import urls
from fairground.operators import lifecycle, places
from fairground.queries import comuni, day, query, t
from fairground.sources import feeds, markup


def landed(rows, payload):
    return rows.select(F.col("source_id").cast("string").alias("source_id"), F.concat(F.lit("https://land.example/"), F.col("source_id").cast("string")).alias("url"), payload.alias("payload"))


def orders(spark, d):
    return t(spark, d, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderkey").alias("source_id"), F.col("o_orderdate").cast("date").alias("g"), "o_orderpriority")


def when(test: str, yes, no=""):
    lit = lambda x: x if hasattr(x, "alias") else F.lit(x)
    return F.when(F.expr(test), lit(yes)).otherwise(lit(no))


@query("""SELECT CAST(o_orderkey AS VARCHAR) AS source_id, CASE WHEN o_orderkey % 2 = 0 THEN 'https://ev.example/' ELSE 'https://land.example/' END || o_orderkey AS url, 'Fiera ' || o_orderpriority || ', numero ' || o_orderkey || ' in piazza' AS titolo,
strftime(o_orderdate, '%Y-%m-%d') AS data_inizio, strftime(o_orderdate + to_days(CASE WHEN o_orderkey % 3 = 0 THEN 2 ELSE 0 END), '%Y-%m-%d') AS data_fine, CASE WHEN o_orderkey % 5 <> 0 THEN '20:30' END AS ora_inizio FROM orders WHERE o_orderkey % 7 <> 0""")
def ical_parse(spark, d):
    """One calendar an order: folded lines, escapes, whole days, ends that are missing, events without a title."""
    k, stamp = F.col("k").cast("string"), lambda c: F.date_format(c, "yyyyMMdd")
    lines = F.concat(
        F.lit("BEGIN:VCALENDAR\r\nBEGIN:VEVENT\r\n"), when("k % 7 <> 0", F.concat(F.lit("SUMMARY:Fiera "), "o_orderpriority", F.lit("\\, numero "), k, F.lit(" in\r\n  piazza\r\n"))),
        when("k % 5 = 0", F.concat(F.lit("DTSTART;VALUE=DATE:"), stamp(F.col("g"))), F.concat(F.lit("DTSTART;TZID=Europe/Rome:"), stamp(F.col("g")), F.lit("T203000"))), F.lit("\r\n"),
        when("k % 3 = 0", F.concat(F.lit("DTEND:"), stamp(F.date_add("g", 2)), F.lit("\r\n"))), when("k % 2 = 0", F.concat(F.lit("URL:https://ev.example/"), k, F.lit("\r\n"))), F.lit("END:VEVENT\r\nEND:VCALENDAR\r\n"),
    )
    return feeds.parse_ical(landed(orders(spark, d), lines)).select("source_id", "url", "titolo", "data_inizio", "data_fine", "ora_inizio")


@query("""SELECT CAST(o_orderkey AS VARCHAR) AS source_id, 'https://ev.example/' || o_orderkey AS url, 'Festa & ' || o_orderpriority || chr(10) || 'In piazza ' || o_orderkey AS text, CASE WHEN o_orderkey % 4 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS context_date FROM orders""")
def rss_parse(spark, d):
    """One feed an order, RSS or Atom, with entities and CDATA; some items have no date."""
    k = F.col("k").cast("string")
    title = F.concat(F.lit("<title>Festa &amp; "), "o_orderpriority", F.lit("</title>"))
    rss = F.concat(F.lit("<rss><channel><item>"), title, F.lit("<link>https://ev.example/"), k, F.lit("</link><description><![CDATA[In piazza "), k, F.lit("]]></description>"), when("k % 4 <> 0", F.concat(F.lit("<pubDate>"), F.date_format("g", "EEE, dd MMM yyyy"), F.lit(" 10:00:00 +0000</pubDate>"))), F.lit("</item></channel></rss>"))
    atom = F.concat(F.lit('<feed xmlns="http://www.w3.org/2005/Atom"><entry>'), title, F.lit('<link rel="alternate" href="https://ev.example/'), k, F.lit('"/><summary>In piazza '), k, F.lit("</summary>"), when("k % 4 <> 0", F.concat(F.lit("<published>"), F.col("g").cast("string"), F.lit("T10:00:00Z</published>"))), F.lit("</entry></feed>"))
    rows = feeds.parse_rss(landed(orders(spark, d), when("k % 3 = 0", atom, rss)))
    return rows.select("source_id", "url", "text", F.col("context_date").cast("string").alias("context_date"))


@query("""SELECT CAST(o_orderkey AS VARCHAR) AS source_id, 'https://land.example/' || o_orderkey AS url, 'Mostra & ' || o_orderpriority AS titolo, strftime(o_orderdate, '%Y-%m-%d') AS data_inizio, strftime(o_orderdate + to_days(CASE WHEN o_orderkey % 2 = 0 THEN 3 ELSE 0 END), '%Y-%m-%d') AS data_fine FROM orders WHERE o_orderkey % 11 <> 0""")
def jsonld_parse(spark, d):
    """One page an order with JSON-LD: an object, a list, a graph among other things, or what is no JSON."""
    event = F.concat(F.lit('{"@type": '), when("k % 5 = 0", '["Event", "Festival"]', '"Event"'), F.lit(', "name": "Mostra &amp; '), "o_orderpriority", F.lit('", "startDate": "'), F.col("g").cast("string"), F.lit('T21:00:00"'), when("k % 2 = 0", F.concat(F.lit(', "endDate": "'), F.date_add("g", 3).cast("string"), F.lit('"'))), F.lit("}"))
    body = when("k % 11 = 0", F.concat(F.lit("{broken "), event), when("k % 3 = 0", F.concat(F.lit('{"@graph": [{"@type": "Place", "name": "x"}, '), event, F.lit("]}")), when("k % 3 = 1", F.concat(F.lit("["), event, F.lit("]")), event)))
    page = F.concat(F.lit('<html><script type="application/ld+json">'), body, F.lit("</script></html>"))
    return feeds.parse_jsonld(landed(orders(spark, d), page)).select("source_id", "url", "titolo", "data_inizio", "data_fine")


@query("""SELECT CAST(o_orderkey AS VARCHAR) AS source_id, 'https://land.example/d/' || o_orderkey AS url, 'Fiera ' || o_orderpriority AS titolo, strftime(o_orderdate, '%Y-%m-%d') AS data_inizio, strftime(o_orderdate + to_days(CASE WHEN o_orderkey % 2 = 0 THEN 3 ELSE 0 END), '%Y-%m-%d') AS data_fine FROM orders WHERE o_orderkey % 9 <> 0""")
def cards_parse(spark, d):
    """One page an order with a card whose field holds a date or two; cards without a date give none."""
    it = lambda c: F.date_format(c, "dd/MM/yyyy")
    when_text = when("k % 9 = 0", "presto", when("k % 2 = 0", F.concat(it("g"), F.lit(" - "), it(F.date_add("g", 3))), it("g")))
    page = F.concat(F.lit('<div class="card-wrapper"><a href="/d/'), F.col("k").cast("string"), F.lit('"><h3 class="card-title">Fiera '), "o_orderpriority", F.lit('</h3></a><span class="data">'), when_text, F.lit("</span></div>"))
    return markup.parse_cards(landed(orders(spark, d), page), day()).select("source_id", "url", "titolo", "data_inizio", "data_fine")


@query("""SELECT s_suppkey, CASE s_suppkey % 8 WHEN 0 THEN 'gruppo_facebook' WHEN 1 THEN 'permalink_post_da_risolvere' WHEN 2 THEN 'id_numerico_da_risolvere' WHEN 3 THEN 'ok' WHEN 4 THEN 'ok' WHEN 5 THEN 'ok' ELSE 'scarto' END AS verdict,
CASE s_suppkey % 8 WHEN 3 THEN 'https://www.facebook.com/Pagina' || s_suppkey WHEN 4 THEN 'https://www.instagram.com/pagina_' || s_suppkey WHEN 5 THEN 'https://www.facebook.com/people/Pro-Loco/' || s_suppkey END AS url,
CASE s_suppkey % 8 WHEN 3 THEN 'Pagina' || s_suppkey WHEN 4 THEN 'pagina_' || s_suppkey WHEN 5 THEN 'Pro-Loco-' || s_suppkey END AS handle FROM supplier""")
def social_links(spark, d):
    """Links of profiles in many spellings: the verdict, and the clean address and name of those that are kept."""
    k = F.col("s_suppkey").cast("string")
    forms = [("https://www.facebook.com/groups/", ""), ("https://instagram.com/p/abc", ""), ("https://www.facebook.com/", "/"), ("http://m.facebook.com/Pagina", "/events?x=1"), (" https://instagram.com/pagina_", "/reels/"), ("https://it-it.facebook.com/people/Pro-Loco/", "//"), ("https://altro.example/", "")]
    link = F.lit(None).cast("string")
    for i, (before, after) in enumerate(forms):
        link = F.when(F.col("s_suppkey") % 8 == i, F.concat(F.lit(before), k, F.lit(after))).otherwise(link)
    rows = t(spark, d, "supplier").select("s_suppkey", link.alias("link")).withColumn("verdict", urls.social_verdict(F.col("link")))
    clean = urls.social_url(F.col("link"))
    kept = lambda c: F.when(F.col("verdict") == "ok", c)
    return rows.select("s_suppkey", "verdict", kept(clean).alias("url"), kept(urls.social_handle(clean)).alias("handle"))


@query("""$ , n AS (SELECT comune, replace(lower(comune), ' ', '') AS c FROM comuni WHERE attivo = 'si' AND length(replace(comune, ' ', '')) >= 6),
l AS (SELECT s_suppkey, CASE s_suppkey % 3 WHEN 0 THEN 'pro_' || replace(lower(n_name), ' ', '_') WHEN 1 THEN 'proloco' || replace(lower(n_name), ' ', '') ELSE 'teatro_bello' END AS handle, (s_nationkey + s_suppkey % 2) % 25 AS e FROM supplier JOIN nation ON s_nationkey = n_nationkey),
x AS (SELECT l.*, n_name AS atteso, replace(lower(n_name), ' ', '') AS w, replace(replace(handle, '_', ''), ' ', '') AS j, string_split(handle, '_') AS toks FROM l JOIN nation ON n_nationkey = e)
SELECT s_suppkey, min(n.comune) AS wrong_comune FROM x LEFT JOIN n ON NOT contains(j, w) AND c <> w AND NOT contains(w, c) AND (CASE WHEN contains(handle, '_') THEN len(list_filter(string_split(lower(n.comune), ' '), lambda q: NOT list_contains(toks, q))) = 0 ELSE false END OR starts_with(j, c) OR ends_with(j, c)) GROUP BY 1""")
def wrong_entity(spark, d):
    """Handles that spell out a municipality, the expected one or another."""
    n = t(spark, d, "nation")
    name = F.lower("n_name")
    handle = F.when(F.col("s_suppkey") % 3 == 0, F.concat(F.lit("pro_"), F.replace(name, F.lit(" "), F.lit("_")))).when(F.col("s_suppkey") % 3 == 1, F.concat(F.lit("proloco"), F.replace(name, F.lit(" "), F.lit("")))).otherwise("teatro_bello")
    own = t(spark, d, "supplier").join(n, F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", handle.alias("handle"), ((F.col("s_nationkey") + F.col("s_suppkey") % 2) % 25).alias("e"))
    rows = own.join(n.select(F.col("n_nationkey").alias("e"), F.col("n_name").alias("comune")), "e")
    return places.wrong_entity(rows, comuni(spark, d)).select("s_suppkey", "wrong_comune")


@query("""WITH q AS (SELECT s_suppkey AS k, 'h' || s_suppkey AS handle, CASE WHEN s_suppkey % 3 = 0 THEN 'seguito' ELSE 'da_seguire' END AS stato, CASE WHEN s_suppkey % 5 = 0 THEN 'instagram' ELSE 'facebook' END AS p FROM supplier),
f AS (SELECT 'h' || (s_suppkey * 2) AS handle, s_suppkey FROM supplier), b AS (SELECT p AS piattaforma, q.handle, CASE WHEN p = 'facebook' AND f.handle IS NOT NULL THEN 'seguito' ELSE stato END AS stato, '' AS comune FROM q LEFT JOIN f ON f.handle = q.handle)
SELECT piattaforma, handle, stato, comune FROM b UNION ALL SELECT 'facebook', handle, CASE WHEN s_suppkey % 4 = 0 AND (s_suppkey % 25) % 8 <> 7 THEN 'da_seguire' ELSE 'quarantena' END, CASE WHEN s_suppkey % 4 < 2 AND (s_suppkey % 25) % 8 <> 7 THEN n_name ELSE '' END FROM f JOIN nation ON n_nationkey = s_suppkey % 25
WHERE handle NOT IN (SELECT handle FROM q WHERE p = 'facebook')""")
def sync_followed(spark, d):
    """The queue after reading who is followed: known ones, unknown ones, and those whose profile names a place."""
    from fairground import schemas
    from fairground.plans.publish import migrate

    s, n = t(spark, d, "supplier"), t(spark, d, "nation")
    k = F.col("s_suppkey")
    queue = migrate(s.select(F.concat(F.lit("x"), k.cast("string")).alias("source_id"), F.when(k % 5 == 0, "instagram").otherwise("facebook").alias("piattaforma"), F.concat(F.lit("h"), k.cast("string")).alias("handle"), F.when(k % 3 == 0, "seguito").otherwise("da_seguire").alias("stato"), F.lit("").alias("comune")), schemas.QUEUE)
    handle = F.concat(F.lit("h"), (k * 2).cast("string"))
    seen = s.select(F.concat(F.lit(" @"), F.upper(handle)).alias("handle"))
    told = s.where(k % 4 < 2).join(n, F.col("n_nationkey") == k % 25).select(handle.alias("handle"), F.when(k % 4 == 0, "Pro Loco").otherwise("Teatro").alias("soggetto"), F.col("n_name").alias("comune"))
    after = lifecycle.sync_followed(queue, seen, told, places.place_keys(comuni(spark, d)), "facebook", "1998-06-15")
    return after.select("piattaforma", "handle", "stato", "comune")
