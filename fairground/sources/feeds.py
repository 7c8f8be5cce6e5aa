"""Parsers of calendar, feed, structured-data and chat payloads: landed text to artifact rows, all with built-in functions.

Every parser takes ``source_id, url, payload`` rows (one row a fetched resource) and returns rows of ``schemas.ARTIFACTS``.
A payload that cannot be read gives no rows; it never fails the job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fairground import schemas
from fairground.functions import dates
from fairground.functions.text import html_unescape, strip


def artifacts(df: DataFrame, kind: str, **columns: Column) -> DataFrame:
    """The artifact columns of ``df``: those given, those it has, and nulls for the rest."""
    wanted = T.StructType.fromDDL(schemas.ARTIFACTS)
    out = []
    for f in wanted:
        c = columns.get(f.name, F.lit(kind) if f.name == "kind" else F.col(f.name) if f.name in df.columns else F.lit(None))
        out.append(c.cast(f.dataType).alias(f.name))
    return df.select(*out)


def parse_ical(payloads: DataFrame) -> DataFrame:
    """Events of iCalendar text. Folded lines are joined; an event needs a start and a summary and ends when it starts
    unless it says so; a closing Z is dropped, not converted."""
    plain = F.regexp_replace(F.regexp_replace("payload", "\r\n", "\n"), "\n[ \t]", "")
    events = payloads.select("source_id", "url", F.explode(F.regexp_extract_all(plain, F.lit(r"(?s)BEGIN:VEVENT\s*?\n(.*?)END:VEVENT"), 1)).alias("event"))

    def field(name: str) -> Column:
        raw = F.regexp_extract("event", rf"(?m)^{name}(?:;[^:\n]*)?:(.*)$", 1)
        return F.nullif(F.trim(F.regexp_replace(F.regexp_replace(raw, r"\\[nN]", "\n"), r"\\([,;])", "$1")), F.lit(""))

    rows = events.select("source_id", F.coalesce(field("URL"), "url").alias("url"), field("SUMMARY").alias("titolo"), field("DTSTART").alias("a"), field("DTEND").alias("b"), field("LOCATION").alias("luogo_testuale"), field("DESCRIPTION").alias("descrizione"))
    rows = rows.where("a is not null and titolo is not null").withColumns({"data_inizio": dates.ical_date(F.col("a")), "ora_inizio": dates.ical_time(F.col("a"))})
    return artifacts(rows, "ical", data_fine=F.coalesce(dates.ical_date(F.col("b")), "data_inizio"), text=F.coalesce("descrizione", F.lit("")), raw_hash=F.sha1(F.concat_ws("|", "titolo", "data_inizio")))


_ITEM = "struct<title:string, link:string, description:string, pubDate:string>"


def parse_rss(payloads: DataFrame) -> DataFrame:
    """Items of RSS 2.0, or entries of Atom where a feed has no items."""

    def inner(block: str, name: str) -> Column:
        raw = F.regexp_extract(block, rf"(?is)<(?:\w+:)?{name}(?:\s[^>]*)?>\s*(?:<!\[CDATA\[)?(.*?)(?:\]\]>)?\s*</(?:\w+:)?{name}>", 1)
        return strip(html_unescape(raw))

    blocks = lambda name: F.regexp_extract_all("payload", F.lit(rf"(?is)<{name}(?:\s[^>]*)?>(.*?)</{name}>"), 1)
    both = payloads.select("source_id", "url", blocks("item").alias("items"), blocks("entry").alias("entries"))
    items = both.select("source_id", "url", F.explode("items").alias("b"))
    rss = items.select("source_id", "url", inner("b", "title").alias("t"), inner("b", "link").alias("l"), inner("b", "description").alias("d"), inner("b", "pubDate").alias("p"))
    rss = rss.withColumn("text", strip(F.concat_ws("\n", "t", "d"))).select("source_id", F.coalesce(F.nullif("l", F.lit("")), "url").alias("url"), "text", dates.mail_date(F.col("p")).alias("context_date"))
    entries = both.where(F.size("items") == 0).select("source_id", "url", F.explode("entries").alias("b"))
    link = F.nullif(F.regexp_extract("b", r"""(?is)<link[^>]*\shref=["']([^"']*)["']""", 1), F.lit(""))
    first = lambda *names: F.coalesce(*(F.nullif(F.col(n), F.lit("")) for n in names), F.lit(""))
    atom = entries.select("source_id", F.coalesce(link, "url").alias("url"), inner("b", "title").alias("t"), *(inner("b", n).alias(n) for n in ("summary", "content", "published", "updated")))
    atom = atom.select("source_id", "url", strip(F.concat_ws("\n", "t", first("summary", "content"))).alias("text"), F.nullif(F.left(first("published", "updated"), F.lit(10)), F.lit("")).alias("context_date"))
    out = rss.unionByName(atom)
    return artifacts(out, "rss", context_date=F.try_to_date("context_date", "yyyy-MM-dd"), raw_hash=F.sha1("text"))


_BLOCK = r"""(?is)<script[^>]+type=["']application/ld\+json["'][^>]*>(.*?)</script>"""


def parse_jsonld(payloads: DataFrame) -> DataFrame:
    """Events in JSON-LD blocks: a root object or list, or a graph in it; name and start are needed.

    The loosely typed blocks are read as variants; a block that is not JSON is passed over.
    """
    roots = payloads.select("source_id", "url", F.posexplode(F.regexp_extract_all("payload", F.lit(_BLOCK), 1)).alias("block", "raw"))
    roots = roots.select("source_id", "url", "block", F.try_parse_json(F.trim("raw")).alias("v")).where("v is not null")
    get = lambda c, path, kind="string": F.try_variant_get(c, path, kind)
    nodes = "array<variant>"
    listed = roots.select("source_id", "url", "block", F.posexplode(F.coalesce(get("v", "$", nodes), F.array("v"))).alias("root", "n"))
    is_event = lambda c: (get(c, "$['@type']") == "Event") | F.array_contains(F.coalesce(get(c, "$['@type']", "array<string>"), F.array().cast("array<string>")), "Event")
    deep = listed.withColumn("event", F.coalesce(is_event(F.col("n")), F.lit(False)))
    inner = deep.select("source_id", "url", "block", "root", F.posexplode(F.when(F.col("event"), F.array("n")).otherwise(F.coalesce(get("n", "$['@graph']", nodes), F.array().cast(nodes)))).alias("at", "e"))
    events = inner.where(F.coalesce(is_event(F.col("e")), F.lit(False)))
    address = F.coalesce(get("e", "$.location.address.addressLocality"), get("e", "$.location.address[0].addressLocality"))
    text_place = F.when(F.schema_of_variant(F.try_variant_get("e", "$.location", "variant")) == "STRING", get("e", "$.location"))
    rows = events.select("source_id", F.coalesce(get("e", "$.url"), "url").alias("url"), html_unescape(get("e", "$.name")).alias("titolo"), F.left(get("e", "$.startDate"), F.lit(10)).alias("data_inizio"), F.left(get("e", "$.endDate"), F.lit(10)).alias("b"), html_unescape(get("e", "$.description")).alias("descrizione"), html_unescape(F.coalesce(F.nullif(get("e", "$.location.name"), F.lit("")), address, text_place)).alias("luogo_testuale"))
    rows = rows.where("coalesce(titolo, '') <> '' and coalesce(data_inizio, '') <> ''").withColumn("text", strip(F.concat_ws("\n", "titolo", F.coalesce("descrizione", F.lit("")))))
    return artifacts(rows, "jsonld", data_fine=F.coalesce(F.nullif("b", F.lit("")), "data_inizio"), raw_hash=F.sha1("text"))


def parse_chat_updates(payloads: DataFrame, channel: Column) -> DataFrame:
    """Posts of one channel in a chat's update list; ``channel`` is its name or id, with or without @."""
    message = "struct<message_id:long, text:string, caption:string, chat:struct<username:string, id:string>>"
    rows = payloads.withColumn("_channel", channel).select("source_id", "url", "_channel", F.explode(F.from_json("payload", f"array<struct<channel_post:{message}, message:{message}>>")).alias("u"))
    rows = rows.select("source_id", "url", "_channel", F.coalesce("u.channel_post", "u.message").alias("m")).where("m is not null")
    name = F.coalesce("m.chat.username", "m.chat.id")
    rows = rows.where(F.lower(name) == F.lower(F.ltrim(F.col("_channel"), F.lit("@"))))
    rows = rows.withColumn("text", F.coalesce(F.nullif("m.text", F.lit("")), "m.caption")).where("coalesce(trim(text), '') <> ''")
    link = F.when(F.col("m.chat.username").isNotNull(), F.concat(F.lit("https://t.me/"), F.col("m.chat.username"), F.lit("/"), F.col("m.message_id").cast("string"))).otherwise(F.col("url"))
    return artifacts(rows, "telegram", url=link, raw_hash=F.sha1("text"))


def parse_posts(payloads: DataFrame) -> DataFrame:
    """Posts of a social feed's JSON, each once: the first is kept in reading order, with the pictures of all its copies."""
    from fairground.functions import urls
    from fairground.functions.text import clean_post

    post = "array<struct<href:string, permalink:string, testo:string, immagineUrls:array<string>, dataPubblicazione:string, tooltip:string>>"
    rows = payloads.select("source_id", "url", "piattaforma", F.posexplode(F.from_json("payload", post)).alias("seq", "p"))
    rows = rows.select("source_id", "piattaforma", "seq", urls.author_handle(F.col("p.href"), F.col("piattaforma")).alias("handle"), clean_post(F.col("p.testo")).alias("text"), F.col("p.permalink").alias("permalink"), F.coalesce("p.immagineUrls", F.array().cast("array<string>")).alias("pictures"), F.coalesce(dates.instant_date(F.col("p.dataPubblicazione")), dates.tooltip_date(F.col("p.tooltip"))).alias("data_post"), dates.tooltip_time(F.col("p.tooltip")).alias("ora_post"))
    rows = rows.withColumn("post_id", urls.post_id(F.col("permalink"), F.col("text")))
    first = lambda c: F.min_by(c, "seq").alias(c)
    return rows.groupBy("source_id", "piattaforma", "post_id").agg(F.min("seq").alias("seq"), *(first(c) for c in ("handle", "text", "permalink", "data_post", "ora_post")), F.array_distinct(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("seq", "pictures"))), lambda x: x["pictures"]))).alias("image_urls"))


def read_csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """A semicolon-separated list with a header and perhaps a byte-order mark; the named columns, absent ones as null."""
    raw = spark.read.option("sep", ";").option("header", True).option("enforceSchema", False).csv(path)
    named = raw.toDF(*(c.lstrip("﻿").strip() for c in raw.columns))
    return named.select(*((F.trim(F.col(f"`{c}`")) if c in named.columns else F.lit(None).cast("string")).alias(c) for c in columns))
