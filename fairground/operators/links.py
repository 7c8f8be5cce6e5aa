"""Links of landed pages: which of them lead to details, where a site keeps its events, what platform it runs on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fairground.functions import filters, urls

#: Paths of details, and how many the regional portal gives.
DETAIL_PATH, REGIONAL_PATH, REGIONAL_LINKS = "^/event/[^/]+", "^/it/eventi/[^/]+", 20
#: Limits of the dominant-prefix search and texts of links to an events page.
MOST_LINKS, DOMINANT, GENERIC, NUMERIC = 15, 5, 0.85, 0.5
EVENTS_LINK = r"(?i)^(?:(?:eventi|manifestazioni|agenda|calendario|cartellone|spettacoli|events|what'?s on)|(?:tutti\s+)?(?:gli|i|le|la|lo|il)\s+(?:eventi|manifestazioni|agenda|calendario|cartellone|spettacoli|events))$"
ANCHOR = r"""(?is)<a\s[^>]*?href=["']([^"']*)["']"""
SITEMAP = r"(?i)<loc>([^<]*(?:/eventi/|/manifestazion|/spettacol|/cartellone|/agenda)[^<]*)</loc>"


def page_links(pages: DataFrame) -> DataFrame:
    """``page_url, pos, link, path, query`` of a page's anchors: same host, no fragment, not itself, the root, a feed or an
    interface; links without a query whose last segment is a date are left out."""
    rows = pages.select(F.col("url").alias("page_url"), F.posexplode(F.regexp_extract_all("html", F.lit(ANCHOR), 1)).alias("pos", "href"))
    host = lambda c: F.regexp_extract(c, r"^[a-zA-Z]+://([^/?#]+)", 1)
    path = lambda c: F.regexp_extract(c, r"^[a-zA-Z]+://[^/?#]+([^?#]*)", 1)
    # The link is resolved once and then taken apart: exploding it keeps the expression from being repeated in each part.
    parts = F.transform(F.array(urls.absolute(F.trim("href"), F.col("page_url"))), lambda c: F.struct(c.alias("link"), host(c).alias("host"), path(c).alias("path"), F.regexp_extract(c, r"\?([^#]*)", 1).alias("query"), F.regexp_extract(c, "#(.*)$", 1).alias("frag")))
    rows = rows.select("page_url", "pos", F.explode(parts).alias("p")).select("page_url", "pos", "p.*")
    keep = (F.col("host") == host(F.col("page_url"))) & (F.col("frag") == "") & ~F.col("path").isin("/", "") & (F.col("path") != path(F.col("page_url"))) & ~F.contains(F.col("path"), F.lit("/feed")) & ~F.startswith(F.col("path"), F.lit("/wp-json"))
    last = F.regexp_extract("path", r"([^/]*)/*$", 1)
    return rows.where(keep & ((F.col("query") != "") | ~last.rlike(urls.DATE_SLUG))).select("page_url", "pos", "link", "path", "query")


def _dominant(groups: DataFrame, links_per_page: DataFrame | None) -> DataFrame:
    """``page_url, level, prefix`` of the group that dominates each page at each level.

    ``groups``: ``page_url, level, prefix, link, path, pos``. The page's own prefix wins with any link; else the group
    with most distinct links, the first on a tie. Groups of numbers, small groups, and groups that hold nearly all links
    and split further down, do not count.
    """
    number = F.regexp_extract("path", r"([^/]*)/*$", 1).rlike(r"^\d+$").cast("int")
    stats = groups.groupBy("page_url", "level", "prefix").agg(F.countDistinct("link").alias("n"), F.avg(number).alias("numeric"), F.min("pos").alias("first"))
    depth = F.size(F.split("prefix", "/"))
    segments = F.split(F.regexp_replace("path", r"^/+|/+$", ""), "/")
    below = groups.where(F.size(segments) > depth).groupBy("page_url", "level", "prefix", F.array_join(F.slice(segments, 1, depth + 1), "/").alias("sub")).agg(F.count("*").alias("m"))
    deeper = below.where("m > 1").groupBy("page_url", "level", "prefix").agg(F.count("*").alias("splits"))
    rows = stats.join(deeper, ["page_url", "level", "prefix"], "left")
    own_path = F.regexp_replace(F.regexp_extract("page_url", r"^[a-zA-Z]+://[^/?#]+([^?#]*)", 1), r"^/+|/+$", "")
    own = (own_path == F.col("prefix")) | F.startswith(own_path, F.concat("prefix", F.lit("/")))
    if links_per_page is not None:
        rows = rows.join(links_per_page, "page_url").withColumn("generic", (F.col("n") / F.col("total") >= GENERIC) & (F.coalesce("splits", F.lit(0)) >= 2))
    else:
        rows, own = rows.withColumn("generic", F.lit(False)), F.lit(False)
    rows = rows.where(F.col("numeric") < NUMERIC).withColumn("own", own).where(F.col("own") | ((F.col("n") >= DOMINANT) & ~F.col("generic")))
    best = Window.partitionBy("page_url", "level").orderBy(F.desc("own"), F.when(F.col("own"), F.lit(0)).otherwise(-F.col("n")), "first", "prefix")
    return rows.withColumn("_r", F.row_number().over(best)).where("_r = 1").select("page_url", "level", "prefix")


def detail_links(pages: DataFrame) -> DataFrame:
    """``page_url, rank, link``: up to 15 links of each page that lead to details.

    Levels are tried in turn: the first, second and third segments of the path, then a query parameter. The first level
    is passed over where all paths open with a language. Query links follow their number downwards, others the alphabet.
    """
    links = page_links(pages)
    plain, asked = links.where("query = ''"), links.where("query <> ''")
    segments = F.split(F.regexp_replace("path", r"^/+|/+$", ""), "/")
    levels = F.filter(F.array(F.lit(1), F.lit(2), F.lit(3)), lambda n: n <= F.size(segments))
    groups = plain.where(segments[0] != "").select("*", F.explode(levels).alias("level")).withColumn("prefix", F.array_join(F.slice(segments, 1, F.col("level")), "/"))
    pages_of = plain.groupBy("page_url").agg(F.count("*").alias("total"), F.every(urls.language_segment(segments[0])).alias("languages"))
    by_path = _dominant(groups, pages_of.select("page_url", "total")).join(pages_of.select("page_url", "languages"), "page_url").where("level > 1 or not languages").select("page_url", "level", "prefix")
    keyed = asked.where(F.col("query").rlike("^[^&=]*=[^&]*$")).withColumns({"level": F.lit(4), "prefix": F.concat("path", F.lit("?"), F.split("query", "=")[0])})
    by_query = _dominant(keyed, None)
    chosen = by_path.unionByName(by_query).groupBy("page_url").agg(F.min_by(F.struct("level", "prefix"), "level").alias("c")).select("page_url", "c.level", "c.prefix")
    met = groups.select("page_url", "level", "prefix", "link").unionByName(keyed.select("page_url", "level", "prefix", "link")).join(chosen, ["page_url", "level", "prefix"]).distinct()
    number = F.when(F.col("level") == 4, F.expr("try_cast(regexp_extract(link, '=([0-9]+)$', 1) as decimal(38,0))"))
    order = Window.partitionBy("page_url").orderBy(F.when(F.col("level") == 4, number.isNull()), number.desc_nulls_last(), "link")
    return met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= MOST_LINKS).select("page_url", "rank", "link")


def event_links(pages: DataFrame, most: int = MOST_LINKS, under: str = DETAIL_PATH) -> DataFrame:
    """``page_url, rank, link``: links whose path matches, in order of the alphabet; ``DETAIL_PATH`` has ``event`` as its
    first segment and goes on, ``REGIONAL_PATH`` lies in the regional portal's list (take ``REGIONAL_LINKS`` of those)."""
    rows = page_links(pages).where(F.col("path").rlike(under)).select("page_url", "link").distinct()
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy("page_url").orderBy("link"))).where(F.col("rank") <= most).select("page_url", "rank", "link")


def crawl(index: DataFrame, links: DataFrame, details: DataFrame) -> DataFrame:
    """Events stated in JSON-LD on the detail pages that index pages link to; an index whose details state none is read itself.

    ``index(source_id, url, html)``, ``links`` from ``event_links``, ``details(url, html)`` as landed: a page that could
    not be read is missing and costs nothing else.
    """
    from fairground.sources.feeds import parse_jsonld

    pages = index.select("source_id", "url").join(links.select(F.col("page_url").alias("url"), "link"), "url").select(F.concat_ws("\u0001", "source_id", "url").alias("source_id"), F.col("link").alias("url")).join(details, "url")
    tagged = parse_jsonld(pages.select("source_id", "url", F.col("html").alias("payload")))
    whose = F.split("source_id", "\u0001")
    found = tagged.withColumn("source_id", whose[0])
    told = tagged.select(whose[1].alias("url"), whose[0].alias("source_id")).distinct()
    rest = index.join(told, ["url", "source_id"], "left_anti")
    return found.unionByName(parse_jsonld(rest.select("source_id", "url", F.col("html").alias("payload"))))


#: Links with their text, and what pages offer to machines.
LINK_TEXT = r"""(?i)<a[^>]+href=["']([^"']+)["'][^>]*>([^<]*)</a>"""
CALENDAR = r"""(?i)<link[^>]+type=["']text/calendar["'][^>]+href=["']([^"']+)["']"""
FEED = r"""(?i)<link[^>]+rel=["']alternate["'][^>]+type=["']application/(?:rss|atom)\+xml["'][^>]+href=["']([^"']+)["']"""
LD_EVENT = r"""(?is)<script[^>]+type=["']application/ld\+json["'][^>]*>(?:(?!</script>).)*"@type"\s*:\s*"Event\""""


def events_page(html: Column, base: Column) -> Column:
    """The first link whose whole text names an events page."""
    pattern = LINK_TEXT
    pairs = F.arrays_zip(F.regexp_extract_all(html, F.lit(pattern), 1).alias("h"), F.regexp_extract_all(html, F.lit(pattern), 2).alias("t"))
    hit = F.filter(pairs, lambda p: F.trim(p["t"]).rlike(EVENTS_LINK))
    return urls.absolute(F.try_element_at(hit, F.lit(1))["h"], base)


def structured_endpoint(html: Column, base: Column) -> Column:
    """``url, kind`` of what a page offers to machines: a calendar, else a feed of its own, else events in JSON-LD."""
    calendar, feed = (F.nullif(F.regexp_extract(html, p, 1), F.lit("")) for p in (CALENDAR, FEED))
    feed = F.when(~urls.generic_feed(urls.absolute(feed, base)), urls.absolute(feed, base))
    events = html.rlike(LD_EVENT)
    made = lambda u, k: F.struct(u.alias("url"), F.lit(k).alias("kind"))
    return F.when(calendar.isNotNull(), made(urls.absolute(calendar, base), "ical")).when(feed.isNotNull(), made(feed, "rss")).when(events, made(base, "jsonld"))


def probe(homes: DataFrame, landed: DataFrame, sitemaps: DataFrame) -> DataFrame:
    """Where each site keeps its events: a link of the home page, else the sitemap, else the home page itself; and what
    that page offers. ``homes(url, html)``, ``landed(url, html)``, ``sitemaps(url, text)`` by the site's root."""
    root = lambda c: F.regexp_extract(c, "^(https?://[^/]+)", 1)
    rows = homes.select("url", "html", events_page(F.col("html"), F.col("url")).alias("_link"), root(F.col("url")).alias("_root"))
    maps = sitemaps.select(root(F.col("url")).alias("_root"), F.nullif(F.regexp_extract("text", SITEMAP, 1), F.lit("")).alias("_map")).groupBy("_root").agg(F.min("_map").alias("_map"))
    rows = rows.join(maps, "_root", "left").withColumn("pagina_calendario", F.coalesce("_link", "_map", "url"))
    rows = rows.withColumn("fonte_scoperta", F.when(F.col("_link").isNotNull(), "homepage").when(F.col("_map").isNotNull(), "sitemap").otherwise("nessuna"))
    pages = landed.select(F.col("url").alias("pagina_calendario"), F.col("html").alias("_html"))
    rows = rows.join(pages, "pagina_calendario", "left")
    end = F.when(F.col("_html").isNotNull(), structured_endpoint(F.col("_html"), F.col("pagina_calendario"))).otherwise(structured_endpoint(F.col("html"), F.col("url")))
    unread = (F.col("fonte_scoperta") != "nessuna") & F.col("_html").isNull()
    return rows.withColumn("_e", end).select("url", "pagina_calendario", "fonte_scoperta", F.col("_e.url").alias("endpoint_strutturato"), F.col("_e.kind").alias("tipo_endpoint"), F.when(unread, F.array(F.lit("pagina del calendario non raggiungibile"))).otherwise(F.array().cast("array<string>")).alias("note"))


def fingerprints(pages: DataFrame) -> DataFrame:
    """Platform and markup of landed pages; an unread page (null) keeps its error and has no platform."""
    return pages.withColumns({"piattaforma": F.when(F.col("html").isNotNull(), filters.cms(F.col("html"))), "ha_jsonld": F.coalesce(filters.has_ld_json(F.col("html")), F.lit(False)), "ha_cards": F.coalesce(filters.has_cards(F.col("html")), F.lit(False))})


def shares(rows: DataFrame, by: str) -> DataFrame:
    """Counts by a column with their share of all, most first."""
    counts = rows.groupBy(by).agg(F.count("*").alias("n"))
    return counts.withColumn("quota", F.col("n") / F.sum("n").over(Window.partitionBy(F.lit(1)))).orderBy(F.desc("n"), by)
