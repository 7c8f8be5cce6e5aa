"""Parsers of HTML pages and mail that need a tree: small Arrow UDFs emit raw fields, columns decide."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructType

from fairground.functions import dates, filters, urls
from fairground.functions.text import strip
from fairground.sources.feeds import artifacts

_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_SKIP = frozenset("script style nav footer header aside form noscript template svg button select".split())
_BLOCKS = frozenset("p div br li ul ol h1 h2 h3 h4 h5 h6 tr td th table article section main blockquote dt dd figure".split())
_CLASSES = ("card-title", "cmp-list-card-img__body-title", "data", "card-day", "card-date", "card-text", "text-paragraph-card", "cmp-list-card-img__body-description")


class _MainText(HTMLParser):
    """Readable text of a page without navigation and the like."""

    def __init__(self):
        super().__init__()
        self.out: list[str] = []
        self.skip = 0

    def handle_starttag(self, tag, attrs):
        self.skip += tag in _SKIP
        if tag in _BLOCKS:
            self.out.append("\n")

    def handle_endtag(self, tag):
        self.skip = max(0, self.skip - (tag in _SKIP))
        if tag in _BLOCKS:
            self.out.append("\n")

    def handle_data(self, data):
        if not self.skip:
            self.out.append(data)

    def text(self) -> str:
        lines = (" ".join(x.split()) for x in "".join(self.out).split("\n"))
        return "\n".join(x for x in lines if x)


@F.pandas_udf(StringType())
def main_text(html: pd.Series) -> pd.Series:
    def one(page):
        if page is None:
            return None
        parser = _MainText()
        parser.feed(page)
        return parser.text() or None

    return html.map(one)


class _Cards(HTMLParser):
    """Texts by class of every ``card-wrapper``, and the link of its title: one in it, else one around it."""

    def __init__(self):
        super().__init__()
        self.stack: list[tuple[str, frozenset, str | None]] = []
        self.open: list[tuple[int, dict]] = []
        self.cards: list[dict] = []

    def handle_starttag(self, tag, attrs):
        if tag in _VOID:
            return
        attributes = dict(attrs)
        classes = frozenset((attributes.get("class") or "").split())
        href = attributes.get("href") if tag == "a" else None
        if "card-wrapper" in classes:
            card = {c: [] for c in (*_CLASSES, "h3")} | {"around": next((h for _, _, h in reversed(self.stack) if h), None), "inside": None}
            self.open.append((len(self.stack), card))
            self.cards.append(card)
        self.stack.append((tag, classes, href))
        for at, card in self.open:
            for name in (*(classes & set(_CLASSES)), *(["h3"] if tag == "h3" else [])):
                card[name].append("")
            titles = [i for i in range(at, len(self.stack)) if self.stack[i][1] & {"card-title", "cmp-list-card-img__body-title"} or self.stack[i][0] == "h3"]
            if href and card["inside"] is None and titles:
                card["inside"] = href
            if titles and titles[-1] == len(self.stack) - 1 and card["around"] is None:
                card["around"] = next((h for _, _, h in reversed(self.stack[at:-1]) if h), None)

    def handle_endtag(self, tag):
        places = [i for i, (t, _, _) in enumerate(self.stack) if t == tag]
        if places:
            del self.stack[places[-1] :]
            self.open = [(at, c) for at, c in self.open if at < len(self.stack)]

    def handle_data(self, data):
        for at, card in self.open:
            for name in (*_CLASSES, "h3"):
                if card[name] and any(name in classes or (name == "h3" and t == "h3") for t, classes, _ in self.stack[at:]):
                    card[name][-1] += data


_CARD = StructType()
for _name in ("title", "data", "card_day", "card_days", "card_date", "card_text", "description", "link"):
    _CARD.add(_name, StringType())


@F.pandas_udf(ArrayType(_CARD))
def card_fields(html: pd.Series) -> pd.Series:
    def one(page):
        parser = _Cards()
        parser.feed(page or "")
        first = lambda *xs: next((x[0].strip() for x in xs if x), None)
        return [
            {
                "title": first(c["card-title"], c["cmp-list-card-img__body-title"], c["h3"]),
                "data": first(c["data"]), "card_day": first(c["card-day"]), "card_days": " ".join(x.strip() for x in c["card-day"]), "card_date": first(c["card-date"]),
                "card_text": first(c["card-text"]), "description": first(c["text-paragraph-card"], c["cmp-list-card-img__body-description"]), "link": c["inside"] or c["around"],
            }
            for c in parser.cards
        ]

    return html.map(one)


def parse_cards(payloads: DataFrame, as_of: Column) -> DataFrame:
    """Events on design-system cards, dated by the first of six fields that hold a date.

    Where two cards or more of a page all show the day of ``as_of``, those days are publication dates, and the form
    without a year is not read on that page.
    """
    pages = payloads.select("source_id", "url", card_fields("payload").alias("cards"))
    shown = F.filter(F.transform("cards", lambda c: F.when(c["card_date"].rlike(r"^\d+$") & dates.month_number(c["card_day"]).isNotNull(), F.struct(c["card_date"].cast("int").alias("d"), dates.month_number(c["card_day"]).alias("m")))), lambda x: x.isNotNull())
    stamped = (F.size(shown) >= 2) & (F.size(F.array_distinct(shown)) == 1) & (F.try_element_at(shown, F.lit(1))["d"] == F.dayofmonth(as_of)) & (F.try_element_at(shown, F.lit(1))["m"] == F.month(as_of))
    rows = pages.withColumn("stamped", F.coalesce(stamped, F.lit(False))).select("source_id", "url", "stamped", F.explode("cards").alias("c")).where("coalesce(c.title, '') <> ''")
    c = lambda name: F.coalesce(F.col(f"c.{name}"), F.lit(""))
    bare = F.when(~F.col("stamped"), dates.day_month(F.concat_ws(" ", "c.card_date", "c.card_day"), as_of, dates.year_in(F.col("c.title"))))
    span = F.coalesce(dates.numeric_range(c("data")), dates.long_month_range(c("data")), dates.short_month_range(c("data")), dates.long_month_range(c("card_days")), dates.long_month_range(c("card_text")), bare)
    rows = rows.withColumn("span", span).where("span is not null")
    rows = rows.withColumns({"titolo": F.col("c.title"), "descrizione": F.col("c.description"), "data_inizio": F.col("span.start"), "data_fine": F.col("span.end")})
    link = F.when(F.col("c.link").isNotNull(), urls.absolute(F.col("c.link"), F.col("url"))).otherwise(F.col("url"))
    return artifacts(rows, "html", url=link, text=strip(F.concat_ws("\n", "titolo", F.coalesce("descrizione", F.lit("")))), raw_hash=F.sha1(F.concat_ws("|", "titolo", "data_inizio")))


def og_image(html: Column, url: Column) -> Column:
    content = F.coalesce(*(F.nullif(F.regexp_extract(html, p, 1), F.lit("")) for p in (r"""(?i)<meta[^>]+property=["']og:image["'][^>]+content=["']([^"']+)""", r"""(?i)<meta[^>]+content=["']([^"']+)["'][^>]+property=["']og:image["']""")))
    return F.when(content.isNotNull(), urls.absolute(content, url))


def parse_pages(payloads: DataFrame) -> DataFrame:
    """Pages whose main text shows at least two of three kinds of date."""
    rows = payloads.withColumn("text", main_text("payload")).where("text is not null").where(filters.date_kinds(F.col("text")) >= 2)
    picture = og_image(F.col("payload"), F.col("url"))
    return artifacts(rows, "html", image_urls=F.when(picture.isNotNull(), F.array(picture)).otherwise(F.array().cast("array<string>")), raw_hash=F.sha1("text"))


def follow_details(indexes: DataFrame, links: DataFrame, details: DataFrame) -> DataFrame:
    """Artifacts of the detail pages that ``links(source_id, url)`` name; a source none of whose details gave any falls
    back to its index page."""
    found = parse_pages(details.join(links.select("source_id", "url").distinct(), ["source_id", "url"], "left_semi"))
    rest = indexes.join(found.select("source_id").distinct(), "source_id", "left_anti")
    return found.unionByName(parse_pages(rest))


_MAIL = "subject string, sender string, body string, images int"


def parse_mail(mails: DataFrame, sender: str = "") -> DataFrame:
    """Messages (``source_id, url, content`` binary) of senders that contain ``sender``: plain text, else the first HTML part."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import email
        from email import policy

        for pdf in batches:
            out = []
            for row in pdf.itertuples(index=False):
                m = email.message_from_bytes(row.content, policy=policy.default)
                parts = [p for p in m.walk() if not p.is_multipart() and p.get_content_disposition() != "attachment"]
                body = next((p.get_content() for p in parts if p.get_content_type() == "text/plain"), None)
                if body is None:
                    page = next((p.get_content() for p in parts if p.get_content_type() == "text/html"), "")
                    parser = _MainText()
                    parser.feed(page)
                    body = parser.text()
                out.append((row.source_id, row.url, str(m.get("subject", "")), str(m.get("from", "")), body.strip(), sum(p.get_content_maintype() == "image" for p in m.walk())))
            yield pd.DataFrame(out, columns=["source_id", "url", "subject", "sender", "body", "images"])

    rows = mails.select("source_id", "url", "content").mapInPandas(read, f"source_id string, url string, {_MAIL}")
    rows = rows.where(F.contains(F.lower("sender"), F.lit(sender.lower()))).withColumn("text", strip(F.concat_ws("\n", "subject", "body"))).where("text <> ''")
    return artifacts(rows, "email", raw_hash=F.sha1("text"))
