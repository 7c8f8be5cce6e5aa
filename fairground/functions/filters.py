"""Predicates and classifiers over text and markup, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fairground.functions.dates import MONTHS
from fairground.functions.text import strip

#: The patterns of the text pre-filter, in the order they are tried.
_M = "|".join(MONTHS)
WEEKDAY = r"luned[iì]|marted[iì]|mercoled[iì]|gioved[iì]|venerd[iì]|sabato|domenica"
NUMERIC_DATE = r"\b\d{1,2}[/\-.]\d{1,2}(?:[/\-.]\d{2,4})?\b"
RELATIVE = r"oggi|domani|dopodomani|stasera|stanotte|questo\s+weekend|prossim[oa]\s+\w+|weekend"
EVENT_WORDS = "sagra|festa|fiera|mercatino|concerto|spettacolo|degustazione|rassegna|mostra|cena|serata|proiezione|festival|manifestazione|appuntamento|cartellone|inaugurazione"
NOT_EVENT = r"auguri|buon\s+natale|buona\s+pasqua|condoglianze|necrologio|lutto|viabilità|ordinanza|comunicato\s+stampa|si\s+ringrazia|ringraziamo|ringraziament[oi]"
YEAR = r"\b(20\d{2})\b"
SHORTEST = 40
#: What pages say where content is gone.
UNAVAILABLE = (
    "questo contenuto non è al momento disponibile", "questo contenuto non è disponibile", "this content isn't available", "content isn't available right now",
    "la pagina che hai richiesto non è disponibile", "sorry, this page isn't available", "the link you followed may be broken", "sorry, this content isn't available right now",
)


#: Warnings and how long they stop a platform.
BLOCK_HOURS = {"captcha": 72, "checkpoint": 72, "riprova più tardi": 168, "azione bloccata": 168, "conferma la tua identità": 24 * 365}


def _any(c: Column, words: str) -> Column:
    return c.rlike(rf"(?iuU)\b({words})\b")


def has_date(c: Column) -> Column:
    """Any kind of date, by one pattern."""
    return c.rlike(rf"(?iuU)(?:{NUMERIC_DATE}|\b(?:{_M}|{WEEKDAY}|{RELATIVE})\b|{YEAR})")


def date_kinds(c: Column) -> Column:
    """How many of three kinds of date a text has: numeric, day and month, weekday."""
    kinds = (c.rlike(f"(?U){NUMERIC_DATE}"), c.rlike(rf"(?iuU)\b\d{{1,2}}\s+({_M})\b"), _any(c, WEEKDAY))
    return sum((k.cast("int") for k in kinds), F.lit(0))


def text_reason(text: Column, has_image: Column, as_of: Column) -> Column:
    """Why a text is dropped before extraction, or null to keep it."""
    c = strip(F.coalesce(text, F.lit("")))

    def reason(p: Column) -> Column:
        past = F.exists(F.regexp_extract_all(p["c"], F.lit(f"(?U){YEAR}"), 1), lambda y: y.cast("int") < F.year(as_of) - 1)
        return (
            F.when(_any(p["c"], NOT_EVENT), "schema_non_evento")
            .when(~p["dated"] & ~has_image & ~_any(p["c"], EVENT_WORDS), "nessun_segnale_di_evento")
            .when(p["dated"] & past, "solo_date_passate")
            .when((F.length(p["c"]) < SHORTEST) & ~has_image, "testo_troppo_corto_senza_immagine")
        )

    # Text and date are made once and put into an array of one, or each mention would search the text again.
    return F.transform(F.array(F.struct(c.alias("c"), has_date(c).alias("dated"))), reason)[0]


def image_reason(width: Column, height: Column, known: Column, edges: Column) -> Column:
    """Why an image is dropped, or null: too small, odd shape, seen before, hardly any edges. Unreadable images stay."""
    ratio = width / height
    return F.when(width.isNull() | height.isNull(), None).when(F.least(width, height) < 400, "dimensioni_troppo_piccole").when((ratio < 0.4) | (ratio > 2.5), "aspect_ratio_implausibile").when(known, "duplicato_di_immagine_nota").when(edges < 0.02, "densita_bordi_bassa")


def unavailable(text: Column) -> Column:
    """The sentence by which a page says its content is gone, or null."""
    low, out = F.lower(F.coalesce(text, F.lit(""))), F.lit(None).cast("string")
    for said in reversed(UNAVAILABLE):
        out = F.when(low.contains(said), said).otherwise(out)
    return out


def block_hours(text: Column) -> Column:
    """Hours to pause after a warning that a page shows; a year where a person must decide, null if it shows none."""
    low, out = F.lower(F.coalesce(text, F.lit(""))), F.lit(None).cast("int")
    for said, hours in reversed(BLOCK_HOURS.items()):
        out = F.when(low.contains(said), hours).otherwise(out)
    return out


#: What the markup of each platform holds, and patterns of structured data and of cards.
WORDPRESS, DRUPAL, DESIGN_SYSTEM = "wp-content", r"""(?i)<meta[^>]+name=["']generator["'][^>]+content=["']Drupal""", ("bootstrap-italia", "agid")
LD_JSON = r"""(?is)<script[^>]+type=["']application/ld\+json["'][^>]*>.*?</script>"""
CARDS = r"""(?i)class=["'](?:[^"']*\s)?card-wrapper(?:\s[^"']*)?["']"""


def cms(html: Column) -> Column:
    """The platform that a page's markup shows; the first signature wins."""
    library, agency = DESIGN_SYSTEM
    return (
        F.when(html.contains(WORDPRESS), "wordpress")
        .when(html.rlike(DRUPAL), "drupal")
        .when(html.contains(library) & F.lower(html).contains(agency), "pa_design_system")
        .otherwise("sconosciuta")
    )


def has_ld_json(html: Column) -> Column:
    return html.rlike(LD_JSON)


def has_cards(html: Column) -> Column:
    return html.rlike(CARDS)
