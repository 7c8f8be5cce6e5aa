"""Text functions as column expressions: folding, titles, similarity, identifiers, post cleaning."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Words that a title key leaves out, words too general to match alone, words a title keeps in lower case.
STOPWORDS = "la il lo di a da in con su per tra fra e ed festa sagra edizione annuale".split()
GENERIC_WORDS = "evento eventi iniziativa manifestazione appuntamento serata giornata incontro attivita".split()
INNER_LOWER = "di della dello delle dei degli e a in per del".split()
EDITION = r"(?iU)\b\d+[ªº°]|\bX{0,3}(IX|IV|V?I{0,3})\b"
TITLE_OVERLAP, SHARED_TOKENS, DESCRIPTION_OVERLAP = 0.8, 3, 0.7
NOISE_LINE = r"(?iu)^(Facebook|·|Segui|Altro\.{3}|\d+\s*(min|h|ago|gg)?)$"


def _fold_table() -> tuple[str, str]:
    """Letters of the Latin blocks with their first base character, where decomposition leaves just that."""
    pairs = []
    for code in [*range(0xA8, 0x250), *range(0x1E00, 0x1F00)]:
        base = "".join(c for c in unicodedata.normalize("NFKD", chr(code)) if not unicodedata.combining(c))
        if len(base) == 1 and base != chr(code):
            pairs.append((chr(code), base))
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


_FROM, _TO = _fold_table()


def strip(c: Column) -> Column:
    """Without white space at the ends."""
    return F.trim(c, F.lit(" \t\n\r\f\v"))


def fold(c: Column) -> Column:
    """Lower case without accents, for Latin script; combining marks are dropped."""
    return F.regexp_replace(F.translate(F.lower(c), _FROM, _TO), r"[̀-ͯ]", "")


@F.pandas_udf(StringType())
def fold_exact(s):
    """Full compatibility decomposition, for text beyond the Latin blocks."""
    return s.map(lambda x: None if x is None else "".join(c for c in unicodedata.normalize("NFKD", x.lower()) if not unicodedata.combining(c)))


def name_key(c: Column) -> Column:
    """The key by which municipalities are looked up; blank is null."""
    return F.nullif(fold(strip(c)), F.lit(""))


def tokens(c: Column) -> Column:
    """Distinct white-space tokens; null and blank give none."""
    return F.array_distinct(F.filter(F.split(F.coalesce(c, F.lit("")), r"\s+"), lambda t: t != ""))


def title_display(c: Column, strip_symbols: bool = True) -> Column:
    """One line, repeated marks once, shouted titles in title case, at most 120 characters cut at a word.

    ``strip_symbols=False`` keeps pictographs, as the original tables do.
    """
    text = F.coalesce(c, F.lit(""))
    if strip_symbols:
        text = F.regexp_replace(text, r"[\p{So}\x{FE0F}]", "")
    text = F.trim(F.regexp_replace(text, r"(?U)\s+", " "))
    text = F.regexp_replace(text, r"[!?.]+([!?.])", "$1")
    words = F.split(F.lower(text), " ")
    cased = F.array_join(F.transform(words, lambda w, i: F.when(w.isin(INNER_LOWER) & (i > 0), w).otherwise(F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, 2, 1000)))), " ")
    text = F.when((text == F.upper(text)) & (text != F.lower(text)), cased).otherwise(text)
    head = F.substring(text, 1, 120)
    at_word = F.regexp_replace(head, r" [^ ]*$", "")
    return F.when(F.length(text) <= 120, text).when((at_word != head) & (at_word != ""), at_word).otherwise(head)


def title_key(c: Column, comune: Column | None = None) -> Column:
    """The sorted tokens of a title without accents, edition ordinals, the municipality's name and stop words."""
    text = F.regexp_replace(fold(F.coalesce(c, F.lit(""))), EDITION, "")
    if comune is not None:
        place = fold(comune)
        text = F.when(F.coalesce(place, F.lit("")) == "", text).otherwise(F.replace(text, place, F.lit("")))
    words = F.split(F.regexp_replace(text, r"(?U)[^\w\s]", " "), r"(?U)\s+")
    return F.array_join(F.array_sort(F.filter(words, lambda w: (w != "") & ~w.isin(STOPWORDS))), " ")


def overlap(a: Column, b: Column) -> Column:
    """Shared tokens over the tokens of the smaller side; 0 where a side has none."""
    least = F.least(F.size(a), F.size(b))
    return F.when(least > 0, F.size(F.array_intersect(a, b)) / least).otherwise(F.lit(0.0))


def titles_similar(key_a: Column, key_b: Column) -> Column:
    """Whether two title keys name one event: overlap of 0.8, three shared tokens; a single token only if it says something."""
    return tokens_similar(tokens(key_a), tokens(key_b))


def tokens_similar(a: Column, b: Column) -> Column:
    """``titles_similar`` on the tokens of two keys."""
    least, shared = F.least(F.size(a), F.size(b)), F.size(F.array_intersect(a, b))
    only = F.when(F.size(a) == 1, F.element_at(a, 1)).otherwise(F.element_at(b, 1))
    return F.when((least == 0) | (overlap(a, b) < TITLE_OVERLAP), False).when(least == 1, ~only.isin(GENERIC_WORDS) & (shared == 1)).otherwise(shared >= SHARED_TOKENS)


def series_titles_similar(key_a: Column, key_b: Column) -> Column:
    """As ``titles_similar``, or one title's tokens all in the other."""
    return tokens_of_series_similar(tokens(key_a), tokens(key_b))


def tokens_of_series_similar(a: Column, b: Column) -> Column:
    """``series_titles_similar`` on the tokens of two keys."""
    return tokens_similar(a, b) | (overlap(a, b) >= 1.0)


def _description(c: Column) -> Column:
    return F.lower(strip(F.coalesce(c, F.lit(""))))


def match_parts(key: Column, description: Column) -> dict[str, Column]:
    """What a comparison needs of one event, to be computed before a join: tokens of the title, description and its tokens."""
    return {"_title": tokens(key), "_text": _description(description), "_words": tokens(_description(description))}


def parts_duplicate(title_a: Column, title_b: Column, text_a: Column, text_b: Column, words_a: Column, words_b: Column, sources_a: Column, sources_b: Column) -> Column:
    """``events_duplicate`` on the parts of two events, the cheaper tests first."""
    full = overlap(title_a, title_b) >= 1.0
    close = ((text_a == "") & (text_b == "")) | (overlap(words_a, words_b) >= DESCRIPTION_OVERLAP)
    return ((text_a != "") & (text_a == text_b)) | tokens_similar(title_a, title_b) | (F.arrays_overlap(sources_a, sources_b) & full & close)


def events_duplicate(key_a: Column, key_b: Column, text_a: Column, text_b: Column, sources_a: Column, sources_b: Column) -> Column:
    """Similar titles; or one description; or full title overlap, a shared source and descriptions empty or close."""
    a, b = match_parts(key_a, text_a), match_parts(key_b, text_b)
    return parts_duplicate(*(side[n] for n in ("_title", "_text", "_words") for side in (a, b)), sources_a, sources_b)


def dedup_key(key: Column, date: Column, comune_key: Column) -> Column:
    return F.sha1(F.concat_ws("|", F.substring(F.replace(key, F.lit(" "), F.lit("-")), 1, 20), date, comune_key))


def event_id(dedup: Column) -> Column:
    return F.left(dedup, F.lit(12))


def series_id(key: Column, comune: Column, place: Column) -> Column:
    return F.left(F.sha1(F.concat_ws("|", key, comune, F.coalesce(place, F.lit("")))), F.lit(12))


def artifact_id(source: Column, url: Column, raw_hash: Column) -> Column:
    return F.left(F.sha1(F.concat_ws("|", source, url, raw_hash)), F.lit(16))


def slug(c: Column) -> Column:
    return F.replace(F.lower(c), F.lit(" "), F.lit("-"))


def clean_post(c: Column) -> Column:
    """The lines of a post without interface labels and single obfuscated characters."""
    lines = F.transform(F.split(F.coalesce(c, F.lit("")), "\n"), strip)
    return F.array_join(F.filter(lines, lambda x: (x != "") & ~x.rlike(NOISE_LINE) & ~x.rlike(r"^[\p{L}\p{N}]?\p{M}+$")), "\n")


def title_case(c: Column) -> Column:
    """Every run of letters with a capital, after apostrophes too."""
    return F.regexp_replace(F.initcap(F.regexp_replace(F.lower(c), "'", "'\u0001 ")), "\u0001 ", "")


def subject_and_channel(source_id: Column, category: Column) -> tuple[Column, Column]:
    """The subject's name and the channel that a source id spells out."""
    channel = F.when(source_id.endswith("-facebook"), "facebook").when(source_id.endswith("-instagram"), "instagram").otherwise("sito")
    body = entity_name(source_id)
    name = title_case(F.replace(F.regexp_replace(body, r"^[^-]*-", ""), F.lit("-"), F.lit(" ")))
    whole = title_case(F.replace(body, F.lit("-"), F.lit(" ")))
    subject = F.when((category == "comune") & body.contains("-"), F.concat(F.lit("Comune di "), name)).when((category == "proloco") & body.contains("-"), F.concat(F.lit("Pro Loco di "), name)).otherwise(whole)
    return subject, channel


def entity_name(source_id: Column) -> Column:
    return F.regexp_replace(source_id, r"-(sito|facebook|instagram)$", "")


def comune_of_subject(subject: Column) -> Column:
    """The part before " - " of "Municipality - Name"; null without one."""
    return F.when(subject.contains(" - "), F.trim(F.split(subject, " - ", 2)[0]))


def append_note(note: Column, more: Column) -> Column:
    return F.concat(F.coalesce(F.concat(note, F.lit(" | ")), F.lit("")), more)


def confidence_note(confidence: Column, place_penalty: Column, explicit_year: Column, year_penalty: int) -> Column:
    """What the confidence is made of, in one line."""
    return F.concat_ws(
        "; ",
        F.concat(F.lit("confidenza LLM: "), confidence.cast("string")),
        F.when(place_penalty != 0, F.concat(F.lit("comune inferito dalla fonte, non dal testo ("), place_penalty.cast("string"), F.lit(")"))),
        F.when(~F.coalesce(explicit_year, F.lit(False)), F.lit(f"anno non esplicito nel testo (-{year_penalty})")),
    )


#: Symbols of the coverage views and labels of the categories: fixed values.
SYMBOLS = {"followed": "✓", "found": "○", "failed": "X", "absent": "—"}
CATEGORY_LABELS = {"comune": "Comune", "proloco": "Pro Loco", "teatro": "Teatro", "aggregatore": "Aggregatore", "compagnia_itinerante": "Compagnia itinerante", "sconosciuto": "Da classificare"}


def queue_symbol(state: Column) -> Column:
    return F.when(state == "seguito", SYMBOLS["followed"]).when(state.isin("da_seguire", "candidato_da_feed"), SYMBOLS["found"]).when(state.isin("fallito", "non_valido", "quarantena"), SYMBOLS["failed"]).otherwise("")


def site_symbol(endpoint: Column, errors: Column) -> Column:
    return F.when(F.coalesce(endpoint, F.lit("")) == "", "").when(F.coalesce(errors, F.lit(0)) > 0, SYMBOLS["failed"]).otherwise(SYMBOLS["followed"])


def category_label(category: Column) -> Column:
    out = F.coalesce(F.nullif(category, F.lit("")), F.lit("sconosciuto"))
    label = out
    for name, text in CATEGORY_LABELS.items():
        label = F.when(out == name, text).otherwise(label)
    return label


@F.pandas_udf(StringType())
def html_unescape(s):
    import html

    return s.map(lambda x: None if x is None else html.unescape(x))
