"""Structured events from free text: providers, prompts, validation, and the event rows that follow.

A provider is a plain object with ``extract(system, prompt, images) -> str`` (a JSON answer). It is named by a factory
that runs on the executors, so nothing that holds a connection is sent there. The default reads rules, offline.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fairground import schemas
from fairground.config import DEFAULT, Settings
from fairground.functions import dates, filters, scores, urls
from fairground.functions import text as T

#: Kinds of event.
KINDS = "sagra gastronomia degustazione concerto teatro cinema mostra fiera sportivo bambini altro".split()
SYSTEM = "Estrai gli annunci dal testo e rispondi solo con JSON secondo lo schema. Non inventare date o luoghi."


class Provider(Protocol):
    def extract(self, system: str, prompt: str, images: list[str]) -> str: ...


class RuleProvider:
    """Reads title, dates and kind from a text by rules; confident only where a year is written."""

    name = "rules"

    def extract(self, system: str, prompt: str, images: list[str]) -> str:
        body = prompt.split("\nTesto:\n", 1)[-1]
        title = next((x.strip() for x in body.split("\n") if x.strip()), "")
        found = re.search(rf"(?i)\b(\d{{1,2}})\s+({'|'.join(dates.MONTHS)})(?:\s+((?:19|20)\d\d))?\b", body)
        number = re.search(r"\b(\d{1,2})[/.-](\d{1,2})[/.-]((?:19|20)\d\d)\b", body)
        year = re.search(r"Data di riferimento: (\d{4})", prompt)
        if found:
            day = f"{found[3] or (year[1] if year else '1970')}-{dates.MONTHS.index(found[2].lower()) + 1:02d}-{int(found[1]):02d}"
        elif number:
            day = f"{number[3]}-{int(number[2]):02d}-{int(number[1]):02d}"
        else:
            return json.dumps({"annunci": [], "non_e_un_evento": True, "motivo": "nessuna data"})
        kind = next((k for k in KINDS if re.search(rf"(?i)\b{k}", body)), "altro")
        explicit = bool(number or found[3])
        event = {"titolo": title[:200], "descrizione": body[:400], "tipologia": kind, "data_inizio": day, "anno_esplicito": explicit, "confidenza": 85 if explicit else 75, "ricorrenza": {"e_ricorrente": False}, "campi_incerti": []}
        return json.dumps({"annunci": [event], "non_e_un_evento": False, "motivo": None}, ensure_ascii=False)


PROVIDERS: dict[str, Callable[[], Provider]] = {"rules": RuleProvider}


def prompt(reference: Column, source: Column, category: Column, comune: Column, url: Column, text: Column, caption: Column | None = None) -> Column:
    """What a provider is asked, one string a text."""
    blank = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    parts = [("Data di riferimento", reference), ("Fonte", source), ("Categoria della fonte", category), ("Comune della fonte", comune), ("URL", url)]
    lines = [F.concat(F.lit(f"{n}: "), blank(c)) for n, c in parts] + ([F.concat(F.lit("Didascalia: "), blank(caption))] if caption is not None else [])
    return F.concat(F.concat_ws("\n", *lines), F.lit("\nTesto:\n"), blank(text))


def ask(rows: DataFrame, factory: Callable[[], Provider], tries: int = 3) -> DataFrame:
    """Add ``raw_output`` and ``errore`` to ``artifact_id, prompt, images``; one provider a task, a failed call is a row."""

    def call(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        provider = factory()
        for pdf in batches:
            out = []
            for row in pdf.itertuples(index=False):
                answer, error = None, None
                for _ in range(tries):
                    try:
                        answer, error = provider.extract(SYSTEM, row.prompt, list(row.images) if row.images is not None else []), None
                        break
                    except Exception as e:  # a provider may fail in any way; the row says how
                        error = str(e)[:500]
                out.append((row.artifact_id, answer, error))
            yield pd.DataFrame(out, columns=["artifact_id", "raw_output", "errore"])

    return rows.select("artifact_id", "prompt", "images").mapInPandas(call, "artifact_id string, raw_output string, errore string")


#: Version of the question, stored with each answer.
PROMPT_VERSION = "1"


def records(answers: DataFrame, model: str, now: str) -> DataFrame:
    """Answers as stored extractions: with an id, the model and question they come from, what could be read, and the time."""
    read = F.from_json("raw_output", schemas.EXTRACTION)
    rows = answers.where("raw_output is not null").withColumn("_r", read)
    best = F.array_max(F.transform("_r.annunci", lambda e: e["confidenza"]))
    return rows.select(
        F.substring(F.sha1(F.concat_ws("|", "artifact_id", F.lit(model), F.lit(PROMPT_VERSION))), 1, 16).alias("extraction_id"), "artifact_id", F.lit(model).alias("model"), F.lit(PROMPT_VERSION).alias("prompt_version"), "raw_output", F.to_json("_r").alias("parsed_json"), best.alias("confidence"), F.lit(now).alias("created_at")
    )


def not_extracted(artifacts: DataFrame, extractions: DataFrame) -> DataFrame:
    """Artifacts whose content has no extraction yet."""
    return artifacts.join(extractions.select("artifact_id"), "artifact_id", "left_anti")


def within_quota(artifacts: DataFrame, used: Column, band: str = "fascia", image: str = "ha_immagine") -> DataFrame:
    """Add ``rinvio``: why an artifact waits for another day at this share of the quota, or null."""
    return artifacts.withColumn("rinvio", F.when(used >= 1, "quota_esaurita").otherwise(scores.quota_decision(used, F.col(band), F.col(image))))


def parse(extractions: DataFrame) -> DataFrame:
    """One row an extracted event: ``artifact_id, pos`` and the event's fields. An answer that is not JSON gives none."""
    rows = extractions.withColumn("r", F.from_json("raw_output", schemas.EXTRACTION))
    out = rows.select("artifact_id", F.posexplode("r.annunci").alias("pos", "e")).select("artifact_id", "pos", "e.*")
    fixed = {"confidenza": F.greatest(F.lit(0), F.least(F.lit(100), F.col("confidenza"))), "tipologia": F.when(F.col("tipologia").isin(KINDS), F.col("tipologia")).otherwise("altro"), "url_approfondimento": urls.further_url(F.col("url_approfondimento"))}
    return out.withColumns(fixed)


def sane(events: DataFrame, reference: Column, settings: Settings = DEFAULT) -> DataFrame:
    """Events with a title of 3 to 200 characters and a start from the day before to two years after the reference day.

    Dates the wrong way round are swapped. An artifact that still gives more than 60 events gives none.
    """
    a, b = F.col("data_inizio"), F.col("data_fine")
    turned = a.isNotNull() & b.isNotNull() & (a > b)
    rows = events.withColumns({"data_inizio": F.when(turned, b).otherwise(a), "data_fine": F.when(turned, a).otherwise(b)})
    day = F.try_to_date("data_inizio", "yyyy-MM-dd")
    fits = a.isNull() | (a == "") | day.between(F.date_sub(reference, 1), F.add_months(reference, 12 * settings.sanity_years))
    rows = rows.where(F.length(F.trim("titolo")).between(settings.min_title, settings.max_title) & F.coalesce(fits, F.lit(False)))
    return rows.withColumn("_n", F.count("*").over(Window.partitionBy("artifact_id"))).where(F.col("_n") <= settings.max_events_per_artifact).drop("_n")


def event_rows(events: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """Event columns with ``esito`` from extracted events that went through ``places.resolve_places``.

    Without a start an event is dropped; without a place, or under the threshold, it is quarantined. The gate reads the
    score as it is; what is stored lies from 0 to 100.
    """
    first_of = lambda c: F.try_element_at(F.col(c), F.lit(1)) if c in events.columns else F.lit(None).cast("string")
    score = scores.final_confidence(F.col("confidenza"), F.coalesce("penalty", F.lit(0)), F.col("anno_esplicito"), settings)
    rows = events.withColumn("_score", score)
    return rows.withColumns(
        {
            "esito": scores.gate(F.col("data_inizio"), F.col("comune"), F.col("_score"), settings),
            "dettaglio_confidenza": T.confidence_note(F.col("confidenza"), F.coalesce("penalty", F.lit(0)), F.col("anno_esplicito"), settings.penalty_implicit_year),
            "titolo_normalizzato": T.title_key(F.col("titolo"), F.col("comune")),
            "comune_normalizzato": T.title_key(F.col("comune")),
            "titolo": T.title_display(F.col("titolo")),
            "descrizione": F.left(F.coalesce("descrizione", F.lit("")), F.lit(settings.max_description)),
            "data_fine": F.coalesce(F.nullif("data_fine", F.lit("")), "data_inizio"),
            "luogo": F.col("luogo_testuale"),
            "ora_inizio": dates.clock_time(F.col("ora_inizio")) if "ora_inizio" in rows.columns else F.lit(None).cast("string"),
            "ora_fine": dates.clock_time(F.col("ora_fine")) if "ora_fine" in rows.columns else F.lit(None).cast("string"),
            "url_immagine": first_of("image_paths"),
            # A further link that nobody named is the picture's own address: it can be opened at least.
            "url_approfondimento": F.coalesce(F.nullif("url_approfondimento", F.lit("")), first_of("image_urls")) if "url_approfondimento" in rows.columns else first_of("image_urls"),
            "campi_incerti": F.nullif(F.array_join("campi_incerti", ", "), F.lit("")),
            "confidenza": F.greatest(F.lit(0), F.least(F.lit(100), F.col("_score"))),
        }
    ).drop("_score")


def structured_rows(artifacts: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """Event columns from artifacts that state title and start, resolved by ``places.resolve_places``; no place, no event."""
    rows = artifacts.where("coalesce(titolo, '') <> '' and coalesce(data_inizio, '') <> '' and comune is not null")
    return rows.withColumns(
        {
            "titolo_normalizzato": T.title_key(F.col("titolo"), F.col("comune")),
            "comune_normalizzato": T.title_key(F.col("comune")),
            "titolo": T.title_display(F.col("titolo")),
            "descrizione": F.left(F.coalesce("descrizione", F.lit("")), F.lit(settings.max_description)),
            "tipologia": F.lit("altro"),
            "data_fine": F.coalesce("data_fine", "data_inizio"),
            "luogo": F.col("luogo_testuale"),
            "confidenza": F.lit(settings.structured_confidence) + F.col("penalty"),
        }
    )


def prefiltered(artifacts: DataFrame, as_of: Column) -> DataFrame:
    """Free-text artifacts with ``motivo_scarto``, null for those worth an extraction."""
    free = artifacts.where("coalesce(titolo, '') = '' or coalesce(data_inizio, '') = ''")
    return free.withColumn("motivo_scarto", filters.text_reason(F.col("text"), F.size(F.coalesce("image_urls", F.array().cast("array<string>"))) > 0, as_of))
