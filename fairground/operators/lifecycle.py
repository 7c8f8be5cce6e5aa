"""Changes of state: archiving, operator actions, pulled columns, source outcomes, the follow queue, replays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fairground.config import DEFAULT, Settings
from fairground.functions import text as T
from fairground.functions import urls

#: Actions on quarantined events and states of the follow queue.
ACTIONS = ["promuovi", "scarta", "elimina", "ignora_fonte"]
QUEUE_STATES = ["da_seguire", "candidato_da_feed", "quarantena", "fallito", "non_valido", "seguito", "nessuna_fonte_trovata"]
TELLING_WORDS = ["proloco", "pro loco", "comune"]
REPROCESSABLE = ["T1_html", "T0_aggregatore_playwright", "T0_pa_design_system", "T0_jsonld", "T0_jsonld_indice", "T0_ical", "T0_rss"]


def archive_ended(events: DataFrame, as_of: Column, settings: Settings = DEFAULT) -> DataFrame:
    """Open events that ended before the archive day are archived; an event without an end never is."""
    day = F.date_sub(as_of, settings.archive_after_days).cast("string")
    return events.withColumn("archiviato", F.when((F.col("data_fine") < day) & (F.col("archiviato") == "no"), "si").otherwise(F.col("archiviato")))


def leave_quarantine(events: DataFrame, confirmed: DataFrame) -> DataFrame:
    """Quarantined events that were confirmed again are new; decisions stay."""
    seen = confirmed.select("event_id", F.lit(True).alias("_seen")).distinct()
    return events.join(seen, "event_id", "left").withColumn("stato", F.when(F.col("_seen") & (F.col("stato") == "quarantena"), "nuovo").otherwise(F.col("stato"))).drop("_seen")


def last_rows(sheet: DataFrame, key: str) -> DataFrame:
    """The last row of each key that is not blank: by ``riga`` where the sheet numbers its rows, else as it is stored."""
    at = F.col("riga") if "riga" in sheet.columns else F.monotonically_increasing_id()
    numbered = sheet.where(f"coalesce({key}, '') <> ''").select(F.struct(*sheet.columns).alias("_r"), F.col(key).alias("_k"), at.alias("_at"))
    return numbered.groupBy("_k").agg(F.max_by("_r", "_at").alias("_r")).select("_r.*")


def with_overrides(rows: DataFrame, sheet: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Rows with the operator's columns where the sheet has any; blank and null both mean none. The last row of a key counts."""
    own = last_rows(sheet, key).select(F.col(key).alias("_k"), *(F.nullif(F.trim(F.col(c)), F.lit("")).alias(f"_u_{c}") for c in columns))
    kept = {c: F.coalesce(F.col(f"_u_{c}"), F.col(c) if c in rows.columns else F.lit("")) for c in columns}
    return rows.join(own, rows[key] == own["_k"], "left").withColumns(kept).drop("_k", *(f"_u_{c}" for c in columns))


def apply_actions(events: DataFrame, edges: DataFrame, sources: DataFrame, actions: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Events, edges and sources after ``actions(event_id, azione)``: promoted, dropped, deleted with their edges, or
    dropped with their sources excluded. Unknown actions do nothing."""
    known = T_first(actions.where(F.col("azione").isin(ACTIONS)), "event_id", "azione")
    marked = events.join(known, "event_id", "left")
    state = F.when(F.col("azione") == "promuovi", "ok").when(F.col("azione").isin("scarta", "ignora_fonte"), "scartato").otherwise(F.col("stato"))
    out = marked.where("azione is null or azione <> 'elimina'").withColumn("stato", state).drop("azione")
    gone = known.where("azione = 'elimina'").select("event_id")
    banned = edges.join(known.where("azione = 'ignora_fonte'"), "event_id", "left_semi").select("source_id").distinct().withColumn("_no", F.lit(True))
    excluded = sources.join(banned, "source_id", "left").withColumn("stato", F.when(F.col("_no"), "esclusa").otherwise(F.col("stato"))).drop("_no")
    return out, edges.join(gone, "event_id", "left_anti"), excluded


def T_first(rows: DataFrame, key: str, value: str) -> DataFrame:
    return rows.groupBy(key).agg(F.min(value).alias(value))


def action_tally(actions: DataFrame, edges: DataFrame) -> DataFrame:
    """One row: ``promossi, scartati, eliminati, fonti_escluse``."""
    known = T_first(actions.where(F.col("azione").isin(ACTIONS)), "event_id", "azione")
    excluded = edges.join(known.where("azione = 'ignora_fonte'"), "event_id", "left_semi").agg(F.count("*").alias("fonti_escluse"))
    n = lambda *names: F.count_if(F.col("azione").isin(*names))
    return known.agg(n("promuovi").alias("promossi"), n("scarta", "ignora_fonte").alias("scartati"), n("elimina").alias("eliminati")).join(F.broadcast(excluded))


def pull_source_columns(sources: DataFrame, sheet: DataFrame) -> DataFrame:
    """Category and direct polling as the sheet has them for known sources; blank is null."""
    own = last_rows(sheet, "source_id").select("source_id", *(F.nullif(F.trim(F.col(c)), F.lit("")).alias(f"_{c}") for c in ("categoria", "polling_diretto")), F.lit(True).alias("_in"))
    take = {c: F.when(F.col("_in"), F.col(f"_{c}")).otherwise(F.col(c)) for c in ("categoria", "polling_diretto")}
    return sources.join(own, "source_id", "left").withColumns(take).drop("_categoria", "_polling_diretto", "_in")


def pull_queue_columns(queue: DataFrame, sheet: DataFrame) -> DataFrame:
    """Municipality and state as the sheet has them, where it has any and the state is a known one."""
    state = F.when(F.trim("stato").isin(QUEUE_STATES), F.trim("stato"))
    own = last_rows(sheet, "source_id").select("source_id", F.nullif(F.trim("comune"), F.lit("")).alias("_c"), state.alias("_s"))
    return queue.join(own, "source_id", "left").withColumns({"comune": F.coalesce("_c", "comune"), "stato": F.coalesce("_s", "stato")}).drop("_c", "_s")


def pull_tally(sheet: DataFrame, known: DataFrame) -> DataFrame:
    """One row: sheet rows that met a known source, and those that did not."""
    met = sheet.where("coalesce(source_id, '') <> ''").join(known.select("source_id", F.lit(1).alias("_k")).distinct(), "source_id", "left")
    return met.agg(F.count("_k").alias("aggiornate"), F.count_if(F.col("_k").isNull()).alias("ignorate"))


def apply_outcomes(sources: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Sources after a run's ``outcomes(source_id, seq, errore, pubblicati, totali, fine)``: a success clears the error
    count and adds to the totals, an error adds one and leaves its message. Errors since the last success count."""
    ok = F.col("errore").isNull()
    last_ok = outcomes.where(ok).groupBy("source_id").agg(F.max("seq").alias("_ok"), F.sum("pubblicati").alias("_useful"), F.sum("totali").alias("_total"))
    rows = outcomes.join(last_ok, "source_id", "left")
    after = rows.groupBy("source_id").agg(F.first("_ok").alias("_ok"), F.first("_useful").alias("_useful"), F.first("_total").alias("_total"), F.count_if(~ok & (F.col("_ok").isNull() | (F.col("seq") > F.col("_ok")))).alias("_errors"), F.max_by("errore", "seq").alias("_message"), F.max("fine").alias("_end"))
    out = sources.join(after, "source_id", "left")
    ran, plus = F.col("_end").isNotNull(), lambda c, m: (F.coalesce(F.col(c), F.lit(0)) + F.coalesce(F.col(m), F.lit(0))).alias(c)
    return out.withColumns(
        {
            "consecutive_errors": F.when(F.col("_ok").isNotNull(), F.col("_errors")).otherwise(F.coalesce("consecutive_errors", F.lit(0)) + F.coalesce("_errors", F.lit(0))).cast("int"),
            "ultimo_errore": F.when(ran, F.col("_message")).otherwise(F.col("ultimo_errore")),
            "last_run": F.when(ran, F.col("_end")).otherwise(F.col("last_run")),
            "esiti_totali": plus("esiti_totali", "_total"),
            "esiti_utili": plus("esiti_utili", "_useful"),
        }
    ).drop("_ok", "_useful", "_total", "_errors", "_message", "_end")


def run_summary(outcomes: DataFrame) -> DataFrame:
    """One row of counters over a run's outcomes."""
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c)
    return outcomes.agg(F.count("*").alias("fonti_tentate"), F.count_if(F.col("errore").isNull()).alias("fonti_ok"), F.count_if(F.col("errore").isNotNull()).alias("fonti_errore"), total("pubblicati"), total("totali"))


def import_sources(sources: DataFrame, found: DataFrame) -> DataFrame:
    """Upsert of imported sources: address and category from the import; a tier that was promoted stays."""
    new = found.select("source_id", F.col("endpoint").alias("_e"), F.col("categoria").alias("_c"))
    both = sources.join(new, "source_id", "full_outer")
    return both.withColumns({"endpoint": F.coalesce("_e", "endpoint"), "categoria": F.coalesce("_c", "categoria"), "tier": F.coalesce("tier", F.when(F.col("_e").isNotNull(), "T1_html"))}).drop("_e", "_c")


def may_reprocess(sources: DataFrame) -> DataFrame:
    """Sources of a tier whose pages can be read again for one source alone."""
    return sources.where(F.col("tier").isin(REPROCESSABLE))


def may_read_feed(state: DataFrame, platform: str, now: Column, settings: Settings = DEFAULT) -> DataFrame:
    """Whether a platform's feed may be read now: not within ``feed_separation_minutes`` of its last lot of follows.

    One row: ``permesso, minuti`` (since then, null if never).
    """
    last = state.where(F.col("chiave") == f"ultimo_lotto_follow_{platform}").agg(F.max(F.try_to_timestamp("valore")).alias("_t"))
    minutes = (F.unix_timestamp(now) - F.unix_timestamp("_t")) / 60
    return last.select(F.coalesce(minutes >= settings.feed_separation_minutes, F.lit(True)).alias("permesso"), minutes.alias("minuti"))


def feeds_on_hold(state: DataFrame, now: Column, settings: Settings = DEFAULT) -> DataFrame:
    """``piattaforma`` of the feeds that ``may_read_feed`` does not let read now, all at once."""
    prefix = "ultimo_lotto_follow_"
    last = state.where(F.col("chiave").startswith(prefix)).groupBy(F.substring("chiave", len(prefix) + 1, 100).alias("piattaforma")).agg(F.max(F.try_to_timestamp("valore")).alias("_t"))
    return last.where((F.unix_timestamp(now) - F.unix_timestamp("_t")) / 60 < settings.feed_separation_minutes).select("piattaforma")


def upsert_latest(stored: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows by key, new ones instead of stored ones."""
    return stored.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new.dropDuplicates(keys).select(*stored.columns))


def upsert_queue(stored: DataFrame, new: DataFrame) -> DataFrame:
    """The follow queue after an import: handle, address, subject, municipality, band and category from the import by source
    and platform; state, attempts, day and note of what is stored stay. Of rows with one key that with the greatest address counts."""
    taken = ["handle", "url", "soggetto", "comune", "fascia", "categoria"]
    last = new.groupBy("source_id", "piattaforma").agg(F.max_by(F.struct(*(c for c in new.columns if c not in ("source_id", "piattaforma"))), F.struct(F.coalesce("url", F.lit("")), F.coalesce("handle", F.lit("")))).alias("_n"))
    rows = stored.withColumn("_old", F.lit(True)).join(last, ["source_id", "piattaforma"], "full_outer")
    given = set(new.columns)
    pick = lambda c: F.when(F.col("_n").isNotNull(), F.col(f"_n.{c}")).otherwise(F.col(c)) if c in given and c in taken else F.when(F.col("_old").isNull(), F.col(f"_n.{c}")).otherwise(F.col(c)) if c in given and c not in ("source_id", "piattaforma") else F.col(c)
    return rows.select(*(pick(f.name).cast(f.dataType).alias(f.name) for f in stored.schema))


def insert_missing(stored: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Stored rows and those of the new ones whose key is not there; what is stored wins."""
    return stored.unionByName(new.dropDuplicates(keys).join(stored.select(*keys), keys, "left_anti").select(*stored.columns))


def promote_tiers(sources: DataFrame, checks: DataFrame) -> DataFrame:
    """Sources on the general tier whose page was seen (``source_id, ha_jsonld, ha_cards``) to hold markup read better."""
    better = checks.groupBy("source_id").agg(F.bool_or("ha_jsonld").alias("_j"), F.bool_or("ha_cards").alias("_c"))
    tier = F.when((F.col("tier") == "T1_html") & F.col("_j"), "T0_jsonld").when((F.col("tier") == "T1_html") & F.col("_c"), "T0_pa_design_system").otherwise(F.col("tier"))
    return sources.join(better, "source_id", "left").withColumn("tier", tier).drop("_j", "_c")


def follow_candidates(queue: DataFrame, platform: str, n: int, settings: Settings = DEFAULT) -> DataFrame:
    """The next ``n`` of a platform to follow, first come first."""
    return queue.where((F.col("piattaforma") == platform) & (F.col("stato") == "da_seguire") & (F.coalesce("tentativi", F.lit(0)) < settings.follow_attempts)).orderBy("seq").limit(n)


def follow_outcomes(queue: DataFrame, log: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """The queue after ``log(source_id, piattaforma, esito, data_follow, dettaglio)``: followed (now or before) is
    followed, invalid is invalid, anything else counts an attempt, and the third fails the candidate."""
    done, bad = F.col("esito").isin("seguito", "gia_seguito"), F.col("esito") == "non_valido"
    seen = log.groupBy("source_id", "piattaforma").agg(F.bool_or(done).alias("_done"), F.bool_or(bad).alias("_bad"), F.count_if(~done & ~bad).alias("_tries"), F.max(F.when(done, F.col("data_follow"))).alias("_when"), F.max_by(F.when(~done, F.col("dettaglio")), "data_follow").alias("_note"))
    tries = F.coalesce("tentativi", F.lit(0)) + F.coalesce("_tries", F.lit(0))
    state = F.when(F.col("_done"), "seguito").when(F.col("_bad"), "non_valido").when((F.col("_tries") > 0) & (tries >= settings.follow_attempts), "fallito").otherwise(F.col("stato"))
    return queue.join(seen, ["source_id", "piattaforma"], "left").withColumns({"stato": state, "tentativi": tries.cast("int"), "data_follow": F.coalesce("_when", "data_follow"), "note": F.coalesce("_note", "note")}).drop("_done", "_bad", "_tries", "_when", "_note")


def follow_preconditions(state: DataFrame, log: DataFrame, platforms: DataFrame, now: Column, settings: Settings = DEFAULT) -> DataFrame:
    """``piattaforma, motivo``: why a platform may not be worked on now, or null; ``state`` holds keys and values."""
    value = lambda prefix: state.where(F.col("chiave").startswith(prefix)).select(F.substring("chiave", len(prefix) + 1, 100).alias("piattaforma"), F.try_to_timestamp("valore").alias(prefix))
    today = log.where((F.to_date("data_follow") == F.to_date(now)) & (F.col("esito") == "seguito")).groupBy("piattaforma").agg(F.count("*").alias("_n"))
    rows = platforms.join(value("circuito_aperto_fino_"), "piattaforma", "left").join(value("ultimo_lotto_follow_"), "piattaforma", "left").join(today, "piattaforma", "left")
    minutes = (F.unix_timestamp(now) - F.unix_timestamp("ultimo_lotto_follow_")) / 60
    reason = F.when(now < F.col("circuito_aperto_fino_"), "circuito_aperto").when(minutes < settings.follow_min_minutes, "intervallo_minimo").when(F.col("_n") >= settings.follow_daily_cap, "limite_giornaliero")
    return rows.select("piattaforma", reason.alias("motivo"))


def sync_followed(queue: DataFrame, handles: DataFrame, profiles: DataFrame, keys: DataFrame, platform: str, now: str) -> DataFrame:
    """The queue after reading the followed ``handles(handle)`` of a platform. Known ones are followed; unknown ones are
    quarantined, or ready to follow where ``profiles(handle, soggetto, comune)`` names a telling subject and a known place."""
    own = handles.select(F.ltrim(F.lower(F.trim("handle")), F.lit("@")).alias("_h")).where("_h <> ''").distinct()
    mine = F.col("piattaforma") == platform
    seen = queue.join(own, mine & (F.lower("handle") == F.col("_h")), "left")
    now_followed = F.col("_h").isNotNull() & (F.coalesce("stato", F.lit("")) != "seguito")
    updated = seen.withColumns({"data_follow": F.when(now_followed, F.lit(now)).otherwise(F.col("data_follow")), "stato": F.when(now_followed, "seguito").otherwise(F.col("stato"))}).select(*queue.columns)
    new = own.join(queue.where(mine).select(F.lower("handle").alias("_h")), "_h", "left_anti").join(profiles.select(F.lower("handle").alias("_h"), F.col("soggetto").alias("_s"), T.name_key(F.col("comune")).alias("_k")), "_h", "left")
    new = new.join(keys.select(F.col("place_key").alias("_k"), F.col("comune").alias("_c")), "_k", "left")
    telling = F.exists(F.array(*map(F.lit, TELLING_WORDS)), lambda w: F.contains(F.lower(F.coalesce("_s", F.lit(""))), w)) & F.col("_c").isNotNull()
    values = {"source_id": F.concat(F.lit(f"sconosciuto-{platform}-"), "_h"), "piattaforma": F.lit(platform), "handle": F.col("_h"), "url": urls.handle_url(F.lit(platform), F.col("_h")), "soggetto": F.coalesce("_s", "_h"), "comune": F.coalesce("_c", F.lit("")), "fascia": F.lit(""), "categoria": F.lit("sconosciuto"), "stato": F.when(telling, "da_seguire").otherwise("quarantena"), "data_follow": F.lit(now), "note": F.lit("trovato nella lista seguiti")}
    rows = new.select(*(values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in queue.schema))
    return updated.unionByName(rows)


def attribute_posts(posts: DataFrame, queue: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Posts with the ``comune`` and category of their author where it is known, and the authors to add as candidates."""
    known = queue.where("coalesce(comune, '') <> ''").groupBy(F.col("piattaforma").alias("_p"), F.lower("handle").alias("_h")).agg(F.min(F.struct("source_id", "comune", "categoria", "stato")).alias("q"))
    handle = F.ltrim(F.lower(F.trim("handle")), F.lit("@"))
    rows = posts.withColumn("_own", handle).join(known, (F.col("piattaforma") == F.col("_p")) & (F.col("_own") == F.col("_h")), "left")
    found = rows.select(*posts.columns, F.col("q.comune").alias("comune"), F.col("q.categoria").alias("categoria"), (F.col("q.stato") == "esclusa").alias("esclusa"))
    new = rows.where("q is null").select(F.concat(F.lit("sconosciuto-"), "piattaforma", F.lit("-"), "_own").alias("source_id"), "piattaforma", F.col("_own").alias("handle"), urls.handle_url(F.col("piattaforma"), F.col("_own")).alias("url"), F.col("_own").alias("soggetto"), F.lit("").alias("comune"), F.lit("sconosciuto").alias("categoria"), F.lit("candidato_da_feed").alias("stato")).distinct()
    return found, new


def post_outcome(group_post: Column, explicit_place: Column, outcome: Column) -> Column:
    """Posts of a group never take their author's place: an event without one of its own is set apart."""
    return F.when(group_post & ~explicit_place, "gruppo_comune_non_inferito").otherwise(outcome)


def outcome_of_post(outcomes: DataFrame, post: str = "post_id") -> DataFrame:
    """One outcome a post: published before quarantined before the first of the others."""
    rank = F.when(F.col("esito") == "pubblicato", 0).when(F.col("esito") == "quarantena", 1).otherwise(2)
    return outcomes.groupBy(post).agg(F.min_by("esito", F.struct(rank, "seq")).alias("esito"))


def unavailable_sources(queue: DataFrame, edges: DataFrame, pages: DataFrame) -> DataFrame:
    """The queue with followed pages that never gave an event and whose landed page says it is gone marked invalid.
    A page that could not be read says nothing."""
    from fairground.functions.filters import unavailable

    silent = queue.where("stato = 'seguito' and piattaforma = 'facebook' and coalesce(url, '') <> ''").join(edges.select("source_id").distinct(), F.concat(F.lit("feed-facebook-"), F.col("handle")) == edges["source_id"], "left_anti")
    gone = pages.select("url", unavailable(F.col("text")).alias("_why")).where("_why is not null").groupBy("url").agg(F.min("_why").alias("_why"))
    marked = silent.select("source_id", "piattaforma", "url").join(gone, "url").select("source_id", "piattaforma", "_why").distinct()
    return queue.join(marked, ["source_id", "piattaforma"], "left").withColumns({"stato": F.when(F.col("_why").isNotNull(), "non_valido").otherwise(F.col("stato")), "note": F.coalesce(F.concat(F.lit("contenuto non disponibile: '"), "_why", F.lit("'")), "note")}).drop("_why")


def new_ids(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """What a replay added."""
    return after.select(*keys).distinct().join(before.select(*keys), keys, "left_anti")


def replace_after_replay(events: DataFrame, replayed: DataFrame) -> DataFrame:
    """Where a replay of a post's ``url`` gave ``event_id`` s that were not there, the url's earlier events are archived
    with a note; where it gave none, nothing changes."""
    fresh = replayed.join(events.select("event_id"), "event_id", "left_anti").groupBy("url").agg(F.array_sort(F.collect_set("event_id")).alias("_new"))
    rows = events.join(fresh, "url", "left")
    hit = F.col("_new").isNotNull() & (F.col("archiviato") == "no")
    note = T.append_note(F.col("note"), F.concat(F.lit("sostituito da "), F.array_join("_new", ", ")))
    return rows.withColumns({"note": F.when(hit, note).otherwise(F.col("note")), "archiviato": F.when(hit, "si").otherwise(F.col("archiviato"))}).drop("_new")


def replay_routes(events: DataFrame, edges: DataFrame) -> DataFrame:
    """``rotta, chiave, annunci``: quarantined events by how they can be read again: posts by event, pages by source."""
    rows = events.where("stato = 'quarantena'").select("event_id").join(edges.select("event_id", "source_id").distinct(), "event_id")
    route = F.when(F.col("source_id").startswith("feed-instagram-"), "instagram").when(F.col("source_id").startswith("feed-facebook-"), "facebook_non_riprocessabile").otherwise("html")
    return rows.withColumn("rotta", route).groupBy("rotta", F.when(F.col("rotta") == "html", F.col("source_id")).otherwise(F.col("event_id")).alias("chiave")).agg(F.countDistinct("event_id").alias("annunci"))
