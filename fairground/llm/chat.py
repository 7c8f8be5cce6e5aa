"""Transcript parsing: who speaks is recovered by a hidden Markov model, then turns are rendered in one form.

A row's text is cut before every line that opens with a speaker marker. The hidden states are the roles; a segment is
seen by its marker, its length, whether it asks, how many lines it has and how it opens. Start, transition and emission
probabilities are counted over all labelled rows; roles come from Viterbi over a conversation's segments.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fairground.llm.common import Scratch, runs

ROLES = ("system", "user", "assistant")
#: Words that name a speaker before a colon, or stand in a chat tag.
SPEAKERS = {
    "system": "system|instructions?|instrucciones|anweisung",
    "user": "user|human|customer|question|q|utilisateur|nutzer|benutzer|usuario|prompter",
    "assistant": "assistant|ai|bot|chatbot|answer|a|agent|assistent|asistente|gpt",
}
_ANY = "|".join(SPEAKERS.values())
MARKER = rf"(?im)^[ \t]*(?:<\|(?:im_start\|>)?(?:{_ANY})(?:\|>)?|\[(?:{_ANY})\]|#{{1,4}} ?(?:{_ANY})\b:?|\*{{0,2}}(?:{_ANY})\*{{0,2}} ?:\*{{0,2}})[ \t]*"
#: A marker tells its role this surely; the rest is shared by the other roles and by segments without one.
TRUST = 0.98
#: Segments that are decoded at a time of one conversation.
BLOCK = 2048

FEATURES = ("length", "asks", "lines", "opening")


@dataclass(frozen=True)
class Hmm:
    """Log probabilities; ``emission[feature]`` is a table of value by role."""

    start: np.ndarray
    step: np.ndarray
    emission: dict[str, np.ndarray]


def segments(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", text: str = "text") -> DataFrame:
    """``conv_id, turn, tie, row, segment, n, marker, text`` and the features of each segment, and the role ``given`` to its row.

    Null text is one empty segment. A text in front of its first marker is a segment of its own. ``tie`` is a hash of
    the row's text and ``row`` a number of its own: they order rows that share a turn.
    """
    parts = F.filter(F.split(F.regexp_replace(F.coalesce(F.col(text), F.lit("")), MARKER, "\u0001$0"), "\u0001"), lambda p: p.rlike(r"\S"))
    cut = rows.select(F.col(conv).cast("long").alias("conv_id"), F.col(turn).cast("long").alias("turn"), *([F.lower("role").alias("given")] if "role" in rows.columns else [F.lit(None).cast("string").alias("given")]), F.xxhash64(F.col(text).cast("string")).alias("tie"), F.monotonically_increasing_id().alias("row"), F.when(F.size(parts) == 0, F.array(F.lit(""))).otherwise(parts).alias("parts"))
    out = cut.select("conv_id", "turn", "tie", "row", "given", F.size("parts").alias("n"), F.posexplode("parts").alias("segment", "raw"))
    head = F.lower(F.regexp_extract("raw", MARKER, 0))
    marker = F.lit(-1)
    for i, role in reversed(list(enumerate(ROLES))):
        marker = F.when(head.rlike(rf"(?<![a-z])(?:{SPEAKERS[role]})(?![a-z])"), i).otherwise(marker)
    body = F.regexp_replace(F.regexp_replace(F.regexp_replace("raw", MARKER, ""), r"<\|(?:im_end|end)\|>", ""), r"^\s+|\s+$", "")
    out = out.withColumns({"marker": F.when(head == "", -1).otherwise(marker), "text": body}).drop("raw")
    return out.withColumns(
        {
            "length": F.least(F.lit(15), F.floor(F.log2(F.length("text") + 1.0))).cast("int"),
            "asks": F.when(F.col("text").rlike(r"[?？]\s*$"), 2).when(F.col("text").contains("?"), 1).otherwise(0),
            "lines": F.least(F.lit(7), F.size(F.split("text", "\n"))) - 1,
            "opening": F.when(F.col("text").rlike(r"^(?i:you are|you're an?|your task|respond|act as|vous êtes|tu es|du bist|sie sind|eres|usted es)\b"), 1).when(F.col("text").rlike(r"^(?:```|[-*•] |\d+[.)] )"), 2).otherwise(0),
        }
    )


_SIZES = {"length": 16, "asks": 3, "lines": 8, "opening": 3}


def fit(segs: DataFrame) -> Hmm:
    """Count the probabilities over all rows whose role is given and that hold one segment; add-one smoothed.

    Steps are counted between turns ``n`` and ``n + 1`` by a join of the counts of roles in each, so no conversation is
    ordered as a whole, and a turn that many rows share counts once a row. Without labels all is even, but for a start
    that prefers the system and turns that alternate.
    """
    code = F.coalesce(*(F.when(F.col("given") == r, i) for i, r in enumerate(ROLES)))
    known = segs.where("n = 1").withColumn("state", code).where("state is not null").select("conv_id", "turn", "state", *FEATURES)
    seen = known.groupBy("state", *FEATURES).agg(F.count("*").alias("m")).toPandas()  # a bounded grid of values
    emission = {}
    for f in FEATURES:
        table = np.ones((_SIZES[f], 3))
        np.add.at(table, (seen[f].to_numpy(int), seen["state"].to_numpy(int)), seen["m"].to_numpy(float))
        emission[f] = np.log(table / table.sum(axis=0))
    start = np.array([1.0, 1.0, 0.5])
    for r in known.where("turn = 0").groupBy("state").agg(F.count("*").alias("m")).collect():
        start[r["state"]] += r["m"]
    step = np.array([[0.1, 1.0, 0.3], [0.02, 0.2, 1.0], [0.02, 1.0, 0.2]])
    turns = known.groupBy("conv_id", "turn", "state").agg(F.count("*").alias("m"))
    after = turns.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("state").alias("then"), F.col("m").alias("k"))
    for r in turns.join(after, ["conv_id", "turn"]).groupBy("state", "then").agg(F.sum(F.least("m", "k")).alias("m")).collect():
        step[r["state"], r["then"]] += r["m"]
    return Hmm(np.log(start / start.sum()), np.log(step / step.sum(axis=1, keepdims=True)), emission)


def emissions(hmm: Hmm) -> Column:
    """The log probabilities of a segment's features under each role, as an array."""
    out = []
    for i in range(3):
        own = F.when(F.col("marker") == i, float(np.log(TRUST))).when(F.col("marker") >= 0, float(np.log((1 - TRUST) / 2))).otherwise(0.0)
        for f in FEATURES:
            own = own + F.element_at(F.array(*(F.lit(float(x)) for x in hmm.emission[f][:, i])), F.col(f) + 1)
        out.append(own)
    return F.array(*out)


def _groups(table: pa.Table, keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """First rows of the groups, longest group first, and the groups' lengths."""
    new = np.zeros(table.num_rows, bool)
    new[0] = True
    for k in keys:
        column = table.column(k)
        for values in (column.fill_null(0).to_numpy(), column.is_null().to_numpy()):
            new[1:] |= values[1:] != values[:-1]
    first = np.flatnonzero(new)
    size = np.diff(np.append(first, table.num_rows))
    order = np.argsort(-size, kind="stable")
    return first[order], size[order]


def viterbi(score: np.ndarray, first: np.ndarray, size: np.ndarray, begin: np.ndarray, step: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The best states of all groups at once. ``begin`` holds each group's log start vector, ``end`` its last state or -1."""
    best, back = begin + score[first], []
    for t in range(1, int(size[0])):
        n = int(np.searchsorted(-size, -t))
        ways = best[:n, :, None] + step
        back.append(ways.argmax(axis=1).astype(np.int8))
        best[:n] = ways.max(axis=1) + score[first[:n] + t]
    state = np.where(end >= 0, end, best.argmax(axis=1))
    out = np.empty(int(size.sum()), np.int64)
    out[first + size - 1] = state
    for t in range(int(size[0]) - 1, 0, -1):
        n = int(np.searchsorted(-size, -t))
        state[:n] = back[t - 1][np.arange(n), state[:n]]
        out[first[:n] + t - 1] = state[:n]
    return out


def transfer(score: np.ndarray, first: np.ndarray, size: np.ndarray, into: np.ndarray) -> np.ndarray:
    """Of each group, the best log probability from each state before it (the last: none) to each of its last states."""
    best = into + score[first][:, None, :]
    for t in range(1, int(size[0])):
        n = int(np.searchsorted(-size, -t))
        best[:n] = (best[:n, :, :, None] + into[:3]).max(axis=2) + score[first[:n] + t][:, None, :]
    return best


KEYS, ORDER = ["conv_id", "block"], ["conv_id", "block", "at"]


def boundaries(scored: DataFrame, into: np.ndarray) -> DataFrame:
    """``conv_id, block, before, last``: for conversations of several blocks, the states on both sides of each block.

    A block is summed up by the best way through it from every state to every state, and only these sums are chained.
    """
    spans = scored.groupBy("conv_id").agg(F.min("block").alias("lo"), F.max("block").alias("hi")).where("lo < hi").select("conv_id")

    def sums(batches):
        for table in runs(batches, KEYS):
            first, size = _groups(table, KEYS)
            m = transfer(_scores(table), first, size, into).reshape(len(first), -1)
            at = pa.array(first)
            yield pa.RecordBatch.from_arrays([*(table.column(k).take(at).combine_chunks() for k in KEYS), pa.array(list(m), pa.list_(pa.float64()))], ["conv_id", "block", "m"])

    def chain(table: pa.Table) -> pa.Table:
        # One row a block: a conversation of a billion turns has half a million.
        pdf = table.to_pandas().sort_values("block", ignore_index=True)
        m = np.stack(pdf["m"].to_numpy()).reshape(-1, 4, 3)
        best, back = m[0, 3], []
        for own in m[1:]:
            ways = best[:, None] + own[:3]
            back.append(ways.argmax(axis=0))
            best = ways.max(axis=0)
        last = [int(best.argmax())]
        for b in reversed(back):
            last.append(int(b[last[-1]]))
        last = last[::-1]
        conv = pa.array([table.column("conv_id")[0].as_py()] * len(pdf), pa.int64())
        return pa.table({"conv_id": conv, "block": pa.array(pdf["block"].to_numpy(), pa.int64()), "before": pa.array([3, *last[:-1]], pa.int32()), "last": pa.array(last, pa.int32())})

    long = scored.select(*ORDER, "score").join(spans.withColumnRenamed("conv_id", "_long"), F.col("conv_id").eqNullSafe(F.col("_long")), "left_semi")
    blocks = long.repartition("conv_id", "block").sortWithinPartitions(*ORDER).mapInArrow(sums, "conv_id long, block long, m array<double>")
    return blocks.groupBy("conv_id").applyInArrow(chain, "conv_id long, block long, before int, last int")


def _scores(table: pa.Table) -> np.ndarray:
    return table.column("score").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, 3)


def format_transcripts(spark: SparkSession, rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """``conv_id, turn, segment, role, text, rendered``: each segment with its recovered role and in canonical form.

    ``rows`` hold ``conv_id``, ``turn`` and ``text``; ``role``, where given, is only counted, never read for the row's
    own prediction. Rows without a conversation are one conversation; a null turn comes first; rows that share a turn
    follow a hash of their texts, rows equal in that too the order they come in, and the segments of a row stay
    together. Null and empty texts are kept as an empty turn; long texts are read whole; repeated rows are turns of
    their own. Other columns are ignored; an empty table gives no rows.

    All segments are sorted into files by ranges of conversation, turn and those ties, so that one conversation with a
    third of all rows, even of one turn or none, lies in many files. It is decoded in blocks of ``block`` segments of a
    file whose boundary states are found first, so it is spread over tasks and still decoded exactly.
    """
    scratch = Scratch(spark, "chat")
    first = [F.asc_nulls_first(c) for c in ("conv_id", "turn", "tie", "row", "segment")]
    # One file a task, whatever the session says: files are numbered by their task, in the order of their ranges.
    stored = scratch.table("segments", segments(rows).orderBy(*first), maxRecordsPerFile=0)
    part, at = F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).cast("long"), F.col("_metadata.row_index")
    segs = stored.select("*", (part * (1 << 32) + F.floor(at / block)).alias("block"), at.alias("at"))
    hmm = fit(segs)
    into = np.vstack([hmm.step, hmm.start])
    scored = segs.withColumn("score", emissions(hmm)).select(*ORDER, "turn", "segment", "score", "text")
    sides = scratch.table("sides", boundaries(scored, into))

    def decode(batches):
        for table in runs(batches, KEYS):
            first, size = _groups(table, KEYS)
            before, last = (table.column(c).to_numpy()[first] for c in ("before", "last"))
            state = viterbi(_scores(table), first, size, into[before], hmm.step, last)
            role = pa.array(list(ROLES)).take(pa.array(state))
            for part in pa.table([*(table.column(c) for c in ("conv_id", "turn", "segment")), role, table.column("text")], ["conv_id", "turn", "segment", "role", "text"]).to_batches():
                yield part

    known = scored.join(sides, [scored["conv_id"].eqNullSafe(sides["conv_id"]), scored["block"] == sides["block"]], "left").select(*(scored[c] for c in scored.columns), F.coalesce("before", F.lit(3)).alias("before"), F.coalesce("last", F.lit(-1)).alias("last"))
    ordered = known.repartition("conv_id", "block").sortWithinPartitions(*ORDER)
    out = ordered.mapInArrow(decode, "conv_id long, turn long, segment int, role string, text string")
    return out.withColumn("rendered", F.concat(F.lit("<|"), "role", F.lit("|>\n"), "text", F.lit("\n<|end|>")))
