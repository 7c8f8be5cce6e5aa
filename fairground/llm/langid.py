"""Language identification by cross-parsing entropy.

For each language a suffix automaton is built over a bounded sample of labelled text. A document is parsed against each
from left to right into the longest phrases that occur in the sample; the language in which the fewest phrases,
weighted by the bits that name one, cover the text is the prediction.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fairground.llm.common import concat, slices, text_column

#: Bounds of what each language is learned from: documents, drawn by a hash, and characters of them. All languages that
#: are labelled are learned, with all letters of their samples; a model takes about 3 MB.
DOCUMENTS, CHARACTERS = 96, 60_000
#: Texts are parsed in runs of this many characters, side by side; what a run's start depends on is mended afterwards.
RUN = 512
#: Languages parsed at a time, and bytes of text: they bound the working memory.
GROUP, SLICE = 8, 1 << 22


def letters_only(texts: pa.Array) -> pa.Array:
    """Lower-cased letters; whatever lies between them is one space."""
    return pc.replace_substring_regex(pc.utf8_lower(texts), r"[^\p{L}\p{M}]+", " ")


def code_points(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The code points of all texts as one array, and each text's bounds in it."""
    bounds = np.concatenate([[0], np.cumsum(pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))])
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = memoryview(data)[int(offsets[0]) : int(offsets[-1])] if data is not None else b""
    return np.frombuffer(str(raw, "utf-8").encode("utf-32-le"), np.uint32), bounds


def automaton(symbols: np.ndarray) -> list[dict[int, int]]:
    """Transitions of each state of the suffix automaton of ``symbols``; state 0 is the start."""
    go: list[dict[int, int]] = [{}]
    link, length = [-1], [0]
    last = 0
    for c in symbols.tolist():
        new = len(go)
        go.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and c not in go[p]:
            go[p][c] = new
            p = link[p]
        if p >= 0:
            q = go[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                clone = len(go)
                go.append(dict(go[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                link[q] = link[new] = clone
                while p >= 0 and go[p].get(c) == q:
                    go[p][c] = clone
                    p = link[p]
        last = new
    return go


@dataclass(frozen=True)
class Automaton:
    """A suffix automaton over an alphabet of its own, its rows laid over each other in one table.

    ``letters`` are the sorted code points; symbol ``i + 1`` is letter ``i``, 0 is any other. A state is named by where
    its row begins, which is unlike that of all others: its step by symbol ``c`` is ``step[state + c]`` if
    ``owner[state + c]`` is the state. ``begin`` holds where a phrase that starts with a symbol leads, the start itself
    for symbol 0; the start has no steps of its own in the table.
    """

    letters: np.ndarray
    owner: np.ndarray
    step: np.ndarray
    begin: np.ndarray
    size: int

    @staticmethod
    def of(sample: str) -> Automaton:
        points = np.frombuffer(sample.encode("utf-32-le"), np.uint32)
        letters, symbols = np.unique(points, return_inverse=True)
        go = automaton(symbols + 1)
        width, block, total = len(letters) + 1, 1024, sum(map(len, go))
        # Rows of several steps go where they fit first, those of one step into the gaps that are left.
        used, named = (np.zeros(4 * width + total + 4 * block, bool) for _ in range(2))
        at = 2 * width
        name = np.zeros(len(go), np.int64)
        for s in sorted((s for s in range(1, len(go)) if len(go[s]) > 1), key=lambda s: -len(go[s])):
            own = np.sort(np.fromiter(go[s], np.int64))
            while True:
                if at + block + width > len(used):
                    used, named = (np.append(x, np.zeros(len(x), bool)) for x in (used, named))
                fits = ~(used[at : at + block] | named[at - own[0] : at - own[0] + block])
                for gap in (own[1:] - own[0]).tolist():
                    fits &= ~used[at + gap : at + gap + block]
                place = int(fits.argmax())
                if fits[place]:
                    break
                at += block  # what is left of a block that a row did not fit goes to rows of one step
            name[s] = at + place - own[0]
            used[name[s] + own], named[name[s]] = True, True
        # By falling symbol into rising gaps, so that no two begin at the same place.
        gaps = iter([*(2 * width + np.flatnonzero(~used[2 * width :])).tolist(), *range(len(used), len(used) + total + width)])
        taken = set(np.flatnonzero(named).tolist())
        for c, s in sorted(((-next(iter(x)), s) for s, x in enumerate(go) if s and len(x) == 1)):
            name[s] = next(g + c for g in gaps if g + c not in taken)
        top = max(int(name.max()) + width, len(used))
        # The start and the state at the end of the sample have no row.
        for i, s in enumerate(s for s, x in enumerate(go) if not s or not x):
            name[s] = top + i
        states = np.repeat(np.arange(1, len(go)), [len(x) for x in go[1:]])
        by = np.array([c for x in go[1:] for c in x], np.int64)
        to = name[np.array([t for x in go[1:] for t in x.values()], np.int64)]
        owner, step = np.full(int(name.max()) + width, -1, np.int32), np.zeros(int(name.max()) + width, np.int32)
        owner[name[states] + by], step[name[states] + by] = name[states], to
        begin = np.full(width, name[0], np.int32)
        begin[list(go[0])] = name[list(go[0].values())]
        return Automaton(letters, owner, step, begin, len(points))


class Tables:
    """The automata of a few languages laid end to end."""

    def __init__(self, automata: list[Automaton], alphabet: np.ndarray):
        places = np.cumsum([0, *(len(a.owner) for a in automata)])
        #: Owner and step of a place share a number, as both are read together.
        self.table = np.concatenate([(np.where(a.owner < 0, -1, a.owner.astype(np.int64) + p) << 32) | (a.step.astype(np.int64) + p) for a, p in zip(automata, places)])
        self.begin = np.concatenate([a.begin.astype(np.int64) + p for a, p in zip(automata, places)])
        self.starts = np.cumsum([0, *(len(a.begin) for a in automata)])[:-1]
        self.root = self.begin[self.starts]
        #: Symbols of each language by the place of a letter in the common alphabet (0: in none).
        self.symbol = np.zeros((len(alphabet) + 1, len(automata)), np.uint16 if len(alphabet) < 1 << 16 else np.int32)
        for i, a in enumerate(automata):
            self.symbol[np.searchsorted(alphabet, a.letters) + 1, i] = np.arange(1, len(a.letters) + 1)

    def advance(self, state: np.ndarray, symbol: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The states after a symbol, and whether a new phrase began with it."""
        entry = self.table[state + symbol]
        new = (entry >> 32) != state
        entry &= 0xFFFFFFFF
        entry[new] = self.begin[(starts + symbol)[new]]
        return entry, new

    def phrases(self, letters: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Phrases of each text (rows) in each language (columns)."""
        size = np.diff(bounds)
        runs = -(-size // RUN)
        text = np.repeat(np.arange(len(size)), runs)
        first = np.repeat(np.cumsum(runs) - runs, runs)
        start = bounds[text] + (np.arange(len(text)) - first) * RUN
        length = np.minimum(RUN, bounds[text + 1] - start)
        # Longest runs first: those that still go on after t characters are always the first n.
        order = np.argsort(-length, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        begin, sizes = start[order], length[order]
        state = np.repeat(self.root[None, :], len(text), axis=0)
        # Every run is parsed as if a phrase began with it: by t, whether one began with the character of each run ...
        news = []
        for t in range(int(sizes[0]) if len(sizes) else 0):
            n = int(np.searchsorted(-sizes, -t))
            state[:n], new = self.advance(state[:n], self.symbol[letters[begin[:n] + t]], self.starts)
            news.append(new)
        last = state[place]
        # ... then from the state that the run before it ends in, until both ways begin a phrase at the same character.
        run, lang = np.nonzero((np.arange(len(text)) > first)[:, None] & (np.roll(last, 1, axis=0) != self.root))
        while len(run):
            state, at, again, t = last[run - 1, lang], place[run], [], 0
            while len(run):
                state, new = self.advance(state, self.symbol[letters[begin[at] + t], lang], self.starts[lang])
                met = new & news[t][at, lang]
                news[t][at, lang] = new
                t += 1
                over = ~met & (sizes[at] == t)
                onward = np.flatnonzero(over & (state != last[run, lang]))
                last[run[onward], lang[onward]] = state[onward]
                onward = onward[run[onward] + 1 < len(text)]
                onward = onward[text[run[onward] + 1] == text[run[onward]]]
                again.append((run[onward] + 1, lang[onward]))
                left = ~met & ~over
                run, lang, state, at = run[left], lang[left], state[left], at[left]
            run, lang = (np.concatenate(x) for x in zip(*again))
        counts = np.zeros((len(text), len(self.root)), np.int64)
        for new in news:
            counts[: len(new)] += new
        return np.stack([np.bincount(text[order], c, minlength=len(size)) for c in counts.T], axis=1)


class Parser:
    """Phrase counts of texts in every language of ``samples`` (language to text or automaton)."""

    def __init__(self, samples: dict[str, str | Automaton]):
        self.languages = sorted(samples)
        automata = [x if isinstance(x, Automaton) else Automaton.of(x) for x in (samples[n] for n in self.languages)]
        alphabet = np.unique(np.concatenate([a.letters for a in automata]))
        self.place = np.zeros(0x110000, np.int32)
        self.place[alphabet] = np.arange(1, len(alphabet) + 1)
        self.tables = [Tables(automata[i : i + GROUP], alphabet) for i in range(0, len(automata), GROUP)]
        self.bits = np.array([np.log2(max(a.size, 2)) for a in automata])

    def phrases(self, points: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Phrases of each text (rows) in each language (columns)."""
        letters = self.place[points]
        return np.concatenate([tables.phrases(letters, bounds) for tables in self.tables], axis=1)

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        """The language and a score from 0 to 1 of each text; ``und`` and 0 without a letter."""
        lettered = pc.match_substring_regex(texts, r"\p{L}").to_numpy(zero_copy_only=False).astype(bool)
        bits = self.phrases(*code_points(letters_only(texts))) * self.bits
        best = bits.argmin(axis=1)
        # Shares of each language if a phrase's bits counted an eighth.
        weight = np.exp2(-(bits - bits.min(axis=1, keepdims=True)) / 8)
        score = np.where(lettered, 1 / weight.sum(axis=1), 0.0)
        return [self.languages[b] if has else "und" for b, has in zip(best, lettered)], score


def sample_text(texts: list[str]) -> str:
    """At most ``CHARACTERS`` letters and spaces of the texts: each gives as much as the bound allows, the shorter ones leaving room to the longer."""
    clean = letters_only(pa.array(texts, pa.string())).to_pylist()
    left, parts = CHARACTERS, []
    for k, text in enumerate(sorted(clean, key=len)):
        parts.append(text[: left // (len(clean) - k)])
        left -= len(parts[-1])
    return " ".join(parts) if any(p.strip() for p in parts) else ""


def learn(docs: DataFrame, may_learn: Column) -> dict[str, Automaton]:
    """The automaton of each labelled language, from at most ``DOCUMENTS`` documents drawn by a hash of id and text.

    Languages are learned side by side on the executors; only the automata come to the driver.
    """
    labelled = docs.where(may_learn & F.col("text").isNotNull() & F.col("lang").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    counts = labelled.groupBy("lang").agg(F.count("*").alias("n"))  # one row a language
    share = F.least(F.lit(1.0), F.lit(1.5 * DOCUMENTS) / F.col("n"))
    h = F.xxhash64("doc_id", "text").alias("h")
    few = labelled.join(F.broadcast(counts), "lang").where(F.xxhash64("doc_id", "text", F.lit(1)).bitwiseAND((1 << 62) - 1) < share * float(1 << 62)).select("lang", h, F.substring("text", 1, CHARACTERS).alias("text"))
    arrays = ("letters", "owner", "step", "begin")

    def build(table: pa.Table) -> pa.Table:
        lang, rows = table.column("lang")[0].as_py(), sorted(zip(table.column("h").to_pylist(), table.column("text").to_pylist()))
        texts = list(dict.fromkeys(text for _, text in rows))[:DOCUMENTS]
        sample = sample_text(texts)
        made = [Automaton.of(sample)] if sample else []
        columns = {"lang": pa.array([lang] * len(made), pa.string()), "size": pa.array([m.size for m in made], pa.int32())}
        return pa.table(columns | {n: pa.array([getattr(m, n).astype(np.int32).tobytes() for m in made], pa.binary()) for n in arrays})

    built = few.groupBy("lang").applyInArrow(build, "lang string, size int, letters binary, owner binary, step binary, begin binary")
    return {r["lang"]: Automaton(*(np.frombuffer(r[n], np.int32) for n in arrays), r["size"]) for r in built.toLocalIterator()}


_PARSERS: dict[str, Parser] = {}


def _parser(key: str, automata: dict[str, Automaton]) -> Parser:
    """The parser of one call of ``identify``, kept by a Python worker from task to task."""
    if key not in _PARSERS:
        _PARSERS.clear()
        _PARSERS[key] = Parser(automata)
    return _PARSERS[key]


def identify(spark: SparkSession, docs: DataFrame, may_learn: Column) -> DataFrame:
    """``doc_id, lang_pred, score`` of every whole text.

    ``may_learn`` says which rows the samples may come from; of those, rows with text and ``lang`` count. Null text and
    text without a letter are ``und`` with score 0, and so is everything if nothing can be learned from. Ties go to the
    language first in order. Long texts are parsed whole: no phrase ends because its text is cut. Repeated rows are
    predicted alike; other columns are ignored.
    """
    held, key = spark.sparkContext.broadcast(learn(docs, may_learn)), uuid.uuid4().hex

    def predict(batches):
        parser = _parser(key, held.value) if held.value else None
        for batch in slices(batches, SLICE):
            texts = concat(batch.column("text"))
            langs, score = parser.predict(texts) if parser else (["und"] * len(texts), np.zeros(len(texts)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(langs, pa.string()), pa.array(score)], ["doc_id", "lang_pred", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_column(docs))
    return rows.mapInArrow(predict, "doc_id long, lang_pred string, score double")
