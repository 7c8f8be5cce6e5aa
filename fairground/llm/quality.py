"""Quality classifier by co-training.

Two views of a document are classified apart: its words, and its metadata (source, language, size and layout). Both
start from the labelled rows; in each round both score all unlabelled documents of the corpus, and each gives the other
those it is surest of, so many of each class from every stratum of source and language, as further examples. Each view
is then calibrated on labelled rows kept aside, and a logistic combination of both scores every document. A document is
good if its quality label is 1 and its toxic label is not.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fairground.llm.common import Scratch, concat, drawn, give_back, mix, slices, split_words, text_column

SOURCES, LANGS = 32, 8
#: Bytes of documents that are described at a time.
SLICE = 4 << 20
_NUMBERS = 9


#: Labels up to this many are broadcast to the documents; more are joined by a shuffle of the described rows.
BROADCAST_LABELS = 1_000_000


@dataclass(frozen=True)
class Settings:
    """Bounds of what is gathered to fit, and parameters of the rounds.

    ``labelled`` bounds the labelled rows that are gathered, drawn evenly by a hash of the row, whatever ids they share. In each round every unlabelled
    document is scored by both views, and ``per_stratum`` of each view, class and stratum at most are gathered, those
    it is surest of: at most ``4 * strata * per_stratum`` a round. Scoring takes every document.
    """

    labelled: int = 10_000
    rounds: int = 3
    strata: int = 64
    per_stratum: int = 5
    sure: float = 0.97
    lexicon: int = 768
    least_documents: int = 5
    threshold: float = 0.6


def _hash(strings: pa.Array, salt: int) -> np.ndarray:
    out = mix(pd.util.hash_array(strings.to_numpy(zero_copy_only=False), categorize=False) + np.uint64(salt))
    out[(pc.binary_length(strings).to_numpy(zero_copy_only=False)) == 0] = 0
    return out


def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, offsets - offsets[0]


_KIND = np.zeros(256, np.uint8)
_KIND[[ord(c) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"]] = 1
_KIND[[ord(c) for c in "0123456789"]] = 2
_KIND[[ord(c) for c in "!#$%&*+/<=>@[]\\^_`{|}~"]] = 3
_KIND[10] = 4


class Views:
    """Both views of a slice of documents."""

    def __init__(self, batch):
        texts = concat(batch.column("text"))
        words, self.bounds = split_words(texts)
        coded = words.dictionary_encode()
        self.codes = coded.indices.to_numpy()
        seen = coded.dictionary
        lower = pc.utf8_lower(seen)
        letters = pc.replace_substring_regex(lower, r"[^\p{L}]+", "")
        shouted = pc.and_(pc.equal(seen, pc.utf8_upper(seen)), pc.greater(pc.utf8_length(letters), 2))
        tail = pc.if_else(shouted, "A", pc.replace_substring_regex(seen, r"^.*[\p{L}\p{N}]", ""))
        #: For each distinct word: the word, its first four, five and six letters, and what ends it or that it is in capitals.
        heads = [_hash(pc.utf8_slice_codeunits(letters, 0, n), 10 + n) for n in (4, 5, 6)]
        self.tokens = np.stack([_hash(letters, 1), *heads, _hash(tail, 3)], axis=1)
        self.metadata = self._metadata(texts, batch)

    def _metadata(self, texts: pa.Array, batch) -> np.ndarray:
        raw, cuts = _bytes(texts)
        size = np.diff(cuts)
        kinds = _KIND[raw]
        count = lambda mask: np.diff(np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])[cuts])
        upper, digits, symbols, lines = (count(kinds == k) for k in (1, 2, 3, 4))
        n = np.diff(self.bounds)
        same = np.concatenate([[False], self.codes[1:] == self.codes[:-1]]) if len(self.codes) else np.zeros(0, bool)
        again = np.diff(np.concatenate([[0], np.cumsum(same)])[self.bounds])
        share = lambda x, of: x / np.maximum(of, 1)
        numbers = [np.log1p(size), np.log1p(lines), np.log1p(share(size, lines + 1)), share(upper, size), share(digits, size), share(symbols, size), share(again, n), share(size - n, n) / 10, (n == 0).astype(float)]
        out = np.zeros((len(size), _NUMBERS + SOURCES + LANGS))
        out[:, :_NUMBERS] = np.stack(numbers, axis=1)
        for name, width, at in (("source", SOURCES, _NUMBERS), ("lang", LANGS, _NUMBERS + SOURCES)):
            place = _hash(pc.fill_null(concat(batch.column(name)), ""), 4) % np.uint64(width)
            out[np.arange(len(size)), at + place.astype(np.int64)] = 1
        return out

    def token_lists(self) -> list[np.ndarray]:
        return [np.setdiff1d(self.tokens[np.unique(self.codes[a:b])].ravel(), np.uint64(0)) for a, b in zip(self.bounds[:-1], self.bounds[1:])]

    def lexicon_hits(self, lexicon: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pairs of document and place in the sorted lexicon, each once, and the logarithm of one more than its count."""
        if not len(lexicon) or not len(self.codes):
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        pairs = []
        for tokens in self.tokens.T:  # one kind of token at a time bounds what is held
            place = np.searchsorted(lexicon, tokens).clip(max=len(lexicon) - 1).astype(np.int32)
            place[lexicon[place] != tokens] = -1
            own = place[self.codes]
            at = np.flatnonzero(own >= 0)
            pairs.append((np.searchsorted(self.bounds, at, side="right") - 1) * len(lexicon) + own[at])
        pairs, times = np.unique(np.concatenate(pairs), return_counts=True)
        return pairs // len(lexicon), pairs % len(lexicon), np.log1p(times)


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float, steps: int = 250) -> np.ndarray:
    """Weights (the last is the intercept) of a ridge logistic regression, by accelerated gradient steps."""
    x, y = np.asarray(x, np.float32), y.astype(np.float32)
    # The intercept goes by itself: a column of ones would copy the examples.
    odds = lambda v: x @ v[:-1] + v[-1]
    back = lambda r: np.append(x.T @ r, r.sum())
    w = np.zeros(x.shape[1] + 1, np.float32)
    top = np.ones_like(w)
    for _ in range(20):  # the largest curvature, by power steps
        top = back(odds(top / np.linalg.norm(top))) / len(x)
    v, rate = w.copy(), np.float32(3.5 / max(float(np.linalg.norm(top)), 1e-6))
    penalty = np.full_like(w, ridge)
    penalty[-1] = 0
    for step in range(steps):
        grad = back(1 / (1 + np.exp(-np.clip(odds(v), -30, 30))) - y) / len(x) + penalty * v
        new = v - rate * grad
        v = new + np.float32(step / (step + 3)) * (new - w)
        w = new
    return w


def raw_scores(content: np.ndarray, meta: np.ndarray, metadata: np.ndarray, hits: tuple[np.ndarray, np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Log odds of good by each view, from scaled metadata and pairs of document, place in the lexicon and weight."""
    doc, place, weight = hits
    words = np.bincount(doc, content[place] * weight, minlength=len(metadata)) if len(doc) else np.zeros(len(metadata))
    return content[-1] + words, metadata @ meta[:-1] + meta[-1]


@dataclass
class Model:
    lexicon: np.ndarray
    content: np.ndarray
    centre: np.ndarray
    scale: np.ndarray
    metadata: np.ndarray
    #: slope and intercept of each view's calibration, and weights of both with an intercept.
    calibration: np.ndarray
    combination: np.ndarray
    threshold: float

    def scores(self, metadata: np.ndarray, hits: tuple[np.ndarray, np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Probability of good by words, by metadata and by both."""
        return self.combine(*raw_scores(self.content, self.metadata, (metadata - self.centre) / self.scale, hits))

    def combine(self, content, metadata):
        a, b = (self.calibration[i, 0] * np.clip(s, -8, 8) + self.calibration[i, 1] for i, s in enumerate((content, metadata)))
        both = np.stack([a, b], axis=1) @ self.combination[:2] + self.combination[2]
        return tuple(1 / (1 + np.exp(-np.clip(s, -30, 30))) for s in (a, b, both))


def marks_of(labels: DataFrame) -> DataFrame:
    """``doc_id, good`` of each labelled id; one labelled twice is good only if both say so."""
    return labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((F.min(F.when((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0), 1).otherwise(0))).alias("good"))


def plain_rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_column(docs), F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"))


def choose_lexicon(sample: DataFrame, settings: Settings) -> np.ndarray:
    """The tokens that tell good from bad best among the labelled rows, by chi-squared; sorted."""

    def tokens(batches):
        for batch in slices(batches, SLICE):
            lists = Views(batch).token_lists()
            good = np.repeat(batch.column("good").to_numpy(zero_copy_only=False), [len(x) for x in lists])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(lists).view(np.int64)), pa.array(good.astype(np.int32))], ["token", "good"])

    totals = sample.groupBy("good").count().toPandas().set_index("good")["count"]
    goods, total = float(totals.get(1, 0)), float(totals.sum())
    counts = sample.mapInArrow(tokens, "token long, good int").groupBy("token").agg(F.sum("good").alias("with_good"), F.count("*").alias("seen")).where(F.col("seen") >= settings.least_documents)
    share, seen = goods / max(total, 1), F.col("seen")
    spread = F.greatest(seen * share * (1 - share) * (1 - seen / max(total, 1)), F.lit(1e-9))
    ranked = counts.withColumn("chi", (F.col("with_good") - seen * share) ** 2 / spread).where("chi >= 10")
    best = ranked.orderBy(F.desc("chi"), "token").limit(settings.lexicon).toPandas()
    return np.sort(best["token"].to_numpy(np.int64).view(np.uint64))


FEATURES = "metadata array<float>, places array<int>, weights array<float>"


def describe(docs: DataFrame, marks: DataFrame, many: int, lexicon: np.ndarray, settings: Settings) -> DataFrame:
    """Every document in numbers: ``row`` (a key), ``doc_id``, ``good`` (null if unlabelled), ``stratum`` and its features."""
    held = docs.sparkSession.sparkContext.broadcast(lexicon)

    def numbers(batches):
        for batch in slices(batches, SLICE):
            views = Views(batch)
            doc, place, weight = views.lexicon_hits(held.value)
            cuts = np.searchsorted(doc, np.arange(batch.num_rows + 1)).astype(np.int32)
            places, weights = (pa.ListArray.from_arrays(pa.array(cuts), pa.array(x)) for x in (place.astype(np.int32), weight.astype(np.float32)))
            metadata = pa.ListArray.from_arrays(pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * views.metadata.shape[1]), pa.array(views.metadata.astype(np.float32).ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("stratum"), metadata, places, weights], ["doc_id", "stratum", "metadata", "places", "weights"])

    stratum = F.pmod(F.xxhash64("source", "lang"), F.lit(settings.strata)).cast("int").alias("stratum")
    blank = [F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source")]
    rows = plain_rows(docs).select("doc_id", "text", *blank, stratum).mapInArrow(numbers, f"doc_id long, stratum int, {FEATURES}")
    known = rows.join(F.broadcast(marks) if many <= BROADCAST_LABELS else marks, "doc_id", "left")
    return known.withColumn("row", F.monotonically_increasing_id())


@dataclass
class Examples:
    """Rows with their metadata, and their words as a matrix over the lexicon."""

    row: np.ndarray
    metadata: np.ndarray
    words: np.ndarray
    label: np.ndarray

    @staticmethod
    def of(table: pa.Table, lexicon: int, label: str) -> Examples:
        table = table.sort_by("row").combine_chunks()
        metadata = concat(table.column("metadata")).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(table.num_rows, -1) if table.num_rows else np.zeros((0, _NUMBERS + SOURCES + LANGS))
        words = np.zeros((table.num_rows, lexicon), np.float32)
        doc, place, weight = stored_hits(table)
        words[doc, place] = weight
        return Examples(table.column("row").to_numpy(), metadata, words, table.column(label).to_numpy().astype(float))

    def take(self, at: np.ndarray) -> Examples:
        return Examples(self.row[at], self.metadata[at], self.words[at], self.label[at])

    def seen_by(self, view: int) -> Examples:
        """What one view is fitted on: the words (0) or the metadata (1)."""
        none = np.zeros((len(self.row), 0), np.float32)
        return Examples(self.row, self.metadata if view else none, none if view else self.words, self.label)

    def __add__(self, other: Examples) -> Examples:
        return Examples(*(np.concatenate([getattr(self, n), getattr(other, n)]) for n in ("row", "metadata", "words", "label")))


def stored_hits(rows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of document and place, with weights, of described rows."""
    places, weights = concat(rows.column("places")), concat(rows.column("weights"))
    doc = np.repeat(np.arange(len(places)), places.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)) if len(places) else np.zeros(0, np.int64)
    return doc, places.flatten().to_numpy(zero_copy_only=False), weights.flatten().to_numpy(zero_copy_only=False)


def surest(features: DataFrame, content: np.ndarray, meta: np.ndarray, centre: np.ndarray, scale: np.ndarray, taken: np.ndarray, settings: Settings) -> pa.Table:
    """Of all unlabelled rows, those a view is surest of: at most ``per_stratum`` of each view, class and stratum.

    A batch keeps its own best before anything is sent on; ``taken`` rows were chosen before.
    """
    held = features.sparkSession.sparkContext.broadcast((content, meta, centre, scale, taken))
    names = ["row", "stratum", "metadata", "places", "weights"]

    def choose(batches):
        content, meta, centre, scale, taken = held.value
        for batch in batches:
            metadata = concat(batch.column("metadata")).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(batch.num_rows, len(centre))
            odds = raw_scores(content, meta, (metadata - centre) / scale, stored_hits(batch))
            stratum, fresh = batch.column("stratum").to_numpy(), ~np.isin(batch.column("row").to_numpy(), taken)
            for view, score in enumerate(odds):
                p = 1 / (1 + np.exp(-np.clip(score, -30, 30)))
                for k, sure in ((1, p), (0, 1 - p)):
                    at = np.flatnonzero(fresh & (sure >= settings.sure))
                    at = at[np.lexsort((-sure[at], stratum[at]))]
                    first = np.searchsorted(stratum[at], stratum[at])
                    at = at[np.arange(len(at)) - first < settings.per_stratum]
                    own = batch.take(pa.array(at))
                    extra = [pa.array(np.full(len(at), view, np.int32)), pa.array(np.full(len(at), k, np.int32)), pa.array(sure[at])]
                    yield pa.RecordBatch.from_arrays([*(own.column(n) for n in names), *extra], [*names, "view", "class", "sure"])

    picked = features.where("good is null").select(*names).mapInArrow(choose, f"row long, stratum int, {FEATURES}, view int, class int, sure double")
    order = Window.partitionBy("view", "class", "stratum").orderBy(F.desc("sure"), "row")
    return picked.withColumn("n", F.row_number().over(order)).where(F.col("n") <= settings.per_stratum).drop("n").toArrow()


def co_train(features: DataFrame, lexicon: np.ndarray, settings: Settings) -> Model | None:
    """Fit the model on described rows; None if the labels do not hold both classes."""
    told = features.where("good is not null").select("row", "good", "metadata", "places", "weights")
    # Rows are drawn, not ids: many may share a labelled one.
    known = Examples.of(told.where(drawn(settings.labelled / max(told.count(), 1), "row")).toArrow(), len(lexicon), "good")
    both = lambda y: len(np.unique(y)) == 2
    if not both(known.label):
        return None
    aside = np.arange(len(known.label)) % 4 == 0
    if both(known.label[aside]) and both(known.label[~aside]):
        kept, given = known.take(aside), known.take(~aside)
    else:
        kept = given = known
    centre, scale = known.metadata.mean(0), np.maximum(known.metadata.std(0), 0.05)
    # Each view has its own examples: the given ones, then those that the other view was sure of.
    own = [given.seen_by(view) for view in (0, 1)]
    del known, given
    for step in range(settings.rounds + 1):
        content = fit_logistic(own[0].words, own[0].label, 3e-4).astype(float)
        meta = fit_logistic((own[1].metadata - centre) / scale, own[1].label, 1e-3).astype(float)
        if step == settings.rounds:
            break
        taken = np.unique(np.concatenate([x.row for x in own]))
        found = surest(features, content, meta, centre, scale, taken, settings)
        views = found.column("view").to_numpy()
        for view, other in ((0, 1), (1, 0)):
            own[other] = own[other] + Examples.of(found.filter(pa.array(views == view)), len(lexicon), "class").seen_by(other)
    del own
    raw = [kept.words @ content[:-1] + content[-1], (kept.metadata - centre) / scale @ meta[:-1] + meta[-1]]
    calibration = np.stack([fit_logistic(np.clip(s, -8, 8)[:, None], kept.label, 1e-3) for s in raw])
    sides = np.stack([c[0] * np.clip(s, -8, 8) + c[1] for c, s in zip(calibration, raw)], axis=1)
    combination = fit_logistic(sides, kept.label, 1e-3)
    del kept
    give_back()
    return Model(lexicon, content, centre, scale, meta, calibration.astype(float), combination.astype(float), settings.threshold)


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> tuple[Model | None, DataFrame]:
    """The model, and all documents described in numbers: texts are taken apart once, the rounds read the numbers."""
    scratch = Scratch(docs.sparkSession, "quality")
    marks = scratch.table("marks", marks_of(labels))
    many = marks.count()
    some = marks.where(drawn(settings.labelled / max(many, 1), "doc_id"))
    sample = scratch.table("sample", plain_rows(docs).join(F.broadcast(some), "doc_id"))
    lexicon = choose_lexicon(sample, settings)
    features = scratch.table("features", describe(docs, marks, many, lexicon, settings))
    scratch.drop("sample")
    return co_train(features, lexicon, settings), features


def _view_batch(batch) -> pa.RecordBatch:
    names = ["text", "lang", "source"]
    return pa.RecordBatch.from_arrays([pc.fill_null(concat(batch.column(n)).cast(pa.string()), "") for n in names], names)


def score_documents(spark: SparkSession, docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``doc_id, score, content_score, metadata_score, keep`` of every document; scores are probabilities of good.

    Null and empty texts have no words and are scored by what is left; long texts are read whole. Null source or
    language is a value of its own. Labels of no document are ignored; a document labelled twice is good only if both
    say so, and rows that share a labelled id share its label. Without labels of both classes nothing can be learned:
    all scores are 0.5 and all documents are kept. Repeated rows are scored alike; equally sure rows are chosen in
    stored order; other columns are ignored; an empty table gives no rows.
    """
    model, features = fit(docs, labels, settings)
    held = spark.sparkContext.broadcast(model)

    def score(batches):
        model = held.value
        for batch in batches:
            if model:
                metadata = concat(batch.column("metadata")).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(batch.num_rows, len(model.centre))
                content, meta, both = model.scores(metadata, stored_hits(batch))
            else:
                content = meta = both = np.full(batch.num_rows, 0.5)
            keep = both >= (model.threshold if model else 0)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(x) for x in (both, content, meta, keep))], ["doc_id", "score", "content_score", "metadata_score", "keep"])

    return features.select("doc_id", "metadata", "places", "weights").mapInArrow(score, "doc_id long, score double, content_score double, metadata_score double, keep boolean")


def keep_good(spark: SparkSession, docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The documents, all columns as they are, that the classifier does not reject.

    Nulls, empty and long texts, repeated rows, doubtful labels and empty tables are taken as in ``score_documents``:
    every row stays or goes by its own score, and repeated rows alike.
    """
    held = spark.sparkContext.broadcast(fit(docs, labels, settings)[0])

    def filtered(batches):
        model = held.value
        for batch in slices(batches, SLICE):
            if model:
                views = Views(_view_batch(batch))
                # As stored for the fit: in single precision.
                doc, place, weight = views.lexicon_hits(model.lexicon)
                batch = batch.filter(pa.array(model.scores(views.metadata.astype(np.float32).astype(float), (doc, place, weight.astype(np.float32)))[2] >= model.threshold))
            yield batch

    return docs.mapInArrow(filtered, docs.schema)
