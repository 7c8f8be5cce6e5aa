"""Names of places in free text: many names at once, the leftmost longest match, whole words, ambiguity told."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from fairground.config import DEFAULT, Settings
from fairground.functions import text as T
from fairground.operators import places

#: Names up to which they go to every worker as one trie (some 100 bytes a word); more are joined.
BROADCAST_NAMES = 200_000
#: Texts that a task takes apart at a time.
SLICE = 4096


def words_line(c: Column) -> Column:
    """The words of a text without case and accents, one blank between them."""
    return F.trim(F.regexp_replace(T.fold(F.coalesce(c.cast("string"), F.lit(""))), r"[^\p{L}\p{N}_]+", " "))


def dictionary(names: DataFrame, name: str = "nome", place: str = "comune") -> DataFrame:
    """``nome, comuni``: each name once, in words, with all places it may mean; names without a word drop out."""
    return names.select(words_line(F.col(name)).alias("nome"), F.col(place).cast("string").alias("_c")).where("nome <> ''").groupBy("nome").agg(F.array_sort(F.collect_set("_c")).alias("comuni"))


def names_of(comuni: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """The names and aliases of the active municipalities, and known places (``nome, comune``) in them."""
    active = comuni.where("attivo = 'si'")
    out = active.select(F.col("comune").alias("nome"), "comune").unionByName(active.select(F.explode(F.split(F.coalesce("alias", F.lit("")), ";")).alias("nome"), "comune"))
    return dictionary(out if known is None else out.unionByName(known.select("nome", "comune")))


class Trie:
    """Names as a trie over word codes, in flat arrays: edges sorted by node and word, and the name that ends at a node."""

    def __init__(self, names: list[str]):
        split = [n.split(" ") for n in names]
        self.words = pa.array(sorted({w for n in split for w in n}), pa.string())
        code = {w: i for i, w in enumerate(self.words.to_pylist())}
        edges: dict[tuple[int, int], int] = {}
        ends: dict[int, int] = {}
        for i, name in enumerate(split):
            node = 0
            for w in name:
                node = edges.setdefault((node, code[w]), len(edges) + 1)
            ends[node] = i
        self.depth, self.width = max(map(len, split), default=0), max(1, len(code))
        keys = np.array([a * self.width + w for a, w in edges], np.int64)
        order = np.argsort(keys)
        self.keys, self.child = keys[order], np.array(list(edges.values()), np.int64)[order]
        self.ends = np.full(len(edges) + 1, -1, np.int64)
        for node, i in ends.items():
            self.ends[node] = i

    def longest(self, words: pa.Array, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places at which a name begins, the number of words of the longest there, and which; ``text`` numbers each word's text."""
        codes = pc.index_in(words, value_set=self.words).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        at = np.flatnonzero(codes >= 0)
        node, begin = np.zeros(len(at), np.int64), at
        size, name = np.zeros(len(codes), np.int64), np.full(len(codes), -1, np.int64)
        for depth in range(self.depth):
            here = begin + depth
            inside = here < len(codes)
            begin, node, here = begin[inside], node[inside], here[inside]
            same = (text[here] == text[begin]) & (codes[here] >= 0)
            begin, node, here = begin[same], node[same], here[same]
            key = node * self.width + codes[here]
            found = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            on = self.keys[found] == key
            begin, node = begin[on], self.child[found[on]]
            full = self.ends[node] >= 0
            size[begin[full]], name[begin[full]] = depth + 1, self.ends[node[full]]
            if not len(begin):
                break
        starts = np.flatnonzero(size)
        return starts, size[starts], name[starts]


def leftmost(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Which matches stay: from the left, each that begins behind the one before."""
    kept, end = np.zeros(len(starts), bool), -1
    for i, (a, n) in enumerate(zip(starts.tolist(), sizes.tolist())):
        if a >= end:
            kept[i], end = True, a + n
    return kept


def mentions(rows: DataFrame, keys: list[str], text: str, names: DataFrame) -> DataFrame:
    """``*keys, inizio, parole, nome, comuni, ambiguo`` of each name of ``names`` (a ``dictionary``) in a text.

    Names are found as whole words; of names that begin at one word the longest counts, and what it covers begins none.
    ``inizio`` numbers words from 0. Null and empty texts hold none. Each text is read once, whatever the number of names:
    up to ``BROADCAST_NAMES`` by a trie, beyond it by a join of its word runs, as long as the longest name, with the names.
    """
    lines = rows.select(*keys, words_line(F.col(text)).alias("_line"))
    known = [tuple(r) for r in names.select("nome").limit(BROADCAST_NAMES + 1).collect()]
    kept = [*(rows.schema[k] for k in keys), StructField("inizio", IntegerType()), StructField("parole", IntegerType()), StructField("nome", StringType())]
    if not known:
        found = rows.sparkSession.createDataFrame([], StructType(kept))
    elif len(known) <= BROADCAST_NAMES:
        trie, plain = Trie(sorted(n for (n,) in known)), sorted(n for (n,) in known)

        def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            label = pa.array(plain, pa.string())
            for whole in batches:
                for at in range(0, whole.num_rows, SLICE):
                    batch = whole.slice(at, SLICE)
                    lists = pc.split_pattern(batch.column(len(keys)), " ")
                    bounds = lists.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
                    bounds = bounds - bounds[0]
                    of = np.repeat(np.arange(batch.num_rows), np.diff(bounds))
                    starts, sizes, which = trie.longest(lists.flatten(), of)
                    keep = leftmost(starts, sizes)
                    starts, sizes, which = starts[keep], sizes[keep], which[keep]
                    row = of[starts]
                    columns = [batch.column(i).take(pa.array(row)) for i in range(len(keys))]
                    yield pa.RecordBatch.from_arrays([*columns, pa.array((starts - bounds[row]).astype(np.int32)), pa.array(sizes.astype(np.int32)), label.take(pa.array(which))], [*keys, "inizio", "parole", "nome"])

        found = lines.mapInArrow(find, StructType(kept))
    else:
        found = joined(lines, keys, names)
    return found.join(names, "nome").select(*keys, "inizio", "parole", "nome", "comuni", (F.size("comuni") > 1).alias("ambiguo"))


def joined(lines: DataFrame, keys: list[str], names: DataFrame) -> DataFrame:
    """The matches by a join: every run of words as long as a name may be, then the leftmost longest of each text in one fold."""
    longest = names.agg(F.max(F.size(F.split("nome", " ")))).first()[0]
    numbered = lines.where("_line <> ''").withColumns({"_row": F.monotonically_increasing_id(), "_w": F.split("_line", " ")})
    runs = F.transform(F.sequence(F.lit(1), F.least(F.lit(longest), F.size("_w") - F.col("_i"))), lambda n: F.struct(n.alias("parole"), F.array_join(F.slice("_w", F.col("_i") + 1, n), " ").alias("nome")))
    each = numbered.select(*keys, "_row", "_w", F.posexplode("_w").alias("_i", "_first")).select(*keys, "_row", F.col("_i").alias("inizio"), F.inline(runs))
    met = each.join(names.select("nome"), "nome")
    ordered = F.array_sort(F.collect_list(F.struct("inizio", (-F.col("parole")).alias("_less"), "nome")))
    texts = met.groupBy("_row", *keys).agg(ordered.alias("_m"))
    kind = "array<struct<inizio: int, parole: int, nome: string>>"
    fold = F.expr(f"aggregate(_m, struct(cast(0 as int) as fine, cast(array() as {kind}) as out), (a, m) -> if(m.inizio >= a.fine, struct(m.inizio - m._less as fine, array_append(a.out, struct(m.inizio as inizio, -m._less as parole, m.nome as nome)) as out), a)).out")
    return texts.select(*keys, F.inline(fold))


def place_in_text(rows: DataFrame, key: str, text: str, names: DataFrame) -> DataFrame:
    """``key, comune`` of texts that name a place: of the names that mean one place alone the longest, the first of them."""
    found = mentions(rows, [key], text, names).where("not ambiguo")
    return found.groupBy(key).agg(F.max_by(F.element_at("comuni", 1), F.struct("parole", (-F.col("inizio")).alias("_at"))).alias("comune"))


def resolve_places(rows: DataFrame, key: str, keys: DataFrame, names: DataFrame, text: str, source: Column, category: Column, settings: Settings = DEFAULT) -> DataFrame:
    """``places.resolve_places`` with a step between text and source: a place that the text names among other words."""
    said = place_in_text(rows, key, text, names).select(F.col(key).alias("_id"), F.col("comune").alias("_said"))
    whole = keys.select(F.col("place_key").alias("_whole"))
    out = rows.join(said, F.col(key) == F.col("_id"), "left").join(whole, T.name_key(F.col(text)) == F.col("_whole"), "left")
    told = F.when(F.col("_whole").isNotNull(), F.col(text)).otherwise(F.coalesce("_said", F.col(text)))
    return places.resolve_places(out.withColumn("_told", told), keys, F.col("_told"), source, category, settings).drop("_id", "_said", "_whole", "_told")


