"""Approximate nearest neighbours with learned partitions.

On a bounded sample the nearest-neighbour graph is cut into balanced parts (recursive bisection with refinement), and a
small softmax classifier learns to tell a vector's part. Every vector is filed under its most probable part; a query is
routed to the most probable parts and compared exactly with all vectors filed there. Where one classifier would have
too many parts to tell apart, each of its parts is divided again by a classifier of its own.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fairground.llm.common import Scratch, concat, drawn


@dataclass(frozen=True)
class Settings:
    """``sample`` bounds the vectors that one classifier is learned from, drawn by a hash of the id; all vectors are filed.

    ``n`` vectors are filed in about ``parts_factor * sqrt(n)`` parts; a classifier tells ``most_parts`` apart, and a
    second level divides each of them. A query goes to its most probable parts until their probabilities reach a mass:
    the least one with which queries kept aside find ``recall`` of their neighbours in the sample. Vectors of one of
    the ``widths`` most common lengths have classifiers; those of any other length are one part a length.
    """

    sample: int = 8192
    neighbours: int = 12
    parts_factor: float = 0.2
    most_parts: int = 256
    recall: float = 0.96
    least_probes: int = 2
    widths: int = 8
    block: int = 4096
    query_block: int = 1024


def unit(v: np.ndarray) -> np.ndarray:
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` nearest others of each unit vector, found in blocks."""
    out = np.empty((len(x), min(k, len(x) - 1)), np.int64)
    for at in range(0, len(x), 1024):
        near = x[at : at + 1024] @ x.T
        near[np.arange(len(near)), np.arange(at, at + len(near))] = -np.inf
        out[at : at + 1024] = np.argpartition(-near, out.shape[1] - 1, axis=1)[:, : out.shape[1]]
    return out


def bisect(n: int, a: np.ndarray, b: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Halves of ``n`` nodes with few of the edges ``a-b`` between them: a spectral cut at the median, then swaps."""
    degree = np.maximum(np.bincount(a, minlength=n) + np.bincount(b, minlength=n), 1).astype(float)
    root = np.sqrt(degree)
    trivial = root / np.linalg.norm(root)
    v = rng.standard_normal(n)
    for _ in range(40):
        v -= trivial * (trivial @ v)
        s = v / root
        v = v + (np.bincount(a, s[b], n) + np.bincount(b, s[a], n)) / root
        v /= max(np.linalg.norm(v), 1e-12)
    side = np.zeros(n, bool)
    side[np.argsort(v / root, kind="stable")[n // 2 :]] = True
    for _ in range(4):
        cut = (side[a] != side[b]).astype(float)
        outside = np.bincount(a, cut, n) + np.bincount(b, cut, n)
        gain = 2 * outside - degree
        left, right = (nodes[np.argsort(-gain[nodes], kind="stable")] for nodes in (np.flatnonzero(~side), np.flatnonzero(side)))
        m = min(len(left), len(right))
        better = int(np.argmin(np.append(gain[left[:m]] + gain[right[:m]] > 0, False)))
        if not better:
            break
        # Swapping all at once overshoots; half of the gainful pairs settle in a few rounds.
        half = (better + 1) // 2
        side[left[:half]], side[right[:half]] = True, False
    return side


def balanced_parts(near: np.ndarray, parts: int, rng: np.random.Generator) -> np.ndarray:
    """A part below ``parts`` (a power of two) for every node of the graph; sizes differ by one a level at most."""
    n = len(near)
    a, b = np.repeat(np.arange(n), near.shape[1]), near.ravel()
    part = np.zeros(n, np.int64)
    size = 1
    while size < parts:
        new = part * 2
        local = np.empty(n, np.int64)
        for p in range(size):
            nodes = np.flatnonzero(part == p)
            local[nodes] = np.arange(len(nodes))
            inside = (part[a] == p) & (part[b] == p)
            new[nodes] += bisect(len(nodes), local[a[inside]], local[b[inside]], rng)
        part, size = new, size * 2
    return part


def fit_softmax(x: np.ndarray, target: np.ndarray, rng: np.random.Generator, steps: int = 600, batch: int = 1024) -> np.ndarray:
    """Weights (the last row is the intercept) that fit the rows of ``target`` as class probabilities, by Adam."""
    x = np.hstack([x, np.ones((len(x), 1))]).astype(np.float32)
    w = np.zeros((x.shape[1], target.shape[1]), np.float32)
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, steps + 1):
        rows = rng.integers(0, len(x), min(batch, len(x)))
        p = softmax(x[rows] @ w)
        g = x[rows].T @ (p - target[rows]) / len(rows) + 1e-6 * w
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= np.float32(0.15 * (1 - step / (steps + 1))) * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return w


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


@dataclass(frozen=True)
class Node:
    """A classifier, the mass that its probes must reach, and the classifiers of its parts that are divided again."""

    weights: np.ndarray
    mass: float
    inner: dict[int, "Node"]

    def file(self, v: np.ndarray, most: int) -> np.ndarray:
        """The part of each vector."""
        outer = probabilities(v, self.weights).argmax(axis=1)
        part = outer * most
        for p, node in self.inner.items():
            own = outer == p
            if own.any():
                part[own] += probabilities(v[own], node.weights).argmax(axis=1)
        return part

    def route(self, v: np.ndarray, most: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of a vector's place and a part to search for it."""
        row, outer = probes(probabilities(v, self.weights), self.mass, least)
        divided = np.isin(outer, list(self.inner))
        rows, parts = [row[~divided]], [outer[~divided] * most]
        for p, node in self.inner.items():
            own = row[outer == p]
            if len(own):
                at, inner = probes(probabilities(v[own], node.weights), node.mass, least)
                rows.append(own[at])
                parts.append(p * most + inner)
        return np.concatenate(rows), np.concatenate(parts)


def probes(p: np.ndarray, mass: float, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the most probable parts, until ``mass`` is reached and ``least`` of them are taken."""
    order = np.argsort(-p, axis=1, kind="stable")
    sorted_p = np.take_along_axis(p, order, axis=1)
    row, nth = np.nonzero((np.cumsum(sorted_p, axis=1) - sorted_p < mass) | (np.arange(p.shape[1]) < least))
    return row, order[row, nth]


def learn(sample: np.ndarray, parts: int, settings: Settings, levels: int = 1, k: int = 5) -> Node:
    """A classifier whose targets are the parts of a vector and of its neighbours, and its mass.

    An eighth of the sample is kept aside as queries. With too few vectors for ``parts`` there are fewer.
    """
    x, rng = unit(sample), np.random.default_rng(7)
    while parts > 1 and len(x) < 8 * parts:
        parts //= 2
    if parts == 1:
        return Node(np.zeros((x.shape[1] + 1, 1), np.float32), 1.0, {})
    aside = np.arange(len(x)) % 8 == 3
    known, asked = x[~aside], x[aside]
    near = neighbour_graph(known.astype(np.float32), settings.neighbours)
    part = balanced_parts(near, parts, rng)
    target = np.zeros((len(known), parts), np.float32)
    np.add.at(target, (np.arange(len(known)), part), 1.0)
    for j in range(near.shape[1]):
        np.add.at(target, (np.arange(len(known)), part[near[:, j]]), 1.0)
    weights = fit_softmax(known, target / target.sum(axis=1, keepdims=True), rng)
    filed = probabilities(known, weights).argmax(axis=1)
    close = asked @ known.T
    found = filed[np.argpartition(-close, k - 1, axis=1)[:, :k]]
    p = probabilities(asked, weights)
    # How much of the mass lies before the part of each neighbour: the mass that a query needs to reach it.
    order = np.argsort(-p, axis=1, kind="stable")
    sorted_p = np.take_along_axis(p, order, axis=1)
    before = np.empty_like(p)
    np.put_along_axis(before, order, np.cumsum(sorted_p, axis=1) - sorted_p, axis=1)
    needed = np.sort(np.take_along_axis(before, found, axis=1).ravel())
    mass = needed[min(len(needed) - 1, int(np.ceil(settings.recall ** (1 / levels) * len(needed))))]
    return Node(weights, float(mass) + 1e-9, {})


def probabilities(v: np.ndarray, w: np.ndarray) -> np.ndarray:
    return softmax(unit(v) @ w[:-1] + w[-1])


def matrix(column: pa.Array, width: int) -> np.ndarray:
    return concat(column).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def usable(rows: DataFrame, vector: str) -> DataFrame:
    """Rows whose vector is neither null nor zero nor holds a null or non-finite component."""
    v = F.col(vector)
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return rows.where(v.isNotNull() & fine & F.exists(v, lambda x: x != 0))


def _power(n: float) -> int:
    return 1 << max(0, int(max(n, 1)).bit_length() - 1)


def _widths(batch):
    """The rows of each width and their vectors."""
    widths = batch.column("w").to_numpy()
    for w in np.unique(widths).tolist():
        at = np.flatnonzero(widths == w)
        yield w, at, matrix(batch.column("v").take(pa.array(at)), w)


def classifiers(data: DataFrame, counts: dict[int, int], settings: Settings) -> dict[int, Node]:
    """The classifier of each of the most common widths, from bounded samples of ``data(id, v, w)``."""
    out = {}
    rows = lambda frame, w: np.unique(np.array(frame.toPandas()["v"].to_list(), np.float64).reshape(-1, w), axis=0)
    for w in sorted(counts, key=lambda w: (-counts[w], w))[: settings.widths]:
        total, own = counts[w], data.where(F.col("w") == w)
        wanted = _power(settings.parts_factor * total**0.5)
        # By id and vector: of many vectors under one id the same share is drawn, and copies of one vector count once.
        sample = rows(own.where(drawn(settings.sample / total, "id", "v")).select("v").distinct(), w)
        if not len(sample):
            continue
        levels = 1 if wanted <= settings.most_parts else 2
        out[w] = learn(sample[np.random.default_rng(1).permutation(len(sample))[: settings.sample]], min(wanted, settings.most_parts), settings, levels)
        if levels == 2:
            out[w] = Node(out[w].weights, out[w].mass, divide(own, out[w], w, wanted / total, settings))
    return out


def divide(data: DataFrame, node: Node, w: int, parts_per_row: float, settings: Settings) -> dict[int, Node]:
    """Classifiers inside the parts of ``node``, each learned in a task of its own from a sample of its part."""

    def file(batches):
        for batch in batches:
            if batch.num_rows:
                part = Node(node.weights, node.mass, {}).file(matrix(batch.column("v"), w), 1)
                yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("v"), pa.array(part.astype(np.int32))], ["id", "v", "outer"])

    filed = data.select("id", "v").mapInArrow(file, "id long, v array<double>, outer int")
    counts = {r["outer"]: r["count"] for r in filed.groupBy("outer").count().collect()}  # at most most_parts rows
    share = F.create_map(*(F.lit(x) for p, n in counts.items() for x in (p, min(1.0, settings.sample / n))))[F.col("outer")]
    some = filed.where(F.xxhash64("id", "v", F.lit(2)).bitwiseAND((1 << 62) - 1) < share * float(1 << 62)).select("outer", "v").distinct()

    def fit(table: pa.Table) -> pa.Table:
        p = table.column("outer")[0].as_py()
        own = np.unique(matrix(table.column("v"), w), axis=0)
        inner = learn(own[np.random.default_rng(p).permutation(len(own))[: settings.sample]], min(settings.most_parts, _power(parts_per_row * counts[p])), settings, 2)
        return pa.table({"outer": pa.array([p], pa.int32()), "parts": pa.array([inner.weights.shape[1]], pa.int32()), "mass": pa.array([inner.mass]), "weights": pa.array([inner.weights.astype(np.float32).tobytes()], pa.binary())})

    fitted = some.groupBy("outer").applyInArrow(fit, "outer int, parts int, mass double, weights binary")
    return {r["outer"]: Node(np.frombuffer(r["weights"], np.float32).reshape(-1, r["parts"]), r["mass"], {}) for r in fitted.collect() if r["parts"] > 1}


def nearest(spark: SparkSession, rows: DataFrame, is_query: Column, k: int = 5, key: str = "vec_id", vector: str = "embedding", settings: Settings = Settings()) -> DataFrame:
    """``query_id, rank, vec_id, score``: of each query row the ``k`` nearest other rows found, by cosine.

    Ranks start at 1; ties go to the smaller id. Scores are cosines of the vectors as stored, in double precision.
    Null vectors, zero vectors and vectors with a null or non-finite component take no part, nor do rows without an
    id; vectors are compared with those of their own length. Rows that share an id and a vector are one. With fewer
    candidates all are returned; an empty table gives no rows. Other columns are ignored.

    Equal vectors are filed once, with the ``k + 1`` smallest ids that hold them, which is all that any query can need;
    equal queries are searched once. Parts are compared in blocks of bounded size, whatever their number of rows.
    """
    scratch = Scratch(spark, "ann")
    data = usable(rows.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"), is_query.alias("q")), "v").where("id is not null").withColumn("w", F.size("v"))
    counts = {r["w"]: r["count"] for r in data.groupBy("w").count().collect()}  # one row a length
    if not counts:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    models = spark.sparkContext.broadcast(classifiers(data, counts, settings))
    most, least = settings.most_parts, settings.least_probes

    rank_in = Window.partitionBy("v").orderBy("id")
    filed = data.select("id", "v", "w").withColumn("n", F.dense_rank().over(rank_in)).where(F.col("n") <= k + 1).groupBy("w", "v").agg(F.array_sort(F.collect_set("id")).alias("ids"))
    asked = data.where("q").groupBy("w", "v").agg(F.min("id").alias("query"))

    def file(batches):
        for batch in batches:
            part = np.zeros(batch.num_rows, np.int32)
            for w, at, v in _widths(batch):
                if w in models.value:
                    part[at] = models.value[w].file(v, most)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(part)], [*batch.schema.names, "part"])

    def route(batches):
        for batch in batches:
            for w, at, v in _widths(batch):
                row, part = models.value[w].route(v, most, least) if w in models.value else (np.arange(len(at)), np.zeros(len(at), np.int64))
                taken = batch.take(pa.array(at[row]))
                yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(part.astype(np.int32))], [*batch.schema.names, "part"])

    index = scratch.table("index", filed.mapInArrow(file, "w int, v array<double>, ids array<long>, part int"))
    routed = scratch.table("routed", asked.mapInArrow(route, "w int, v array<double>, query long, part int"))
    # One row a part tells how many blocks it is compared in.
    parts = ["w", "part"]
    blocks = index.groupBy(*parts).agg(F.ceil(F.count("*") / settings.block).cast("int").alias("c_blocks")).join(routed.groupBy(*parts).agg(F.ceil(F.count("*") / settings.query_block).cast("int").alias("q_blocks")), parts)
    dealt = lambda n, *of: F.pmod(F.xxhash64(*of), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    candidates = index.join(F.broadcast(blocks), parts).withColumn("c", dealt("c_blocks", "ids")).withColumn("b", each("q_blocks")).select(*parts, "c", "b", "ids", "v")
    queries = routed.join(F.broadcast(blocks), parts).withColumn("b", dealt("q_blocks", "query")).withColumn("c", each("c_blocks")).select(*parts, "c", "b", "query", "v")

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        found = ([], [], [])
        if left.num_rows and right.num_rows:
            width = left.column("w")[0].as_py()
            raw_q, raw_c = matrix(left.column("v"), width), matrix(right.column("v"), width)
            lists = concat(right.column("ids"))
            ids, cuts = lists.flatten().to_numpy(), np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
            near = unit(raw_q) @ unit(raw_c).T
            take = min(k + 1, near.shape[1])
            # All that may be as near as the last one wanted: among equals the ids decide.
            worst = -np.partition(-near, take - 1, axis=1)[:, take - 1] - 1e-9
            for i, query in enumerate(left.column("query").to_pylist()):
                rows = np.flatnonzero(near[i] >= worst[i])
                # The product above only picks; the score is summed the same way wherever the vector lies.
                score = (raw_q[i] * raw_c[rows]).sum(axis=1) / np.sqrt((raw_q[i] ** 2).sum() * (raw_c[rows] ** 2).sum(axis=1))
                own = np.concatenate([ids[cuts[r] : cuts[r + 1]] for r in rows])
                scores = np.repeat(score, np.diff(cuts)[rows])
                first = np.lexsort((own, -scores))[: k + 1]
                found[0].extend([query] * len(first))
                found[1].extend(own[first].tolist())
                found[2].extend(scores[first].tolist())
        return pa.table({"query": pa.array(found[0], pa.int64()), "vec_id": pa.array(found[1], pa.int64()), "score": pa.array(found[2], pa.float64())})

    met = queries.groupBy(*parts, "c", "b").cogroup(candidates.groupBy(*parts, "c", "b")).applyInArrow(compare, "query long, vec_id long, score double")
    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    top = scratch.table("top", met.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 1).drop("n"))
    scratch.drop("index", "routed")
    # Every row that asked gets the answers of its vector, without itself.
    who = data.where("q").select("id", "v").join(asked, "v").select(F.col("id").alias("query_id"), "query").distinct()
    ranks = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    out = who.join(top, "query").where("query_id <> vec_id").withColumn("rank", F.row_number().over(ranks)).where(F.col("rank") <= k)
    return out.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
