"""Nearest vectors by cosine: a forest of random-projection trees, one priority queue per query, exact reranking.

The trees are fitted on a bounded sample, chosen by hash; every vector is then put into one
leaf of each tree.  A query walks all trees with one shared queue, always on the side with the smallest
margin crossed so far, until the leaves it has reached hold a share of all vectors.  That
share is the smallest at which searches within the sample find ``TRIAL_RECALL`` of what
brute force finds there; among more vectors the nearest are nearer, so it is on the safe
side.  Queries and vectors meet per leaf, as matrices; large leaves are cut into slices.

Equal vectors are one node that carries its smallest ids, one more than are asked for: more
can't be among the nearest.  So a third of all rows being one vector is one row here.

Vectors that are null, zero, of another length than most, or hold a null or a number that
is not finite take no part, neither do rows of null id.  Ties go to the smaller id.  With
fewer candidates than asked for all are returned; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tidegate.llm import common
from tidegate.session import scratch_path

#: Sample that the trees are fitted on: vectors and bytes at most; sample vectors per leaf at least.
SAMPLE_ROWS, SAMPLE_BYTES, SAMPLE_PER_LEAF = 20_000, 16_000_000, 8
TREES = 12
#: Leaves of a tree.  Their number is bounded by the sample, so leaves grow with the table, and with them the work of a query.
LEAVES = 256
#: Rounding of the products that choose whom to look at exactly: ties within it are all looked at.
MARGIN = 1e-9
#: Recall that a search among the sample must reach for its share of vectors to be enough, and queries that try it.
TRIAL_RECALL, TRIAL_QUERIES = 0.96, 200
#: Vectors of a leaf that one group holds.
SLICE_ROWS = 20_000


@dataclass(frozen=True)
class Forest:
    """Perfect binary trees in arrays: the children of node i are 2i+1 and 2i+2."""

    depth: int
    normals: np.ndarray  # trees, nodes, dimensions
    offsets: np.ndarray  # trees, nodes

    @property
    def trees(self) -> int:
        return len(self.normals)

    def leaves(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of every vector in every tree."""
        out = np.empty((len(vectors), self.trees), np.int32)
        for t in range(self.trees):
            node = np.zeros(len(vectors), np.int64)
            for _ in range(self.depth):
                side = np.einsum("ij,ij->i", vectors, self.normals[t][node]) > self.offsets[t][node]
                node = 2 * node + 1 + side
            out[:, t] = node - (2**self.depth - 1)
        return out

    def search(self, vector: np.ndarray, sizes: np.ndarray, wanted: int) -> list[tuple[int, int]]:
        """Leaves of all trees, best first, until they hold ``wanted`` vectors."""
        inner = 2**self.depth - 1
        margin = self.normals @ vector - self.offsets if inner else np.zeros((self.trees, 0))
        queue = [(-np.inf, t, 0) for t in range(self.trees)]
        heapq.heapify(queue)
        out, held = [], 0
        while queue and held < wanted:
            bound, t, node = heapq.heappop(queue)
            while node < inner:
                m = float(margin[t, node])
                near, far = (2 * node + 2, 2 * node + 1) if m > 0 else (2 * node + 1, 2 * node + 2)
                heapq.heappush(queue, (max(bound, abs(m)), t, far))
                node = near
            if sizes[t, node - inner]:
                out.append((t, node - inner))
                held += int(sizes[t, node - inner])
        return out


def _unit(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length one; the largest component first, so that squares neither overflow nor vanish."""
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def fit(sample: np.ndarray, trees: int = TREES, leaves: int = LEAVES, seed: int = 7) -> Forest:
    """Split the sample at the median of its projections on the difference of two of its members, again and again."""
    depth = int(np.log2(max(1, min(leaves, len(sample) / SAMPLE_PER_LEAF))))
    rng, unit = np.random.default_rng(seed), _unit(sample)
    normals = np.zeros((trees, 2**depth - 1, sample.shape[1]))
    offsets = np.zeros((trees, 2**depth - 1))
    for t in range(trees):
        parts = {0: np.arange(len(unit))}
        for node in range(2**depth - 1):
            part = parts.pop(node)
            a, b = unit[rng.choice(part, 2, replace=len(part) < 2)] if len(part) else rng.normal(size=(2, unit.shape[1]))
            normal = a - b if np.any(a != b) else rng.normal(size=unit.shape[1])
            normals[t, node] = normal / np.sqrt(normal @ normal)
            side = unit[part] @ normals[t, node]
            offsets[t, node] = np.median(side) if len(part) else 0.0
            parts[2 * node + 1], parts[2 * node + 2] = part[side <= offsets[t, node]], part[side > offsets[t, node]]
    return Forest(depth, normals, offsets)


def share_needed(forest: Forest, sample: np.ndarray, k: int, recall: float = TRIAL_RECALL) -> float:
    """Share of the vectors, counted once per tree they are met in, that searches within the sample have to look at."""
    unit, leaves = _unit(sample), forest.leaves(_unit(sample))
    sizes = np.stack([np.bincount(leaves[:, t], minlength=2**forest.depth) for t in range(forest.trees)])
    tried = np.linspace(0, len(unit) - 1, min(TRIAL_QUERIES, len(unit))).astype(int)
    near = unit[tried] @ unit.T
    near[np.arange(len(tried)), tried] = -np.inf
    most = min(k, len(unit) - 1)
    if most < 1:
        return float(forest.trees)
    best = np.argpartition(-near, most - 1, axis=1)[:, :most]
    share = 1 / 64
    while share < forest.trees:
        found = 0
        for q, wanted in zip(tried, best):
            seen = set(forest.search(unit[q], sizes, int(share * len(unit)) + 1))
            found += sum(any((t, leaves[w, t]) in seen for t in range(forest.trees)) for w in wanted)
        if found >= recall * best.size:
            return share
        share *= 1.5
    return float(forest.trees)


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, size)


def _classes(vectors: DataFrame, k: int) -> tuple[DataFrame, int]:
    """Distinct usable vectors with their smallest ids, and the number of components."""
    usable = vectors.where(F.col("id").isNotNull() & F.col("vec").isNotNull()).where(
        ~F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("vec", lambda x: x != 0))
    most = usable.groupBy(F.size("vec").alias("size")).count().orderBy(F.desc("count"), "size").first()
    if most is None:
        return usable, 0
    own = usable.where(F.size("vec") == most["size"]).withColumn("h", F.xxhash64("vec")).distinct()
    rank = F.row_number().over(Window.partitionBy("h", "vec").orderBy("id"))  # limited before the shuffle
    few = own.withColumn("r", rank).where(F.col("r") <= k + 1)
    return few.groupBy("h", "vec").agg(F.min("id").alias("rep"), F.sort_array(F.collect_list("id")).alias("ids")), most["size"]


def search(vectors: DataFrame, is_query, k: int = 5, vec_id: str = "vec_id", vector: str = "embedding", trees: int = TREES,
           leaves: int = LEAVES, share: float | None = None) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: the ``k`` nearest found of every row for which ``is_query`` holds."""
    spark = common.prepared(vectors.sparkSession)
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vec"), F.coalesce(is_query, F.lit(False)).alias("q"))
    classes, size = _classes(rows.select("id", "vec"), k)
    out = "query_id long, rank int, vec_id long, score double"
    if not size:
        return spark.createDataFrame([], out)
    classes.write.parquet(at := scratch_path(spark, "vectors"))
    classes = spark.read.parquet(at)
    total = classes.count()
    limit = max(1, min(SAMPLE_ROWS, SAMPLE_BYTES // (8 * size)))
    sample = np.array([r["vec"] for r in classes.orderBy("h", "rep").limit(limit).collect()])
    fitted = fit(sample, trees, leaves)
    search_rows = int(total * (share or share_needed(fitted, sample, k))) + 1
    forest = spark.sparkContext.broadcast(fitted)  # bounded by the sample

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = forest.value.leaves(_unit(_matrix(batch.column("vec"), size))) if batch.num_rows else np.zeros((0, trees))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own.tolist(), pa.list_(pa.int32()))], [*batch.schema.names, "leaves"])

    placed = classes.select("rep", "ids", "vec").mapInArrow(place, "rep long, ids array<long>, vec array<double>, leaves array<int>")
    placed.write.parquet(at := scratch_path(spark, "leaves"))
    placed = spark.read.parquet(at)
    spread = placed.select("rep", "ids", "vec", F.posexplode("leaves").alias("tree", "leaf"))
    sizes = np.zeros((trees, 2 ** forest.value.depth), np.int64)
    for r in spread.groupBy("tree", "leaf").count().collect():  # trees times leaves, bounded by the sample
        sizes[r["tree"], r["leaf"]] = r["count"]
    slices = -(-sizes // SLICE_ROWS)

    # A vector that several queries ask for is searched once.
    asked = rows.where("q").select(F.col("id").alias("query_id"), F.xxhash64("vec").alias("h"), "vec").distinct()
    asked = asked.join(classes.select("h", "vec", "rep"), ["h", "vec"]).select("query_id", "rep")
    queries = placed.join(asked.select("rep").distinct(), "rep", "left_semi").select(F.col("rep").alias("query"), "vec")

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            unit, source, found = _unit(_matrix(batch.column("vec"), size)), [], []
            for i in range(len(unit)):
                for t, leaf in forest.value.search(unit[i], sizes, search_rows):
                    for part in range(slices[t, leaf]):
                        source.append(i)
                        found.append((t, leaf, part))
            cells = np.array(found, np.int32).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays([*batch.take(pa.array(source, pa.int64())).columns, *(pa.array(cells[:, c]) for c in range(3))],
                                             ["query", "vec", "tree", "leaf", "part"])

    visits = queries.mapInArrow(visit, "query long, vec array<double>, tree int, leaf int, part int")
    counts = spark.createDataFrame([(t, i, int(n)) for (t, i), n in np.ndenumerate(slices) if n], "tree int, leaf int, n int")
    cut = spread.join(F.broadcast(counts), ["tree", "leaf"]).withColumn("part", F.pmod(F.xxhash64("rep"), F.col("n")).cast("int")).drop("n")

    def rerank(vectors_: pa.Table, queries_: pa.Table) -> pa.Table:
        if not vectors_.num_rows or not queries_.num_rows:
            return pa.table({"query": pa.array([], pa.int64()), "rep": pa.array([], pa.int64()), "score": pa.array([], pa.float64()), "ids": pa.array([], pa.list_(pa.int64()))})
        held = _matrix(vectors_.column("vec").combine_chunks(), size)
        held, wanted = _unit(held), _unit(_matrix(queries_.column("vec").combine_chunks(), size))
        raw, raw_q = (_matrix(x.column("vec").combine_chunks(), size) for x in (vectors_, queries_))
        rep, most = vectors_.column("rep").to_numpy(), min(len(held), k + 1)
        pick, source, score = [], [], []
        for i in range(len(wanted)):
            near = held @ wanted[i]
            best = np.flatnonzero(near >= np.partition(near, len(near) - most)[len(near) - most] - MARGIN)
            exact = cosine(raw_q[i], raw[best])
            order = np.lexsort((rep[best], -exact))[: k + 1]
            pick += best[order].tolist()
            score += exact[order].tolist()
            source += [i] * len(order)
        return pa.table({"query": queries_.column("query").take(pa.array(source)), "rep": vectors_.column("rep").take(pa.array(pick)),
                         "score": pa.array(score), "ids": vectors_.column("ids").take(pa.array(pick))})

    cell = ["tree", "leaf", "part"]
    found = cut.groupBy(*cell).cogroup(visits.groupBy(*cell)).applyInArrow(rerank, "query long, rep long, score double, ids array<long>")
    found = found.groupBy("query", "rep").agg(F.max("score").alias("score"), F.first("ids").alias("ids"))
    near = found.select("query", F.explode("ids").alias("vec_id"), "score")
    best = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))
    lists = near.withColumn("r", best).where(F.col("r") <= k + 1).groupBy("query").agg(
        F.sort_array(F.collect_list(F.struct("r", "vec_id", "score"))).alias("near"))
    own = asked.join(lists, asked["rep"] == lists["query"]).select("query_id", F.filter("near", lambda x: x["vec_id"] != F.col("query_id")).alias("near"))
    return own.select("query_id", F.posexplode(F.slice("near", 1, k)).alias("place", "x")).select(
        "query_id", (F.col("place") + 1).alias("rank"), F.col("x.vec_id").alias("vec_id"), F.col("x.score").alias("score"))


def cosine(one: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Cosine in double precision; the scales are taken out first."""
    one, many = one / np.abs(one).max(), many / np.abs(many).max(axis=1, keepdims=True)
    return (many * one).sum(axis=1) / (np.sqrt((one * one).sum()) * np.sqrt((many * many).sum(axis=1)))
