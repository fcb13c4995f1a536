"""Nearest neighbours by inner product through a hierarchical k-means tree.

The tree is fitted on a bounded sample and travels with the tasks; every
vector is then sent down to its leaf. A query walks the tree best bin first:
a priority queue holds the nodes met so far, the most promising is opened
next, and every leaf that comes up is visited. How many leaves a query visits
is widened until the recall measured on calibration queries, against an exact
search over all vectors, reaches the target.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.common import cut, fields

K = 20
EVERY = 20  # rows whose id this divides are queries
BRANCH = 8
LEAF = 512  # vectors that a leaf should hold
LEAVES = 4096  # at most so many leaves: the tree stays small enough to send
SAMPLE = 20_000  # vectors that the tree is fitted on, about
SAMPLE_MB = 64
CALIBRATE = 96  # queries that the recall is measured on
RECALL = 0.97
BLOCK = 4096  # vectors, and queries, that one task compares at once


@dataclass
class Tree:
    """Nodes in order; the root is 0. ``leaf`` is a leaf's number, or -1."""

    centroids: np.ndarray
    children: list[list[int]] = field(default_factory=list)
    leaf: list[int] = field(default_factory=list)

    @property
    def leaves(self) -> int:
        return max(self.leaf) + 1

    def assign(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of each vector: from the root always to the nearest child."""
        out = np.zeros(len(vectors), dtype=np.int64)
        stack = [(0, np.arange(len(vectors)))]
        while stack:
            node, rows = stack.pop()
            if not len(rows):
                continue
            if self.leaf[node] >= 0:
                out[rows] = self.leaf[node]
                continue
            kids = self.children[node]
            near = _nearest(vectors[rows], self.centroids[kids])
            stack += [(kid, rows[near == i]) for i, kid in enumerate(kids)]
        return out

    def walk(self, query: np.ndarray) -> Iterator[int]:
        """Leaves, best bin first."""
        score = self.centroids @ query
        queue = [(-score[0], 0)]
        while queue:
            _, node = heapq.heappop(queue)
            if self.leaf[node] >= 0:
                yield self.leaf[node]
            for kid in self.children[node]:
                heapq.heappush(queue, (-score[kid], kid))


def _nearest(vectors: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmin((centres ** 2).sum(axis=1) - 2 * vectors @ centres.T, axis=1)


def _split(points: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 12) -> np.ndarray:
    centres = points[rng.choice(len(points), size=k, replace=False)]
    for _ in range(rounds):
        near = _nearest(points, centres)
        size = np.bincount(near, minlength=k)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, points)
        moved = np.where(size[:, None] > 0, sums / np.maximum(size, 1)[:, None], centres)
        if np.allclose(moved, centres):
            break
        centres = moved
    return centres


def grow(points: np.ndarray, leaves: int, branch: int = BRANCH, seed: int = 11) -> Tree:
    """A tree of about ``leaves`` leaves over the sample: the fullest node is split until there are enough."""
    rng = np.random.default_rng(seed)
    tree = Tree(points.mean(axis=0, keepdims=True), [[]], [-1])
    centroids = [tree.centroids[0]]
    open_ = [(-len(points), 0, np.arange(len(points)))]
    ends = 1
    done: list[int] = []
    while open_:
        _, node, rows = heapq.heappop(open_)
        k = min(branch, leaves - ends + 1, len(rows) // 2)
        if k < 2:
            done.append(node)
            continue
        near = _nearest(points[rows], centres := _split(points[rows], k, rng))
        parts = [rows[near == i] for i in range(k)]
        if sum(len(p) > 0 for p in parts) < 2:
            done.append(node)
            continue
        for i, part in enumerate(parts):
            if len(part):
                tree.children[node].append(len(centroids))
                heapq.heappush(open_, (-len(part), len(centroids), part))
                centroids.append(centres[i])
                tree.children.append([])
                tree.leaf.append(-1)
        ends += len(tree.children[node]) - 1
    for number, node in enumerate(sorted(done)):
        tree.leaf[node] = number
    tree.centroids = np.array(centroids)
    return tree


def clean(table: DataFrame, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id, vector (array of double) and key (its digest) of the rows that take part.

    Rows with a null id, a null, empty or zero vector, or null or non-finite
    components don't. Vectors of all lengths do; see ``neighbours``.
    """
    x = F.col(f"`{vector}`").cast("array<double>")
    rows = table.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), x.alias("vector")).where("vec_id IS NOT NULL")
    fine = F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists("vector", lambda v: v != 0)
    return rows.where(fine).withColumn("key", F.md5(F.concat_ws(",", F.col("vector").cast("array<string>")).cast("binary")))


def distinct_vectors(rows: DataFrame, k: int = K) -> DataFrame:
    """One row per vector: key, vector, ids (its k + 1 smallest, ascending).

    No query can return more than k rows of one vector beside its own, so the
    other ids can't matter; ranks are limited before the shuffle too, so a
    vector that very many rows share is no large group.
    """
    ranked = rows.withColumn("nth", F.dense_rank().over(Window.partitionBy("key").orderBy("vec_id"))).where(F.col("nth") <= k + 1)
    return ranked.groupBy("key").agg(F.first("vector").alias("vector"), F.sort_array(F.collect_set("vec_id")).alias("ids"))


def _matrix(column: pd.Series) -> np.ndarray:
    return np.array(column.tolist(), dtype=np.float64)


def _best(asked: np.ndarray, vectors: np.ndarray, ids: list, k: int, allowed: list[np.ndarray] | None = None) -> list[list[tuple[float, int]]]:
    """For every query its k + 1 best (-score, vec_id) of these vectors, ties to smaller ids; ``allowed`` masks vectors by query."""
    out = []
    for at in range(0, len(asked), 256):
        for i, row in enumerate(asked[at:at + 256] @ vectors.T, start=at):
            take = np.arange(len(row)) if allowed is None else np.flatnonzero(allowed[i])
            if len(take) > k + 1:
                some = row[take]
                take = take[some >= np.partition(some, len(some) - k - 1)[len(some) - k - 1]]
            out.append(sorted((-float(row[t]), int(v)) for t in take.tolist() for v in ids[t])[:k + 1])
    return out


_FOUND = fields(query="string", ids="long[]", scores="double[]")


def _lists(keys: list[str], best: list[list[tuple[float, int]]]) -> pd.DataFrame:
    return pd.DataFrame({"query": keys, "ids": [[v for _, v in b] for b in best], "scores": [[-s for s, _ in b] for b in best]})


def _merged(found: DataFrame, k: int) -> DataFrame:
    """query and best: array of (loss, vec_id) of the k + 1 best of all its lists, best first.

    A task sends one list of at most k + 1 for a query, so a query's lists
    number its blocks at most.
    """
    pairs = F.arrays_zip(F.transform("scores", lambda x: -x).alias("loss"), F.col("ids").alias("vec_id"))
    return found.groupBy("query").agg(F.slice(F.sort_array(F.flatten(F.collect_list(pairs))), 1, k + 1).alias("best"))


def exact(classes: DataFrame, queries: pd.DataFrame, k: int = K) -> DataFrame:
    """Brute force for a bounded set of queries (key, vector): query and best, as ``_merged`` has them."""
    keys, asked = queries["key"].tolist(), _matrix(queries["vector"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield _lists(keys, _best(asked, _matrix(batch["vector"]), batch["ids"].tolist(), k))

    return _merged(classes.select("vector", "ids").mapInPandas(run, _FOUND), k)


@dataclass
class Index:
    """The tree, every distinct vector with its leaf, and the rows behind each leaf."""

    tree: Tree
    classes: DataFrame  # key, vector, ids, leaf
    sizes: np.ndarray  # distinct vectors by leaf
    members: np.ndarray  # ids kept by leaf
    visits: int


def _to_leaf(tree: Tree):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(leaf=tree.assign(_matrix(batch["vector"])) if len(batch) else [])
    return run


def build(rows: DataFrame, k: int = K, recall: float = RECALL, every: int = EVERY) -> Index | None:
    """Fit the tree on a sample, index every row, and widen the visits until ``recall`` is reached; None without rows.

    The sample is drawn by hash, about SAMPLE vectors (or SAMPLE_MB of them).
    The recall is measured on up to CALIBRATE queries of smallest hash.
    """
    classes = cut(distinct_vectors(rows, k))
    n = classes.count()
    if not n:
        return None
    width = len(classes.select("vector").first()[0])
    bound = max(1, min(SAMPLE, SAMPLE_MB * 1_000_000 // (8 * width)))
    # Not the first by an order: every task would send its own first ``bound`` to the driver.
    picked = F.pmod(F.xxhash64("key"), F.lit(1 << 40)) < F.lit(min(1 << 40, bound * (1 << 40) // n))
    sample = classes.where(picked).select("vector").toPandas()
    leaves = max(1, min(LEAVES, n // LEAF, len(sample) // 4))
    tree = grow(_matrix(sample["vector"]), leaves) if len(sample) else Tree(np.zeros((1, width)), [[]], [0])
    indexed = cut(classes.mapInPandas(_to_leaf(tree), fields(key="string", vector="double[]", ids="long[]", leaf="long")))
    sizes, members = np.zeros(tree.leaves, np.int64), np.zeros(tree.leaves, np.int64)
    for r in indexed.groupBy("leaf").agg(F.count("*").alias("n"), F.sum(F.size("ids")).alias("m")).collect():
        sizes[r["leaf"]], members[r["leaf"]] = r["n"], r["m"]
    index = Index(tree, indexed, sizes, members, tree.leaves)
    asked = rows.where(F.col("vec_id") % every == 0).select("key").distinct()
    some = indexed.join(asked, "key", "left_semi").orderBy(F.xxhash64("key", F.lit(1)), "key") \
        .limit(CALIBRATE).select("key", "vector").toPandas()
    if len(some) and tree.leaves > 1:
        index.visits = calibrate(index, some, recall, k)
    return index


def calibrate(index: Index, queries: pd.DataFrame, recall: float = RECALL, k: int = K) -> int:
    """The fewest leaf visits, widened by a quarter at a time, that find ``recall`` of the exact neighbours."""
    near = exact(index.classes, queries, k).select("query", F.explode("best.vec_id").alias("vec_id"))
    where = index.classes.select("leaf", F.explode("ids").alias("vec_id"))
    best = near.join(where, "vec_id").select("query", "leaf").toPandas()  # CALIBRATE * (k + 1) rows at most
    turn = {key: {leaf: i for i, leaf in enumerate(index.tree.walk(np.array(v)))} for key, v in zip(queries["key"], queries["vector"])}
    needed = np.array([turn[q][leaf] + 1 for q, leaf in zip(best["query"], best["leaf"])])
    visits = 1
    while visits < index.tree.leaves and (needed <= visits).mean() < recall:
        visits = min(index.tree.leaves, max(visits + 1, visits * 5 // 4))
    return visits


def deal_blocks(sizes: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    """For every leaf its block, and for every block its parts: small leaves side by side share
    a block of at most ``block`` vectors, a larger leaf is a block of its own in several parts."""
    of, held = np.zeros(len(sizes), np.int64), [0]
    for leaf, size in enumerate(sizes.tolist()):
        if held[-1] and held[-1] + size > block:
            held.append(0)
        of[leaf], held[-1] = len(held) - 1, held[-1] + size
    return of, np.maximum(1, -(-np.array(held) // block))


def _visits(index: Index, block_of: np.ndarray, k: int):
    """Rows (key, vector, block, leaves): the leaves that each query visits, by block: enough of them, holding enough rows."""
    tree, members, visits = index.tree, index.members, index.visits

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for key, vector in zip(batch["key"], batch["vector"]):
                held, leaves = 0, {}
                for seen, leaf in enumerate(tree.walk(np.array(vector))):
                    if seen >= visits and held > k:
                        break
                    held += members[leaf]
                    leaves.setdefault(int(block_of[leaf]), []).append(leaf)
                rows += [(key, vector, b, some) for b, some in leaves.items()]
            yield pd.DataFrame(rows, columns=["key", "vector", "block", "leaves"])
    return run


def _compare(k: int):
    def run(vectors: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if not len(vectors) or not len(queries):
            return _lists([], [])
        leaf = vectors["leaf"].to_numpy()
        allowed = [np.isin(leaf, some) for some in queries["leaves"]]
        return _lists(queries["key"].tolist(), _best(_matrix(queries["vector"]), _matrix(vectors["vector"]), vectors["ids"].tolist(), k, allowed))
    return run


def search(rows: DataFrame, index: Index | None, k: int = K, every: int = EVERY) -> DataFrame:
    """query_id, rank (from 1), vec_id, score for the ``k`` nearest found of every row whose id ``every`` divides.

    Queries with the same vector are answered once. Leaves are dealt out in
    blocks of about BLOCK vectors, and a block's queries in turns of about
    BLOCK, so no leaf or vector is one large task. Repeated rows count once.
    Without rows the result is empty.
    """
    spark = rows.sparkSession
    if index is None:
        return spark.createDataFrame([], fields(query_id="long", rank="int", vec_id="long", score="double"))
    block_of, parts = deal_blocks(index.sizes, BLOCK)
    asked = rows.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), "key").distinct()
    queries = index.classes.join(asked.select("key").distinct(), "key", "left_semi").select("key", "vector")
    visits = cut(queries.repartition("key").mapInPandas(_visits(index, block_of, k), fields(key="string", vector="double[]", block="long", leaves="long[]")))
    visitors = np.zeros(len(parts), np.int64)
    for r in visits.groupBy("block").count().collect():
        visitors[r["block"]] = r["count"]
    turns = np.maximum(1, -(-visitors // BLOCK))
    # One row per leaf or block, LEAVES at most.
    of_leaf = F.broadcast(spark.createDataFrame(pd.DataFrame({"leaf": np.arange(len(block_of)), "block": block_of})))
    of_block = F.broadcast(spark.createDataFrame(pd.DataFrame({"block": np.arange(len(parts)), "parts": parts, "turns": turns})))
    left = index.classes.join(of_leaf, "leaf").join(of_block, "block").withColumns({
        "part": F.pmod(F.xxhash64("key"), "parts"), "turn": F.explode(F.sequence(F.lit(0).cast("long"), F.col("turns") - 1))})
    right = visits.join(of_block, "block").withColumns({
        "turn": F.pmod(F.xxhash64("key"), "turns"), "part": F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))})
    task = ["block", "part", "turn"]
    found = left.select(*task, "leaf", "vector", "ids").groupBy(*task).cogroup(
        right.select(*task, "key", "vector", "leaves").groupBy(*task)).applyInPandas(_compare(k), _FOUND)
    best = _merged(found, k)
    # Each query leaves itself out; what is above it keeps its place, what is below moves up.
    other = F.slice(F.filter("best", lambda b: b["vec_id"] != F.col("query_id")), 1, k)
    return asked.join(best, asked["key"] == best["query"]).select("query_id", F.posexplode(other).alias("at", "b")).select(
        "query_id", (F.col("at") + 1).alias("rank"), F.col("b.vec_id").alias("vec_id"), (-F.col("b.loss")).alias("score"))


def neighbours(rows: DataFrame, k: int = K, every: int = EVERY) -> DataFrame:
    """``search`` over the rows that ``clean`` made, with an index of its own for every length of vectors:
    those of different lengths have no inner product, so they are no neighbours of each other."""
    widths = sorted(r["n"] for r in rows.select(F.size("vector").alias("n")).distinct().collect())
    if len(widths) < 2:
        return search(rows, build(rows, k, every=every), k, every)
    out = None
    for n in widths:
        some = rows.where(F.size("vector") == n)
        found = search(some, build(some, k, every=every), k, every)
        out = found if out is None else out.unionByName(found)
    return out
