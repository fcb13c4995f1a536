"""Ranked lexical search by best-first intervals over range-maximum tables.

A task gathers its documents into shards of bounded size. In a shard, every
term asked for has a posting list: documents in the order of their ids, each
with its impact, the score it would add. A sparse table per list answers in
constant time which posting of any range has the greatest impact. An interval
of documents is bounded by the sum of its terms' range maxima. The search
takes the interval of the highest bound, scores the document of its greatest
impact exactly, splits the interval there, and stops when no bound left can
enter the best found. As equal scores rank by id, a large group of copies
costs no more than its first few.

What is best so far goes on from shard to shard of a task, so most intervals
of later shards fall at once. No document or posting is shuffled: tasks send
counts of the terms asked for, then their best documents.

The items are the stated query set: they are taken in blocks of about ITEMS,
each searched against all documents.
"""

from __future__ import annotations

import heapq
import math
from array import array
from bisect import insort
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.common import cut, fields

#: A term: letters and digits of ASCII, and every other character.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
K = 10
ITEMS = 2_000  # of a block
DOCS, POSTINGS = 1 << 14, 1 << 20  # a shard is searched when it has so many
DENSE = 1_024  # an interval of so few postings is scored as a whole

_LOWER = bytes(ord(chr(b).lower()) if b < 128 and chr(b).isalnum() else b if b >= 128 else 32 for b in range(256))


def terms(text: bytes | None) -> list[bytes]:
    """The terms of a text in UTF-8, A-Z lower-cased, with repeats."""
    return text.translate(_LOWER).split() if text else []


def weight(docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * docs + 2) / (2 * df + 1)))


class Shard:
    """Documents of one task, and the posting lists of the terms asked for.

    ``weights`` is an array by term number, ``length`` gives the m of a
    document with so many terms.
    """

    def __init__(self, weights: np.ndarray, length) -> None:
        self.weights, self.length = weights, length
        self.ids, self.sizes = [], []
        self.of, self.term, self.tf = array("i"), array("i"), array("q")

    def add(self, doc_id: int | None, n: int, found: list[tuple[int, int]]) -> None:
        at = len(self.ids)
        self.ids.append((doc_id is None, doc_id or 0))
        self.sizes.append(self.length(n))
        for number, tf in found:
            self.of.append(at)
            self.term.append(number)
            self.tf.append(tf)

    @property
    def full(self) -> bool:
        return len(self.ids) >= DOCS or len(self.of) >= POSTINGS

    def index(self) -> None:
        """Sort documents by id and postings by (term, document), and build the tables."""
        order = sorted(range(len(self.ids)), key=self.ids.__getitem__)
        self.ids = [self.ids[i] for i in order]
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        of, term = np.array(self.of, np.int64), np.array(self.term, np.int64)
        tf, m = np.array(self.tf, np.int64), np.array(self.sizes, np.int64)[of]
        impact = self.weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))
        self.n = len(order)
        key = term * self.n + rank[of]
        sort = np.argsort(key)
        sort = sort[impact[sort] > 0]
        self.key, self.impact = key[sort], impact[sort]
        self.doc = self.key % max(self.n, 1)
        ends = np.searchsorted(self.key, np.arange(len(self.weights) + 1) * self.n)
        self.start, self.end = ends[:-1], ends[1:]
        self.tables = self._tables(int((self.end - self.start).max(initial=0)))

    def _tables(self, longest: int) -> np.ndarray:
        """Row j: for every posting the place of the first greatest impact among the 2**j from it on.

        Rows run over the ends of lists; what does is never asked for.
        """
        n = len(self.impact)
        out = np.zeros((max(1, longest.bit_length()), n), np.int32)
        out[0] = np.arange(n)
        for j in range(1, len(out)):
            half = 1 << (j - 1)
            left, right = out[j - 1][:n - half], out[j - 1][half:]
            out[j, :n - half] = np.where(self.impact[left] >= self.impact[right], left, right)
            out[j, n - half:] = out[j - 1, n - half:]
        return out

    def greatest(self, lo: np.ndarray, hi: np.ndarray) -> tuple[int, int]:
        """Of the non-empty ones of these ranges: the sum of their maxima, and the place of the largest maximum."""
        some = hi > lo
        if not some.any():
            return 0, -1
        lo, hi = lo[some], hi[some]
        level = np.frexp((hi - lo).astype(np.float64))[1] - 1
        left, right = self.tables[level, lo], self.tables[level, hi - (1 << level)]
        a, b = self.impact[left], self.impact[right]
        top = np.maximum(a, b)
        at = int(top.argmax())
        return int(top.sum()), int(left[at] if a[at] >= b[at] else right[at])

    def search(self, asked: np.ndarray, best: list[tuple[int, tuple[bool, int]]], k: int) -> int:
        """Bring this shard's documents into ``best``: at most k of (-score, id), best first. Returns how many intervals were opened."""
        base = asked * self.n
        lo_at, hi_at = self.start[asked], self.end[asked]
        bound, at = self.greatest(lo_at, hi_at)
        heap, opened = [(-bound, 0, self.n, at, lo_at, hi_at)] if bound else [], 0

        def offer(score: int, doc: int) -> None:
            found = (-score, self.ids[doc])
            if score > 0 and (len(best) < k or found < best[-1]):
                insort(best, found)
                del best[k:]

        while heap:
            loss, lo, hi, at, lo_at, hi_at = heapq.heappop(heap)
            # Nothing left has a higher bound, nor an equal one with smaller ids.
            if len(best) == k and (loss, self.ids[lo]) >= best[-1]:
                break
            opened += 1
            sizes = hi_at - lo_at
            total = int(sizes.sum())
            if total <= DENSE:
                places = np.repeat(hi_at - np.cumsum(sizes), sizes) + np.arange(total)
                # Sums stay far below 2**53, so they are exact.
                scores = np.bincount(self.doc[places] - lo, weights=self.impact[places])
                worth = np.flatnonzero(scores >= (-best[-1][0] if len(best) == k else 1))
                if len(worth) > k:  # ties to smaller ids, which come first
                    worth = worth[np.argsort(-scores[worth], kind="stable")[:k]]
                for doc in worth.tolist():
                    offer(int(scores[doc]), lo + doc)
                continue
            split = int(self.doc[at])
            cut_at = np.searchsorted(self.key, base + split)
            has = cut_at < hi_at
            has[has] = self.doc[cut_at[has]] == split
            offer(int(self.impact[cut_at[has]].sum()), split)
            for a, b, first, last in ((lo, split, lo_at, cut_at), (split + 1, hi, cut_at + has, hi_at)):
                bound, at = self.greatest(first, last)
                if bound and not (len(best) == k and (-bound, self.ids[a]) >= best[-1]):
                    heapq.heappush(heap, (-bound, a, b, at, first, last))
        return opened


def _statistics(vocabulary: dict[bytes, int]):
    """A task's documents with a term (row -1), all their terms (row -2), and documents by term asked for."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        docs = total = 0
        df: Counter = Counter()
        for batch in batches:
            for text in batch["text"]:
                found = terms(text)
                if found:
                    docs, total = docs + 1, total + len(found)
                    df.update(vocabulary.keys() & set(found))
        yield pd.DataFrame({"term": [-1, -2, *(vocabulary[t] for t in df)], "n": [docs, total, *df.values()]})
    return run


def _best(vocabulary: dict[bytes, int], weights: np.ndarray, items: list[tuple[int, np.ndarray]], docs: int, total: int, k: int):
    """A task's at most k best documents of every item: item (its place), doc_id, score."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best: list[list] = [[] for _ in items]

        def length(n: int) -> int:
            return 10 + (90 * n * docs) // total

        def through(shard: Shard) -> Shard:
            shard.index()
            for i, (_, asked) in enumerate(items):
                shard.search(asked, best[i], k)
            return Shard(weights, length)

        shard = Shard(weights, length)
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                found = terms(text)
                if found:
                    counts = Counter(found)
                    shard.add(None if doc_id is None else int(doc_id), len(found), [(vocabulary[t], counts[t]) for t in vocabulary.keys() & counts.keys()])
                    if shard.full:
                        shard = through(shard)
        through(shard)
        rows = [(item, None if none else doc, -loss) for (item, _), found in zip(items, best) for loss, (none, doc) in found]
        yield pd.DataFrame({"item": pd.Series([r[0] for r in rows], dtype="int64"), "doc_id": pd.Series([r[1] for r in rows], dtype="object"),
                            "score": pd.Series([r[2] for r in rows], dtype="int64")})
    return run


def _block(docs: DataFrame, items: list, k: int) -> DataFrame | None:
    """item_id, place, doc_id, score of the best of each task for one block of items (rows with item_id and text)."""
    asked = [sorted(set(terms(r["text"]))) for r in items]
    vocabulary = {t: i for i, t in enumerate(sorted(set().union(*asked)))}
    if not vocabulary:
        return None
    counts = docs.select("text").mapInPandas(_statistics(vocabulary), fields(term="long", n="long"))
    df = {r["term"]: r["n"] for r in counts.groupBy("term").agg(F.sum("n").alias("n")).collect()}  # the block's terms at most
    n_docs, total = df.get(-1, 0), df.get(-2, 0)
    if not n_docs:
        return None
    weights = np.array([weight(n_docs, df[i]) if i in df else 0 for i in range(len(vocabulary))], np.int64)
    numbered = [(i, np.array([vocabulary[t] for t in a], np.int64)) for i, a in enumerate(asked) if a]
    found = docs.mapInPandas(_best(vocabulary, weights, numbered, n_docs, total, k), fields(item="long", doc_id="long", score="long"))
    names = docs.sparkSession.createDataFrame([(i, r["item_id"]) for i, r in enumerate(items)], fields(item="long", item_id="long"))
    return found.join(F.broadcast(names), "item")  # ITEMS rows or so


def search(docs: DataFrame, items: DataFrame, k: int = K, id_col: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """item_id, rank (from 1), doc_id, score: every item's ``k`` highest-scoring documents with a score above 0.

    Equal scores rank by ascending id, a null id last; rows repeated with
    the same id take a rank each, and an item's repeated rows a list each. A
    null text has no terms; an item or a document without terms has no rows,
    nor has an empty table. Other columns are not read, whatever their names.
    Each block of items reads the documents twice, while the query is built once.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{id_col}`").cast("string").alias("doc_id"), F.col(f"`{text}`").cast("binary").alias("text"))
    asked = cut(items.select(F.col(f"`{item_id}`").cast("long").alias("item_id"), F.col(f"`{item_text}`").cast("binary").alias("text")))
    n_blocks = max(1, -(-asked.count() // ITEMS))
    dealt = asked.withColumn("block", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(n_blocks)))
    out = None
    for b in range(n_blocks):
        found = _block(rows, dealt.where(F.col("block") == b).collect(), k)
        if found is not None:
            found = found.withColumn("item", F.struct(F.lit(b).alias("block"), "item"))
            out = found if out is None else out.unionByName(found)
    if out is None:
        return spark.createDataFrame([], fields(item_id="long", rank="int", doc_id="long", score="long"))
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return out.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
