"""SimHash near-duplicates by a binary trie joined with itself.

Distinct fingerprints are the leaves of a binary trie. Pairs of its nodes
are traversed together from the root: every step down splits both nodes by
their next bit and adds one error where the bits differ; a pair beyond the
error budget is dropped with everything below it.

The trie is built once per rotation of the 64 bits. With ``tries`` rotations
one of the ``tries`` bit blocks holds at most ``max_bits // tries`` of the
differing bits, so the budget of that block can be that low in the trie which
starts with it, and no link is lost. Pairs of upper nodes are the groups that
Spark deals out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.llm.common import cut, fields, free

SHINGLE = 4
MAX_BITS = 4
TRIES = 3
BITS = 64
NODE = 4096  # fingerprints that an upper node should hold
SALT = 16  # tasks that a component's fingerprints are dealt to
PROBE = 12  # depth at which upper nodes are counted
FRONTIER = 1 << 18  # node pairs held at once
EDGES = 200_000  # in one checkpoint file
PAIRS = 1 << 21  # leaf pairs compared at once


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64-bit SimHash of a whole text; zero if it has no word."""
    words = (text or "").encode().lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    stops = ends[min(shingle, len(words)) - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(line[a:b], 42) for a, b in zip(starts[:n], stops)], dtype="<u8")
    ones = np.zeros(BITS, dtype=np.int64)
    for k in range(0, n, 4096):
        ones += np.unpackbits(h[k:k + 4096].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(text: Column, shingle: int = SHINGLE) -> Column:
    """The fingerprint as a signed long; a null text counts as one without words."""
    @F.pandas_udf(T.LongType())
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            prints = np.array([fingerprint(t, shingle) for t in texts], dtype=np.uint64)
            yield pd.Series(prints.view(np.int64))

    return run(text)


def rotate(prints: np.ndarray, by: int) -> np.ndarray:
    """Rotate to the left by ``by`` bits."""
    by %= BITS
    return prints if not by else (prints << np.uint64(by)) | (prints >> np.uint64(BITS - by))


def first_bits(trie: int, tries: int) -> tuple[int, int]:
    """Where the block that leads this trie begins, and its length."""
    begin = trie * BITS // tries
    return begin, (trie + 1) * BITS // tries - begin


class Links:
    """Connected positions, as labels that point to the smallest position reached."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        label = self.label
        while len(a):
            low = np.minimum(label[a], label[b])
            np.minimum.at(label, label[a], low)
            np.minimum.at(label, label[b], low)
            while not np.array_equal(up := label[label], label):
                label[:] = up
            open_ = label[a] != label[b]
            a, b = a[open_], b[open_]


def _spread(lo: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For ranges starting at lo: the range each element is of, and the element."""
    which = np.repeat(np.arange(len(lo)), count)
    return which, lo[which] + np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)


def trie_links(keys: np.ndarray, roots: list[tuple[int, int, int, int, int]], depth: int, first: int, first_budget: int,
               budget: int, links: Links) -> None:
    """Traverse node pairs from ``depth`` down and connect all leaves within ``budget`` bits.

    ``keys`` is sorted and distinct; a node is a range of it. A root is (low
    and high end of one node, of the other, errors so far). Up to depth
    ``first`` the budget is ``first_budget``.
    """
    stack = [(depth, np.array(roots, dtype=np.int64).reshape(-1, 5))]
    while stack:
        d, pairs = stack.pop()
        if len(pairs) > FRONTIER:
            half = len(pairs) // 2
            stack += [(d, pairs[:half]), (d, pairs[half:])]
            continue
        size_a, size_b = pairs[:, 1] - pairs[:, 0], pairs[:, 3] - pairs[:, 2]
        small = (size_a * size_b <= 16) | (d == BITS)
        leaf = pairs[small]
        if len(leaf):
            cells = (leaf[:, 1] - leaf[:, 0]) * (leaf[:, 3] - leaf[:, 2])
            part = np.cumsum(cells) // PAIRS
            for p in np.unique(part):
                some, n = leaf[part == p], cells[part == p]
                which, cell = _spread(np.zeros(len(some), dtype=np.int64), n)
                wide = (some[:, 3] - some[:, 2])[which]
                a, b = some[which, 0] + cell // wide, some[which, 2] + cell % wide
                near = (a != b) & (np.bitwise_count(keys[a] ^ keys[b]) <= budget)
                links.add(a[near], b[near])
        pairs = pairs[~small]
        if not len(pairs):
            continue
        bit = np.uint64(1 << (BITS - 1 - d))
        above = ~np.uint64((1 << (BITS - d)) - 1)

        def middle(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
            return np.clip(np.searchsorted(keys, (keys[lo] & above) | bit), lo, hi)

        a0, a2, b0, b2, err = pairs.T
        a1, b1 = middle(a0, a2), middle(b0, b2)
        same = a0 == b0
        down = [np.stack(x, axis=1) for x in (
            (a0, a1, b0, b1, err), (a1, a2, b1, b2, err), (a0, a1, b1, b2, err + 1),
            (a1[~same], a2[~same], b0[~same], b1[~same], err[~same] + 1))]
        down = np.concatenate(down)
        allowed = first_budget if d + 1 <= first else budget
        keep = (down[:, 0] < down[:, 1]) & (down[:, 2] < down[:, 3]) & (down[:, 4] <= allowed)
        # A node paired with itself needs two leaves.
        keep &= (down[:, 0] != down[:, 2]) | (down[:, 1] - down[:, 0] > 1)
        down = down[keep]
        if len(down):
            stack.append((d + 1, down))


def _node_pairs(depth: int, tries: int, max_bits: int):
    """Rows (trie, left, right, fp) for every upper node pair within the first budget that a fingerprint is in."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            raw = batch["fp"].to_numpy(dtype=np.int64)
            prints = raw.view(np.uint64)
            for trie in range(tries):
                begin, length = first_bits(trie, tries)
                node = (rotate(prints, begin) >> np.uint64(BITS - depth)).astype(np.int64) if depth else np.zeros(len(raw), np.int64)
                flips = [0, *(1 << k for k in range(depth))] if max_bits // tries else [0]
                for flip in flips:
                    other = node ^ flip
                    yield pd.DataFrame({"trie": trie, "left": np.minimum(node, other), "right": np.maximum(node, other), "fp": raw})
    return run


def _traverse(depth: int, tries: int, max_bits: int):
    """One upper node pair: star edges (fp, root) of what it connects, at most one per fingerprint."""
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        trie, left, right = (int(x) for x in key)
        begin, length = first_bits(trie, tries)
        keys = np.sort(rotate(rows["fp"].to_numpy(dtype=np.int64).view(np.uint64), begin))
        if left == right:
            root = (0, len(keys), 0, len(keys), 0)
        else:
            at = int(np.searchsorted(keys, np.uint64(right << (BITS - depth))))
            root = (0, at, at, len(keys), 1)
        links = Links(len(keys))
        if root[1] > root[0] and root[3] > root[2]:
            trie_links(keys, [root], depth, length, max_bits // tries, max_bits, links)
        child = np.flatnonzero(links.label != np.arange(len(keys)))
        back = rotate(keys, BITS - begin).view(np.int64)
        return pd.DataFrame({"a": back[child], "b": back[links.label[child]]})
    return run


def near_links(prints: DataFrame, max_bits: int = MAX_BITS, tries: int = TRIES, node: int = NODE) -> DataFrame:
    """Edges (a, b) whose components are those of all distinct ``fp`` within ``max_bits`` bits.

    ``prints`` holds distinct non-null fp. At most one edge per fingerprint
    and node pair comes out, not all close pairs, so a dense group stays
    linear. The upper nodes' depth follows the fullest one, counted first.
    """
    if not 1 <= tries or max_bits // tries > 1:
        raise ValueError("use enough tries for a first budget of at most one error")
    count = []
    for trie in range(tries):
        begin, _ = first_bits(trie, tries)
        low = (begin + PROBE) % BITS
        shifted = F.shiftrightunsigned("fp", BITS - low) if low else F.col("fp")
        if begin + PROBE > BITS:
            shifted = shifted.bitwiseOR(F.shiftleft("fp", low))
        count.append(shifted.bitwiseAND(F.lit((1 << PROBE) - 1).cast("long")))
    at = prints.select(F.posexplode(F.array(*count)).alias("trie", "node")).groupBy("trie", "node").count().collect()
    depth = 0
    while depth < 20 and at:
        if depth <= PROBE:
            full: dict[tuple[int, int], int] = {}
            for r in at:  # at most tries * 4096 rows
                k = (r["trie"], r["node"] >> (PROBE - depth))
                full[k] = full.get(k, 0) + r["count"]
            most = max(full.values())
        if most >> max(0, depth - PROBE) <= node:
            break
        depth += 1
    pairs = prints.select("fp").mapInPandas(_node_pairs(depth, tries, max_bits), fields(trie="long", left="long", right="long", fp="long"))
    return pairs.groupBy("trie", "left", "right").applyInPandas(_traverse(depth, tries, max_bits), fields(a="long", b="long")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(v, root) for every vertex of the edges (a, b); root is the smallest vertex of its component.

    Alternating large and small stars; every round is written to the shared
    folder, and only a count and a checksum come back to the driver.
    """
    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % 1_000_003)).first())

    def files(count: int) -> int:
        """Checkpoint files for so many edges; a round changes their number little."""
        return 1 + count // EDGES

    edges = cut(edges.where("a <> b").distinct())
    now = state(edges)
    while True:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("b")).select("a", F.least("a", "b").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        up = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = up.groupBy("a").agg(F.min("b").alias("m"))
        small = up.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = cut(small.union(least.select("a", F.col("m").alias("b"))).distinct().coalesce(files(now[0])))
        before, now = now, state(edges)
        if now == before:
            break
    roots = edges.select("b").distinct()
    return edges.select(F.col("a").alias("v"), F.col("b").alias("root")).union(roots.select("b", "b"))


def _members(keys: DataFrame, max_bits: int, tries: int) -> DataFrame:
    """fp, root, at for every distinct fp of ``keys``, which has its smallest key as at; root is the component's smallest fp."""
    found = components(near_links(keys.select("fp"), max_bits, tries))
    return keys.join(found.withColumnRenamed("v", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def _salted(of: DataFrame, least: DataFrame) -> DataFrame:
    """``of`` joined with ``least`` by root, a root's rows dealt to SALT tasks: one component may have very many fingerprints."""
    parts = least.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    return of.withColumn("__salt", F.pmod(F.xxhash64("fp"), F.lit(SALT)).cast("int")).join(parts, ["root", "__salt"]).drop("__salt")


def groups(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
           max_bits: int = MAX_BITS, tries: int = TRIES) -> DataFrame:
    """One row per document: doc_id, fp (signed long), component_id.

    Documents link when their fingerprints differ in at most ``max_bits``
    bits; component_id is the smallest doc_id that can be reached. Texts that
    are null or blank have fingerprint zero and link like any other. Repeated
    rows stay repeated. A null doc_id takes part but names no component: if
    all ids of a component are null, so is component_id. Other columns are
    left behind; an empty table gives no rows.
    """
    prints = cut(docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), fingerprints(F.col(f"`{text}`"), shingle).alias("fp")))
    first = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("at")))
    member = _members(first, max_bits, tries)
    least = member.groupBy("root").agg(F.min("at").alias("component_id"))
    of = _salted(member.select("fp", "root"), least).select("fp", "component_id")
    # The last join's hot side (a fingerprint that many copies share) is split by adaptive execution.
    return prints.join(of, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
             max_bits: int = MAX_BITS, tries: int = TRIES) -> DataFrame:
    """``docs`` with one row of each group of ``groups``; all its columns stay.

    The kept row is the one with the smallest id, nulls last, and of equal ids
    the one whose text has the smallest hash: it depends on the rows alone,
    not on their partitions. Of rows repeated with both equal one stays. An
    empty table gives no rows. Rows are chosen by id and hash, so texts are
    shuffled once, for the join with what is kept; only rows that repeat the
    id and text of a kept one are shuffled again.
    """
    own = F.xxhash64(F.coalesce(F.col(f"`{text}`").cast("binary"), F.lit(b"")), F.col(f"`{text}`").isNull())
    prints = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), own.alias("hash"), fingerprints(F.col(f"`{text}`"), shingle).alias("fp"))
    rows = cut(prints.groupBy("fp", "id", "hash").agg(F.count("*").alias("n")))
    at = F.struct(F.col("id").isNull().alias("none"), "id", "hash", "n")
    member = _members(cut(rows.groupBy("fp").agg(F.min(at).alias("at"))), max_bits, tries)
    kept_id, kept_hash, kept_n = free(docs, "kept_id", "kept_hash", "kept_n")
    kept = cut(member.groupBy("root").agg(F.min("at").alias("at")).select(
        F.col("at.id").alias(kept_id), F.col("at.hash").alias(kept_hash), F.col("at.n").alias(kept_n)))
    same = F.col(f"`{id_col}`").cast("long").eqNullSafe(F.col(kept_id)) & (own == F.col(kept_hash))
    out = docs.join(kept.where(F.col(kept_n) == 1), same, "left_semi")
    if kept.where(F.col(kept_n) > 1).limit(1).count():
        again = docs.join(kept.where(F.col(kept_n) > 1), same, "left_semi").withColumn(kept_hash, own)
        out = out.unionByName(again.dropDuplicates([id_col, kept_hash]).drop(kept_hash))
    return out
