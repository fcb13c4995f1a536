"""Vector code compression: a product quantizer whose exact integer assignment is pruned by LAESA pivots.

Vectors become integers, are cut into equal parts, and every part position
has a codebook of integer entries. Fixed pivots are chosen for each position,
and every part's distances to them are computed once and stored. In each
round the pivots' distances to the present entries are computed; by the
triangle inequality |d(part, pivot) - d(pivot, entry)| is a lower bound of
d(part, entry), so a part takes its entries in the order of their bounds,
evaluates them exactly in integers, and stops once no bound left can reach
the best distance found. Bounds carry a margin for rounding, so codes are
those of a full search.

A round's sums are added up in the tasks, one row per position and used
entry each, so what is shuffled and what reaches the driver has the size of the codebooks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import bounded, fields, written

SCALE = 256
PARTS = 16
ENTRIES = 64
ROUNDS = 2
PIVOTS = 6  # by part position
LARGEST = 1 << 26  # of an integer component; squares of differences must add up within 64 bits
MARGIN = 1e-6  # relative, of lower bounds held as 32-bit numbers
LABELS = 100_000  # sums by label are broadcast up to this many
BLOCK = 1024  # vectors whose bounds are held at once


def clean(table: DataFrame, id_col: str = "vec_id", vector: str = "embedding", label: str = "label", scale: int = SCALE) -> DataFrame:
    """vec_id, label (as text) and comps (floor of ``scale`` times each component) of the rows that take part.

    Rows whose vector is null or holds null or non-finite components don't;
    repeated rows, null ids and null labels do. Other columns are not read.
    """
    x = F.col(f"`{vector}`").cast("array<double>")
    rows = table.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{label}`").cast("string").alias("label"), x.alias("x"))
    fine = F.col("x").isNotNull() & F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return rows.where(fine).select("vec_id", "label", F.transform("x", lambda v: F.floor(v * F.lit(float(scale)))).alias("comps"))


def _ints(column: pd.Series, width: int) -> np.ndarray:
    return np.array(column.tolist(), dtype=np.int64).reshape(len(column), width)


def choose_pivots(book: np.ndarray, count: int = PIVOTS) -> np.ndarray:
    """Of one position's entries the ``count`` that lie far apart: the first, then always the one farthest from those taken."""
    taken, near = [], np.full(len(book), np.iinfo(np.int64).max)
    at = 0
    for _ in range(min(count, len(book))):
        taken.append(at)
        near = np.minimum(near, ((book - book[at]) ** 2).sum(axis=1))
        at = int(near.argmax())
    return book[taken]


def pivot_distances(parts: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances of parts (n, positions, width) to their position's pivots (positions, p, width): (n, positions, p)."""
    return np.sqrt(((parts[:, :, None, :] - pivots[None]) ** 2).sum(axis=3).astype(np.float64)).astype(np.float32)


def assign(parts: np.ndarray, to_pivots: np.ndarray, books: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """For parts (n, positions, width) the nearest entries and squared distances (n, positions), and how many were evaluated.

    ``books`` is (positions, entries, width). Ties go to the lower index.
    """
    n, positions, _ = parts.shape
    entries = books.shape[1]
    of_entries = np.sqrt(((pivots[:, :, None, :] - books[:, None, :, :]) ** 2).sum(axis=3).astype(np.float64)).astype(np.float32)
    bound = np.zeros((n, positions, entries), np.float32)
    for p in range(pivots.shape[1]):
        np.maximum(bound, np.abs(to_pivots[:, :, p, None] - of_entries[None, :, p, :]), out=bound)
    # Both distances are rounded: the bound gives way by that much.
    bound -= MARGIN * (to_pivots.max(axis=2, initial=0)[:, :, None] + of_entries.max(axis=1, initial=0)[None]) + np.float32(1e-3)
    bound = bound.reshape(n * positions, entries)
    order = np.argsort(bound, axis=1, kind="stable")
    flat, place = parts.reshape(n * positions, -1), np.tile(np.arange(positions), n)
    best, code = np.full(len(flat), np.iinfo(np.int64).max), np.zeros(len(flat), np.int64)
    active, evaluated = np.arange(len(flat)), 0
    for turn in range(entries):
        entry = order[active, turn]
        if turn:
            reach = bound[active, entry]
            go = (reach <= 0) | (reach.astype(np.float64) ** 2 <= best[active])
            active, entry = active[go], entry[go]
            if not len(active):
                break
        gap = flat[active] - books[place[active], entry]
        found = (gap * gap).sum(axis=1)
        evaluated += len(active)
        better = (found < best[active]) | ((found == best[active]) & (entry < code[active]))
        hit = active[better]
        best[hit], code[hit] = found[better], entry[better]
    return code.reshape(n, positions), best.reshape(n, positions), evaluated


@dataclass
class Codes:
    """The prepared rows (vec_id, label, comps, pivots), and every position's entries and pivots."""

    rows: DataFrame
    books: np.ndarray  # (positions, entries, width)
    pivots: np.ndarray  # (positions, pivots, width)

    @property
    def digest(self) -> str:
        """SHA-256 of all components in decimal, by part, entry and position, joined by commas."""
        return hashlib.sha256(",".join(map(str, self.books.ravel().tolist())).encode()).hexdigest()


def _batches(batches: Iterator[pd.DataFrame], books: np.ndarray, pivots: np.ndarray):
    """(rows, parts, codes, squared distances) of every block of the batches."""
    positions, _, width = books.shape
    for batch in batches:
        for at in range(0, len(batch), BLOCK):
            some = batch.iloc[at:at + BLOCK]
            parts = np.stack([np.frombuffer(b, "<i4") for b in some["comps"]]).astype(np.int64).reshape(len(some), positions, width)
            near = np.stack([np.frombuffer(b, "<f4") for b in some["pivots"]]).reshape(len(some), positions, -1)
            yield some, parts, *assign(parts, near, books, pivots)[:2]


_READY = dict(vec_id="string", comps="binary", pivots="binary", label="string")  # ids as text: pandas would make floats of nullable numbers


def _prepare(pivots: np.ndarray):
    positions, _, width = pivots.shape

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for at in range(0, len(batch), BLOCK):
                some = batch.iloc[at:at + BLOCK]
                parts = _ints(some["comps"], positions * width)
                if np.abs(parts).max(initial=0) > LARGEST:
                    raise ValueError(f"a component exceeds {LARGEST} after scaling")
                near = pivot_distances(parts.reshape(len(some), positions, width), pivots)
                rows += zip(some["vec_id"], [p.tobytes() for p in parts.astype("<i4")], [d.tobytes() for d in near.astype("<f4")], some["label"])
            yield pd.DataFrame(rows, columns=list(_READY))
    return run


def _sums(books: np.ndarray, pivots: np.ndarray):
    """A task's counts and component sums by position and entry, in one row each, those without parts left out."""
    positions, entries, width = books.shape

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count, total = np.zeros(positions * entries, np.int64), np.zeros((positions * entries, width), np.int64)
        for _, parts, code, _ in _batches(batches, books, pivots):
            key = (np.arange(positions) * entries + code).ravel()
            np.add.at(count, key, 1)
            np.add.at(total, key, parts.reshape(-1, width))
        used = np.flatnonzero(count)
        yield pd.DataFrame({"entry": used, "n": count[used], "total": pd.Series(total[used].tolist(), dtype=object)})
    return run


def fit(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, pivots: int = PIVOTS) -> Codes | None:
    """Codebooks of the ``rows`` that ``clean`` made; None if there are none.

    They start from the vectors of the ``entries`` smallest ids (nulls last;
    equal ids in the order of their components; fewer, if there are fewer).
    Each round assigns every part and replaces an entry by its parts'
    componentwise mean, rounded down; entries without parts stay. All vectors
    must have one length that ``parts`` divides, and components within LARGEST:
    anything else is an error, as it has no codes.
    """
    # One aggregate of bounded size in each task; ids first, then what has the smallest of them.
    sizes = rows.agg(F.count("*").alias("n"), F.min(F.size("comps")).alias("lo"), F.max(F.size("comps")).alias("hi")).first()
    if not sizes["n"]:
        return None
    if sizes["lo"] != sizes["hi"] or sizes["lo"] % parts:
        raise ValueError(f"vectors of {sizes['lo']} to {sizes['hi']} components can't be cut into {parts} equal parts")
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "comps").limit(entries).select("comps").toPandas()
    books = _ints(first["comps"], sizes["lo"]).reshape(len(first), parts, -1).transpose(1, 0, 2).copy()
    if np.abs(books).max(initial=0) > LARGEST:
        raise ValueError(f"a component exceeds {LARGEST} after scaling")
    fixed = np.stack([choose_pivots(book, pivots) for book in books])
    as_text = rows.withColumn("vec_id", F.col("vec_id").cast("string"))
    ready, _ = written(as_text.mapInPandas(_prepare(fixed), fields(**_READY)), "pivots")
    for _ in range(rounds):
        found = ready.select("comps", "pivots").mapInPandas(_sums(books, fixed), fields(entry="long", n="long", total="long[]"))
        width = books.shape[2]
        sums = found.groupBy("entry").agg(F.sum("n").alias("n"), *[F.sum(F.get("total", F.lit(i))).alias(f"t{i}") for i in range(width)])
        # At most parts * entries rows.
        for row in sums.collect():
            at = divmod(row["entry"], books.shape[1])
            books[at] = [row[f"t{i}"] // row["n"] for i in range(width)]
    return Codes(ready, books, fixed)


def encode(codes: Codes) -> DataFrame:
    """vec_id, label, code (two hex digits for each part) and error (squared distances summed over parts) of every row."""
    books, fixed = codes.books, codes.pivots

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for some, _, code, best in _batches(batches, books, fixed):
            text = [bytes(c).hex() for c in code.astype(np.uint8)]
            yield pd.DataFrame({"vec_id": some["vec_id"], "label": some["label"], "code": text, "error": best.sum(axis=1)})

    return codes.rows.mapInPandas(run, fields(vec_id="string", label="string", code="string", error="long")).withColumn("vec_id", F.col("vec_id").cast("long"))


def compress(table: DataFrame, id_col: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """vec_id, code, error, label_error (errors summed over equal labels, nulls together), codebooks_sha256.

    One row for every row that takes part, see ``clean`` and ``fit``; without
    any the result is empty. Sums by label are broadcast up to LABELS labels;
    beyond that the join shuffles.
    """
    rows = clean(table, id_col, vector, label)
    codes = fit(rows)
    if codes is None:
        return table.sparkSession.createDataFrame([], fields(vec_id="long", code="string", error="long", label_error="long", codebooks_sha256="string"))
    coded, _ = written(encode(codes), "codes")
    sums, _ = bounded(coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error")), LABELS)
    return coded.join(sums, F.col("label").eqNullSafe(F.col("of"))).select("vec_id", "code", "error", "label_error", F.lit(codes.digest).alias("codebooks_sha256"))
