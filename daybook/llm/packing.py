"""Best-fit packing by bin completion with branch and bound.

Pieces of the same length are interchangeable, so the search runs on the
histogram of lengths, at most ``capacity`` numbers whatever the number of
documents. It fills one kind of sequence after another around the largest
piece left, taking an undominated filling as often as the counts allow, and
prunes by the waste that the incumbent leaves. Spark then deals the pieces
of each length to the places that the fillings have for them.
"""

from __future__ import annotations

import os
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.common import cut, fields, free, tokenizer_path

CAPACITY = 2048
END = 0  # id behind every document
TOKENIZER = "byte_bpe_50k.json"
#: The same vocabulary as ranks. Both give the same ids for texts of PLAIN characters; others take TOKENIZER.
RANKS = "byte_bpe_50k.tiktoken"
PLAIN = re.compile(r"[\t\n\r -~¡-ɏ]*")
SPECIAL = "<|endoftext|>"
NODES = 4_000  # branches that the search may take in all
FILLINGS = 8  # fillings kept for a branch
STEPS = 400  # combinations looked at for one branch
ROWS = 50_000  # pieces numbered together
Filling = tuple[tuple[int, int], ...]  # (length, times)

_LOADED: dict[str, object] = {}


def _exact():
    if "exact" not in _LOADED:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        _LOADED["exact"] = Tokenizer.from_file(tokenizer_path(TOKENIZER))
    return _LOADED["exact"]


def _fast():
    if "fast" not in _LOADED:
        import base64

        import public_tokenizers
        import tiktoken

        with open(tokenizer_path(RANKS), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _LOADED["fast"] = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _LOADED["fast"]


def token_ids(text: str | None) -> np.ndarray:
    """Ids of a whole text and the end id, as little-endian unsigned 32-bit numbers."""
    text = text or ""
    if PLAIN.fullmatch(text) and SPECIAL not in text:
        ids = _fast().encode_to_numpy(text, disallowed_special=())
    else:
        ids = _exact().encode(text, add_special_tokens=False).ids
    return np.append(np.asarray(ids, dtype="<u4"), np.array([END], dtype="<u4"))


def cuts(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens; only the first can be shorter than the capacity."""
    first = n if n <= capacity else (n % capacity or capacity)
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))]


def pieces(docs: DataFrame, id_col: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
           with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 and, if asked for, ids (array of long).

    A null text is an empty one: a single piece that holds the end id. Each
    repeated row gives pieces of its own; other columns are left behind.
    """
    schema = dict(start="long[]", length="long[]", ids_crc32="long[]") | ({"ids": "long[][]"} if with_ids else {})

    @F.pandas_udf(fields(**schema))
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = []
            for t in texts:
                ids = token_ids(t)
                at = cuts(len(ids), capacity)
                row = ([s for s, _ in at], [n for _, n in at], [zlib.crc32(ids[s:s + n].tobytes()) for s, n in at])
                rows.append(row + (([ids[s:s + n].tolist() for s, n in at],) if with_ids else ()))
            yield pd.DataFrame(rows, columns=list(schema))

    split = docs.select(F.col(f"`{id_col}`").alias("doc_id"), run(F.col(f"`{text}`")).alias("p"))
    return split.select("doc_id", F.posexplode(F.arrays_zip(*[F.col(f"p.{x}") for x in schema])).alias("piece", "q")) \
        .select("doc_id", "piece", *[F.col(f"q.{x}").alias(x) for x in schema])


def least_bins(counts: dict[int, int], capacity: int) -> int:
    """A number of bins that no packing goes below: by total length, and by items that can't share a bin."""
    total = sum(n * c for n, c in counts.items())
    best = -(-total // capacity)
    sizes = sorted(counts)
    for k in [0, *(n for n in sizes if n <= capacity // 2)]:
        alone = sum(counts[n] for n in sizes if n > capacity - k)
        half = [n for n in sizes if capacity // 2 < n <= capacity - k]
        free = sum((capacity - n) * counts[n] for n in half)
        small = sum(n * counts[n] for n in sizes if k <= n <= capacity // 2)
        best = max(best, alone + sum(counts[n] for n in half) + max(0, -(-(small - free) // capacity)))
    return best


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[Filling, int]]:
    """Best-fit decreasing over the histogram: equal bins are kept as one group with a number."""
    by_room: dict[int, dict[Filling, int]] = {}
    rooms: list[int] = []

    def put(room: int, filling: Filling, bins: int) -> None:
        group = by_room.setdefault(room, {})
        if not group and room not in rooms:
            rooms.insert(bisect_right(rooms, room), room)
        group[filling] = group.get(filling, 0) + bins

    for n in sorted(counts, reverse=True):
        left = counts[n]
        while left:
            at = next((r for r in rooms if r >= n and by_room[r]), None)
            if at is None:
                per = capacity // n
                if left >= per:
                    put(capacity - per * n, ((n, per),), left // per)
                if left % per:
                    put(capacity - left % per * n, ((n, left % per),), 1)
                break
            filling, bins = by_room[at].popitem()
            # The bin that just took a piece is the tightest for the next one as long as it fits.
            per = min(at // n, left)
            used = min(bins, left // per)
            if used < bins:
                by_room[at][filling] = bins - used
            put(at - per * n, (*filling, (n, per)), used)
            left -= per * used
    return [(f, b) for group in by_room.values() for f, b in group.items()]


def fullest(counts: dict[int, int], sizes: list[int], room: int) -> tuple[int, ...]:
    """The pieces that leave the least of ``room`` unfilled, the longest ones that do; by subset sums as bits of a number."""
    fits = sizes[:bisect_right(sizes, room)]
    within, reach = (1 << (room + 1)) - 1, [1]
    for n in fits:
        sums = once = reach[-1]
        for _ in range(min(counts[n], room // n)):
            once = once << n & within
            sums |= once
        reach.append(sums)
    rest, chosen = reach[-1].bit_length() - 1, []
    for i in range(len(fits) - 1, -1, -1):
        n = fits[i]
        k = min(counts[n], rest // n)
        while not reach[i] >> (rest - k * n) & 1:
            k -= 1
        chosen += [n] * k
        rest -= k * n
    return tuple(chosen)


def fillings(counts: dict[int, int], sizes: list[int], room: int) -> list[Filling]:
    """Undominated ways to fill ``room`` from the lengths left, least waste first, then fewest pieces.

    ``sizes`` is sorted. A filling is dominated if another of as many pieces
    has a piece at least as long in every place. At most STEPS combinations
    are looked at, the longest pieces first; if none of them fills the room
    exactly, the fullest filling of all joins them.
    """
    found: dict[tuple[int, ...], int] = {}
    steps = 0

    def extend(chosen: tuple[int, ...], rest: int, below: int) -> None:
        nonlocal steps
        last = bisect_right(sizes, min(rest, below)) - 1
        fits = False
        for i in range(last, -1, -1):
            n = sizes[i]
            if chosen.count(n) >= counts[n]:
                continue
            fits = True
            if steps >= STEPS or any(w == 0 for w in found.values()) and len(found) >= FILLINGS:
                break
            steps += 1
            extend((*chosen, n), rest - n, n)
        if not fits:
            found[chosen] = rest

    extend((), room, room)
    if min(found.values()):
        most = fullest(counts, sizes, room)
        found[most] = room - sum(most)
    best = sorted(found, key=lambda f: (found[f], len(f), [-n for n in f]))
    kept: list[tuple[int, ...]] = []
    for f in best:
        if not any(len(g) == len(f) and all(x >= y for x, y in zip(g, f)) for g in kept):
            kept.append(f)
        if len(kept) == FILLINGS:
            break
    return [tuple((n, f.count(n)) for n in dict.fromkeys(f)) for f in kept]


def complete(counts: dict[int, int], capacity: int = CAPACITY, nodes: int = NODES) -> list[tuple[Filling, int]]:
    """Fillings with the number of bins of each that pack the histogram in as few bins as were found.

    Depth first: around the largest length left the fillings are tried from
    the least waste on, each for as many bins as the counts allow. A branch
    ends when its waste can't beat the incumbent, which best fit supplies
    first; the search ends at the lower bound or after ``nodes`` branches.
    """
    counts = {n: c for n, c in counts.items() if c}
    if not counts:
        return []
    incumbent = best_fit(counts, capacity)
    best = sum(b for _, b in incumbent)
    floor = least_bins(counts, capacity)
    total = sum(n * c for n, c in counts.items())
    left, sizes = dict(counts), sorted(counts)
    path: list[tuple[Filling, int]] = []
    # Each frame: the fillings still to try; what the present one took.
    frames: list[list] = []
    bins = waste = 0

    def choices() -> list[Filling]:
        big = sizes[-1]
        left[big] -= 1
        rest = [n for n in sizes if left[n]]
        out = fillings(left, rest, capacity - big)
        left[big] += 1
        merged = []
        for f in out:
            take = dict(f)
            take[big] = take.get(big, 0) + 1
            merged.append(tuple(sorted(take.items(), reverse=True)))
        return merged[::-1]

    while best > floor:
        if sizes and nodes:
            frames.append([choices(), None])
        elif not sizes and bins < best:
            best, incumbent = bins, list(path)
        moved = False
        while frames and not moved:
            frame = frames[-1]
            if frame[1]:
                filling, times, lost = frame[1]
                path.pop()
                bins, waste = bins - times, waste - lost
                for n, k in filling:
                    left[n] += k * times
                sizes = sorted(n for n in left if left[n])
                frame[1] = None
            if not frame[0] or not nodes:
                frames.pop()
                continue
            filling = frame[0].pop()
            times = min(left[n] // k for n, k in filling)
            lost = times * (capacity - sum(n * k for n, k in filling))
            # A better packing leaves at most this much unfilled.
            if waste + lost > (best - 1) * capacity - total:
                continue
            nodes -= 1
            for n, k in filling:
                left[n] -= k * times
            sizes = [n for n in sizes if left[n]]
            path.append((filling, times))
            bins, waste = bins + times, waste + lost
            frame[1] = (filling, times, lost)
            moved = True
        if not frames:
            break
    return incumbent


def places(plan: list[tuple[Filling, int]]) -> dict[int, np.ndarray]:
    """For every length, rows (first number, times per bin, first bin, offset): who gets which place."""
    rows: dict[int, list[tuple[int, int, int, int]]] = {}
    given: dict[int, int] = {}
    first_bin = 0
    for filling, bins in plan:
        offset = 0
        for n, k in filling:
            rows.setdefault(n, []).append((given.get(n, 0), k, first_bin, offset))
            given[n] = given.get(n, 0) + k * bins
            offset += n * k
        first_bin += bins
    return {n: np.array(r, dtype=np.int64) for n, r in rows.items()}


def _deal(plan: dict[int, np.ndarray], names: list[str], at: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sequence = np.zeros(len(batch), dtype=np.int64)
            offset = np.zeros(len(batch), dtype=np.int64)
            number, length = batch[at].to_numpy(), batch["length"].to_numpy()
            for n in np.unique(length):
                rows = np.flatnonzero(length == n)
                table = plan[int(n)]
                hit = table[np.searchsorted(table[:, 0], number[rows], side="right") - 1]
                nth = number[rows] - hit[:, 0]
                sequence[rows] = hit[:, 2] + nth // hit[:, 1]
                offset[rows] = hit[:, 3] + nth % hit[:, 1] * n
            yield batch.assign(sequence_id=sequence, offset=offset)[names]
    return run


def pack(pieces: DataFrame, capacity: int = CAPACITY, nodes: int = NODES) -> DataFrame:
    """``pieces`` (with a long ``length`` from 1 to the capacity) and where each goes: sequence_id, offset.

    Only the histogram of lengths reaches the driver, and the fillings that
    return with the tasks are at most a few for each length. Pieces get
    their number among those of their length by blocks of about ROWS, so a
    length that a third of all pieces have is no single task. Repeated rows
    are packed one by one; no rows give no rows. Input columns called
    sequence_id or offset are replaced, all others stay, whatever their names.
    """
    row, block, nth, ahead, number = free(pieces, "row", "block", "nth", "ahead", "number")
    rows = cut(pieces.withColumn(row, F.monotonically_increasing_id()))
    n = rows.count()
    counts = {r["length"]: r["count"] for r in rows.groupBy("length").count().collect()}
    if any(not 1 <= x <= capacity for x in counts):
        raise ValueError("a piece is empty or longer than the capacity")
    plan = places(complete(counts, capacity, nodes))
    blocks = max(1, n // ROWS)
    rows = rows.withColumn(block, F.pmod(F.xxhash64(row), F.lit(blocks)))
    # At most capacity * blocks sums; each window is one length's blocks.
    before = Window.partitionBy("length").orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy("length", block).agg(F.count("*").alias("n")).select(
        "length", block, F.coalesce(F.sum("n").over(before), F.lit(0)).alias(ahead))
    inside = Window.partitionBy("length", block).orderBy(row)
    numbered = rows.withColumn(nth, F.row_number().over(inside)) \
        .join(sums, ["length", block]).withColumn(number, F.col(ahead) + F.col(nth) - 1)
    names = [c for c in pieces.columns if c.lower() not in ("sequence_id", "offset")]
    out = numbered.select(*[F.col(f"`{c}`") for c in names], number)
    schema = out.select(*[F.col(f"`{c}`") for c in names], F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset")).schema
    return out.mapInPandas(_deal(plan, [*names, "sequence_id", "offset"], number), schema)


