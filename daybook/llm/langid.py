"""Language identification with hyperdimensional profiles.

Each letter has a random vector of +1/-1. An n-gram is bound by multiplying
its letters' vectors, each permuted (rotated) by its place; a text is the
bundle (sum) of its n-grams, a language the bundle of its texts. The
language whose prototype has the largest cosine with the text wins.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import cut, fields

DIM = 1024
GRAM = 3
LETTERS = 64  # codes: 0 for a gap between words, the rest for letters
CHUNK = 2048  # n-gram vectors held at once
HELD = 1 << 21  # n-grams that a task gathers before it adds them up
MAX_LANGUAGES = 2000  # prototypes are collected and sent to every task; refuse past this
UNKNOWN = "und"


def letter_codes() -> np.ndarray:
    """Code of every character below U+0800; 0 means it is no letter. Later letters are folded by ``code_of``."""
    return np.array([_fold(i) if chr(i).isalpha() else 0 for i in range(0x800)], dtype=np.int64)


def _fold(point: int) -> int:
    """a-z get codes of their own, other letters share the remaining ones by their code point."""
    low = ord(chr(point).lower()[0])
    return low - 96 if 97 <= low <= 122 else 27 + low % (LETTERS - 27)


_CODES = letter_codes()


def codes(text: str) -> np.ndarray:
    """Letter codes of a text, every run of other characters as a single gap, with a gap at both ends."""
    points = np.frombuffer(f" {text} ".encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    if points.max(initial=0) < len(_CODES):
        out = _CODES[points]
    else:
        known, inverse = np.unique(points, return_inverse=True)
        out = np.array([_fold(p) if chr(p).isalpha() else 0 for p in known.tolist()], dtype=np.int64)[inverse]
    keep = np.ones(len(out), dtype=bool)
    keep[1:] = (out[1:] != 0) | (out[:-1] != 0)
    return out[keep]


def grams(text: str | None) -> np.ndarray:
    """Indices of the text's letter n-grams; empty if it holds no letter."""
    c = codes(text or "")
    if len(c) < GRAM:
        return np.empty(0, dtype=np.int64)
    out = np.zeros(len(c) - GRAM + 1, dtype=np.int64)
    for k in range(GRAM):
        out = out * LETTERS + c[k:k + len(out)]
    return out


def letter_vectors(dim: int = DIM, seed: int = 7) -> np.ndarray:
    return np.random.default_rng(seed).choice(np.array([-1, 1], dtype=np.int8), size=(LETTERS, dim))


_TABLE: dict[int, np.ndarray] = {}


def bind(which: np.ndarray, dim: int = DIM) -> np.ndarray:
    """The n-gram vectors: product of the letters' vectors, each rotated by its place."""
    if dim not in _TABLE:
        base = letter_vectors(dim)
        _TABLE[dim] = np.stack([np.roll(base, GRAM - 1 - k, axis=1) for k in range(GRAM)])
    places = _TABLE[dim]
    out = places[GRAM - 1][which % LETTERS]
    for k in range(GRAM - 2, -1, -1):
        which = which // LETTERS
        out = out * places[k][which % LETTERS]
    return out


def bundle_grams(which: np.ndarray, dim: int = DIM) -> np.ndarray:
    """The sum of the vectors of all these n-grams, a bounded number of them at a time."""
    which, times = np.unique(which, return_counts=True)
    out = np.zeros(dim)
    for a in range(0, len(which), CHUNK):
        out += times[a:a + CHUNK].astype(np.float32) @ bind(which[a:a + CHUNK], dim).astype(np.float32)
    return out


def bundle(text: str | None, dim: int = DIM) -> np.ndarray | None:
    """The text's vector, or None if it has no letter."""
    which = grams(text)
    return bundle_grams(which, dim) if len(which) else None


def _partial(dim: int):
    """Per task, one row (lang, vector sum, documents) for every language it met."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[str, np.ndarray] = {}
        docs: dict[str, int] = {}
        waiting: dict[str, list[np.ndarray]] = {}
        held = 0

        def add() -> None:
            for lang, parts in waiting.items():
                total[lang] = total.get(lang, 0) + bundle_grams(np.concatenate(parts), dim)
            waiting.clear()

        for batch in batches:
            for text, lang in zip(batch["text"], batch["lang"]):
                g = grams(text)
                if len(g):
                    waiting.setdefault(lang, []).append(g.astype(np.int32))
                    docs[lang] = docs.get(lang, 0) + 1
                    held += len(g)
                    if held > HELD:
                        add()
                        held = 0
        add()
        if total:
            yield pd.DataFrame({"lang": list(total), "vector": [v.tolist() for v in total.values()],
                                "docs": [docs[x] for x in total]})
    return run


@dataclass
class Profiles:
    """Languages in order, their unit prototypes, and the mean they were centred on."""

    langs: list[str]
    prototypes: np.ndarray
    centre: np.ndarray

    def score(self, text: str | None) -> tuple[str, float]:
        vector = bundle(text, self.prototypes.shape[1])
        if vector is None or not self.langs:
            return UNKNOWN, 0.0
        v = vector / (np.linalg.norm(vector) or 1.0) - self.centre
        cosine = self.prototypes @ v / (np.linalg.norm(v) or 1.0)
        best = int(np.argmax(cosine))  # ties go to the first language in order
        return self.langs[best], float(min(1.0, max(0.0, cosine[best])))


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", dim: int = DIM) -> Profiles:
    """Prototypes from every row with a language and a letter; other rows add nothing.

    Each task sums its own documents, the sums are added up by language and
    dimension, and languages x dim numbers reach the driver, whatever the
    number of rows. More than MAX_LANGUAGES languages raise an error. No
    labelled row gives no language, and every text scores ``und``.
    """
    rows = docs.select(F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").alias("lang")).where("lang IS NOT NULL")
    parts = rows.mapInPandas(_partial(dim), fields(lang="string", vector="double[]", docs="long"))
    summed = (parts.select("lang", F.posexplode("vector").alias("i", "x"))
              .groupBy("lang", "i").agg(F.sum("x").alias("x"))
              .groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("i", "x"))).alias("v")))
    got = cut(summed.select("lang", F.col("v.x").alias("v"))).limit(MAX_LANGUAGES + 1).collect()
    if len(got) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages: {lang} is no language column")
    got.sort(key=lambda r: r["lang"])
    unit = np.array([r["v"] for r in got], dtype=np.float64).reshape(len(got), dim)
    unit /= np.maximum(np.linalg.norm(unit, axis=1, keepdims=True), 1e-12)
    # All languages share letters; what they share tells nothing apart.
    centre = unit.mean(axis=0) if len(got) > 1 else np.zeros(dim)
    unit = unit - centre
    unit /= np.maximum(np.linalg.norm(unit, axis=1, keepdims=True), 1e-12)
    return Profiles([r["lang"] for r in got], unit, centre)


def predict(text: Column, profiles: Profiles) -> Column:
    """Struct (lang_pred, score) of a text column; ``und`` and 0 for a null text or one without letters.

    The score is the cosine with the winning prototype, negative ones as 0.
    Texts of any length count whole; each repeated row is told by itself. As a
    column it leaves the other columns, whatever their names, as they are; an empty table gives no rows.
    The prototypes travel with the task: languages x dim numbers.
    """
    @F.pandas_udf(fields(lang_pred="string", score="double"))
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([profiles.score(t) for t in texts], columns=["lang_pred", "score"])

    return run(text)


