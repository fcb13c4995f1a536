"""Quality rules as a ledger of failure bits.

Every rule is evaluated once per document. The ledger row keeps all
measurements and one bit per failed rule; a policy is only a mask over those
bits, so verdicts under any policy version, and what each rule adds to it,
come from the stored bits without touching a text again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import fields

WINDOW = 8
SYMBOLS = b"#*$%&|<>"
BLANK = b" \t\n\x0b\x0c\r"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_shouts",
            "n_echo_words")
_STEP = np.uint64(0x9E3779B97F4A7C15)


def repeat_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words that lie in a ``window``-word run found twice or more in the list.

    Runs are compared by a rolling 64-bit hash first; the few that share one
    are then compared word by word, so the count is exact.
    """
    n = len(words) - window + 1
    if n < 2:
        return 0
    word = np.fromiter(map(hash, words), dtype=np.int64, count=len(words)).view(np.uint64)
    run = np.zeros(n, dtype=np.uint64)
    for k in range(window):
        run = run * _STEP + word[k:k + n]
    order = np.sort(run)
    twice = order[1:][order[1:] == order[:-1]]
    if not len(twice):
        return 0
    at = np.flatnonzero(np.isin(run, twice))
    found: dict[tuple, list[int]] = {}
    for i in at.tolist():
        found.setdefault(tuple(words[i:i + window]), []).append(i)
    starts = np.array([i for group in found.values() if len(group) > 1 for i in group], dtype=np.int64)
    if not len(starts):
        return 0
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + window, -1)
    return int((np.cumsum(edge) > 0).sum())


def measure(text: str | None) -> tuple[int, ...]:
    """All measurements of one text, in the order of MEASURES; a null text measures as an empty one."""
    raw = (text or "").encode()
    words = raw.split()  # bytes split on space and 0x09-0x0D only
    if not words:
        return (0,) * len(MEASURES)
    # A UTF-8 continuation byte is no character of its own.
    chars = len(text) - (len(raw) - len(raw.translate(None, BLANK)))
    lines = [x for x in raw.split(b"\n") if x.translate(None, BLANK)]
    return (len(words), chars, len(raw) - len(raw.translate(None, SYMBOLS)), len(lines), len(lines) - len(set(lines)),
            repeat_words(words), raw.count(b"!!"), sum(map(eq, words, words[1:])))


Get = Callable[[str], Column]


@dataclass(frozen=True)
class Rule:
    """``fails`` makes a boolean Column from a getter of measurements."""

    bit: int
    name: str
    fails: Callable[[Get], Column]


#: The ledger's rules. A bit keeps its meaning for good; a new rule takes a new bit.
RULES = (
    Rule(0, "few_words", lambda m: m("n_words") < 20),
    Rule(1, "repeated_runs", lambda m: 100 * m("n_repeat_words") > 30 * m("n_words")),
    Rule(2, "symbols", lambda m: 10 * m("n_symbols") > 3 * m("n_words")),
    Rule(3, "repeated_lines", lambda m: (m("n_dup_lines") >= 3) & (100 * m("n_dup_lines") > 30 * m("n_lines"))),
    Rule(4, "shouting", lambda m: 10 * m("n_shouts") > 3 * m("n_words")),
    Rule(5, "word_length", lambda m: (m("word_chars") < 2 * m("n_words")) | (m("word_chars") > 20 * m("n_words"))),
    Rule(6, "some_repeated_runs", lambda m: 100 * m("n_repeat_words") > 15 * m("n_words")),
    Rule(7, "many_symbols", lambda m: m("n_symbols") > m("n_words")),
    Rule(8, "echoes", lambda m: 10 * m("n_echo_words") > 3 * m("n_words")),
)


def mask(*names: str) -> int:
    """The policy mask of the named rules."""
    bits = {r.name: r.bit for r in RULES}
    return sum(1 << bits[n] for n in names)


BASE = mask("few_words", "repeated_runs")
#: Versioned policies: a document is rejected if any bit of the mask is set.
POLICIES = {
    "base": BASE,
    "v1": BASE | mask("many_symbols", "repeated_lines"),
    "v2": BASE | mask("symbols", "repeated_lines", "shouting", "word_length", "echoes"),
    "strict": (1 << 9) - 1,
}
POLICY = "v2"


@F.pandas_udf(fields(**dict.fromkeys(MEASURES, "long")))
def _measure(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for texts in batches:
        yield pd.DataFrame([measure(t) for t in texts], columns=list(MEASURES), dtype="int64")


def with_ledger(docs: DataFrame, text: str = "text", name: str = "ledger") -> DataFrame:
    """``docs`` with one struct column: the measurements and ``bits`` (long).

    One pass, no shuffle, every row and column kept, repeated rows too; an
    input column called ``name`` is replaced. A null or blank text measures
    zero everywhere and fails ``few_words`` alone.
    """
    measured = docs.withColumn(name, _measure(F.col(f"`{text}`")))

    def m(x: str) -> Column:
        return F.col(name)[x]

    bits = F.lit(0).cast("long")
    for rule in RULES:
        bits = bits.bitwiseOR(F.when(rule.fails(m), F.lit(1 << rule.bit)).otherwise(F.lit(0)).cast("long"))
    return measured.withColumn(name, F.struct(*[m(x).alias(x) for x in MEASURES], bits.alias("bits")))


def fails(bits: Column, policy: str | int) -> Column:
    """Whether the ledger's bits break the policy (a version's name, or a mask)."""
    return bits.bitwiseAND(F.lit(POLICIES[policy] if isinstance(policy, str) else policy).cast("long")) != 0


def ablations(bits: DataFrame, policies: dict[str, int] = POLICIES, column: str = "bits") -> DataFrame:
    """What each rule adds to each policy, from stored bits alone.

    One row per policy and rule of it: policy, rule, n_failed (documents
    failing the rule), n_only (rejected by it alone), n_kept (kept by the
    whole policy), n_kept_without (kept once it is left out). The bits are
    first counted by value, at most 2**rules groups and once for all
    policies, so the rest runs on a handful of rows. Null bits count as none
    failed; an empty ledger gives zero counts.
    """
    counts = bits.groupBy(F.coalesce(F.col(column), F.lit(0).cast("long")).alias("bits")).agg(F.count("*").alias("n"))

    def total(mask_: int, equal_to: int | None = None) -> Column:
        seen = F.col("bits").bitwiseAND(F.lit(mask_).cast("long"))
        return F.coalesce(F.sum(F.when(seen != 0 if equal_to is None else seen == equal_to, F.col("n"))), F.lit(0).cast("long"))

    rows = [F.struct(F.lit(name).alias("policy"), F.lit(rule.name).alias("rule"), total(bit).alias("n_failed"), total(want, bit).alias("n_only"),
                     total(want, 0).alias("n_kept"), total(want & ~bit, 0).alias("n_kept_without"))
            for name, want in policies.items() for rule in RULES if want & (bit := 1 << rule.bit)]
    return counts.agg(F.array(*rows).alias("r")).select(F.inline("r"))


def ablation(bits: DataFrame, policy: str = POLICY, column: str = "bits") -> DataFrame:
    """``ablations`` of one policy: rule, n_failed, n_only, n_kept, n_kept_without."""
    return ablations(bits, {policy: POLICIES[policy]}, column).drop("policy")
