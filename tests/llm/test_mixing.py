import hashlib
import math
from collections import Counter

import pytest
from cases import ODD, docs
from daybook.llm import mixing as M
from pyspark.sql import functions as F


def slow(doc_id, text, rate, seed=M.SEED):
    """Copies of one document, by summing the distribution."""
    key = f"{seed}:{doc_id}" if doc_id is not None else f"{seed}:text:{hashlib.md5((text or '').encode()).hexdigest()}"
    draws, count = math.ceil(rate / M.MEAN), 0
    for j in range(1, draws + 1):
        u = int(hashlib.md5(f"{key}:{j}".encode()).hexdigest()[:13], 16) / 2 ** 52
        mean = rate / draws
        p = total = math.exp(-mean)
        k = 0
        while k < M.TERMS and total <= u:
            k += 1
            p *= mean / k
            total += p
            count += 1
    return count


def test_counts_against_plain_loops(spark):
    rows = ODD + [(100 + i, f"t{i}", "en", "abcd"[i % 4] if i % 9 else None, 1) for i in range(300)]
    weights = {"a": 1.0, "b": 5.0, None: 2.0, "c": 0.0}
    got = Counter((r["doc_id"], r["text"]) for r in M.mix(docs(spark, rows), weights, epochs=3.0).collect())
    n = Counter(r[3] for r in rows)
    want = Counter()
    for r in rows:
        rate = weights.get(r[3], 0.0) / 8.0 * 3.0 * len(rows) / n[r[3]]
        if rate:
            want[r[0], r[1]] += slow(r[0], r[1], rate)
    assert got == +want


def test_large_rates_and_weights_are_met(spark):
    rows = [(i, "t", "en", "big" if i else "tiny", 1) for i in range(2000)]
    got = Counter(r["source"] for r in M.mix(docs(spark, rows), {"big": 1.0, "tiny": 1.0}).select("source").collect())
    assert abs(got["tiny"] - 1000) < 150 and abs(got["big"] - 1000) < 150


def test_copies_are_numbered_and_shuffled(spark):
    rows = [(i, "t", "en", f"s{i // 100}", 1) for i in range(400)]
    out = M.mix(docs(spark, rows, clash=("copy", "shuffle_key", "rate", "__weight")), epochs=2.0)
    got = out.collect()
    theirs = ("__source", "__draws", "__upto", "__key", "__count")
    same = M.mix(docs(spark, rows, clash=theirs), epochs=2.0).collect()
    assert sorted(r["shuffle_key"] for r in same) == sorted(r["shuffle_key"] for r in got) and all(r[c] == "theirs" for r in same for c in theirs)
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append(r["copy"])
    assert all(sorted(c) == list(range(1, len(c) + 1)) for c in by.values())
    order = [r["doc_id"] for r in sorted(got, key=lambda r: r["shuffle_key"])]
    rising = sum(a <= b for a, b in zip(order, order[1:])) / len(order)
    assert 0.4 < rising < 0.6 and len({r["shuffle_key"] for r in got}) == len(got)


def test_sources_beyond_the_broadcast_bound(spark, monkeypatch):
    d = docs(spark, [(i, "t", "en", f"s{i % 5}", 1) for i in range(200)])
    want = sorted(r["shuffle_key"] for r in M.mix(d).collect())
    monkeypatch.setattr(M, "SOURCES", 0)
    assert sorted(r["shuffle_key"] for r in M.mix(d).collect()) == want


def test_zero_weights_and_empty_table(spark):
    assert M.mix(docs(spark, []), epochs=2.0).count() == 0
    assert M.mix(docs(spark), {"nowhere": 1.0}).count() == 0


def test_distribution_is_complete(spark):
    p = spark.range(1).select(M._cumulative(F.lit(M.MEAN)).alias("p")).first()["p"]
    assert len(p) == M.TERMS and p[-1] == pytest.approx(1.0, abs=1e-12) and p[0] == pytest.approx(math.exp(-M.MEAN))
