import math
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from daybook.llm import ranked as R
from daybook.llm.common import ascii_lower
from daybook.llm.oracles import ORACLES
from daybook.llm.queries import QUERIES
from pyspark.sql import functions as F

from cases import DOCS, ODD, docs, words

SF_SMALL = "/root/testdata/sf0.01"
UPPER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def split(text):
    return re.findall(R.TERM, (text or "").translate(UPPER))


def brute(rows, items, k=10):
    counts = [(i, Counter(split(t))) for i, t in rows]
    counts = [(i, c, sum(c.values())) for i, c in counts if c]
    n_docs, total = len(counts), sum(n for _, _, n in counts)
    df = Counter(t for _, c, _ in counts for t in c)
    out = []
    for item, text in items:
        found = []
        for doc, c, n in counts:
            m = 10 + 90 * n * n_docs // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10 ** 9 * c[t] // (1000 * c[t] + 8 * m)) for t in set(split(text)) & set(c))
            if score > 0:
                found.append((-score, doc is None, doc or 0, doc))
        out += [(item, rank, f[3], -f[0]) for rank, f in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=repr)


def check(spark, rows, items, parts=3, k=10):
    df = docs(spark, rows, clash=("item_id", "score", "rank", "term", "item")).repartition(parts)
    asked = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'theirs' AS doc_id")
    got = sorted(map(tuple, R.search(df, asked, k).collect()), key=repr)
    assert got == brute([r[:2] for r in rows], items, k)
    return got


ITEMS = [(1, words(30, 1)), (2, "Kelvin K é 中文 x y z"), (3, None), (4, ""), (5, "nowhere-found"), (None, words(12, 6)), (1, "ha ha HA"), (7, words(30, 1))]


def test_odd_documents_and_items(spark):
    assert check(spark, ODD, ITEMS)
    assert check(spark, ODD, ITEMS, parts=1, k=2)


@pytest.mark.parametrize("limits", [(3, 1 << 20, 1024), (1 << 14, 40, 4), (1 << 14, 1 << 20, 1)])
def test_shards_and_splits_against_brute_force(spark, monkeypatch, limits):
    """Workers of a local session are forked from the driver's modules only once, so the shard is also searched here."""
    docs_most, postings_most, dense = limits
    for name, value in zip(("DOCS", "POSTINGS", "DENSE"), limits):
        monkeypatch.setattr(R, name, value)
    rng = np.random.default_rng(7)
    rows = [(int(i), " ".join(f"w{x}" for x in rng.zipf(1.4, size=int(rng.integers(1, 60))) % 50)) for i in rng.permutation(400)]
    rows += [(500 + i, "w1 w2 w3 w4") for i in range(200)]  # copies
    items = [(j, " ".join(f"w{x}" for x in rng.integers(0, 60, size=8))) for j in range(20)] + [(99, "w1 w2 w3 w4")]
    vocabulary = {t: i for i, t in enumerate(sorted({t.encode() for _, text in items for t in split(text)}))}
    n_docs, total = len(rows), sum(len(split(t)) for _, t in rows)
    df = Counter(t for _, text in rows for t in {x.encode() for x in split(text)})
    weights = np.array([R.weight(n_docs, df[t]) if t in df else 0 for t in sorted(vocabulary)], np.int64)
    best, opened = [[] for _ in items], 0
    shard = R.Shard(weights, lambda n: 10 + 90 * n * n_docs // total)

    def through():
        nonlocal opened
        shard.index()
        for i, (_, text) in enumerate(items):
            opened += shard.search(np.array(sorted(vocabulary[t.encode()] for t in set(split(text)))), best[i], 10)

    for doc, text in rows:
        c = Counter(R.terms(text.encode()))
        shard.add(doc, sum(c.values()), [(vocabulary[t], c[t]) for t in vocabulary.keys() & c.keys()])
        if shard.full:
            through()
            shard = R.Shard(weights, shard.length)
    through()
    got = sorted(((items[i][0], rank, doc, -loss) for i, found in enumerate(best) for rank, (loss, (_, doc)) in enumerate(found, 1)), key=repr)
    assert got == brute(rows, items)
    if dense == 1 and docs_most == 1 << 14:
        assert opened < 0.5 * len(items) * len(rows)  # intervals fall unopened


def test_copies_cost_no_more_than_the_first(spark):
    rows = [(i, "a b c d e") for i in range(5000)] + [(9000 + i, f"x{i} y z") for i in range(5000)]
    shard = R.Shard(np.array([5, 7], np.int64), lambda n: 50)
    for i, _ in rows:
        shard.add(i, 5, [(0, 1), (1, 1)] if i < 5000 else [])
    shard.index()
    best = []
    assert shard.search(np.array([0, 1]), best, 10) < 60
    assert [doc for _, (_, doc) in best] == list(range(10))


def test_range_maxima_by_brute_force():
    rng = np.random.default_rng(2)
    shard = R.Shard(np.array([3, 1, 9], np.int64), lambda n: n)
    for i in range(200):
        shard.add(i, int(rng.integers(1, 9)), [(t, int(rng.integers(1, 5))) for t in range(3) if rng.random() < 0.7])
    shard.index()
    for _ in range(300):
        lo = rng.integers(shard.start, shard.end + 1)
        hi = np.array([rng.integers(a, b + 1) for a, b in zip(lo, shard.end)])
        parts = [shard.impact[a:b] for a, b in zip(lo, hi) if b > a]
        bound, at = shard.greatest(lo, hi)
        assert bound == sum(int(p.max()) for p in parts)
        assert not parts or shard.impact[at] == max(int(p.max()) for p in parts)


def test_empty_tables_and_many_blocks(spark, monkeypatch):
    asked = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert R.search(spark.createDataFrame([], DOCS), asked).count() == 0
    assert R.search(docs(spark), asked.limit(0)).count() == 0
    assert R.search(docs(spark, [(1, None, None, None, None), (2, "...", None, None, None)]), asked).count() == 0
    monkeypatch.setattr(R, "ITEMS", 2)
    check(spark, ODD, ITEMS)


def test_terms_are_those_of_the_pattern(spark):
    texts = ["".join(chr(c) for c in range(0, 256)), "Kelvin K İ ı ſ", "a_b-c~d`e@f[g", "\u0085x y z", words(200, 3)]
    for t in texts:
        assert [x.decode() for x in R.terms(t.encode())] == split(t)
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(ascii_lower(F.col("t")))
    assert [split(r[0]) for r in df.collect()] == [split(t) for t in texts]


def test_query_against_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    want = con.execute(ORACLES["op13_ranked_search"])
    columns = [d[0] for d in want.description]
    got = QUERIES["op13_ranked_search"](spark, SF_SMALL).select(*columns).collect()
    assert sorted(map(tuple, got)) == sorted(want.fetchall())
