import numpy as np
import pytest
import xxhash
from cases import docs, words
from daybook.llm import simhash as S
from pyspark.sql import functions as F


def slow(text):
    w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        w = w.replace(c, " ")
    w = [x for x in w.split(" ") if x]
    grams = [" ".join(w[i:i + 4]) for i in range(max(1, len(w) - 3))] if w else []
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute(prints, bits):
    """Smallest position reachable from each."""
    label = list(range(len(prints)))
    near = [[j for j in range(len(prints)) if bin(prints[i] ^ prints[j]).count("1") <= bits] for i in range(len(prints))]
    changed = True
    while changed:
        changed = False
        for i, js in enumerate(near):
            low = min(label[j] for j in js)
            if low < label[i]:
                label[i], changed = low, True
    return label


def test_fingerprint_against_plain_loops(spark):
    for t in [None, "", " \n", "one", "a b c", "A B c D", "a b c d e a b c d", "KK É x\u0085y z", words(50), "x " * 9]:
        assert S.fingerprint(t) == slow(t), t
    # Spark's own XXH64 has the same seed.
    assert spark.range(1).select(F.xxhash64(F.lit("a b c d"))).first()[0] % (1 << 64) == xxhash.xxh64_intdigest(b"a b c d", 42)


@pytest.mark.parametrize("tries,node", [(3, 8), (3, 4096), (5, 16)])
def test_links_against_brute_force(spark, tries, node):
    rng = np.random.default_rng(2)
    base = rng.integers(0, 2 ** 64, 60, dtype=np.uint64)
    prints = list(base)
    for _ in range(300):
        p = int(prints[rng.integers(len(prints))])
        for b in rng.choice(64, rng.integers(1, 7), replace=False):
            p ^= 1 << int(b)
        prints.append(np.uint64(p))
    prints = sorted({int(p) for p in prints} | {0, 1, 2 ** 64 - 1, 15, 31})
    df = spark.createDataFrame([(int(np.uint64(p).view(np.int64)),) for p in prints], "fp long")
    root = {r["v"]: r["root"] for r in S.components(S.near_links(df, 4, tries, node)).collect()}
    label = brute(prints, 4)
    got = [root.get(int(np.uint64(p).view(np.int64)), int(np.uint64(p).view(np.int64))) for p in prints]
    assert all((got[i] == got[j]) == (label[i] == label[j]) for i in range(len(prints)) for j in range(i))


def test_budget_that_the_tries_cannot_hold(spark):
    with pytest.raises(ValueError):
        S.near_links(spark.createDataFrame([(1,)], "fp long"), 4, 1)


def test_odd_rows_against_brute_force(spark):
    long = words(400, 3)
    rows = [(20, long, "en", "a", 1), (21, long.replace("ba", "bo", 1), "en", "a", 1), (22, words(400, 9), "en", "a", 1), (23, "", "en", "a", 1), (24, "two words", "en", "a", 1)]
    from cases import ODD

    rows = ODD + rows
    d = docs(spark, rows, clash=("fp", "component_id", "root", "v"))
    got = sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["fp"] % (1 << 64), r["component_id"]) for r in S.groups(d).collect())
    prints = [slow(r[1]) if r[0] != 6 else S.fingerprint(r[1]) for r in rows]
    label = brute(prints, 4)
    want = []
    for i, r in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if label[j] == label[i] and rows[j][0] is not None]
        want.append((r[0] if r[0] is not None else -1, prints[i], min(ids, default=None)))
    assert got == sorted(want, key=lambda x: x[:2])
    kept = S.keep_one(d)
    assert kept.columns == d.columns
    ids = sorted(-1 if r["doc_id"] is None else r["doc_id"] for r in kept.collect())
    assert ids == sorted({-1 if c is None else c for _, _, c in want})


@pytest.mark.parametrize("parts", [1, 2, 5])
def test_ids_that_several_texts_share_lose_no_group(spark, parts):
    a, b = words(50, 1), words(50, 2)
    rows = [(1, a), (1, b), (2, b), (None, words(50, 3)), (None, words(50, 3)), (7, words(50, 4)), (7, words(50, 4)), (8, None), (8, "")]
    kept = S.keep_one(docs(spark, [(i, t, "en", "s", 1) for i, t in rows]).repartition(parts))
    got = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=repr)
    empty = [r for r in got if not r[1]]
    assert len(empty) == 1 and empty[0][0] == 8
    assert [r for r in got if r[1]] == sorted([(1, a), (1, b), (None, words(50, 3)), (7, words(50, 4))], key=repr)
    again = S.keep_one(docs(spark, [(i, t, "en", "s", 1) for i, t in reversed(rows)], clash=("__kept_id", "__kept_hash", "__kept_n")))
    assert again.columns[-3:] == ["__kept_id", "__kept_hash", "__kept_n"] and again.where("__kept_hash <> 'theirs'").count() == 0
    assert sorted(((r["doc_id"], r["text"]) for r in again.collect()), key=repr) == got


def test_dense_group_stays_linear(spark):
    """Thousands of fingerprints within a few bits give at most a few edges each."""
    prints = spark.range(4096).select((F.col("id") * F.lit(1 << 20)).alias("fp"))
    edges = S.near_links(prints)
    assert edges.count() <= 4096 * 3 * 4
    assert S.components(edges).select("root").distinct().count() == 1


def test_empty_table(spark):
    assert S.groups(docs(spark, [])).count() == 0 and S.keep_one(docs(spark, [])).count() == 0
