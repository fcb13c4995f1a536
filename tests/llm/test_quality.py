import random

import duckdb
from cases import ODD, docs
from daybook.llm import oracles, queries
from daybook.llm import quality as Q
from pyspark.sql import functions as F


def slow(text):
    """The measurements once more, by plain loops."""
    text = text or ""
    blank = " \t\n\x0b\x0c\r"
    words, now = [], ""
    for ch in text:
        if ch in blank:
            if now:
                words.append(now)
            now = ""
        else:
            now += ch
    if now:
        words.append(now)
    runs = {}
    for i in range(len(words) - 7):
        runs.setdefault(" ".join(words[i:i + 8]), []).append(i)
    covered = {i + k for at in runs.values() if len(at) > 1 for i in at for k in range(8)}
    seen, dup = set(), 0
    lines = [x for x in text.split("\n") if any(c not in blank for c in x)]
    for x in lines:
        dup += x in seen
        seen.add(x)
    if not words:
        return (0,) * 8
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines), dup, len(covered),
            text.count("!!"), sum(a == b for a, b in zip(words, words[1:])))


def test_measure_against_plain_loops():
    rng = random.Random(3)
    texts = [r[1] for r in ODD if r[0] != 6] + ["a\nb\na\n\n \nb", "x " * 7, "x " * 8, "x " * 9, "é é#\x85\xa0\x1c a!!"]
    texts += [" ".join(rng.choice("abc") for _ in range(rng.randrange(60))) for _ in range(200)]
    for t in texts:
        assert Q.measure(t) == slow(t), t


def test_odd_rows_and_clashing_columns(spark):
    out = Q.with_ledger(docs(spark, clash=("ledger", "bits", "n_words")), name="ledger")
    rows = out.collect()
    assert len(rows) == len(ODD)
    assert all(r["bits"] == "theirs" for r in rows)
    by = {r["doc_id"]: r["ledger"] for r in rows}
    assert by[2]["n_words"] == by[3]["n_words"] == by[4]["n_words"] == 0
    assert by[2]["bits"] == by[8]["bits"] == Q.mask("few_words")
    assert by[1]["bits"] == 0 and by[6]["n_words"] == 30_000
    assert by[9]["bits"] & Q.mask("repeated_runs") and by[9]["bits"] & Q.mask("echoes")


def test_policies_and_ablation(spark):
    rows = Q.with_ledger(docs(spark)).select("ledger.bits")
    got = {r["rule"]: r for r in Q.ablation(rows, "v2").collect()}
    bits = [r["bits"] for r in rows.collect()]
    want = Q.POLICIES["v2"]
    assert set(got) == {r.name for r in Q.RULES if want >> r.bit & 1}
    for r in Q.RULES:
        if want >> r.bit & 1:
            b = 1 << r.bit
            assert got[r.name][1:] == (sum(x & b != 0 for x in bits), sum(x & want == b for x in bits), sum(x & want == 0 for x in bits),
                                       sum(x & (want & ~b) == 0 for x in bits))
    none = Q.ablation(rows.where("bits < 0"), "base").collect()
    assert [tuple(r)[1:] for r in none] == [(0, 0, 0, 0)] * 2


def test_ablation_query_against_sql(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    out = queries.quality_ablation(spark, sf)
    got = sorted(tuple(r) for r in out.collect())
    assert got == sorted(con.execute(oracles.QUALITY_ABLATION).fetchall()) and len(got) == sum(w.bit_count() for w in Q.POLICIES.values())
    assert out.columns == [d[0] for d in con.description]


def test_empty_table(spark):
    assert Q.with_ledger(docs(spark, [])).where(Q.fails(F.col("ledger.bits"), "v1")).count() == 0
