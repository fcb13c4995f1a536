import math
import os
import zlib
from collections import Counter

import corpus_pipeline as C
import duckdb
import pytest
from cases import ODD, docs
from daybook.llm import langid, mixing, oracles, packing, quality, queries, simhash

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(oracles.ORACLES))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF, t)}.parquet')")
    df = queries.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    res = con.execute(oracles.ORACLES[name])
    at = [[d[0] for d in res.description].index(c) for c in cols]
    want = sorted((tuple(r[i] for i in at) for r in res.fetchall()), key=repr)
    assert sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr) == want


@pytest.mark.parametrize("name", ["op5_mixed_sources", "op6_license_scan", "op7_url_filter"])
def test_native_queries_run_no_python(spark, name):
    plan = queries.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"))


def test_stages_against_brute_force(spark):
    """The pipeline's rows again, by single-row helpers in plain Python."""
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select(*C.COLUMNS).collect()]

    def passes(text):
        m = dict(zip(quality.MEASURES, quality.measure(text)))
        n = m["n_words"]
        return not (n < 20 or 100 * m["n_repeat_words"] > 30 * n or 10 * m["n_symbols"] > 3 * n or 10 * m["n_shouts"] > 3 * n or 10 * m["n_echo_words"] > 3 * n
                    or m["n_dup_lines"] >= 3 and 100 * m["n_dup_lines"] > 30 * m["n_lines"] or not 2 * n <= m["word_chars"] <= 20 * n)

    kept = [r for r in rows if passes(r[1])]
    got = C.quality_rules(spark, docs(spark, rows), SF)
    assert Counter(map(tuple, got.collect())) == Counter(kept)

    profiles = langid.fit(docs(spark, [r for r in kept if zlib.crc32(str(r[0]).encode()) % 5]))
    known = [r for r in kept if profiles.score(r[1])[0] != "und" and profiles.score(r[1])[1] >= C.LEAST_SCORE]
    assert Counter(map(tuple, C.language_id(spark, docs(spark, kept), SF).collect())) == Counter(known)

    prints = [simhash.fingerprint(r[1]) for r in known]
    label = list(range(len(known)))
    changed = True
    while changed:
        changed = False
        for i in range(len(known)):
            low = min(label[j] for j in range(len(known)) if bin(prints[i] ^ prints[j]).count("1") <= 4)
            if low < label[i]:
                label[i], changed = low, True
    first = {}
    for i, r in enumerate(known):
        first.setdefault(label[i], []).append(r[0])
    one = [r for i, r in enumerate(known) if r[0] == min(first[label[i]])]
    assert Counter(map(tuple, C.simhash_near_dedup(spark, docs(spark, known), SF).collect())) == Counter(one)

    from test_mixing import slow

    sizes = Counter(r[3] for r in one)
    weight = {s: math.sqrt(n) for s, n in sizes.items()}
    mixed = Counter()
    for r in one:
        mixed[r] += slow(r[0], r[1], weight[r[3]] / sum(weight.values()) * len(one) / sizes[r[3]])
    assert Counter(map(tuple, C.mix_sources(spark, docs(spark, one), SF).collect())) == +mixed

    final = C.run(spark, SF).collect()
    want = Counter()
    for r, n in mixed.items():
        for i, (s, length) in enumerate(packing.cuts(len(packing.token_ids(r[1])))):
            want[r[0], i, s, length] += n
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"]) for r in final) == +want
    used = {}
    for r in sorted(final, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == used.get(r["sequence_id"], 0)
        used[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(used.values()) <= packing.CAPACITY
    assert len(used) <= packing.least_bins(Counter(r["length"] for r in final), packing.CAPACITY) + 1


def test_odd_rows_and_empty_table(spark):
    for rows in (ODD, []):
        d = docs(spark, rows, clash=("ledger", "told", "copy"))
        for _, stage in C.STAGES:
            d = stage(spark, d, SF)
            d.collect()
            if stage is not C.STAGES[-1][1]:
                assert d.columns == C.COLUMNS


def test_clean_documents_stay(spark):
    """No document labelled good is lost to the filters, but for ones the base rule drops."""
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    good = d.join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet").where("quality = 1"), "doc_id", "left_semi")
    rated = quality.with_ledger(good)
    base = rated.where(~quality.fails(rated["ledger.bits"], "base")).count()
    kept = C.quality_rules(spark, good, SF)
    assert kept.count() == base
    assert C.language_id(spark, kept, SF).count() == base
    assert mixing.POWER == 0.5


def test_workers_find_the_package(spark):
    from daybook.llm import common

    common.importable(spark)
    common.importable(spark)
    root = os.path.dirname(os.path.dirname(os.path.dirname(common.__file__)))
    assert spark.sparkContext.environment["PYTHONPATH"].split(os.pathsep).count(root) == 1
