import hashlib

import duckdb
import numpy as np
import pytest
from daybook.llm import pivots as P
from daybook.llm.oracles import ORACLES
from daybook.llm.queries import QUERIES

SF_SMALL = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, parts=16, entries=64, rounds=2):
    """(vec_id, code, error, label_error) sorted, and the codebooks' digest, by full search."""
    rows = [r for r in rows if r[1] is not None and all(x is not None and np.isfinite(x) for x in r[1])]
    rows.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    x = np.floor(np.array([r[1] for r in rows], np.float32).astype(np.float64) * 256).astype(np.int64).reshape(len(rows), parts, -1)
    books = x[:entries].transpose(1, 0, 2).copy()

    def near():
        d = ((x[:, :, None] - books[None]) ** 2).sum(3)
        return d.argmin(2), d.min(2)

    for _ in range(rounds):
        code, _ = near()
        for p in range(parts):
            for e in range(books.shape[1]):
                mine = x[code[:, p] == e, p]
                if len(mine):
                    books[p, e] = mine.sum(0) // len(mine)
    code, best = near()
    error = best.sum(1)
    by_label = {}
    for r, e in zip(rows, error):
        by_label[r[2]] = by_label.get(r[2], 0) + int(e)
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    return sorted(((r[0], bytes(c.tolist()).hex(), int(e), by_label[r[2]]) for r, c, e in zip(rows, code, error)), key=repr), digest


def check(spark, rows, parts=3):
    got = P.compress(spark.createDataFrame(rows, SCHEMA).repartition(parts)).collect()
    want, digest = brute(list(rows))
    assert sorted(((r["vec_id"], r["code"], r["error"], r["label_error"]) for r in got), key=repr) == want
    assert {r["codebooks_sha256"] for r in got} == {digest}


def floats(rng, n, width=32, scale=1.0):
    return (rng.normal(size=(n, width)) * scale).astype(np.float32).tolist()


def test_random_vectors_with_ties_nulls_and_repeats(spark):
    rng = np.random.default_rng(3)
    rows = [(i, v, i % 5 if i % 7 else None) for i, v in enumerate(floats(rng, 400))]
    rows += rows[:3] + [(None, floats(rng, 1)[0], 1), (1000, None, 1), (1001, [None] * 32, 1), (1002, [float("nan")] * 32, 2), (1003, [float("inf")] * 32, 2),
                        (1004, [0.0] * 32, None), (9007199254740993, [0.0] * 32, 3)]
    rows += [(2000 + i, floats(np.random.default_rng(9), 1)[0], 4) for i in range(300)]  # one hot vector
    check(spark, rows)


@pytest.mark.parametrize("n", [1, 5, 64, 65])
def test_fewer_rows_than_entries(spark, n):
    check(spark, [(i, v, 0) for i, v in enumerate(floats(np.random.default_rng(n), n))])


def test_equal_entries_take_the_lower_index(spark):
    check(spark, [(i, [float(i % 2)] * 32, 0) for i in range(200)])


def test_large_components_stay_exact(spark):
    check(spark, [(i, v, 0) for i, v in enumerate(floats(np.random.default_rng(1), 150, scale=1000.0))])


def test_empty_tables_and_clashing_columns(spark):
    from pyspark.sql import functions as F

    assert P.compress(spark.createDataFrame([], SCHEMA)).count() == 0
    assert P.compress(spark.createDataFrame([(1, None, 2)], SCHEMA)).count() == 0
    df = spark.createDataFrame([(i, v, 0) for i, v in enumerate(floats(np.random.default_rng(2), 70))], SCHEMA)
    clash = df.withColumns({c: F.lit("theirs") for c in ("comps", "pivots", "code", "error", "of", "x")})
    assert sorted(P.compress(clash).collect()) == sorted(P.compress(df).collect())


def test_lengths_that_have_no_codes_are_errors(spark):
    with pytest.raises(ValueError):
        P.compress(spark.createDataFrame([(1, [0.5] * 32, 0), (2, [0.5] * 48, 0)], SCHEMA))
    with pytest.raises(ValueError):
        P.compress(spark.createDataFrame([(1, [0.5] * 30, 0)], SCHEMA))


def test_bounds_prune_and_never_change_a_code():
    rng = np.random.default_rng(5)
    parts = rng.integers(-200, 200, size=(700, 4, 4))
    books = np.stack([parts[:64, p] for p in range(4)])
    fixed = np.stack([P.choose_pivots(b) for b in books])
    moved = books + rng.integers(-40, 40, size=books.shape)
    code, best, evaluated = P.assign(parts, P.pivot_distances(parts, fixed), moved, fixed)
    d = ((parts[:, :, None] - moved[None]) ** 2).sum(3)
    assert (code == d.argmin(2)).all() and (best == d.min(2)).all()
    assert evaluated < 0.15 * d.size


def test_query_against_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF_SMALL}/embeddings.parquet'")
    want = con.execute(ORACLES["op12_laesa_codes"])
    columns = [d[0] for d in want.description]
    got = QUERIES["op12_laesa_codes"](spark, SF_SMALL).select(*columns).collect()
    assert sorted(map(tuple, got)) == sorted(want.fetchall())
