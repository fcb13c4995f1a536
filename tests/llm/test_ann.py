import numpy as np
import pytest
from daybook.llm import ann as A

SF_SMALL = "/root/testdata/sf0.01"


def brute(ids, vectors, k=20, every=20):
    out = {}
    for q in sorted({i for i in ids if i % every == 0}):
        for v in {tuple(vectors[i]) for i in range(len(ids)) if ids[i] == q}:
            pairs = sorted({(-float(np.dot(v, vectors[i])), ids[i]) for i in range(len(ids)) if ids[i] != q})[:k]
            out[q] = [(i, -s) for s, i in pairs]
    return out


def run(spark, rows, **kw):
    df = A.clean(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"))
    got = {}
    for r in A.neighbours(df, **kw).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return got


def test_recall_over_the_table(spark, monkeypatch):
    monkeypatch.setattr(A, "LEAF", 32)
    rows = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").toPandas()
    ids, vectors = rows["vec_id"].tolist(), np.array(rows["embedding"].tolist(), dtype=np.float64)
    df = A.clean(spark.read.parquet(f"{SF_SMALL}/embeddings.parquet"))
    index = A.build(df)
    assert index.tree.leaves > 8
    got = A.search(df, index).toPandas()
    want = brute(ids, vectors)
    hit = sum(len({i for i, _ in want[q]} & set(g["vec_id"])) for q, g in got.groupby("query_id"))
    assert hit / (20 * len(want)) >= 0.9 and set(got["query_id"]) == set(want)
    exact = {(q, i): s for q, near in want.items() for i, s in near}
    for q, i, s in zip(got["query_id"], got["vec_id"], got["score"]):
        assert s == pytest.approx(float(vectors[ids.index(q)] @ vectors[ids.index(i)]), abs=1e-12)
        assert (q, i) not in exact or exact[q, i] == pytest.approx(s, abs=1e-12)


def test_walk_visits_every_leaf_once():
    points = np.random.default_rng(1).normal(size=(500, 8))
    tree = A.grow(points, 40)
    order = list(tree.walk(points[0]))
    assert sorted(order) == list(range(tree.leaves)) and 20 <= tree.leaves <= 40
    leaf = tree.assign(points)
    assert set(leaf) <= set(range(tree.leaves))


def test_widening_reaches_the_target(spark, monkeypatch):
    monkeypatch.setattr(A, "LEAF", 16)
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=6).tolist(), 0) for i in range(600)]
    df = A.clean(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"))
    visits = [A.build(df, recall=r).visits for r in (0.2, 0.9, 1.0)]
    assert visits[0] < visits[1] <= visits[2]


def test_hot_vector_ties_and_rows_that_take_no_part(spark):
    rng = np.random.default_rng(3)
    same = [1.0, 2.0, 0.5]
    rows = [(i, same if i % 3 == 0 else rng.integers(-4, 5, 3).astype(float).tolist(), 0) for i in range(1, 400)]
    bad = [(1000, None, 0), (1020, [0.0, 0.0, 0.0], 0), (1040, [1.0, None, 2.0], 0), (1060, [1.0, float("nan"), 0.0], 0), (1080, [float("inf"), 1.0, 1.0], 0),
           (None, same, 0), (1101, [1.0, 2.0], 0), (1120, [], 0)]
    repeated = [rows[0], rows[0], rows[59], rows[59]]
    got = run(spark, rows + bad + repeated)
    live = [r for r in rows if any(r[1])]
    want = brute([r[0] for r in live], np.array([r[1] for r in live]))
    assert set(got) == set(want)
    for q in want:
        assert [r for r, _, _ in got[q]] == list(range(1, 21))
        assert [i for _, i, _ in got[q]] == [i for i, _ in want[q]]
        assert [s for *_, s in got[q]] == pytest.approx([s for _, s in want[q]])


@pytest.mark.parametrize("parts", [1, 4])
def test_two_lengths_are_searched_each(spark, parts):
    rng = np.random.default_rng(8)
    rows = [(i, rng.normal(size=3 if i % 5 < 2 else 6).tolist(), 0) for i in range(300)]
    df = A.clean(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(parts))
    got = {}
    for r in A.neighbours(df).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    want = {}
    for n in (3, 6):
        some = [(i, np.array(v, dtype=np.float32)) for i, v, _ in rows if len(v) == n]
        want |= brute([i for i, _ in some], np.array([v for _, v in some], dtype=np.float64))
    assert got == {q: [i for i, _ in near] for q, near in want.items()}


def test_fewer_rows_than_neighbours(spark):
    got = run(spark, [(0, [1.0, 0.0], 0), (1, [0.5, 0.5], 0), (2, [2.0, 0.0], 0)])
    assert [(r, i) for r, i, _ in got[0]] == [(1, 2), (2, 1)]
    assert run(spark, [(20, [1.0], 0)]) == {}
    assert run(spark, []) == {} and run(spark, [(1, [1.0], 0), (2, [1.0], 0)]) == {}


def test_blocks_of_a_hot_leaf_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(A, "BLOCK", 16)
    rng = np.random.default_rng(9)
    rows = [(i, rng.normal(size=4).tolist(), 0) for i in range(300)]
    got = run(spark, rows)
    want = brute([r[0] for r in rows], np.array([np.array(r[1], dtype=np.float32) for r in rows], dtype=np.float64))
    for q in want:
        assert [i for _, i, _ in got[q]] == [i for i, _ in want[q]]


def test_best_keeps_ties_at_the_edge():
    out = A._best(np.array([[1.0]]), np.ones((50, 1)), [[i] for i in range(49, -1, -1)], 3)
    assert out == [[(-1.0, 0), (-1.0, 1), (-1.0, 2), (-1.0, 3)]]


def test_blocks_hold_what_they_should():
    of, parts = A.deal_blocks(np.array([3, 3, 3, 25, 1, 9, 0, 10]), 10)
    assert of.tolist() == [0, 0, 0, 1, 2, 2, 2, 3] and parts.tolist() == [1, 3, 1, 1]
