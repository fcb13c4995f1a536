"""Use over time against plain Python, with hot keys dealt over many partitions."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from daybook.operators import overtime, yarn
from daybook.operators.ordered import Carry, carried

T0 = dt.datetime(2024, 3, 10, 1, 30)  # before a daylight-saving change in New York


@pytest.fixture(autouse=True)
def many_partitions(spark):
    """No merging of small partitions, so that one key really spans several."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def at(seconds):
    return None if seconds is None else T0 + dt.timedelta(seconds=seconds)


def random_intervals(seed, n, hot=0.6):
    rnd = random.Random(seed)
    rows = []
    for _ in range(n):
        key = "hot" if rnd.random() < hot else rnd.choice(["a", "b", None])
        s = rnd.randrange(0, 5000)
        e = rnd.choice([None, s, s + rnd.randrange(1, 30), s + rnd.randrange(1, 30), s - 3])
        rows.append((key, s, e))
    return rows + rows[:5] + [("only-open", 7, None), ("empty", 3, 3), ("gone", None, 9), ("gone", None, None)]


def frame(spark, rows, parts=6):
    return spark.createDataFrame([(k, at(s), at(e)) for k, s, e in rows], "k string, start_time timestamp_ntz, end_time timestamp_ntz").repartition(parts)


def sweep(rows):
    out = {}
    for k in {r[0] for r in rows}:
        mine = [(s, None if e is None else max(s, e)) for key, s, e in rows if key == k and s is not None]
        if not mine:
            continue
        points = sorted({s for s, _ in mine} | {e for _, e in mine if e is not None})
        now = {t: sum(s <= t and (e is None or t < e) for s, e in mine) for t in points}
        peak = max(now.values())
        busy = sum(b - a for a, b in zip(points, points[1:]) if now[a] > 0)
        out[k] = (len(mine), sum(e is None for _, e in mine), peak, at(min(t for t in points if now[t] == peak)), busy)
    return out


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_concurrency(spark, zone):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        rows = random_intervals(1, 400) + [("dst", 0, 7200)]
        got = {r.k: (r.intervals, r.open_intervals, r.peak, r.peak_time, r.busy_sec) for r in overtime.concurrency(frame(spark, rows), ["k"], end="end_time").collect()}
        assert got == sweep(rows) and got["dst"][4] == 7200
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_busy_spells_and_cluster_use(spark):
    rows = random_intervals(2, 60, hot=0.8)
    got = {r.k: (r.busy_sec, r.gaps, r.gap_sec, r.longest_gap_sec) for r in overtime.busy_spells(frame(spark, rows), ["k"]).collect()}
    want = {}
    for k in {r[0] for r in rows}:
        mine = sorted((s, max(s, s if e is None else e)) for key, s, e in rows if key == k and s is not None)
        gaps, upto = [], None
        for s, e in mine:
            if upto is not None and s > upto:
                gaps.append(s - upto)
            upto = e if upto is None else max(upto, e)
        if mine:
            want[k] = (upto - mine[0][0] - sum(gaps), len(gaps), sum(gaps), max(gaps, default=0))
    assert got == want
    use = overtime.cluster_use(frame(spark, rows).withColumn("cluster_id", F.coalesce("k", F.lit("none")))).collect()
    assert {r.cluster_id: r.applications for r in use} == {k or "none": v[0] for k, v in sweep(rows).items()}


def test_overlaps_count_each_pair_once(spark):
    rnd = random.Random(5)
    rows = [("hot" if i % 3 else "b", i, *sorted((rnd.randrange(3000), rnd.randrange(3000)))) for i in range(90)]
    rows += [("hot", 1000, 50, 50), ("hot", 1001, 0, 2999), ("hot", 1002, 0, 2999), (None, 1, 5, 9), (None, 2, 8, 20), ("open", 1, 3, None), ("gone", 1, None, None)]
    df = spark.createDataFrame([(k, n, at(s), at(e)) for k, n, s, e in rows], "k string, n int, s timestamp_ntz, e timestamp_ntz").repartition(5)
    got = sorted(((r.k or "", r.n_a, r.n_b, r.overlap_sec) for r in overtime.overlaps(df, ["k"], "n", "s", "e").collect()))
    want = sorted((a[0] or "", a[1], b[1], min(a[3], b[3]) - max(a[2], b[2])) for a in rows for b in rows
                  if a[0] == b[0] and a[1] < b[1] and None not in a[2:] + b[2:] and min(a[3], b[3]) > max(a[2], b[2]))
    assert got == want


def test_retries_across_files_with_a_hot_chain(spark):
    rnd = random.Random(9)
    rows = []
    for tid in range(300):
        task = 0 if tid < 150 else tid % 7
        s = rnd.randrange(1000)
        done = rnd.random() < 0.6
        rows.append(("app", f"c{tid % 3}", 1 if task else 0, 0, task, tid, s, s + rnd.randrange(20) if done else None))
    rows += [("app", "c0", 9, 0, 1, 900, None, 5), ("app", "c0", 9, 0, 1, 901, None, None)]
    schema = "application_id string, container_id string, stage bigint, stage_attempt bigint, task bigint, tid bigint, start_time timestamp_ntz, finish_time timestamp_ntz"
    df = spark.createDataFrame([(*r[:6], at(r[6]), at(r[7])) for r in rows], schema).withColumn(
        "duration_sec", F.timestamp_diff("SECOND", "start_time", "finish_time").cast("double"))
    got = {(r.application_id, r.stage): tuple(r)[2:] for r in overtime.retries(df.repartition(4)).collect()}
    chains = {}
    for r in rows:
        chains.setdefault((r[0], r[2], r[3], r[4]), []).append(r)
    want = {}
    for (app, stage, _, _), c in chains.items():
        began = [r[6] if r[6] is not None else r[7] for r in c]
        order = sorted(range(len(c)), key=lambda i: (began[i] is not None, began[i] or 0, c[i][5]))
        c, began = [c[i] for i in order], [began[i] for i in order]
        lost = 0
        for i, r in enumerate(c[:-1]):
            if r[7] is not None:
                lost += r[7] - r[6] if r[6] is not None else 0
            elif began[i] is not None:
                lost += began[i + 1] - began[i]
        w = want.setdefault((app, stage), [0, 0, 0, 0, 0.0, 0, 0])
        w[0] += 1
        w[1] += len(c) > 1
        w[2] = max(w[2], len(c))
        w[3] += len(c) - 1
        w[4] += lost
        w[5] += c[-1][7] is not None
        w[6] += c[-1][7] is None
    # A null start sorts first going forward, so last going back: nulls come first in the descending order's negated column.
    assert {k: v for k, v in got.items() if k[1] != 9} == {k: tuple(v) for k, v in want.items() if k[1] != 9}
    assert got["app", 9][:4] == (1, 1, 2, 1)


def test_memory_is_matched_with_the_store_started_last(spark, tmp_path):
    from daybook.sources import read_logs

    folder = tmp_path / "application_1_0001"
    folder.mkdir()
    start = "24/03/10 01:{:02d}:00 INFO storage.MemoryStore: MemoryStore started with capacity {}"
    block = "24/03/10 01:{:02d}:00 INFO storage.MemoryStore: Block b stored as values in memory (estimated size 1.0 KB, free {})"
    (folder / "container_1_0001_01_000001.log").write_text("\n".join([
        block.format(1, "1.0 MB"), start.format(2, "4.0 MB"), block.format(3, "1.0 MB"), block.format(3, "3.0 MB"), "noise MemoryStore",
        start.format(4, "1.0 GB"), block.format(5, "256.0 MB"), block.format(6, "0.25 GB")]) + "\n")
    (folder / "container_1_0001_01_000002.log").write_text(block.format(1, "1.0 MB") + "\n")
    (folder / "container_1_0001_01_000003.log").write_text("nothing here\n")
    got = {r.container_id[-1]: tuple(r)[2:] for r in overtime.memory_over_time(read_logs(spark, str(folder), positions=True)).collect()}
    assert got == {"1": (5, 1, 0.75, dt.datetime(2024, 3, 10, 1, 3), 4.0, 1.0), "2": (1, 1, None, None, None, None)}


def test_empty_inputs(spark):
    df = frame(spark, [])
    assert overtime.concurrency(df, ["k"], end="end_time").count() == 0
    assert overtime.busy_spells(df, ["k"]).count() == 0
    assert overtime.overlaps(df.withColumn("n", F.lit(1)), ["k"], "n", "start_time", "end_time").count() == 0
    lines = spark.createDataFrame([], "value string, file_path string, file_block_start bigint, row_pos bigint")
    attempts = yarn.task_attempts(lines)
    assert overtime.retries(attempts).count() == 0 and overtime.stage_overlaps(attempts).count() == 0
    assert overtime.memory_over_time(lines).count() == 0


def test_carried_over_partitions_of_one_key(spark):
    rnd = random.Random(3)
    rows = [("k" if i % 10 else None, i, rnd.randrange(100), rnd.choice([None, i])) for i in range(2000)]
    df = spark.createDataFrame(rows, "k string, i int, v int, l int").repartition(7)
    out = carried(df, ["k"], ["i"], Carry("sum", F.col("v"), "s"), Carry("max", F.col("v"), "m", inclusive=False), Carry("last", F.col("l"), "p"))
    assert out.select(F.spark_partition_id()).distinct().count() > 3
    state = {}
    got = {r.i: (r.s, r.m, r.p) for r in out.collect()}
    for k, i, v, l in rows:
        s, m, p = state.get(k, (0, None, None))
        p = p if l is None else l
        assert got[i] == (s + v, m, p)
        state[k] = (s + v, v if m is None else max(m, v), p)
