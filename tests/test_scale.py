"""What must not grow with files or lines: findings of the third round."""

import os

import pytest
from conftest import SF_SMALL, SF_TINY
from daybook import session
from daybook.llm import lm
from daybook.operators import incremental, percentile
from daybook.plans import catalog, rendered
from daybook.sources import number_lines, read_logs, text
from pyspark.sql import functions as F


def _events(spark, n, users):
    return spark.range(n).select(
        F.col("id").alias("event_id"), (F.col("id") % users).alias("user_id"), F.element_at(F.array(*map(F.lit, ["error", "click", "view", "signup"])), (F.col("id") % 4 + 1).cast("int"))
        .alias("event_type"), (F.col("id") % 50).cast("double").alias("value"), F.timestamp_seconds(F.lit(1700000000) + F.col("id")).cast("timestamp_ntz").alias("ts"))


def _numbered(lines):
    rows = number_lines(lines).select(F.regexp_extract("file_path", "(k=.*)/", 1), "line_no", "value")
    return sorted(map(tuple, rows.collect()))


def test_packed_logs_hold_the_lines_of_the_container_files(spark, tmp_path):
    ev = _events(spark, 400, 40).unionByName(spark.createDataFrame([(1000, None, "click", 1.0, None), (None, 3, "error", None, None)], "event_id long, user_id long, event_type string, value double, ts timestamp_ntz"))
    for templates in (rendered.BASE, rendered.YARN):
        name = f"{tmp_path}/{len(templates)}"
        files = read_logs(spark, rendered.write_event_logs(ev, f"{name}-files", templates), positions=True, recursive=True)
        root = rendered.write_packed_logs(ev, f"{name}-packed", templates)
        want = _numbered(files)
        assert len(want) > 400 and _numbered(rendered.unpacked(spark.read.text(root), root, positions=True)) == want
    empty = rendered.write_packed_logs(ev.limit(0), f"{tmp_path}/empty")
    assert rendered.unpacked(spark.read.text(empty), empty).count() == 0


def test_logs_are_not_read_from_a_file_per_container(spark):
    containers = catalog.container_files(spark, SF_SMALL).count()
    files = rendered.rendered_logs(spark, SF_SMALL).inputFiles()
    assert len(files) <= max(8, spark.sparkContext.defaultParallelism * 4) < containers


def test_manifest_is_made_without_reading_lines(spark, monkeypatch):
    monkeypatch.setattr(catalog, "_logs", None)
    assert catalog.manifest_level_counts(spark, SF_TINY).count() == 4


def test_refresh_lists_once_however_many_steps(spark, tmp_path, monkeypatch):
    root = tmp_path / "logs"
    for i in range(5):
        d = root / f"application_1_000{i}"
        d.mkdir(parents=True)
        (d / f"container_1_000{i}_01_000001.log").write_text(f"17/01/01 00:00:0{i} INFO a: x\n")
    calls = []
    monkeypatch.setattr(incremental, "PATHS", 2)
    for name in ("listing", "read_logs"):
        plain = getattr(incremental, name)
        monkeypatch.setattr(incremental, name, lambda *a, _n=name, _f=plain, **kw: calls.append(_n) or _f(*a, **kw))
    rows, read = incremental.level_counts(spark, str(root), str(tmp_path / "store"))
    assert read == 5 and calls == ["listing", "read_logs"] and [tuple(r) for r in rows.collect()] == [("INFO", 5)]


@pytest.fixture()
def a_task_a_file(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = {k: spark.conf.get(k) for k in names}
    for k in names:
        spark.conf.set(k, "4096")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def _small_logs(root, containers):
    for i in containers:
        d = root / f"application_1_{i // 3:04d}"
        d.mkdir(parents=True, exist_ok=True)
        (d / f"container_1_{i // 3:04d}_01_{i:06d}'s log.log").write_text("17/01/01 00:00:00 INFO a: x\n")


def test_small_files_share_tasks(spark, tmp_path, monkeypatch, a_task_a_file):
    monkeypatch.setattr(session, "LISTERS", 1)
    most = spark.sparkContext.defaultParallelism * 4
    _small_logs(tmp_path / "logs", range(most + 8))
    assert incremental.listing(spark, str(tmp_path / "logs")).rdd.getNumPartitions() == most
    tasks = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    old = spark.conf.get(tasks)
    with session.few_listers(spark):
        assert int(spark.conf.get(tasks)) == most
    assert spark.conf.get(tasks) == old


def test_refresh_reads_all_in_one_step_and_later_only_new_files(spark, tmp_path, monkeypatch, a_task_a_file):
    root, store, scans, plain = tmp_path / "logs", tmp_path / "store", [], incremental.in_tasks
    monkeypatch.setattr(incremental, "PATHS", 2)
    monkeypatch.setattr(incremental, "in_tasks", lambda lines, *a: scans.append(lines.rdd.getNumPartitions()) or plain(lines, *a))
    _small_logs(root, range(7))
    assert incremental.level_counts(spark, str(root), str(store))[1] == 7
    assert scans == [7] and len(os.listdir(store)) == 1  # one step, as nothing was known
    scans.clear()
    _small_logs(root, range(7, 12))
    rows, read = incremental.level_counts(spark, str(root), str(store))
    assert read == 5 and sum(scans) == 5 and len(scans) > 1  # of twelve files the five new ones are opened
    assert [tuple(r) for r in rows.collect()] == [("INFO", 12)]


def test_a_manifest_of_a_folders_files_is_read_as_the_folder(spark, tmp_path, monkeypatch):
    root, asked, plain = tmp_path / "my logs", [], text.read_logs
    _small_logs(root / "a", range(7))
    _small_logs(root / "b", range(20, 22))
    keys = [str(p.relative_to(root)) for p in sorted(root.rglob("*.log")) if p.parent.parent.name == "a"]
    (root / "a" / "note's.txt").write_text("17/01/01 00:00:00 WARN a: not listed\n")

    def rows(many, named=keys):
        (tmp_path / "manifest.txt").write_text("".join(f" {k}\n\n{k}\n" for k in named))
        monkeypatch.setattr(text, "MANY", many)
        lines = text.read_manifest_logs(spark, str(tmp_path / "manifest.txt"), f"{root}/", positions=True)
        return lines.columns, sorted((r.file_path, r.line_no, r.value) for r in number_lines(lines).collect())

    want = rows(1000)
    assert len(want[1]) == 7
    monkeypatch.setattr(text, "read_logs", lambda s, paths, *a, **kw: asked.append(paths) or plain(s, paths, *a, **kw))
    assert rows(3) == want and asked == [f"{root}/a"]
    asked.clear()
    monkeypatch.setattr(text, "OTHERS", 0)
    assert rows(3) == want and len(asked[0]) == 7  # too many others: the files one by one
    for odd in ([*keys, "a/nowhere.log"], [*keys, "a"]):
        assert _outcome(lambda: rows(3, odd)) == _outcome(lambda: rows(1000, odd))


def _outcome(f):
    try:
        return f()
    except Exception as e:
        return type(e).__name__, "PATH_NOT_FOUND" in str(e)


def test_files_that_come_after_the_listing_are_no_part_of_a_manifest(spark, tmp_path, monkeypatch):
    root, plain = tmp_path / "logs", text.read_logs
    _small_logs(root, range(5))
    (tmp_path / "manifest.txt").write_text("".join(f"{p.relative_to(root)}\n" for p in root.rglob("*.log")))

    def late(*a, **kw):
        _small_logs(root, range(5, 9))
        return plain(*a, **kw)

    monkeypatch.setattr(text, "MANY", 3)
    monkeypatch.setattr(text, "read_logs", late)
    assert text.read_manifest_logs(spark, str(tmp_path / "manifest.txt"), str(root)).count() == 5


def test_narrowing_a_percentile_sorts_no_rows(spark, monkeypatch):
    plans, plain = [], percentile.cut

    def cut(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return plain(df)

    monkeypatch.setattr(percentile, "cut", cut)
    df = spark.range(20000).select((F.col("id") % 2).alias("g"), (F.col("id") * 7919 % 20011).alias("v"))
    got = {r.g: r.p for r in percentile.exact(df, ["g"], "v", 0.95, "p", inside=1000).collect()}
    for g in (0, 1):
        xs = sorted(i * 7919 % 20011 for i in range(20000) if i % 2 == g)
        assert got[g] == xs[9499]
    assert len(plans) > 2 and not any("SortAggregate" in p for p in plans)


def test_the_network_models_most_tokens(spark):
    d = spark.read.parquet(os.path.join(SF_SMALL, "documents.parquet"))
    model = lm.fit(d, rounds=0)
    assert model.rare_total < 0.35 * model.total and lm.ROUNDS == 2
