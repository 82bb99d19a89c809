"""The log-structured state of the performance mart, and the mart kept in parts."""

import re
from datetime import datetime
from urllib.parse import unquote

import pytest
from pyspark.sql import functions as F

from registra import schemas
from registra.plans import jobs, marts
from registra.plans import state as store
from registra.sources import sinks
from test_marts import log, logs_of

T0, T1 = datetime(2024, 1, 1), datetime(2024, 2, 1)
FIELDS = schemas.STUDENT_PERFORMANCE.fieldNames()


@pytest.fixture
def deps(spark):
    return spark.createDataFrame([(3, "three"), (9, "nine")], schemas.DEPARTMENTS)


def batch_of(spark, number, users, weeks=(1, 2)):
    return logs_of(spark, *[log(u, 10 * number + w, str(2 + (u + number) % 4), u * w + number, depart=3 + 6 * (u % 2)) for u in users for w in weeks])


def files(frame):
    """The files that rows come from; the others are pruned by their folder."""
    for scan in frame._jdf.queryExecution().executedPlan().toString().split("FileScan")[1:]:
        assert re.search(r"PartitionFilters: \[[^\]]*bucket", scan)
    return {unquote(r[0]) for r in frame.select(F.input_file_name()).distinct().collect()}


@pytest.mark.parametrize("variant", ["v1", "v2"])
def test_many_batches_give_the_mart_of_all_logs(spark, deps, tmp_path, variant):
    name, state = f"dmr_many_{variant}.performance", str(tmp_path / "state")
    every = None
    for number in range(6):
        logs = batch_of(spark, number, range(number, 20 + number, 1 + number % 3))
        every = logs if every is None else every.unionByName(logs)
        for _ in range(1 + number % 2):  # a batch that comes again changes nothing
            rows = jobs.run_arrivals(logs, number, state, deps, str(tmp_path), T0, variant, name, buckets=4)
        published = sinks.current_mart(spark, name)
        assert published.columns == FIELDS and [f.dataType for f in published.schema] == [f.dataType for f in schemas.STUDENT_PERFORMANCE]
        wanted = marts.student_performance(every, deps, None, T0, variant).collect()
        if variant == "v2":
            assert sorted(published.collect()) == sorted(wanted)
        assert rows == len(wanted) == published.count()
    manifest = store.read_manifest(spark, state)
    assert manifest.batches == ((0, 5),) and sorted(r.level for r in manifest.runs) == [0, 0, 1]
    assert len(list((tmp_path / "state" / "manifest").glob("0*"))) == 2
    assert len(list((tmp_path / "state" / "runs").iterdir())) == 3
    held = {p.table for p in manifest.marts[name].parts} | set(manifest.marts[name].before)
    assert {t for t in sinks.list_tables(spark, name.split(".")[0]) if "_part_" in t} == held | {f"{t}_counts" for t in held}


def test_a_run_touches_the_buckets_of_its_batch(spark, deps, tmp_path):
    """What a small batch reads and writes does not grow with the history in other buckets."""
    sizes = []
    for scale in (20, 400):
        name, state = f"dmr_small_{scale}.performance", str(tmp_path / f"state{scale}")
        jobs.run_arrivals(batch_of(spark, 0, range(scale)), 0, state, deps, str(tmp_path / "marts"), T0, name=name, buckets=16)
        before = store.read_manifest(spark, state).marts[name].parts
        one = logs_of(spark, log(1, 50, "5", 9))
        jobs.run_arrivals(one, 1, state, deps, str(tmp_path / "marts"), T1, name=name)
        after = store.read_manifest(spark, state).marts[name].parts
        bucket = after[-1].buckets
        assert len(bucket) == 1 and [p.table for p in after[:-1]] == [p.table for p in before]
        assert set(after[0].buckets) == set(before[0].buckets) - set(bucket)
        database = name.split(".")[0]
        fresh = spark.table(f"{database}.{after[-1].table}")
        assert {r["bucket"] for r in fresh.select("bucket").distinct().collect()} == set(bucket)
        read = files(store.read(spark, state, bucket))
        assert read and all(f"/bucket={bucket[0]}/" in f for f in read)
        old = files(sinks.parts_frame(spark, name, [store.Part(before[0].table, bucket)]))
        assert len(old) == 1 and all(f"/bucket={bucket[0]}/" in f for f in old)
        sizes.append((len(read), len(old), len(files(fresh.filter(F.col("bucket") >= 0)))))
        published = {r.student_id: r for r in sinks.current_mart(spark, name).collect()}
        assert len(published) == scale and {r.last_update for r in published.values()} == {T1}
        assert published[1].final_grade == 5
    assert sizes[0] == sizes[1]


def test_changed_departments_and_other_publishers_rewrite_all(spark, deps, tmp_path):
    name, state = "dmr_changed.performance", str(tmp_path / "state")
    early, late = batch_of(spark, 0, range(8)), batch_of(spark, 1, [3])
    assert jobs.run_performance_mart(logs_of(spark, log(77, 1, "4")), deps, str(tmp_path), T0, name=name) == 1
    assert jobs.run_arrivals(early, 0, state, deps, str(tmp_path), T0, name=name, buckets=4) == 9  # the older row stays
    renamed = spark.createDataFrame([(3, "drei"), (9, "neun")], schemas.DEPARTMENTS)
    assert jobs.run_arrivals(late, 1, state, renamed, str(tmp_path), T1, name=name) == 9
    names = {r.student_id: r.department_name for r in sinks.current_mart(spark, name).collect()}
    assert {names[u] for u in range(8)} == {"drei", "neun"}
    assert jobs.run_performance_mart(logs_of(spark, log(78, 1, "4")), renamed, str(tmp_path), T1, name=name) == 10
    assert jobs.run_arrivals(batch_of(spark, 2, [4]), 2, state, renamed, str(tmp_path), T1, name=name) == 10


def test_many_parts_are_written_together(spark, deps, tmp_path):
    name, state = "dmr_parts.performance", str(tmp_path / "state")
    jobs.run_arrivals(batch_of(spark, 0, range(60)), 0, state, deps, str(tmp_path), T0, name=name, buckets=32)
    for number in range(1, 15):
        jobs.run_arrivals(logs_of(spark, log(number, 60, "5", 3)), number, state, deps, str(tmp_path), T0, name=name)
        parts = store.read_manifest(spark, state).marts[name].parts
        assert len(parts) <= jobs.MOST_PARTS + 1
        assert sorted(b for p in parts for b in p.buckets) == sorted({b for p in parts for b in p.buckets})
    assert sinks.current_mart(spark, name).count() == 60


def test_refused_rows_leave_mart_and_state_usable(spark, deps, tmp_path):
    name, state = "dmr_refused.performance", str(tmp_path / "state")
    jobs.run_arrivals(logs_of(spark, log(1, 1, "4")), 0, state, deps, str(tmp_path), T0, name=name, buckets=4)
    wide = logs_of(spark, *[log(2, w, "4", 90_000_000) for w in range(1, 31)])
    with pytest.raises(ValueError, match="counter width"):
        jobs.run_arrivals(wide, 1, state, deps, str(tmp_path), T0, name=name)
    assert [r.student_id for r in sinks.current_mart(spark, name).collect()] == [1]
    with pytest.raises(ValueError, match="variant"):
        store.add(wide, state, 2, "v1")


def test_a_failed_write_leaves_the_state(spark, tmp_path, monkeypatch):
    state = str(tmp_path / "state")
    store.add(batch_of(spark, 0, range(5)), state, 0, buckets=4)
    before = sorted(map(tuple, store.read(spark, state).collect()))

    def fail(*_):
        raise OSError("no space")

    monkeypatch.setattr(store, "write_manifest", fail)
    with pytest.raises(OSError):
        store.add(batch_of(spark, 1, range(5)), state, 1)
    monkeypatch.undo()
    assert sorted(map(tuple, store.read(spark, state).collect())) == before
    assert not store.read_manifest(spark, state).has(1)


def test_empty_batches_and_no_state(spark, deps, tmp_path):
    state = str(tmp_path / "state")
    assert jobs.run_arrivals(logs_of(spark), 0, state, deps, str(tmp_path), T0, name="dmr_empty.performance", buckets=4) == 0
    assert jobs.run_arrivals(logs_of(spark, log(1, 1, "4")), 1, state, deps, str(tmp_path), T0, name="dmr_empty.performance") == 1
    with pytest.raises(ValueError, match="no state"):
        store.read(spark, str(tmp_path / "other"))


def test_a_bucket_is_written_by_several_tasks(spark, deps, tmp_path):
    name, state = "dmr_dealt.performance", tmp_path / "state"
    jobs.run_arrivals(batch_of(spark, 0, range(200)), 0, str(state), deps, str(tmp_path), T0, name=name, buckets=1)
    assert int(spark.conf.get("spark.sql.shuffle.partitions")) > 1
    assert len(list(state.glob("runs/*/bucket=0/part-*"))) > 1
    part = sinks.published_parts(spark, name)[0]
    assert spark.table(f"dmr_dealt.{part}").select(F.input_file_name()).distinct().count() > 1
