"""Upserts that rewrite only the buckets they touch, and the versions of a table."""

from datetime import datetime, timedelta, timezone
from pathlib import Path

import numpy as np
import pytest

from granero.operators.upsert import bucket_of, merge_buckets, one_per_key, upsert
from granero.sinks import parts
from granero.sinks.mart import ParquetMart, StaleTable
from granero.sinks.parts import Part, PartLog, Version
from granero.sinks.targets import COBERTURA, CORREDOR, PRODUCTO_COBERTURA
from tests.helpers import bag, plan

KEYS, UPDATES = list(CORREDOR.keys), list(CORREDOR.updates)


def brokers(spark, rows):
    return spark.createDataFrame(rows, CORREDOR.schema)


def some(rng, n, agents=40):
    return [
        (None if rng.random() < 0.05 else int(rng.integers(agents)), int(rng.integers(4)), int(rng.integers(9)), str(rng.choice(["A", "B", None])))
        for _ in range(n)
    ]


@pytest.fixture
def mart(spark, base):
    return ParquetMart(spark, base + "/mart", rows_per_bucket=1_000, least_buckets=8)


def test_upserts_equal_a_whole_join(spark, mart):
    rng = np.random.default_rng(1)
    plain = brokers(spark, [])
    for size in (60, 5, 30, 1):
        rows = brokers(spark, some(rng, size))
        plain = spark.createDataFrame(upsert(plain, one_per_key(rows, KEYS, UPDATES), KEYS, UPDATES).collect(), CORREDOR.schema)
        mart.upsert(CORREDOR, rows)
        assert bag(mart.read(CORREDOR)) == bag(plain)


def test_untouched_buckets_are_neither_read_nor_written(spark, base, mart, monkeypatch):
    mart.upsert(CORREDOR, brokers(spark, [(i, 1, 5, "OLD") for i in range(200)]))
    before = mart.version(CORREDOR)
    assert len(before.parts) == before.buckets == 8
    rows = brokers(spark, [(7, 1, 6, "NEW"), (7, 2, 6, "ADDED")])
    touched = {f"{b} of 8" for (b,) in rows.select(bucket_of(KEYS, 8)).distinct().collect()}
    assert len(touched) < 3
    files = {name: sorted(map(str, Path(part.path).rglob("*.parquet"))) for name, part in before.parts.items()}
    times = {file: Path(file).stat().st_mtime_ns for own in files.values() for file in own}

    read, written = [], []
    write = mart._write

    def watched(target, merged, name):
        read.extend(merged.inputFiles())
        written.append(write(target, merged, name))
        return written[-1]

    monkeypatch.setattr(mart, "_write", watched)
    mart.upsert(CORREDOR, rows)
    stored = [file.removeprefix("file://") for file in read if "/Corredor/" in file]
    assert sorted(stored) == sorted(file for name in touched for file in files[name])
    assert {path.name for path in Path(written[0]).iterdir() if path.is_dir()} == {
        f"_bucket={name.split()[0]}" for name in touched
    }
    after = mart.version(CORREDOR)
    assert {name for name in after.parts if after.parts[name] != before.parts[name]} == touched
    assert {file: Path(file).stat().st_mtime_ns for file in times} == times
    want = {(i, 1): "OLD" for i in range(200)} | {(7, 1): "NEW", (7, 2): "ADDED"}
    assert {(r.AgenteID, r.CorredorID): r.NombreCorredor for r in mart.read(CORREDOR).collect()} == want


def test_the_merge_shuffles_once_for_both_sides(spark):
    stored, batch = brokers(spark, [(1, 1, 1, "A")]), brokers(spark, [(1, 1, 2, "B")])
    text = plan(merge_buckets(stored, batch, KEYS, UPDATES, 8, 3))
    assert text.count("Exchange") == 1 and "Join" not in text


def test_columns_that_are_no_updates_stay(spark):
    schema = "k int, changes string, stays string"
    stored = spark.createDataFrame([(1, "old", "old"), (None, "old", "old")], schema)
    batch = spark.createDataFrame([(1, None, "new"), (2, "new", "new"), (None, "new", "new")], schema)
    found = merge_buckets(stored, batch, ["k"], ["changes"], 4, 2).drop("_bucket")
    assert bag(found) == bag(upsert(stored, batch, ["k"], ["changes"]))
    assert bag(found) == {(None, 1, "old"): 1, ("new", 2, "new"): 1, ("new", None, "old"): 1}


def test_a_growing_table_gets_more_buckets(spark, base):
    mart = ParquetMart(spark, base + "/mart", rows_per_bucket=20, least_buckets=2)
    mart.upsert(CORREDOR, brokers(spark, [(i, 1, 5, "A") for i in range(30)]))
    assert mart.version(CORREDOR).buckets == 2
    mart.upsert(CORREDOR, brokers(spark, [(i, 1, 6, "B") for i in range(20, 120)]))
    version = mart.version(CORREDOR)
    assert version.buckets == 8 and version.rows == 120
    assert {name.split(" of ")[1] for name in version.parts} == {"8"}
    rows = mart.read(CORREDOR).collect()
    assert sorted((r.AgenteID, r.NombreCorredor) for r in rows) == [(i, "A" if i < 20 else "B") for i in range(120)]
    mart.upsert(CORREDOR, brokers(spark, [(0, 1, 7, "C")]))
    changed = mart.version(CORREDOR)
    assert changed.buckets == 8 and sum(changed.parts[name] != version.parts[name] for name in version.parts) == 1


def test_many_small_buckets_share_tasks(spark, base, monkeypatch):
    mart = ParquetMart(spark, base + "/mart", rows_per_bucket=1, least_buckets=128)
    tasks, write = [], mart._write

    def watched(target, merged, name):
        tasks.append(merged.rdd.getNumPartitions())
        return write(target, merged, name)

    monkeypatch.setattr(mart, "_write", watched)
    monkeypatch.setattr("granero.sinks.mart.LEAST_TASKS", 16)
    monkeypatch.setattr("granero.sources.folders.MOST_LISTING_TASKS", 16)
    rows = [(i, 1, 5, "A") for i in range(120)]
    mart.upsert(CORREDOR, brokers(spark, rows))
    version = mart.version(CORREDOR)
    assert version.buckets == 128 and version.rows == 120 and len(version.parts) > 64
    assert tasks == [16]

    setting = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before, tracker = spark.conf.get(setting), spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("listing", "listing")
    found = mart._rows(CORREDOR, list(version.parts.values()))
    spark.sparkContext.setJobGroup("other", "other")
    stages = [stage for job in tracker.getJobIdsForGroup("listing") for stage in tracker.getJobInfo(job).stageIds]
    assert [tracker.getStageInfo(stage).numTasks for stage in stages] == [16]
    assert spark.conf.get(setting) == before
    assert sorted(map(tuple, found.collect())) == rows


def test_empty_batches_and_overwrites(spark, mart):
    mart.upsert(CORREDOR, brokers(spark, []))
    assert mart.version(CORREDOR).number == 0 and mart.read(CORREDOR).count() == 0
    mart.upsert(CORREDOR, brokers(spark, [(1, 1, 1, "A"), (2, 2, 2, "B")]))
    mart.upsert(CORREDOR, brokers(spark, []))
    assert mart.version(CORREDOR).number == 1
    mart.overwrite(CORREDOR, brokers(spark, [(3, 3, 3, "C"), (3, 3, 1, "D")]))
    assert bag(mart.read(CORREDOR)) == {(3, 3, 3, "C"): 1}
    mart.overwrite(CORREDOR, brokers(spark, []))
    assert mart.read(CORREDOR).count() == 0
    with pytest.raises(ValueError, match="upsert"):
        mart.append(CORREDOR, brokers(spark, []))


def test_a_failed_upsert_changes_nothing(spark, mart, monkeypatch):
    mart.upsert(CORREDOR, brokers(spark, [(1, 1, 1, "A")]))
    before = mart.version(CORREDOR)

    def broken(target, rows, name):
        raise RuntimeError("lost")

    monkeypatch.setattr(mart, "_write", broken)
    with pytest.raises(RuntimeError):
        mart.upsert(CORREDOR, brokers(spark, [(1, 1, 2, "B")]))
    assert mart.version(CORREDOR) == before


# --- versions -------------------------------------------------------------------------


def test_a_version_lists_only_what_it_changes(spark, base, monkeypatch):
    monkeypatch.setattr(parts, "WHOLE_EVERY", 4)
    log = PartLog(spark, base)
    version, held = log.current("t"), {}
    assert version == Version("t")
    for step in range(1, 11):
        changes = {f"p{step}": Part(f"/f{step}", step, step)}
        if step % 3 == 0:
            changes["p1"] = None
        if step % 5 == 0:
            changes["p2"] = Part(f"/again{step}", 1)
        version = log.publish(version, changes, buckets=step)
        held.update(changes)
        live = {name: part for name, part in held.items() if part}
        assert log.current("t") == version == Version("t", step, live, step)
        listed = spark.read.parquet(f"{base}/versions/t/v={step:012d}").where("part is not null").count()
        assert listed == (len(live) if step % 4 == 0 else len(changes))
    assert log.current("other") == Version("other")


def test_two_writers_of_one_version_are_told_apart(spark, base):
    log = PartLog(spark, base)
    read = log.publish(log.current("t"), {"a": Part("/a", 1)})
    log.publish(read, {"b": Part("/b", 1)})
    with pytest.raises(StaleTable):
        log.publish(read, {"c": Part("/c", 1)})
    assert set(log.current("t").parts) == {"a", "b"}


def test_purge_drops_what_was_replaced_long_ago_once(spark, base, monkeypatch):
    monkeypatch.setattr(parts, "WHOLE_EVERY", 2)
    mart = ParquetMart(spark, base + "/mart")
    rows = spark.createDataFrame([(None, 1, "x")], COBERTURA.schema)
    folders = []
    for batch in ("one", "two", "one", "one", "one"):
        mart.append(COBERTURA, rows, batch)
        folders.append(mart.version(COBERTURA).parts[batch].path)
    now = datetime.now(timezone.utc)
    assert mart.purge(COBERTURA, now - timedelta(days=1)) == []
    assert mart.purge(COBERTURA, now + timedelta(minutes=1)) == [folders[0], folders[2]]
    assert [Path(folder).exists() for folder in folders] == [False, True, False, True, True]
    assert mart.purge(COBERTURA, now + timedelta(minutes=1)) == []
    assert mart.read(COBERTURA).count() == 2
    mart.append(COBERTURA, rows, "three")
    assert mart.read(COBERTURA).count() == 3


def test_appends_do_not_read_stored_rows(spark, base, monkeypatch):
    mart = ParquetMart(spark, base + "/mart")
    links = spark.createDataFrame([(1, None, 1, None, None, None)], PRODUCTO_COBERTURA.schema)
    mart.append(PRODUCTO_COBERTURA, links, "one")
    monkeypatch.setattr(mart, "_rows", lambda *_: pytest.fail("stored rows were read"))
    mart.append(PRODUCTO_COBERTURA, links, "two")
    assert mart.version(PRODUCTO_COBERTURA).rows == 2
