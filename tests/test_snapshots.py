from datetime import datetime, timedelta, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from granero.sources.snapshots import FileTable, SnapshotStore
from granero.sources.staging import stage, staging_dir, staging_path, staging_scope
from granero.sources.tables import scan, scan_sources
from tests.helpers import bag, plan

NOW = datetime(2030, 1, 1, tzinfo=timezone.utc)


@pytest.fixture
def source(spark, base):
    path = f"{base}/source"
    spark.range(3).write.parquet(path)
    return path


def test_snapshot_does_not_follow_its_source(spark, base, source):
    store = SnapshotStore(spark, f"{base}/snapshots")
    frozen = store.take({"t": spark.read.parquet(source)})["t"]
    spark.range(5).write.mode("append").parquet(source)
    assert spark.read.parquet(source).count() == 8
    assert frozen.count() == 3
    assert store.read("t").count() == 3


def test_manifest_row(spark, base, source):
    store = SnapshotStore(spark, base + "/s")
    store.take({"t": spark.read.parquet(source)}, now=NOW)
    row = store.manifest.entries().first()
    assert (row["name"], row.row_count) == ("t_snapshot", 3)
    assert row.expires_at - row.created_at == timedelta(days=7)


def test_expired_is_not_readable_and_can_be_taken_again(spark, base, source):
    store = SnapshotStore(spark, base + "/s")
    store.take({"t": spark.read.parquet(source)}, now=NOW)
    late = NOW + timedelta(days=7)
    assert store.read("t", late - timedelta(seconds=1)).count() == 3
    with pytest.raises(FileNotFoundError):
        store.read("t", late)
    spark.range(1).write.mode("append").parquet(source)
    assert store.take({"t": spark.read.parquet(source)}, now=late)["t"].count() == 4


def test_existing_snapshot(spark, base, source):
    store = SnapshotStore(spark, base + "/s")
    store.take({"t": spark.read.parquet(source)}, now=NOW)
    spark.range(1).write.mode("append").parquet(source)
    table = {"t": spark.read.parquet(source)}
    later = NOW + timedelta(hours=1)
    with pytest.raises(FileExistsError):
        store.take(table, now=later)
    assert store.take(table, if_exists="reuse", now=later)["t"].count() == 3
    assert store.take(table, if_exists="new", now=later)["t"].count() == 4
    assert store.read("t", later).count() == 4
    with pytest.raises(ValueError):
        store.take(table, if_exists="skip")


def test_purge_deletes_only_what_expired(spark, base, source):
    store = SnapshotStore(spark, base + "/s")
    store.take({"t": spark.read.parquet(source)}, now=NOW)
    later = NOW + timedelta(days=6)
    store.take({"t": spark.read.parquet(source)}, if_exists="new", now=later)
    purged = store.purge(NOW + timedelta(days=8))
    assert len(purged) == 1 and not Path(purged[0]).exists()
    assert store.read("t", NOW + timedelta(days=8)).count() == 3
    assert store.purge(NOW + timedelta(days=8)) == []


def test_scan_reads_only_the_columns_asked_for(spark, sf_dir):
    df = scan(spark, f"{sf_dir}/part.parquet", ["p_partkey", "p_name"])
    assert "ReadSchema: struct<p_partkey:bigint,p_name:string>" in plan(df)


def test_scan_filter_reaches_the_files(spark, sf_dir):
    df = scan(spark, f"{sf_dir}/part.parquet").where("p_partkey > 150").select("p_name")
    assert "GreaterThan(p_partkey,150)" in plan(df)


def test_scan_sources_keeps_the_used_columns(spark, base):
    wide = spark.createDataFrame([("1", "x", 9)], "cod_tarifa string, txt_desc string, other int")
    wide.write.parquet(base + "/ttarifa")
    tables = scan_sources(spark, {"ttarifa": base + "/ttarifa"})
    assert tables["ttarifa"].columns == ["cod_tarifa", "txt_desc"]


def test_scan_of_a_catalog_table(spark, sf_dir):
    scan(spark, f"{sf_dir}/region.parquet").createOrReplaceTempView("region_view")
    assert scan(spark, "region_view", ["r_name"], format="table").count() == 5


def test_stage_keeps_rows_and_types(spark):
    df = spark.sql("SELECT 1 AS a, CAST(NULL AS STRING) AS b, 2D AS c")
    staged = stage(df)
    assert staged.schema.simpleString() == df.schema.simpleString()
    assert bag(staged) == bag(df)


def test_scope_deletes_what_was_staged_inside(spark):
    outside = stage(spark.range(2))
    with staging_scope(spark):
        inside = stage(spark.range(3))
        (file,) = {row[0].rsplit("/", 1)[0] for row in inside.select(F.input_file_name()).collect()}
        folder = Path(file.removeprefix("file:").replace("///", "/"))
        assert folder.exists()
    assert not folder.exists()
    assert outside.count() == 2
    assert staging_path(spark) != staging_path(spark)


class Session:
    """Stands in for a session that has only settings."""

    def __init__(self, **settings):
        values = {name.replace("_", "."): value for name, value in settings.items()}
        self.conf = type("Conf", (), {"get": values.get, "set": values.__setitem__})


def test_staging_folder_is_the_one_the_cluster_names():
    named = Session(spark_master="yarn", spark_checkpoint_dir="hdfs:///shared")
    assert staging_dir(named) == "hdfs:///shared"


def test_a_local_session_gets_one_folder_of_its_own():
    local = Session(spark_master="local[2]")
    folder = staging_dir(local)
    assert Path(folder).is_dir() and staging_dir(local) == folder


def test_no_machine_local_staging_on_a_cluster():
    with pytest.raises(RuntimeError):
        staging_dir(Session(spark_master="yarn"))


# --- tables of files ------------------------------------------------------------------


def copied_files(base):
    return sorted(str(path) for path in Path(base, "s").rglob("*.parquet") if "manifest" not in str(path))


def test_an_unchanged_table_is_frozen_again_without_writing(spark, base, source):
    store = SnapshotStore(spark, f"{base}/s")
    table = {"t": FileTable(source)}
    assert store.take(table, now=NOW)["t"].count() == 3
    before = copied_files(base)
    again = store.take(table, if_exists="new", now=NOW + timedelta(hours=1))["t"]
    assert copied_files(base) == before and bag(again) == bag(spark.range(3))
    assert store.manifest.entries().count() == 2


def test_only_new_and_changed_files_are_copied(spark, base, source):
    store = SnapshotStore(spark, f"{base}/s")
    first = store.take({"t": FileTable(source)}, now=NOW)["t"]
    before = copied_files(base)
    spark.range(10, 14).coalesce(1).write.mode("append").parquet(source)
    assert first.count() == 3 and store.read("t", NOW).count() == 3
    second = store.take({"t": FileTable(source)}, if_exists="new", now=NOW + timedelta(hours=1))["t"]
    assert sorted(row.id for row in second.collect()) == [0, 1, 2, 10, 11, 12, 13]
    assert len(copied_files(base)) == len(before) + 1 and set(before) < set(copied_files(base))

    removed = sorted(Path(source).glob("*.parquet"), key=lambda path: -spark.read.parquet(str(path)).count())
    kept = [row.id for row in spark.read.parquet(str(removed[0])).collect()]
    for path in removed[1:]:
        path.unlink()
    third = store.take({"t": FileTable(source)}, if_exists="new", now=NOW + timedelta(hours=2))["t"]
    assert sorted(row.id for row in third.collect()) == sorted(kept)
    assert sorted(row.id for row in second.collect()) == [0, 1, 2, 10, 11, 12, 13]
    assert len(copied_files(base)) == len(before) + 1

    spark.range(50, 52).write.mode("overwrite").parquet(source)
    fourth = store.take({"t": FileTable(source)}, if_exists="new", now=NOW + timedelta(hours=3))["t"]
    assert sorted(row.id for row in fourth.collect()) == [50, 51]


def test_frozen_files_keep_columns_and_other_columns_are_copied_apart(spark, base):
    path = f"{base}/wide"
    spark.createDataFrame([(1, "x", None), (2, None, 5)], "id int, name string, other int").write.parquet(path)
    store = SnapshotStore(spark, f"{base}/s")
    narrow = store.take({"t": FileTable(path, ("id", "name"))}, now=NOW)["t"]
    assert bag(narrow) == {(1, "x"): 1, (2, None): 1} and narrow.columns == ["id", "name"]
    wide = store.take({"t": FileTable(path)}, if_exists="new", now=NOW + timedelta(hours=1))["t"]
    assert bag(wide) == {(1, "x", None): 1, (2, None, 5): 1}


def test_tables_without_rows_or_files(spark, base):
    spark.range(0).write.parquet(f"{base}/none")
    store = SnapshotStore(spark, f"{base}/s")
    assert store.take({"t": FileTable(f"{base}/none")}, now=NOW)["t"].columns == ["id"]
    assert store.read("t", NOW).count() == 0
    with pytest.raises(Exception):
        store.take({"u": FileTable(f"{base}/missing")}, now=NOW)


def test_purge_keeps_files_that_a_later_snapshot_shares(spark, base, source):
    store = SnapshotStore(spark, f"{base}/s")
    store.take({"t": FileTable(source)}, now=NOW)
    spark.range(7, 8).coalesce(1).write.mode("append").parquet(source)
    later = NOW + timedelta(days=6)
    store.take({"t": FileTable(source)}, if_exists="new", now=later)
    assert store.purge(NOW + timedelta(days=8)) == []
    assert store.read("t", NOW + timedelta(days=8)).count() == 4
    assert len(store.purge(NOW + timedelta(days=14))) > 0
    assert store.purge(NOW + timedelta(days=14)) == [] and copied_files(base) == []


def test_a_file_that_changes_while_it_is_copied_stops_the_snapshot(spark, base, source, monkeypatch):
    store = SnapshotStore(spark, f"{base}/s")
    listed = store._listed(FileTable(source))
    monkeypatch.setattr(store, "_listed", lambda table: {f"other {key}": path for key, path in listed.items()})
    with pytest.raises(RuntimeError, match="changed while"):
        store.take({"t": FileTable(source)}, now=NOW)
    assert store.manifest.entries().count() == 0


def test_scopes_of_threads_are_their_own(spark):
    from concurrent.futures import ThreadPoolExecutor
    from threading import Barrier

    together = Barrier(2, timeout=60)

    def load(rows):
        with staging_scope(spark):
            table = stage(spark.range(rows))
            together.wait()  # both are inside their scopes
            assert table.count() == rows
        together.wait()

    def slow(rows):
        with staging_scope(spark):
            table = stage(spark.range(rows))
            together.wait()
            together.wait()  # the other scope has ended
            return table.count()

    with ThreadPoolExecutor(2) as pool:
        first, second = pool.submit(load, 2), pool.submit(slow, 5)
        assert (first.result(), second.result()) == (None, 5)
