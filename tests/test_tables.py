import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from millrace.catalogue.tables import daily_clock
from millrace.tables import TableStore, maintenance


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def batch(spark, data, schema="k long, v int, x string"):
    return spark.createDataFrame(data, schema)


def test_first_write_creates_later_ones_replace(spark, store):
    table = store.table("t")
    assert not table.exists() and store.names() == []
    table.upsert(batch(spark, [(1, 1, "a"), (2, 1, "b")]), ["k"])
    table.upsert(batch(spark, [(2, 2, "B"), (3, 2, "c"), (3, 2, "c2"), (None, 2, "n")]), ["k"])
    table.upsert(batch(spark, [(None, 3, "m")]), ["k"])
    assert rows(table.read()) == sorted(
        [(1, 1, "a"), (2, 2, "B"), (3, 2, "c"), (3, 2, "c2"), (None, 2, "n"), (None, 3, "m")], key=repr
    )
    assert rows(table.read(1)) == [(1, 1, "a"), (2, 1, "b")]
    assert store.names() == ["t"]


def test_upsert_rewrites_only_files_with_touched_keys(spark, store):
    table = store.table("t")
    for low in (0, 1000, 2000):
        table.append(spark.range(low, low + 1000).select(F.col("id").alias("k"), F.lit(1).alias("v")).coalesce(1))
    before = {r["path"] for r in table.files_at().collect()}
    table.upsert(batch(spark, [(1500, 2), (5000, 2)], "k long, v int"), ["k"])
    after = {r["path"] for r in table.files_at().collect()}
    assert len(before - after) == 1 and len(before & after) == 2
    assert table.read().count() == 3001
    assert table.read().filter("v = 2").count() == 2


def test_same_batch_twice_changes_nothing(spark, store):
    table = store.table("t")
    first = batch(spark, [(1, 1, "a"), (2, 1, "b")])
    table.upsert(first, ["k"])
    table.upsert(first, ["k"])
    assert rows(table.read()) == rows(first)
    version = table.upsert(batch(spark, [(1, 2, "c")]), ["k"], batch_id="q#7")
    assert table.upsert(batch(spark, [(1, 3, "d")]), ["k"], batch_id="q#7") == version
    assert rows(table.read()) == [(1, 2, "c"), (2, 1, "b")]


def test_last_batch_wins_unless_guarded(spark, store):
    newer, older = batch(spark, [(1, 2, "new")]), batch(spark, [(1, 1, "old")])
    for name, guard, expected in (("plain", None, "old"), ("guarded", "v", "new")):
        store.table(name).upsert(newer, ["k"], guard_version=guard)
        store.table(name).upsert(older, ["k"], guard_version=guard)
        assert store.read(name).first()["x"] == expected


def test_a_guarded_upsert_touches_only_its_keys(spark, store):
    table = store.table("t")
    table.append(batch(spark, [(1, 5, "a"), (2, 1, "b"), (5, 1, "x"), (5, 2, "y"), (None, 1, "n"), (None, 2, "m")]).coalesce(1))
    table.upsert(batch(spark, [(1, 4, "late"), (2, 3, "c"), (2, 3, "twin"), (None, 1, "o"), (9, 1, "new")]), ["k"], guard_version="v")
    expected = [(1, 5, "a"), (2, 3, "c"), (2, 3, "twin"), (5, 1, "x"), (5, 2, "y"), (9, 1, "new"), (None, 1, "n"), (None, 1, "o"), (None, 2, "m")]
    assert rows(table.read()) == sorted(expected, key=repr)
    table.upsert(batch(spark, [(1, 5, "tie"), (2, None, "no version"), (5, 2, "z")]), ["k"], guard_version="v")
    assert rows(table.read().filter("k < 9")) == [(1, 5, "tie"), (2, 3, "c"), (2, 3, "twin"), (5, 2, "z")]


@pytest.mark.parametrize("files", [1, 4])
def test_append_dedup_does_not_depend_on_files(spark, store, files):
    table = store.table("t")
    old = [(1, 5, "a"), (2, 1, "b"), (5, 1, "x"), (5, 2, "y"), (None, 1, "n"), (None, 2, "m")]
    table.append(batch(spark, old).repartition(files, "x"))
    table.append_dedup(batch(spark, [(1, 4, "late"), (2, 3, "c"), (2, 2, "d"), (None, 1, "o")]), ["k"], "v")
    expected = [(1, 5, "a"), (2, 3, "c"), (5, 1, "x"), (5, 2, "y"), (None, 1, "n"), (None, 1, "o"), (None, 2, "m")]
    assert rows(table.read()) == sorted(expected, key=repr)


def test_types_do_not_change(spark, store):
    table = store.table("t")
    table.append(batch(spark, [(1, "a")], "k long, x string"))
    for write in (table.append, lambda df: table.upsert(df, ["k"])):
        with pytest.raises(TypeError, match="column x of t is string, the batch has double"):
            write(batch(spark, [(2, 1.5)], "k long, x double"))
    assert rows(table.read()) == [(1, "a")] and table.current_version() == 1


def test_hot_key_in_the_table(spark, store):
    table = store.table("t")
    hot = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.lit(1).alias("v"))
    table.append(hot.repartition(6))
    table.upsert(batch(spark, [(0, 2), (1, 2)], "k long, v int"), ["k"])
    assert table.read().count() == 30_000 - 10_000 - 1 + 2


def test_new_columns_are_added(spark, store):
    table = store.table("t")
    table.upsert(batch(spark, [(1, 1, "a"), (2, 1, "b")]), ["k"])
    table.upsert(batch(spark, [(2, 5.5)], "k long, y double"), ["k"])
    assert rows(table.read().select("k", "v", "x", "y")) == [(1, 1, "a", None), (2, None, None, 5.5)]
    assert table.read(1).columns == ["k", "v", "x"]


def test_a_key_column_may_be_called_path(spark, store):
    for n in (1, 2):
        store.table("t").upsert(batch(spark, [("p", n)], "path string, n int"), ["path"])
    assert rows(store.read("t")) == [("p", 2)]


def test_sync_modes(spark, store):
    for mode, expected in (
        ("append", [(1, 1, "b"), (1, 2, "a")]),
        ("overwrite", [(1, 1, "b")]),
        ("append_dedup", [(1, 2, "a")]),
        ("merge", [(1, 1, "b")]),
    ):
        for row in ((1, 2, "a"), (1, 1, "b")):
            store.table(mode).write(batch(spark, [row]), mode, ["k"], "v")
        assert rows(store.read(mode)) == expected, mode
    with pytest.raises(ValueError):
        store.table("append").write(batch(spark, []), "replace")


def test_a_second_writer_fails(spark, store):
    table = store.table("t")
    table.append(batch(spark, [(1, 1, "a")]))
    expected = table.current_version()
    folder = table._stage(batch(spark, [(2, 1, "b")]), "append")
    table.append(batch(spark, [(3, 1, "c")]))  # somebody else commits first
    with pytest.raises(Exception, match="already exists"):
        table._commit("append", table.schema(), [folder], expected=expected)
    assert rows(table.read().select("k")) == [(1,), (3,)]


def test_create_and_drop(spark, store):
    store.create("t", "k long, v int")
    store.create("t", "k long, v int")
    assert store.table("t").current_version() == 1 and store.read("t").count() == 0
    store.table("t").upsert(batch(spark, [(1, 1)], "k long, v int"), ["k"])
    assert store.read("t").count() == 1
    store.drop("t")
    store.drop("t")
    assert not store.exists("t")


def three_versions(spark, tmp_path):
    table = TableStore(spark, f"{tmp_path}/s", clock=daily_clock()).table("t")
    for n in (1, 2, 3):
        table.upsert(batch(spark, [(1, n, "a"), (n, n, "b")]), ["k"])
    return table


def test_expire_and_clean_up(spark, tmp_path):
    table = three_versions(spark, tmp_path)
    current = rows(table.read())
    assert maintenance.expire_snapshots(table, dt.datetime(2023, 1, 1, tzinfo=dt.timezone.utc)) == 3
    assert maintenance.expire_snapshots(table, dt.datetime(2024, 1, 2, tzinfo=dt.timezone.utc)) == 4
    assert rows(table.snapshots().select("version", "expired")) == [(1, True), (2, False), (3, False), (4, False)]
    with pytest.raises(ValueError, match="expired"):
        table.read(1)
    listed = maintenance.cleanup_old_files(table)
    assert listed and all(os.path.exists(f"{table.data_path}/{p}") for p in listed)
    assert maintenance.cleanup_old_files(table, dry_run=False) == listed
    assert maintenance.cleanup_old_files(table, dry_run=False) == []
    assert not any(os.path.exists(f"{table.data_path}/{p}") for p in listed)
    assert rows(table.read()) == current and table.read(2).count() > 0


def test_the_current_snapshot_never_expires(spark, tmp_path):
    table = three_versions(spark, tmp_path)
    current = rows(table.read())
    maintenance.expire_snapshots(table, dt.datetime(2099, 1, 1, tzinfo=dt.timezone.utc))
    maintenance.cleanup_old_files(table, dry_run=False)
    assert rows(table.read()) == current


def test_orphans(spark, tmp_path):
    table = three_versions(spark, tmp_path)
    assert maintenance.delete_orphans(table) == []
    table._stage(batch(spark, [(9, 9, "lost")]).coalesce(1), "failed")
    assert maintenance.delete_orphans(table, dry_run=True) == []  # may still be written to
    found = maintenance.delete_orphans(table, dry_run=True, min_age=dt.timedelta(0))
    assert found and all(p.startswith("failed-") for p in found)
    maintenance.delete_orphans(table, dry_run=False, min_age=dt.timedelta(0))
    assert maintenance.delete_orphans(table, min_age=dt.timedelta(0)) == []
    assert table.read(3).count() == 3


def test_compaction(spark, store):
    table = store.table("t")
    for n in range(4):
        table.append(spark.range(n * 10, n * 10 + 10).repartition(3))
    before = table.files_at().count()
    version = maintenance.compact(table)
    assert table.files_at().count() < before
    assert table.read().count() == 40 and table.read(version - 1).count() == 40
    assert maintenance.compact(table) in (version, version + 1)
    maintenance.maintain(table, dt.datetime(2099, 1, 1, tzinfo=dt.timezone.utc))
    assert table.read().count() == 40


def test_compaction_by_key_separates_key_ranges(spark, store):
    table = store.table("t")
    hot = F.when(F.col("id") % 3 == 0, 500).otherwise(F.col("id"))
    table.upsert(spark.range(3000).select(hot.alias("k"), "id").repartition(5), ["k"])
    table.upsert(spark.range(10).select(F.col("id").alias("k"), F.lit(-1).cast("long").alias("id")), ["k"])
    expected = rows(table.read())
    size = table.files_at().agg(F.sum("file_size")).first()[0]
    maintenance.compact(table, ["k"], target_bytes=size // 6, everything=True)
    found = table.files_at().select(F.col("low")["k"].cast("long"), F.col("high")["k"].cast("long"), "record_count")
    ranges = sorted((r[0], r[1]) for r in found.collect())
    assert len(ranges) >= 6 and all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:]))
    assert max(r[2] for r in found.collect()) < 1000  # the hot key alone has 1000 rows
    assert rows(table.read()) == expected
    # an upsert of one key meets only the files around it
    before = {r["path"] for r in table.files_at().collect()}
    table.upsert(batch(spark, [(2999, 0)], "k long, id long"), ["k"])
    assert len(before - {r["path"] for r in table.files_at().collect()}) == 1


def test_high_water_mark_comes_from_the_log(spark, store):
    table = store.table("t")
    data = [(1, dt.datetime(2024, 1, 5, 1, 2, 3, 456789)), (2, dt.datetime(2024, 1, 4))]
    table.upsert(spark.createDataFrame(data, "k long, at timestamp_ntz"), ["k"], ranges=["at"])
    assert table.high_water_mark("at") == "2024-01-05 01:02:03.456789"
    assert table.high_water_mark("k") == "2"
    table.upsert(spark.createDataFrame([(1, dt.datetime(2024, 1, 3))], "k long, at timestamp_ntz"), ["k"])
    assert table.high_water_mark("at") == "2024-01-04 00:00:00"
    table.upsert(spark.createDataFrame([(3, None)], "k long, at timestamp_ntz"), ["k"])
    assert table.high_water_mark("at") == "2024-01-04 00:00:00"
    store.create("empty", "k long, at timestamp_ntz")
    assert store.table("empty").high_water_mark("at") is None


def test_ranges_of_zoned_timestamps(spark, store):
    table = store.table("t")
    first = spark.range(1).select(F.col("id").alias("k"), F.timestamp_seconds(F.lit(1_700_000_000)).alias("at"))
    table.upsert(first, ["at"])
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        table.upsert(first.withColumn("k", F.lit(7).cast("long")), ["at"])
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert rows(table.read().select("k")) == [(7,)]


def test_nothing_is_left_behind_by_a_write(spark, store):
    table = store.table("t")
    for n in (1, 2, 3):
        table.upsert(batch(spark, [(1, n, "a"), (n, n, "b")]), ["k"], guard_version="v")
    assert maintenance.delete_orphans(table, min_age=dt.timedelta(0)) == []
    assert not os.path.exists(table.scratch)


def test_current_tables(spark, store):
    assert maintenance.current_tables(store).count() == 0
    store.table("a").append(spark.range(5))
    store.table("b").append(spark.range(7))
    assert rows(maintenance.current_tables(store).select("table_name", "version", "record_count")) == [("a", 1, 5), ("b", 1, 7)]


def test_file_statistics(spark, tmp_path):
    spark.range(10).withColumn("t", F.when(F.col("id") > 3, "x")).coalesce(1).write.parquet(f"{tmp_path}/p")
    stats = maintenance.file_column_stats(spark.read.parquet(f"{tmp_path}/p")).drop("file_path")
    assert rows(stats) == [(10, "id", 0, "0", "9"), (10, "t", 4, "x", "x")]


