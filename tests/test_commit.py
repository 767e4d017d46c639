"""Writes that fail half-way, several writers, and what inserts read."""

import glob
import os
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tallyframe.sources.bronze import qualified
from tallyframe.sources.folders import entries, exists, publish, read_text, write_text
from tallyframe.sources.keyed import (
    BUCKET, clean_snapshots, insert_if_absent, read_keyed, read_snapshot, snapshot_keys, write_snapshot,
)
from tallyframe.sources.sinks import drop_table, write_table
from tests.conftest import plan, rows

AT = datetime(2025, 1, 1, 12)


def failing(spark, schema="s string, n bigint"):
    """Rows of which one fails, after others have been written."""
    good = spark.range(1000).select(F.col("id").cast("string").alias("s"), F.col("id").alias("n"))
    return good.withColumn("n", F.when(F.col("n") == 999, F.raise_error("broken").cast("bigint")).otherwise(F.col("n")))


@pytest.fixture
def table(spark):
    return spark.createDataFrame([("x", 1), ("y", 2)], "s string, n bigint")


def test_a_half_written_snapshot_is_none(spark, tmp_path, table):
    path = str(tmp_path / "snapshots")
    # as left by a writer that died: parts, and no sign that it came to its end
    folder = tmp_path / "snapshots/report_id=R/snapshot=20250101T120000.000000"
    os.makedirs(folder / "_temporary/0")
    (folder / "part-00000.snappy.parquet").write_bytes(b"cut off")
    assert snapshot_keys(spark, path, "R") == []
    assert read_snapshot(spark, path, "R", table.schema).count() == 0
    assert read_snapshot(spark, path, "R", table.schema, AT).count() == 0
    assert write_snapshot(table, path, "R", AT)
    assert rows(read_snapshot(spark, path, "R", table.schema)) == rows(table)
    assert not write_snapshot(table, path, "R", AT)


def test_a_failing_snapshot_leaves_the_others(spark, tmp_path, table):
    path = str(tmp_path / "snapshots")
    assert write_snapshot(table, path, "R", AT)
    with pytest.raises(Exception, match="broken"):
        write_snapshot(failing(spark), path, "R", AT + timedelta(days=1))
    assert rows(read_snapshot(spark, path, "R", table.schema)) == rows(table)
    assert os.listdir(tmp_path / "snapshots/report_id=R") == ["snapshot=20250101T120000.000000"]
    assert write_snapshot(table.limit(1), path, "R", AT + timedelta(days=1))
    assert read_snapshot(spark, path, "R", table.schema).count() == 1


def test_two_writers_of_one_snapshot(spark, tmp_path, table, monkeypatch):
    from tallyframe.sources import keyed

    path, first = str(tmp_path / "snapshots"), []

    def late(spark, pending, target):
        # another writer ends between this one's rows and its commit
        if not first:
            first.append(1)
            assert write_snapshot(table, path, "R", AT)
        return publish(spark, pending, target)

    monkeypatch.setattr(keyed, "publish", late)
    assert not write_snapshot(table.limit(1), path, "R", AT)
    assert rows(read_snapshot(spark, path, "R", table.schema)) == rows(table)
    assert len(os.listdir(tmp_path / "snapshots/report_id=R")) == 1


def test_leftovers_are_cleaned_when_old(spark, tmp_path, table):
    path = str(tmp_path / "snapshots")
    write_snapshot(table, path, "R", AT)
    for name in ("_pending-1", "_pending-2", "snapshot=20240101T000000.000000"):
        os.makedirs(tmp_path / "snapshots/report_id=R" / name)
    os.utime(tmp_path / "snapshots/report_id=R/_pending-1", (1, 1))
    os.utime(tmp_path / "snapshots/report_id=R/snapshot=20240101T000000.000000", (1, 1))
    assert clean_snapshots(spark, path, "R") == ["_pending-1", "snapshot=20240101T000000.000000"]
    assert clean_snapshots(spark, path, "R") == [] and len(snapshot_keys(spark, path, "R")) == 1
    assert clean_snapshots(spark, path, "none") == []


def test_names_are_given_once(spark, tmp_path):
    a, b, target = (str(tmp_path / n) for n in ("a", "b", "deep/er/target"))
    os.makedirs(a), os.makedirs(b)
    assert publish(spark, a, target) and not publish(spark, b, target)
    assert exists(spark, b) and not exists(spark, a)
    assert [e.name for e in entries(spark, str(tmp_path / "deep"))] == ["er"] and list(entries(spark, a)) == []
    file = str(tmp_path / "note.json")
    assert read_text(spark, file) is None
    for text in ("one", "zwei ä", ""):
        write_text(spark, file, text)
        assert read_text(spark, file) == text


# --- tables -------------------------------------------------------------------


@pytest.fixture(scope="module")
def schema(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS swapped")
    return "swapped"


def location(spark, name):
    return next(r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect() if r.col_name == "Location")


def test_a_failing_write_leaves_the_old_table(spark, schema, table):
    name = qualified("gold", schema)
    write_table(table, "gold", schema)
    for turn in range(3):
        with pytest.raises(Exception, match="broken"):
            write_table(failing(spark), "gold", schema)
        assert rows(spark.table(name)) == rows(table)
        reader = spark.table(name)
        write_table(table.limit(1), "gold", schema)
        assert rows(reader) == rows(table)  # who has begun reads what there was
        spark.catalog.refreshTable(name)
        assert spark.table(name).count() == 1
        write_table(table, "gold", schema)
        assert rows(spark.table(name)) == rows(table)
    at = location(spark, name).removeprefix("file:")
    assert len(os.listdir(os.path.dirname(at))) == 2  # this version and the one before
    drop_table(spark, "gold", schema)
    assert not spark.catalog.tableExists(name) and not os.path.exists(os.path.dirname(at))
    write_table(table, "gold", schema)
    assert rows(spark.table(name)) == rows(table)


def test_the_table_is_there_while_it_is_replaced(spark, schema, table):
    name = qualified("seen", schema)
    write_table(table, "seen", schema)
    warehouse = location(spark, name).removeprefix("file:")
    # the rows of the new table are those of the old one: it is read while it is replaced
    write_table(spark.table(name).withColumn("n", F.col("n") + 1), "seen", schema)
    assert rows(spark.table(name)) == [("x", 2), ("y", 3)]
    write_table(spark.table(name).withColumn("n", F.col("n") + 1), "seen", schema)
    assert rows(spark.table(name)) == [("x", 3), ("y", 4)] and not os.path.exists(warehouse)


def test_other_columns_exchange_the_tables(spark, schema, table):
    name = qualified("wider", schema)
    write_table(table, "wider", schema)
    with pytest.raises(Exception, match="broken"):
        write_table(failing(spark).withColumn("more", F.lit(1)), "wider", schema)
    assert rows(spark.table(name)) == rows(table)
    write_table(table.withColumn("more", F.lit(1)), "wider", schema)
    assert spark.table(name).columns == ["s", "n", "more"]
    table.write.partitionBy("n").saveAsTable(qualified("parted", schema))
    write_table(table, "parted", schema)
    assert rows(spark.table(qualified("parted", schema))) == rows(table)
    left = [t.name for t in spark.catalog.listTables(schema) if t.name.startswith("wider") and t.name.endswith("_old")]
    assert left == []


# --- insert-if-absent ---------------------------------------------------------


def test_keyed_table_holds_the_same_rows(spark, tmp_path):
    plain, keyed = str(tmp_path / "plain"), str(tmp_path / "keyed")
    rounds = [
        [("a", 1, "x"), ("a", 1, "w"), (None, 2, "n"), ("b", None, "m"), (None, None, "o")],
        [("a", 1, "z"), ("a", 2, "y"), (None, 2, "q"), ("b", None, "a"), ("zz", 9, "r")],
        [],
        [("a", 1, "z"), (None, None, "p"), ("c", 5, None)],
    ]
    for given in rounds:
        new = spark.createDataFrame(given, "k string, i int, v string")
        for path, buckets in ((plain, None), (keyed, 8)):
            for _ in range(2):
                insert_if_absent(spark, path, new, ["k", "i"], buckets=buckets)
    schema = spark.createDataFrame([], "k string, i int, v string").schema
    got = read_keyed(spark, keyed, schema)
    assert got.columns == ["k", "i", "v"] and rows(got) == rows(read_keyed(spark, plain, schema)) and got.count() == 7
    insert_if_absent(spark, keyed, spark.createDataFrame([("c", 6, "t")], schema), ["k", "i"])
    assert read_keyed(spark, keyed, schema).count() == 8
    for wrong in ({"keys": ["k"]}, {"keys": ["k", "i"], "buckets": 4}):
        with pytest.raises(ValueError, match="laid out"):
            insert_if_absent(spark, keyed, spark.createDataFrame([], schema), **wrong)
    with pytest.raises(ValueError, match="not laid out"):
        insert_if_absent(spark, plain, spark.createDataFrame([], schema), ["k", "i"], buckets=8)


def test_an_insert_reads_only_what_its_keys_can_be_in(spark, tmp_path, monkeypatch):
    from tallyframe.sources import keyed

    path = str(tmp_path / "t")
    stored = spark.range(0, 2000).select("id", F.lit("old").alias("v"))
    insert_if_absent(spark, path, stored, ["id"], buckets=16)
    assert len(glob.glob(f"{path}/{BUCKET}=*")) == 16
    new = spark.createDataFrame([(5,), (3000,)], "id bigint").withColumn("v", F.lit("new"))
    hit = {r[0] for r in new.select(keyed._bucket(["id"], 16)).collect()}
    seen, read = [], keyed.keys_held

    def held(*args):
        seen.append(read(*args))
        return seen[-1]

    monkeypatch.setattr(keyed, "keys_held", held)
    # buckets that no new key falls in can not even be read
    for folder in glob.glob(f"{path}/{BUCKET}=*"):
        if int(folder.rpartition("=")[2]) not in hit:
            for file in glob.glob(f"{folder}/*.parquet"):
                with open(file, "r+b") as f:
                    f.write(b"gone")
                    f.truncate(20)
    insert_if_absent(spark, path, new, ["id"])
    text = plan(seen[0])
    filters = next(line for line in text.splitlines() if "PartitionFilters" in line)
    assert f"{BUCKET}" in filters.split("PartitionFilters:")[1].split("PushedFilters")[0]
    assert "GreaterThanOrEqual(id,5)" in text and "LessThanOrEqual(id,3000)" in text
    kept = spark.read.parquet(*[f"{path}/{BUCKET}={b}" for b in hit])
    assert {r.id for r in kept.filter("v = 'new'").collect()} == {3000} and kept.filter("id = 5").count() == 1


def test_a_failing_insert_leaves_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    new = failing(spark).withColumnRenamed("n", "v")
    insert_if_absent(spark, path, new.limit(10), ["s"], buckets=4)
    before = rows(read_keyed(spark, path, new.schema))
    with pytest.raises(Exception, match="broken"):
        insert_if_absent(spark, path, new, ["s"], buckets=4)
    assert rows(read_keyed(spark, path, new.schema)) == before and time.time() > 0
