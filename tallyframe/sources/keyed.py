"""Insert-if-absent tables and report snapshots."""

from __future__ import annotations

import json
from collections.abc import Sequence
from datetime import datetime, timedelta, timezone
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from tallyframe.operators.shape import all_of
from tallyframe.sources.folders import (
    delete, entries, exists, is_complete, pending_name, publish, read_text, write_text,
)

#: the defaults would cut timestamps to milliseconds
_JSON = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def absent_rows(existing: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``new`` whose key is not in ``existing``, one per key.

    Of several new rows with one key the least payload wins, so the choice does not depend on row order.
    That is a mergeable aggregate: repeats of a hot key shrink to one row per task before the shuffle.
    NULL is a key value like any other: it matches an existing NULL, so inserting the same rows twice adds
    nothing, and of new rows with one key, NULLs included, one stays.
    """
    payload = [c for c in new.columns if c not in keys]
    if payload:
        one = new.groupBy(*keys).agg(F.min(F.struct(*payload)).alias("__row"))
        one = one.select(*keys, *[F.col("__row")[c].alias(c) for c in payload]).select(*new.columns)
    else:
        one = new.select(*keys).distinct()
    held = existing.select(*[F.col(k).alias(f"__held_{k}") for k in keys]).distinct()
    same = all_of(F.col(k).eqNullSafe(F.col(f"__held_{k}")) for k in keys)
    return one.join(held, same, "left_anti").select(*new.columns)


#: file of a bucketed table that tells its keys and number of buckets, and its column of bucket numbers
_LAYOUT, BUCKET = "_key_layout.json", "key_bucket"


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def insert_if_absent(
    spark: SparkSession,
    path: str,
    new: DataFrame,
    keys: Sequence[str],
    partition_by: Sequence[str] = (),
    buckets: int | None = None,
) -> None:
    """Append to the Parquet table at ``path`` the rows whose key it does not hold yet.

    With ``buckets`` a new table is laid out by key: a folder per hash of the key modulo ``buckets``. An insert into
    such a table looks for the new keys only in the folders that they fall in, and there only in the parts of files
    whose least and greatest keys admit them; how much it reads depends on the new rows, not on all that was ever
    stored. The new rows are read twice for that: for their buckets and bounds, one row on the driver,
    and for themselves. A table keeps its keys and buckets; asking for others is an error. ``read_keyed`` reads it back.

    One writer at a time: an insert sees what was there when it began, so that two at once with one new key would both
    append it. Inserts of keys in different buckets don't meet and may run together. An insert that fails leaves the
    table as it was; repeating one that succeeded adds nothing.
    """
    layout = _layout(spark, path)
    if layout is None and (buckets is None or exists(spark, path)):
        if buckets is not None:
            raise ValueError(f"{path} is not laid out by key: insert into it without buckets")
        rows = absent_rows(_read(spark, path, new.schema), new, keys)
        rows.write.mode("append").partitionBy(*partition_by).parquet(path)
        return
    if layout is None:
        layout = {"keys": list(keys), "buckets": buckets}
        write_text(spark, f"{path}/{_LAYOUT}", json.dumps(layout))
    if layout["keys"] != list(keys) or buckets not in (None, layout["buckets"]):
        raise ValueError(f"{path} is laid out as {layout}")
    if BUCKET in new.columns:
        raise ValueError(f"{BUCKET} is the name of the table's own column")
    numbered = new.withColumn(BUCKET, _bucket(keys, layout["buckets"]))
    held = keys_held(spark, path, numbered, keys)
    rows = absent_rows(held, numbered, [BUCKET, *keys])
    # a task has whole buckets, sorted by key: few files, and bounds that tell something
    rows = rows.repartition(BUCKET).sortWithinPartitions(BUCKET, *keys)
    rows.write.mode("append").partitionBy(BUCKET, *partition_by).parquet(path)


def keys_held(spark: SparkSession, path: str, numbered: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The stored keys of a bucketed table that rows of ``numbered`` (with their buckets) could have.

    Folders of other buckets are left out by name, and of the others what lies outside the bounds of the new keys by
    the statistics of the files. Where a new key is NULL, stored NULLs are looked at too.
    """
    bounds = []
    for k in keys:
        bounds += [F.min(k), F.max(k), F.count_if(F.col(k).isNull())]
    hit, *found = numbered.agg(F.collect_set(BUCKET), *bounds).first()
    within = F.col(BUCKET).isin(sorted(hit)) if hit else F.lit(False)
    for k, (least, most, nulls) in zip(keys, zip(*[iter(found)] * 3), strict=True):
        if isinstance(numbered.schema[k].dataType, _BOUNDED) and not _is_nan(most):
            inside = F.col(k).between(F.lit(least), F.lit(most)) if least is not None else F.lit(False)
            within = within & (inside | F.col(k).isNull() if nulls else inside)
    held = _read(spark, path, numbered.select(*keys, BUCKET).schema)
    return held.filter(within)


#: types whose bounds files have; others are told by their bucket alone
_BOUNDED = (T.NumericType, T.StringType, T.DateType, T.TimestampType, T.BooleanType)


def _is_nan(value: object) -> bool:
    return isinstance(value, float) and value != value


def _layout(spark: SparkSession, path: str) -> dict | None:
    text = read_text(spark, f"{path}/{_LAYOUT}")
    return None if text is None else json.loads(text)


def read_keyed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows of a table that ``insert_if_absent`` writes, laid out by key or not."""
    return _read(spark, path, schema).select(*[F.col(f"`{name}`") for name in schema.fieldNames()])


def _read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


def pack_snapshot(df: DataFrame, report_id: str, taken_at: datetime | None = None) -> DataFrame:
    """Report rows as JSON text beside the report id and the time of the snapshot."""
    stamp = F.current_timestamp() if taken_at is None else F.lit(taken_at)
    return df.select(
        F.lit(report_id).alias("report_id"),
        stamp.alias("snapshot_timestamp"),
        F.to_json(F.struct(*[F.col(c) for c in df.columns]), _JSON).alias("data"),
    )


def unpack_snapshot(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The report rows of a packed snapshot."""
    return df.select(F.from_json("data", schema, _JSON).alias("__row")).select("__row.*")


def _snapshot_key(taken_at: datetime) -> str:
    """Name of a snapshot's partition: its time in UTC, ordered as text."""
    return taken_at.astimezone(timezone.utc).strftime("%Y%m%dT%H%M%S.%f")


def _report_folder(path: str, report_id: str) -> str:
    return f"{path}/report_id={quote(report_id)}"


def snapshot_keys(spark: SparkSession, path: str, report_id: str) -> list[str]:
    """Times of the stored snapshots of a report, in order, from the folder names alone.

    Only whole ones count: a folder that a writer left before its end is no snapshot.
    """
    found = [e for e in entries(spark, _report_folder(path, report_id)) if e.is_folder and e.name.startswith("snapshot=")]
    return sorted(e.name.partition("=")[2] for e in found if is_complete(spark, e.path))


def write_snapshot(df: DataFrame, path: str, report_id: str, taken_at: datetime) -> bool:
    """Store a snapshot of a report; does nothing and returns False if that (report, time) is there.

    A snapshot is a folder of its own. It is written under a hidden name and renamed when it is whole, so readers see all
    of it or nothing, a writer that dies leaves nothing that counts, and the same snapshot can be written again.
    Of two writers of one snapshot the first to end has it; the other's rows are removed, and it returns False.
    """
    spark, key = df.sparkSession, _snapshot_key(taken_at)
    folder = _report_folder(path, report_id)
    target = f"{folder}/snapshot={key}"
    if is_complete(spark, target):
        return False
    pending = f"{folder}/{pending_name()}"
    try:
        pack_snapshot(df, report_id, taken_at).drop("report_id").write.parquet(pending)
        if publish(spark, pending, target):
            return True
        if is_complete(spark, target):
            return False
        # what stands there was never finished: only whole folders get such a name from here
        delete(spark, target)
        return publish(spark, pending, target)
    finally:
        delete(spark, pending)


def clean_snapshots(spark: SparkSession, path: str, report_id: str, older_than: timedelta = timedelta(days=1)) -> list[str]:
    """Remove what writers of a report's snapshots left unfinished and have not touched for so long; returns the names."""
    before = (datetime.now(timezone.utc) - older_than).timestamp() * 1000
    left = [
        e for e in entries(spark, _report_folder(path, report_id))
        if e.is_folder and e.changed_ms < before
        and (e.name.startswith("_pending-") or e.name.startswith("snapshot=") and not is_complete(spark, e.path))
    ]
    for e in left:
        delete(spark, e.path)
    return sorted(e.name for e in left)


def read_snapshot(
    spark: SparkSession, path: str, report_id: str, schema: T.StructType, taken_at: datetime | None = None
) -> DataFrame:
    """Rows of one snapshot of a report, by default of its latest one; no other snapshot is read."""
    keys = snapshot_keys(spark, path, report_id)
    wanted = keys[-1:] if taken_at is None else [k for k in keys if k == _snapshot_key(taken_at)]
    if not wanted:
        return spark.createDataFrame([], schema)
    stored = spark.read.schema("snapshot_timestamp timestamp, data string")
    return unpack_snapshot(stored.parquet(f"{_report_folder(path, report_id)}/snapshot={wanted[0]}"), schema)
