"""Folders of a shared file system: listing, and the atomic step with which finished work is made visible.

Everything goes through Hadoop's file systems, so it works wherever Spark reads and writes. ``publish`` renames, which
is one atomic step on HDFS and on local disks; an object store that copies instead of renaming needs one of the committers made
for it.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

#: names that start so are no data to Spark's readers
HIDDEN = ("_", ".")
#: what a finished write leaves in its folder
SUCCESS = "_SUCCESS"


@dataclass(frozen=True)
class Entry:
    """A file or folder directly below another."""

    name: str
    path: str
    is_folder: bool
    size: int
    changed_ms: int


def _hadoop(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    at, system = _hadoop(spark, path)
    return bool(system.exists(at))


def delete(spark: SparkSession, path: str) -> bool:
    """Delete a file or a whole folder; False if there was none."""
    at, system = _hadoop(spark, path)
    return bool(system.delete(at, True))


def entries(spark: SparkSession, path: str) -> Iterator[Entry]:
    """What is directly below ``path``, as the file system pages through it; nothing if there is no such folder."""
    at, system = _hadoop(spark, path)
    if not system.exists(at):
        return
    found = system.listStatusIterator(at)
    while found.hasNext():
        status = found.next()
        yield Entry(
            status.getPath().getName(), status.getPath().toString(), bool(status.isDirectory()),
            int(status.getLen()), int(status.getModificationTime()),
        )


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a write into the folder has come to its end."""
    return exists(spark, f"{path}/{SUCCESS}")


def pending_name() -> str:
    """A new name that readers pass over."""
    return f"_pending-{uuid.uuid4().hex}"


def publish(spark: SparkSession, pending: str, path: str) -> bool:
    """Give a finished folder or file its name. False, and nothing is changed, if that name is taken.

    Of several writers of one name exactly one gets it.
    """
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    source, target = jvm.org.apache.hadoop.fs.Path(pending), jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(target.getParent())
    source = source.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(source)
    target = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(target)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(source.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    # without the option to overwrite, an existing target is an error
    no_options = gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(source, target, no_options)
    except Py4JJavaError as e:
        if "FileAlreadyExistsException" in e.java_exception.getClass().getName():
            return False
        raise
    return True


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file whole: it appears with its content, in place of the one before."""
    at, system = _hadoop(spark, path)
    pending = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(at.getParent(), pending_name())
    out = system.create(pending, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    source, target = system.makeQualified(pending), system.makeQualified(at)
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        source.toUri(), spark.sparkContext._jsc.hadoopConfiguration()
    ).rename(source, target, options)


def read_text(spark: SparkSession, path: str) -> str | None:
    """The content of a small file; None if there is none."""
    at, system = _hadoop(spark, path)
    if not system.exists(at):
        return None
    stream = system.open(at)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def partition_values(spark: SparkSession, path: str, column: str) -> list[str]:
    """The values of ``column`` that a partitioned table's folders name, sorted; no file is opened.

    A folder without data files, as an overwritten partition leaves it, has no rows and doesn't count. NULL is no value.
    """
    unescape = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    found = []
    for entry in entries(spark, path):
        name, _, value = entry.name.partition("=")
        if entry.is_folder and name == column and value != "__HIVE_DEFAULT_PARTITION__":
            if any(not e.name.startswith(HIDDEN) for e in entries(spark, entry.path)):
                found.append(unescape(value))
    return sorted(found)


def state(spark: SparkSession, path: str) -> str:
    """A short text that changes when any data file below ``path`` is added, removed or written again.

    Files are listed, not opened: their number, bytes, and a sum over hashes of name, size and time, which needs no order
    and keeps no list.
    """
    at, system = _hadoop(spark, path)
    files = size = mark = 0
    if system.exists(at):
        found = system.listFiles(at, True)
        while found.hasNext():
            status = found.next()
            name = status.getPath().toString()
            if name.rpartition("/")[2].startswith(HIDDEN):
                continue
            told = f"{name}|{status.getLen()}|{status.getModificationTime()}"
            files, size = files + 1, size + int(status.getLen())
            mark = (mark + int.from_bytes(hashlib.blake2b(told.encode(), digest_size=8).digest())) % (1 << 64)
    return f"{files}:{size}:{mark:016x}"
