"""Intermediate results that outlive an executor."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"


def staging_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: the one the cluster names in ``spark.checkpoint.dir``.

    In local mode an unset folder becomes a temporary one. On a cluster that would be local to one
    machine, so there it is an error. A configured folder of the local file system is taken as a mount that all
    machines share; whether it is one can't be told from its name.
    """
    configured = spark.conf.get(_SETTING, None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {_SETTING} to a folder that all executors share")
    return tempfile.mkdtemp(prefix="tallyframe-")


def run_together(spark: SparkSession, jobs: Iterable[Callable[[], object]]) -> None:
    """Submit independent jobs at the same time, so the last tasks of one leave no executors idle."""
    jobs = list(jobs)
    with ThreadPoolExecutor(max_workers=max(1, len(jobs))) as pool:
        for done in [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]:
            done.result()


class Stage:
    """Tables written once and read back by several later jobs.

    A written table cuts the lineage and survives lost executors, and unlike a checkpointed RDD its
    readers prune columns and push filters down. As a context manager it deletes its folder at the end, when the
    sinks that read from it have finished.
    """

    def __init__(self, spark: SparkSession, root: str | None = None) -> None:
        self._spark = spark
        self.path = f"{root or staging_root(spark)}/stage-{uuid.uuid4().hex}"

    def __enter__(self) -> Stage:
        return self

    def __exit__(self, *_: object) -> None:
        self.remove()

    def remove(self) -> None:
        """Delete the staged tables."""
        folder = self._spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        system = folder.getFileSystem(self._spark.sparkContext._jsc.hadoopConfiguration())
        system.delete(folder, True)

    def tables(self, frames: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
        """Write each frame, all at the same time, and return them as stored tables."""
        paths = {name: f"{self.path}/{name}" for name in frames}
        run_together(self._spark, [lambda d=df, p=paths[n]: d.write.parquet(p) for n, df in frames.items()])
        return {n: self._spark.read.schema(df.schema).parquet(paths[n]) for n, df in frames.items()}
