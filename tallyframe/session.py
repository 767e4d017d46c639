"""Session settings the reports are designed for."""

from __future__ import annotations

import warnings

from pyspark.sql import SparkSession

#: AQE sizes shuffle partitions from the data and splits skewed join partitions. The initial partition
#: number is an upper bound that AQE coalesces from, so it suits small and large inputs.
_SETS_HASHED = "spark.sql.objectHashAggregate.sortBased.fallbackThreshold"
_SCANNED = "spark.sql.files.maxPartitionBytes"
_MERGED = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot key also where that costs one more shuffle (chained fact joins share a partitioning)
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # join by hash instead of sorting where every partition turns out small enough at run time
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    # lets tables bucketed by pupil join on (pupil, year) without a shuffle
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # sets of establishments are hashed for so many groups of a task before they are sorted (128 by default): some 30 MB
    _SETS_HASHED: "20000",
    # rows of codes take some 10 bytes each in files and in the shuffle, and some 100 in the memory of the task that sorts or
    # buffers them: parts of 16 MB are over a million rows
    _SCANNED: "16m",
    _MERGED: "16m",
    # a report is several hundred column calls; recording the call site of each doubles the planning time
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def fill_settings(spark: SparkSession) -> None:
    """Give a session that was made elsewhere the settings that bound a task's memory, where it has Spark's defaults.

    With 128 groups a task soon sorts all of its rows instead of hashing the sets, which takes their size in memory and most
    of the time. Of files a task reads up to 128 MB, of shuffled rows 64 MB, and holds many times that.
    """
    for key, default in ((_SETS_HASHED, "128"), (_SCANNED, "134217728b"), (_MERGED, "67108864b")):
        if spark.conf.get(key) == default:
            spark.conf.set(key, SETTINGS[key])


PARTITION_BYTES = 128 << 20
#: so many tasks read the facts at most, until these reach as many times 128 MB
SCAN_TASKS = 50_000


def initial_partitions(shuffle_bytes: int) -> int:
    """Shuffle partitions of about 128 MB each. AQE merges small ones but never makes more than these."""
    return max(200, -(-shuffle_bytes // PARTITION_BYTES))


def scan_bytes(fact_bytes: int) -> int:
    """Part of a file that a task reads: 16 MB, more where a scan would have too many tasks, 128 MB at most."""
    return min(128 << 20, max(16 << 20, -(-fact_bytes // SCAN_TASKS)))


def builder(app: str = "tallyframe", master: str | None = None, shuffle_bytes: int | None = None) -> SparkSession.Builder:
    """Session builder for local runs (``master="local[8]"``) or a cluster.

    ``shuffle_bytes`` is the size of the largest shuffle to expect: for the reports, the columns they use of
    the three fact tables. Without it a cluster gets partitions for 1 TB, with a warning.
    """
    b = SparkSession.builder.appName(app)
    for key, value in SETTINGS.items():
        b = b.config(key, value)
    if master:
        b = b.master(master)
    if master and master.startswith("local"):
        return b.config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
    if shuffle_bytes is None:
        warnings.warn("shuffle_bytes is not given: shuffle partitions are sized for 1 TB", stacklevel=2)
        shuffle_bytes = 1 << 40
    b = b.config(_SCANNED, str(scan_bytes(shuffle_bytes)))
    return b.config("spark.sql.shuffle.partitions", str(initial_partitions(shuffle_bytes)))
