"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections import Counter
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on; a cluster's own values (executors, memory,
# shuffle partitions, checkpoint folder) come from spark-submit.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A skewed fact-to-dimension join is split even if that costs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Streaming state lives on disk, so it may outgrow the executor heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


# Of stored tables; hashes as text take half the room they take with the default.
COMPRESSION = "zstd"


def build_session(app: str = "martloom", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for intermediate tables, under the cluster's shared folder.

    The shared folder is ``spark.checkpoint.dir``.  Only a local session may go
    without one; on a cluster a machine-local folder would not be seen by the
    other executors, so its absence is an error there.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="martloom-")
    location = f"{base.rstrip('/')}/martloom/{name}-{uuid.uuid4().hex}"
    made = _made.get()
    if made is not None:
        made.append(location)
    return location


# Folders of the innermost ``work_folders_removed``.  Jobs in other threads have lists of their own.
_made: ContextVar[list[str] | None] = ContextVar("made", default=None)


@contextmanager
def work_folders_removed(spark: SparkSession) -> Iterator[None]:
    """Remove the folders of ``work_dir`` and ``stored`` made inside, when a job has published its results or failed.

    A thread started inside takes part if it runs in a copy of the context.
    """
    made: list[str] = []
    outer = _made.set(made)
    try:
        yield
    finally:
        _made.reset(outer)
        for location in made:
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(location)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_cleaning: Counter[str] = Counter()
_before: dict[str, str] = {}
_cleaning_lock = threading.Lock()


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the writes and streams begun inside go when each has ended.

    Else they stay until the driver happens to collect its garbage, so a job of many steps holds them all.  A
    write plans its query anew, hence needs no shuffle of an earlier one.
    """
    session = spark._jsparkSession.sessionUUID()
    with _cleaning_lock:
        _cleaning[session] += 1
        if _cleaning[session] == 1:
            _before[session] = spark.conf.get(CLEANUP)
            spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        with _cleaning_lock:
            _cleaning[session] -= 1
            if not _cleaning[session]:
                del _cleaning[session]
                spark.conf.set(CLEANUP, _before.pop(session))


def merging(df: DataFrame) -> DataFrame:
    """``df`` as a side of a join that sorts and merges, never sent whole through the driver.

    Spark judges a stored table by the size of its files.  Ids that repeat or lie close together take many times
    that in memory, so a table under the broadcast threshold can fill the driver.
    """
    return df.hint("merge")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate result to the shared folder once and read it back.

    For a costly frame that several branches of one job use.  It cuts the
    lineage: a lost executor costs no recomputation of what is written.
    """
    location = work_dir(df.sparkSession, name)
    with shuffles_removed(df.sparkSession):
        df.write.parquet(location, compression=COMPRESSION)
    return df.sparkSession.read.schema(df.schema).parquet(location)
