"""Session settings and lineage cuts."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from functools import partial
from multiprocessing.pool import ThreadPool
from threading import Condition

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"
_CUTS: list[str] = []


def build_session(app: str = "quillstat", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution and Arrow transfer switched on."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder the cluster names; fall back to a scratch folder
    only for a local session that names none."""
    context = spark.sparkContext
    if context.getCheckpointDir():
        return
    folder = spark.conf.get(CHECKPOINT_SETTING, None)
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_SETTING} to a shared folder")
        folder = tempfile.mkdtemp(prefix="quillstat-checkpoint-", dir=os.environ.get("TMPDIR", "/tmp"))
    context.setCheckpointDir(folder)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared checkpoint folder and read it back.

    A written table is computed once (``checkpoint`` computes its input twice) and
    outlives lost executors.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _CUTS.append(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_cuts(spark: SparkSession) -> int:
    """Delete the tables that ``cut_lineage`` has written in this driver; call it when no
    result that reads them is needed any more. Returns how many there were."""
    context = spark.sparkContext
    gone = 0
    while _CUTS:
        path = context._jvm.org.apache.hadoop.fs.Path(_CUTS.pop())
        gone += bool(path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True))
    return gone


def keep(df: DataFrame) -> DataFrame:
    """Cache a table that several jobs read; lost blocks are recomputed from lineage."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)


_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
_BATCH_BYTES = 4 << 20
_NO_LIMIT = 2**31 - 1  # Spark then counts rows only, at most 10,000 a batch
_TURN, _BATCHES = Condition(), {"inside": 0, "limit": 0, "before": None}


@contextmanager
def _batches(spark: SparkSession, limit: int) -> Iterator[None]:
    """Threads with the same limit may be inside together, others wait; the last one out restores the setting."""
    with _TURN:
        _TURN.wait_for(lambda: not _BATCHES["inside"] or _BATCHES["limit"] == limit)
        if not _BATCHES["inside"]:
            _BATCHES.update(limit=limit, before=spark.conf.get(_BATCH_SETTING, None))
            spark.conf.set(_BATCH_SETTING, str(limit))
        _BATCHES["inside"] += 1
    try:
        yield
    finally:
        with _TURN:
            _BATCHES["inside"] -= 1
            if not _BATCHES["inside"]:
                if _BATCHES["before"] is None:
                    spark.conf.unset(_BATCH_SETTING)
                else:
                    spark.conf.set(_BATCH_SETTING, _BATCHES["before"])
                _TURN.notify_all()


def small_batches(spark: SparkSession):
    """Jobs started inside pass rows to Python in batches of a few MB.

    A row that holds a block of values is large, and a batch of many such rows is held several times
    over on both sides, outside the heap.
    """
    return _batches(spark, _BATCH_BYTES)


def narrow_batches(spark: SparkSession):
    """For jobs that pass rows of a few numbers: Spark need not measure the batch after every row, which takes longer
    than passing the row. Not to be used inside ``small_batches``."""
    return _batches(spark, _NO_LIMIT)


def side_by_side(spark: SparkSession, run: Callable, tasks: Sequence, parallelism: int) -> list:
    """``run`` of every task, in threads that share the session.

    Each call is wrapped by itself: a wrapper copies the local properties once, and calls under one
    wrapper would share that copy and reset each other's execution ids.
    """
    calls = [inheritable_thread_target(spark)(partial(run, task)) for task in tasks]
    with ThreadPool(max(1, min(parallelism, len(calls)))) as pool:
        return pool.map(lambda call: call(), calls, chunksize=1)
