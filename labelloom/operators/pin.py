"""Fixing intermediate results.

``pin`` is for a handful of numbers per class, or a vocabulary, that every row
needs: it settles the frame and counts its rows in the files. Within the bound
it is broadcast, beyond it joined like any other table.

``settle`` writes a frame to the shared folder and reads it back. Later jobs
start from the files, whatever executors were lost in between, and plan with
their real size.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MAX_PINNED_ROWS = 20_000


def shared_folder(spark: SparkSession) -> str:
    """The folder the session names in ``spark.checkpoint.dir``, or its checkpoint directory.

    A temporary one is made only where neither is set and everything runs in
    one process, as in tests.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", "") or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="checkpoints-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


_SETTLED: list[str] = []


def scratch_path(spark: SparkSession) -> str:
    """A new path in the shared folder, for files that stay until :func:`release`."""
    path = f"{shared_folder(spark)}/labelloom-{uuid.uuid4().hex}"
    _SETTLED.append(path)
    return path


def settle(frame: DataFrame) -> DataFrame:
    """``frame`` written to the shared folder and read back. The files stay until :func:`release`."""
    spark = frame.sparkSession
    path = scratch_path(spark)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Delete what this program has settled; frames that stand on it can't be read any more."""
    while _SETTLED:
        remove(spark, _SETTLED.pop())


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder, if it is there."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def settle_alone(make: Callable[[], DataFrame]) -> DataFrame:
    """The frame that ``make`` gives, settled. What was settled on the way to it is deleted, as it stands on it no more."""
    before = len(_SETTLED)
    made = settle(make())
    own = _SETTLED.pop()
    while len(_SETTLED) > before:
        remove(made.sparkSession, _SETTLED.pop())
    _SETTLED.append(own)
    return made


def pin(frame: DataFrame, max_rows: int = MAX_PINNED_ROWS) -> DataFrame:
    """``frame`` settled; marked for broadcast if it has at most ``max_rows`` rows, joined as Spark chooses otherwise."""
    settled = settle(frame)
    return F.broadcast(settled) if settled.count() <= max_rows else settled
