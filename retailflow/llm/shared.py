"""What several operators of this package need: shipping code to executors, bounded batches, written intermediate tables."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import os
import tempfile
import uuid
import zipfile

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ..session import checkpoint_dir, hold_at_most

_shipped: dict[str, str] = {}

# MB of rows that go to a Python worker at once, at most; a session may name less.  The JVM and the worker both hold them.
BATCH_MB = {"spark.sql.execution.arrow.maxBytesPerBatch": 8}


def ready(spark: SparkSession) -> SparkSession:
    """Give executors this package's Python files (once per application) and hold batches to their size."""
    hold_at_most(spark, BATCH_MB)
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        here = os.path.dirname(os.path.abspath(__file__))
        top = os.path.dirname(here)
        path = os.path.join(tempfile.mkdtemp(prefix="retailflow-code-"), "retailflow_code.zip")
        with zipfile.ZipFile(path, "w") as z:
            for folder in (top, here):
                for name in sorted(os.listdir(folder)):
                    if name.endswith(".py"):
                        z.write(os.path.join(folder, name), os.path.relpath(os.path.join(folder, name), os.path.dirname(top)))
        spark.sparkContext.addPyFile(path)
        _shipped[app] = path
    return spark


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder's path below the one the cluster shares (spark.checkpoint.dir)."""
    top = checkpoint_dir(spark)
    if spark.conf.get("spark.checkpoint.dir", None) is None:
        spark.conf.set("spark.checkpoint.dir", top)  # a local session without the setting: one folder for all
    return f"{top.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The same rows, written to the shared folder and read from there: computed once, no lineage to recompute."""
    path = shared_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def tidy(run):
    """A task's generator that gives its memory back to the system when it ends.

    Workers live on for the tasks of other stages; what the allocators keep of one stage's arrays would count against them all.
    """
    @functools.wraps(run)
    def tidied(batches):
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):  # a C library without it keeps what it keeps
                ctypes.CDLL(None).malloc_trim(0)
    return tidied
