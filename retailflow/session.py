"""Session settings and shared frames."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on.  Numbers of partitions and executor memory stay with the cluster;
# AQE coalesces small shuffles, splits skewed join partitions and turns small sides into broadcasts.
RELIED_ON = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

# MB of packed input a task is given at most; a cluster may name less.  Numbers pack to a few bytes a row, and a task holds its rows
# unpacked, hashed and sorted, some twenty times that: with the default 64 and 128 MB a task's memory goes on growing with the tables.
AT_MOST_MB = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": 16,
    "spark.sql.files.maxPartitionBytes": 32,
}


def _megabytes(size: str) -> float:
    number, unit = re.fullmatch(r"(-?\d+)([bkmgtp]?)b?", size.strip().lower()).groups()
    return int(number) * 1024.0 ** ("bkmgtp".index(unit or "b") - 2)


def hold_at_most(spark: SparkSession, limits: dict[str, int] = AT_MOST_MB) -> None:
    """Lower sizes above ``limits`` (setting to MB)."""
    for key, mb in limits.items():
        if not 0 <= _megabytes(spark.conf.get(key)) <= mb:
            spark.conf.set(key, f"{mb}m")


def build_session(app: str = "retailflow", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RELIED_ON, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    hold_at_most(spark)
    return spark


def apply_settings(spark: SparkSession) -> SparkSession:
    """Set what the jobs rely on in a session somebody else made."""
    for key, value in RELIED_ON.items():
        spark.conf.set(key, value)
    hold_at_most(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names; a temporary one only for a local session without any."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    return tempfile.mkdtemp(prefix="retailflow-checkpoint-")


class SharedFrames:
    """Owner of frames that several branches of a plan read: each is written once and dropped with its owner.

        with SharedFrames(spark) as shared:
            demand.years_of_stock(framed, shared).write...

    A frame becomes a table of the warehouse, which all executors reach: it is computed once, branches read only the columns they
    need, and an executor lost later costs none of what came before.  Keeping a frame runs its job.
    """

    def __init__(self, spark: SparkSession):
        self._spark = spark
        self._tables: list[str] = []

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        table = f"shared_{name}_{uuid.uuid4().hex[:12]}"
        self._tables.append(table)
        df.write.format("parquet").option("compression", "zstd").saveAsTable(table)
        return self._spark.table(table)

    def close(self) -> None:
        while self._tables:
            self._spark.sql(f"DROP TABLE IF EXISTS {self._tables.pop()}")

    def __enter__(self) -> SharedFrames:
        return self

    def __exit__(self, *exc) -> None:
        self.close()


def kept(df: DataFrame, shared: SharedFrames | None, name: str) -> DataFrame:
    """The frame, written once if it has an owner."""
    return shared.keep(df, name) if shared else df
