"""Sinks: exports in the target's column spelling and order, checked totals, one folder per category, snapshot and versioned tables."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from ..functions.semantics import percent_text
from ..operators.reshape import sort_r, sort_sku

MANIFEST = "_manifest"  # Spark's readers leave names with an underscore out


def write_export(df: DataFrame, path: str, renames: Mapping[str, str] | None = None, *, encoding: str = "UTF-8", quote_all: bool = False,
                 mode: str = "errorifexists", percents: Sequence[str] = (), order: Sequence[str] | None = None, sku_order: str | None = None,
                 checks: Mapping[str, tuple[Column, object]] | None = None) -> None:
    """CSV with nulls blank and headers renamed to the target's spelling; a column the spelling lacks is an error.

    Columns named in ``percents`` are numbers inside and percent text in the file.  With ``order`` (as ``sort_r`` takes it) or ``sku_order`` (a SKU column) rows are in total order: ranges of the keys are dealt to
    tasks and sorted there, a file is one range, file names follow the ranges, and a manifest lists the files in order.
    With ``checks`` totals are held against what they should be (see ``write_checked``).
    """
    if renames and (extra := [c for c in df.columns if c not in renames]):
        raise ValueError(f"no header for {', '.join(extra)}")
    if order or sku_order:
        df = sort_r(df, order) if order else sort_sku(df, sku_order)
    out = df.withColumns({c: percent_text(c) for c in percents}).withColumnsRenamed(dict(renames or {}))
    dates = [f.name for f in out.schema.fields if isinstance(f.dataType, T.DateType)]
    out = out.withColumns({c: F.date_format(c, "MM/dd/yyyy") for c in dates}) if dates else out
    options = {"header": True, "nullValue": "", "emptyValue": "", "encoding": encoding, "quoteAll": quote_all}
    write_checked(out, path, checks or {}, "csv", mode, **options)
    if order or sku_order:
        files = out.sparkSession.read.text(path).groupBy(F.col("_metadata.file_name").alias("file")).agg((F.count("*") - 1).alias("n_rows"))
        files.orderBy("file").coalesce(1).write.mode(mode).json(f"{path}/{MANIFEST}")


def ordered_files(spark: SparkSession, path: str) -> list[str]:
    """The files of an ordered export, first to last."""
    names = spark.read.json(f"{path}/{MANIFEST}").orderBy("file").collect()  # a row a file
    return [f"{path}/{r['file']}" for r in names]


class TotalsDiffer(ValueError):
    """A total of the rows written is not the stated one; ``found`` has all totals."""

    def __init__(self, found: Mapping[str, object], stated: Mapping[str, object]):
        self.found = dict(found)
        super().__init__("; ".join(f"{k}: {found[k]} written, {v} stated" for k, v in stated.items() if found[k] != v))


def write_checked(df: DataFrame, path: str, checks: Mapping[str, tuple[Column, object]], fmt: str = "parquet", mode: str = "errorifexists",
                  fail: bool = True, **options) -> dict[str, object]:
    """Write, and take totals of the rows in the same pass: ``checks`` are name -> (aggregate, stated value).

    A total that differs is an error, raised after the rows are written (so that they can be looked at), or with ``fail=False`` only
    reported.  Returns the totals.  Nothing is read a second time.
    """
    seen = Observation(f"checks-{uuid.uuid4().hex[:8]}")
    rows = df.observe(seen, *[total.alias(name) for name, (total, _) in checks.items()]) if checks else df
    rows.write.mode(mode).format(fmt).options(**options).save(path)
    found = dict(seen.get) if checks else {}
    stated = {name: value for name, (_, value) in checks.items() if value is not None}
    if fail and any(found[k] != v for k, v in stated.items()):
        raise TotalsDiffer(found, stated)
    return found


def write_partitioned(df: DataFrame, path: str, by: str, fmt: str = "parquet", mode: str = "errorifexists") -> None:
    """One folder per value of ``by``.

    Rows are brought together by value first (few files per folder); adaptive execution splits the partition
    of a value that holds many rows, so no task writes a hot value alone.
    """
    writer = df.hint("rebalance", F.col(by)).write.mode(mode).partitionBy(by)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)


def write_snapshot(df: DataFrame, table: str, snapshot: date) -> None:
    """Add one ``snapshot_date=`` folder to a table kept between steps."""
    df.write.mode("overwrite").parquet(f"{table}/snapshot_date={snapshot.isoformat()}")


class VersionedTable:
    """A table that a job can read and replace.

    A new version is written beside the old one, and only then a line is added to the table's history; the last line names the
    current version.  Adding a line is one new file, which is there or not.  A driver lost before it leaves the old
    version current, and a reader never sees half a table.  Old versions stay readable by number.
    """

    HISTORY = "version long, folder string"

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema

    def _history(self) -> DataFrame:
        try:
            return self.spark.read.schema(self.HISTORY).parquet(f"{self.path}/history")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], self.HISTORY)

    def version(self) -> int:
        """Number of the current version; 0 before the first."""
        return self._history().agg(F.coalesce(F.max("version"), F.lit(0))).first()[0]

    def read(self, version: int | None = None) -> DataFrame:
        """A version's rows, the current one's unless told otherwise; none before the first version."""
        wanted = self._history().filter(F.lit(True) if version is None else F.col("version") == version)
        last = wanted.orderBy(F.desc("version"), F.desc("folder")).first()  # of two writers at once the same one for all
        if last is None:
            if version:
                raise ValueError(f"{self.path}: no version {version}")
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/{last['folder']}")

    def replace(self, df: DataFrame) -> int:
        """Make the rows of ``df``, which may read this table, the current version."""
        version, folder = self.version() + 1, f"data-{uuid.uuid4().hex}"
        df.select(*[F.col(f"`{f.name}`").cast(f.dataType) for f in self.schema.fields]).write.parquet(f"{self.path}/{folder}")
        self._commit(version, folder)
        return version

    def _commit(self, version: int, folder: str) -> None:
        self.spark.createDataFrame([(version, folder)], self.HISTORY).coalesce(1).write.mode("append").parquet(f"{self.path}/history")
