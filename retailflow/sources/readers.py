"""Delimited exports with fixed schemas, source positions, newest-file and snapshot selection.

Files of one kind are read by their own header lines.  A census looks at the first line of every file (one task a file, which
stops there), files are grouped by header, and each distinct header is one scan, however many files there are.
"""

from __future__ import annotations

import csv
import fnmatch
import re
from collections.abc import Iterator, Mapping, Sequence
from datetime import date
from functools import reduce
from typing import NamedTuple
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

POS = "_pos"
# Row numbers inside one task fill the low 33 bits of monotonically_increasing_id(); above them count mebibytes: those of the
# files before, and those before the row's split in its own file.
_ROW_BITS = 33
_UNIT = 1 << 20
_WHOLE_FILE = 1 << 40


class _File(NamedTuple):
    path: str  # as Spark's metadata spells it
    size: int
    head: str | None


def _pick_heads(start: str | None, encoding: str):
    """Of each task's one file: the first line, or the first that starts with ``start`` (null where none does)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = None
        for batch in batches:
            for path, size, raw in zip(*(c.to_pylist() for c in batch.columns)):
                seen = path, size
                line = raw.decode(encoding, "replace").lstrip("\ufeff")
                if start is None or line.startswith(start):
                    yield pa.record_batch([pa.array([path]), pa.array([size], pa.int64()), pa.array([line])], ["path", "size", "head"])
                    return
        if seen:
            yield pa.record_batch([pa.array([seen[0]]), pa.array([seen[1]], pa.int64()), pa.array([None], pa.string())], ["path", "size", "head"])
    return run


def census(spark: SparkSession, path: str | Sequence[str], start: str | None = None, encoding: str = "UTF-8") -> list[_File]:
    """The files of a path, pattern or list of them, in the order given (those of one pattern by path), with their header lines.

    One job with a task per file.  A task reads the beginning of its file only.  Empty files are left out.
    """
    given = [path] if isinstance(path, str) else list(path)
    lines = spark.read.text(given).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size"), F.col("value").cast("binary").alias("raw"))
    alone = {"spark.sql.files.maxPartitionBytes": _WHOLE_FILE, "spark.sql.files.openCostInBytes": _WHOLE_FILE}  # one file a task, whole
    before = {k: spark.conf.get(k) for k in alone}
    try:
        for k, v in alone.items():
            spark.conf.set(k, v)
        found = lines.mapInArrow(_pick_heads(start, encoding), "path string, size long, head string").toArrow().to_pylist()  # a row a file
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    rank = _ranks(given)
    return sorted((_File(**f) for f in found), key=lambda f: (rank(f.path), f.path))


def _ranks(given: Sequence[str]):
    """Place in the list of the path or pattern a file came from."""
    tails = [re.sub(r"^[a-z0-9]+:/*", "/", g).rstrip("/") for g in given]
    whole = {t: i for i, t in reversed(list(enumerate(tails)))}
    patterns = [(i, t) for i, t in enumerate(tails) if re.search(r"[*?\[{]", t)]

    def rank(path: str) -> int:
        plain = re.sub(r"^[a-z0-9]+:/*", "/", unquote(path))
        at = plain
        while at:  # the file itself, or a folder that was given
            if at in whole:
                return whole[at]
            at = at.rpartition("/")[0]
        return next((i for i, p in patterns if fnmatch.fnmatchcase(plain, "*" + p.lstrip("/") + "*")), len(tails))
    return rank


def _by_head(files: Sequence[_File]) -> dict[str, list[_File]]:
    groups: dict[str, list[_File]] = {}
    for f in files:
        groups.setdefault(f.head, []).append(f)
    return groups


def _paths(files: Sequence[_File]) -> list[str]:
    """Paths as Spark's readers take them, characters of patterns escaped."""
    return [re.sub(r"([*?{}\[\]\\])", r"\\\1", unquote(f.path)) for f in files]


def _unique(names: Sequence[str]) -> list[str]:
    """Header cells as column names: blank and repeated ones (whatever their case) get their place."""
    seen: set[str] = set()
    out = []
    for i, n in enumerate(names):
        n = n if n.strip() and n.lower() not in seen else f"{n}__{i}"
        seen.add(n.lower())
        out.append(n)
    return out


def _file_name() -> Column:
    """The file's name as people write it (the metadata's is percent-encoded)."""
    return F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))


def with_pos(df: DataFrame, source: str | None = None, files: Sequence[_File] = ()) -> DataFrame:
    """Add ``_pos``, the order of rows inside their file, straight after a file scan; with ``files`` across them in that order.

    A file is read in splits; the split's offset (in MiB, splits are never smaller) leads and the row number
    inside the task follows, so positions grow along the file whichever tasks read it.  A file begins behind the mebibytes of those before.
    """
    row = F.monotonically_increasing_id().bitwiseAND((1 << _ROW_BITS) - 1)
    unit = (F.col("_metadata.file_block_start") / F.lit(_UNIT)).cast("bigint")
    cols = [F.col(f"`{c}`") for c in df.columns]
    extra = [_file_name().alias(source)] if source else []
    out = df.select(*cols, unit.alias("__unit"), row.alias("__row"), *([F.col("_metadata.file_path").alias("__file")] if files else []), *extra)
    if files:
        bases, at = [], 0
        for f in files:
            bases.append((f.path, at))
            at += f.size // _UNIT + 1
        out = out.join(df.sparkSession.createDataFrame(bases, "__file string, __base long"), "__file")
    base = F.col("__base") if files else F.lit(0)
    pos = (F.shiftleft(base + F.col("__unit"), _ROW_BITS) + F.col("__row")).alias(POS)
    return out.select(*cols, pos, *([source] if source else []))


def read_table(spark: SparkSession, path: str | Sequence[str], schema: T.StructType, *, sep: str = ",",
               encoding: str = "UTF-8", pos: bool = False, source: str | None = None, header: bool = True,
               headers: Mapping[str, str] | None = None) -> DataFrame:
    """Delimited text as the columns of ``schema``; blank cells and unreadable values are null, nothing is inferred.

    With a header line columns are found by name, in each file by its own: spelled as ``headers`` (schema column -> header) says,
    else as the schema's names with any case and punctuation ("Regular price" is ``regular_price``).  Columns the schema lacks
    are not read, their order is free, a column that a file lacks is an error.  Without a header line columns go
    by position.  With ``pos`` positions grow from file to file in the order given.
    """
    reader = spark.read.option("sep", sep).option("encoding", encoding).option("quote", '"').option("escape", '"')
    extra = ([POS] if pos else []) + ([source] if source else [])
    kinds = {f.name: f.dataType for f in schema.fields}

    def bound(df: DataFrame, names: Mapping[str, str], order: Sequence[_File]) -> DataFrame:
        if pos:
            df = with_pos(df, source, order)
        elif source:
            df = df.select(*[F.col(f"`{c}`") for c in df.columns], _file_name().alias(source))
        return df.select(*[F.col(f"`{h}`").try_cast(kinds[c]).alias(c) for c, h in names.items()], *extra)

    files = census(spark, path, encoding=encoding) if header or pos else []
    order = files if len(files) > 1 else []
    if not header:
        return bound(reader.schema(schema).csv(path), {c: c for c in kinds}, order)
    if not files:
        raise ValueError(f"{path}: no file with a header line")
    parts = []
    for head, some in _by_head(files).items():
        found = _unique(next(csv.reader([head], delimiter=sep)))
        names = _named(found, schema, headers or {}, some[0].path)
        scan = reader.option("header", True).schema(T.StructType([T.StructField(n, T.StringType()) for n in found])).csv(_paths(some))
        parts.append(bound(scan, names, order))
    return reduce(DataFrame.unionByName, parts)


def _plain(name: str) -> str:
    return re.sub(r"[^0-9a-z]+", "_", name.lower()).strip("_")


def _named(found: Sequence[str], schema: T.StructType, headers: Mapping[str, str], path, by_place: bool = False) -> dict[str, str]:
    """Schema column -> the file's spelling of it; with ``by_place`` a column not named takes its own place if no other has it."""
    plain: dict[str, str] = {}
    for name in found:
        plain.setdefault(_plain(name), name)
    out = {}
    for f in schema.fields:
        given = headers.get(f.name)
        out[f.name] = given if given in found else plain.get(_plain(given or f.name), plain.get(_plain(f.name)))
    if by_place:
        free = {i: h for i, h in enumerate(found) if h not in out.values()}
        out = {c: h if h is not None else free.get(i) for i, (c, h) in enumerate(out.items())}
    if missing := [c for c, h in out.items() if h is None]:
        raise ValueError(f"{path}: no column {', '.join(missing)} among {', '.join(found)}")
    return out


def read_after_preamble(spark: SparkSession, path: str | Sequence[str], schema: T.StructType, header: str,
                        *, sep: str = ",", headers: Mapping[str, str] | None = None) -> DataFrame:
    """Delimited text whose table starts after free-text lines: rows below the line starting with ``header``.

    Columns are found by that line's names, as ``read_table`` does, those it does not name by their place; a file without
    such a line is an error.
    """
    files = census(spark, path, header)
    if lacking := [f.path for f in files if f.head is None]:
        raise ValueError(f"{lacking[0]}: no line starts with {header}")
    kinds = {f.name: f.dataType for f in schema.fields}
    parts = []
    for head, some in _by_head(files).items():
        found = _unique(next(csv.reader([head], delimiter=sep)))
        names = _named(found, schema, headers or {}, some[0].path, by_place=True)
        text = spark.read.text(_paths(some)).select("value", F.col("_metadata.file_path").alias("__path"))
        lines = with_pos(text, files=files if len(files) > 1 else ())
        heads = lines.filter(F.col("value").contains(header)).groupBy("__path").agg(F.min(POS).alias("__head"))
        body = lines.join(heads, "__path").filter((F.col(POS) > F.col("__head")) & (F.trim("value") != ""))
        cells = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(found))])
        row = F.from_csv("value", ", ".join(f"c{i} STRING" for i in range(len(cells))), {"sep": sep, "escape": '"'})
        place = {n: i for i, n in enumerate(found)}
        parts.append(body.select(row.alias("r"), POS).select(*[F.col(f"r.c{place[h]}").try_cast(kinds[c]).alias(c) for c, h in names.items()], POS))
    return reduce(DataFrame.unionByName, parts)


def latest_file(spark: SparkSession, pattern: str) -> str:
    """Path of the newest file by modification time; only the listing is read."""
    files = spark.read.format("binaryFile").load(pattern).select("path", "modificationTime")
    top = files.orderBy(F.desc("modificationTime"), F.desc("path")).limit(1).collect()
    if not top:
        raise FileNotFoundError(pattern)
    return top[0]["path"]


def only_file(spark: SparkSession, pattern: str) -> str:
    """Path of the one file that must match."""
    files = spark.read.format("binaryFile").load(pattern).select("path").limit(2).collect()
    if len(files) != 1:
        raise ValueError(f"{pattern}: expected one file, found {'several' if files else 'none'}")
    return files[0]["path"]


def read_snapshot(spark: SparkSession, table: str, snapshot: date) -> DataFrame:
    """One day of a table kept in ``snapshot_date=`` folders; the other days' folders are pruned."""
    return spark.read.parquet(table).filter(F.col("snapshot_date") == F.lit(snapshot)).drop("snapshot_date")


def read_many(spark: SparkSession, paths: Sequence[str], schema: T.StructType, source: str, **kw) -> DataFrame:
    """Files of one kind as one table, file name kept: ``read_table`` of a list."""
    return read_table(spark, paths, schema, source=source, **kw)


def drop_marker_rows(df: DataFrame, col: str, markers: Sequence[str]) -> DataFrame:
    """Drop summary and repeated header rows; rows without the column's value stay."""
    return df.filter(~F.coalesce(F.col(col).isin(list(markers)), F.lit(False)))


def _of(df: DataFrame, kind) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kind)]


def blank_to_zero(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Missing numbers become 0; text columns are left alone."""
    cols = cols or _of(df, T.NumericType)
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(0).cast(df.schema[c].dataType)) for c in cols})


def trim_strings(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.trim(c) for c in _of(df, T.StringType)})


def drop_empty(df: DataFrame, ignore: Sequence[str] = (POS,)) -> DataFrame:
    """Drop rows empty in every column (positions aside); blanks count as empty."""
    cols = [f for f in df.schema.fields if f.name not in ignore]
    filled: Column = F.lit(False)
    for f in cols:
        has = F.col(f.name).isNotNull()
        if isinstance(f.dataType, T.StringType):
            has = has & (F.trim(f.name) != "")
        filled = filled | has
    return df.filter(filled)


def parse_folder_name(df: DataFrame, col: str) -> DataFrame:
    """``"P12 - CAT - vendor - sent"`` to po, category, vendor and the memo without the sent mark."""
    memo = F.regexp_replace(col, " *- *sent.*", "")
    parts = F.split(memo, " *- *", 3)
    return df.withColumns({
        "memo": memo,
        "po": F.trim(F.get(parts, F.lit(0))),
        "category": F.trim(F.get(parts, F.lit(1))),
        "vendor": F.trim(F.regexp_replace(F.get(parts, F.lit(2)), " *-.*", "")),
    })
