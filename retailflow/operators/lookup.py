"""Keyed lookups.

No side is forced into a broadcast: Catalyst broadcasts what its statistics put below the session's
threshold, AQE does so at run time for what turns out small, and beyond it the join is a sort-merge
join whose hot partitions AQE splits.  ``salt`` spreads a hot key over several copies of the dimension
where a plan cannot rely on that (for example a dimension too large to copy whole to every executor); such a join
is a sort-merge join always.

A key that occurs twice in the dimension never multiplies rows: the first row by ``order`` is taken, or the
lookup fails at run time (``unique=True``, for tables whose key must be unique), inside the one job.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .keys import first_per_key

On = str | Sequence[str] | Mapping[str, str]
Cols = Sequence[str] | Mapping[str, str]


def _pairs(names: On | Cols) -> list[tuple[str, str]]:
    if isinstance(names, str):
        return [(names, names)]
    if isinstance(names, Mapping):
        return list(names.items())
    return [(n, n) for n in names]


def _row_hash(df: DataFrame) -> Column:
    plain = [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.ArrayType, T.VariantType))]
    return F.xxhash64(*[F.col(f"`{c}`") for c in plain])


def one_per_key(dim: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``dim`` without rows of null key; reading a key that occurs twice is an error that names it.

    The rows of a key meet in one window, so the check costs no second reading of ``dim``.  The window groups by
    the keys as one value: a join on the keys then deals both its sides itself, which is what AQE needs to split hot keys.
    """
    key = F.struct(*[F.col(f"`{k}`") for k in keys])
    nth = F.row_number().over(Window.partitionBy(key).orderBy(F.lit(0)))
    text = F.concat(F.lit(f"key ({', '.join(keys)}) is not unique: "), F.to_json(key))
    known = dim.filter(" AND ".join(f"`{k}` IS NOT NULL" for k in keys)).withColumn("__nth", nth)
    return known.filter(F.when(F.col("__nth") > 1, F.raise_error(text).cast("boolean")).otherwise(True)).drop("__nth")


def lookup(
    df: DataFrame,
    dim: DataFrame,
    on: On,
    cols: Cols,
    *,
    unique: bool | str = False,
    order: str | Sequence[str] | None = None,
    defaults: Mapping[str, object] | None = None,
    flag: str | None = None,
    salt: int | None = None,
) -> DataFrame:
    """Attach ``cols`` of ``dim`` to every row of ``df``; the row count never changes.

    ``on`` maps df column -> dim column, ``cols`` maps dim column -> output name (an output may replace
    a column of ``df``).  ``unique`` says that the key must be unique, which is checked while the lookup runs;
    ``unique="grouped"`` that ``dim`` was made by grouping on exactly this key, which needs no check; otherwise the
    first row per key by ``order`` is used.  ``defaults`` fill outputs of rows *without a match*: a matched null stays null.
    """
    on, cols = _pairs(on), _pairs(cols)
    if not unique:
        dim = first_per_key(dim, [d for _, d in on], order or [c for c, _ in cols])
    elif unique != "grouped":
        dim = one_per_key(dim, [d for _, d in on])
    right = dim.select(
        *[F.col(f"`{d}`").alias(f"__k{i}") for i, (_, d) in enumerate(on)],
        *[F.col(f"`{c}`").alias(f"__v{i}") for i, (c, _) in enumerate(cols)],
        F.lit(True).alias("__hit"),
    )
    left = df
    cond = [F.col(f"`{l}`") == F.col(f"__k{i}") for i, (l, _) in enumerate(on)]
    if salt:
        left = left.withColumn("__salt", F.pmod(_row_hash(df), F.lit(salt)).cast("int"))
        # never broadcast: the planner sizes the copies as one
        right = right.withColumn("__salt_copy", F.explode(F.sequence(F.lit(0), F.lit(salt - 1)))).hint("merge")
        cond.append(F.col("__salt") == F.col("__salt_copy"))
    joined = left.join(right, cond, "left")
    defaults = defaults or {}
    new = {}
    for i, (_, out) in enumerate(cols):
        value = F.col(f"__v{i}")
        if out in defaults:
            d = defaults[out]
            value = F.when(F.col("__hit"), value).otherwise(d if isinstance(d, Column) else F.lit(d))
        new[out] = value
    if flag:
        new[flag] = F.coalesce(F.col("__hit"), F.lit(False))
    names = df.columns + [c for c in new if c not in df.columns]
    return joined.select(*[new[c].alias(c) if c in new else F.col(f"`{c}`") for c in names])


def lookup_chain(df: DataFrame, attempts: Sequence[tuple[DataFrame, On]], cols: Cols, **kw) -> DataFrame:
    """Try dimensions in turn; the first one holding the key decides, also when its value is null."""
    cols = _pairs(cols)
    out, hits = df, []
    for i, (dim, on) in enumerate(attempts):
        out = lookup(out, dim, on, {c: f"__try{i}_{o}" for c, o in cols}, flag=f"__hit{i}", **kw)
        hits.append(f"__hit{i}")
    for _, o in cols:
        value = None
        for i, h in enumerate(hits):
            here = F.col(f"__try{i}_{o}")
            value = F.when(F.col(h), here) if value is None else value.when(F.col(h), here)
        out = out.withColumn(o, value)
    return out.drop(*[c for c in out.columns if c.startswith("__try") or c.startswith("__hit")])


def grid_lookup(df: DataFrame, grid: DataFrame, row: str, col: str, value: str, out: str) -> DataFrame:
    """Cell of a two-label matrix kept long as (row label, column label, value)."""
    r, c = grid.columns[:2]
    return lookup(df, grid, {row: r, col: c}, {value: out}, unique=True)


def left_join_fill(df: DataFrame, other: DataFrame, on: On, fills: Mapping[str, object], unique: bool = True) -> DataFrame:
    """Left join whose unmatched *and* null values become the fill."""
    out = lookup(df, other, on, list(fills), unique=unique)
    return out.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in fills.items()})


def rows_update(a: DataFrame, b: DataFrame, on: str | Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Replace ``cols`` of rows of ``a`` found in ``b``; other rows and unmatched rows of ``b`` are left."""
    return lookup(a, b, on, cols, unique=False, defaults={c: F.col(c) for c in cols})


def semi(df: DataFrame, other: DataFrame, on: On) -> DataFrame:
    return _exists(df, other, on, "left_semi")


def anti(df: DataFrame, other: DataFrame, on: On) -> DataFrame:
    """Rows whose key is absent from ``other``; rows with a null key stay."""
    return _exists(df, other, on, "left_anti")


def _exists(df: DataFrame, other: DataFrame, on: On, how: str) -> DataFrame:
    on = _pairs(on)
    keys = other.select(*[F.col(f"`{r}`").alias(f"__k{i}") for i, (_, r) in enumerate(on)])
    return df.join(keys, [F.col(f"`{l}`") == F.col(f"__k{i}") for i, (l, _) in enumerate(on)], how)
