"""Row splitting, ranges, pivots with fixed columns, region columns to rows, calendars."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import sku


def rename_all(df: DataFrame, fn: Callable[[str], str]) -> DataFrame:
    return df.withColumnsRenamed({c: fn(c) for c in df.columns})


def with_constants(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.withColumns({c: F.lit(v) for c, v in values.items()})


def across(df: DataFrame, cols: Sequence[str], fn: Callable[[Column], Column]) -> DataFrame:
    """The same function over many columns, in one projection."""
    return df.withColumns({c: fn(F.col(c)) for c in cols})


def sort_r(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sort with missing values last both ways; ``-name`` sorts descending."""
    return df.orderBy(*[F.col(k[1:]).desc_nulls_last() if k.startswith("-") else F.col(k).asc_nulls_last() for k in keys])


def sort_sku(df: DataFrame, col: str) -> DataFrame:
    """Sort by category, then size."""
    return df.orderBy(sku.category(col), sku.size(col), col)


def split_rows(df: DataFrame, col: str, sep: str) -> DataFrame:
    """One row per delimited item, trimmed; a null stays one row."""
    items = F.split(F.col(col), f"\\Q{sep}\\E")
    return df.withColumn(col, F.explode_outer(items)).withColumn(col, F.trim(col))


def explode_range(df: DataFrame, start: str, end: str, out: str) -> DataFrame:
    """One row per whole number between the ends; a range written backwards counts down."""
    return df.withColumn(out, F.explode(F.sequence(F.col(start), F.col(end))))


def pivot_fixed(df: DataFrame, by: Sequence[str], col: str, values: Mapping[object, str],
                aggs: Mapping[str, Column]) -> DataFrame:
    """Long to wide over a fixed list of values; column names are ``agg_label`` (``label`` for one agg)."""
    g = df.groupBy(*by).pivot(col, list(values)).agg(*[a.alias(n) for n, a in aggs.items()])
    names = {}
    for v, label in values.items():
        for n in aggs:
            src = str(v) if len(aggs) == 1 else f"{v}_{n}"
            names[src] = label if len(aggs) == 1 else f"{n}_{label}"
    return g.withColumnsRenamed(names)


def unpivot_regions(df: DataFrame, keys: Sequence[str], regions: Mapping[str, str],
                    names: tuple[str, str] = ("region", "qty")) -> DataFrame:
    """Quantity columns to rows labelled by region; missing quantities give no row."""
    wide = df.select(*keys, *[F.col(c).alias(label) for c, label in regions.items()])
    return wide.unpivot(list(keys), list(regions.values()), names[0], names[1]).filter(F.col(names[1]).isNotNull())


def calendar(spark: SparkSession, start: date, end: date, skip_sundays: bool = True,
             closed: Sequence[date] = ()) -> DataFrame:
    days = spark.range(1).select(F.explode(F.sequence(F.lit(start), F.lit(end))).alias("date"))
    if skip_sundays:
        days = days.filter(F.dayofweek("date") != 1)
    return days.filter(~F.col("date").isin([F.lit(d) for d in closed])) if closed else days


def with_calendar(daily: DataFrame, days: DataFrame, fills: Mapping[str, object]) -> DataFrame:
    """Add calendar days without a row; days with rows stay, also those off the calendar."""
    out = daily.join(days, "date", "full")
    return out.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in fills.items()})
