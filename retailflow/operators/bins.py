"""Exact quantiles, equal-count bins, median imputation, rank bands."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


STRIDE = 16  # cuts looked over together


def column_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float], blocks: int = 256) -> DataFrame:
    """(c, q): per column, by its place in ``cols``, exact quantiles with linear interpolation between order statistics.

    All columns go together.  Values are counted first, and everything after reads the counts from their one exchange.
    A mergeable sketch of the distinct values cuts them into ``blocks`` brackets, bracket totals tell which brackets hold a wanted
    order statistic (two a probability at most), and only these are put in order and counted through.  What is broadcast has
    a row per column, or per column and wanted bracket.
    """
    pairs = F.array(*[F.struct(F.lit(i).alias("c"), F.col(f"`{c}`").cast("double").alias("v")) for i, c in enumerate(cols)])
    counts = df.select(F.explode(pairs).alias("x")).select("x.*").filter("v IS NOT NULL").groupBy("c", "v").agg(F.count("*").alias("n"))
    counts = counts.filter("n > 0")  # names the count, so that every reader needs the same exchange
    cuts = counts.groupBy("c").agg(F.percentile_approx("v", [i / blocks for i in range(1, blocks)], 10_000).alias("e"))
    # cuts below a value are counted in strides first, then inside one stride
    cuts = cuts.withColumn("far", F.filter("e", lambda _, i: i % STRIDE == STRIDE - 1))
    below = lambda cut: cut < F.col("v")
    strides = counts.join(F.broadcast(cuts), "c").withColumn("s", F.size(F.filter("far", below)) * STRIDE)
    tagged = strides.select("c", "v", "n", (F.col("s") + F.size(F.filter(F.slice("e", F.col("s") + 1, F.lit(STRIDE)), below))).alias("b"))
    totals = tagged.groupBy("c", "b").agg(F.sum("n").alias("bn"))
    of_column = Window.partitionBy("c")
    totals = totals.withColumns({"total": F.sum("bn").over(of_column), "upto": F.sum("bn").over(of_column.orderBy("b"))})
    at = [(F.col("total") - 1) * F.lit(float(p)) for p in probs]
    held = [(F.col("upto") > rank) & (F.col("upto") - F.col("bn") <= rank) for h in at for rank in (F.floor(h), F.ceil(h))]
    wanted = totals.filter(reduce(lambda a, b: a | b, held)).select("c", "b", "total", (F.col("upto") - F.col("bn")).alias("before"))
    inside = Window.partitionBy("c", "b").orderBy("v")
    ranked = tagged.join(F.broadcast(wanted), ["c", "b"]).withColumn("upto", F.sum("n").over(inside) + F.col("before"))
    stats = ranked.groupBy("c").agg(
        F.max("total").alias("total"),
        *[F.min(F.when(F.col("upto") > F.floor(h), F.col("v"))).alias(f"lo{i}") for i, h in enumerate(at)],
        *[F.min(F.when(F.col("upto") > F.ceil(h), F.col("v"))).alias(f"hi{i}") for i, h in enumerate(at)])
    q = [F.col(f"lo{i}") + (h - F.floor(h)) * (F.col(f"hi{i}") - F.col(f"lo{i}")) for i, h in enumerate(at)]
    return stats.select("c", F.array(*q).alias("q"))


def exact_quantiles(df: DataFrame, col: str, probs: Sequence[float], blocks: int = 256) -> DataFrame:
    """One row with array ``q``: exact quantiles of a column, nulls where it has no value."""
    found = column_quantiles(df, [col], probs, blocks).agg(F.any_value("q").alias("q"))  # one row, also of an empty table
    none = F.array(*[F.lit(None).cast("double") for _ in probs])
    return found.select(F.coalesce("q", none).alias("q"))


def equal_count_bin(df: DataFrame, col: str, n: int, where: Column | None = None, out: str = "bin") -> DataFrame:
    """1-based bin among ``n`` bins of about equal counts.

    Edges are exact quantiles, intervals are right-closed with the lowest value included, equal edges merge
    and ties share a bin.  ``where`` limits the rows that make the edges; other rows get null.
    """
    inside = df if where is None else df.filter(where)
    edges = exact_quantiles(inside, col, [i / n for i in range(n + 1)])
    e = F.array_distinct(edges.scalar())
    tagged = df.withColumn("__e", e)
    inner = F.slice("__e", 2, F.greatest(F.size("__e") - 2, F.lit(0)))
    bin_ = F.size(F.filter(inner, lambda x: x < F.col(col).cast("double"))) + 1
    keep = F.col(col).isNotNull() if where is None else (F.coalesce(where, F.lit(False)) & F.col(col).isNotNull())
    return tagged.withColumn(out, F.when(keep, bin_)).drop("__e")


def impute_median(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Missing values become their column's median; the medians of all columns come from one plan."""
    medians = column_quantiles(df, cols, [0.5]).select("c", F.element_at("q", 1).alias("m"))
    by_column = medians.agg(F.map_from_entries(F.collect_list(F.struct("c", "m"))).alias("m")).scalar()  # an entry per column
    return df.withColumns({c: F.coalesce(F.col(c), F.try_element_at(by_column, F.lit(i))) for i, c in enumerate(cols)})


def _sortable(key: Column | str) -> list[Column]:
    """A sort key as fields that sort upwards: ``-name`` is a number downwards, missing values last."""
    if isinstance(key, str) and key.startswith("-"):
        return [F.col(key[1:]).isNull(), -F.col(key[1:])]
    return [F.col(key) if isinstance(key, str) else key]


def assign_by_rank(df: DataFrame, key: Sequence[str], order: Sequence[Column | str], bands: Sequence[tuple[int, object]],
                   default: Column, out: str) -> DataFrame:
    """Value by position after a sort: ``bands`` are (last rank, value) in growing order.

    The sort key at each band's end is one small value (from a distributed top-k of keys alone); a row's band is found by
    comparing its key with these, so the rows themselves are neither ranked, moved nor joined.
    """
    fields = [f for k in [*order, *key] for f in _sortable(k)]
    sort_key = F.struct(*[f.alias(f"f{i}") for i, f in enumerate(fields)])
    first = df.select(sort_key.alias("k")).orderBy("k").limit(bands[-1][0])
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("k")))
    ends = ranked.agg(F.struct(*[F.max(F.when(F.col("rank") <= upto, F.col("k"))).alias(f"e{i}") for i, (upto, _) in enumerate(bands)]).alias("ends"))
    rows = df.withColumns({"__key": sort_key, "__ends": ends.scalar()})
    value = default
    for i, (_, v) in reversed(list(enumerate(bands))):
        value = F.when(F.col("__key") <= F.col(f"__ends.e{i}"), F.lit(v)).otherwise(value)
    return rows.withColumn(out, value).drop("__key", "__ends")
