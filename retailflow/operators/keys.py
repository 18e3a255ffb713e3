"""First row per key, unions by key, densifying and channel fall-back."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _list(x) -> list:
    return [x] if isinstance(x, (str, Column)) else list(x)


def source_order(df: DataFrame) -> list[str]:
    """File order where the table carries positions, else all columns (any row order, but always the same)."""
    return ["_pos"] if "_pos" in df.columns else df.columns


def first_per_key(df: DataFrame, keys: str | Sequence[str], order) -> DataFrame:
    """One full row per key, the first by ``order``.

    ``row_number() = 1`` is pruned by Spark inside every map task before the shuffle, so a hot key sends
    one row per task and not all its rows.
    """
    w = Window.partitionBy(*_list(keys)).orderBy(*_list(order))
    return df.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")


def top_k(df: DataFrame, k: int, order, by: Sequence[str] = ()) -> DataFrame:
    """The k first rows by ``order``, overall or per group."""
    if not by:
        return df.orderBy(*_list(order)).limit(k)
    w = Window.partitionBy(*_list(by)).orderBy(*_list(order))
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= k).drop("__rn")


def union_prefer(a: DataFrame, b: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """All of ``a`` and the rows of ``b`` whose key is not in ``a``."""
    from .lookup import anti

    return a.unionByName(anti(b, a, _list(keys)))


def union_first(a: DataFrame, b: DataFrame, keys: str | Sequence[str], order) -> DataFrame:
    """One row per key; a row of ``a`` wins over a row of ``b``."""
    both = a.withColumn("__src", F.lit(0)).unionByName(b.withColumn("__src", F.lit(1)))
    return first_per_key(both, keys, ["__src", *_list(order)]).drop("__src")


def append_rows(df: DataFrame, rows: Sequence[tuple]) -> DataFrame:
    """Append constant rows given in the column order of ``df``."""
    return df.unionByName(df.sparkSession.createDataFrame(list(rows), df.schema))


def densify(df: DataFrame, keys: DataFrame, fills: Mapping[str, object]) -> DataFrame:
    """Add one row with ``fills`` for every key of ``keys`` that ``df`` lacks."""
    from .lookup import anti

    names = keys.columns
    missing = anti(keys.distinct(), df, names).withColumns({c: F.lit(v) for c, v in fills.items()})
    return df.unionByName(missing, allowMissingColumns=True)


def prefer_rows(df: DataFrame, keys: str | Sequence[str], col: str, order: Sequence[str]) -> DataFrame:
    """Per key keep the rows of the most preferred source present, in ``order``."""
    keys = _list(keys)
    rank = F.coalesce(*[F.when(F.col(col) == v, F.lit(i)) for i, v in enumerate(order)])
    ranked = df.withColumn("__rank", rank).filter(F.col("__rank").isNotNull())
    best = ranked.groupBy(*keys).agg(F.min("__rank").alias("__best"))
    best = best.select(*[F.col(k).alias(f"__k_{k}") for k in keys], "__best")
    cond = [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in keys] + [F.col("__rank") == F.col("__best")]
    return ranked.join(best, cond, "left_semi").drop("__rank")


def upsert_status(log: DataFrame, key: str, status: str, batches: Sequence[tuple[DataFrame, str]]) -> DataFrame:
    """Set the status of logged keys found in a batch (the first batch wins) and append unknown keys.

    A key unknown to the log and present in several batches is appended once per batch, as the log
    records each notice.
    """
    from .lookup import anti, lookup

    # a batch is one row per key before it meets the log; of keys alone, counted out in the map tasks without a sort
    firsts = [(b.distinct() if b.columns == [key] else first_per_key(b, key, b.columns), label) for b, label in batches]
    out = log
    for i, (batch, _) in enumerate(firsts):
        out = lookup(out, batch, key, {}, unique="grouped", flag=f"__in{i}")
    value = F.col(status)
    for i, (_, label) in reversed(list(enumerate(firsts))):
        value = F.when(F.col(f"__in{i}"), F.lit(label)).otherwise(value)
    out = out.withColumn(status, value).select(*log.columns)
    for batch, label in firsts:
        out = out.unionByName(anti(batch, log, key).withColumn(status, F.lit(label)).select(*log.columns))
    return out
