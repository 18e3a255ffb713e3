"""Group totals beside the rows, joined text, subtotals.

A window over a group moves every row of a hot group into one task.  Where the result needs only a total
per group, the total is aggregated first (partial sums on the map side) and joined back.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_ROWS = 1 << 20


def block_of(order: str, block_rows: int) -> Column:
    """Block of consecutive source positions, by whole-number division."""
    return F.expr(f"`{order}` div {block_rows}")


def join_back(df: DataFrame, agg: DataFrame, by: Sequence[str]) -> DataFrame:
    """Attach one row per group to the rows of the group; null is a group of its own."""
    right = agg.select(*[F.col(f"`{k}`").alias(f"__g_{k}") for k in by],
                       *[F.col(f"`{c}`") for c in agg.columns if c not in by])
    cond = [F.col(f"`{k}`").eqNullSafe(F.col(f"`__g_{k}`")) for k in by]
    return df.join(right, cond, "left").drop(*[f"__g_{k}" for k in by])


def with_group_total(df: DataFrame, by: str | Sequence[str], totals: Mapping[str, Column]) -> DataFrame:
    by = [by] if isinstance(by, str) else list(by)
    agg = df.groupBy(*by).agg(*[v.alias(k) for k, v in totals.items()])
    return join_back(df, agg, by)


def share_of(df: DataFrame, col: str, by: str | Sequence[str], out: str) -> DataFrame:
    """col / group sum of col; null for a group summing to zero."""
    t = with_group_total(df, by, {"__total": F.sum(col)})
    return t.withColumn(out, F.try_divide(F.col(col).cast("double"), F.col("__total").cast("double"))).drop("__total")


def weighted_count(df: DataFrame, key: str | Sequence[str], weight: str, out: str = "n") -> DataFrame:
    key = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*key).agg(F.sum(weight).alias(out))


def collapse(df: DataFrame, by: Sequence[str], order: str | Sequence[str], sep: str, texts: Mapping[str, str],
             sums: Mapping[str, str] | None = None, mins: Mapping[str, str] | None = None,
             maxs: Mapping[str, str] | None = None, block_rows: int = BLOCK_ROWS, fan: int = 1024) -> DataFrame:
    """One row per group: joined text in source order (nulls skipped), sums, minima, maxima.

    ``order`` starts with the whole-number source position; further columns break ties.  A group is joined
    per block of positions, then per ``fan`` blocks, then whole, so no task holds more than a block of rows
    of a hot group before the last level, which holds the group's text, the result itself.
    """
    by, order = list(by), [order] if isinstance(order, str) else list(order)
    q = sep.replace("'", "\\'")

    def level(rows: DataFrame, key: Sequence, named: bool, sort: str) -> DataFrame:
        src = (lambda m: [(o, o) for o in (m or {}).values()]) if named else (lambda m: list((m or {}).items()))
        return rows.groupBy(*by, *key).agg(
            *[F.expr(f"listagg(`{c}`, '{q}') within group (order by {sort})").alias(o) for c, o in src(texts)],
            *[F.sum(c).alias(o) for c, o in src(sums)], *[F.min(c).alias(o) for c, o in src(mins)],
            *[F.max(c).alias(o) for c, o in src(maxs)])

    first = f"struct({', '.join(f'`{o}`' for o in order)})" if len(order) > 1 else f"`{order[0]}`"
    out = level(df, [block_of(order[0], block_rows).alias("__block")], False, first)
    out = level(out, [block_of("__block", fan).alias("__blocks")], True, "__block")
    return level(out, [], True, "__blocks")


def join_text(df: DataFrame, by: Sequence[str], cols: Mapping[str, str], sep: str, order: str,
              block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Text of a group in source order, nulls skipped."""
    return collapse(df, by, order, sep, cols, block_rows=block_rows)


def with_subtotals(df: DataFrame, key: Sequence[str], detail: Sequence[str], sums: Sequence[str],
                   level: str = "level") -> DataFrame:
    """Detail rows plus one subtotal row per key (detail columns null)."""
    rows = df.groupBy(*key, *detail).agg(*[F.sum(s).alias(s) for s in sums]).withColumn(level, F.lit("detail"))
    sub = rows.groupBy(*key).agg(*[F.sum(s).alias(s) for s in sums]).withColumn(level, F.lit("subtotal"))
    return rows.unionByName(sub, allowMissingColumns=True)


def total_row(df: DataFrame, pos: str) -> DataFrame:
    """The last row of a table, where the export keeps its totals."""
    cols = [c for c in df.columns if c != pos]
    return df.agg(F.max_by(F.struct(*cols), F.col(pos)).alias("__t")).select("__t.*")
