"""Scans in source order: run ids, fill-down, show-once labels.

``order`` is the whole-number source position.  Rows are scanned inside blocks of positions (a hot day or file becomes many
tasks).  A block folds to its last row, which carries the state at the block's end; states combine from block to block in a window over
these few rows, and what a block inherits is joined to its rows.

The input is read once.  Rows are dealt to blocks by one exchange, from which both the scan and the fold are taken: a block's last row
travels whole, so both need the same columns and Spark reuses the exchange; the join finds the rows already
dealt and sorted.  Only block summaries meet in one task: one row per ``block_rows`` source rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from .groups import BLOCK_ROWS, block_of, join_back

_G, _B, _END = "__group", "__block", "__end"


def _inside(by: Sequence[str], order: str) -> WindowSpec:
    return Window.partitionBy(*_key(by)).orderBy(order)


def _across(by: Sequence[str]) -> WindowSpec:
    return Window.partitionBy(*_key(by)[:-1]).orderBy(_B)


def _key(by: Sequence[str]) -> list[str]:
    return [_G, _B] if by else [_B]


def _in_blocks(df: DataFrame, by: Sequence[str], order: str, block_rows: int) -> DataFrame:
    """Rows with their group (one value, never null, so that null is a group of its own) and block."""
    group = {_G: F.struct(*[F.col(f"`{c}`") for c in by])} if by else {}
    return df.withColumns(group | {_B: F.coalesce(block_of(order, block_rows), F.lit(-1))})


def _carried(rows: DataFrame, by: Sequence[str], order: str, carry: Mapping[str, Column], keep: Sequence[str]) -> DataFrame:
    """``rows`` with ``keep``, of which ``carry`` gives what each block inherits; it sees a block's last row as ``__last``."""
    rows = rows.withColumn(_END, F.lead(F.lit(True)).over(_inside(by, order)).isNull())
    ends = rows.filter(_END).select(*_key(by), F.struct(*rows.columns).alias("__last"))
    for name, value in carry.items():
        ends = ends.withColumn(name, value)
    right = ends.select(*[F.col(k).alias(f"{k}_end") for k in _key(by)], *keep)
    return rows.join(right, [F.col(k) == F.col(f"{k}_end") for k in _key(by)])


def run_id(df: DataFrame, value: str, order: str, by: Sequence[str] = (), out: str = "run_id",
           block_rows: int = BLOCK_ROWS) -> DataFrame:
    """1-based id that grows whenever ``value`` differs from the row before it (within ``by``)."""
    inside = _inside(by, order)
    rows = _in_blocks(df, by, order, block_rows).withColumn("__v", F.struct(F.col(f"`{value}`").alias("v")))  # never null: a null value is a value
    above = F.lag("__v").over(inside)
    rows = rows.withColumns({"__first": F.first("__v").over(inside), "__changed": F.when(above.isNull(), 0).otherwise((above != F.col("__v")).cast("int"))})
    rows = rows.withColumn("__run", F.sum("__changed").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    before = F.lag("__last").over(_across(by))
    joined = _carried(rows, by, order, {
        "__before": before,
        "__starts": F.when(F.col("__before").isNull() | (F.col("__before.__v") != F.col("__last.__first")), 1).otherwise(0),
        "__base": F.sum(F.col("__starts") + F.coalesce(F.col("__before.__run"), F.lit(0))).over(_across(by).rowsBetween(Window.unboundedPreceding, 0)),
    }, ["__base"])
    new = {out: F.col("__base") + F.col("__run")}
    return joined.withColumns(new).select(*[c for c in df.columns if c != out], out)


def fill_down(df: DataFrame, cols: Sequence[str], order: str, by: Sequence[str] = (),
              block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Replace nulls by the last value above them (within ``by``)."""
    so_far = _inside(by, order).rowsBetween(Window.unboundedPreceding, 0)
    rows = _in_blocks(df, by, order, block_rows).withColumns({f"__f{i}": F.last(c, ignorenulls=True).over(so_far) for i, c in enumerate(cols)})
    above = _across(by).rowsBetween(Window.unboundedPreceding, -1)
    # the last row that had a value, whole: its columns keep both readers of the exchange alike
    carry = {f"__c{i}": F.last(F.when(F.col(f"__last.__f{i}").isNotNull(), F.col("__last")), ignorenulls=True).over(above)[f"__f{i}"] for i, _ in enumerate(cols)}
    out = _carried(rows, by, order, carry, list(carry))
    return out.withColumns({c: F.coalesce(F.col(f"__f{i}"), F.col(f"__c{i}")) for i, c in enumerate(cols)}).select(*df.columns)


def blank_repeats(df: DataFrame, cols: Sequence[str], order: str) -> DataFrame:
    """Show a label on the first row (by ``order``) that carries it, blank on later ones."""
    out = df
    for c in cols:
        firsts = df.groupBy(c).agg(F.min(order).alias("__scan_first"))
        out = join_back(out, firsts, [c]).withColumn(
            c, F.when(F.col(order) == F.col("__scan_first"), F.col(c)).otherwise(F.lit(""))).drop("__scan_first")
    return out.select(*df.columns)
