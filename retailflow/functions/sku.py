"""SKU grammar: CATEGORY-PRINT-SIZE, ``M`` prefix for second quality, ``-V1`` for a version."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .semantics import col, rlike0

_WORD = "[A-Za-z0-9_]+"


def category(c: str | Column) -> Column:
    return F.regexp_replace(col(c), "-.*", "")


def _parts(c: str | Column, n: int) -> Column:
    head = "^(" + "-".join([_WORD] * n) + ")"
    return F.regexp_replace(col(c), head + ".*", "$1")


def spu(c: str | Column) -> Column:
    """First two parts; text of another shape passes through."""
    return F.regexp_replace(col(c), f"^({_WORD}-{_WORD})-.*", "$1")


def spu_size(c: str | Column) -> Column:
    return _parts(c, 3)


def size(c: str | Column) -> Column:
    """What follows the first two parts."""
    return F.regexp_replace(col(c), f"^{_WORD}-{_WORD}-", "")


def size_tail(c: str | Column) -> Column:
    """What follows the last dash."""
    return F.regexp_replace(col(c), ".*-", "")


def base_quality(c: str | Column) -> Column:
    """First-quality SKU behind a second-quality copy."""
    return F.regexp_replace(col(c), "^M", "")


def unversioned(c: str | Column) -> Column:
    return F.regexp_replace(col(c), "-V1", "")


def valid(c: str | Column, dashes: int = 2) -> Column:
    return rlike0(c, "-.*" * dashes)
