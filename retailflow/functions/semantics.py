"""Column helpers whose null, text and rounding rules differ from Spark's defaults."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(12,2)"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def r_ifelse(cond: Column, yes, no) -> Column:
    """Conditional whose unknown condition gives null, not the second value."""
    return F.when(cond.isNull(), F.lit(None)).when(cond, yes).otherwise(no)


def isin0(c: str | Column, values: Iterable) -> Column:
    """Membership test; null is not a member."""
    return F.coalesce(col(c).isin(list(values)), F.lit(False))


def rlike0(c: str | Column, pattern: str) -> Column:
    """Regex test; null does not match, so its negation keeps null rows."""
    return F.coalesce(col(c).rlike(pattern), F.lit(False))


def not_blank(c: str | Column) -> Column:
    return col(c).isNotNull() & (F.trim(col(c)) != "")


def blank_to_null(c: str | Column) -> Column:
    return F.nullif(F.trim(col(c)), F.lit(""))


def clip0(c: str | Column) -> Column:
    """Null and negative become zero."""
    return F.greatest(F.coalesce(col(c), F.lit(0)), F.lit(0))


def pmax(*cols: str | Column) -> Column:
    """Element-wise maximum that is null when any input is null."""
    cs = [col(c) for c in cols]
    return F.when(reduce(lambda a, b: a & b, [c.isNotNull() for c in cs]), F.greatest(*cs))


def row_sum(cols: Sequence[str | Column]) -> Column:
    return reduce(lambda a, b: a + b, [F.coalesce(col(c), F.lit(0)) for c in cols])


def money(c: str | Column) -> Column:
    """``"$1,234.50"`` to decimal; text that is no number becomes null."""
    return F.regexp_replace(col(c), r'[$,"\s]', "").try_cast(MONEY)


def number(c: str | Column, kind: str = "double") -> Column:
    return F.regexp_replace(col(c).cast("string"), r"[,\s]", "").try_cast(kind)


def percent(c: str | Column) -> Column:
    """``"10% Off"`` to 0.10."""
    return F.regexp_extract(col(c), r"(-?[0-9.]+)\s*%", 1).try_cast("double") / 100


def percent_text(c: str | Column, digits: int = 1) -> Column:
    return F.format_string(f"%.{digits}f%%", col(c) * 100)


def money_round(c: Column, digits: int = 2) -> Column:
    """Half-even on exact decimals."""
    return F.bround(c, digits).cast(f"decimal(14,{digits})")


def safe_div(a: str | Column, b: str | Column) -> Column:
    """Ratio of two numbers; a zero divisor gives null and the caller states its own rule."""
    return F.try_divide(col(a).cast("double"), col(b).cast("double"))


def years_ratio(stock: str | Column, demand: str | Column) -> Column:
    """stock / demand where zero demand over positive stock is endless and 0/0 is unknown."""
    stock, demand = col(stock).cast("double"), col(demand).cast("double")
    return (F.when((demand == 0) & (stock > 0), F.lit(float("inf")))
            .otherwise(F.try_divide(stock, demand)))


def trunc_cents(c: str | Column) -> Column:
    """Cut, not round, to whole cents."""
    return ((col(c).cast("decimal(18,6)") * 100).cast("bigint") / F.lit(100)).cast(MONEY)


def parse_date(c: str | Column, fmt: str) -> Column:
    """First word of a date-time text read with ``fmt``; unreadable text becomes null."""
    return F.to_date(F.try_to_timestamp(F.split(col(c), " ")[0], F.lit(fmt)))


def excel_date(c: str | Column) -> Column:
    return F.date_add(F.lit("1899-12-30").cast("date"), col(c).cast("int"))


def date_text(c: str | Column, fmt: str = "MM/dd/yyyy") -> Column:
    return F.date_format(col(c), fmt)


def band_label(c: str | Column, cap: int, prefix: str, suffix: str) -> Column:
    """Cap, cut to a whole number, shift by one and label: 1.7 -> ``prefix2suffix``."""
    return F.concat(F.lit(prefix), (F.least(col(c), F.lit(float(cap))).cast("int") + 1).cast("string"), F.lit(suffix))


def apply_rules(c: str | Column, rules: Sequence[tuple[str, object]], default=None) -> Column:
    """Regex to value where a later matching rule overrides an earlier one."""
    out = None
    for pattern, value in reversed(rules):
        test = rlike0(c, pattern)
        out = F.when(test, F.lit(value)) if out is None else out.when(test, F.lit(value))
    base = default if isinstance(default, Column) else F.lit(default)
    return base if out is None else out.otherwise(base)


def map_column(c: str | Column, table: Mapping[str, str], default: Column | None = None) -> Column:
    """Exact value mapping, no substitution order; unmapped values keep ``default`` (else themselves)."""
    pairs = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    return F.coalesce(F.try_element_at(pairs, col(c)), col(c) if default is None else default)


def substitutions(c: str | Column, pairs: Sequence[tuple[str, str]]) -> Column:
    """Texts replaced wherever they occur, one pair after the other."""
    return reduce(lambda text, pair: F.replace(text, F.lit(pair[0]), F.lit(pair[1])), pairs, col(c))


def any_field_rlike(fields: Sequence[str | Column], pattern: str) -> Column:
    """Does any field of the row match?"""
    return F.concat_ws("\x1f", *[col(f).cast("string") for f in fields]).rlike(pattern)
