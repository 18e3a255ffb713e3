"""Registry of queries and their SQL, and small helpers both sides use."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import apply_settings
from .standins import STANDINS, Inputs, ctes

AS_OF = date(2001, 3, 15)
CHANNELS = ("Amazon.com", "Amazon.ca", "WEB")


@dataclass(frozen=True)
class Query:
    build: Callable[[Inputs], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None):
    """Register a query; ``sql`` is a SELECT, or a WITH whose tables continue the job inputs it names."""

    def add(fn: Callable[[Inputs], DataFrame]):
        assert name not in QUERIES, name
        QUERIES[name] = Query(fn, full_sql(sql) if sql else None)
        return fn

    return add


def full_sql(body: str) -> str:
    body = body.strip()
    names = [n for n in STANDINS if re.search(rf"\b{n}\b", body)]
    if not names:
        return body
    if body.upper().startswith("WITH"):
        return ctes(names) + ",\n" + body[4:].lstrip()
    return ctes(names) + "\n" + body


def run(q: Query) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: plain(q.build(Inputs(apply_settings(spark), sf_dir)))


def plain(df: DataFrame) -> DataFrame:
    """Result in types every engine shows alike: decimals as doubles, dates as text, booleans as 0/1."""
    out = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DecimalType):
            out[f.name] = F.col(f.name).cast("double")
        elif isinstance(f.dataType, T.DateType):
            out[f.name] = F.date_format(f.name, "yyyy-MM-dd")
        elif isinstance(f.dataType, T.BooleanType):
            out[f.name] = F.col(f.name).cast("int")
    return df.withColumns(out) if out else df


# SQL text shared by several oracles.

def cat(c: str) -> str:
    return f"regexp_replace({c}, '-.*', '')"


def spu(c: str) -> str:
    return rf"regexp_replace({c}, '^([A-Za-z0-9_]+-[A-Za-z0-9_]+)-.*', '\1')"


def renamed(key: str, keep: Column, prefix: str = "Z") -> Column:
    """A key that others miss where ``keep`` does not hold: the rows stay."""
    return F.when(keep, F.col(key)).otherwise(F.concat(F.lit(prefix), F.col(key)))


def half_even(num: str, den: str) -> str:
    """Whole quotient rounded half to even, for whole non-negative operands."""
    q, r = f"(({num}) // ({den}))", f"(({num}) % ({den}))"
    return f"({q} + CASE WHEN 2 * {r} > ({den}) OR (2 * {r} = ({den}) AND {q} % 2 = 1) THEN 1 ELSE 0 END)"


def cents(c: str) -> str:
    return f"cast({c} * 100 as hugeint)"


def years(stock: str, demand: str) -> str:
    return (f"(CASE WHEN {demand} = 0 AND {stock} > 0 THEN 'infinity'::DOUBLE WHEN {demand} = 0 THEN NULL "
            f"ELSE cast({stock} as double) / cast({demand} as double) END)")


def values(rows, names: str) -> str:
    """Constant table for an oracle."""
    def lit(x):
        return "NULL" if x is None else ("'" + x.replace("'", "''") + "'" if isinstance(x, str) else str(x))
    return "(VALUES " + ", ".join("(" + ", ".join(lit(x) for x in r) + ")" for r in rows) + f") AS {names}"
