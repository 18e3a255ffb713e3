"""Rule tables: a regex per row, the first matching rule decides.

Rules and texts both stay rows.  A pattern can only match a text that holds its required literal, so the rule table gets an
inverted index: a row per rule and alternative with one n-gram of its longest literal, the n-gram that the fewest rules have.  Each
distinct text probes the index with its own n-grams by an equi-join and is tried against the rules it meets there.  Patterns without a
literal (or whose syntax is not analysed: groups, flags, numbered characters) have the empty n-gram, which every text
probes; it is spread over ``SPREAD`` keys.  The first rule of a text is a minimum, partly taken before its shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .lookup import lookup

GRAM = 3
SPREAD = 32
_CUT = "\x00"  # stands where a pattern's literal run ends


def literals(pattern: Column) -> Column:
    """Longest literal of each alternative of a pattern; null where one has none of ``GRAM`` characters, or is not analysed.

    Escapes, classes, wildcards, anchors and whatever may be absent or repeated end a run: runs may come out shorter than
    they are, never longer.
    """
    text = pattern
    for part, by in ((r"\\[dwsDWSbB.+*?()\[\]{}|^$/\-]", _CUT),  # one character or place, whatever it is
                     (r"\[\^?[^\[\]\\&]+\]", _CUT),  # a plain class
                     (r"[\s\S]\{[0-9,]*\}[?+]?|[\s\S][*?][?+]?", _CUT),  # may be absent
                     (r"\+[?+]?|[.^$]", _CUT)):
        text = F.regexp_replace(text, part, by)
    longest = F.transform(F.split(text, r"\|"), lambda a: F.array_max(F.transform(
        F.split(a, _CUT), lambda run: F.struct(F.length(run).alias("n"), run.alias("run"))))["run"])
    plain = ~F.rlike(text, F.lit(r"[\\()\[\]{}*+?]"))
    return F.when(plain & F.forall(longest, lambda l: F.length(l) >= GRAM), longest)


def _grams(text: Column) -> Column:
    """Distinct n-grams of a text (none of a shorter one)."""
    places = F.when(F.length(text) >= GRAM, F.sequence(F.lit(1), F.length(text) - (GRAM - 1))).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(places, lambda i: F.substr(text, i, F.lit(GRAM))))


def _index(rules: DataFrame, pattern: str, order: str) -> DataFrame:
    """(gram, spread, order, pattern): where each rule is found."""
    known = rules.filter(F.col(pattern).isNotNull()).select(F.col(order).alias("__o"), F.col(pattern).alias("__p"), literals(F.col(pattern)).alias("__l"))
    runs = known.select("__o", "__p", F.posexplode_outer("__l").alias("__a", "__run"))
    grams = runs.select("__o", "__p", "__a", F.explode_outer(F.when(F.col("__run").isNotNull(), _grams(F.col("__run")))).alias("__gram"))
    often = grams.groupBy("__gram").agg(F.count("*").alias("__n"))
    rarest = F.min(F.struct("__n", "__gram"))["__gram"]
    found = grams.join(often, "__gram", "left").groupBy("__o", "__a").agg(rarest.alias("__gram"), F.any_value("__p").alias("__p"))
    everywhere = F.sequence(F.lit(0), F.lit(SPREAD - 1))
    spread = F.explode(F.when(F.col("__gram").isNull(), everywhere).otherwise(F.array(F.lit(0))))
    return found.select(F.coalesce("__gram", F.lit("")).alias("__gram"), spread.alias("__spread"), "__o", "__p")


def regex_lookup(df: DataFrame, rules: DataFrame, col: str, pattern: str, order: str, cols: Sequence[str]) -> DataFrame:
    """Attach ``cols`` of the first rule (by unique ``order``) whose ``pattern`` matches ``col``; else null."""
    texts = df.select(F.col(col).alias("__t")).filter(F.col(col).isNotNull()).distinct()
    probe = F.explode(F.concat(_grams(F.col("__t")), F.array(F.lit(""))))
    probes = texts.select("__t", probe.alias("__gram")).withColumn(
        "__spread", F.when(F.col("__gram") == "", F.pmod(F.xxhash64("__t"), F.lit(SPREAD))).otherwise(0).cast("int"))
    index = _index(rules, pattern, order)
    met = probes.join(index, (probes["__gram"] == index["__gram"]) & (probes["__spread"] == index["__spread"]) & F.regexp_like("__t", F.col("__p")))
    first = met.groupBy("__t").agg(F.min("__o").alias("__o"))
    hits = lookup(first, rules, {"__o": order}, {c: f"__r{i}" for i, c in enumerate(cols)}, unique=True)
    return lookup(df, hits.select(F.col("__t").alias(col), *[F.col(f"__r{i}").alias(c) for i, c in enumerate(cols)]), col, list(cols), unique="grouped")


def matches_any(df: DataFrame, rules: DataFrame, col: str, pattern: str, order: str, flag: str) -> DataFrame:
    """Does the text match any rule of the table?"""
    out = regex_lookup(df, rules.withColumn("__yes", F.lit(True)), col, pattern, order, ["__yes"])
    return out.withColumn(flag, F.coalesce(F.col("__yes"), F.lit(False))).drop("__yes")
