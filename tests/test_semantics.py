"""One test per null, rounding or text rule that differs from Spark's default."""

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from retailflow.functions import months, semantics as s, sku


def one(spark, expr, **vals):
    kinds = {str: "string", int: "int", float: "double", bool: "boolean"}
    ddl = ", ".join(f"{k} {kinds[type(v[0] if isinstance(v, tuple) else v)] if v is not None else 'string'}"
                    for k, v in vals.items()) or "x int"
    row = tuple(None if isinstance(v, tuple) else v for v in vals.values()) or (1,)
    return spark.createDataFrame([row], ddl).select(expr.alias("r")).first()["r"]


def test_ifelse_keeps_unknown(spark):
    assert one(spark, s.r_ifelse(F.col("a") > 1, F.lit("y"), F.lit("n")), a=(1,)) is None
    assert one(spark, s.r_ifelse(F.col("a") > 1, F.lit("y"), F.lit("n")), a=2) == "y"


def test_membership_and_regex_of_null_are_false(spark):
    assert one(spark, s.isin0("a", ["x"]), a=("x",)) is False
    assert one(spark, ~s.rlike0("a", "x"), a=("x",)) is True


def test_clip_and_pmax(spark):
    assert one(spark, s.clip0("a"), a=(1,)) == 0
    assert one(spark, s.clip0("a"), a=-4) == 0
    assert one(spark, s.pmax("a", "b"), a=1, b=(2,)) is None
    assert one(spark, s.pmax("a", "b"), a=1, b=2) == 2


def test_money_and_numbers(spark):
    assert one(spark, s.money("a"), a="$1,234.50") == Decimal("1234.50")
    assert one(spark, s.money("a"), a="abc") is None
    assert one(spark, s.number("a"), a="1,234") == 1234.0
    assert one(spark, s.percent("a"), a="10% Off") == 0.1
    assert one(spark, s.trunc_cents("a"), a=1.239) == Decimal("1.23")


def test_division_rules(spark):
    assert one(spark, s.safe_div("a", "b"), a=1, b=0) is None
    assert one(spark, s.years_ratio("a", "b"), a=5, b=0) == float("inf")
    assert one(spark, s.years_ratio("a", "b"), a=0, b=0) is None


def test_half_even_on_decimals(spark):
    assert one(spark, s.money_round(F.lit(Decimal("0.125")))) == Decimal("0.12")
    assert one(spark, s.money_round(F.lit(Decimal("0.135")))) == Decimal("0.14")


def test_dates(spark):
    assert one(spark, s.parse_date("a", "dd-MMM-yyyy"), a="05-Sep-2024 10:11 AM") == date(2024, 9, 5)
    assert one(spark, s.parse_date("a", "dd-MMM-yyyy"), a="soon") is None
    assert one(spark, s.excel_date("a"), a=45292) == date(2024, 1, 1)


def test_bands_and_rules(spark):
    assert one(spark, s.band_label("a", 3, "Sold out ", " yr"), a=1.7) == "Sold out 2 yr"
    assert one(spark, s.band_label("a", 3, "Sold out ", " yr"), a=float("inf")) == "Sold out 4 yr"
    rules = [("^A", 1), ("^AB", 2), ("C$", 3)]
    assert one(spark, s.apply_rules("a", rules, 0), a="ABX") == 2
    assert one(spark, s.apply_rules("a", rules, 0), a="ABC") == 3
    assert one(spark, s.apply_rules("a", rules, 0), a="Z") == 0
    assert one(spark, s.map_column("a", {"QUEBEC": "QC"}), a="QUEBEC") == "QC"
    assert one(spark, s.map_column("a", {"QUEBEC": "QC"}), a="BC") == "BC"


def test_sku_grammar(spark):
    assert one(spark, sku.category("a"), a="AAA-BBB-2T") == "AAA"
    assert one(spark, sku.spu("a"), a="AAA-BBB-2T") == "AAA-BBB"
    assert one(spark, sku.spu("a"), a="AAA-BBB") == "AAA-BBB"
    assert one(spark, sku.spu_size("a"), a="AAA-BBB-2T-V1") == "AAA-BBB-2T"
    assert one(spark, sku.size("a"), a="AAA-BBB-2T") == "2T"
    assert one(spark, sku.size_tail("a"), a="AAA-BBB-C-2T") == "2T"
    assert one(spark, sku.base_quality("a"), a="MAAA-BBB-2T") == "AAA-BBB-2T"
    assert one(spark, sku.valid("a"), a="AAA-BBB") is False


@pytest.mark.parametrize("m", range(1, 13))
def test_month_sets_for_all_months(m):
    back, ahead = months.trailing_months(m), months.forward_months(m)
    assert len(set(back)) == 3 and m not in back and back[-1] == (m - 2) % 12 + 1
    assert len(set(ahead)) == 4 and ahead[0] == m
    assert all(1 <= x <= 12 for x in back + ahead)
    assert months.trailing_months(m, 3, include_current=True)[-1] == m


def test_month_sets_wrap():
    assert months.trailing_months(2) == [11, 12, 1]
    assert months.trailing_months(1) == [10, 11, 12]
    assert months.forward_months(11) == [11, 12, 1, 2]
    assert months.month_fraction(date(2024, 5, 31)) == 1.0


def test_row_sum_and_percent_text(spark):
    assert one(spark, s.row_sum(["a", "b", "c"]), a=1, b=(2,), c=3) == 4
    assert [one(spark, s.percent_text("a"), a=x) for x in (0.125, 1.0, 0.0)] == ["12.5%", "100.0%", "0.0%"]
    assert one(spark, s.percent("a"), a="10% Off") == 0.1 and one(spark, s.percent("a"), a="Sold out") is None


def test_substitutions_go_in_order(spark):
    assert one(spark, s.substitutions("a", [("ab", "b"), ("bb", "x")]), a="abb 中国") == "x 中国"
    assert one(spark, s.substitutions("a", [("a", "b")]), a=("x",)) is None
