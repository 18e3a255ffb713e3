"""Dead stock, seasonal clearance, event candidates, holiday discounts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import HOLIDAY_BANDS, SUMMER_MONTHS, WINTER_MONTHS
from ..functions import sku
from ..functions.semantics import MONEY, band_label, isin0, money_round, pmax, rlike0, years_ratio
from ..operators.bins import assign_by_rank, equal_count_bin, impute_median
from ..operators.lookup import anti, grid_lookup, lookup
from ..session import SharedFrames, kept
from .demand import DOUBLE, missing_label, ratio_sums, spu_stock, suggested_price, sum_where


def bulk_dead(items: DataFrame, sales: DataFrame, new_season: str, other_letter: str, k: int, min_years: float = 1,
              min_qty: int = 500) -> DataFrame:
    """Older-season SPUs holding more than ``min_years`` of sales and ``min_qty`` pieces; SPUs whose season
    names ``other_letter`` are left out."""
    old = items.filter(~rlike0("seasons", new_season) & (F.col("qty") > k) & (F.col("regular_price") > 0))
    spus = old.groupBy("spu").agg(F.min_by("seasons", "sku").alias("seasons"), F.sum("qty").alias("qty"))
    sold = sales.groupBy(sku.spu("adjust_msku").alias("spu")).agg(
        sum_where(F.col("month").isin(list(SUMMER_MONTHS)), "qty").cast(DOUBLE).alias("sales_ss"),
        sum_where(F.col("month").isin(list(WINTER_MONTHS)), "qty").cast(DOUBLE).alias("sales_fw"))
    out = lookup(spus, sold, "spu", ["sales_ss", "sales_fw"], unique="grouped", defaults={"sales_ss": 0.0, "sales_fw": 0.0})
    out = out.withColumn("time_yrs", years_ratio("qty", F.col("sales_ss") + F.col("sales_fw")))
    return out.filter(~rlike0("seasons", other_letter) & (F.col("time_yrs") > min_years) & (F.col("qty") > min_qty))


def limited_sizes(items: DataFrame, new_season: str, k: int) -> DataFrame:
    """Older SPUs holding fewer sizes than the fullest SPU of their category."""
    sizes = items.groupBy("spu").agg(F.count(F.lit(1)).alias("n"))
    most = sizes.groupBy(sku.category("spu").alias("cat")).agg(F.max("n").alias("n_all"))
    left = items.filter(~rlike0("seasons", new_season) & (F.col("qty") > k) & (F.col("regular_price") > 0))
    out = left.groupBy("spu").agg(F.count(F.lit(1)).alias("n")).withColumn("cat", sku.category("spu"))
    return lookup(out, most, "cat", ["n_all"], unique="grouped").filter(F.col("n") != F.col("n_all"))


def event_leftovers(items: DataFrame, sales: DataFrame, listed: DataFrame, sizes: Mapping[str, int], new_season: str,
                    old_seasons: Sequence[str], k: int, web_channel: str, market_pattern: str) -> DataFrame:
    """Further event items of the categories in ``sizes``: goods of none of ``old_seasons``, and goods not of the new
    season whose SPU no longer has all the category's sizes; with this year's sales per channel."""
    pool = items.filter(isin0("cat", list(sizes)) & (F.col("qty") > k))
    full = F.create_map(*[F.lit(x) for kv in sizes.items() for x in kv])
    left = pool.groupBy("spu").agg(F.count(F.lit(1)).alias("n"))
    short = left.filter(F.col("n") != F.try_element_at(full, sku.category("spu")))
    out = lookup(anti(pool, listed, "sku"), short, "spu", {}, unique="grouped", flag="__short")
    none_of = ~rlike0("seasons", "|".join(old_seasons))
    out = out.filter(none_of | (F.col("__short") & ~rlike0("seasons", new_season)))
    on = F.col("sales_channel")
    sold = sales.groupBy("adjust_msku").agg(F.sum("qty").alias("total"), F.sum(F.when(on == web_channel, F.col("qty"))).alias("total_web"),
                                            F.sum(F.when(rlike0("sales_channel", market_pattern), F.col("qty"))).alias("total_market"))
    out = lookup(out, sold, {"sku": "adjust_msku"}, ["total", "total_web", "total_market"], unique="grouped")
    return out.withColumn("time_yrs", years_ratio("qty", "total")).select(
        "sku", "seasons", "regular_price", "qty", "time_yrs", "total", "total_web", "total_market")


def _priced(df: DataFrame, suggest: Column) -> DataFrame:
    out = df.withColumn("suggest_discount", pmax(suggest, F.col("discount")))
    return out.withColumn("suggest_price", money_round(
        (F.lit(Decimal(1)) - F.col("suggest_discount").cast("decimal(6,4)")) * F.col("regular_price")).cast(MONEY))


def winter_frame(items: DataFrame, inv: DataFrame, sales: DataFrame, ratio: DataFrame, growth: DataFrame, k: int,
                 season_letter: str = "F", peak: Sequence[int] = (9, 10, 11, 12), half: Sequence[int] = (1, 2, 3, 4, 5, 6),
                 shared: SharedFrames | None = None) -> DataFrame:
    """Season items with stock and yearly demand = max(peak sales / peak share, actual year).

    Shares of categories without a growth figure are unknown and take the median over the season's items.
    """
    sold = sales.groupBy(sku.spu("adjust_msku").alias("spu")).agg(
        sum_where(F.col("month").isin(list(peak)), "qty").cast(DOUBLE).alias("sales_peak"), F.sum("qty").cast(DOUBLE).alias("sales_yr_actual"))
    shares = lookup(ratio_sums(ratio, r_peak=peak, r_half=half), growth, "category", ["growth"], unique=True)
    shares = shares.filter(F.col("growth").isNotNull())
    out = items.filter(rlike0("seasons", season_letter) & (F.col("qty") > k) & (F.col("regular_price") > 0))
    out = lookup(out, spu_stock(inv), "spu", ["qty_spu"], unique="grouped")
    out = lookup(out, shares, {"cat": "category"}, ["r_peak", "r_half"], unique=True)
    out = lookup(out, sold, "spu", ["sales_peak", "sales_yr_actual"], unique="grouped")
    out = impute_median(kept(out, shared, "winter"), ["r_peak", "r_half"])
    year = pmax(F.try_divide(F.col("sales_peak"), F.col("r_peak")), F.col("sales_yr_actual"))
    return out.withColumn("sales_yr", year).withColumn("sales_half", F.col("sales_yr") * F.col("r_half"))


def clearance_no_sales(frame: DataFrame) -> DataFrame:
    """Season items whose SPU has no sales at all: no yearly demand, so no discount rule applies to them."""
    return frame.filter(F.col("sales_yr").isNull())


def clearance_carry_over(frame: DataFrame, new_season: str, shared: SharedFrames | None = None) -> DataFrame:
    """Goods of the coming season: small leftovers after the half year 5%, else by quartile of leftover years."""
    out = frame.filter(F.col("sales_yr").isNotNull() & rlike0("seasons", new_season))
    stock = F.col("qty_spu").cast(DOUBLE)
    out = out.withColumn("qty_left", F.when(stock > F.col("sales_half"), (stock - F.col("sales_half")).cast("int")).otherwise(0))
    out = out.withColumn("times", F.bround(years_ratio("qty_left", "sales_half"), 1))
    out = kept(out, shared, "carry_over")
    small = F.coalesce((F.col("times") <= 0.5) | (F.col("qty_left") <= 20), F.lit(False))
    out = equal_count_bin(out, "times", 4, where=~small, out="bin")
    return _priced(out, F.when(small, 0.05).otherwise(F.col("bin") * 5 / 100 + 0.05))


def clearance_discontinued(frame: DataFrame, missing: DataFrame, new_season: str, last_season: str, size_percent: float,
                           shared: SharedFrames | None = None) -> DataFrame:
    """Goods that do not come back: up to a year of stock in full sizes 5%, last season in full sizes by quartile
    from 10%, the rest by quintile from 30%."""
    out = frame.filter(F.col("sales_yr").isNotNull() & ~rlike0("seasons", new_season))
    out = lookup(out, missing, "spu", {"percent": "missing_share"}, unique=True)
    out = kept(out.withColumn("times", F.bround(years_ratio("qty_spu", "sales_yr"), 1)), shared, "discontinued")
    full = F.coalesce(F.col("missing_share") < size_percent, F.lit(False))
    small = F.coalesce(F.col("times") <= 1, F.lit(False)) & full
    recent = ~small & full & rlike0("seasons", last_season)
    out = equal_count_bin(out, "times", 4, where=recent, out="bin4")
    out = equal_count_bin(out, "times", 5, where=~small & ~recent, out="bin5")
    return _priced(out, F.when(small, 0.05).when(recent, F.col("bin4") * 5 / 100 + 0.05).otherwise(F.col("bin5") * 5 / 100 + 0.25))


def clearance_grid(framed: DataFrame, grid: DataFrame, season_letter: str, this_season: str, k: int) -> DataFrame:
    """Season clearance by the discount grid on total years of stock; well-selling full-size goods of this
    season are left out."""
    out = framed.filter(rlike0("seasons", season_letter) & (F.col("qty") > k) & (F.col("regular_price") > 0))
    out = out.withColumn("time", years_ratio("qty_spu", "sales_1yr"))
    out = out.withColumns({"time_yrs": band_label(F.least("time", F.lit(3.0)), 3, "Sold out ", " yr"),
                           "size_percent_missing": missing_label(F.col("missing_share"))})
    out = out.withColumn("time_yrs", F.when(F.col("time").isNotNull(), F.col("time_yrs")))
    out = grid_lookup(out, grid, "time_yrs", "size_percent_missing", "discount", "suggest_discount")
    out = out.withColumn("suggest_price", suggested_price(F.col("suggest_discount"), F.col("regular_price")))
    keep = (F.coalesce(F.col("time") > 1, F.lit(False)) | (F.col("size_percent_missing") != "Sizes missing < 50%")
            | ~rlike0("seasons", this_season))
    return out.filter(keep).select("sku", "seasons", "cat", "spu", "regular_price", "qty", "time", "time_yrs",
                                   "size_percent_missing", "suggest_discount", "suggest_price")


def event_candidates(framed: DataFrame, new_season: str, k: int, min_years: float, strict: bool = True,
                     half_price: bool = False, categories: Sequence[str] | None = None, listed: DataFrame | None = None) -> DataFrame:
    """Older items with more than (``strict``) or at least ``min_years`` of stock, not on the list already."""
    out = framed.filter(~rlike0("seasons", new_season) & (F.col("qty") > k) & (F.col("regular_price") > 0))
    if categories is not None:
        out = out.filter(isin0("cat", categories))
    if listed is not None:
        out = anti(out, listed, "sku")
    out = out.withColumn("time_yrs", F.bround("time_yr", 1))
    out = out.filter(F.col("time_yrs") > min_years if strict else F.col("time_yrs") >= min_years)
    cols = ["sku", "seasons", "regular_price", "discount", "qty", "time_yrs"]
    if half_price:
        out = out.withColumn("wholesale_price", money_round(F.col("regular_price") / F.lit(Decimal(2))).cast(MONEY))
        cols.append("wholesale_price")
    return out.select(*cols)


def holiday_discounts(framed: DataFrame, k: int, winter: str, categories: Sequence[str] | None = None,
                      late_categories: Sequence[str] = (), bumps: Mapping[str, float] | None = None,
                      bands: Sequence[tuple[int, float]] = HOLIDAY_BANDS, shared: SharedFrames | None = None) -> DataFrame:
    """Holiday sale: season rule first, then bands by rank (smallest rule discount, most years), category bumps,
    never below the running discount."""
    out = framed.filter((F.col("qty") > k) & (F.col("regular_price") > 0))
    if categories is not None:
        out = out.filter(isin0("cat", categories))
    out = out.withColumn("time_yrs", F.coalesce(F.bround("time_yr", 2), F.lit(0.0)))
    rule = F.when(rlike0("seasons", winter), F.when(F.col("time_yrs") > 4, 0.2).otherwise(0.1)).otherwise(0.0)
    out = out.withColumn("__rule", F.when(isin0("cat", late_categories), 0.2).otherwise(rule))
    out = assign_by_rank(kept(out, shared, "holiday"), ["sku"], ["__rule", "-time_yrs"], bands, F.col("__rule"), "__band")
    more = F.lit(Decimal("0"))
    for cat, plus in (bumps or {}).items():
        more = F.when(F.col("cat") == cat, F.lit(Decimal(str(plus)))).otherwise(more)
    out = out.withColumn("__d", (F.col("__band").cast("decimal(4,2)") + more.cast("decimal(4,2)")).cast(DOUBLE))
    out = out.withColumn("suggest_discount", F.when(F.col("__d") > F.col("discount"), F.col("__d")).otherwise(F.col("discount")))
    price = money_round(F.col("regular_price") * (F.lit(Decimal(1)) - F.col("suggest_discount").cast("decimal(6,4)")))
    return out.withColumn("sale_price", price.cast(MONEY)).select(
        "sku", "seasons", "cat", "spu", "regular_price", "discount", "qty", "time_yrs", "suggest_discount", "sale_price")
