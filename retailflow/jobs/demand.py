"""Seasonality, years of stock, deal suggestions, shortfalls.

Month data stays long (channel, sku, month, qty).  Ratios summed over months are taken as decimals where the
caller provides decimals, so that sums do not depend on the order of addition.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import CHANNEL_MARKERS
from ..functions import sku
from ..functions.months import forward_months, in_season_letter, month_fraction, off_season_letter, trailing_months
from ..functions.semantics import MONEY, band_label, isin0, money_round, r_ifelse, rlike0, row_sum, years_ratio
from ..operators.groups import with_group_total
from ..operators.keys import first_per_key, source_order
from ..operators.lookup import grid_lookup, lookup, semi
from ..session import SharedFrames, kept

DOUBLE = "double"


def sum_where(cond: Column, value: str) -> Column:
    return F.sum(F.when(cond, F.col(value)).otherwise(0))


def last12(sales: DataFrame, as_of: date, include_current: bool = False) -> DataFrame:
    """Quantity per channel, SKU and calendar month over the 12 months before ``as_of``'s month.

    ``include_current`` takes the running month in (its quantity scaled up by the passed share of a 31-day
    month) and drops the same month of the year before.
    """
    first = as_of.year * 12 + as_of.month - 12 + (1 if include_current else 0)
    index = F.col("year") * 12 + F.col("month")
    kept = sales.filter((index >= first) & (index < first + 12) & ~isin0("sales_channel", CHANNEL_MARKERS))
    out = kept.groupBy("sales_channel", "adjust_msku", "month").agg(F.sum(F.coalesce("qty", F.lit(0))).alias("qty"))
    if include_current:
        scaled = F.bround(F.col("qty").cast(DOUBLE) / F.lit(month_fraction(as_of)), 0)
        out = out.withColumn("qty", F.when(F.col("month") == as_of.month, scaled).otherwise(F.col("qty").cast(DOUBLE)))
    return out


def refresh_month_ratio(cat_sales: DataFrame, last_ratio: DataFrame, as_of: date, keep_until: int = 2,
                        include_current: bool = False) -> DataFrame:
    """Month shares per category: elapsed months follow this year's sales, later months stay.

    The elapsed part keeps last year's total share; a category without sales this year keeps last year's
    shares; categories without a last-year row are dropped.  Up to month ``keep_until`` nothing changes.
    """
    last = last_ratio.select("category", "month", F.col("ratio"))
    if as_of.month <= keep_until:
        return last.withColumn("ratio", F.col("ratio").cast(DOUBLE))
    elapsed = F.col("month") <= as_of.month if include_current else F.col("month") < as_of.month
    sold = cat_sales.filter(elapsed).groupBy("category", "month").agg(F.sum("qty").alias("__qty"))
    total = sold.groupBy("category").agg(F.sum("__qty").alias("__total"))
    share = last.groupBy("category").agg(sum_where(elapsed, "ratio").alias("__share"))
    out = semi(last, cat_sales.select("category").distinct(), "category")
    out = lookup(out, sold, ["category", "month"], ["__qty"], unique="grouped")
    out = lookup(lookup(out, total, "category", ["__total"], unique=True), share, "category", ["__share"], unique=True)
    d = lambda c: F.col(c).cast(DOUBLE)
    new = F.try_divide(F.coalesce(d("__qty"), F.lit(0.0)), d("__total")) * d("__share")
    use = elapsed & (F.coalesce(d("__total"), F.lit(0.0)) != 0)
    return out.select("category", "month", F.when(use, new).otherwise(d("ratio")).alias("ratio"))


def month_in(months: Sequence[int], category: Column, special: Mapping[str, Sequence[int]] | None = None) -> Column:
    """Is the row's month in the set?  ``special`` gives single categories a set of their own."""
    test = F.col("month").isin(list(months))
    for cat, ms in (special or {}).items():
        test = F.when(category == cat, F.col("month").isin(list(ms))).otherwise(test)
    return test


def ratio_sums(ratio: DataFrame, special: Mapping[str, Sequence[int]] | None = None, **months: Sequence[int]) -> DataFrame:
    """One row per category with the summed shares of each named month set."""
    return ratio.groupBy("category").agg(
        *[sum_where(month_in(ms, F.col("category"), special), "ratio").cast(DOUBLE).alias(name) for name, ms in months.items()])


def spu_stock(inv: DataFrame) -> DataFrame:
    """Stock per SPU: total, warehouse, the rest."""
    out = inv.groupBy(sku.spu("adjust_msku").alias("spu")).agg(
        F.sum(F.coalesce("inv_total_end_wk", F.lit(0))).alias("qty_spu"),
        F.sum(F.coalesce("inv_warehouse", F.lit(0))).alias("qty_wh"))
    return out.withColumn("qty_amz", F.col("qty_spu") - F.col("qty_wh"))


def erp_spu_stock(items: DataFrame) -> DataFrame:
    """Stock per SPU by the ERP's items of one warehouse."""
    return items.groupBy(sku.spu("name").alias("spu")).agg(F.sum("warehouse_available").alias("qty_wh"))


def spu_sales(sales: DataFrame, months: Sequence[int], web_channel: str, market_pattern: str,
              special: Mapping[str, Sequence[int]] | None = None) -> DataFrame:
    """Sales per SPU in one pass: trailing months over all channels and on the web, 12 months on marketplaces.

    A figure is null where the SPU has no row in the channel at all.
    """
    recent = month_in(months, sku.category("adjust_msku"), special)
    web, market = F.col("sales_channel") == web_channel, rlike0("sales_channel", market_pattern)

    def total(rows: Column, value: Column) -> Column:
        return F.sum(F.when(rows, value))

    qty = F.col("qty")
    now = F.when(recent, qty).otherwise(0)
    return sales.groupBy(sku.spu("adjust_msku").alias("spu")).agg(
        F.sum(now).alias("t_last3m"), total(web, now).alias("t_last3m_web"), total(market, qty).alias("t_last12m_amz"))


def size_missing(erp: DataFrame, k: int) -> DataFrame:
    """Share of an SPU's sizes with no more than ``k`` pieces, floored at 0.

    An SPU with no item above ``k`` has no row.
    """
    items = erp.withColumns({"spu": sku.spu("name"), "__size": sku.spu_size("name")})
    out = items.groupBy("spu").agg(
        F.count_distinct("__size").alias("sizes"), F.count_if(F.col("warehouse_available") > k).alias("in_stock"))
    share = F.when(F.col("sizes") < F.col("in_stock"), 0.0).otherwise((F.col("sizes") - F.col("in_stock")) / F.col("sizes"))
    return out.filter(F.col("in_stock") > 0).withColumn("percent", share)


def catalog_frame(web: DataFrame, erp: DataFrame, master: DataFrame, warehouse: str) -> DataFrame:
    """Web items the ERP knows, with the warehouse's stock, season (by SKU, else by adjusted SKU), category, SPU
    and running discount.  Of several web or master rows of one SKU the first counts."""
    web = first_per_key(web, "sku", "id")
    here = F.when(F.col("inventory_warehouse") == warehouse, F.col("warehouse_available"))
    known = erp.groupBy("name").agg(F.max(here).alias("qty"))
    out = lookup(web, known, {"sku": "name"}, ["qty"], unique="grouped", flag="__known").filter("__known")
    out = lookup(out, master, {"sku": "msku"}, {"category_sku": "cat", "seasons_sku": "__own"}, order=source_order(master), flag="__listed")
    others = master.filter(F.col("adjust_sku").isNotNull()).groupBy("adjust_sku").agg(F.min_by("seasons_sku", "msku").alias("__other"))
    out = lookup(out, others, {"sku": "adjust_sku"}, ["__other"], unique="grouped")
    out = out.withColumn("seasons", F.when(F.col("__listed"), F.col("__own")).otherwise(F.col("__other")))
    off = F.try_divide(F.col("regular_price").cast(DOUBLE) - F.col("sale_price").cast(DOUBLE), F.col("regular_price").cast(DOUBLE))
    return out.select("id", "sku", "name", "seasons", "cat", sku.spu("sku").alias("spu"), "regular_price",
                      F.when(F.col("sale_price").isNull(), 0.0).otherwise(off).alias("discount"),
                      F.coalesce("qty", F.lit(0)).alias("qty"))


def with_years(items: DataFrame, inv: DataFrame, sales: DataFrame, ratio: DataFrame, missing: DataFrame, month: int,
               web_channel: str, market_pattern: str, trailing: int = 3, include_current: bool = False,
               special: Mapping[str, Sequence[int]] | None = None, warehouse: DataFrame | None = None) -> DataFrame:
    """Attach stock, yearly demand and years of stock per SPU; SPUs without stock rows are dropped.

    Yearly demand = trailing sales / trailing share of the year.  Where stock outside the warehouse covers a
    year of marketplace sales the web has to sell the warehouse stock alone, else everything sells everywhere.
    ``warehouse`` (spu, qty_wh) takes the place of the warehouse stock of ``inv``.
    """
    months = trailing_months(month, trailing, include_current)
    stock = spu_stock(inv)
    spus = lookup(stock, spu_sales(sales, months, web_channel, market_pattern, special), "spu", ["t_last3m", "t_last3m_web", "t_last12m_amz"], unique="grouped")
    if warehouse is not None:
        spus = lookup(spus, warehouse, "spu", ["qty_wh"], unique=True)
    spus = lookup(spus, missing, "spu", {"percent": "missing_share"}, unique=True)
    out = lookup(items, spus, "spu", [c for c in spus.columns if c != "spu"], unique=True, flag="__known").filter("__known").drop("__known")
    out = lookup(out, ratio_sums(ratio, special, r3=months), {"cat": "category"}, ["r3"], unique="grouped")
    year = years_ratio("t_last3m", "r3")
    year_web = years_ratio("t_last3m_web", "r3")
    out = out.withColumns({"sales_1yr": year, "sales_1yr_web": year_web})
    return out.withColumn("time_yr", r_ifelse(
        F.col("qty_amz") >= F.col("t_last12m_amz"), years_ratio("qty_wh", "sales_1yr_web"), years_ratio("qty_spu", "sales_1yr")))


def missing_label(share: Column, null_is_low: bool = True) -> Column:
    """Decade of the missing share; less than half pooled."""
    known = F.when(share < 0.5, 0.0).otherwise(share)
    decade = (known * 10).cast("int") * 10
    label = F.when(decade == 0, "Sizes missing < 50%").otherwise(F.concat(F.lit("Sizes missing "), decade.cast("string"), F.lit("%")))
    return F.when(share.isNull(), "Sizes missing < 50%" if null_is_low else F.lit(None)).otherwise(label)


def years_of_stock(framed: DataFrame, shared: SharedFrames | None = None) -> DataFrame:
    """Overstock report: years of stock to one decimal for SPUs with warehouse stock on the web."""
    out = framed.filter(F.col("regular_price") > 0)
    out = out.select("sku", "seasons", "cat", "spu", "regular_price", "discount", "qty", "time_yr", "missing_share")
    out = with_group_total(kept(out, shared, "years_of_stock"), "spu", {"qty_on_web": F.sum("qty")}).filter(F.col("qty_on_web") > 0)
    return out.select("sku", "seasons", "cat", "spu", "regular_price", "discount", "qty",
                      F.bround("time_yr", 1).alias("time_yrs"), missing_label(F.col("missing_share"), False).alias("size_percent_missing"))


def suggested_price(discount: Column, regular: Column) -> Column:
    return money_round((F.lit(1).cast("decimal(1,0)") - discount.cast("decimal(4,2)")) * regular).cast(MONEY)


def deal_bands(framed: DataFrame, grid: DataFrame) -> DataFrame:
    """Discount of the grid cell (years band, missing-size band); unknown years count as 10."""
    out = framed.withColumn("time_yr", F.coalesce("time_yr", F.lit(10.0)))
    out = out.withColumns({"time_yrs": band_label(F.least("time_yr", F.lit(3.0)), 3, "Sold out ", " yr"),
                           "size_percent_missing": missing_label(F.col("missing_share"))})
    out = grid_lookup(out, grid, "time_yrs", "size_percent_missing", "discount", "suggest_discount")
    return out.withColumn("suggest_price", suggested_price(F.col("suggest_discount"), F.col("regular_price")))


def suggest_deals(framed: DataFrame, grid: DataFrame, month: int, deeper_only: bool = False) -> DataFrame:
    """Web deals to add: positive grid discounts outside the running season."""
    out = deal_bands(framed, grid).filter(F.col("suggest_discount") > 0)
    if deeper_only:
        out = out.filter(F.col("suggest_discount") > F.col("discount"))
    leave = off_season_letter(month)
    if leave:
        out = out.filter(~rlike0("seasons", leave))
    return out.select("sku", "seasons", "cat", "spu", "regular_price", "discount", "qty", "time_yr", "time_yrs",
                      "size_percent_missing", "suggest_discount", "suggest_price")


def current_deals(items: DataFrame, month: int) -> DataFrame:
    """Running deals of the other season's goods; all items in June and December."""
    leave = {"S": "F", "F": "S"}.get(off_season_letter(month) or "")
    return items.filter(~rlike0("seasons", leave) & (F.col("discount") > 0)) if leave else items


def demand_base(sales: DataFrame, inv: DataFrame, master: DataFrame, ratio: DataFrame, month: int, channels: Sequence[str],
                ahead: int) -> DataFrame:
    """Trailing demand of stocked SKUs beside their stock and the category's shares."""
    months = trailing_months(month, 3)
    sold = sales.filter(F.col("sales_channel").isin(list(channels))).groupBy("adjust_msku").agg(
        sum_where(F.col("month").isin(months), "qty").cast(DOUBLE).alias("sales_last3m"))
    stock = inv.groupBy("adjust_msku").agg(F.sum(
        row_sum(["inv_warehouse", "inv_amz_usa", "inv_amz_ca"])).alias("stock"))
    out = sold.join(stock, "adjust_msku")
    out = lookup(out, master, {"adjust_msku": "msku"}, {"category_sku": "cat", "seasons_sku": "seasons", "msku_status": "status"}, unique=True)
    sums = ratio_sums(ratio, r3=months, r_ahead=forward_months(month, ahead))
    return lookup(out, sums, {"cat": "category"}, ["r3", "r_ahead"], unique="grouped")


def low_stock_month(sales: DataFrame, inv: DataFrame, master: DataFrame, ratio: DataFrame, month: int,
                    channels: Sequence[str], refill: int = 12, shared: SharedFrames | None = None) -> DataFrame:
    """In-season active SKUs that will not last the month, with the share of the SPU's sizes that will."""
    out = demand_base(sales, inv, master, ratio, month, channels, 1).withColumn("spu", sku.spu("adjust_msku"))
    out = out.withColumn("sales_this", F.try_divide(F.col("sales_last3m"), F.col("r3")) * F.col("r_ahead"))
    stock = F.col("stock").cast(DOUBLE)
    left = r_ifelse(stock < F.col("sales_this"), F.lit(0), (stock - F.col("sales_this")).cast("int"))
    out = out.withColumn("qty_left", left)
    out = out.withColumn("enough", (F.col("qty_left") >= refill) | (F.col("sales_this") == 0))
    out = with_group_total(kept(out, shared, "low_stock"), "spu", {"__ok": F.avg(F.col("enough").cast("int"))})
    out = out.withColumn("percent_sizes_ok", (F.col("__ok") * 100).cast("int"))
    return out.filter(rlike0("seasons", in_season_letter(month)) & (F.col("status") == "Active") & ~F.col("enough")).select(
        "adjust_msku", "spu", "cat", "seasons", "sales_last3m", "sales_this", "stock", "qty_left", "percent_sizes_ok")


def reorder_gap(sales: DataFrame, inv: DataFrame, master: DataFrame, ratio: DataFrame, po: DataFrame, month: int,
                channels: Sequence[str], warehouse: str, season: str = "") -> DataFrame:
    """Demand of the next four months that neither stock nor open orders cover."""
    remain = po.filter(F.col("warehouse") == warehouse).groupBy("item").agg(
        F.sum(F.col("quantity") - F.coalesce("quantity_on_shipments", F.lit(0))).alias("po_remain")).filter(F.col("po_remain") > 0)
    out = demand_base(sales, inv, master, ratio, month, channels, 4)
    out = out.withColumn("need", (F.try_divide(F.col("sales_last3m"), F.col("r3")) * F.col("r_ahead")).cast("int"))
    out = lookup(out, remain, {"adjust_msku": "item"}, ["po_remain"], unique="grouped", defaults={"po_remain": 0})
    out = out.withColumn("gap", F.col("need") - F.col("stock") - F.col("po_remain")).filter(F.col("gap") > 0)
    if season:
        out = out.filter(rlike0("seasons", season))
    return out.select("adjust_msku", "cat", "seasons", "sales_last3m", "need", "stock", "po_remain", "gap")


def to_inactivate(master: DataFrame, pos: DataFrame, inv: DataFrame, new_season: str) -> DataFrame:
    """Active SKUs of older seasons with nothing in the store and nothing anywhere."""
    total = inv.groupBy("adjust_msku").agg(F.sum("inv_total_end_wk").alias("inv_total"))
    out = master.filter((F.col("msku_status") == "Active") & ~rlike0("seasons_sku", new_season))
    out = lookup(out, pos.filter(F.col("name").isNotNull()), {"msku": "name"}, {"quantity": "inv_pos"}, order=source_order(pos))
    out = lookup(out, total, {"msku": "adjust_msku"}, ["inv_total"], unique="grouped")
    return out.filter((F.col("inv_pos") == 0) & (F.col("inv_total") == 0)).select("msku", "msku_status", "seasons_sku", "inv_pos", "inv_total")
