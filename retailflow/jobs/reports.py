"""Sales, store, wholesale and customer reports (the tables behind the charts)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import CHANNEL_MARKERS, EAST_PROVINCES, PROVINCE_CODES, WHOLESALE_MARKET, WHOLESALE_MARKET_COUNTRIES
from ..functions import sku
from ..functions.semantics import excel_date, isin0, map_column, money_round, not_blank, number, parse_date, safe_div
from ..operators.groups import share_of
from ..operators.keys import first_per_key, prefer_rows, source_order, top_k
from ..operators.lookup import left_join_fill, lookup, semi
from ..operators.reshape import pivot_fixed, with_calendar
from ..session import SharedFrames, kept

DOUBLE = "double"


def best_sellers(sales: DataFrame, master: DataFrame, categories: Sequence[str], stock: DataFrame | None = None) -> DataFrame:
    """SKU totals of the chosen categories beside the total of their SPU (category-print)."""
    per_sku = sales.filter(~isin0("sales_channel", CHANNEL_MARKERS)).groupBy("adjust_msku").agg(F.sum("qty").alias("total"))
    per_sku = lookup(per_sku, master, {"adjust_msku": "msku"}, {"category_sku": "category", "print_sku": "__print"}, unique=True)
    per_sku = per_sku.withColumn("spu", F.concat(F.coalesce("category", F.lit("")), F.lit("-"), F.coalesce("__print", F.lit(""))))
    per_spu = per_sku.groupBy("spu").agg(F.sum("total").alias("total_spu"))
    out = lookup(per_sku, per_spu, "spu", ["total_spu"], unique="grouped").drop("__print")
    if stock is not None:
        out = lookup(out, stock, {"adjust_msku": "name"}, {"warehouse_available": "available"}, unique=True)
    return out.filter(isin0("category", categories))


def sales_summary(sales: DataFrame, key: str, year: int, preferred: Sequence[str]) -> DataFrame:
    """Annual sales per key from the "all channels" rows, else from one channel's rows."""
    kept = prefer_rows(sales.filter(F.col("year") == year), key, "sales_channel", preferred)
    return kept.groupBy(key, "sales_channel").agg(F.sum("qty").alias("qty"))


def sku_summary(sales: DataFrame, year: int) -> DataFrame:
    """SKUs sold in a year, channel totals added up."""
    kept = sales.filter((F.col("year") == year) & ~isin0("sales_channel", CHANNEL_MARKERS))
    return kept.groupBy("adjust_msku").agg(F.sum("qty").alias("qty")).filter(F.col("qty") > 0)


def sales_trend(cat_sales: DataFrame, groups: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Series per category of a known group: by year, and by month."""
    out = lookup(cat_sales, groups, {"category": "category_sku"}, ["category_group"], unique=True).filter(F.col("category_group").isNotNull())
    yearly = out.groupBy("category_group", "category", "year").agg(F.sum("qty").alias("sales"))
    monthly = out.groupBy("category_group", "category", "year", "month").agg(F.sum("qty").alias("sales"))
    return yearly, monthly


WHOLESALE = ("ref_no", "date", "year", "month", "sales_rep", "currency", "total_amount", "shipping_cost", "amount_discount",
             "tax", "total_qty", "country", "state", "customer_name", "email")


def _dated(df: DataFrame, serial: str) -> DataFrame:
    return df.withColumn("date", excel_date(serial)).withColumns({"year": F.year("date"), "month": F.month("date")})


def unify_wholesale(a: DataFrame, b: DataFrame, c: DataFrame, years: Sequence[int], rep_c: str = WHOLESALE_MARKET) -> DataFrame:
    """Three invoice layouts in one; marketplace lines (layout c) are summed to orders."""
    first = _dated(a, "date").select(
        F.col("so_ref_number").alias("ref_no"), "date", "year", "month", "sales_rep", F.col("currency_code").alias("currency"),
        "total_amount", "shipping_cost", F.col("total_discount").alias("amount_discount"), F.col("total_tax_amount").alias("tax"),
        "total_qty", F.col("ship_to_country").alias("country"), F.col("ship_to_state").alias("state"), "customer_name",
        F.col("main_email").alias("email"))
    names = first_per_key(first.filter(not_blank("email")).select("email", "customer_name", "ref_no"), "email", ["ref_no"])
    second = lookup(_dated(b, "date"), names, "email", {"customer_name": "customer_name"}, unique="grouped",
                    defaults={"customer_name": F.col("company_name")})
    second = second.select(
        "ref_no", "date", "year", "month", "sales_rep", "currency", F.col("amount_foreign_currency").alias("total_amount"),
        "shipping_cost", F.coalesce("amount_discount", F.lit(0)).alias("amount_discount"), F.col("tax_total").alias("tax"),
        F.col("total_qty_r").alias("total_qty"), F.col("country_code").alias("country"), F.col("state_province").alias("state"),
        "customer_name", "email")
    country = map_column("country", WHOLESALE_MARKET_COUNTRIES)
    third = _dated(c.groupBy("order_number").agg(
        F.min("order_date").alias("date"), F.sum("wholesale_price").alias("total_amount"), F.sum("quantity").alias("total_qty"),
        F.min("country").alias("country"), F.min("state").alias("state"), F.min("retailer_name").alias("customer_name")), "date")
    zero = F.lit(0).cast("decimal(12,2)")
    third = third.filter(F.col("year").isin(list(years))).select(
        F.col("order_number").alias("ref_no"), "date", "year", "month", F.lit(rep_c).alias("sales_rep"), F.lit("USD").alias("currency"),
        "total_amount", zero.alias("shipping_cost"), zero.alias("amount_discount"), zero.alias("tax"), "total_qty",
        country.alias("country"), "state", "customer_name", F.lit("").alias("email"))
    return third.select(*WHOLESALE).unionByName(first.select(*WHOLESALE)).unionByName(second.select(*WHOLESALE))


def wholesale_by(invoices: DataFrame, by: Sequence[str], no_average: Column | None = None) -> DataFrame:
    """Average, amount and quantity per (by, year), one row per measure."""
    avg = safe_div(F.sum("total_amount"), F.count("total_amount"))
    out = invoices.groupBy(*by, "year").agg(
        avg.alias("average_amount"), F.sum("total_amount").cast(DOUBLE).alias("total_amount"), F.sum("total_qty").cast(DOUBLE).alias("total_qty"))
    if no_average is not None:
        out = out.withColumn("average_amount", F.when(no_average, 0.0).otherwise(F.col("average_amount")))
    return out.unpivot([*by, "year"], ["average_amount", "total_amount", "total_qty"], "total", "value")


def wholesale_stores(invoices: DataFrame, years: tuple[int, int]) -> DataFrame:
    """One row per store: both years side by side and the growth rate (1 for a new, -1 for a lost store)."""
    y0, y1 = years
    first = invoices.groupBy("customer_name").agg(F.min("date").alias("start_date"), F.min_by("sales_rep", F.struct("date", "ref_no")).alias("sales_rep"),
                                                  F.min_by("country", F.struct("date", "ref_no")).alias("country"))
    wide = pivot_fixed(invoices, ["customer_name"], "year", {y0: str(y0), y1: str(y1)}, {
        "total_amount": F.sum("total_amount"), "orders": F.count("total_amount"), "total_qty": F.sum("total_qty")})
    a, b = F.col(f"total_amount_{y0}"), F.col(f"total_amount_{y1}")
    growth = F.when(a.isNull(), 1.0).when(b.isNull(), -1.0).otherwise(F.bround(safe_div(b - a, a), 3))
    out = wide.filter(a.isNotNull() | b.isNotNull()).withColumn("growth_rate", growth)
    for y in years:
        mean = F.try_divide(F.col(f"total_amount_{y}"), F.col(f"orders_{y}").cast("decimal(12,0)"))
        out = out.withColumn(f"average_amount_{y}", money_round(mean)).drop(f"orders_{y}")
    return lookup(out, first, "customer_name", ["start_date", "sales_rep", "country"], unique="grouped")


def store_payments(payments: DataFrame, exclude_employee: str | None = None) -> DataFrame:
    """Successful non-zero payments with their day."""
    out = payments.filter((F.col("result") == "SUCCESS") & (F.col("amount") != 0))
    if exclude_employee:
        out = out.filter(F.col("order_employee_name") != exclude_employee)
    return out.withColumn("date", parse_date("payment_date", "dd-MMM-yyyy"))


def daily_sales(payments: DataFrame, days: DataFrame) -> DataFrame:
    """Amount and number of payments per day, workdays without sales at 0."""
    daily = payments.groupBy("date").agg(F.sum("amount").alias("amount"), F.count(F.lit(1)).alias("n"))
    return with_calendar(daily, days, {"amount": 0, "n": 0})


def store_kpis(payments: DataFrame, web: DataFrame, refunds: DataFrame, days: DataFrame) -> DataFrame:
    """One row of store figures against the web shop.

    ``web`` has one row per order (order_number, order_total).
    """
    daily = daily_sales(payments, days).agg(F.sum("amount").alias("a"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("d"))
    web1 = web.agg(F.sum("order_total").alias("a"), F.count(F.lit(1)).alias("n"))
    back = refunds.agg(F.sum("refund_amount").alias("a"), F.count(F.lit(1)).alias("n"))
    pay = payments.agg(F.sum("amount").alias("revenue"), F.count(F.lit(1)).alias("orders"))
    one = lambda df, c: df.select(c).scalar()
    out = pay.select("revenue", "orders", one(web1, "a").alias("web_revenue"), one(web1, "n").alias("web_orders"),
                     one(back, "a").alias("refund"), one(back, "n").alias("refunds"), one(daily, "a").alias("__da"),
                     one(daily, "n").alias("__dn"), one(daily, "d").alias("days"))
    d = lambda c: F.col(c).cast(DOUBLE)
    return out.select(
        d("revenue").alias("revenue"), "orders", d("web_revenue").alias("web_revenue"), "web_orders",
        safe_div("revenue", "web_revenue").alias("revenue_share"), safe_div("orders", "web_orders").alias("order_share"),
        d("refund").alias("refund"), "refunds", safe_div("refunds", "orders").alias("refund_share"),
        safe_div("__da", "days").alias("daily_amount"), safe_div("__dn", "days").alias("daily_orders"),
        safe_div("revenue", "orders").alias("order_size"))


def by_weekday(payments: DataFrame) -> DataFrame:
    """Revenue, orders and order size per weekday; the number sorts, the label shows."""
    out = payments.groupBy(F.dayofweek("date").alias("weekday")).agg(F.sum("amount").alias("amount"), F.count(F.lit(1)).alias("n"))
    names = F.array(*[F.lit(x) for x in ("Sun", "Mon", "Tue", "Wed", "Thu", "Fri", "Sat")])
    return out.select("weekday", F.element_at(names, F.col("weekday")).alias("label"), F.col("amount").cast(DOUBLE).alias("amount"), "n",
                      safe_div("amount", "n").alias("average"))


def by_month(payments: DataFrame) -> DataFrame:
    out = payments.groupBy(F.year("date").alias("year"), F.month("date").alias("month")).agg(F.sum("amount").alias("amount"), F.count(F.lit(1)).alias("n"))
    return out.select("year", "month", F.col("amount").cast(DOUBLE).alias("amount"), "n", safe_div("amount", "n").alias("average"))


def web_region_yoy(orders: DataFrame, years: Sequence[int], before: tuple[int, int] | None = None, lump: str = "US") -> DataFrame:
    """Web orders per month, country and state for some years, one row per measure; one country stays unsplit.

    ``before=(month, day)`` compares the years up to the same day.
    """
    used, order = ["order_number", "order_date", "country_code", "state_code", "order_total"], source_order(orders)
    if "_pos" not in order:  # of columns in their order, those behind the last used one decide nothing that shows
        order = order[:1 + max(order.index(c) for c in used)]
    one = first_per_key(orders.select(*dict.fromkeys([*order, *used])), "order_number", order).withColumn("__d", F.to_date(F.split("order_date", " ")[0]))
    out = one.withColumns({"year": F.year("__d"), "month": F.month("__d"),
                           "state": F.when(F.col("country_code") == lump, lump).otherwise(F.col("state_code"))})
    out = out.filter(F.col("year").isin(list(years)) & not_blank("country_code") & not_blank("state"))
    if before:
        out = out.filter((F.month("__d") * 100 + F.dayofmonth("__d")) < before[0] * 100 + before[1])
    agg = out.groupBy("year", "month", F.col("country_code").alias("country"), "state").agg(
        F.count(F.lit(1)).cast(DOUBLE).alias("orders"), F.sum("order_total").cast(DOUBLE).alias("amount"))
    return agg.unpivot(["year", "month", "country", "state"], ["orders", "amount"], "measure", "value")


def customer_counts(payments: DataFrame, contacts: DataFrame, web_customers: DataFrame) -> DataFrame:
    """Known customers, repeat customers, and those unknown to the web shop."""
    paid = lookup(payments, contacts, {"customer_name": "name"}, {"email_address": "email"}, unique=True)
    per = paid.filter(F.col("email").isNotNull()).groupBy("email").agg(F.count(F.lit(1)).alias("n"))
    per = lookup(per, web_customers.select("email").distinct(), "email", {}, unique="grouped", flag="__web")
    out = per.agg(F.count(F.lit(1)).alias("known"), F.count_if(F.col("n") > 1).alias("repeat"), F.count_if(~F.col("__web")).alias("new"))
    return out.withColumns({"repeat_share": safe_div("repeat", "known"), "new_share": safe_div("new", "known")})


def prefix_of(c: str) -> Column:
    return F.upper(F.substring(F.col(c), 1, 3))


def fsa_rollup(orders: DataFrame, postal: str, amount: str, region: DataFrame, census: DataFrame, childcare: DataFrame) -> DataFrame:
    """Orders, amount, dwellings and childcares per postal prefix of a region, absent figures at 0."""
    sold = orders.groupBy(prefix_of(postal).alias("fsa")).agg(F.count(F.lit(1)).alias("order_count"), F.sum(amount).cast(DOUBLE).alias("amount"))
    care = childcare.groupBy(prefix_of("postal_code").alias("fsa")).agg(F.count(F.lit(1)).alias("childcares"))
    homes = census.select("fsa", number("occupied_dwellings").alias("dwellings"))
    out = left_join_fill(region.filter("in_region").select("fsa"), sold, "fsa", {"order_count": 0, "amount": 0.0})
    out = left_join_fill(out, homes, "fsa", {"dwellings": 0.0})
    return left_join_fill(out, care, "fsa", {"childcares": 0})


def top_categories(lines: DataFrame, k: int, by: Sequence[str] = (), orders: DataFrame | None = None) -> DataFrame:
    """Best-selling categories by pieces, overall or per group; ties go by name."""
    sold = lines.filter(not_blank("item_sku"))
    if orders is not None:
        sold = semi(sold, orders, "order_id")
    agg = sold.groupBy(*by, sku.category("item_sku").alias("category")).agg(F.count(F.lit(1)).alias("qty"))
    return top_k(agg, k, [F.col("qty").desc(), F.col("category")], by)


def event_sales(lines: DataFrame, skip: str = "MISC") -> DataFrame:
    """Pieces per event day and category, miscellaneous items left out."""
    sold = lines.filter(not_blank("item_sku") & ~F.col("item_sku").contains(skip))
    return sold.groupBy(parse_date("line_item_date", "dd-MMM-yyyy").alias("date"), sku.category("item_sku").alias("category")).agg(F.count(F.lit(1)).alias("qty"))


def return_rate(tx: DataFrame, province_map: Mapping[str, str] = PROVINCE_CODES, min_orders: int = 10,
                category_pattern: str | None = None, skip: Sequence[str] = ()) -> DataFrame:
    """Refunded share of ordered pieces per state and category with enough orders."""
    rows = tx.filter(F.col("type").isin("Order", "Refund") & not_blank("order_state")).withColumns({
        "category": sku.category("sku"), "state": map_column(F.upper(F.trim("order_state")), province_map)})
    if category_pattern:
        rows = rows.filter(F.col("category").rlike(category_pattern))
    if skip:
        rows = rows.filter(~isin0("category", skip))
    wide = pivot_fixed(rows, ["state", "category"], "type", {"Order": "orders", "Refund": "refunds"}, {"q": F.sum("quantity")})
    wide = wide.withColumn("refunds", F.coalesce("refunds", F.lit(0)))
    return wide.filter(F.col("orders") >= min_orders).withColumn("return_rate", safe_div("refunds", "orders"))


def regional_share(orders: DataFrame, master: DataFrame, country: str = "CA", east: Sequence[str] = EAST_PROVINCES,
                   shared: SharedFrames | None = None) -> DataFrame:
    """Share of a country in each category's sales and of its eastern provinces in the country's."""
    rows = orders.filter((F.col("order_status") == "Completed") & not_blank("country_code") & not_blank("sku"))
    rows = lookup(rows, master, {"sku": "msku"}, {"category_sku": "category"}, unique=True, defaults={"category": sku.category("sku")})
    region = F.when(isin0("state_code", east), "East").otherwise("West")
    # a row per category, country and side: both shares are of these few rows
    rows = kept(rows.groupBy("category", "country_code", region.alias("region")).agg(F.sum("quantity").alias("q")), shared, "regional_share")
    by_country = share_of(rows.groupBy("category", "country_code").agg(F.sum("q").alias("q")), "q", "category", "share")
    home = by_country.filter(F.col("country_code") == country).select("category", F.bround("share", 2).alias("country_share"))
    by_region = share_of(rows.filter(F.col("country_code") == country).select("category", "region", "q"), "q", "category", "share")
    side = by_region.filter(F.col("region") == "East").select("category", F.bround("share", 2).alias("east_share"))
    return lookup(home, side, "category", ["east_share"], unique=True, defaults={"east_share": 0.0})
