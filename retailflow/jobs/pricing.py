"""Catalog prices, POS and marketplace catalog files."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import (
    CONSTANT_CATEGORY_PRICES, POS_TAX, POS_TAX_FULL, TAXABLE_CATEGORIES,
)
from ..functions import sku
from ..functions.semantics import MONEY, apply_rules, isin0, money_round, not_blank, rlike0
from ..operators.keys import append_rows, first_per_key, source_order, union_first
from ..operators.lookup import anti, lookup, semi
from ..operators.rules import regex_lookup


def effective_price(web: DataFrame, as_of: datetime | None, order: str = "id") -> DataFrame:
    """First row per SKU with ``sale_price`` valid at ``as_of`` (regular price outside the window).

    A SKU whose first row has no regular price has no price.  A missing window end is open.  ``as_of=None`` ignores
    the window.
    """
    priced = first_per_key(web.filter(not_blank("sku")), "sku", order).filter(F.col("regular_price").isNotNull())
    off = F.col("sale_price").isNull()
    if as_of is not None:
        now = F.lit(as_of)
        off = off | F.coalesce(now < F.col("sale_starts"), F.lit(False)) | F.coalesce(now > F.col("sale_ends"), F.lit(False))
    return priced.withColumn("sale_price", F.when(off, F.col("regular_price")).otherwise(F.col("sale_price")))


def category_price(web: DataFrame, extra: Sequence[tuple[str, float]] = CONSTANT_CATEGORY_PRICES,
                   measure: str = "sale_price", factor: float | None = None) -> DataFrame:
    """Highest price per category (times ``factor``) plus constant rows: the price of SKUs off the web."""
    top = F.max(measure)
    if factor is not None:
        top = money_round(top * F.lit(Decimal(str(factor))))
    cats = web.groupBy(sku.category("sku").alias("cat")).agg(top.cast(MONEY).alias("price"))
    return append_rows(cats, [(c, Decimal(str(p))) for c, p in extra]) if extra else cats


def tax_rates(category: Column, taxable: Sequence[str]) -> Column:
    return F.when(isin0(category, taxable), POS_TAX_FULL).otherwise(POS_TAX)


def _price_from(df: DataFrame, web: DataFrame, cat_price: DataFrame, key: str, cat: str, measure: str) -> DataFrame:
    """Own web price, else category price; ``alternate_name`` and ``tax_class`` come along."""
    out = lookup(df, web, {key: "sku"}, {measure: "__own", "name": "alternate_name", "tax_class": "__class"},
                 unique=True, flag="__on_web")
    out = lookup(out, cat_price, {cat: "cat"}, {"price": "__cat_price"}, unique=True)
    return out.withColumn("price", F.when(F.col("__on_web"), F.col("__own")).otherwise(F.col("__cat_price")))


def sync_pos_catalog(pos: DataFrame, web: DataFrame, cat_price: DataFrame, rules: DataFrame,
                     taxable: Sequence[str] | None = TAXABLE_CATEGORIES) -> DataFrame:
    """POS items with price, name and tax of the web catalog; clearance rules override the price.

    ``taxable=None`` takes the tax from the web tax class instead of the category.
    """
    items = first_per_key(pos.filter(not_blank("name")), "name", source_order(pos))
    items = _price_from(items.withColumn("cat", sku.category("name")), web, cat_price, "name", "cat", "sale_price")
    items = regex_lookup(items, rules, "name", "item", "_pos", ["sales"])
    full = F.when(F.coalesce(F.col("__class") == "full", F.lit(False)), POS_TAX_FULL).otherwise(POS_TAX)
    return items.withColumns({
        "price": F.coalesce("sales", "price").cast(MONEY),
        "tax_rates": full if taxable is None else tax_rates(F.col("cat"), taxable),
    }).withColumn("price_type", F.when(F.col("price").isNull(), "Variable").otherwise("Fixed")).select(
        *dict.fromkeys([*pos.columns, "alternate_name", "price", "price_type", "tax_rates"]))


def promo_price(pos: DataFrame, web: DataFrame, factor: float, overrides: Sequence[tuple[str, float]] = (),
                extra: Sequence[tuple[str, float]] = ()) -> DataFrame:
    """Lower of the sale price and the marked-down regular price; items off the web take the marked-down
    highest regular price of their category; pattern overrides win, the last one first."""
    cats = category_price(web, extra, "regular_price", factor)
    down = money_round(F.col("regular_price") * F.lit(Decimal(str(factor)))).cast(MONEY)
    marked = web.withColumn("sale_price", F.least("sale_price", down))
    out = _price_from(pos.withColumn("cat", sku.category("name")), marked, cats, "name", "cat", "sale_price")
    ruled = apply_rules("name", [(p, Decimal(str(v))) for p, v in overrides], F.col("price"))
    return out.withColumn("price", ruled.cast(MONEY)).withColumn(
        "price_type", F.when(F.col("price").isNull(), "Variable").otherwise("Fixed")).select(
        "name", "cat", "price", "price_type")


def event_price(pos: DataFrame, item_prices: DataFrame, cat_prices: DataFrame,
                rules: Sequence[tuple[str, float]]) -> DataFrame:
    """Price from an item list, else from a category list, else kept; prefix rules override all."""
    out = lookup(pos.withColumn("cat", sku.category("name")), item_prices, "name", {"price": "__item"},
                 unique=True, flag="__listed")
    out = lookup(out, cat_prices, "cat", {"price": "__cat"}, unique=True, flag="__cat_listed")
    price = (F.when(F.col("__listed"), F.col("__item")).when(F.col("__cat_listed"), F.col("__cat"))
             .otherwise(F.col("price")))
    ruled = apply_rules("name", [(p, Decimal(str(v))) for p, v in rules], price)
    return out.withColumn("price", ruled.cast(MONEY)).withColumn(
        "price_type", F.when(F.col("price").isNull(), "Variable").otherwise("Fixed")).select(
        "name", "cat", "price", "price_type")


def pos2_catalog(web: DataFrame, stock: DataFrame, stock_category: str = "item_category_sku") -> DataFrame:
    """Second POS catalog: price, tax flag and available quantity (absent stock is 0)."""
    out = lookup(web, stock, {"sku": "name"}, {"warehouse_available": "new_quantity", stock_category: "category"}, unique=True)
    return out.select(
        F.lit("").alias("token"), F.col("sku").alias("item_name"), F.lit("Regular").alias("variation_name"), "sku",
        "category", F.col("sale_price").alias("price"), F.coalesce("new_quantity", F.lit(0)).alias("new_quantity"),
        F.lit("Y").alias("enabled"), F.lit("UNAVAILABLE").alias("online_visibility"), F.lit("Y").alias("sellable"),
        F.lit("Y").alias("stockable"),
        F.when(F.coalesce(F.col("tax_class") == "full", F.lit(False)), "Y").otherwise("N").alias("tax_pst"))


def first_barcode(c: Column) -> Column:
    return F.regexp_replace(c, "[ /|].*", "")


def inherit_attr(df: DataFrame, dim: DataFrame, key: str, dim_key: str, col: str, out: str) -> DataFrame:
    """Second-quality SKUs take the attribute of the SKU they copy."""
    tagged = df.withColumn("__base", F.when(rlike0(key, "^M"), sku.base_quality(key)).otherwise(F.col(key)))
    return lookup(tagged, dim, {"__base": dim_key}, {col: out}, unique=True).drop("__base")


def sync_master(master: DataFrame, pos: DataFrame, web: DataFrame, cat_price: DataFrame, rules: DataFrame,
                taxable: Sequence[str] = TAXABLE_CATEGORIES, exclude: Sequence[str] = ()) -> DataFrame:
    """POS item file of all active SKUs: price, tax, first barcode (second quality inherits), kept quantity."""
    items = master.filter((F.col("msku_status") == "Active") & not_blank("msku") & ~isin0("category_sku", exclude))
    items = items.select(F.col("msku").alias("name"), F.col("category_sku").alias("categories"))
    items = _price_from(items, web, cat_price, "name", "categories", "sale_price")
    items = lookup(items, pos, "name", ["quantity", "clover_id"], unique=True, defaults={"quantity": 0})
    items = inherit_attr(items, master, "name", "msku", "upc_active", "__upc")
    items = regex_lookup(items, rules, "name", "item", "_pos", ["sales"])
    price = F.coalesce("sales", "price").cast(MONEY)
    return items.select(
        "clover_id", "name", "alternate_name", price.alias("price"),
        F.when(F.col("price").isNull(), "Variable").otherwise("Fixed").alias("price_type"),
        first_barcode(F.col("__upc")).alias("product_code"), F.col("name").alias("sku"), "quantity",
        tax_rates(F.col("categories"), taxable).alias("tax_rates"), "categories")


def category_listing(items: DataFrame, pos_category: DataFrame) -> DataFrame:
    """Items under their category, the category label and id shown on its first item only."""
    out = items.select(F.col("categories").alias("category_name"), F.col("name").alias("item_sort_order"))
    firsts = out.groupBy("category_name").agg(F.min("item_sort_order").alias("__first"))
    out = lookup(out, firsts, "category_name", ["__first"], unique="grouped")
    out = lookup(out, pos_category, "category_name", ["category_id"], unique=True)
    shown = F.col("item_sort_order") == F.col("__first")
    return out.select(
        F.when(shown, F.col("category_name")).otherwise("").alias("category_name"),
        F.when(shown, F.col("category_id")).otherwise("").alias("category_id"), "item_sort_order")


def sync_market(products: DataFrame, stock: DataFrame, web: DataFrame, descr: DataFrame, min_qty: int = 20,
                surcharge_pattern: str = "^L", surcharge: float = 10, off_pattern: str | None = "^MWPF",
                tags: tuple[str, str] = ("regular", "sale")) -> DataFrame:
    """Marketplace price and stock: stock below ``min_qty`` shows 0, a prefix carries a surcharge, the tag
    tells full price from sale, texts come per SPU."""
    out = lookup(products.select("spu", "sku"), stock, {"sku": "name"}, {"warehouse_available": "inventory"}, unique=True)
    out = lookup(out, web, "sku", {"sale_price": "price", "regular_price": "compare_at_price"}, unique=True)
    out = lookup(out.withColumn("__spu", F.upper("spu")), descr.withColumn("__spu", F.upper("spu")), "__spu",
                 ["product_name", "description"], order=["spu"])
    more = F.when(rlike0("sku", surcharge_pattern), F.lit(Decimal(str(surcharge)))).otherwise(F.lit(Decimal(0)))
    inv = F.when(F.col("inventory") < min_qty, 0).otherwise(F.col("inventory"))
    if off_pattern:
        inv = F.when(rlike0("sku", off_pattern), 0).otherwise(inv)
    out = out.withColumns({"inventory": inv, "price": (F.col("price") + more).cast(MONEY),
                           "compare_at_price": (F.col("compare_at_price") + more).cast(MONEY)})
    same = F.col("price") == F.col("compare_at_price")
    return out.withColumn("tags", F.when(same, tags[0]).when(~same, tags[1])).drop("__spu")


def listing_candidates(stock: DataFrame, listed: DataFrame, exclude: Sequence[str], min_qty: int = 5) -> DataFrame:
    """Stocked items not listed yet, outside the excluded categories."""
    enough = stock.filter((F.col("warehouse_available") >= min_qty) & ~isin0("item_category_sku", exclude))
    return anti(enough, listed, {"name": "sku"})


def missing_category_texts(candidates: DataFrame, cat_descr: DataFrame) -> DataFrame:
    """Categories of candidates without a description row."""
    cats = candidates.select(F.col("item_category_sku").alias("cat")).distinct()
    return anti(cats, cat_descr, "cat")


def missing_spu_texts(candidates: DataFrame, descr: DataFrame, web: DataFrame, cat_descr: DataFrame) -> DataFrame:
    """Draft description rows of SPUs that are sold on the web and have none."""
    spu = F.concat_ws("-", "item_category_sku", "item_print_sku")
    drafts = candidates.select(spu.alias("spu"), F.col("item_category_sku").alias("cat")).distinct()
    drafts = semi(anti(drafts, descr, "spu"), web.select(sku.spu("sku").alias("spu")).distinct(), "spu")
    return lookup(drafts, cat_descr, "cat", ["product_name", "description", "categories"], unique=True)


def new_listings(candidates: DataFrame, listed: DataFrame, master: DataFrame, web: DataFrame, descr: DataFrame,
                 stock: DataFrame, tags: tuple[str, str] = ("regular", "sale")) -> DataFrame:
    """Old listing plus active, priced, described candidates (old rows win), refreshed, stock above 0 kept."""
    new = lookup(candidates.select(F.col("name").alias("sku")), master, {"sku": "msku"},
                 ["msku_status", "category_sku", "print_sku"], unique=True)
    new = new.withColumn("spu", F.concat_ws("-", "category_sku", "print_sku")).filter(F.col("msku_status") == "Active")
    new = semi(semi(new, web.filter(F.col("sale_price").isNotNull()), "sku"), descr, "spu")
    both = union_first(listed.select(F.upper("spu").alias("spu"), "sku"), new.select("spu", "sku"), "sku", "spu")
    both = lookup(both, descr, "spu", ["product_name", "description"], unique=True)
    both = lookup(both, web, "sku", {"sale_price": "price", "regular_price": "compare_at_price"}, unique=True)
    both = lookup(both, stock, {"sku": "name"}, {"warehouse_available": "inventory"}, unique=True)
    same = F.col("price") == F.col("compare_at_price")
    return both.withColumn("tags", F.when(same, tags[0]).when(~same, tags[1])).filter(F.col("inventory") > 0)

