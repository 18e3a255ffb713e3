"""Inventory reconciliation, replenishment, counts, third-party warehouse, event lists."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import LOG_WHOLE, LOG_YES, REASON_COUNT, STATUS_SHIPPED, STATUS_SYNCED
from ..functions import sku
from ..functions.semantics import MONEY, apply_rules, clip0, isin0, rlike0, safe_div
from ..operators.keys import densify, first_per_key, source_order, upsert_status
from ..operators.lookup import anti, lookup, semi
from ..operators.reshape import sort_r
from ..operators.rules import matches_any
from ..schemas import STATUS_LOG_HEADERS
from ..sources.writers import VersionedTable


def _date(as_of: date) -> Column:
    return F.lit(as_of.strftime("%m/%d/%Y"))


def transfer(as_of: date, season: str, source: str, target: str, ref_no: str, memo: str, by: str, to_type: str) -> dict[str, Column]:
    """What all rows of a transfer order say, by the names of ``TRANSFER_HEADERS``."""
    return {
        "date": _date(as_of), "to_type": F.lit(to_type), "season": F.lit(season), "from_warehouse": F.lit(source), "to_warehouse": F.lit(target),
        "ref_no": F.lit(ref_no), "memo": F.lit(memo), "order_placed_by": F.lit(by),
    }


def warehouse_stock(erp: DataFrame, warehouse: str) -> DataFrame:
    return erp.filter(F.col("inventory_warehouse") == warehouse)


def clean_pos(pos: DataFrame) -> DataFrame:
    """Named POS items, one row per name, quantity floored at 0."""
    named = first_per_key(pos.filter(F.col("name").isNotNull() & (F.col("name") != "")), "name", source_order(pos))
    return named.withColumn("quantity", clip0("quantity").cast("int"))


def inventory_adjustment(pos: DataFrame, erp: DataFrame, warehouse: str, as_of: date, memo: str = "POS Inventory Update",
                         prefix: str = "IAR", suffix: str = "2") -> DataFrame:
    """POS quantity minus ERP availability in one warehouse, for items the ERP knows; zero differences dropped."""
    here = warehouse_stock(erp, warehouse).select("name", "warehouse_available")
    here = densify(here, erp.select("name"), {"warehouse_available": 0})
    counted = semi(pos.withColumn("quantity", clip0("quantity")), erp, "name")
    out = lookup(counted, here, "name", {"warehouse_available": "__erp"}, unique=True)
    out = out.withColumn("adjust_qty_by", (F.col("quantity") - F.col("__erp")).cast("int")).filter(F.col("adjust_qty_by") != 0)
    return out.select(
        _date(as_of).alias("date"), F.col("name").alias("item"), "adjust_qty_by", F.lit(REASON_COUNT).alias("reason_code"),
        F.lit("Good").alias("status"), F.lit(memo).alias("memo"), F.lit(warehouse).alias("warehouse"),
        F.lit(f"{prefix}-{as_of:%y%m%d}-{suffix}").alias("external_id"))


def stock_upload(stock: DataFrame, warehouse: str, as_of: date, memo: str = "Inventory Upload") -> DataFrame:
    """First stock of a warehouse as adjustments: every item with stock, upper-case name."""
    return stock.filter(F.col("warehouse_available") > 0).select(
        _date(as_of).alias("date"), F.upper("name").alias("item"), F.col("warehouse_available").alias("adjust_qty_by"), F.lit(REASON_COUNT).alias("reason_code"),
        F.lit(memo).alias("memo"), F.lit(warehouse).alias("warehouse"), F.lit(f"IAC-{as_of:%y%m%d}-1").alias("external_id"))


def pos_not_in_erp(pos: DataFrame, erp: DataFrame, master: DataFrame) -> DataFrame:
    out = anti(pos, erp, "name").select("name", "quantity")
    return lookup(out, master, {"name": "msku"}, ["msku_status", "seasons_sku"], unique=True)


def apply_movements(pos: DataFrame, moves: DataFrame, sign: int = 1, clip: bool = False) -> DataFrame:
    """Add (or take away) the summed movement quantity per item; items without movement keep theirs."""
    moved = moves.groupBy("item").agg(F.sum("quantity").alias("__moved"))
    out = lookup(pos, moved, {"name": "item"}, ["__moved"], unique="grouped", defaults={"__moved": 0})
    base = clip0("quantity") if clip else F.col("quantity")
    return out.withColumn("quantity", (base + sign * F.col("__moved")).cast("bigint")).drop("__moved")


def replenish(pos: DataFrame, donor: DataFrame, categories: Sequence[str], priority_categories: Sequence[str],
              priority_sizes: Sequence[str], season: str, as_of: date, target: int = 2, priority_target: int = 5,
              donor_floor: int = 8, source: str = "WH-CENTRAL", to: str = "WH-STORE", by: str = "", to_type: str = "Central-Store") -> DataFrame:
    """Transfer request up to the target stock (a higher one for priority category, size and season) where
    the donor holds more than its floor."""
    low = clean_pos(pos).filter(F.col("quantity") < priority_target).select(F.col("name").alias("item"), F.col("quantity").alias("stock"))
    out = lookup(low, donor, {"item": "name"}, {"item_category_sku": "__cat", "item_size": "__size",
                 "item_sku_seasons": "seasons", "warehouse_available": "__donor"}, unique=True)
    first = isin0("__cat", priority_categories) & isin0("__size", priority_sizes) & rlike0("seasons", season)
    out = out.withColumn("quantity", F.when(first, priority_target).otherwise(target) - F.col("stock"))
    out = out.filter((F.col("__donor") > donor_floor) & (F.col("quantity") > 0) & isin0(sku.category("item"), categories))
    return out.withColumns(transfer(as_of, season, source, to, f"TO-S2R{as_of:%y%m%d}", "Store Refill", by, to_type)).drop("__cat", "__size", "__donor")


def replenish_clearance(pos: DataFrame, donor: DataFrame, rules: DataFrame, n: int, as_of: date, season: str = "",
                        source: str = "WH-CENTRAL", to: str = "WH-STORE", by: str = "", to_type: str = "Central-Store") -> DataFrame:
    """All donor stock of clearance items the store is short of, or of which one piece is left."""
    hit = matches_any(clean_pos(pos), rules, "name", "item", "_pos", "__hit").filter("__hit")
    out = lookup(hit.select(F.col("name").alias("item"), F.col("quantity").alias("stock")), donor, {"item": "name"},
                 {"warehouse_available": "quantity", "item_sku_seasons": "seasons"}, unique=True)
    out = out.filter((F.col("quantity") > 0) & ((F.col("stock") < n) | (F.col("quantity") == 1)))
    return out.withColumns(transfer(as_of, season, source, to, f"TO-S2R{as_of:%y%m%d}", "Store Refill", by, to_type))


def refill_sold(sold: DataFrame, pos: DataFrame) -> DataFrame:
    """Refill what was sold; current stock shown beside."""
    return lookup(sold.select("item", "quantity"), clean_pos(pos), {"item": "name"}, {"quantity": "stock"}, unique="grouped")


def refill_event(pos: DataFrame, donor: DataFrame, event_items: DataFrame, low: int = 10, target: int = 20) -> DataFrame:
    """Event items running low: everything a nearly empty donor has, else up to the target."""
    short = semi(pos.filter(F.col("quantity") < low), event_items, {"name": "sku"}).select(F.col("name").alias("item"), F.col("quantity").alias("qty"))
    out = lookup(short, donor, {"item": "name"}, {"warehouse_available": "available"}, unique=True).filter(F.col("available") > 0)
    return out.withColumn("qty_transfer", F.when(F.col("available") < low, F.col("available")).otherwise(target - F.col("qty")))


def move_offline(erp: DataFrame, new_season: str, k: int, as_of: date, season: str = "", source: str = "WH-CENTRAL",
                 to: str = "WH-STORE", by: str = "", to_type: str = "Central-Store") -> DataFrame:
    """Transfer order for small remainders of older seasons."""
    small = erp.filter((F.col("warehouse_available") > 0) & (F.col("warehouse_available") <= k) & ~rlike0("item_sku_seasons", new_season))
    return small.select(F.col("name").alias("item"), F.col("warehouse_available").alias("quantity")).withColumns(
        transfer(as_of, season, source, to, f"TO-S2R{as_of:%y%m%d}", "Store Refill", by, to_type))


def store_only(erp: DataFrame, pos: DataFrame, season: str) -> DataFrame:
    """Items left only in the store, older seasons."""
    out = lookup(erp, pos, "name", {"quantity": "qty", "price": "price"}, unique=True)
    return out.filter((F.col("warehouse_available") <= 0) & (F.col("qty") > 0) & ~rlike0("item_sku_seasons", season)).select("name", "qty", "price")


def second_quality(erp: DataFrame, floor: int = 5) -> DataFrame:
    return erp.filter(rlike0("name", "^M[A-Z][A-Z][A-Z]-") & (F.col("warehouse_available") > floor))


def recount(first: DataFrame, others: Sequence[DataFrame]) -> DataFrame:
    """Count sheets matched on SKU: new quantity = later counts minus twice the first count.

    A blank count is 0; only SKUs on every sheet are reported; the book quantity is the first sheet's.
    """
    def counted(s: DataFrame, out: str) -> DataFrame:
        return s.select("sku", F.coalesce(F.col("new_qty").try_cast("double"), F.lit(0.0)).alias(out))

    out = first.select("sku", "quantity", F.coalesce(F.col("new_qty").try_cast("double"), F.lit(0.0)).alias("__c0"))
    names = []
    for i, s in enumerate(others, 1):
        out = out.join(counted(s, f"__c{i}"), "sku")
        names.append(f"__c{i}")
    new = reduce(lambda a, b: a + b, [F.col(n) for n in names]) - 2 * F.col("__c0")
    return out.select("sku", "quantity", new.alias("new_qty"))


def recount_differences(counts: DataFrame) -> DataFrame:
    """Counts that differ from the books, largest difference first (ties by SKU)."""
    off = counts.filter(F.col("new_qty") != F.col("quantity")).withColumn("diff", F.abs(F.col("quantity") - F.col("new_qty")))
    return sort_r(off, ["-diff", "sku"])


def combine_stock(a: DataFrame, b: DataFrame) -> DataFrame:
    """Quantity of both places, floored at 0; an item unknown to ``b`` has no known total."""
    out = lookup(a, b.withColumn("__b", F.coalesce("quantity", F.lit(0))), "name", {"__b": "__b", "price": "price"}, unique=True)
    total = F.coalesce("quantity", F.lit(0)) + F.col("__b")
    return out.withColumn("quantity", F.when(total < 0, 0).otherwise(total)).drop("__b")


def stock_discrepancy(start: DataFrame, end: DataFrame, moved_in: DataFrame, moved_out: DataFrame, sold: DataFrame,
                      low: float = -3, high: float = 5) -> DataFrame:
    """End stock against start + in - out - sold, where the gap leaves [low, high]; absent flows are 0."""
    def total(df: DataFrame, key: str) -> DataFrame:
        return df.groupBy(key).agg(F.sum("quantity").alias("q"))

    out = end.select("name", "quantity")
    for df, key, name in ((start, "name", "start"), (moved_in, "item", "moved_in"), (moved_out, "item", "moved_out"), (sold, "item", "sold")):
        out = lookup(out, total(df, key), {"name": key}, {"q": name}, unique="grouped").withColumn(name, F.coalesce(name, F.lit(0)))
    out = out.withColumn("quantity", F.coalesce("quantity", F.lit(0)))
    gap = F.col("quantity") - (F.col("start") + F.col("moved_in") - F.col("moved_out") - F.col("sold"))
    return out.withColumn("discrepancy", gap).filter((gap < low) | (gap > high))


def tpl_diff(tpl: DataFrame, erp: DataFrame) -> DataFrame:
    """ERP minus third-party stock where they differ; items the ERP lacks count 0."""
    out = lookup(tpl, erp, {"sku": "name"}, {"warehouse_available": "erp_qty"}, unique=True, defaults={"erp_qty": 0})
    return out.withColumn("diff", F.col("erp_qty") - F.col("current_atp")).filter(F.col("diff") != 0).select("sku", "current_atp", "erp_qty", "diff")


def tpl_log_rows(orders: DataFrame) -> DataFrame:
    """Third-party orders in the layout of the status log (``STATUS_LOG_HEADERS``)."""
    out = {
        "date": F.split("shipment_order_date", " ")[0], "order_id": F.col("extra_note_1"), "shipped_from": F.lit(LOG_WHOLE),
        "province": F.col("billing_state"), "total_qty": F.col("total_quantity"), "shipped_qty": F.col("total_quantity"), "auto_fr": F.lit(LOG_YES),
        "shipping_required": F.when(F.col("shipping_service") == "Cheapest Service", "").otherwise("Express"), "fr_created": F.lit(LOG_YES),
        "status": F.lit(None).cast("string"), "items": F.when(F.col("total_quantity") == 1, F.col("sku")).otherwise(""),
    }
    return orders.select(*[out[c].alias(c) for c in STATUS_LOG_HEADERS])


def tpl_upsert(log: DataFrame, synced: DataFrame, shipped: DataFrame) -> DataFrame:
    """Log with the status of known orders changed and unknown orders appended."""
    return upsert_status(log, "order_id", "status", [(tpl_log_rows(synced), STATUS_SYNCED), (tpl_log_rows(shipped), STATUS_SHIPPED)])


def tpl_refresh(log: VersionedTable, synced: DataFrame, shipped: DataFrame) -> int:
    """Bring the kept log up to date: read and replaced in one job, as one new version."""
    return log.replace(tpl_upsert(log.read(), synced, shipped))


def tpl_split_orders(orders: DataFrame) -> DataFrame:
    """Rows of sales orders fulfilled in more than one part, one per order code."""
    parts = orders.withColumns({"so": F.regexp_replace("order_code", "-.*", ""), "fr": F.regexp_replace("order_code", ".*-", "")})
    split = parts.groupBy("so").agg(F.min("fr").alias("a"), F.max("fr").alias("b")).filter(F.col("a") != F.col("b"))
    return first_per_key(semi(parts, split, "so"), "order_code", source_order(orders)).drop("so", "fr")


def fill_upc(df: DataFrame, master: DataFrame) -> DataFrame:
    return lookup(df, master, {"sku": "msku"}, {"upc_active": "upc"}, unique=True)


def refresh_event_items(items: DataFrame, stock: DataFrame, web: DataFrame) -> DataFrame:
    """Event sheet with fresh stock (a zero keeps the sheet's quantity), season and prices."""
    out = lookup(items, stock, {"sku": "name"}, {"warehouse_available": "__now", "item_sku_seasons": "seasons", "item_size": "size"}, unique=True)
    out = lookup(out, web, "sku", ["name", "regular_price", "sale_price"], unique=True)
    return out.withColumn("qty", F.when(F.col("__now").isNull(), F.lit(None)).when(F.col("__now") == 0, F.col("qty")).otherwise(F.col("__now"))).drop("__now")


def not_on_event(stock: DataFrame, items: DataFrame) -> DataFrame:
    return anti(stock.filter(F.col("warehouse_available") > 0), items, {"name": "sku"})


def source_request(req: DataFrame, erp: DataFrame, pos: DataFrame) -> DataFrame:
    """Where to take a requested SKU from: the warehouse (stock or order), the store, or the samples."""
    out = lookup(req.withColumn("sku", F.upper("sku")), erp, {"sku": "name"}, {"warehouse_available": "qty", "on_po": "on_po"}, unique=True)
    out = lookup(out, pos, {"sku": "name"}, {"quantity": "store_qty"}, unique=True)
    got = lambda c: F.coalesce(F.col(c), F.lit(0)) > 0
    return out.withColumn("source", F.when(got("qty") | got("on_po"), "Central").when(got("store_qty"), "Store").otherwise("Sample"))


def refresh_deals(deals: DataFrame, old_web: DataFrame, stock: DataFrame) -> DataFrame:
    """Long-running deals: missing sale prices from the old catalog, discount ratio, current stock."""
    out = lookup(deals, old_web, "sku", {"sale_price": "old_price"}, unique=True)
    out = lookup(out, stock, {"sku": "name"}, {"warehouse_available": "qty"}, unique=True, defaults={"qty": 0})
    out = out.withColumn("sale_price", F.coalesce("sale_price", "old_price"))
    off = F.bround(safe_div(F.col("regular_price") - F.col("sale_price"), "regular_price"), 2)
    return out.withColumn("discount", F.when(F.col("sale_price").isNull(), 0.0).otherwise(off))


def replace_stock(pos: DataFrame, snapshot: DataFrame, default: int | None = None) -> DataFrame:
    """Quantities of a snapshot in place of the current ones; items without one get ``default``."""
    return lookup(pos, snapshot, "name", ["quantity"], unique=True, defaults={"quantity": default} if default is not None else None)


def extend_event_list(event: DataFrame, stock: DataFrame, pos: DataFrame, prefixes: Sequence[str], new_season: str,
                      prices: Sequence[tuple[str, float]], default_price: float, any_season: Sequence[str] = ()) -> DataFrame:
    """Event list plus items chosen by prefix (older seasons; ``any_season`` prefixes regardless), priced by
    prefix, with current stock in both places; donor stock above 0 kept."""
    def starts(ps: Sequence[str]) -> Column:
        return reduce(lambda a, b: a | b, [F.col("name").startswith(p) for p in ps], F.lit(False))

    old = ~rlike0("item_sku_seasons", new_season)
    chosen = stock.filter((F.col("warehouse_available") > 0) & ((starts(prefixes) & old) | starts(any_season)))
    new = chosen.select(F.lit("Discontinued").alias("type"), F.col("name").alias("sku"),
                        apply_rules("name", [(p, float(v)) for p, v in prices], F.lit(float(default_price))).cast(MONEY).alias("sales_price"))
    out = event.select("type", "sku", F.col("sales_price").cast(MONEY).alias("sales_price")).unionByName(new)
    out = lookup(out, stock, {"sku": "name"}, {"warehouse_available": "central_qty", "item_sku_seasons": "seasons"}, unique=True)
    out = lookup(out, pos, {"sku": "name"}, {"quantity": "store_qty"}, unique=True)
    return out.filter(F.col("central_qty") > 0)


