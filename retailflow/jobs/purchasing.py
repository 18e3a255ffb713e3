"""Purchase orders, labels, third-party new items, fabric allocation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import (
    ORDER_REGIONS, PO_APPROVED, PO_CURRENCY, PO_REGULAR, PO_UNIFORM, PO_VENDOR, TAX_ZERO,
)
from ..functions import sku
from ..functions.semantics import clip0, not_blank, number
from ..operators.keys import first_per_key
from ..operators.lookup import anti, lookup, lookup_chain, semi
from ..operators.reshape import split_rows, unpivot_regions
from ..operators.scan import fill_down
from .pricing import first_barcode

PURCHASE_ORDER = ("po_type", "category", "season", "ref_no", "warehouse", "vendor", "currency", "order_date",
                  "order_placed_by", "approval_status", "due_date", "memo", "item", "quantity", "tax_code", "external_id")


def _po_constants(as_of: date, by: str) -> dict[str, Column]:
    return {"currency": F.lit(PO_CURRENCY), "order_date": F.lit(as_of.strftime("%m/%d/%Y")), "order_placed_by": F.lit(by),
            "approval_status": F.lit(PO_APPROVED), "tax_code": F.lit(TAX_ZERO)}


def due_date(ship: Column, days: int = 40) -> Column:
    return F.date_format(F.date_add(F.to_date(F.try_to_timestamp(ship, F.lit("yyyy.MM.dd"))), days), "MM/dd/yyyy")


def region_pos(requests: DataFrame, season_start: DataFrame, as_of: date, season: str, warehouses: Mapping[str, str],
               regions: Mapping[str, str] = ORDER_REGIONS, dashes: int = 1, by: str = "") -> DataFrame:
    """Factory order with one quantity column per region as ERP purchase orders, one per (order, region).

    Due date: the category's season start, else the ship date plus 40 days.
    """
    lines = requests.filter(sku.valid("sku", dashes))
    long = unpivot_regions(lines, ["po", "category", "vendor", "memo", "sku", "ship_date"], regions, ("region", "quantity"))
    long = long.withColumn("quantity", F.bround(F.col("quantity").cast("double"), 0).cast("int")).filter(F.col("quantity") > 0)
    starts = season_start.withColumn("due", F.date_format(F.to_date("arrival_date"), "MM/dd/yyyy"))
    long = lookup(long, starts, "category", {"due": "due_date"}, unique=True, defaults={"due_date": due_date(F.col("ship_date"))})
    places = F.create_map(*[F.lit(x) for kv in warehouses.items() for x in kv])
    ref = F.concat_ws("-", "po", "region")
    return long.withColumns({**_po_constants(as_of, by), "po_type": F.lit(PO_REGULAR), "season": F.lit(season), "ref_no": ref,
                             "external_id": ref, "warehouse": F.try_element_at(places, F.col("region")), "item": F.col("sku")}).select(*PURCHASE_ORDER)


def po_check(requests: DataFrame, stated: DataFrame, dashes: int = 1) -> DataFrame:
    """Per order: sum of lines against the stated total, category named against categories ordered."""
    lines = requests.filter(sku.valid("sku", dashes))
    got = lines.groupBy("po").agg(F.sum("total_qty").alias("line_total"), F.min("category").alias("category"),
                                  F.min(sku.category("sku")).alias("__lo"), F.max(sku.category("sku")).alias("__hi"))
    out = lookup(got, stated, "po", {"total_qty": "stated_total"}, unique=True)
    return out.select("po", "category", "line_total", "stated_total", (F.col("line_total") == F.col("stated_total")).alias("total_ok"),
                      ((F.col("__lo") == F.col("category")) & (F.col("__hi") == F.col("category"))).alias("category_ok"))


def _category_text(lines: DataFrame, col: str, by: Sequence[str] = ()) -> DataFrame:
    """Ordered categories of the lines as one text (distinct categories only reach the joining task)."""
    cats = lines.select(*by, sku.category(col).alias("__cat")).distinct()
    return cats.groupBy(*by).agg(F.expr("listagg(__cat, ' ') within group (order by __cat)").alias("category"))


def wholesale_po(requests: DataFrame, ref: str, po_type: str, season: str, warehouse: str, as_of: date, by: str = "") -> DataFrame:
    """Wholesale order from several sheets as one ERP purchase order; the category field lists all categories."""
    lines = requests.filter(sku.valid("sku", 2) & (F.coalesce("quantity", F.lit(0)) > 0))
    text = _category_text(requests.filter(sku.valid("sku", 2)), "sku").scalar()
    return lines.withColumns({**_po_constants(as_of, by), "po_type": F.lit(po_type), "season": F.lit(season), "ref_no": F.lit(ref),
                              "external_id": F.lit(ref), "warehouse": F.lit(warehouse), "vendor": F.lit(PO_VENDOR),
                              "memo": F.lit(f"{po_type} {season}"), "item": F.col("sku"), "due_date": due_date(F.col("ship_date")),
                              "category": text}).select(*PURCHASE_ORDER)


def uniform_po(order: DataFrame, ref: str, season: str, warehouse: str, due: date, as_of: date, by: str = "") -> DataFrame:
    lines = order.filter(sku.valid("sku_number", 2) & (F.col("quantity") > 0))
    return lines.withColumns({**_po_constants(as_of, by), "po_type": F.lit(PO_UNIFORM), "season": F.lit(season), "ref_no": F.lit(ref),
                              "external_id": F.lit(ref), "warehouse": F.lit(warehouse), "vendor": F.lit(PO_VENDOR),
                              "memo": F.lit(f"Uniform order for {season}"), "item": F.col("sku_number"),
                              "due_date": F.lit(due.strftime("%m/%d/%Y")), "category": _category_text(lines, "sku_number").scalar()}).select(*PURCHASE_ORDER)


def uniform_new_skus(order: DataFrame, items: DataFrame) -> DataFrame:
    lines = order.filter(sku.valid("sku_number", 2) & (F.col("quantity") > 0))
    return anti(lines, items, {"sku_number": "name"}).select("sku_number", "quantity")


def po_remaining(po: DataFrame, subtract_received: bool = False, open_only: bool = True) -> DataFrame:
    """Open quantity per purchase order line, never below 0."""
    lines = po.filter(not_blank("item"))
    if open_only:
        lines = lines.filter(F.col("status") != "Closed")
    left = number("quantity") - F.coalesce(number("quantity_on_shipments"), F.lit(0.0))
    if subtract_received:
        left = left - F.coalesce(number("quantity_fulfilled_received"), F.lit(0.0))
    return lines.withColumn("quantity_remain", clip0(left))


def tpl_new_skus(master: DataFrame, priced: DataFrame, cat_price: DataFrame, dims: DataFrame, tpl: DataFrame, season: str) -> DataFrame:
    """New-season SKUs the third-party warehouse does not hold: cost, barcode, dimensions (by category and size,
    else by the size without its trailing letter)."""
    log = fill_down(dims, ["category"], "_pos") if "_pos" in dims.columns else dims
    log = log.withColumn("category", F.regexp_replace("category", r"\(.*", "")).filter(F.col("size").isNotNull())
    log = first_per_key(split_rows(split_rows(log, "category", "/"), "size", "/"), ["category", "size"], ["length_in", "width_in", "height_in", "weight_lb"])
    out = anti(master.filter(F.col("seasons") == season), tpl, {"msku": "sku"})
    out = out.select(F.col("msku").alias("sku"), F.col("item_name").alias("description"), F.trim("category_sku").alias("cat"),
                     F.trim("size").alias("__size"), first_barcode(F.col("upc_active")).alias("upc"))
    out = out.withColumn("__short", F.regexp_replace("__size", "[A-Z]$", ""))
    out = lookup(out, priced, "sku", {"sale_price": "__own"}, unique=True, flag="__on_web")
    out = lookup(out, cat_price, "cat", {"price": "__cat_price"}, unique=True)
    out = out.withColumn("cost", F.when(F.col("__on_web"), F.col("__own")).otherwise(F.col("__cat_price")))
    sizes = {f"{c}_in": c for c in ("length", "width", "height")} | {"weight_lb": "weight"}
    out = lookup_chain(out, [(log, {"cat": "category", "__size": "size"}), (log, {"cat": "category", "__short": "size"})], sizes, unique=True)
    return out.select("sku", "description", "cost", F.lit(0).alias("min_qty"), "upc", *[F.bround(c, 2).alias(c) for c in sizes.values()])


def label_rows(orders: DataFrame, master: DataFrame) -> DataFrame:
    """Label data of ordered SKUs; written one folder per category."""
    lines = orders.withColumn("sku", F.trim("sku")).filter(not_blank("sku") & (F.col("total_order") != 0))
    out = lookup(lines, master, {"sku": "msku"}, {"category_sku": "category", "print_name": "print_name", "size": "size", "upc_active": "__upc"}, unique=True)
    return out.select("po", "sku", "print_name", "category", "size", F.regexp_replace("__upc", "/.*", "").alias("upc"), "design_version")


def label_zero(orders: DataFrame, master: DataFrame) -> DataFrame:
    """New designs listed with quantity 0, carrying a barcode and ordered nowhere."""
    lines = orders.withColumn("sku", F.trim("sku")).filter(not_blank("sku"))
    zero = lines.filter((F.col("total_order") == 0) & F.coalesce(F.col("design_version").contains("NEW"), F.lit(False)))
    zero = lookup(anti(zero, lines.filter(F.col("total_order") != 0), "sku"), master, {"sku": "msku"}, {"upc_active": "upc", "category_sku": "category"}, unique=True)
    return zero.filter(F.col("upc").isNotNull()).select("po", "sku", "category", "upc", "design_version")


def allocate_fabric(items: DataFrame, fabric: DataFrame, usage: DataFrame, skip_sizes: Sequence[str] = (), master: DataFrame | None = None) -> DataFrame:
    """Pieces per size from leftover fabric of a print: fabric x size share / cost-weighted shares of the print.

    ``check`` is the fabric the print's pieces use; with the master its status and print names stand beside each item.
    """
    out = semi(items, fabric, {"item_category_sku": "category", "item_print_sku": "print"}).filter(~F.coalesce(F.col("item_size").isin(list(skip_sizes)), F.lit(False)))
    out = lookup(out, fabric, {"item_category_sku": "category", "item_print_sku": "print"}, {"length": "fabric"}, unique=True)
    out = lookup(out, usage, {"item_category_sku": "category", "item_size": "size"}, ["cost_m", "size_r"], unique=True)
    if master is not None:
        out = lookup(out, master, {"name": "msku"}, {"msku_status": "status", "print_name": "print_name", "print_chinese": "print_chinese"}, unique=True)
    out = out.withColumn("__w", F.col("cost_m") * F.col("size_r"))
    of_print = ["item_category_sku", "item_print_sku"]
    # the pieces of a size follow from the print's total, so the print's use follows from its distinct sizes
    sizes = out.groupBy(*of_print, "fabric", "cost_m", "size_r").agg(F.count(F.lit(1)).alias("__n"))
    weight = sizes.groupBy(*of_print).agg(F.sum(F.col("__n") * F.col("cost_m") * F.col("size_r")).alias("__w"))
    pieces = F.bround(F.try_divide(F.col("fabric") * F.col("size_r"), F.col("total_weight")), 0).cast("int")
    use = lookup(sizes, weight, of_print, {"__w": "total_weight"}, unique="grouped").groupBy(*of_print).agg(
        F.max("total_weight").alias("total_weight"), F.sum(F.col("__n") * F.col("cost_m") * pieces).alias("check"))
    return lookup(out, use, of_print, ["total_weight", "check"], unique="grouped").withColumn("quantity", pieces).drop("__w")


def checklist(folders: DataFrame) -> DataFrame:
    """Pre-production list (order, category, factory) from parsed folder names."""
    return folders.filter(not_blank("po")).select("category", F.col("vendor").alias("factory"), "po")
