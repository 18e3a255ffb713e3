"""Inbound shipments: packing lists, weights, purchase order matching, over-receipt, receiving."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import PO_APPROVED, PO_CURRENCY, PO_MIXED, PO_OVER, PO_VENDOR, REASON_COUNT, TAX_ZERO
from ..functions import sku
from ..functions.semantics import clip0, number, rlike0, safe_div
from ..operators.groups import collapse, total_row, with_group_total
from ..operators.keys import first_per_key, source_order, union_prefer
from ..operators.lookup import lookup
from ..operators.scan import fill_down
from ..schemas import SHIPMENT_HEADERS, TRANSFER_HEADERS
from ..session import SharedFrames, kept
from .stock import transfer


def grams(c: str):
    """Unit weight in whole grams; figures below 10 are kilograms."""
    w = number(c)
    return F.when(w < 10, F.bround(w * 1000, 0)).otherwise(F.bround(w, 0))


def normalise_packing(lines: DataFrame, fill=("po", "season")) -> DataFrame:
    """Packing lines of both layouts as one row per (box, SKU).

    Blank order cells take the value above them inside their sheet; a line is either one named carton or a
    range of cartons each holding the per-box quantity.
    """
    kept = lines.filter(rlike0("sku", "-"))
    kept = fill_down(kept, [*fill, "ctn_start", "ctn_end", "ctn_no"], "_pos", ["sheet"])
    single = F.col("ctn_start").isNull()
    boxes = F.when(single, F.array(F.lit(None).cast("int"))).otherwise(F.sequence("ctn_start", "ctn_end"))
    out = kept.withColumn("__n", F.explode(boxes))
    return out.select(
        "sheet", "sheet_name", F.concat(F.col("sheet").cast("string"), F.lit("-"), F.when(single, F.col("ctn_no")).otherwise(F.col("__n").cast("string"))).alias("box_no"),
        "po", "season", "sku", F.when(single, F.col("qty_shipped")).otherwise(F.col("qty_per_box")).alias("quantity"), grams("unit_weight").alias("unit_weight_g"),
        F.bround("gross_weight_per_ctn", 2).alias("gross_weight"), "_pos", F.coalesce("__n", F.lit(0)).alias("_box_seq"))


def unit_weight(manual: DataFrame, master: DataFrame) -> DataFrame:
    """Unit weights in grams: manual checks first, the sample weight for what was never checked."""
    samples = master.filter(F.col("size").isNotNull() & F.col("category").isNotNull()).select(
        "category", "size", F.bround("sample_weight_g", 0).alias("unit_weight"))
    return union_prefer(manual.select("category", "size", "unit_weight"), samples, ["category", "size"])


def box_weight(lines: DataFrame, weights: DataFrame, shared: SharedFrames | None = None) -> DataFrame:
    """Estimated kilograms per box (1 kg of carton) by the packing list's and by the reference weights."""
    out = lines.withColumns({"__cat": sku.category("sku"), "__size": sku.size_tail("sku")})
    out = lookup(out, weights, {"__cat": "category", "__size": "size"}, {"unit_weight": "unit_weight_ref"}, unique=True).drop("__cat", "__size")
    kilos = lambda c: F.bround(F.sum(F.col("quantity") * F.col(c)).cast("decimal(18,3)") / 1000 + 1, 2).cast("double")
    return with_group_total(kept(out, shared, "box_lines"), "box_no", {"est_weight": kilos("unit_weight_g"), "est_weight_ref": kilos("unit_weight_ref")})


def resolve_po(lines: DataFrame, po: DataFrame, suffix: str = "-CA") -> DataFrame:
    """Purchase order reference with the region suffix, else without it; ``document`` is null when neither exists."""
    ends = F.col("ref_no").endswith(suffix)
    docs = po.withColumn("__base", F.when(ends, F.expr(f"substring(ref_no, 1, length(ref_no) - {len(suffix)})")).otherwise(F.col("ref_no")))
    docs = docs.groupBy("__base").agg(
        F.min(F.when(ends, F.struct("ref_no", "document_number"))).alias("__with"), F.min(F.when(~ends, F.struct("ref_no", "document_number"))).alias("__bare"))
    out = lookup(lines, docs, {"po": "__base"}, ["__with", "__bare"], unique="grouped")
    found = F.coalesce("__with", "__bare")
    return out.withColumns({"document": found["document_number"], "po_ref": F.coalesce(found["ref_no"], F.col("po"))}).drop("__with", "__bare")


def collapse_shipment(lines: DataFrame, order=("_pos", "_box_seq")) -> DataFrame:
    """One row per (purchase order, item): quantity and the list of all its boxes."""
    rows = lines.withColumn("item", sku.unversioned("sku"))
    return collapse(rows, ["po_ref", "item"], list(order), " | ", {"box_no": "box_no"}, {"quantity": "quantity"}, {"document": "document"})


def over_received(ship: DataFrame, open_po: DataFrame) -> DataFrame:
    """Shipment rows beyond the open quantity, with the surplus; an unknown line has nothing open."""
    out = lookup(ship, open_po, {"po_ref": "ref_no", "item": "item"}, ["quantity_remain"], unique=True, defaults={"quantity_remain": 0.0})
    out = out.withColumn("quantity_remain", F.coalesce("quantity_remain", F.lit(0.0)))
    return out.withColumn("over", F.col("quantity") - F.col("quantity_remain")).filter(F.col("over") > 0)


def over_receipt_po(over: DataFrame, shipment: str, season: str, as_of: date, due: date, warehouse: str, by: str = "") -> DataFrame:
    """Purchase order rows for the surplus, one per item."""
    text = lambda d: F.lit(d.strftime("%m/%d/%Y"))
    ref = F.lit(f"Over.{shipment}")
    return over.groupBy("item").agg(F.sum("over").alias("quantity")).select(
        F.lit(PO_OVER).alias("po_type"), F.lit(PO_MIXED).alias("category"), F.lit(season).alias("season"), ref.alias("ref_no"),
        F.lit(warehouse).alias("warehouse"), F.lit(PO_VENDOR).alias("vendor"), F.lit(PO_CURRENCY).alias("currency"), text(as_of).alias("order_date"),
        F.lit(by).alias("order_placed_by"), F.lit(PO_APPROVED).alias("approval_status"), text(due).alias("due_date"),
        F.lit(f"Over receiving in shipment {shipment}").alias("memo"), "item", "quantity", F.lit(TAX_ZERO).alias("tax_code"), ref.alias("external_id"))


def split_over_receipt(ship: DataFrame, open_po: DataFrame, shipment: str, over_po: str) -> DataFrame:
    """Shipment capped at the open quantity plus the surplus under the over-receipt order.

    Known orders keep min(shipped, open); surplus rows carry ``over_po``; zero rows are dropped.
    """
    out = lookup(ship, open_po, {"po_ref": "ref_no", "item": "item"}, {"quantity_remain": "__open"}, unique=True)
    open_qty = F.coalesce("__open", F.lit(0.0))
    known = F.when(F.col("document").isNotNull(), F.least("quantity", open_qty)).otherwise(0.0)
    parts = F.array(
        F.struct(F.col("po_ref").alias("po_ref"), known.alias("quantity"), F.col("document").alias("document")),
        F.struct(F.lit(f"Over.{shipment}").alias("po_ref"), F.greatest(F.col("quantity") - open_qty, F.lit(0.0)).alias("quantity"), F.lit(over_po).alias("document")))
    rows = out.select("item", "box_no", F.explode(parts).alias("p")).select("item", "box_no", "p.*").filter(F.col("quantity") != 0)
    # one row per (purchase order, item) here: an item has at most as many rows as there are orders
    return collapse(rows.withColumn("__pos", F.lit(0)), ["po_ref", "item"], ["__pos", "box_no"], " | ", {"box_no": "box_no"}, {"quantity": "quantity"}, {"document": "document"})


def shipment_upload(receipt: DataFrame, ref_no: str, ships: date, arrives: date, memo: str, location: str, amz_shipment: str = "") -> DataFrame:
    """Shipment file (``SHIPMENT_HEADERS``) of what ``split_over_receipt`` leaves: one row per (purchase order, item)."""
    text = lambda d: F.lit(d.strftime("%m/%d/%Y"))
    out = receipt.withColumns({"ref_no": F.lit(ref_no), "expected_shipping_date": text(ships), "expected_delivery_date": text(arrives), "memo": F.lit(memo),
                               "location": F.lit(location), "amz_shipment_id": F.lit(amz_shipment)})
    return out.select(*SHIPMENT_HEADERS)


def reserve_transfer(lines: DataFrame, prefix: str, as_of: date, shipment: str, season: str = "", source: str = "WH-CN", to: str = "WH-CENTRAL",
                     ref_no: str = "", by: str = "", to_type: str = "China-Central") -> DataFrame:
    """Items on reserve sheets as a transfer order (``TRANSFER_HEADERS``), one row per item; its memo is the shipment."""
    rows = lines.filter(F.col("sheet_name").contains(prefix)).groupBy(sku.unversioned("sku").alias("item")).agg(F.sum("quantity").alias("quantity"))
    return rows.filter(F.col("quantity") > 0).withColumns(
        transfer(as_of, season, source, to, ref_no or f"TO-{shipment}", shipment, by, to_type)).select(*TRANSFER_HEADERS)


def reserve_shortfall(transfer: DataFrame, stock: DataFrame, shipment: str, warehouse: str, as_of: date) -> DataFrame:
    """Adjustment that books the stock a transfer needs and the reserve lacks."""
    out = lookup(transfer, stock, {"item": "name"}, {"warehouse_available": "__have"}, unique=True, defaults={"__have": 0})
    out = out.withColumn("adjust_qty_by", F.col("quantity") - F.coalesce("__have", F.lit(0))).filter(F.col("adjust_qty_by") > 0)
    return out.select(F.lit(as_of.strftime("%m/%d/%Y")).alias("date"), "item", "adjust_qty_by", F.lit(REASON_COUNT).alias("reason_code"),
                      F.lit(f"{shipment} Reserve TO").alias("memo"), F.lit(warehouse).alias("warehouse"), F.lit(f"IAC-{as_of:%y%m%d}-1").alias("external_id"))


def check_totals(lines: DataFrame, summary: DataFrame) -> DataFrame:
    """Packed quantity and boxes against the summary's last row."""
    want = total_row(summary, "_pos")
    got = lines.agg(F.sum("quantity").alias("qty"), F.count_distinct("box_no").alias("boxes"))
    out = got.select("qty", "boxes", want.select("qty").scalar().alias("stated_qty"), want.select("number_of_box").scalar().alias("stated_boxes"))
    return out.withColumns({"qty_ok": F.col("qty") == F.col("stated_qty"), "boxes_ok": F.col("boxes") == F.col("stated_boxes")})


def receiving_by_box(lines: DataFrame) -> DataFrame:
    """Receiving sheet: one row per (box, SKU)."""
    return lines.select(F.regexp_replace("box_no", "-.*", "").alias("sheet_number"), F.regexp_replace("box_no", ".*-", "").alias("box_number"), "sku",
                        F.col("quantity").alias("packing_slip_qty"), "gross_weight", "est_weight", "est_weight_ref")


def receiving(ship: DataFrame, shipment_id: str) -> DataFrame:
    """Receipt file: one row per (purchase order, item)."""
    return ship.select(F.lit(shipment_id).alias("id"), F.regexp_replace("document", "^PO#", "").alias("po"), "item", F.col("quantity").alias("qty"))


def customer_inbound(ship: DataFrame, ordered: DataFrame, stock: DataFrame) -> DataFrame:
    """Customer order lines with what the shipment and the stock leave missing."""
    came = ship.groupBy("item").agg(F.sum("quantity").alias("shipped"))
    out = lookup(ordered, came, "item", ["shipped"], unique="grouped", defaults={"shipped": 0})
    out = lookup(out, stock, {"item": "name"}, {"warehouse_available": "available"}, unique=True, defaults={"available": 0})
    return out.withColumn("missing", clip0(F.col("quantity") - F.col("shipped") - F.col("available")))


def measured_weights(measured: DataFrame, boxes: DataFrame) -> DataFrame:
    """Measured box weights beside both estimates of the same (SKU, box)."""
    est = ["unit_weight_g", "unit_weight_ref", "est_weight", "est_weight_ref"]
    out = lookup(measured, boxes, {"sku": "sku", "box_number": "box_no"}, est, order=est)
    kilos = F.col("total_weight_g").cast("decimal(14,3)") * F.lit(Decimal("0.001"))
    off = {"diff": "est_weight", "diff_ref": "est_weight_ref"}
    return out.withColumns({d: kilos - F.col(e).cast("decimal(14,2)") for d, e in off.items()})


def weights_to_update(weights: DataFrame) -> DataFrame:
    """SKUs whose reference weight is further off than the packing list's."""
    off = weights.filter(F.abs("diff_ref") > F.abs("diff"))
    return first_per_key(off, "sku", source_order(weights)).withColumns({"category": sku.category("sku"), "size": sku.size_tail("sku")})


def weight_check(weights: DataFrame, tolerance: float | None = 0.5) -> DataFrame:
    """Boxes off by more than the tolerance under both estimates (``None``: by more than one piece)."""
    if tolerance is not None:
        return weights.filter((F.abs("diff_ref") > tolerance) & (F.abs("diff") > tolerance))
    return weights.filter((F.abs("diff_ref") > F.col("unit_weight_ref") / 1000) & (F.abs("diff") > F.col("unit_weight_g") / 1000))


def weight_check_sizes(off: DataFrame) -> DataFrame:
    """Mean deviation per category and size."""
    return off.groupBy(sku.category("sku").alias("category"), sku.size_tail("sku").alias("size")).agg(
        F.count(F.lit(1)).alias("n"), safe_div(F.sum("diff"), F.count("diff")).alias("diff"), safe_div(F.sum("diff_ref"), F.count("diff_ref")).alias("diff_ref"))
