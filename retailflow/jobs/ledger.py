"""Purchase order ledger: plan against shipments per order, SKU and region."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import LEDGER_REGIONS
from ..functions import sku
from ..functions.semantics import safe_div
from ..operators.keys import first_per_key
from ..operators.lookup import lookup
from ..operators.reshape import unpivot_regions

TOTAL = "Total"


def factory_by_category(factories: DataFrame, factory_cols: Sequence[str]) -> DataFrame:
    """Wide factory sheet (a column per factory listing its categories) as category -> factory.

    A category listed twice belongs to the factory of its last column.
    """
    long = factories.select(*factory_cols).unpivot([], list(factory_cols), "factory", "category").filter(F.col("category").isNotNull())
    place = F.array_position(F.array(*[F.lit(c) for c in factory_cols]), F.col("factory"))
    return first_per_key(long, "category", [place.desc()])


def plan_lines(requests: DataFrame, regions: Mapping[str, str] = LEDGER_REGIONS) -> DataFrame:
    """Planned quantity per (order, SKU, region) with a Total region."""
    lines = requests.filter(F.col("sku").contains("-")).withColumn("sku", F.trim("sku"))
    columns = {"total_qty": TOTAL, **regions}
    # summed while the regions are columns: a row per order and SKU is hashed and moved, not one per region
    wide = lines.groupBy("po", "sku").agg(*[F.sum(c).alias(c) for c in columns])
    return unpivot_regions(wide, ["po", "sku"], columns, ("region", "plan"))


def open_ledger(requests: DataFrame, master: DataFrame, factories: DataFrame | None = None,
                regions: Mapping[str, str] = LEDGER_REGIONS) -> DataFrame:
    """The plan with season, category and factory; remaining starts at the plan."""
    out = plan_lines(requests, regions)
    out = lookup(out.withColumn("__up", F.upper("sku")), master.withColumn("__up", F.upper("msku")), "__up", {"seasons": "seasons"}, order=["msku"]).drop("__up")
    out = out.withColumns({"category": sku.category("sku"), "remaining": F.col("plan")})
    return lookup(out, factories, "category", ["factory"], unique=True) if factories is not None else out


def stated_totals(ledger: DataFrame, stated: DataFrame) -> DataFrame:
    """The ledger with each order's stated total and whether its lines add up to it (null for an order without one)."""
    sums = ledger.filter(F.col("region") == TOTAL).groupBy("po").agg(F.sum("plan").alias("line_total"))
    out = lookup(ledger, sums, "po", ["line_total"], unique="grouped")
    out = lookup(out, stated, "po", {"total_qty": "stated_total"}, unique=True)
    return out.withColumn("total_ok", F.coalesce("line_total", F.lit(0)) == F.col("stated_total"))


def totals_hold() -> dict[str, tuple[Column, object]]:
    """For ``write_checked``: ledger lines of orders that miss their stated total, counted while the ledger is written."""
    return {"lines_off": (F.count_if(~F.col("total_ok")), 0)}


def ledger_subtotals(ledger: DataFrame, measures: Sequence[str] = ("plan", "remaining")) -> DataFrame:
    """Ledger lines plus one subtotal per order and region."""
    out = ledger.groupingSets([["po", "region", "sku"], ["po", "region"]], "po", "region", "sku").agg(
        *[F.sum(m).alias(m) for m in measures], F.grouping("sku").alias("__order"))
    order = F.col("__order") == 1
    return out.withColumns({"sku": F.when(order, F.lit("")).otherwise(F.col("sku")), "level": F.when(order, F.lit("order")).otherwise(F.lit("line"))}).drop("__order")


def remaining_percent(remaining: Column, plan: Column) -> Column:
    """Open share in percent; an empty plan is 0% open."""
    return F.when(plan == 0, 0.0).otherwise(safe_div(remaining, plan) * 100)


def apply_shipments(ledger: DataFrame, shipments: DataFrame) -> DataFrame:
    """Remaining = plan - everything shipped, per line and per order (idempotent: always from the plan).

    ``shipments`` (po, sku, region, quantity) reduce the line's Total and its region; shipped (order, SKU)
    pairs without a plan are appended.  ``flag`` marks lines more than 1.0% open or more than 10.0% overshipped, the
    percentage read with one decimal: 1.05 reads as 1.1 (the number nearest to it lies above), likewise -10.05.
    """
    regions = F.explode(F.array_distinct(F.array(F.col("region"), F.lit(TOTAL))))
    plan = ledger.select("po", "sku", "region", F.col("plan").cast("bigint").alias("plan"), F.lit(0).cast("bigint").alias("shipped"), F.lit(1).alias("planned"))
    moved = shipments.select("po", "sku", regions.alias("region"), F.lit(0).cast("bigint").alias("plan"), F.col("quantity").cast("bigint").alias("shipped"), F.lit(0).alias("planned"))
    # lines and orders in one aggregation
    out = plan.unionByName(moved).groupingSets([["po", "region", "sku"], ["po", "region"]], "po", "region", "sku").agg(
        F.sum("plan").alias("plan"), F.sum("shipped").alias("shipped"), (F.max("planned") == 0).alias("unplanned"), F.grouping("sku").alias("__order"))
    out = out.withColumns({"sku": F.when(F.col("__order") == 1, F.lit("")).otherwise(F.col("sku")),
                           "level": F.when(F.col("__order") == 1, F.lit("order")).otherwise(F.lit("line"))}).drop("__order")
    out = out.withColumn("remaining", F.col("plan") - F.col("shipped"))
    out = out.withColumn("percent", remaining_percent(F.col("remaining"), F.col("plan")))
    return out.withColumn("flag", (F.col("percent") >= 1.05) | (F.col("percent") <= -10.05))


def manifest_to_po(manifest: DataFrame, master: DataFrame, po_map: DataFrame, region_alias: str = "fbasku_de",
                   fallback_alias: str = "fbasku_us", order: str = "_pos") -> DataFrame:
    """Fulfilment manifest to (order, SKU): merchant SKU by the regional alias (else the fallback alias, else the
    SKU itself), else without its suffix; the order by category.  Of several rows with one alias, or of one category,
    the last by ``order`` decides."""
    alias = F.coalesce(region_alias, fallback_alias, F.upper("msku"))
    names = first_per_key(master.select(alias.alias("__alias"), F.upper("msku").alias("sku"), order), "__alias", [F.desc(order)])
    out = lookup(manifest, names, {"merchant_sku": "__alias"}, {"sku": "__sku"}, unique="grouped")
    out = out.withColumn("sku", F.coalesce("__sku", F.regexp_replace("merchant_sku", "-A.*", "")))
    cats = first_per_key(po_map.select(sku.category("sku").alias("cat"), F.regexp_replace("po", "-.*", "").alias("po"), order), "cat", [F.desc(order)])
    out = lookup(out.withColumn("cat", sku.category("sku")), cats, "cat", ["po"], unique="grouped")
    return out.groupBy("po", "sku").agg(F.sum("quantity").alias("quantity"))
