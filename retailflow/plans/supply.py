"""Purchasing, inbound and ledger jobs as queries."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from ..jobs import inbound, ledger, pricing, purchasing, stock
from ..operators.lookup import lookup
from ..sources.readers import parse_folder_name
from .catalog_prices import CATS, EXTRA, NOW, WEB
from .registry import AS_OF, cat, half_even, query, renamed

DAY, YMD = AS_OF.strftime("%m/%d/%Y"), AS_OF.strftime("%y%m%d")
PO_CONST = f"'CAD' AS currency, '{DAY}' AS order_date, 'ops' AS order_placed_by, 'APPROVED' AS approval_status, 'CA-Zero' AS tax_code"
DUE = "strftime(cast(replace(ship_date, '.', '-') as date) + 40, '%m/%d/%Y')"
PLACES = {"CA": "WH-CENTRAL", "UK": "FBA-UK", "DE": "FBA-DE", "AU": "FBA-AU", "JP": "FBA-JP", "CN": "WH-CN"}


@query("region_po", f"""
    SELECT 'Regular' AS po_type, category, '26F' AS season, po || '-' || r.region AS ref_no, CASE r.region WHEN 'CA' THEN 'WH-CENTRAL' WHEN 'CN' THEN 'WH-CN' ELSE 'FBA-' || r.region END AS warehouse, vendor, {PO_CONST},
      CASE category WHEN 'B3' THEN '06/01/2025' WHEN 'B4' THEN NULL ELSE {DUE} END AS due_date, memo, sku AS item, r.qty AS quantity, po || '-' || r.region AS external_id
    FROM s_request, LATERAL (VALUES ('CA', qty_ca), ('UK', qty_uk), ('DE', qty_de), ('AU', qty_au), ('JP', qty_jp), ('CN', qty_cn)) AS r(region, qty) WHERE r.qty > 0""")
def _(t):
    starts = t.s_sku.select(renamed("cat", F.col("cat").isin("B3", "B4")).alias("category")).distinct().withColumn(
        "arrival_date", F.when(F.col("category") == "B3", "2025-06-01"))
    return purchasing.region_pos(t.s_request, starts, AS_OF, "26F", PLACES, by="ops")


@query("po_check", f"""
    WITH g AS (SELECT po, sum(total_qty)::BIGINT AS line_total, min(category) AS category, min({cat('sku')}) AS lo, max({cat('sku')}) AS hi FROM s_request GROUP BY 1)
    SELECT po, category, line_total, line_total + CASE WHEN po LIKE '%3' THEN 1 ELSE 0 END AS stated_total, CASE WHEN po LIKE '%3' THEN 0 ELSE 1 END AS total_ok,
      CASE WHEN lo = category AND hi = category THEN 1 ELSE 0 END AS category_ok FROM g""")
def _(t):
    stated = t.s_request.groupBy("po").agg((F.sum("total_qty") + F.max(F.when(F.col("po").endswith("3"), 1).otherwise(0))).alias("total_qty"))
    return purchasing.po_check(t.s_request, stated)


@query("wholesale_po", f"""
    WITH c AS (SELECT string_agg(c, ' ' ORDER BY c) AS text FROM (SELECT DISTINCT {cat('sku')} AS c FROM s_request))
    SELECT 'CA-Partner' AS po_type, (SELECT text FROM c) AS category, '26F' AS season, 'P668' AS ref_no, 'WH-CENTRAL' AS warehouse, 'China' AS vendor, {PO_CONST}, {DUE} AS due_date,
      'CA-Partner 26F' AS memo, sku AS item, qty_wholesale AS quantity, 'P668' AS external_id FROM s_request WHERE qty_wholesale > 0""")
def _(t):
    return purchasing.wholesale_po(t.s_request.withColumn("quantity", F.col("qty_wholesale")), "P668", "CA-Partner", "26F", "WH-CENTRAL", AS_OF, "ops")


UNIFORM = "SELECT CASE WHEN p_partkey % 6 = 0 THEN p_name ELSE sku END AS sku_number, cast(p_size % 4 as int) AS quantity FROM s_sku"


@query("uniform_po", f"""
    WITH u AS ({UNIFORM}), l AS (SELECT * FROM u WHERE regexp_matches(sku_number, '-.*-') AND quantity > 0), c AS (SELECT string_agg(c, ' ' ORDER BY c) AS text FROM (SELECT DISTINCT {cat('sku_number')} AS c FROM l))
    SELECT 'Daycare Uniforms' AS po_type, (SELECT text FROM c) AS category, '26F' AS season, 'U26F' AS ref_no, 'WH-CENTRAL' AS warehouse, 'China' AS vendor, {PO_CONST}, '08/20/2026' AS due_date,
      'Uniform order for 26F' AS memo, sku_number AS item, quantity, 'U26F' AS external_id FROM l""")
def _(t):
    return purchasing.uniform_po(t.sql(UNIFORM), "U26F", "26F", "WH-CENTRAL", date(2026, 8, 20), AS_OF, "ops")


@query("uniform_new_skus", f"""
    WITH u AS ({UNIFORM}) SELECT sku_number, quantity FROM u WHERE regexp_matches(sku_number, '-.*-') AND quantity > 0 AND sku_number NOT IN (SELECT name || CASE WHEN warehouse_available > 10 THEN '' ELSE '?' END FROM s_erp)""")
def _(t):
    return purchasing.uniform_new_skus(t.sql(UNIFORM), t.s_erp.withColumn("name", F.concat("name", F.when(F.col("warehouse_available") > 10, "").otherwise("?"))))


@query("po_remaining", """
    SELECT ref_no, item, warehouse, greatest(quantity - coalesce(quantity_on_shipments, 0.0), 0.0) AS quantity_remain FROM s_po""")
def _(t):
    return purchasing.po_remaining(t.s_po).select("ref_no", "item", "warehouse", "quantity_remain")


@query("po_remaining_received", """
    SELECT ref_no, item, warehouse, greatest(quantity - coalesce(quantity_on_shipments, 0.0) - quantity_fulfilled_received, 0.0) AS quantity_remain FROM s_po""")
def _(t):
    return purchasing.po_remaining(t.s_po, subtract_received=True).select("ref_no", "item", "warehouse", "quantity_remain")


NEW_SKU = f"""{WEB}, {CATS}, m AS (SELECT msku AS sku, item_name, category_sku AS c, CASE WHEN length(size) % 2 = 0 THEN size || 'M' ELSE size END AS size, upc_active, seasons FROM s_master),
    dims AS (SELECT c, cast(z as varchar) || 'T' AS size, z + 0.125 AS l, z * 0.5 AS w FROM (SELECT DISTINCT cat AS c FROM s_sku), (SELECT unnest(generate_series(1, 39)) AS z)
      UNION ALL SELECT c, cast(z as varchar), z + 0.125, z * 0.5 FROM (SELECT DISTINCT cat AS c FROM s_sku), (SELECT unnest(generate_series(1, 39)) AS z))"""


@query("tpl_new_skus", f"""
    WITH {NEW_SKU}, x AS (SELECT m.*, CASE WHEN p.sku IS NOT NULL THEN p.sale_price ELSE k.price END AS cost, CASE WHEN a.size IS NOT NULL THEN a.l ELSE b.l END AS l, CASE WHEN a.size IS NOT NULL THEN a.w ELSE b.w END AS w
      FROM m LEFT JOIN priced p ON p.sku = m.sku LEFT JOIN cats k ON k.cat = m.c LEFT JOIN dims a ON a.c = m.c AND a.size = m.size LEFT JOIN dims b ON b.c = m.c AND b.size = regexp_replace(m.size, '[A-Z]$', '')
      WHERE m.seasons = '25F' AND m.sku NOT IN (SELECT name FROM s_erp WHERE inventory_warehouse = 'WH-3PL' AND warehouse_available > 20))
    SELECT sku, item_name AS description, cast(cost as double) AS cost, 0 AS min_qty, regexp_replace(upc_active, '[ /|].*', '') AS upc, cast({half_even('cast(l * 1000 as hugeint)', '10')} as double) / 100 AS length,
      cast(w as double) AS width, cast({half_even('cast(l * 1000 as hugeint)', '10')} as double) / 100 AS height, cast(w as double) AS weight FROM x""")
def _(t):
    priced = pricing.effective_price(t.s_web, NOW)
    m = t.s_master.withColumn("size", F.when(F.length("size") % 2 == 0, F.concat("size", F.lit("M"))).otherwise(F.col("size")))
    cats = t.s_sku.select("cat").distinct()
    z = cats.select("cat", F.explode(F.sequence(F.lit(1), F.lit(39))).alias("z"))
    dims = z.select(
        (F.substring("cat", 2, 5).cast("bigint") * 100 + F.col("z")).alias("_pos"), F.when(F.col("z") == 1, F.concat("cat", F.lit("(all)"))).alias("category"),
        F.concat(F.col("z").cast("string"), F.lit(" / "), F.col("z").cast("string"), F.lit("T")).alias("size"), (F.col("z") + 0.125).alias("length_in"), (F.col("z") * 0.5).alias("width_in"),
        (F.col("z") + 0.125).alias("height_in"), (F.col("z") * 0.5).alias("weight_lb"))
    tpl = stock.warehouse_stock(t.s_erp, "WH-3PL").filter("warehouse_available > 20").select(F.col("name").alias("sku"))
    return purchasing.tpl_new_skus(m, priced, pricing.category_price(priced, EXTRA), dims, tpl, "25F")


ORDERED = """SELECT po, case when l % 9 = 0 then ' ' || sku || ' ' else sku end AS sku, case when l % 4 = 0 or sku like 'B8-%' then 0 else total_qty end AS total_order, case when l % 3 = 0 then 'NEW v1' else 'v2' end AS design_version
    FROM (SELECT po, sku, total_qty, length(sku) + total_qty AS l FROM s_request) x"""


@query("label_rows", f"""
    WITH o AS ({ORDERED}) SELECT po, trim(o.sku) AS sku, m.print_name, m.category_sku AS category, m.size, regexp_replace(m.upc_active, '/.*', '') AS upc, design_version
    FROM o LEFT JOIN s_master m ON m.msku = trim(o.sku) WHERE total_order <> 0""")
def _(t):
    return purchasing.label_rows(t.sql(ORDERED), t.s_master)


@query("label_zero", f"""
    WITH o AS ({ORDERED}) SELECT po, trim(o.sku) AS sku, m.category_sku AS category, m.upc_active AS upc, design_version FROM o JOIN s_master m ON m.msku = trim(o.sku)
    WHERE total_order = 0 AND contains(design_version, 'NEW') AND trim(o.sku) NOT IN (SELECT trim(sku) FROM o WHERE total_order <> 0)""")
def _(t):
    return purchasing.label_zero(t.sql(ORDERED), t.s_master)


@query("checklist", """
    SELECT DISTINCT 'P' || (l_suppkey % 50) AS po, category AS category, 'F' || (l_suppkey % 3) AS factory FROM (SELECT l_suppkey, p_brand AS category FROM lineitem JOIN part ON p_partkey = l_partkey)""")
def _(t):
    names = lookup(t.lineitem, t.part, {"l_partkey": "p_partkey"}, {"p_brand": "c"}, unique=True).select(F.concat(
        F.lit("P"), F.col("l_suppkey") % 50, F.lit(" - "), F.col("c"), F.lit("  -  F"), F.col("l_suppkey") % 3, F.lit(" - sent May 1")).alias("folder")).distinct()
    return purchasing.checklist(parse_folder_name(names, "folder"))


@query("fabric_allocation", f"""
    WITH f AS (SELECT k.cat, CASE WHEN k.print = 'LARGE' THEN 'L' ELSE k.print END AS print, cast(sum(l_quantity) as double) AS len FROM lineitem JOIN s_sku k ON k.p_partkey = l_partkey GROUP BY 1, 2),
    x AS (SELECT e.name, e.item_category_sku, e.item_print_sku, f.len, (e.item_size::INT % 3 + 1)::DOUBLE AS cost, (e.item_size::INT % 5 + 1)::DOUBLE AS r FROM s_erp e JOIN f ON f.cat = e.item_category_sku AND f.print = e.item_print_sku
      WHERE e.inventory_warehouse = 'WH-CENTRAL' AND e.item_size NOT IN ('6', '10')),
    y AS (SELECT *, sum(cost * r) OVER (PARTITION BY item_category_sku, item_print_sku) AS w FROM x),
    z AS (SELECT *, cast({half_even('cast(len * r as hugeint)', 'cast(w as hugeint)')} as int) AS quantity FROM y)
    SELECT z.name, item_category_sku, item_print_sku, m.print_name, m.print_chinese, m.msku_status AS status, len AS fabric, cost AS cost_m, r AS size_r, w AS total_weight, quantity,
      sum(cost * quantity) OVER (PARTITION BY item_category_sku, item_print_sku) AS "check" FROM z LEFT JOIN s_master m ON m.msku = z.name""")
def _(t):
    lines = lookup(t.lineitem, t.s_sku, {"l_partkey": "p_partkey"}, ["cat", "print"], unique=True).replace("LARGE", "L", "print")
    fabric = lines.groupBy(F.col("cat").alias("category"), "print").agg(F.sum("l_quantity").alias("length"))
    usage = t.s_sku.select(F.col("cat").alias("category"), "size").distinct().withColumns({
        "cost_m": (F.col("size").cast("int") % 3 + 1).cast("double"), "size_r": (F.col("size").cast("int") % 5 + 1).cast("double")})
    out = purchasing.allocate_fabric(stock.warehouse_stock(t.s_erp, "WH-CENTRAL"), fabric, usage, ["6", "10"], t.s_master)
    return out.select("name", "item_category_sku", "item_print_sku", "print_name", "print_chinese", "status", "fabric", "cost_m", "size_r", "total_weight", "quantity", "check")


# Inbound


def _fill(c: str) -> str:
    return f"last_value({c} IGNORE NULLS) OVER (PARTITION BY sheet ORDER BY _pos ROWS UNBOUNDED PRECEDING)"


GRAMS = "CASE WHEN cast(unit_weight as double) < 10 THEN round_even(cast(unit_weight as double) * 1000, 0) ELSE round_even(cast(unit_weight as double), 0) END"
PACK = f"""filled AS (SELECT * REPLACE ({_fill('po')} AS po, {_fill('season')} AS season, {_fill('ctn_start')} AS ctn_start, {_fill('ctn_end')} AS ctn_end, {_fill('ctn_no')} AS ctn_no) FROM s_packing),
    boxes AS (SELECT sheet, sheet_name, sheet || '-' || ctn_no AS box_no, po, season, sku, qty_shipped AS quantity, {GRAMS} AS unit_weight_g, gross_weight_per_ctn AS gross_weight, _pos, 0 AS seq FROM filled WHERE ctn_start IS NULL
      UNION ALL SELECT sheet, sheet_name, sheet || '-' || n, po, season, sku, qty_per_box, {GRAMS}, gross_weight_per_ctn, _pos, n FROM (SELECT *, unnest(generate_series(ctn_start, ctn_end)) AS n FROM filled WHERE ctn_start IS NOT NULL))"""


def _boxes(t):
    return inbound.normalise_packing(t.s_packing)


@query("normalise_packing", f"""
    WITH {PACK} SELECT sheet, sheet_name, box_no, po, season, sku, quantity, unit_weight_g, gross_weight, _pos, cast(seq as int) AS box_seq FROM boxes""")
def _(t):
    return _boxes(t).withColumnRenamed("_box_seq", "box_seq")


WEIGHTS = """manual AS (SELECT DISTINCT CASE WHEN p_size <= 25 THEN cat ELSE 'Z' || cat END AS category, size, cast(150 + p_size as double) AS unit_weight FROM s_sku),
    wt AS (SELECT * FROM manual UNION ALL SELECT * FROM (SELECT DISTINCT CASE WHEN p_size >= 10 AND p_size < 45 THEN cat ELSE 'Y' || cat END AS cat, size, round_even(180.4 + p_size * 0.2, 0) FROM s_sku) WHERE (cat, size) NOT IN (SELECT (category, size) FROM manual))"""


def _weights(t):
    manual = t.s_sku.select(renamed("cat", F.col("p_size") <= 25).alias("category"), "size", (F.col("p_size") + 150).cast("double").alias("unit_weight")).distinct()
    log = t.s_sku.select(renamed("cat", (F.col("p_size") >= 10) & (F.col("p_size") < 45), "Y").alias("category"), "size", (F.lit(180.4) + F.col("p_size") * F.lit(0.2)).alias("sample_weight_g")).distinct()
    return inbound.unit_weight(manual, log)


@query("unit_weight", f"WITH {WEIGHTS} SELECT category, size, unit_weight FROM wt")
def _(t):
    return _weights(t)


EST = f"""{PACK}, {WEIGHTS}, est AS (SELECT b.*, w.unit_weight AS unit_weight_ref,
      {half_even('cast(sum(quantity * unit_weight_g) OVER (PARTITION BY box_no) + 1000 as hugeint)', '10')} / 100.0::DOUBLE AS est_weight,
      {half_even('cast(sum(quantity * w.unit_weight) OVER (PARTITION BY box_no) + 1000 as hugeint)', '10')} / 100.0::DOUBLE AS est_weight_ref
    FROM boxes b LEFT JOIN wt w ON w.category = {cat('b.sku')} AND w.size = split_part(b.sku, '-', 3))"""


def _est(t):
    boxes = _boxes(t).withColumn("full_sku", F.col("sku")).withColumn("sku", F.regexp_extract("sku", "^[^-]+-[^-]+-[^-]+", 0))
    out = inbound.box_weight(boxes, _weights(t), t.shared)
    return out.withColumn("sku", F.col("full_sku")).drop("full_sku")


@query("box_weight", f"""
    WITH {EST} SELECT _pos, cast(seq as int) AS box_seq, box_no, sku, quantity, unit_weight_g, unit_weight_ref, est_weight, est_weight_ref FROM est WHERE box_no IS NOT NULL""")
def _(t):
    return _est(t).filter("box_no IS NOT NULL").withColumnRenamed("_box_seq", "box_seq").select(
        "_pos", "box_seq", "box_no", "sku", "quantity", "unit_weight_g", "unit_weight_ref", "est_weight", "est_weight_ref")


RESOLVE = f"""{PACK}, docs AS (SELECT ref_no, min(document_number) AS doc FROM s_po GROUP BY 1),
    res AS (SELECT b.*, CASE WHEN a.ref_no IS NOT NULL THEN a.doc ELSE d.doc END AS document, CASE WHEN a.ref_no IS NOT NULL THEN a.ref_no ELSE b.po END AS po_ref
      FROM boxes b LEFT JOIN docs a ON a.ref_no = b.po || '-CA' LEFT JOIN docs d ON d.ref_no = b.po),
    ship AS (SELECT po_ref, replace(sku, '-V1', '') AS item, sum(quantity) AS quantity, min(document) AS document, string_agg(box_no, ' | ' ORDER BY _pos, seq) AS txt FROM res GROUP BY 1, 2),
    sh AS (SELECT po_ref, item, quantity, document, txt AS box_no FROM ship),
    op AS (SELECT ref_no, item, sum(greatest(quantity - coalesce(quantity_on_shipments, 0.0), 0.0)) AS remain FROM s_po GROUP BY 1, 2)"""


def _ship(t):
    return inbound.collapse_shipment(inbound.resolve_po(_boxes(t), t.s_po))


def _open(t):
    po = purchasing.po_remaining(t.s_po)
    return po.groupBy("ref_no", "item").agg(F.sum("quantity_remain").alias("quantity_remain"))


@query("resolve_po", f"WITH {RESOLVE} SELECT _pos, cast(seq as int) AS box_seq, po, document, po_ref FROM res")
def _(t):
    return inbound.resolve_po(_boxes(t), t.s_po).select("_pos", F.col("_box_seq").alias("box_seq"), "po", "document", "po_ref")


@query("collapse_shipment", f"WITH {RESOLVE} SELECT po_ref, item, quantity, document, box_no FROM sh WHERE po_ref IS NOT NULL")
def _(t):
    return _ship(t).filter("po_ref IS NOT NULL")


@query("over_received", f"""
    WITH {RESOLVE} SELECT po_ref, sh.item, quantity, document, box_no, coalesce(remain, 0.0) AS quantity_remain, quantity - coalesce(remain, 0.0) AS over
    FROM sh LEFT JOIN op ON op.ref_no = po_ref AND op.item = sh.item WHERE po_ref IS NOT NULL AND quantity > coalesce(remain, 0.0)""")
def _(t):
    return inbound.over_received(_ship(t).filter("po_ref IS NOT NULL"), _open(t))


@query("over_receipt_po", f"""
    WITH {RESOLVE}, o AS (SELECT sh.item, quantity - coalesce(remain, 0.0) AS over FROM sh LEFT JOIN op ON op.ref_no = po_ref AND op.item = sh.item WHERE po_ref IS NOT NULL AND quantity > coalesce(remain, 0.0))
    SELECT 'Over Received' AS po_type, 'MIX' AS category, '26F' AS season, 'Over.S1' AS ref_no, 'WH-CENTRAL' AS warehouse, 'China' AS vendor, {PO_CONST}, '04/01/2001' AS due_date,
      'Over receiving in shipment S1' AS memo, item, sum(over) AS quantity, 'Over.S1' AS external_id FROM o GROUP BY item""")
def _(t):
    over = inbound.over_received(_ship(t).filter("po_ref IS NOT NULL"), _open(t))
    return inbound.over_receipt_po(over, "S1", "26F", AS_OF, date(2001, 4, 1), "WH-CENTRAL", "ops")


@query("over_receipt", f"""
    WITH {RESOLVE}, j AS (SELECT sh.*, coalesce(remain, 0.0) AS remain FROM sh LEFT JOIN op ON op.ref_no = po_ref AND op.item = sh.item WHERE po_ref IS NOT NULL),
    a AS (SELECT po_ref, item, least(quantity, remain) AS quantity, document, box_no FROM j WHERE document IS NOT NULL
      UNION ALL SELECT 'Over.S1', item, quantity - remain, 'PO#77', box_no FROM j WHERE quantity > remain),
    z AS (SELECT po_ref, item, sum(quantity) AS quantity, min(document) AS document, string_agg(box_no, ' | ' ORDER BY box_no) AS txt FROM a WHERE quantity <> 0 GROUP BY 1, 2)
    SELECT po_ref, item, quantity, document, txt AS box_no FROM z""")
def _(t):
    return inbound.split_over_receipt(_ship(t).filter("po_ref IS NOT NULL"), _open(t), "S1", "PO#77")


@query("reserve_transfer", f"""
    WITH {PACK} SELECT '{DAY}' AS date, 'China-Central' AS to_type, '25F' AS season, 'WH-CN' AS from_warehouse, 'WH-CENTRAL' AS to_warehouse, 'TO-S1' AS ref_no, 'S1' AS memo, 'ops' AS order_placed_by,
      replace(sku, '-V1', '') AS item, sum(quantity) AS quantity FROM boxes WHERE contains(sheet_name, 'F25') GROUP BY replace(sku, '-V1', '') HAVING sum(quantity) > 0""")
def _(t):
    return inbound.reserve_transfer(_boxes(t), "F25", AS_OF, "S1", "25F", by="ops")


@query("reserve_shortfall", f"""
    WITH {PACK}, r AS (SELECT replace(sku, '-V1', '') AS item, sum(quantity) AS q FROM boxes WHERE contains(sheet_name, 'F25') GROUP BY 1)
    SELECT '{DAY}' AS date, item, q - coalesce(e.warehouse_available, 0) AS adjust_qty_by, 'CC' AS reason_code, 'S1 Reserve TO' AS memo, 'WH-CN' AS warehouse, 'IAC-{YMD}-1' AS external_id
    FROM r LEFT JOIN s_erp e ON e.name = r.item AND e.inventory_warehouse = 'WH-3PL' WHERE q > 0 AND q - coalesce(e.warehouse_available, 0) > 0""")
def _(t):
    return inbound.reserve_shortfall(inbound.reserve_transfer(_boxes(t), "F25", AS_OF, "S1"), stock.warehouse_stock(t.s_erp, "WH-3PL"), "S1", "WH-CN", AS_OF)


@query("check_totals", f"""
    WITH {PACK}, g AS (SELECT sum(quantity) AS qty, count(DISTINCT box_no) AS boxes FROM boxes), s AS (SELECT sum(qty_shipped) AS q, 7::BIGINT AS n FROM s_packing)
    SELECT g.qty, g.boxes, s.q AS stated_qty, s.n AS stated_boxes, CASE WHEN g.qty = s.q THEN 1 ELSE 0 END AS qty_ok, CASE WHEN g.boxes = s.n THEN 1 ELSE 0 END AS boxes_ok FROM g, s""")
def _(t):
    last = t.s_packing.agg(F.sum("qty_shipped").alias("qty"), F.lit(7).cast("bigint").alias("number_of_box"), F.lit(9).alias("_pos"))
    first = last.withColumns({"qty": F.lit(1.0), "_pos": F.lit(1)})
    return inbound.check_totals(_boxes(t), first.unionByName(last))


@query("shipment_upload", f"""
    WITH {RESOLVE}, j AS (SELECT sh.*, coalesce(remain, 0.0) AS remain FROM sh LEFT JOIN op ON op.ref_no = po_ref AND op.item = sh.item WHERE po_ref IS NOT NULL),
    a AS (SELECT po_ref, item, least(quantity, remain) AS quantity, document, box_no FROM j WHERE document IS NOT NULL
      UNION ALL SELECT 'Over.S1', item, quantity - remain, 'PO#77', box_no FROM j WHERE quantity > remain)
    SELECT 'S1' AS ref_no, '{DAY}' AS expected_shipping_date, '04/20/2001' AS expected_delivery_date, 'sea' AS memo, po_ref, string_agg(box_no, ' | ' ORDER BY box_no) AS box_no, item, sum(quantity) AS quantity,
      'WH-CENTRAL' AS location, min(document) AS document, 'FBA1' AS amz_shipment_id FROM a WHERE quantity <> 0 GROUP BY po_ref, item""")
def _(t):
    kept = inbound.split_over_receipt(_ship(t).filter("po_ref IS NOT NULL"), _open(t), "S1", "PO#77")
    return inbound.shipment_upload(kept, "S1", AS_OF, date(2001, 4, 20), "sea", "WH-CENTRAL", "FBA1")


@query("receiving_by_box", f"""
    WITH {EST} SELECT split_part(box_no, '-', 1) AS sheet_number, split_part(box_no, '-', 2) AS box_number, sku, quantity AS packing_slip_qty, gross_weight, est_weight, est_weight_ref FROM est WHERE box_no IS NOT NULL""")
def _(t):
    return inbound.receiving_by_box(_est(t).filter("box_no IS NOT NULL"))


@query("receiving", f"WITH {RESOLVE} SELECT 'INB1' AS id, replace(document, 'PO#', '') AS po, item, quantity AS qty FROM sh WHERE po_ref IS NOT NULL")
def _(t):
    return inbound.receiving(_ship(t).filter("po_ref IS NOT NULL"), "INB1")


@query("customer_inbound", f"""
    WITH {RESOLVE}, c AS (SELECT item, sum(quantity) AS shipped FROM sh GROUP BY 1), o AS (SELECT sku AS item, sum(total_qty)::BIGINT AS quantity FROM s_request GROUP BY 1)
    SELECT o.item, o.quantity, coalesce(shipped, 0.0) AS shipped, coalesce(e.warehouse_available, 0) AS available, greatest(o.quantity - coalesce(shipped, 0.0) - coalesce(e.warehouse_available, 0), 0.0) AS missing
    FROM o LEFT JOIN c ON c.item = o.item LEFT JOIN s_erp e ON e.name = o.item AND e.inventory_warehouse = 'WH-CENTRAL'""")
def _(t):
    ordered = t.s_request.groupBy(F.col("sku").alias("item")).agg(F.sum("total_qty").alias("quantity"))
    return inbound.customer_inbound(_ship(t), ordered, stock.warehouse_stock(t.s_erp, "WH-CENTRAL"))


MEASURED = f"""{EST}, ms AS (SELECT sku, box_no, 500.0 + min(_pos) % 4000 AS g, min(_pos) AS _pos FROM est WHERE box_no IS NOT NULL GROUP BY 1, 2),
    one AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY sku, box_no ORDER BY unit_weight_g NULLS FIRST, unit_weight_ref NULLS FIRST, est_weight, est_weight_ref) AS rn FROM est) WHERE rn = 1),
    wc AS (SELECT ms.sku, ms.box_no, ms._pos, o.unit_weight_g, o.unit_weight_ref, cast(ms.g as decimal(14,3)) * 0.001 - cast(o.est_weight as decimal(14,2)) AS diff, cast(ms.g as decimal(14,3)) * 0.001 - cast(o.est_weight_ref as decimal(14,2)) AS diff_ref
      FROM ms JOIN one o ON o.sku = ms.sku AND o.box_no = ms.box_no)"""


def _measured(t):
    est = _est(t)
    m = est.filter("box_no IS NOT NULL").groupBy("sku", F.col("box_no").alias("box_number")).agg(F.min("_pos").alias("_pos"))
    return inbound.measured_weights(m.withColumn("total_weight_g", F.lit(500.0) + F.col("_pos") % 4000), est)


@query("weight_check", f"""
    WITH {MEASURED} SELECT sku, box_no AS box_number, cast(diff as double) AS diff, cast(diff_ref as double) AS diff_ref FROM wc WHERE abs(diff_ref) > 0.5 AND abs(diff) > 0.5""")
def _(t):
    return inbound.weight_check(_measured(t)).select("sku", "box_number", "diff", "diff_ref")


@query("weight_update", f"""
    WITH {MEASURED} SELECT sku, split_part(sku, '-', 1) AS category, regexp_replace(sku, '.*-', '') AS size, box_no AS box_number FROM
      (SELECT *, row_number() OVER (PARTITION BY sku ORDER BY _pos, box_no) AS rn FROM wc WHERE abs(diff_ref) > abs(diff)) WHERE rn = 1""")
def _(t):
    w = _measured(t)
    w = w.withColumn("_pos", F.struct("_pos", "box_number"))
    return inbound.weights_to_update(w).select("sku", "category", "size", "box_number")


@query("weight_check_sizes", f"""
    WITH {MEASURED}, x AS (SELECT * FROM wc WHERE abs(diff_ref) > unit_weight_ref / 1000 AND abs(diff) > unit_weight_g / 1000)
    SELECT split_part(sku, '-', 1) AS category, regexp_replace(sku, '.*-', '') AS size, count(*) AS n, cast(sum(diff) as double) / count(diff) AS diff, cast(sum(diff_ref) as double) / count(diff_ref) AS diff_ref FROM x GROUP BY 1, 2""")
def _(t):
    return inbound.weight_check_sizes(inbound.weight_check(_measured(t), None))


# Ledger


LEDGER = """led AS (SELECT po, trim(sku) AS sku, r.region, sum(r.q)::BIGINT AS plan FROM s_request, LATERAL (VALUES ('Total', total_qty), ('CA/US', qty_ca), ('UK', qty_uk), ('DE', qty_de), ('CN', qty_cn), ('Wholesaler', qty_wholesale)) AS r(region, q)
      WHERE r.q IS NOT NULL GROUP BY 1, 2, 3)"""


def _factories(t):
    n = F.substring("cat", 2, 5).cast("int")
    return t.s_sku.select("cat").distinct().select(*[F.when((n % 3 == i) | ((n % 5 == 0) & F.lit(i == 2)), renamed("cat", F.col("cat") != "B9")).alias(f"FAC{i}") for i in range(3)])


def _ledger(t):
    return ledger.open_ledger(t.s_request, t.s_master, ledger.factory_by_category(_factories(t), ["FAC0", "FAC1", "FAC2"]))


@query("ledger_open", f"""
    WITH {LEDGER} SELECT po, sku, region, plan, plan AS remaining, m.seasons, {cat('sku')} AS category, CASE WHEN {cat('sku')} <> 'B9' THEN 'FAC' || CASE WHEN cast(substr({cat('sku')}, 2) as int) % 5 = 0 THEN 2 ELSE cast(substr({cat('sku')}, 2) as int) % 3 END END AS factory
    FROM led LEFT JOIN s_master m ON upper(m.msku) = upper(led.sku)""")
def _(t):
    return _ledger(t)


@query("ledger_totals", f"""
    WITH {LEDGER}, s AS (SELECT po, sum(total_qty)::BIGINT + CASE WHEN po LIKE '%3' THEN 1 ELSE 0 END AS total FROM s_request WHERE po NOT LIKE '%7' GROUP BY po),
    l AS (SELECT po, sum(plan)::BIGINT AS line_total FROM led WHERE region = 'Total' GROUP BY po)
    SELECT led.po, led.sku, led.region, led.plan, l.line_total, s.total AS stated_total, CASE WHEN s.total IS NOT NULL THEN CASE WHEN coalesce(l.line_total, 0) = s.total THEN 1 ELSE 0 END END AS total_ok
    FROM led LEFT JOIN l ON l.po = led.po LEFT JOIN s ON s.po = led.po""")
def _(t):
    off = F.max(F.when(F.col("po").endswith("3"), 1).otherwise(0))
    stated = t.s_request.groupBy("po").agg((F.sum("total_qty") + off).alias("total_qty")).filter(~F.col("po").endswith("7"))
    return ledger.stated_totals(ledger.plan_lines(t.s_request), stated)


@query("ledger_subtotals", f"""
    WITH {LEDGER} SELECT po, region, CASE WHEN grouping(sku) = 1 THEN '' ELSE sku END AS sku, sum(plan)::BIGINT AS plan, sum(plan)::BIGINT AS remaining, CASE WHEN grouping(sku) = 1 THEN 'order' ELSE 'line' END AS level
    FROM led GROUP BY GROUPING SETS ((po, region, sku), (po, region))""")
def _(t):
    plan = ledger.plan_lines(t.s_request)
    return ledger.ledger_subtotals(plan.withColumn("remaining", F.col("plan")))


SHIPPED = """SELECT 'P' || cast(l_suppkey % 50 as string) AS po, case when l_discount = 0.1 then 'NEW-' else '' end || k.sku AS sku,
    case l_linenumber when 2 then 'UK' when 3 then 'DE' when 6 then 'CN' when 7 then 'Wholesaler' else 'CA/US' end AS region,
    cast(case l_returnflag when 'A' then l_quantity else floor(l_quantity / 2) end as bigint) AS quantity FROM lineitem JOIN s_sku k ON k.p_partkey = l_partkey"""


@query("ledger_apply", f"""
    WITH {LEDGER}, s0 AS ({SHIPPED}), s1 AS (SELECT po, sku, region, sum(quantity)::BIGINT AS shipped FROM s0 GROUP BY 1, 2, 3 UNION ALL SELECT po, sku, 'Total', sum(quantity)::BIGINT FROM s0 GROUP BY 1, 2),
    j AS (SELECT coalesce(l.po, s.po) AS po, coalesce(l.sku, s.sku) AS sku, coalesce(l.region, s.region) AS region, coalesce(plan, 0) AS plan, coalesce(shipped, 0) AS shipped, CASE WHEN plan IS NULL THEN 1 ELSE 0 END AS unplanned
      FROM led l FULL JOIN s1 s ON s.po = l.po AND s.sku = l.sku AND s.region = l.region),
    a AS (SELECT *, 'line' AS level FROM j UNION ALL SELECT po, '', region, sum(plan)::BIGINT, sum(shipped)::BIGINT, min(unplanned), 'order' FROM j GROUP BY po, region),
    p AS (SELECT *, plan - shipped AS remaining, CASE WHEN plan = 0 THEN 0.0 ELSE (plan - shipped) / plan * 100 END AS percent FROM a)
    SELECT po, sku, region, plan, shipped, unplanned, level, remaining, percent, CASE WHEN cast(format('{{:.1f}}', percent) as double) > 1 OR cast(format('{{:.1f}}', percent) as double) < -10 THEN 1 ELSE 0 END AS flag FROM p""")
def _(t):
    return ledger.apply_shipments(ledger.plan_lines(t.s_request), t.sql(SHIPPED))


MANIFEST = """SELECT case when p_partkey % 6 = 0 then 'DE-' || sku when p_partkey % 5 = 0 then 'US-' || sku when p_partkey % 7 = 0 then sku || '-A2' else sku end AS merchant_sku,
    cast(p_size as int) AS quantity FROM s_sku"""


@query("manifest_to_po", f"""
    WITH mf AS ({MANIFEST}), al AS (SELECT alias, arg_max(sku, pos) AS sku FROM (SELECT coalesce(fbasku_de, fbasku_us, upper(msku)) AS alias, upper(msku) AS sku, 0 AS pos FROM s_master
      UNION ALL SELECT fbasku_de, upper(msku) || '-V9', 1 FROM s_master WHERE fbasku_de IS NOT NULL) GROUP BY 1),
    m AS (SELECT CASE WHEN al.sku IS NOT NULL THEN al.sku ELSE regexp_replace(merchant_sku, '-A.*', '') END AS sku, quantity FROM mf LEFT JOIN al ON al.alias = merchant_sku),
    pm AS (SELECT category AS cat, arg_max(po, sku || '|' || po) AS po FROM s_request WHERE category <> 'B7' GROUP BY 1)
    SELECT pm.po, m.sku, sum(quantity)::BIGINT AS quantity FROM m LEFT JOIN pm ON pm.cat = {cat('m.sku')} GROUP BY 1, 2""")
def _(t):
    po_map = t.s_request.select(renamed("sku", F.col("category") != "B7").alias("sku"), F.concat("po", F.lit("-CA")).alias("po"), F.concat_ws("|", "sku", "po").alias("_pos"))
    master = t.s_master.withColumn("_pos", F.lit(0))
    again = master.filter("fbasku_de IS NOT NULL").withColumns({"msku": F.concat("msku", F.lit("-V9")), "_pos": F.lit(1)})
    return ledger.manifest_to_po(t.sql(MANIFEST), master.unionByName(again), po_map)
