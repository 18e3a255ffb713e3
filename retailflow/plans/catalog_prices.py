"""Pricing and stock jobs as queries."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from ..jobs import pricing, stock
from ..operators.lookup import lookup
from ..schemas import STATUS_LOG_HEADERS
from .registry import AS_OF, cat, cents, half_even, query, renamed, values

NOW = datetime(2024, 6, 1, 12, 0, 0)
EXTRA = (("MISC5", 5), ("MISC10", 10), ("MAJC", 99.99))
TAXABLE = ("B1", "B7", "B12", "B20")
RULES = [("^B1[0-9]?-PROMO", 10.5, 1), ("-SMALL-", 20.25, 2), ("^B2", 30.0, 3), ("-PROMO-.*7$", 40.0, 4)]
OVERRIDES = [("PROMO", 39), ("^B5", 25), ("SMALL-1", 34.5)]

WEB = """priced AS (SELECT sku, id, name, tax_class, regular_price,
    CASE WHEN sale_price IS NULL OR coalesce(timestamp '2024-06-01 12:00:00' < sale_starts, false) OR coalesce(timestamp '2024-06-01 12:00:00' > sale_ends, false)
         THEN regular_price ELSE sale_price END AS sale_price
  FROM s_web WHERE regular_price IS NOT NULL AND trim(sku) <> '')"""
EXTRA_SQL = "(VALUES ('MISC5', 5.00), ('MISC10', 10.00), ('MAJC', 99.99)) AS x(cat, price)"
CATS = f"""cats AS (SELECT {cat('sku')} AS cat, cast(max(sale_price) as decimal(12,2)) AS price FROM priced GROUP BY 1
  UNION ALL SELECT cat, cast(price as decimal(12,2)) FROM {EXTRA_SQL})"""
TAX = "CASE WHEN {c} IN ('B1', 'B7', 'B12', 'B20') THEN 'GST+PST' ELSE 'GST' END"
RULE_HIT = f"""hits AS (SELECT n.name, r.price AS sales, row_number() OVER (PARTITION BY n.name ORDER BY r.pos) AS rn
  FROM names n JOIN {values(RULES, 'r(item, price, pos)')} ON regexp_matches(n.name, r.item))"""
DAY, YMD = AS_OF.strftime("%m/%d/%Y"), AS_OF.strftime("%y%m%d")


def _web(t):
    """The web catalog; SKUs whose first row has no price are listed a second time, with one."""
    again = t.s_web.filter("regular_price IS NULL").withColumns({"id": F.col("id") + 10 ** 9, "regular_price": F.lit(5).cast("decimal(12,2)")})
    return pricing.effective_price(t.s_web.unionByName(again), NOW)


def _rules(t):
    return t.spark.createDataFrame([(p, float(v), i) for p, v, i in RULES], "item string, sales double, _pos int").withColumn("sales", F.col("sales").cast("decimal(12,2)"))


def _pos(t):
    return t.s_pos.withColumns({"alternate_name": F.lit(None).cast("string"), "tax_rates": F.lit(None).cast("string")})


@query("effective_price", f"""
    WITH {WEB} SELECT sku, cast(regular_price as double) AS regular_price, cast(sale_price as double) AS sale_price FROM priced""")
def _(t):
    return _web(t).select("sku", "regular_price", "sale_price")


@query("category_price", f"""
    WITH {WEB}, {CATS} SELECT cat, cast(price as double) AS price FROM cats""")
def _(t):
    return pricing.category_price(_web(t), EXTRA)


@query("category_price_factor", f"""
    WITH {WEB} SELECT {cat('sku')} AS cat, {half_even(cents('max(regular_price)') + ' * 85', '100')} / 100.0::DOUBLE AS price FROM priced GROUP BY 1""")
def _(t):
    return pricing.category_price(_web(t), (), "regular_price", 0.85)


@query("sync_pos_catalog", f"""
    WITH {WEB}, {CATS}, names AS (SELECT DISTINCT name FROM s_pos), {RULE_HIT},
    x AS (SELECT p.name, w.name AS alternate_name, {cat('p.name')} AS cat,
            coalesce(cast(h.sales as decimal(12,2)), CASE WHEN w.sku IS NOT NULL THEN w.sale_price ELSE c.price END) AS price
          FROM s_pos p LEFT JOIN priced w ON w.sku = p.name LEFT JOIN cats c ON c.cat = {cat('p.name')} LEFT JOIN hits h ON h.name = p.name AND h.rn = 1)
    SELECT name, alternate_name, cast(price as double) AS price, CASE WHEN price IS NULL THEN 'Variable' ELSE 'Fixed' END AS price_type, {TAX.format(c='cat')} AS tax_rates FROM x""")
def _(t):
    out = pricing.sync_pos_catalog(_pos(t), _web(t), pricing.category_price(_web(t), EXTRA), _rules(t), TAXABLE)
    return out.select("name", "alternate_name", "price", "price_type", "tax_rates")


@query("sync_pos_tax_class", f"""
    WITH {WEB} SELECT p.name, CASE WHEN w.tax_class = 'full' THEN 'GST+PST' ELSE 'GST' END AS tax_rates FROM s_pos p LEFT JOIN priced w ON w.sku = p.name""")
def _(t):
    out = pricing.sync_pos_catalog(_pos(t), _web(t), pricing.category_price(_web(t), EXTRA), _rules(t), None)
    return out.select("name", "tax_rates")


@query("promo_price", f"""
    WITH {WEB}, d AS (SELECT sku, least(cast(sale_price as double), {half_even(cents('regular_price') + ' * 85', '100')} / 100.0::DOUBLE) AS price FROM priced),
    c AS (SELECT {cat('sku')} AS cat, {half_even(cents('max(regular_price)') + ' * 85', '100')} / 100.0::DOUBLE AS price FROM priced GROUP BY 1),
    x AS (SELECT p.name, {cat('p.name')} AS cat, CASE WHEN regexp_matches(p.name, 'SMALL-1') THEN 34.5 WHEN regexp_matches(p.name, '^B5') THEN 25 WHEN regexp_matches(p.name, 'PROMO') THEN 39
            WHEN d.sku IS NOT NULL THEN d.price ELSE c.price END AS price
          FROM s_pos p LEFT JOIN d ON d.sku = p.name LEFT JOIN c ON c.cat = {cat('p.name')})
    SELECT name, cat, cast(price as double) AS price, CASE WHEN price IS NULL THEN 'Variable' ELSE 'Fixed' END AS price_type FROM x""")
def _(t):
    return pricing.promo_price(t.s_pos.select("name"), _web(t), 0.85, OVERRIDES)


@query("event_price", f"""
    WITH i AS (SELECT CASE WHEN size IN ('7', '9') THEN sku ELSE 'Z' || sku END AS name, cast(price - 500 as double) AS price FROM s_sku),
    c AS (SELECT CASE WHEN cat IN ('B3', 'B4') THEN cat ELSE 'Z' || cat END AS cat, cast(min(price) - 300 as double) AS price FROM s_sku GROUP BY 1),
    x AS (SELECT p.name, {cat('p.name')} AS cat, CASE WHEN regexp_matches(p.name, '^B1-') THEN 8.5 WHEN regexp_matches(p.name, '-PROMO-') THEN 45
            WHEN i.name IS NOT NULL THEN i.price WHEN c.cat IS NOT NULL THEN c.price ELSE cast(p.price as double) END AS price
          FROM s_pos p LEFT JOIN i ON i.name = p.name LEFT JOIN c ON c.cat = {cat('p.name')})
    SELECT name, cat, cast(price as double) AS price, CASE WHEN price IS NULL THEN 'Variable' ELSE 'Fixed' END AS price_type FROM x""")
def _(t):
    listed = t.s_sku.select(renamed("sku", F.col("size").isin("7", "9")).alias("name"), (F.col("price") - 500).alias("price"))
    cats = t.s_sku.groupBy(renamed("cat", F.col("cat").isin("B3", "B4")).alias("cat")).agg((F.min("price") - 300).alias("price"))
    return pricing.event_price(t.s_pos.select("name", "price"), listed, cats, [("-PROMO-", 45), ("^B1-", 8.5)])


@query("pos2_catalog", f"""
    WITH {WEB}, e AS (SELECT * FROM s_erp WHERE inventory_warehouse = 'WH-CENTRAL')
    SELECT '' AS token, p.sku AS item_name, 'Regular' AS variation_name, p.sku, e.item_category_sku AS category, cast(p.sale_price as double) AS price,
           coalesce(e.warehouse_available, 0) AS new_quantity, 'Y' AS enabled, 'UNAVAILABLE' AS online_visibility, 'Y' AS sellable, 'Y' AS stockable,
           CASE WHEN p.tax_class = 'full' THEN 'Y' ELSE 'N' END AS tax_pst
    FROM priced p LEFT JOIN e ON e.name = p.sku""")
def _(t):
    return pricing.pos2_catalog(_web(t), stock.warehouse_stock(t.s_erp, "WH-CENTRAL"))


MASTER_SYNC = f"""{WEB}, {CATS}, names AS (SELECT DISTINCT msku AS name FROM s_master), {RULE_HIT},
    items AS (SELECT p.clover_id, m.msku AS name, w.name AS alternate_name,
        coalesce(cast(h.sales as decimal(12,2)), CASE WHEN w.sku IS NOT NULL THEN w.sale_price ELSE c.price END) AS price,
        regexp_replace(m.upc_active, '[ /|].*', '') AS product_code, CASE WHEN p.name IS NOT NULL THEN p.quantity ELSE 0 END AS quantity,
        {TAX.format(c='m.category_sku')} AS tax_rates, m.category_sku AS categories
      FROM s_master m LEFT JOIN priced w ON w.sku = m.msku LEFT JOIN cats c ON c.cat = m.category_sku LEFT JOIN s_pos p ON p.name = m.msku
      LEFT JOIN hits h ON h.name = m.msku AND h.rn = 1 WHERE m.msku_status = 'Active')"""


def _master_items(t):
    return pricing.sync_master(t.s_master, t.s_pos, _web(t), pricing.category_price(_web(t), EXTRA), _rules(t), TAXABLE)


@query("sync_master", f"""
    WITH {MASTER_SYNC}
    SELECT clover_id, name, alternate_name, cast(price as double) AS price, CASE WHEN price IS NULL THEN 'Variable' ELSE 'Fixed' END AS price_type, product_code,
           name AS sku, cast(quantity as double) AS quantity, tax_rates, categories FROM items""")
def _(t):
    return _master_items(t).withColumn("quantity", F.col("quantity").cast("double"))


@query("category_listing", f"""
    WITH {MASTER_SYNC}, c AS (SELECT DISTINCT CASE WHEN cat <> 'B9' THEN cat ELSE 'Z' || cat END AS category_name, 'ID-' || cat AS category_id FROM s_sku),
    r AS (SELECT categories, name, row_number() OVER (PARTITION BY categories ORDER BY name) AS rn FROM items)
    SELECT CASE WHEN rn = 1 THEN categories ELSE '' END AS category_name, CASE WHEN rn = 1 THEN c.category_id ELSE '' END AS category_id, name AS item_sort_order
    FROM r LEFT JOIN c ON c.category_name = categories""")
def _(t):
    ids = t.s_sku.select(renamed("cat", F.col("cat") != "B9").alias("category_name"), F.concat(F.lit("ID-"), "cat").alias("category_id")).distinct()
    return pricing.category_listing(_master_items(t), ids)


@query("inherit_barcode", """
    WITH x AS (SELECT CASE WHEN p_partkey % 10 = 0 THEN 'M' || sku ELSE sku END AS name FROM s_sku)
    SELECT x.name, m.upc_active AS upc FROM x LEFT JOIN s_master m ON m.msku = regexp_replace(x.name, '^M', '')""")
def _(t):
    names = t.s_sku.select(F.when(F.col("p_partkey") % 10 == 0, F.concat(F.lit("M"), "sku")).otherwise(F.col("sku")).alias("name"))
    return pricing.inherit_attr(names, t.s_master, "name", "msku", "upc_active", "upc")


@query("sync_market", f"""
    WITH {WEB}, d AS (SELECT cat || '-' || print AS spu, min(p_name) AS product_name, max(p_name) AS description FROM s_sku GROUP BY 1),
    x AS (SELECT lower(k.cat || '-' || k.print) AS spu, k.sku, e.warehouse_available AS a, w.sale_price + CASE WHEN regexp_matches(k.sku, '^B2') THEN 10 ELSE 0 END AS price,
            w.regular_price + CASE WHEN regexp_matches(k.sku, '^B2') THEN 10 ELSE 0 END AS compare_at_price, d.product_name, d.description
          FROM s_sku k LEFT JOIN s_erp e ON e.name = k.sku AND e.inventory_warehouse = 'WH-CENTRAL' LEFT JOIN priced w ON w.sku = k.sku
          LEFT JOIN d ON d.spu = k.cat || '-' || k.print)
    SELECT spu, sku, cast(CASE WHEN regexp_matches(sku, '^B5') THEN 0 WHEN a < 20 THEN 0 ELSE a END as double) AS inventory, cast(price as double) AS price,
           cast(compare_at_price as double) AS compare_at_price, product_name, description, CASE WHEN price = compare_at_price THEN 'regular' WHEN price <> compare_at_price THEN 'sale' END AS tags FROM x""")
def _(t):
    descr = t.s_sku.groupBy(F.concat_ws("-", "cat", "print").alias("spu")).agg(F.min("p_name").alias("product_name"), F.max("p_name").alias("description"))
    items = t.s_sku.select(F.lower(F.concat_ws("-", "cat", "print")).alias("spu"), "sku")
    out = pricing.sync_market(items, stock.warehouse_stock(t.s_erp, "WH-CENTRAL"), _web(t), descr, 20, "^B2", 10, "^B5")
    return out.withColumn("inventory", F.col("inventory").cast("double"))


LISTING = f"""{WEB}, listed AS (SELECT cat || '-' || print AS spu, CASE WHEN size IN ('3', '4', '5') THEN sku ELSE 'Z' || sku END AS sku FROM s_sku),
    d AS (SELECT CASE WHEN print <> 'LARGE' THEN '' ELSE 'Z' END || cat || '-' || print AS spu, min(p_name) AS product_name, max(p_name) AS description FROM s_sku GROUP BY 1),
    cand AS (SELECT * FROM s_erp WHERE inventory_warehouse = 'WH-CENTRAL' AND warehouse_available >= 5 AND item_category_sku NOT IN ('B1', 'B2') AND name NOT IN (SELECT sku FROM listed))"""


def _listing(t):
    listed = t.s_sku.select(F.concat_ws("-", "cat", "print").alias("spu"), renamed("sku", F.col("size").isin("3", "4", "5")).alias("sku"))
    descr = t.s_sku.groupBy(F.concat_ws("-", renamed("cat", F.col("print") != "LARGE"), "print").alias("spu")).agg(
        F.min("p_name").alias("product_name"), F.max("p_name").alias("description"))
    here = stock.warehouse_stock(t.s_erp, "WH-CENTRAL")
    return listed, descr, here, pricing.listing_candidates(here, listed, ["B1", "B2"])


@query("new_listings", f"""
    WITH {LISTING}, n AS (SELECT m.category_sku || '-' || m.print_sku AS spu, c.name AS sku FROM cand c JOIN s_master m ON m.msku = c.name AND m.msku_status = 'Active'
      WHERE EXISTS (SELECT 1 FROM priced p WHERE p.sku = c.name AND p.sale_price IS NOT NULL) AND m.category_sku || '-' || m.print_sku IN (SELECT spu FROM d)),
    a AS (SELECT upper(spu) AS spu, sku FROM listed UNION ALL SELECT * FROM n)
    SELECT a.spu, a.sku, d.product_name, d.description, cast(p.sale_price as double) AS price, cast(p.regular_price as double) AS compare_at_price, e.warehouse_available AS inventory,
           CASE WHEN p.sale_price = p.regular_price THEN 'regular' WHEN p.sale_price <> p.regular_price THEN 'sale' END AS tags
    FROM a LEFT JOIN d ON d.spu = a.spu LEFT JOIN priced p ON p.sku = a.sku JOIN s_erp e ON e.name = a.sku AND e.inventory_warehouse = 'WH-CENTRAL' AND e.warehouse_available > 0""")
def _(t):
    listed, descr, here, cand = _listing(t)
    return pricing.new_listings(cand, listed, t.s_master, _web(t), descr, here)


@query("listing_gaps", f"""
    WITH {LISTING}, cd AS (SELECT DISTINCT CASE WHEN cat IN ('B3', 'B8') THEN 'Z' || cat ELSE cat END AS cat FROM s_sku)
    SELECT 'category' AS kind, item_category_sku AS key FROM cand WHERE item_category_sku NOT IN (SELECT cat FROM cd) GROUP BY 2
    UNION ALL SELECT 'spu', item_category_sku || '-' || item_print_sku FROM cand
      WHERE item_category_sku || '-' || item_print_sku NOT IN (SELECT spu FROM d) AND item_category_sku || '-' || item_print_sku IN (SELECT {cat('sku')} || '-' || split_part(sku, '-', 2) FROM s_web) GROUP BY 2""")
def _(t):
    _, descr, _, cand = _listing(t)
    texts = t.s_sku.select(renamed("cat", ~F.col("cat").isin("B3", "B8")).alias("cat")).distinct().withColumns({c: F.lit("") for c in ("product_name", "description", "categories")})
    a = pricing.missing_category_texts(cand, texts).select(F.lit("category").alias("kind"), F.col("cat").alias("key"))
    return a.unionByName(pricing.missing_spu_texts(cand, descr, t.s_web, texts).select(F.lit("spu").alias("kind"), F.col("spu").alias("key")))


# Stock


@query("inventory_adjustment", f"""
    WITH h AS (SELECT name, warehouse_available AS a FROM s_erp WHERE inventory_warehouse = 'WH-STORE'),
    x AS (SELECT p.name, greatest(coalesce(p.quantity, 0), 0) - coalesce(h.a, 0) AS d FROM s_pos p LEFT JOIN h ON h.name = p.name WHERE p.name IN (SELECT name FROM s_erp))
    SELECT '{DAY}' AS date, name AS item, d AS adjust_qty_by, 'CC' AS reason_code, 'Good' AS status, 'POS Inventory Update' AS memo, 'WH-STORE' AS warehouse,
           'IAR-{YMD}-2' AS external_id FROM x WHERE d <> 0""")
def _(t):
    return stock.inventory_adjustment(t.s_pos, t.s_erp, "WH-STORE", AS_OF)


@query("stock_upload", f"""
    SELECT '{DAY}' AS date, upper(name) AS item, warehouse_available AS adjust_qty_by, 'CC' AS reason_code, 'Inventory Upload' AS memo, 'WH-CN' AS warehouse, 'IAC-{YMD}-1' AS external_id
    FROM s_erp WHERE inventory_warehouse = 'WH-3PL' AND warehouse_available > 0""")
def _(t):
    return stock.stock_upload(stock.warehouse_stock(t.s_erp, "WH-3PL"), "WH-CN", AS_OF)


@query("pos_not_in_erp", """
    SELECT p.name, cast(p.quantity as double) AS quantity, m.msku_status, m.seasons_sku FROM s_pos p LEFT JOIN s_master m ON m.msku = p.name
    WHERE p.name NOT IN (SELECT name || CASE WHEN warehouse_available > 10 THEN '' ELSE '?' END FROM s_erp)""")
def _(t):
    return stock.pos_not_in_erp(t.s_pos, t.s_erp.withColumn("name", F.concat("name", F.when(F.col("warehouse_available") > 10, "").otherwise("?"))), t.s_master).withColumn("quantity", F.col("quantity").cast("double"))


@query("apply_movements", """
    WITH m AS (SELECT k.sku AS item, sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END)::BIGINT AS q FROM lineitem JOIN s_sku k ON k.p_partkey = l_partkey GROUP BY 1),
    n AS (SELECT k.sku AS item, count(*) AS q FROM lineitem JOIN s_sku k ON k.p_partkey = l_partkey WHERE l_returnflag = 'A' GROUP BY 1)
    SELECT p.name, greatest(coalesce(p.quantity, 0), 0) + coalesce(m.q, 0) - coalesce(n.q, 0) AS quantity
    FROM s_pos p LEFT JOIN m ON m.item = p.name LEFT JOIN n ON n.item = p.name""")
def _(t):
    lines = lookup(t.lineitem, t.s_sku, {"l_partkey": "p_partkey"}, {"sku": "item"}, unique=True)
    received = lines.select("item", F.when(F.col("l_returnflag") == "R", F.col("l_quantity")).otherwise(0).alias("quantity"))
    sold = lines.filter("l_returnflag = 'A'").select("item", F.lit(1).alias("quantity"))
    out = stock.apply_movements(t.s_pos.select("name", "quantity"), received, 1, clip=True)
    return stock.apply_movements(out, sold, -1)


CLEAN = "pos AS (SELECT name, greatest(coalesce(quantity, 0), 0) AS quantity FROM s_pos WHERE name IS NOT NULL AND name <> '')"
TRANSFER = f"'{DAY}' AS date, 'Central-Store' AS to_type, '25S' AS season, 'WH-CENTRAL' AS from_warehouse, 'WH-STORE' AS to_warehouse, 'TO-S2R{YMD}' AS ref_no, 'Store Refill' AS memo, 'ops' AS order_placed_by"


@query("replenish", f"""
    WITH {CLEAN}, x AS (SELECT p.name AS item, p.quantity AS stock, e.item_sku_seasons AS seasons, e.warehouse_available AS a,
        CASE WHEN e.item_category_sku IN ('B1', 'B2', 'B3') AND e.item_size IN ('1', '2', '3', '4', '5', '6', '7', '8', '9') AND e.item_sku_seasons LIKE '%25S%' THEN 5 ELSE 2 END - p.quantity AS quantity
      FROM pos p JOIN s_erp e ON e.name = p.name AND e.inventory_warehouse = 'WH-CENTRAL' WHERE p.quantity < 5)
    SELECT item, stock, seasons, quantity, {TRANSFER} FROM x WHERE a > 8 AND quantity > 0 AND {cat('item')} IN ('B1', 'B2', 'B3', 'B10', 'B11', 'B12')""")
def _(t):
    return stock.replenish(t.s_pos, stock.warehouse_stock(t.s_erp, "WH-CENTRAL"), ["B1", "B2", "B3", "B10", "B11", "B12"], ["B1", "B2", "B3"],
                           [str(i) for i in range(1, 10)], "25S", AS_OF, by="ops")


@query("replenish_clearance", f"""
    WITH {CLEAN} SELECT p.name AS item, p.quantity AS stock, e.warehouse_available AS quantity, e.item_sku_seasons AS seasons, {TRANSFER}
    FROM pos p JOIN s_erp e ON e.name = p.name AND e.inventory_warehouse = 'WH-CENTRAL'
    WHERE regexp_matches(p.name, '^B1[0-9]?-PROMO|-SMALL-|^B2|-PROMO-.*7$') AND e.warehouse_available > 0 AND (p.quantity < 3 OR e.warehouse_available = 1)""")
def _(t):
    return stock.replenish_clearance(t.s_pos, stock.warehouse_stock(t.s_erp, "WH-CENTRAL"), _rules(t), 3, AS_OF, "25S", by="ops")


@query("refill_sold", f"""
    WITH {CLEAN}, s AS (SELECT k.sku AS item, count(*) AS quantity FROM lineitem JOIN s_sku k ON k.p_partkey = l_partkey GROUP BY 1)
    SELECT s.item, s.quantity, cast(p.quantity as double) AS stock FROM s LEFT JOIN pos p ON p.name = s.item""")
def _(t):
    sold = lookup(t.lineitem, t.s_sku, {"l_partkey": "p_partkey"}, {"sku": "item"}, unique=True)
    return stock.refill_sold(sold.groupBy("item").agg(F.count(F.lit(1)).alias("quantity")), t.s_pos).withColumn("stock", F.col("stock").cast("double"))


@query("refill_event", """
    SELECT p.name AS item, p.quantity AS qty, e.warehouse_available AS available, CASE WHEN e.warehouse_available < 10 THEN e.warehouse_available ELSE 20 - p.quantity END AS qty_transfer
    FROM s_pos p JOIN s_erp e ON e.name = p.name AND e.inventory_warehouse = 'WH-CENTRAL' AND e.warehouse_available > 0
    WHERE p.quantity < 10 AND p.name IN (SELECT sku FROM s_web WHERE sale_price IS NOT NULL)""")
def _(t):
    return stock.refill_event(t.s_pos, stock.warehouse_stock(t.s_erp, "WH-CENTRAL"), t.s_web.filter("sale_price IS NOT NULL"))


@query("move_offline", f"""
    SELECT name AS item, warehouse_available AS quantity, {TRANSFER} FROM s_erp WHERE inventory_warehouse = 'WH-CENTRAL' AND warehouse_available BETWEEN 1 AND 3 AND item_sku_seasons NOT LIKE '%26%'""")
def _(t):
    return stock.move_offline(stock.warehouse_stock(t.s_erp, "WH-CENTRAL"), "26", 3, AS_OF, "25S", by="ops")


@query("store_only", """
    SELECT e.name, p.quantity AS qty, cast(p.price as double) AS price FROM s_erp e JOIN s_pos p ON p.name = e.name
    WHERE e.inventory_warehouse = 'WH-CENTRAL' AND e.warehouse_available <= 0 AND p.quantity > 0 AND e.item_sku_seasons NOT LIKE '%26%'""")
def _(t):
    return stock.store_only(stock.warehouse_stock(t.s_erp, "WH-CENTRAL"), t.s_pos, "26")


@query("second_quality", """
    SELECT 'MBC' || chr(cast(65 + length(name) % 2 as int)) || substr(name, strpos(name, '-')) AS name, warehouse_available FROM s_erp
    WHERE inventory_warehouse = 'WH-STORE' AND warehouse_available > 5""")
def _(t):
    copies = stock.warehouse_stock(t.s_erp, "WH-STORE").withColumn(
        "name", F.concat(F.lit("MBC"), F.char(65 + F.length("name") % 2), F.expr("substr(name, instr(name, '-'))")))
    return stock.second_quality(copies).select("name", "warehouse_available")


COUNTS = "SELECT name AS sku, warehouse_available AS q FROM s_erp WHERE inventory_warehouse = "


@query("recount", f"""
    WITH a AS ({COUNTS}'WH-CENTRAL'), b AS ({COUNTS}'WH-STORE'), c AS ({COUNTS}'WH-3PL'), f AS (SELECT name AS sku, quantity AS q FROM s_pos)
    SELECT f.sku, cast(f.q as double) AS quantity, cast(a.q + b.q + c.q - 2 * (CASE WHEN f.q > 4 THEN f.q ELSE 0 END) as double) AS new_qty
    FROM f JOIN a USING (sku) JOIN b USING (sku) JOIN c USING (sku)""")
def _(t):
    return _recount(t)


def _recount(t):
    sheet = lambda w: stock.warehouse_stock(t.s_erp, w).select(F.col("name").alias("sku"), F.col("warehouse_available").cast("string").alias("new_qty"))
    first = t.s_pos.select(F.col("name").alias("sku"), "quantity", F.when(F.col("quantity") > 4, F.col("quantity").cast("string")).otherwise("").alias("new_qty"))
    return stock.recount(first, [sheet("WH-CENTRAL"), sheet("WH-STORE"), sheet("WH-3PL")]).withColumn("quantity", F.col("quantity").cast("double"))


@query("recount_differences", f"""
    WITH a AS ({COUNTS}'WH-CENTRAL'), b AS ({COUNTS}'WH-STORE'), c AS ({COUNTS}'WH-3PL'), f AS (SELECT name AS sku, quantity AS q FROM s_pos),
    r AS (SELECT f.sku, cast(f.q as double) AS quantity, cast(a.q + b.q + c.q - 2 * (CASE WHEN f.q > 4 THEN f.q ELSE 0 END) as double) AS new_qty FROM f JOIN a USING (sku) JOIN b USING (sku) JOIN c USING (sku))
    SELECT sku, quantity, new_qty, abs(quantity - new_qty) AS diff FROM r WHERE new_qty <> quantity ORDER BY diff DESC, sku""")
def _(t):
    return stock.recount_differences(_recount(t))


@query("combine_stock", """
    SELECT p.name, cast(CASE WHEN e.name IS NULL THEN NULL ELSE greatest(coalesce(p.quantity, 0) + e.warehouse_available, 0) END as double) AS quantity, cast(w.regular_price as double) AS price
    FROM s_pos p LEFT JOIN s_erp e ON e.name = p.name AND e.inventory_warehouse = 'WH-3PL' LEFT JOIN s_web w ON w.sku = e.name""")
def _(t):
    other = lookup(stock.warehouse_stock(t.s_erp, "WH-3PL"), t.s_web, {"name": "sku"}, {"regular_price": "price"}, unique=True)
    out = stock.combine_stock(t.s_pos.select("name", "quantity"), other.select("name", F.col("warehouse_available").alias("quantity"), "price"))
    return out.withColumn("quantity", F.col("quantity").cast("double"))


@query("stock_discrepancy", """
    WITH l AS (SELECT k.sku, l_returnflag AS f FROM lineitem JOIN s_sku k ON k.p_partkey = l_partkey),
    a AS (SELECT sku, sum(CASE WHEN f = 'A' THEN 1 ELSE 0 END)::BIGINT AS i, sum(CASE WHEN f = 'R' THEN 1 ELSE 0 END)::BIGINT AS o, sum(CASE WHEN f = 'N' THEN 1 ELSE 0 END)::BIGINT AS s FROM l GROUP BY 1),
    x AS (SELECT e.name, e.warehouse_available AS quantity, coalesce(greatest(coalesce(p.quantity, 0), 0), 0)::BIGINT AS start, coalesce(a.i, 0) AS moved_in, coalesce(a.o, 0) AS moved_out, coalesce(a.s, 0) AS sold
          FROM s_erp e LEFT JOIN s_pos p ON p.name = e.name LEFT JOIN a ON a.sku = e.name WHERE e.inventory_warehouse = 'WH-STORE')
    SELECT *, quantity - (start + moved_in - moved_out - sold) AS discrepancy FROM x WHERE quantity - (start + moved_in - moved_out - sold) < -3 OR quantity - (start + moved_in - moved_out - sold) > 5""")
def _(t):
    lines = lookup(t.lineitem, t.s_sku, {"l_partkey": "p_partkey"}, {"sku": "item"}, unique=True).withColumn("quantity", F.lit(1))
    start = stock.clean_pos(t.s_pos).select("name", "quantity")
    end = stock.warehouse_stock(t.s_erp, "WH-STORE").select("name", F.col("warehouse_available").alias("quantity"))
    return stock.stock_discrepancy(start, end, lines.filter("l_returnflag = 'A'"), lines.filter("l_returnflag = 'R'"), lines.filter("l_returnflag = 'N'"))


@query("tpl_diff", """
    SELECT p.name AS sku, p.quantity AS current_atp, coalesce(e.warehouse_available, 0) AS erp_qty, coalesce(e.warehouse_available, 0) - p.quantity AS diff
    FROM s_pos p LEFT JOIN s_erp e ON e.name = p.name AND e.inventory_warehouse = 'WH-3PL' WHERE coalesce(e.warehouse_available, 0) <> p.quantity""")
def _(t):
    return stock.tpl_diff(t.s_pos.select(F.col("name").alias("sku"), F.col("quantity").alias("current_atp")), stock.warehouse_stock(t.s_erp, "WH-3PL"))


def _tpl(t, which="true"):
    return t.sql(f"""
        SELECT 'SO' || cast(l_orderkey as string) || '-' || cast(l_suppkey % 3 as string) AS order_code, 'W' || cast(l_orderkey as string) AS extra_note_1,
               cast(year(l_shipdate) as string) || ' 10:00' AS shipment_order_date, cast(l_partkey as string) AS sku, cast(l_quantity as int) AS total_quantity,
               case when l_suppkey % 2 = 0 then 'Cheapest Service' else 'Fast' end AS shipping_service, 'BC' AS billing_state, l_returnflag AS status
        FROM lineitem WHERE {which}""")


@query("split_orders", """
    WITH o AS (SELECT l_orderkey AS so, l_suppkey % 3 AS fr FROM lineitem)
    SELECT DISTINCT 'SO' || so || '-' || fr AS order_code FROM o WHERE so IN (SELECT so FROM o GROUP BY so HAVING count(DISTINCT fr) > 1)""")
def _(t):
    return stock.tpl_split_orders(_tpl(t)).select("order_code")


LOG_ROW = """date, shipped_from, province, total_qty, shipped_qty, auto_fr, shipping_required, fr_created, items"""


def _log_sql(which: str, status: str) -> str:
    """First row of each order of a batch in the log's layout."""
    return f"""(SELECT order_id, {LOG_ROW}, '{status}' AS status FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY date, province, total_qty, shipping_required, items) AS rn FROM (
      SELECT 'W' || l_orderkey AS order_id, cast(year(l_shipdate) as varchar) AS date, 'Whole' AS shipped_from, 'BC' AS province, cast(l_quantity as int) AS total_qty, cast(l_quantity as int) AS shipped_qty, 'Y' AS auto_fr,
        CASE WHEN l_suppkey % 2 = 0 THEN '' ELSE 'Express' END AS shipping_required, 'Y' AS fr_created, CASE WHEN cast(l_quantity as int) = 1 THEN cast(l_partkey as varchar) ELSE '' END AS items
      FROM lineitem WHERE {which})) WHERE rn = 1)"""


@query("tpl_upsert", f"""
    WITH log AS (SELECT CASE WHEN o_orderstatus = 'O' THEN 'W' ELSE 'V' END || o_orderkey AS id FROM orders),
    a AS {_log_sql("l_returnflag = 'A'", "Synced")}, b AS {_log_sql("l_returnflag <> 'A'", "Shipped")}
    SELECT log.id AS order_id, CASE WHEN a.order_id IS NOT NULL THEN 'Synced' WHEN b.order_id IS NOT NULL THEN 'Shipped' ELSE 'New' END AS status,
      '' AS date, '' AS shipped_from, '' AS province, 0 AS total_qty, 0 AS shipped_qty, '' AS auto_fr, '' AS shipping_required, '' AS fr_created, '' AS items
    FROM log LEFT JOIN a ON a.order_id = log.id LEFT JOIN b ON b.order_id = log.id
    UNION ALL SELECT order_id, status, {LOG_ROW} FROM a WHERE order_id NOT IN (SELECT id FROM log) UNION ALL SELECT order_id, status, {LOG_ROW} FROM b WHERE order_id NOT IN (SELECT id FROM log)""")
def _(t):
    known = {"order_id": F.concat(F.when(F.col("o_orderstatus") == "O", "W").otherwise("V"), "o_orderkey"), "total_qty": F.lit(0), "shipped_qty": F.lit(0), "status": F.lit("New")}
    log = t.orders.select(*[known.get(c, F.lit("")).alias(c) for c in STATUS_LOG_HEADERS])
    return stock.tpl_upsert(log, _tpl(t, "l_returnflag = 'A'"), _tpl(t, "l_returnflag <> 'A'"))


@query("fill_upc", "SELECT k.sku, m.upc_active AS upc FROM s_sku k LEFT JOIN s_master m ON m.msku = k.sku")
def _(t):
    return stock.fill_upc(t.s_sku.select("sku"), t.s_master)


EVENT_LIST = "items AS (SELECT sku, cast(p_size % 9 + 1 as int) AS qty FROM s_sku WHERE print IN ('PROMO', 'SMALL'))"


@query("refresh_event_items", f"""
    WITH {EVENT_LIST}, {WEB} SELECT i.sku, cast(CASE WHEN e.warehouse_available IS NULL THEN NULL WHEN e.warehouse_available = 0 THEN i.qty ELSE e.warehouse_available END as double) AS qty,
        e.item_sku_seasons AS seasons, e.item_size AS size, p.name, cast(p.regular_price as double) AS regular_price, cast(p.sale_price as double) AS sale_price
    FROM items i LEFT JOIN s_erp e ON e.name = i.sku AND e.inventory_warehouse = 'WH-CENTRAL' LEFT JOIN priced p ON p.sku = i.sku""")
def _(t):
    items = t.s_sku.filter(F.col("print").isin("PROMO", "SMALL")).select("sku", (F.col("p_size") % 9 + 1).alias("qty"))
    return stock.refresh_event_items(items, stock.warehouse_stock(t.s_erp, "WH-CENTRAL"), _web(t)).withColumn("qty", F.col("qty").cast("double"))


@query("not_on_event", f"WITH {EVENT_LIST} SELECT name, warehouse_available FROM s_erp WHERE inventory_warehouse = 'WH-CENTRAL' AND warehouse_available > 0 AND name NOT IN (SELECT sku FROM items)")
def _(t):
    items = t.s_sku.filter(F.col("print").isin("PROMO", "SMALL")).select("sku")
    return stock.not_on_event(stock.warehouse_stock(t.s_erp, "WH-CENTRAL"), items).select("name", "warehouse_available")


@query("source_request", """
    SELECT k.sku, cast(e.warehouse_available as double) AS qty, cast(e.on_po as double) AS on_po, cast(p.quantity as double) AS store_qty,
           CASE WHEN e.warehouse_available > 0 OR e.on_po > 0 THEN 'Central' WHEN p.quantity > 0 THEN 'Store' ELSE 'Sample' END AS source
    FROM s_sku k LEFT JOIN s_erp e ON e.name = k.sku AND e.inventory_warehouse = 'WH-STORE' LEFT JOIN s_pos p ON p.name = k.sku""")
def _(t):
    out = stock.source_request(t.s_sku.select(F.lower("sku").alias("sku")), stock.warehouse_stock(t.s_erp, "WH-STORE"), t.s_pos)
    return out.withColumns({c: F.col(c).cast("double") for c in ("qty", "on_po", "store_qty")})


@query("refresh_deals", f"""
    WITH {WEB}, x AS (SELECT w.sku, w.regular_price, coalesce(w.sale_price, p.sale_price) AS sale_price, p.sale_price AS old_price, coalesce(e.warehouse_available, 0) AS qty
      FROM s_web w LEFT JOIN priced p ON p.sku = w.sku LEFT JOIN s_erp e ON e.name = w.sku AND e.inventory_warehouse = 'WH-CENTRAL')
    SELECT sku, cast(regular_price as double) AS regular_price, cast(sale_price as double) AS sale_price, cast(old_price as double) AS old_price, qty,
           CASE WHEN sale_price IS NULL THEN 0.0 ELSE round_even(cast(regular_price - sale_price as double) / cast(regular_price as double), 2) END AS discount FROM x""")
def _(t):
    return stock.refresh_deals(t.s_web.select("sku", "regular_price", "sale_price"), _web(t), stock.warehouse_stock(t.s_erp, "WH-CENTRAL"))


@query("replace_stock", """
    SELECT p.name, coalesce(e.warehouse_available, 0) AS quantity, cast(p.price as double) AS price FROM s_pos p LEFT JOIN s_erp e ON e.name = p.name AND e.inventory_warehouse = 'WH-STORE'""")
def _(t):
    snap = stock.warehouse_stock(t.s_erp, "WH-STORE").select("name", F.col("warehouse_available").alias("quantity"))
    return stock.replace_stock(t.s_pos.select("name", "quantity", "price"), snap, 0)


@query("extend_event_list", """
    WITH ev AS (SELECT 'Sale' AS type, sku, cast(price - 400 as double) AS sales_price FROM s_sku WHERE print = 'PROMO' AND size IN ('1', '2')),
    n AS (SELECT 'Discontinued', name, CASE WHEN regexp_matches(name, 'LARGE') THEN 45.0 WHEN regexp_matches(name, '^B12') THEN 15.0 ELSE 25.0 END FROM s_erp
          WHERE inventory_warehouse = 'WH-CENTRAL' AND warehouse_available > 0 AND ((regexp_matches(name, '^(B12-|B13-)') AND item_sku_seasons NOT LIKE '%26%') OR name LIKE 'B14-SMALL%'))
    SELECT a.type, a.sku, cast(a.sales_price as double) AS sales_price, e.warehouse_available AS central_qty, e.item_sku_seasons AS seasons, cast(p.quantity as double) AS store_qty
    FROM (SELECT * FROM ev UNION ALL SELECT * FROM n) a JOIN s_erp e ON e.name = a.sku AND e.inventory_warehouse = 'WH-CENTRAL' AND e.warehouse_available > 0 LEFT JOIN s_pos p ON p.name = a.sku""")
def _(t):
    event = t.s_sku.filter("print = 'PROMO' AND size IN ('1', '2')").select(F.lit("Sale").alias("type"), "sku", (F.col("price") - 400).alias("sales_price"))
    out = stock.extend_event_list(event, stock.warehouse_stock(t.s_erp, "WH-CENTRAL"), t.s_pos, ["B12-", "B13-"], "26", [("^B12", 15), ("LARGE", 45)], 25, ["B14-SMALL"])
    return out.withColumn("store_qty", F.col("store_qty").cast("double"))


