"""Reusable operators as queries."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from ..functions import sku
from ..functions.semantics import apply_rules, isin0, r_ifelse, rlike0, safe_div
from ..jobs import customers
from ..operators import bins, groups, keys, lookup as lk, reshape, rules, scan
from .registry import cat, query, spu, values

RULES = [("^B1[0-9]?-PROMO", 10.5, 1), ("-SMALL-", 20.25, 2), ("^B2", 30.0, 3), ("-PROMO-.*7$", 40.0, 4)]
CHAIN = [("^B", 1), ("^B1", 2), ("-PROMO-", 3), ("9$", 4)]
SIZE_GRID = [(f"S{i}", f"B{j}", round(0.05 * (i + 1) + 0.01 * j, 2)) for i in range(5) for j in range(1, 20)]
HOLIDAYS = (date(1996, 1, 1), date(1997, 7, 1), date(1998, 12, 25))


@query("lookup_unique", """
    SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey, l_quantity, p_brand AS brand, p_retailprice AS unit_price
    FROM lineitem LEFT JOIN part ON p_partkey = l_partkey""")
def _(t):
    out = lk.lookup(t.lineitem, t.part, {"l_partkey": "p_partkey"}, {"p_brand": "brand", "p_retailprice": "unit_price"}, unique=True)
    return out.select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_quantity", "brand", "unit_price")


@query("lookup_salted", """
    SELECT user_id, event_type, count(*) AS n, sum(CASE WHEN c_custkey IS NOT NULL THEN 1 ELSE 0 END)::BIGINT AS known,
           max(c_name) AS name
    FROM events LEFT JOIN customer ON c_custkey = user_id GROUP BY 1, 2""")
def _(t):
    out = lk.lookup(t.events.select("event_id", "user_id", "event_type"), t.customer, {"user_id": "c_custkey"}, {"c_name": "name"}, unique=True, flag="hit", salt=16)
    return out.groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("hit").cast("int")).alias("known"), F.max("name").alias("name"))


@query("lookup_default", """
    SELECT o_orderkey, CASE WHEN c.c_custkey IS NOT NULL THEN c.c_name ELSE 'unknown' END AS name,
           CASE WHEN c.c_custkey IS NOT NULL THEN c.bal ELSE -1.0 END AS balance
    FROM orders LEFT JOIN (SELECT c_custkey, c_name, CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal END AS bal FROM customer
                           ) c ON 2 * c.c_custkey = o_custkey""")
def _(t):
    dim = t.customer.withColumn("bal", F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal"))).withColumn("c_custkey", 2 * F.col("c_custkey"))
    out = lk.lookup(t.orders, dim, {"o_custkey": "c_custkey"}, {"c_name": "name", "bal": "balance"}, unique=True, defaults={"name": "unknown", "balance": -1.0})
    return out.select("o_orderkey", "name", "balance")


@query("lookup_chain", """
    SELECT w.sku, CASE WHEN a.msku IS NOT NULL THEN a.seasons_sku WHEN b.adjust_sku IS NOT NULL THEN b.seasons_sku END AS seasons
    FROM s_web w LEFT JOIN s_master a ON a.msku = w.sku LEFT JOIN s_master b ON b.adjust_sku = w.sku""")
def _(t):
    m = t.s_master
    out = lk.lookup_chain(t.s_web, [(m, {"sku": "msku"}), (m.filter("adjust_sku IS NOT NULL"), {"sku": "adjust_sku"})], {"seasons_sku": "seasons"}, unique=True)
    return out.select("sku", "seasons")


@query("grid_lookup", f"""
    SELECT k.sku, g.v AS discount FROM s_sku k
    LEFT JOIN {values(SIZE_GRID, 'g(a, b, v)')} ON g.a = 'S' || (k.p_size // 12) AND g.b = k.cat""")
def _(t):
    grid = t.spark.createDataFrame(SIZE_GRID, "row_key string, col_key string, value double")
    banded = t.s_sku.withColumn("band", F.concat(F.lit("S"), F.floor(F.col("p_size") / 12).cast("string")))
    return lk.grid_lookup(banded, grid, "band", "cat", "value", "discount").select("sku", "discount")


@query("regex_rules", f"""
    WITH hits AS (SELECT k.sku, r.price, row_number() OVER (PARTITION BY k.sku ORDER BY r.pos) AS rn
                  FROM s_sku k JOIN {values(RULES, 'r(item, price, pos)')} ON regexp_matches(k.sku, r.item))
    SELECT k.sku, cast(h.price as double) AS price FROM s_sku k LEFT JOIN hits h ON h.sku = k.sku AND h.rn = 1""")
def _(t):
    table = t.spark.createDataFrame(RULES, "item string, price double, pos int")
    return rules.regex_lookup(t.s_sku.select("sku"), table, "sku", "item", "pos", ["price"])


@query("regex_rules_chunked", f"""
    WITH hits AS (SELECT k.p_partkey, r.price, row_number() OVER (PARTITION BY k.p_partkey ORDER BY r.pos) AS rn
                  FROM s_sku k JOIN {values(RULES, 'r(item, price, pos)')} ON regexp_matches(k.sku, r.item))
    SELECT cast(price as double) AS price, count(*) AS n FROM lineitem JOIN hits ON p_partkey = l_partkey AND rn = 1 GROUP BY 1""")
def _(t):
    table = t.spark.createDataFrame(RULES, "item string, price double, pos int")
    lines = lk.lookup(t.lineitem, t.s_sku, {"l_partkey": "p_partkey"}, ["sku"], unique=True)
    out = rules.regex_lookup(lines, table, "sku", "item", "pos", ["price"])
    return out.filter("price IS NOT NULL").groupBy("price").agg(F.count(F.lit(1)).alias("n"))


@query("rule_chain", """
    SELECT sku, CASE WHEN regexp_matches(sku, '9$') THEN 4 WHEN regexp_matches(sku, '-PROMO-') THEN 3
                     WHEN regexp_matches(sku, '^B1') THEN 2 WHEN regexp_matches(sku, '^B') THEN 1 ELSE 0 END AS rule FROM s_sku""")
def _(t):
    return t.s_sku.select("sku", apply_rules("sku", CHAIN, 0).alias("rule"))


@query("null_rules", """
    SELECT event_type, count(*) AS n,
           sum(CASE WHEN item_tax_rate IS NULL THEN 0 WHEN item_tax_rate > 0.1 THEN 1 ELSE 0 END)::BIGINT AS high,
           sum(CASE WHEN item_tax_rate IS NULL THEN 1 ELSE 0 END)::BIGINT AS unknown,
           sum(CASE WHEN order_discounts IN ('Partner channel') THEN 0 ELSE 1 END)::BIGINT AS not_partner,
           sum(CASE WHEN order_discounts LIKE '%Staff%' THEN 0 ELSE 1 END)::BIGINT AS not_staff
    FROM s_line JOIN (SELECT event_id, event_type FROM events) e ON e.event_id = _pos GROUP BY 1""")
def _(t):
    lines = lk.lookup(t.s_line, t.events, {"_pos": "event_id"}, ["event_type"], unique=True)
    high = r_ifelse(F.col("item_tax_rate") > 0.1, F.lit(1), F.lit(0))
    one = lambda c: F.sum(c.cast("int"))
    return lines.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(high), F.lit(0)).alias("high"), one(high.isNull()).alias("unknown"),
        one(~isin0("order_discounts", ["Partner channel"])).alias("not_partner"), one(~rlike0("order_discounts", "Staff")).alias("not_staff"))


@query("semi_sold", "SELECT sku FROM s_sku WHERE EXISTS (SELECT 1 FROM lineitem WHERE 2 * l_partkey = p_partkey)")
def _(t):
    return lk.semi(t.s_sku, t.lineitem.select((2 * F.col("l_partkey")).alias("sold")), {"p_partkey": "sold"}).select("sku")


@query("anti_unsold", "SELECT sku FROM s_sku WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE 2 * l_partkey = p_partkey)")
def _(t):
    return lk.anti(t.s_sku, t.lineitem.select((2 * F.col("l_partkey")).alias("sold")), {"p_partkey": "sold"}).select("sku")


@query("rows_update", """
    WITH u AS (SELECT o_custkey, cast(sum(cast(o_totalprice as decimal(12,2))) as double) AS total FROM orders GROUP BY 1)
    SELECT c_custkey, CASE WHEN o_custkey IS NOT NULL THEN total ELSE c_acctbal END AS c_acctbal FROM customer LEFT JOIN u ON o_custkey = c_custkey""")
def _(t):
    new = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.sum(F.col("o_totalprice").cast("decimal(12,2)")).cast("double").alias("c_acctbal"))
    return lk.rows_update(t.customer.select("c_custkey", "c_acctbal"), new, "c_custkey", ["c_acctbal"])


@query("upsert_log", """
    WITH log AS (SELECT CASE WHEN o_orderstatus = 'O' THEN o_orderkey ELSE -o_orderkey END AS k, o_orderpriority AS status FROM orders),
         a AS (SELECT DISTINCT l_orderkey AS k FROM lineitem WHERE l_returnflag = 'A'),
         b AS (SELECT DISTINCT l_orderkey AS k FROM lineitem WHERE l_returnflag <> 'A')
    SELECT log.k, CASE WHEN a.k IS NOT NULL THEN 'Synced' WHEN b.k IS NOT NULL THEN 'Shipped' ELSE log.status END AS status
    FROM log LEFT JOIN a ON a.k = log.k LEFT JOIN b ON b.k = log.k
    UNION ALL SELECT k, 'Synced' FROM a WHERE k NOT IN (SELECT k FROM log)
    UNION ALL SELECT k, 'Shipped' FROM b WHERE k NOT IN (SELECT k FROM log)""")
def _(t):
    log = t.orders.selectExpr("CASE WHEN o_orderstatus = 'O' THEN o_orderkey ELSE -o_orderkey END AS k", "o_orderpriority AS status")
    batch = lambda which: t.lineitem.filter(which).select(F.col("l_orderkey").alias("k"))
    return keys.upsert_status(log, "k", "status", [(batch("l_returnflag = 'A'"), "Synced"), (batch("l_returnflag <> 'A'"), "Shipped")])


@query("calendar_fill", """
    WITH d AS (SELECT cast(o_orderdate as date) AS date, cast(sum(cast(o_totalprice as decimal(12,2))) as double) AS amount, count(*) AS n
               FROM orders GROUP BY 1),
         cal AS (SELECT cast(unnest(generate_series(date '1995-01-01', date '2001-12-31', interval 1 day)) as date) AS date)
    SELECT strftime(coalesce(d.date, cal.date), '%Y-%m-%d') AS date, coalesce(amount, 0.0) AS amount, coalesce(n, 0) AS n
    FROM d FULL JOIN (SELECT date FROM cal WHERE dayofweek(date) <> 0 AND date NOT IN (date '1996-01-01', date '1997-07-01', date '1998-12-25')) cal
      ON cal.date = d.date""")
def _(t):
    daily = t.orders.groupBy(F.to_date("o_orderdate").alias("date")).agg(
        F.sum(F.col("o_totalprice").cast("decimal(12,2)")).cast("double").alias("amount"), F.count(F.lit(1)).alias("n"))
    days = reshape.calendar(t.spark, date(1995, 1, 1), date(2001, 12, 31), closed=HOLIDAYS)
    return reshape.with_calendar(daily, days, {"amount": 0.0, "n": 0})


@query("weighted_count", "SELECT user_id, sum(k)::BIGINT AS points FROM s_event GROUP BY 1")
def _(t):
    return groups.weighted_count(t.s_event, "user_id", "k", "points")


@query("first_per_key", """
    SELECT o_custkey, o_orderkey, o_totalprice, o_orderstatus FROM
      (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders) WHERE rn = 1""")
def _(t):
    return keys.first_per_key(t.orders, "o_custkey", ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey", "o_totalprice", "o_orderstatus")


@query("union_prefer", """
    WITH a AS (SELECT sku, cast(sale_price as double) AS price FROM s_web WHERE sale_price IS NOT NULL)
    SELECT * FROM a UNION ALL SELECT sku, cast(price as double) FROM s_sku WHERE sku NOT IN (SELECT sku FROM a)""")
def _(t):
    a = t.s_web.filter("sale_price IS NOT NULL").selectExpr("sku", "sale_price AS price")
    return keys.union_prefer(a, t.s_sku.select("sku", "price"), "sku")


@query("densify_stock", """
    WITH h AS (SELECT name, warehouse_available AS q FROM s_erp WHERE inventory_warehouse = 'WH-STORE' AND warehouse_available > 20)
    SELECT name, q FROM h UNION ALL SELECT DISTINCT name, 0 FROM s_erp WHERE name NOT IN (SELECT name FROM h)""")
def _(t):
    here = t.s_erp.filter("inventory_warehouse = 'WH-STORE' AND warehouse_available > 20").selectExpr("name", "warehouse_available AS q")
    return keys.densify(here, t.s_erp.select("name"), {"q": 0})


@query("prefer_channel", """
    WITH r AS (SELECT *, CASE sales_channel WHEN 'WEB' THEN 0 WHEN 'Amazon.ca' THEN 1 WHEN 'Amazon.com' THEN 2 END AS rk FROM s_sales)
    SELECT adjust_msku, year, month, sales_channel, qty FROM r
    JOIN (SELECT adjust_msku AS m, year AS y, month AS mo, min(rk) AS best FROM r WHERE rk IS NOT NULL GROUP BY 1, 2, 3) b
      ON m = adjust_msku AND y = year AND mo = month AND best = rk""")
def _(t):
    return keys.prefer_rows(t.s_sales, ["adjust_msku", "year", "month"], "sales_channel", ["WEB", "Amazon.ca", "Amazon.com"]).select(
        "adjust_msku", "year", "month", "sales_channel", "qty")


@query("listagg_boxes", """
    WITH x AS (SELECT l_suppkey, l_returnflag, string_agg(l_orderkey || '-' || l_linenumber, ' | ' ORDER BY l_orderkey, l_linenumber, l_partkey) AS t,
                 cast(sum(l_quantity) as double) AS qty FROM lineitem GROUP BY 1, 2)
    SELECT l_suppkey, l_returnflag, qty, t AS boxes FROM x""")
def _(t):
    rows = t.lineitem.withColumn("box", F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")))
    return groups.collapse(rows, ["l_suppkey", "l_returnflag"], ["l_orderkey", "l_linenumber", "l_partkey"], " | ", {"box": "boxes"}, {"l_quantity": "qty"})


@query("run_length_orders", """
    WITH f AS (SELECT _pos, order_id, cast(ts as date) AS d,
                 CASE WHEN order_id IS DISTINCT FROM lag(order_id) OVER (PARTITION BY cast(ts as date) ORDER BY _pos) THEN 1 ELSE 0 END AS chg,
                 row_number() OVER (PARTITION BY cast(ts as date) ORDER BY _pos) AS rn FROM s_line)
    SELECT _pos, order_id, sum(CASE WHEN rn = 1 THEN 1 ELSE chg END) OVER (PARTITION BY d ORDER BY _pos ROWS UNBOUNDED PRECEDING)::BIGINT AS run FROM f""")
def _(t):
    lines = t.s_line.withColumn("d", F.to_date("ts"))
    return scan.run_id(lines, "order_id", "_pos", ["d"], "run", block_rows=1000).select("_pos", "order_id", "run")


@query("run_length_file", """
    WITH f AS (SELECT _pos, transaction_id, CASE WHEN transaction_id IS DISTINCT FROM lag(transaction_id) OVER (ORDER BY _pos) THEN 1 ELSE 0 END AS chg FROM s_pos2_line)
    SELECT _pos, sum(chg) OVER (ORDER BY _pos ROWS UNBOUNDED PRECEDING)::BIGINT AS no FROM f""")
def _(t):
    return scan.run_id(t.s_pos2_line, "transaction_id", "_pos", [], "no", block_rows=1000).select("_pos", "no")


@query("share_of_group", """
    WITH x AS (SELECT k.cat AS category, n_name AS country, cast(sum(l_quantity) as double) AS qty
               FROM lineitem JOIN s_sku k ON k.p_partkey = l_partkey JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
               JOIN nation ON n_nationkey = c_nationkey GROUP BY 1, 2)
    SELECT category, country, qty, qty / sum(qty) OVER (PARTITION BY category) AS share FROM x""")
def _(t):
    rows = lk.lookup(t.lineitem.select("l_partkey", "l_orderkey", "l_quantity"), t.s_sku, {"l_partkey": "p_partkey"}, {"cat": "category"}, unique=True)
    rows = rows.join(t.orders, F.col("o_orderkey") == F.col("l_orderkey")).join(t.customer, F.col("c_custkey") == F.col("o_custkey"))
    rows = rows.join(t.nation, F.col("n_nationkey") == F.col("c_nationkey"))
    agg = rows.groupBy("category", F.col("n_name").alias("country")).agg(F.sum("l_quantity").alias("qty"))
    return groups.share_of(agg, "qty", "category", "share")


@query("group_total", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, sum(l_quantity) OVER (PARTITION BY l_suppkey) AS supplier_qty FROM lineitem""")
def _(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    return groups.with_group_total(rows, "l_suppkey", {"supplier_qty": F.sum("l_quantity")})


@query("fill_down", """
    SELECT event_id, last_value(CASE WHEN k < 30 THEN cast(k as double) END IGNORE NULLS) OVER (PARTITION BY user_id % 5 ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS k,
           last_value(CASE WHEN event_type = 'click' THEN event_type END IGNORE NULLS) OVER (PARTITION BY user_id % 5 ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS kind
    FROM s_event""")
def _(t):
    rows = t.s_event.select("event_id", (F.col("user_id") % 5).alias("sheet"), F.when(F.col("k") < 30, F.col("k").cast("double")).alias("k"),
                            F.when(F.col("event_type") == "click", F.col("event_type")).alias("kind"))
    return scan.fill_down(rows, ["k", "kind"], "event_id", ["sheet"], block_rows=1000).drop("sheet")


@query("blank_repeats", """
    SELECT event_id, CASE WHEN row_number() OVER (PARTITION BY user_id ORDER BY event_id) = 1 THEN cast(user_id as varchar) ELSE '' END AS label FROM events""")
def _(t):
    return scan.blank_repeats(t.events.select("event_id", F.col("user_id").cast("string").alias("label")), ["label"], "event_id")


@query("exact_quantiles", """
    WITH s AS (SELECT l_extendedprice AS x, row_number() OVER (ORDER BY l_extendedprice) - 1 AS r, count(*) OVER () AS n FROM lineitem),
         p AS (SELECT unnest([0.0, 0.1, 0.25, 0.5, 0.9, 1.0]) AS p),
         h AS (SELECT p, (SELECT max(n) FROM s) AS n FROM p)
    SELECT cast(h.p as double) AS p, a.x + (((h.n - 1) * cast(h.p as double)) - floor((h.n - 1) * cast(h.p as double))) * (b.x - a.x) AS q
    FROM h JOIN s a ON a.r = floor((h.n - 1) * cast(h.p as double)) JOIN s b ON b.r = ceil((h.n - 1) * cast(h.p as double))""")
def _(t):
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    q = bins.exact_quantiles(t.lineitem, "l_extendedprice", probs)
    return q.select(F.explode(F.arrays_zip(F.array(*[F.lit(p) for p in probs]).alias("p"), F.col("q"))).alias("z")).select("z.p", "z.q")


@query("equal_count_bins", """
    WITH s AS (SELECT p_partkey, p_size, row_number() OVER (ORDER BY p_size) - 1 AS r, count(*) OVER () AS n FROM part),
         e AS (SELECT i, (SELECT min(p_size) FROM s WHERE r >= floor((n - 1) * i / 6.0)) AS lo, (SELECT min(p_size) FROM s WHERE r >= ceil((n - 1) * i / 6.0)) AS hi,
                 (SELECT max((n - 1) * i / 6.0) FROM s) AS h FROM (SELECT unnest([1, 2, 3, 4, 5]) AS i)),
         q AS (SELECT DISTINCT lo + (h - floor(h)) * (hi - lo) AS edge FROM e)
    SELECT p_partkey, p_size, (1 + (SELECT count(*) FROM q WHERE edge < p_size AND edge > (SELECT min(p_size) FROM part)))::INT AS bin FROM part""")
def _(t):
    return bins.equal_count_bin(t.part.select("p_partkey", "p_size"), "p_size", 6)


@query("impute_median", """
    SELECT sku, coalesce(cast(regular_price as double), (SELECT quantile_cont(cast(regular_price as double), 0.5) FROM s_web)) AS price FROM s_web""")
def _(t):
    return bins.impute_median(t.s_web.select("sku", F.col("regular_price").cast("double").alias("price")), ["price"])


@query("rank_bands", """
    WITH r AS (SELECT p_partkey, p_retailprice, row_number() OVER (ORDER BY p_size, p_retailprice DESC, p_partkey) AS rk FROM part)
    SELECT p_partkey, CASE WHEN rk <= 54 THEN 0.4 WHEN rk <= 101 THEN 0.3 WHEN rk <= 250 THEN 0.2 WHEN rk <= 500 THEN 0.1 ELSE 0.0 END::DOUBLE AS discount FROM r""")
def _(t):
    out = bins.assign_by_rank(t.part, ["p_partkey"], ["p_size", "-p_retailprice"], [(54, .4), (101, .3), (250, .2), (500, .1)], F.lit(0.0), "discount")
    return out.select("p_partkey", "discount")


@query("explode_range", """
    SELECT l_orderkey, l_partkey, l_suppkey, cast(unnest(generate_series(l_linenumber, l_linenumber + cast(l_quantity as int) % 4)) as int) AS box FROM lineitem""")
def _(t):
    rows = t.lineitem.withColumn("last", (F.col("l_linenumber") + F.col("l_quantity").cast("int") % 4))
    return reshape.explode_range(rows, "l_linenumber", "last", "box").select("l_orderkey", "l_partkey", "l_suppkey", "box")


@query("split_rows", "SELECT p_partkey, trim(unnest(string_split(p_name, ' '))) AS word FROM part")
def _(t):
    return reshape.split_rows(t.part.select("p_partkey", F.col("p_name").alias("word")), "word", " ")


@query("unpivot_regions", """
    SELECT po, sku, vendor, r.region, r.qty FROM s_request, LATERAL (VALUES ('CA', qty_ca), ('UK', qty_uk), ('DE', qty_de), ('AU', qty_au), ('JP', qty_jp), ('CN', qty_cn)) AS r(region, qty)
    WHERE r.qty IS NOT NULL""")
def _(t):
    return reshape.unpivot_regions(t.s_request, ["po", "sku", "vendor"], {f"qty_{r.lower()}": r for r in ("CA", "UK", "DE", "AU", "JP", "CN")})


@query("pivot_fixed", """
    SELECT l_suppkey, sum(CASE WHEN l_returnflag = 'A' THEN l_quantity END) AS qty_a, count(CASE WHEN l_returnflag = 'A' THEN 1 END) AS n_a,
           sum(CASE WHEN l_returnflag = 'R' THEN l_quantity END) AS qty_r, count(CASE WHEN l_returnflag = 'R' THEN 1 END) AS n_r
    FROM lineitem GROUP BY 1""")
def _(t):
    return reshape.pivot_fixed(t.lineitem, ["l_suppkey"], "l_returnflag", {"A": "a", "R": "r"}, {"qty": F.sum("l_quantity"), "n": F.count("l_quantity")}).withColumns(
        {"n_a": F.coalesce("n_a", F.lit(0)), "n_r": F.coalesce("n_r", F.lit(0))})


@query("with_subtotals", """
    SELECT l_suppkey, l_returnflag, sum(l_quantity) AS l_quantity, 'detail' AS level FROM lineitem GROUP BY 1, 2
    UNION ALL SELECT l_suppkey, NULL, sum(l_quantity), 'subtotal' FROM lineitem GROUP BY 1""")
def _(t):
    return groups.with_subtotals(t.lineitem, ["l_suppkey"], ["l_returnflag"], ["l_quantity"])


@query("top_k_groups", """
    SELECT o_orderpriority, o_orderkey, o_totalprice FROM
      (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders) WHERE rn <= 5""")
def _(t):
    return keys.top_k(t.orders, 5, [F.col("o_totalprice").desc(), F.col("o_orderkey")], ["o_orderpriority"]).select("o_orderpriority", "o_orderkey", "o_totalprice")


@query("total_row", "SELECT max_by(value, event_id) AS value, max_by(event_type, event_id) AS event_type FROM events")
def _(t):
    return groups.total_row(t.events.select("event_id", "value", "event_type"), "event_id")


@query("sku_grammar", f"""
    SELECT adjust_msku AS sku, {cat('adjust_msku')} AS category, {spu('adjust_msku')} AS spu,
           regexp_replace(adjust_msku, '^([A-Za-z0-9_]+-[A-Za-z0-9_]+-[A-Za-z0-9_]+).*', '\\1') AS spu_size,
           regexp_replace(adjust_msku, '^[A-Za-z0-9_]+-[A-Za-z0-9_]+-', '') AS size, regexp_replace(adjust_msku, '.*-', '') AS tail, sum(qty)::BIGINT AS qty
    FROM s_sales GROUP BY 1""")
def _(t):
    s = t.s_sales.groupBy(F.col("adjust_msku").alias("sku")).agg(F.sum("qty").alias("qty"))
    return s.select("sku", sku.category("sku").alias("category"), sku.spu("sku").alias("spu"), sku.spu_size("sku").alias("spu_size"),
                    sku.size("sku").alias("size"), sku.size_tail("sku").alias("tail"), "qty")


@query("share_true", """
    SELECT l_suppkey, avg(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS returned, count(DISTINCT l_partkey) AS parts FROM lineitem GROUP BY 1 HAVING count(*) >= 10""")
def _(t):
    out = t.lineitem.groupBy("l_suppkey").agg(safe_div(F.count_if(F.col("l_returnflag") == "R"), F.count(F.lit(1))).alias("returned"),
                                              F.count_distinct("l_partkey").alias("parts"), F.count(F.lit(1)).alias("n"))
    return out.filter(F.col("n") >= 10).drop("n")


@query("contact_consolidate", """
    WITH c AS (SELECT first_name || ' ' || last_name AS name, nullif(phone_number, '') AS p, nullif(email_address, '') AS e, _pos FROM s_customer)
    SELECT name, CASE WHEN count(DISTINCT p) = 1 THEN max(p) ELSE string_agg(p, '|' ORDER BY _pos) END AS phone_number,
           CASE WHEN count(DISTINCT e) = 1 THEN max(e) ELSE string_agg(e, '|' ORDER BY _pos) END AS email_address
    FROM c WHERE trim(name) <> '' GROUP BY 1""")
def _(t):
    return customers.consolidate_contacts(t.s_customer)


@query("contact_ambiguous", """
    SELECT first_name || ' ' || last_name AS name, string_agg(nullif(email_address, ''), '|' ORDER BY _pos) AS email_address
    FROM s_customer WHERE first_name || last_name <> '' GROUP BY 1 HAVING count(DISTINCT nullif(email_address, '')) > 1""")
def _(t):
    return customers.ambiguous_contacts(customers.consolidate_contacts(t.s_customer)).select("name", "email_address")


CONTACT_VALUES = """v AS (SELECT name, field, value, count(*) AS n, min(_pos) AS first_pos FROM (
        SELECT first_name || ' ' || last_name AS name, 'phone_number' AS field, nullif(phone_number, '') AS value, _pos FROM s_customer
        UNION ALL SELECT first_name || ' ' || last_name, 'email_address', nullif(email_address, ''), _pos FROM s_customer)
      WHERE trim(name) <> '' AND value IS NOT NULL GROUP BY 1, 2, 3)"""


@query("contact_values", f"WITH {CONTACT_VALUES} SELECT * FROM v")
def _(t):
    return customers.contact_values(t.s_customer)


@query("contact_conflicts", f"""
    WITH {CONTACT_VALUES} SELECT name, field, value, n, first_pos, n_values, cast(n_rows AS bigint) AS n_rows
    FROM v JOIN (SELECT name, field, count(*) AS n_values, sum(n) AS n_rows FROM v GROUP BY 1, 2 HAVING count(*) > 1) USING (name, field)""")
def _(t):
    return customers.contact_conflicts(t.s_customer)
