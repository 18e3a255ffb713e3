"""Demand and clearance jobs as queries."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from ..functions.months import trailing_months
from ..jobs import clearance, demand, stock
from .registry import AS_OF, CHANNELS, cents, half_even, query, renamed, spu, values, years

MONTH = AS_OF.month
K = 25
AUGUST = date(2001, 8, 20)
MISSING_BANDS = ["Sizes missing < 50%"] + [f"Sizes missing {p}%" for p in (50, 60, 70, 80, 90, 100)]
GRID = [(f"Sold out {y} yr", m, round(max(0, y - 2) * 0.1 + i * 0.05, 2)) for y in (1, 2, 3, 4) for i, m in enumerate(MISSING_BANDS)]

L12 = f"""l12 AS (SELECT sales_channel, adjust_msku, month, sum(qty)::BIGINT AS qty FROM s_sales
    WHERE year * 12 + month >= {AS_OF.year * 12 + MONTH - 12} AND year * 12 + month < {AS_OF.year * 12 + MONTH} GROUP BY 1, 2, 3)"""


def _months(ms):
    return "(" + ", ".join(map(str, ms)) + ")"


R3 = _months(trailing_months(MONTH))


def frame(months: str = R3, late: str = "", published: bool = False) -> str:
    """Catalog items with stock, demand and years of stock per SPU; category ``late`` counts June and July instead.

    With ``published`` only published items count, and an SPU's warehouse stock is the ERP's."""
    shown = " AND w.published = 1" if published else ""
    erp = f"(SELECT {spu('name')} AS spu, sum(warehouse_available)::BIGINT AS wh FROM s_erp WHERE inventory_warehouse = 'WH-CENTRAL' GROUP BY 1)"
    wh, joined = ("ew.wh", f" LEFT JOIN {erp} ew ON ew.spu = i.spu") if published else ("stk.qty_wh", "")
    sold_in = f"CASE WHEN split_part(adjust_msku, '-', 1) = '{late}' THEN month IN (6, 7) ELSE month IN {months} END" if late else f"month IN {months}"
    share_in = f"CASE WHEN category = '{late}' THEN month IN (6, 7) ELSE month IN {months} END" if late else f"month IN {months}"
    return f"""{L12},
    items AS (SELECT w.id, w.sku, CASE WHEN a.msku IS NOT NULL THEN a.seasons_sku ELSE b.seasons_sku END AS seasons, a.category_sku AS cat, {spu('w.sku')} AS spu, w.regular_price,
        CASE WHEN w.sale_price IS NULL THEN 0.0 ELSE (cast(w.regular_price as double) - cast(w.sale_price as double)) / cast(w.regular_price as double) END AS discount, coalesce(e.warehouse_available, 0) AS qty
      FROM s_web w LEFT JOIN s_master a ON a.msku = w.sku LEFT JOIN s_master b ON b.adjust_sku = w.sku LEFT JOIN s_erp e ON e.name = w.sku AND e.inventory_warehouse = 'WH-CENTRAL'
      WHERE w.regular_price IS NOT NULL{shown} AND w.sku IN (SELECT name FROM s_erp)),
    stk AS (SELECT {spu('adjust_msku')} AS spu, sum(inv_total_end_wk)::BIGINT AS qty_spu, sum(inv_warehouse)::BIGINT AS qty_wh FROM s_inv GROUP BY 1),
    sold AS (SELECT {spu('adjust_msku')} AS spu, sum(CASE WHEN {sold_in} THEN qty ELSE 0 END)::BIGINT AS t3, sum(CASE WHEN sales_channel = 'WEB' THEN CASE WHEN {sold_in} THEN qty ELSE 0 END END)::BIGINT AS t3w,
        sum(CASE WHEN sales_channel LIKE 'Amazon%' THEN qty END)::BIGINT AS m12 FROM l12 GROUP BY 1),
    miss AS (SELECT * FROM (SELECT {spu('name')} AS spu, count(DISTINCT regexp_replace(name, '^([A-Za-z0-9_]+-[A-Za-z0-9_]+-[A-Za-z0-9_]+).*', '\\1')) AS sizes, count(CASE WHEN warehouse_available > {K} THEN 1 END) AS in_stock
        FROM s_erp WHERE inventory_warehouse = 'WH-CENTRAL' GROUP BY 1) WHERE in_stock > 0),
    rat AS (SELECT category, cast(sum(CASE WHEN {share_in} THEN ratio ELSE 0 END) as double) AS r3 FROM s_ratio GROUP BY 1),
    f0 AS (SELECT i.*, stk.qty_spu, {wh} AS qty_wh, stk.qty_spu - stk.qty_wh AS qty_amz, sold.t3, sold.t3w, sold.m12, rat.r3,
        CASE WHEN miss.sizes IS NULL THEN NULL WHEN miss.sizes < miss.in_stock THEN 0.0 ELSE (miss.sizes - miss.in_stock) / miss.sizes END AS missing_share
      FROM items i JOIN stk ON stk.spu = i.spu LEFT JOIN sold ON sold.spu = i.spu LEFT JOIN miss ON miss.spu = i.spu LEFT JOIN rat ON rat.category = i.cat{joined}),
    f1 AS (SELECT *, {years('t3', 'r3')} AS y1, {years('t3w', 'r3')} AS y1w FROM f0),
    framed AS (SELECT *, CASE WHEN qty_amz >= m12 THEN {years('qty_wh', 'y1w')} WHEN qty_amz < m12 THEN {years('qty_spu', 'y1')} END AS time_yr FROM f1)"""


def missing_sql(null_label: str) -> str:
    decade = "cast(trunc((CASE WHEN missing_share < 0.5 THEN 0.0 ELSE missing_share END) * 10) as int) * 10"
    return f"CASE WHEN missing_share IS NULL THEN {null_label} WHEN {decade} = 0 THEN 'Sizes missing < 50%' ELSE 'Sizes missing ' || cast({decade} as varchar) || '%' END"


def off_price(d: str, scale: int) -> str:
    unit = 10 ** scale
    return f"{half_even(f'({unit} - cast(cast({d} as decimal(6,{scale})) * {unit} as hugeint)) * ' + cents('regular_price'), str(unit))} / 100.0::DOUBLE"


def _last12(t):
    return demand.last12(t.s_sales, AS_OF)


def _items(t):
    return demand.catalog_frame(t.s_web.filter("regular_price IS NOT NULL"), t.s_erp, t.s_master, "WH-CENTRAL")


def _missing(t):
    return demand.size_missing(stock.warehouse_stock(t.s_erp, "WH-CENTRAL"), K)


def _frame(t, include_current=False, special=None):
    return demand.with_years(_items(t), t.s_inv, _last12(t), t.s_ratio, _missing(t), MONTH, "WEB", "^Amazon", include_current=include_current, special=special)


def _holiday_frame(t):
    here = stock.warehouse_stock(t.s_erp, "WH-CENTRAL")
    items = demand.catalog_frame(t.s_web.filter("regular_price IS NOT NULL AND published = 1"), t.s_erp, t.s_master, "WH-CENTRAL")
    return demand.with_years(items, t.s_inv, _last12(t), t.s_ratio, _missing(t), MONTH, "WEB", "^Amazon", special={"B3": (6, 7)}, warehouse=demand.erp_spu_stock(here))


def _grid(t):
    return t.spark.createDataFrame(GRID, "time_band string, missing_band string, discount double")


@query("trailing_sales", f"WITH {L12} SELECT sales_channel, adjust_msku, month, qty FROM l12")
def _(t):
    return _last12(t)


@query("trailing_sales_scaled", f"""
    WITH x AS (SELECT sales_channel, adjust_msku, month, sum(qty)::BIGINT AS qty FROM s_sales WHERE year * 12 + month > {AUGUST.year * 12 + 8 - 12} AND year * 12 + month <= {AUGUST.year * 12 + 8} GROUP BY 1, 2, 3)
    SELECT sales_channel, adjust_msku, month, CASE WHEN month = 8 THEN round_even(cast(qty as double) / (20 / 31), 0) ELSE cast(qty as double) END AS qty FROM x""")
def _(t):
    return demand.last12(t.s_sales, AUGUST, include_current=True)


@query("month_ratio_refresh", """
    WITH this AS (SELECT CASE WHEN category = 'B5' THEN 'ZB5' ELSE category END AS category, month, CASE WHEN category = 'B6' THEN 0 ELSE qty END AS qty FROM s_cat_month WHERE year = 2001),
    sold AS (SELECT category, month, sum(qty)::BIGINT AS q FROM this WHERE month < 8 GROUP BY 1, 2), tot AS (SELECT category, sum(q)::BIGINT AS t FROM sold GROUP BY 1),
    sh AS (SELECT category, cast(sum(CASE WHEN month < 8 THEN ratio ELSE 0 END) as double) AS s FROM s_ratio GROUP BY 1)
    SELECT r.category, r.month, CASE WHEN r.month < 8 AND coalesce(tot.t, 0) <> 0 THEN coalesce(cast(sold.q as double), 0.0) / cast(tot.t as double) * sh.s ELSE cast(r.ratio as double) END AS ratio
    FROM s_ratio r LEFT JOIN sold ON sold.category = r.category AND sold.month = r.month LEFT JOIN tot ON tot.category = r.category JOIN sh ON sh.category = r.category
    WHERE r.category IN (SELECT category FROM this)""")
def _(t):
    this = t.s_cat_month.filter("year = 2001").withColumns({"qty": F.when(F.col("category") == "B6", 0).otherwise(F.col("qty")), "category": renamed("category", F.col("category") != "B5")})
    return demand.refresh_month_ratio(this, t.s_ratio, AUGUST)


@query("spu_rollup", f"""
    WITH {frame()} SELECT stk.spu, stk.qty_spu, stk.qty_wh, stk.qty_spu - stk.qty_wh AS qty_amz, cast(t3 as double) AS t_last3m, cast(t3w as double) AS t_last3m_web, cast(m12 as double) AS t_last12m_amz
    FROM stk LEFT JOIN sold ON sold.spu = stk.spu""")
def _(t):
    from ..operators.lookup import lookup
    cols = ["t_last3m", "t_last3m_web", "t_last12m_amz"]
    out = lookup(demand.spu_stock(t.s_inv), demand.spu_sales(_last12(t), trailing_months(MONTH), "WEB", "^Amazon"), "spu", cols, unique=True)
    return out.withColumns({c: F.col(c).cast("double") for c in cols})


@query("size_missing", f"""
    WITH {frame()} SELECT spu, sizes, in_stock, CASE WHEN sizes < in_stock THEN 0.0 ELSE (sizes - in_stock) / sizes END AS percent FROM miss""")
def _(t):
    return _missing(t)


@query("years_of_stock", f"""
    WITH {frame()}, x AS (SELECT *, sum(qty) OVER (PARTITION BY spu) AS on_web FROM framed WHERE regular_price > 0)
    SELECT sku, seasons, cat, spu, cast(regular_price as double) AS regular_price, discount, qty, round_even(time_yr, 1) AS time_yrs, {missing_sql('NULL')} AS size_percent_missing FROM x WHERE on_web > 0""")
def _(t):
    return demand.years_of_stock(_frame(t), t.shared)


BANDS = f"""b AS (SELECT * REPLACE (coalesce(time_yr, 10.0) AS time_yr), 'Sold out ' || cast(cast(trunc(least(coalesce(time_yr, 10.0), 3.0)) as int) + 1 as varchar) || ' yr' AS time_yrs,
      {missing_sql("'Sizes missing < 50%'")} AS size_percent_missing FROM framed),
    d AS (SELECT b.*, cast(g.v as double) AS sd FROM b LEFT JOIN {values(GRID, 'g(tb, mb, v)')} ON g.tb = b.time_yrs AND g.mb = b.size_percent_missing)"""


@query("deal_suggestion", f"""
    WITH {frame()}, {BANDS}
    SELECT sku, seasons, cat, spu, cast(regular_price as double) AS regular_price, discount, qty, time_yr, time_yrs, size_percent_missing, sd AS suggest_discount, {off_price('sd', 2)} AS suggest_price
    FROM d WHERE sd > 0 AND NOT coalesce(contains(seasons, 'S'), false)""")
def _(t):
    return demand.suggest_deals(_frame(t), _grid(t), MONTH)


@query("deal_suggestion_deeper", f"""
    WITH {frame()}, {BANDS} SELECT sku, discount, sd AS suggest_discount FROM d WHERE sd > 0 AND sd > discount""")
def _(t):
    return demand.suggest_deals(_frame(t), _grid(t), 6, deeper_only=True).select("sku", "discount", "suggest_discount")


@query("current_deals", f"""
    WITH {frame()} SELECT sku, seasons, spu, discount, qty FROM items WHERE NOT coalesce(contains(seasons, 'F'), false) AND discount > 0""")
def _(t):
    return demand.current_deals(_items(t), MONTH).select("sku", "seasons", "spu", "discount", "qty")


DEMAND = f"""{L12}, sold AS (SELECT adjust_msku, cast(sum(CASE WHEN month IN {R3} THEN qty ELSE 0 END) as double) AS s3 FROM l12 WHERE sales_channel IN ('Amazon.com', 'Amazon.ca', 'WEB') GROUP BY 1),
    stk AS (SELECT adjust_msku, sum(inv_warehouse + inv_amz_usa + inv_amz_ca)::BIGINT AS stock FROM s_inv GROUP BY 1),
    r AS (SELECT category, cast(sum(CASE WHEN month IN {R3} THEN ratio ELSE 0 END) as double) AS r3, cast(sum(CASE WHEN month = 3 THEN ratio ELSE 0 END) as double) AS r1,
        cast(sum(CASE WHEN month IN (3, 4, 5, 6) THEN ratio ELSE 0 END) as double) AS r4 FROM s_ratio GROUP BY 1),
    base AS (SELECT sold.adjust_msku, s3, stock, m.category_sku AS cat, m.seasons_sku AS seasons, m.msku_status AS status, r3, r1, r4
      FROM sold JOIN stk USING (adjust_msku) LEFT JOIN s_master m ON m.msku = sold.adjust_msku LEFT JOIN r ON r.category = m.category_sku)"""


@query("low_stock_month", f"""
    WITH {DEMAND}, a AS (SELECT *, {spu('adjust_msku')} AS spu, CASE WHEN r3 <> 0 THEN s3 / r3 * r1 END AS st FROM base),
    b AS (SELECT *, CASE WHEN stock < st THEN 0 WHEN stock >= st THEN cast(trunc(stock - st) as int) END AS lft FROM a), c AS (SELECT *, lft >= 12 OR st = 0 AS ok FROM b),
    e AS (SELECT *, avg(CASE WHEN ok THEN 1 WHEN NOT ok THEN 0 END) OVER (PARTITION BY spu) AS share FROM c)
    SELECT adjust_msku, spu, cat, seasons, s3 AS sales_last3m, st AS sales_this, stock, lft AS qty_left, cast(trunc(share * 100) as int) AS percent_sizes_ok FROM e WHERE contains(seasons, 'S') AND status = 'Active' AND NOT ok""")
def _(t):
    return demand.low_stock_month(_last12(t), t.s_inv, t.s_master, t.s_ratio, MONTH, CHANNELS, shared=t.shared)


@query("reorder_gap", f"""
    WITH {DEMAND}, p AS (SELECT item, sum(quantity - coalesce(quantity_on_shipments, 0)) AS po_remain FROM s_po WHERE warehouse = 'WH-STORE' GROUP BY 1 HAVING sum(quantity - coalesce(quantity_on_shipments, 0)) > 0),
    a AS (SELECT *, cast(trunc(s3 / nullif(r3, 0) * r4) as int) AS need FROM base)
    SELECT adjust_msku, cat, seasons, s3 AS sales_last3m, need, stock, coalesce(po_remain, 0.0) AS po_remain, need - stock - coalesce(po_remain, 0.0) AS gap
    FROM a LEFT JOIN p ON p.item = adjust_msku WHERE need - stock - coalesce(po_remain, 0.0) > 0""")
def _(t):
    return demand.reorder_gap(_last12(t), t.s_inv, t.s_master, t.s_ratio, t.s_po, MONTH, CHANNELS, "WH-STORE")


@query("to_inactivate", """
    WITH i AS (SELECT adjust_msku, sum(CASE WHEN inv_total_end_wk < 12 THEN 0 ELSE 1 END)::BIGINT AS n FROM s_inv GROUP BY 1)
    SELECT m.msku, m.msku_status, m.seasons_sku, p.quantity AS inv_pos, i.n AS inv_total FROM s_master m JOIN s_pos p ON p.name = m.msku JOIN i ON i.adjust_msku = m.msku
    WHERE m.msku_status = 'Active' AND NOT contains(m.seasons_sku, '26') AND p.quantity = 0 AND i.n = 0""")
def _(t):
    inv = t.s_inv.withColumn("inv_total_end_wk", F.when(F.col("inv_total_end_wk") < 12, 0).otherwise(1))
    return demand.to_inactivate(t.s_master, t.s_pos, inv, "26")


@query("bulk_dead", f"""
    WITH {frame()}, o AS (SELECT spu, min_by(seasons, sku) AS seasons, sum(qty)::BIGINT AS qty FROM items WHERE NOT contains(coalesce(seasons, ''), '26') AND qty > 1 AND regular_price > 0 GROUP BY 1),
    s AS (SELECT {spu('adjust_msku')} AS spu, cast(sum(CASE WHEN month BETWEEN 3 AND 8 THEN qty ELSE 0 END) as double) AS ss, cast(sum(CASE WHEN month BETWEEN 3 AND 8 THEN 0 ELSE qty END) as double) AS fw FROM l12 GROUP BY 1),
    x AS (SELECT o.*, coalesce(ss, 0.0) AS sales_ss, coalesce(fw, 0.0) AS sales_fw FROM o LEFT JOIN s ON s.spu = o.spu), y AS (SELECT *, {years('qty', '(sales_ss + sales_fw)')} AS time_yrs FROM x)
    SELECT spu, seasons, qty, sales_ss, sales_fw, time_yrs FROM y WHERE NOT contains(coalesce(seasons, ''), 'F') AND time_yrs > 0.05 AND qty > 60""")
def _(t):
    return clearance.bulk_dead(_items(t), _last12(t), "26", "F", 1, 0.05, 60)


@query("limited_sizes", f"""
    WITH {frame()}, n AS (SELECT spu, count(*) AS n FROM items GROUP BY 1), m AS (SELECT regexp_replace(spu, '-.*', '') AS cat, max(n) AS n_all FROM n GROUP BY 1),
    l AS (SELECT spu, count(*) AS n, regexp_replace(spu, '-.*', '') AS cat FROM items WHERE NOT contains(coalesce(seasons, ''), '26') AND qty > 1 AND regular_price > 0 GROUP BY spu)
    SELECT spu, n, l.cat, n_all FROM l JOIN m ON m.cat = l.cat WHERE n <> n_all""")
def _(t):
    return clearance.limited_sizes(_items(t), "26", 1)


WINTER = f"""{frame()}, ws AS (SELECT {spu('adjust_msku')} AS spu, cast(sum(CASE WHEN month BETWEEN 9 AND 12 THEN qty ELSE 0 END) as double) AS pk, cast(sum(qty) as double) AS yr FROM l12 GROUP BY 1),
    sh AS (SELECT category, cast(sum(CASE WHEN month BETWEEN 9 AND 12 THEN ratio ELSE 0 END) as double) AS rp, cast(sum(CASE WHEN month BETWEEN 1 AND 6 THEN ratio ELSE 0 END) as double) AS rh FROM s_ratio WHERE category NOT IN ('B5', 'B6') GROUP BY 1),
    w0 AS (SELECT i.*, stk.qty_spu, sh.rp, sh.rh, ws.pk, ws.yr FROM items i LEFT JOIN stk ON stk.spu = i.spu LEFT JOIN sh ON sh.category = i.cat LEFT JOIN ws ON ws.spu = i.spu
      WHERE contains(i.seasons, 'F') AND i.qty > 1 AND i.regular_price > 0),
    w1 AS (SELECT *, coalesce(rp, (SELECT quantile_cont(rp, 0.5) FROM w0)) AS r_peak, coalesce(rh, (SELECT quantile_cont(rh, 0.5) FROM w0)) AS r_half FROM w0),
    w2 AS (SELECT *, CASE WHEN pk IS NULL OR yr IS NULL THEN NULL ELSE greatest(pk / r_peak, yr) END AS sales_yr FROM w1), w AS (SELECT *, sales_yr * r_half AS sales_half FROM w2)"""


def bins_sql(name: str, source: str, n: int) -> str:
    """Tables ``name`` (inner bin edges of ``x``) and its sorted values, from ``source``."""
    def cut(i: int) -> str:
        h = f"((m.n - 1) * {i / n!r}::DOUBLE)"
        return (f"SELECT a.x + ({h} - floor({h})) * (b.x - a.x) AS e FROM (SELECT max(n) AS n FROM {name}_sorted) m "
                f"JOIN {name}_sorted a ON a.r = floor({h}) JOIN {name}_sorted b ON b.r = ceil({h})")

    return (f"{name}_sorted AS (SELECT x, row_number() OVER (ORDER BY x) - 1 AS r, count(*) OVER () AS n FROM ({source})), "
            f"{name} AS (SELECT * FROM ({' UNION '.join(cut(i) for i in range(1, n))}) WHERE e > (SELECT min(x) FROM {name}_sorted))")


def _winter(t, sales=None):
    growth = t.s_sku.select(F.col("cat").alias("category")).distinct().withColumn("growth", F.when(F.col("category").isin("B5", "B6"), None).otherwise(F.lit(0.1)))
    return clearance.winter_frame(_items(t), t.s_inv, _last12(t) if sales is None else sales, t.s_ratio, growth, 1, shared=t.shared)


@query("clearance_no_sales", f"""
    WITH {WINTER.replace("SELECT sales_channel, adjust_msku, month, sum(qty)", "SELECT sales_channel, CASE WHEN adjust_msku LIKE 'B4-%' THEN 'Q' || adjust_msku ELSE adjust_msku END AS adjust_msku, month, sum(qty)", 1)}
    SELECT sku, seasons, cat, spu, cast(regular_price as double) AS regular_price, discount, qty, cast(qty_spu as double) AS qty_spu FROM w WHERE sales_yr IS NULL""")
def _(t):
    other = F.when(F.col("adjust_msku").startswith("B4-"), F.concat(F.lit("Q"), "adjust_msku")).otherwise(F.col("adjust_msku"))  # sold under other names
    out = clearance.clearance_no_sales(_winter(t, _last12(t).withColumn("adjust_msku", other)))
    return out.select("sku", "seasons", "cat", "spu", "regular_price", "discount", "qty", F.col("qty_spu").cast("double").alias("qty_spu"))


@query("clearance_carry_over", f"""
    WITH {WINTER}, c0 AS (SELECT *, CASE WHEN qty_spu > sales_half THEN cast(trunc(qty_spu - sales_half) as int) ELSE 0 END AS lft FROM w WHERE sales_yr IS NOT NULL AND contains(seasons, '24')),
    c1 AS (SELECT *, round_even({years('lft', 'sales_half')}, 1) AS times FROM c0), c AS (SELECT *, coalesce(times <= 0.5 OR lft <= 20, false) AS small FROM c1),
    {bins_sql('q', 'SELECT times AS x FROM c WHERE NOT small AND times IS NOT NULL', 4)},
    s AS (SELECT *, CASE WHEN small THEN 0.05::DOUBLE WHEN times IS NOT NULL THEN (1 + (SELECT count(*) FROM q WHERE e < times)) * 5 / 100 + 0.05::DOUBLE END AS sug FROM c),
    z AS (SELECT *, CASE WHEN sug IS NOT NULL THEN greatest(sug, discount) END AS sd FROM s)
    SELECT sku, lft AS qty_left, times, sd AS suggest_discount, {off_price('sd', 4)} AS suggest_price FROM z""")
def _(t):
    return clearance.clearance_carry_over(_winter(t), "24", t.shared).select("sku", "qty_left", "times", "suggest_discount", "suggest_price")


@query("clearance_discontinued", f"""
    WITH {WINTER}, c0 AS (SELECT w.*, CASE WHEN miss.sizes < miss.in_stock THEN 0.0 ELSE (miss.sizes - miss.in_stock) / miss.sizes END AS ms FROM w LEFT JOIN miss ON miss.spu = w.spu
      WHERE sales_yr IS NOT NULL AND NOT contains(seasons, '24')),
    c1 AS (SELECT *, round_even({years('qty_spu', 'sales_yr')}, 1) AS times, coalesce(ms < 0.6, false) AS fl FROM c0), c2 AS (SELECT *, coalesce(times <= 1, false) AND fl AS small FROM c1),
    c AS (SELECT *, NOT small AND fl AND contains(seasons, '25') AS recent FROM c2),
    {bins_sql('q4', 'SELECT times AS x FROM c WHERE recent AND times IS NOT NULL', 4)},
    {bins_sql('q5', 'SELECT times AS x FROM c WHERE NOT small AND NOT recent AND times IS NOT NULL', 5)},
    s AS (SELECT *, CASE WHEN small THEN 0.05::DOUBLE WHEN times IS NULL THEN NULL WHEN recent THEN (1 + (SELECT count(*) FROM q4 WHERE e < times)) * 5 / 100 + 0.05::DOUBLE
        ELSE (1 + (SELECT count(*) FROM q5 WHERE e < times)) * 5 / 100 + 0.25::DOUBLE END AS sug FROM c),
    z AS (SELECT *, CASE WHEN sug IS NOT NULL THEN greatest(sug, discount) END AS sd FROM s)
    SELECT sku, times, ms AS missing_share, sd AS suggest_discount, {off_price('sd', 4)} AS suggest_price FROM z""")
def _(t):
    return clearance.clearance_discontinued(_winter(t), _missing(t), "24", "25", 0.6, t.shared).select("sku", "times", "missing_share", "suggest_discount", "suggest_price")


@query("clearance_grid", f"""
    WITH {frame(_months(trailing_months(MONTH, 3, True)))}, c0 AS (SELECT *, {years('qty_spu', 'y1')} AS time FROM framed WHERE contains(seasons, 'S') AND qty > 1 AND regular_price > 0),
    c AS (SELECT *, 'Sold out ' || cast(cast(trunc(least(CASE WHEN time IS NOT NULL THEN time END, 3.0)) as int) + 1 as varchar) || ' yr' AS tb, {missing_sql("'Sizes missing < 50%'")} AS mb FROM c0),
    e AS (SELECT * REPLACE (CASE WHEN time IS NOT NULL THEN tb END AS tb) FROM c),
    d AS (SELECT e.*, cast(g.v as double) AS sd FROM e LEFT JOIN {values(GRID, 'g(gt, gm, v)')} ON g.gt = e.tb AND g.gm = e.mb)
    SELECT sku, seasons, cat, spu, cast(regular_price as double) AS regular_price, qty, time, tb AS time_yrs, mb AS size_percent_missing, sd AS suggest_discount, {off_price('sd', 2)} AS suggest_price
    FROM d WHERE coalesce(time > 1, false) OR mb <> 'Sizes missing < 50%' OR NOT contains(seasons, '24')""")
def _(t):
    return clearance.clearance_grid(_frame(t, include_current=True), _grid(t), "S", "24", 1)


@query("event_candidates", f"""
    WITH {frame()} SELECT sku, seasons, cast(regular_price as double) AS regular_price, discount, qty, round_even(time_yr, 1) AS time_yrs FROM framed
    WHERE NOT contains(coalesce(seasons, ''), '26') AND qty > 1 AND regular_price > 0 AND round_even(time_yr, 1) > 0.2""")
def _(t):
    return clearance.event_candidates(_frame(t), "26", 1, 0.2)


@query("event_candidates_half_price", f"""
    WITH {frame()} SELECT sku, seasons, cast(regular_price as double) AS regular_price, discount, qty, round_even(time_yr, 1) AS time_yrs, {half_even(cents('regular_price'), '2')} / 100.0::DOUBLE AS wholesale_price FROM framed
    WHERE NOT contains(coalesce(seasons, ''), '26') AND qty > 5 AND regular_price > 0 AND round_even(time_yr, 1) >= 0.2 AND cat IN ('B1', 'B2', 'B3', 'B10') AND sku NOT IN (SELECT sku FROM s_web WHERE sale_price IS NOT NULL)""")
def _(t):
    return clearance.event_candidates(_frame(t), "26", 5, 0.2, strict=False, half_price=True, categories=["B1", "B2", "B3", "B10"], listed=t.s_web.filter("sale_price IS NOT NULL"))


@query("holiday_discounts", f"""
    WITH {frame(R3, 'B3', True)}, h0 AS (SELECT *, coalesce(round_even(time_yr, 2), 0.0) AS ty FROM framed WHERE qty > 1 AND regular_price > 0),
    h1 AS (SELECT *, CASE WHEN cat = 'B3' THEN 0.2 WHEN contains(coalesce(seasons, ''), '25F') THEN CASE WHEN ty > 4 THEN 0.2 ELSE 0.1 END ELSE 0.0 END AS rule FROM h0),
    h2 AS (SELECT *, row_number() OVER (ORDER BY rule, ty DESC, sku) AS rk FROM h1),
    h3 AS (SELECT *, cast(CASE WHEN rk <= 54 THEN 0.4 WHEN rk <= 101 THEN 0.3 WHEN rk <= 250 THEN 0.2 WHEN rk <= 500 THEN 0.1 ELSE rule END + CASE WHEN cat = 'B7' THEN 0.1 ELSE 0.0 END as double) AS d FROM h2),
    z AS (SELECT *, CASE WHEN d > discount THEN d ELSE discount END AS sd FROM h3)
    SELECT sku, seasons, cat, spu, cast(regular_price as double) AS regular_price, discount, qty, ty AS time_yrs, sd AS suggest_discount, {off_price('sd', 4)} AS sale_price FROM z""")
def _(t):
    return clearance.holiday_discounts(_holiday_frame(t), 1, "25F", late_categories=["B3"], bumps={"B7": 0.1}, shared=t.shared)


SIZES = {"B1": 60, "B4": 40, "B9": 70, "B11": 55}


@query("event_leftovers", f"""
    WITH {frame()}, pool AS (SELECT * FROM items WHERE cat IN ('B1', 'B4', 'B9', 'B11') AND qty > 1),
    sh AS (SELECT spu FROM pool GROUP BY spu HAVING count(*) <> CASE split_part(spu, '-', 1) WHEN 'B1' THEN 60 WHEN 'B4' THEN 40 WHEN 'B9' THEN 70 ELSE 55 END),
    s AS (SELECT adjust_msku, sum(qty)::BIGINT AS t, sum(CASE WHEN sales_channel = 'WEB' THEN qty END)::BIGINT AS w, sum(CASE WHEN sales_channel LIKE 'Amazon%' THEN qty END)::BIGINT AS m FROM l12 GROUP BY 1)
    SELECT sku, seasons, cast(regular_price as double) AS regular_price, qty, {years('qty', 's.t')} AS time_yrs, cast(s.t as double) AS total, cast(s.w as double) AS total_web, cast(s.m as double) AS total_market
    FROM pool LEFT JOIN s ON s.adjust_msku = sku WHERE sku NOT IN (SELECT sku FROM s_web WHERE sale_price IS NOT NULL)
      AND (NOT regexp_matches(coalesce(seasons, ''), '26|25|24') OR (spu IN (SELECT spu FROM sh) AND NOT contains(coalesce(seasons, ''), '26')))""")
def _(t):
    out = clearance.event_leftovers(_items(t), _last12(t), t.s_web.filter("sale_price IS NOT NULL"), SIZES, "26", ["26", "25", "24"], 1, "WEB", "^Amazon")
    return out.withColumns({c: F.col(c).cast("double") for c in ("total", "total_web", "total_market")})
