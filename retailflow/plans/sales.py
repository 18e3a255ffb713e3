"""Sales order, customer and report jobs as queries."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from ..constants import MARKET_HOME
from ..jobs import customers, orders, reports
from ..operators.lookup import lookup
from ..operators.reshape import calendar
from .catalog_prices import TAXABLE
from .registry import AS_OF, cat, cents, half_even, query, renamed, spu

MAIN = orders.Store("store 1", "SHOP 1", "Retail : Store 1", "WH-STORE", "CLR")
SECOND = orders.Store("store 2", "SHOP 2", "Retail : Store 2", "WH-CENTRAL", "CLS")
BLOCK = 1000
DAY, YMD = AS_OF.strftime("%m/%d/%Y"), AS_OF.strftime("%y%m%d")

CONTACTS = """contacts AS (SELECT name, CASE WHEN count(DISTINCT p) = 1 THEN max(p) ELSE string_agg(p, '|' ORDER BY _pos) END AS phone,
    CASE WHEN count(DISTINCT e) = 1 THEN max(e) ELSE string_agg(e, '|' ORDER BY _pos) END AS email
  FROM (SELECT first_name || ' ' || last_name AS name, nullif(phone_number, '') AS p, nullif(email_address, '') AS e, _pos FROM s_customer) WHERE trim(name) <> '' GROUP BY 1)"""


def _as_double(df, *cols):
    return df.withColumns({c: F.col(c).cast("double") for c in cols})


@query("pos_sales_orders", f"""
    WITH {CONTACTS}, l AS (SELECT l.*, CASE WHEN item_sku IN (SELECT sku FROM s_sku) THEN item_sku ELSE 'MISC-ITEM' END AS item, cast(ts as date) AS d FROM s_line l
      WHERE order_payment_state = 'Paid' AND refunded = 'false' AND exchanged = 'false' AND NOT coalesce(contains(order_discounts, 'Partner'), false)),
    f AS (SELECT *, CASE WHEN order_id IS DISTINCT FROM lag(order_id) OVER (PARTITION BY d ORDER BY _pos) THEN 1 ELSE 0 END AS chg FROM l),
    r AS (SELECT *, sum(chg) OVER (PARTITION BY d ORDER BY _pos ROWS UNBOUNDED PRECEDING) AS run FROM f),
    p AS (SELECT order_id, customer_name, tender FROM s_payment WHERE result = 'SUCCESS')
    SELECT CASE WHEN tender = 'Cash' THEN 'Cash' WHEN contains(tender, 'WeChat') THEN 'AlphaPay' ELSE 'Clover' END AS payment_option, 'FBM : CA' AS class, strftime(d, '%m/%d/%Y') AS order_date,
      CASE WHEN order_employee_name = 'Ann' THEN 'CLS' ELSE 'CLR' END || strftime(d, '%y%m%d') || '-' || CASE WHEN run < 10 THEN '0' ELSE '' END || cast(run as varchar) AS ref_id,
      CASE WHEN order_employee_name = 'Ann' THEN 'SHOP 2' ELSE 'SHOP 1' END AS order_type, CASE WHEN order_employee_name = 'Ann' THEN 'Retail : Store 2' ELSE 'Retail : Store 1' END AS department,
      CASE WHEN order_employee_name = 'Ann' THEN 'WH-CENTRAL' ELSE 'WH-STORE' END AS warehouse, 'POS sales' AS memo, r.order_id, item AS item_sku, 1 AS quantity, 'Custom' AS price_level,
      cast(item_total as double) AS rate, cast(nullif(total_discount + order_discount_proportion, 0) as double) AS coupon_discount,
      regexp_replace(coalesce(order_discounts, '') || coalesce(discounts, ''), ' -.*', '') AS coupon_code,
      CASE WHEN item_tax_rate = 0.05 THEN 'CA-BC-GST' WHEN item_tax_rate = 0.12 THEN 'CA-BC-TAX' WHEN item_tax_rate IS NOT NULL THEN '' END AS tax_code, cast(tax_amount as double) AS tax_amount,
      CASE WHEN order_employee_name = 'Ann' THEN 'store 2' ELSE 'store 1' END AS customer, p.customer_name AS recipient, c.phone AS recipient_phone, c.email AS recipient_email,
      '' AS shipping_carrier, '' AS shipping_method, 0 AS shipping_cost
    FROM r JOIN p ON p.order_id = r.order_id AND p.tender IS NOT NULL LEFT JOIN contacts c ON c.name = p.customer_name""")
def _(t):
    contacts = customers.consolidate_contacts(t.s_customer)
    items = t.s_sku.select(F.col("sku").alias("name"))
    return orders.pos_sales_orders(t.s_line, t.s_payment, contacts, items, "Ann", ["Partner"], MAIN, SECOND, block_rows=BLOCK)


@query("sold_by_employee", "SELECT item_sku AS item, count(*) AS quantity FROM s_line WHERE order_employee_name = 'Ann' GROUP BY 1")
def _(t):
    return orders.sold_by_employee(t.s_line, "Ann")


NET, TAXC = "cast(replace(net_sales, '$', '') as decimal(12,2))", "cast(replace(tax, '$', '') as decimal(12,2))"


@query("pos2_sales_orders", f"""
    WITH l AS (SELECT *, CASE WHEN item IN (SELECT sku FROM s_sku) THEN item ELSE 'MISC-ITEM' END AS it, cast(date as date) AS d, {NET} AS net, {TAXC} AS tx FROM s_pos2_line),
    f AS (SELECT *, CASE WHEN transaction_id IS DISTINCT FROM lag(transaction_id) OVER (PARTITION BY d ORDER BY _pos) THEN 1 ELSE 0 END AS chg FROM l),
    r AS (SELECT *, sum(chg) OVER (PARTITION BY d ORDER BY _pos ROWS UNBOUNDED PRECEDING) AS run FROM f),
    p AS (SELECT payment_id, cash FROM s_pos2_payment WHERE event_type <> 'Refund')
    SELECT CASE WHEN p.cash = '$0.00' OR p.cash IS NULL THEN 'Square' ELSE 'Cash' END AS payment_option, strftime(d, '%m/%d/%Y') AS order_date,
      'SQ' || strftime(d, '%y%m%d') || '-' || CASE WHEN run < 10 THEN '0' ELSE '' END || cast(run as varchar) AS ref_id, CASE WHEN location = 'South' THEN 'WH-CENTRAL' ELSE 'WH-STORE' END AS warehouse,
      transaction_id AS order_id, it AS item_sku, qty AS quantity, {half_even(cents('net'), 'cast(qty as hugeint)')} / 100.0::DOUBLE AS rate,
      cast(nullif(cast(replace(discounts, '$', '') as decimal(12,2)), 0) as double) AS coupon_discount,
      CASE WHEN net = 0 THEN NULL WHEN {half_even(cents('tx') + ' * 100', cents('net'))} = 5 THEN 'CA-BC-GST' WHEN {half_even(cents('tx') + ' * 100', cents('net'))} = 12 THEN 'CA-BC-TAX' ELSE '' END AS tax_code,
      cast(tx as double) AS tax_amount, coalesce(customer_name, '') AS recipient, c.phone AS recipient_phone, c.email AS recipient_email
    FROM r LEFT JOIN p ON p.payment_id = r.payment_id LEFT JOIN s_pos2_customer c ON c.customer_id = r.customer_id WHERE qty > 0""")
def _(t):
    items = t.s_sku.select(F.col("sku").alias("name"))
    out = orders.pos2_sales_orders(t.s_pos2_line, t.s_pos2_payment, t.s_pos2_customer, items, "South", MAIN, SECOND, block_rows=BLOCK)
    return out.select("payment_option", "order_date", "ref_id", "warehouse", "order_id", "item_sku", "quantity", "rate", "coupon_discount", "tax_code", "tax_amount",
                      "recipient", "recipient_phone", "recipient_email")


LINE_NET = "(lineitem_total - lineitem_total_discount)"


@query("market_cash_sales", f"""
    SELECT strftime(cast(created_at as timestamp), '%m/%d/%Y') AS order_date, order_no AS order_id, 'MKT-' || order_no AS ref_id, lineitem_sku AS item_sku, lineitem_quantity AS quantity,
      {half_even(cents(LINE_NET), 'cast(lineitem_quantity as hugeint)')} / 100.0::DOUBLE AS rate, cast(nullif(lineitem_total_discount, 0) as double) AS coupon_discount,
      shipping_last_name || shipping_first_name AS recipient, phone AS recipient_phone, email AS recipient_email, 'Longxing' AS shipping_carrier, cast(shipping as double) AS shipping_cost, 'AlphaPay' AS payment_option
    FROM s_market WHERE financial_status = 'paid' AND shipping_country = '中国'""")
def _(t):
    return orders.market_cash_sales(t.s_market, MARKET_HOME).select("order_date", "order_id", "ref_id", "item_sku", "quantity", "rate", "coupon_discount", "recipient", "recipient_phone",
                                                             "recipient_email", "shipping_carrier", "shipping_cost", "payment_option")


TAX_TREE = """CASE WHEN shipping_country = 'US' THEN '.' WHEN shipping_province IN ('AB', 'NT', 'NU', 'YT') THEN 'CA-' || shipping_province || '-GST'
      WHEN shipping_province IN ('NB', 'NL') THEN 'CA-' || shipping_province || '-HST'
      WHEN shipping_province IN ('NS', 'ON', 'PE') THEN 'CA-' || shipping_province || CASE WHEN cat IN ('B1', 'B7', 'B12', 'B20') THEN '-HST' ELSE '-GST' END
      ELSE 'CA-' || shipping_province || CASE WHEN cat IN ('B1', 'B7', 'B12', 'B20') THEN '-TAX' ELSE '-GST' END END"""


@query("tax_code_tree", f"""
    WITH m AS (SELECT * REPLACE (replace(replace(shipping_country, '美国', 'US'), '加拿大', 'CA') AS shipping_country, replace(shipping_province, '不列颠哥伦比亚', 'BC') AS shipping_province) FROM s_market),
    x AS (SELECT *, 'MKT' || shipping_country || '-' || order_no AS oid, strftime(cast(created_at as timestamp), '%m/%d/%Y') AS od, shipping_address1 || ' ' || coalesce(shipping_address2, '') AS addr,
      CASE WHEN delivery_method = 'pickup' THEN pickup_person_name ELSE shipping_first_name || ' ' || shipping_last_name END AS person FROM m WHERE financial_status = 'paid' AND shipping_country <> '中国')
    SELECT CASE WHEN shipping_country = 'CA' THEN 'market CA' ELSE 'market US' END AS customer_id, 'MARKET ' || shipping_country AS order_type_code, oid AS order_id, oid AS ref_number, '{DAY}' AS date, od AS order_date,
      od AS sales_effective_date, '03/16/2001' AS ship_by_date, 'Custom' AS price_level, lineitem_sku AS sku, cast(lineitem_unit_price as double) AS unit_price, lineitem_quantity AS qty, cast({LINE_NET} as double) AS amount,
      {TAX_TREE} AS tax_code, cast(lineitem_total_discount as double) AS coupon_discount, promotion_detail AS order_coupon_code, cast(shipping as double) AS shipping_cost, '.' AS shipping_tax_code, cast(total as double) AS order_total,
      CASE WHEN delivery_method <> 'pickup' THEN CASE WHEN shipping = 0 THEN 'Free shipping over $69' ELSE 'Parcel with Tracking' END WHEN shipping_city = 'City1' THEN 'Pickup at Campus'
           WHEN shipping_city = 'City2' THEN 'Pickup at Office' ELSE 'Pickup at Warehouse' END AS shipping_method,
      'Available QTY' AS commit, payment_method AS marketplace_payment_method, CASE WHEN payment_method = 'Stripe' THEN 'Stripe CAD Allvalue' ELSE 'AlphaPay' END AS payment_option, 'CIA' AS terms, 'No' AS to_be_emailed,
      person AS shipping_name, addr AS shipping_address1, shipping_city, shipping_province, shipping_country, shipping_zip AS shipping_postal_code,
      person AS billing_name, addr AS billing_address1, shipping_city AS billing_city, shipping_province AS billing_province, shipping_country AS billing_country, shipping_zip AS billing_postal_code,
      'Retail : Marketplace' AS department, 'FBM : ' || shipping_country AS class, 'WH-CENTRAL' AS warehouse, person AS recipient, email AS recipient_email, phone AS recipient_phone,
      CASE WHEN shipping_country = 'CA' THEN 'Canada Post' ELSE 'USPS' END AS carrier, CASE WHEN shipping_country = 'CA' THEN 'Expedited Parcel' ELSE 'USPS Priority Mail' END AS shipping_service,
      CASE WHEN delivery_method <> 'pickup' THEN 'Standard' WHEN shipping_city = 'City1' THEN 'Campus Pickup' ELSE shipping_city || ' Pickup' END AS service, '' AS order_issue, 'Marketplace order' AS memo
    FROM x""")
def _(t):
    return orders.market_sales_orders(t.s_market, MARKET_HOME, AS_OF, TAXABLE, [("City1", "Pickup at Campus"), ("City2", "Pickup at Office")], "Pickup at Warehouse", [("City1", "Campus Pickup")])


@query("returns_adjustment", f"""
    SELECT '{DAY}' AS date, k.sku AS item, cast(l_quantity as int) - 5 AS adjust_qty_by, CASE WHEN l_linenumber % 2 = 0 THEN 'RT' ELSE 'EXC' END AS reason_code,
      l_orderkey || ' | ' || l_linestatus || ' | ' || 'Size' || ' | ' || CASE WHEN l_linenumber = 3 THEN 'n' ELSE '' END AS memo, 'WH-STORE' AS warehouse, 'IAR-{YMD}-1' AS external_id
    FROM lineitem JOIN s_sku k ON k.p_partkey = l_partkey WHERE l_linenumber < 6 AND l_quantity <> 5""")
def _(t):
    lines = lookup(t.lineitem, t.s_sku, {"l_partkey": "p_partkey"}, ["sku"], unique=True)
    rec = lines.select(
        F.col("sku").alias("return_item_sku"), (F.col("l_quantity").cast("int") - 5).alias("return_qty"), F.when(F.col("l_linenumber") % 2 == 1, 1).alias("exchange_qty"),
        F.col("l_orderkey").cast("string").alias("original_order_id"), F.col("l_linestatus").alias("order_channel"), F.lit("Size").alias("return_reason"),
        F.when(F.col("l_linenumber") == 3, "n").alias("notes"), F.when(F.col("l_linenumber") >= 6, "IA").alias("ns_action"))
    return orders.returns_adjustment(rec, AS_OF)


PICKUPS = [orders.Pickup("R Pickup", None, ("1 River Rd", "", "Rivertown", "BC", "V1V 1V1")), orders.Pickup("U Pickup", None, ("2 Campus Ln", "", "Hilltown", "BC", "V2V 2V2")),
           orders.Pickup("S Pickup", "South", ("3 South St", "Unit 3", "Southtown", "BC", "V3V 3V3"))]


@query("pos2_import_orders", f"""
    WITH f AS (SELECT *, CASE WHEN transaction_id IS DISTINCT FROM lag(transaction_id) OVER (ORDER BY _pos) THEN 1 ELSE 0 END AS chg, {NET} AS net FROM s_pos2_line),
    r AS (SELECT *, sum(chg) OVER (ORDER BY _pos ROWS UNBOUNDED PRECEDING) AS no FROM f),
    j AS (SELECT r.*, c.first_name, c.last_name, c.phone, c.email, c.address1, c.address2, c.city, c.state, c.zip, coalesce(c.first_name, '') || coalesce(c.last_name, '') = '' AS nameless,
        CASE WHEN contains(concat_ws('~', customer_name, c.address1), 'R Pickup') THEN 1 WHEN contains(coalesce(c.address1, ''), 'U Pickup') THEN 2 WHEN location = 'South' THEN 3 ELSE 0 END AS pk
      FROM r LEFT JOIN s_pos2_customer c ON c.customer_id = r.customer_id)
    SELECT replace(date, '-', '') AS order_date, 'POP' || replace(date, '-', '') || '-' || CASE WHEN no < 10 THEN '0' ELSE '' END || cast(no as varchar) AS order_number,
      CASE WHEN nameless THEN 'Walk-in' ELSE last_name END AS last_name, CASE WHEN nameless THEN location ELSE first_name END AS first_name, phone AS main_phone, email AS main_email,
      CASE WHEN location = 'South' THEN 'Walk in customer-Picked' ELSE '' END AS customer_note, 'CIA' AS payment_terms, item AS sku,
      CASE WHEN qty <> 0 THEN ({cents('net')} // cast(qty as hugeint)) / 100.0::DOUBLE END AS unit_price, qty,
      CASE pk WHEN 1 THEN '1 River Rd' WHEN 2 THEN '2 Campus Ln' WHEN 3 THEN '3 South St' ELSE address1 END AS shipping_address, CASE pk WHEN 1 THEN '' WHEN 2 THEN '' WHEN 3 THEN 'Unit 3' ELSE address2 END AS shipping_address_2,
      CASE pk WHEN 1 THEN 'Rivertown' WHEN 2 THEN 'Hilltown' WHEN 3 THEN 'Southtown' ELSE city END AS shipping_city, CASE WHEN pk > 0 THEN 'BC' ELSE state END AS shipping_state, 'CA' AS shipping_country,
      CASE pk WHEN 1 THEN 'V1V 1V1' WHEN 2 THEN 'V2V 2V2' WHEN 3 THEN 'V3V 3V3' ELSE zip END AS shipping_zip, transaction_id AS po_no
    FROM j""")
def _(t):
    return orders.pos2_import_orders(t.s_pos2_line, t.s_pos2_customer, PICKUPS, "South", block_rows=BLOCK)


@query("recode_oversold", """
    WITH e AS (SELECT l_orderkey, l_suppkey, k.sku AS item_sku, 1 AS quantity FROM lineitem JOIN s_sku k ON k.p_partkey = l_partkey),
    g AS (SELECT item_sku, sum(quantity)::BIGINT AS qty_total FROM e GROUP BY 1)
    SELECT l_orderkey, l_suppkey, CASE WHEN s.name IS NULL THEN NULL WHEN qty_total > s.warehouse_available THEN 'MISC-ITEM' ELSE e.item_sku END AS item_sku, quantity, qty_total
    FROM e JOIN g ON g.item_sku = e.item_sku LEFT JOIN s_erp s ON s.name = e.item_sku AND s.inventory_warehouse = 'WH-CENTRAL'""")
def _(t):
    lines = lookup(t.lineitem, t.s_sku, {"l_partkey": "p_partkey"}, {"sku": "item_sku"}, unique=True)
    err = lines.select("l_orderkey", "l_suppkey", "item_sku", F.lit(1).alias("quantity"))
    return orders.recode_oversold(err, t.s_erp.filter("inventory_warehouse = 'WH-CENTRAL'")).drop("qty_stock")


@query("unstocked_errors", """
    SELECT _pos, item_sku FROM s_line WHERE item_sku NOT IN (SELECT name FROM s_erp WHERE inventory_warehouse = 'WH-CENTRAL' AND warehouse_available > 0)""")
def _(t):
    return orders.unstocked_errors(t.s_line, t.s_erp.filter("inventory_warehouse = 'WH-CENTRAL'")).select("_pos", "item_sku")


WHOLE = f"""{CONTACTS}, l AS (SELECT l.*, cast(ts as date) AS d FROM s_line l WHERE (coalesce(contains(order_discounts, 'Wholesaler'), false) OR coalesce(contains(discounts, 'Wholesaler'), false)) AND order_payment_state = 'Paid'),
    p AS (SELECT order_id, string_agg(tender || ':$' || cast(amount as varchar), '|' ORDER BY _pos) AS tender, sum(amount) AS amount, min_by(customer_name, _pos) AS customer_name
          FROM s_payment WHERE result = 'SUCCESS' GROUP BY 1),
    w AS (SELECT CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY', 'FURNITURE') THEN 'u' ELSE 'w' END || c_custkey || '@x.ca' AS email, c_name AS company_name, '777' || c_nationkey AS phone FROM customer),
    o AS (SELECT l.order_id, min(p.tender) AS tender, min(p.amount) AS amount, min(CASE WHEN w.email IS NOT NULL THEN w.company_name ELSE p.customer_name END) AS company_name,
            min(CASE WHEN w.email IS NOT NULL THEN w.phone ELSE c.phone END) AS recipient_phone, min(c.email) AS recipient_email
          FROM l JOIN p ON p.order_id = l.order_id LEFT JOIN contacts c ON c.name = p.customer_name LEFT JOIN w ON w.email = c.email GROUP BY 1),
    lines AS (SELECT strftime(d, '%m/%d/%Y') AS order_date, CASE WHEN o.order_id IS NOT NULL THEN 'REF' || l.order_id END AS ref_id, l.order_id, item_sku, o.tender, o.amount, o.company_name, o.recipient_phone, o.recipient_email,
            count(*) AS quantity, sum(item_total) AS rate, nullif(sum(total_discount + order_discount_proportion), 0) AS coupon_discount, sum(tax_amount) AS tax_amount,
            arg_min(regexp_replace(coalesce(order_discounts, '') || coalesce(discounts, ''), ' -.*', ''), _pos) AS coupon_code,
            arg_min(CASE WHEN item_tax_rate = 0.05 THEN 'CA-BC-GST' WHEN item_tax_rate = 0.12 THEN 'CA-BC-TAX' WHEN item_tax_rate IS NOT NULL THEN '' END, _pos) AS tax_code
          FROM l LEFT JOIN o ON o.order_id = l.order_id GROUP BY 1, 2, 3, 4, 5, 6, 7, 8, 9),
    ords AS (SELECT order_date, ref_id, order_id, tender, amount, company_name, sum(coalesce(coupon_discount, 0)) AS discount, sum(tax_amount) AS tax FROM lines GROUP BY 1, 2, 3, 4, 5, 6)"""


def _wholesale(t):
    mail = F.when(F.col("c_mktsegment").isin("BUILDING", "MACHINERY", "FURNITURE"), "u").otherwise("w")  # others are not the contacts' addresses
    wholesalers = t.customer.select(
        F.concat(mail, F.col("c_custkey"), F.lit("@x.ca")).alias("email"), F.col("c_name").alias("company_name"), F.concat(F.lit("777"), F.col("c_nationkey")).alias("phone"))
    done = t.s_payment.filter("result = 'SUCCESS'").select("order_id", F.concat(F.lit("REF"), "order_id").alias("ref_id"))
    return orders.store_wholesale(t.s_line, t.s_payment, customers.consolidate_contacts(t.s_customer), wholesalers, done, block_rows=BLOCK)


@query("store_wholesale", f"""
    WITH {WHOLE} SELECT order_date, ref_id, order_id, item_sku, tender, cast(amount as double) AS amount, company_name, recipient_phone, recipient_email, quantity, cast(rate as double) AS rate,
      cast(coupon_discount as double) AS coupon_discount, cast(tax_amount as double) AS tax_amount, coupon_code, tax_code,
      'WH-STORE' AS warehouse, 'Custom' AS price_level, 'store 1' AS customer, '' AS shipping_carrier, '' AS shipping_method, 0 AS shipping_cost FROM lines""")
def _(t):
    return _wholesale(t)[0]


@query("store_wholesale_orders", f"""
    WITH {WHOLE} SELECT order_date, ref_id, order_id, tender, cast(amount as double) AS amount, company_name, cast(discount as double) AS discount, cast(tax as double) AS tax FROM ords""")
def _(t):
    return _wholesale(t)[1]


@query("store_wholesale_months", f"""
    WITH {WHOLE} SELECT substr(order_date, 1, 2) AS month, cast(sum(discount) as double) AS discount, cast(sum(tax) as double) AS tax, cast(sum(amount) as double) AS amount FROM ords GROUP BY 1""")
def _(t):
    return _wholesale(t)[2]


@query("customer_union", """
    SELECT 'pos' AS source, id, first_name, last_name, email_address AS email, phone_number AS phone, 'a' AS address1, 'b' AS address2, 'c' AS city, 'BC' AS state, 'CA' AS country, 'V' AS postal_code FROM s_customer
    UNION ALL SELECT 'pos2', customer_id, first_name, last_name, email, phone, address1, address2, city, state, 'CA', zip FROM s_pos2_customer
    UNION ALL SELECT 'card', 'S' || s_suppkey, s_name, '', 's' || s_suppkey || '@x.ca', '', 'x', 'y', 'z', 'ON', 'CA', 'T' FROM supplier""")
def _(t):
    lits = lambda **kw: {k: F.lit(v) for k, v in kw.items()}
    a = t.s_customer.withColumnsRenamed({"email_address": "email", "phone_number": "phone"}).withColumns(lits(address1="a", address2="b", city="c", state="BC", country="CA", postal_code="V"))
    b = t.s_pos2_customer.withColumnsRenamed({"customer_id": "id", "zip": "postal_code"})
    c = t.supplier.select(F.concat(F.lit("S"), F.col("s_suppkey")).alias("id"), F.col("s_name").alias("first_name"), F.concat(F.lit("s"), F.col("s_suppkey"), F.lit("@x.ca")).alias("email"))
    return customers.union_customers(a, b, c.withColumns(lits(address1="x", address2="y", city="z", state="ON", country="CA", postal_code="T")))


NAMED = """mail AS (SELECT *, first_name || ' ' || last_name AS name, row_number() OVER (PARTITION BY email_address ORDER BY _pos) AS r1 FROM s_customer),
    m1 AS (SELECT * FROM mail WHERE r1 = 1 AND trim(name) <> '' AND trim(email_address) <> ''),
    named AS (SELECT name, email_address FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY _pos) AS r2 FROM m1) WHERE r2 = 1)"""


@query("loyalty_points", f"""
    WITH {NAMED} SELECT n.email_address AS email, cast(trunc(amount - coalesce(refund_amount, 0)) as int) AS points FROM s_payment p JOIN named n ON n.name = p.customer_name
    WHERE result = 'SUCCESS' AND trunc(amount - coalesce(refund_amount, 0)) <> 0""")
def _(t):
    return customers.loyalty_points(t.s_payment, t.s_customer)


@query("points_backlog", f"""
    WITH {NAMED}, e AS (SELECT n.email_address AS email, cast(trunc(amount - coalesce(refund_amount, 0)) as int) AS points FROM s_payment p JOIN named n ON n.name = p.customer_name
      WHERE result = 'SUCCESS' AND trunc(amount - coalesce(refund_amount, 0)) <> 0),
    b AS (SELECT email_address AS email, cast(c_custkey % 100 as int) AS points FROM s_customer WHERE email_address <> '')
    SELECT email, sum(points)::BIGINT AS points FROM (SELECT * FROM e UNION ALL SELECT * FROM b) GROUP BY 1""")
def _(t):
    backlog = t.s_customer.filter("email_address <> ''").select(F.col("email_address").alias("email"), (F.col("c_custkey") % 100).cast("int").alias("points"))
    return customers.points_backlog(backlog, customers.loyalty_points(t.s_payment, t.s_customer))


@query("pos2_points", """
    WITH p AS (SELECT 'C' || o_custkey AS customer_id, trunc(cast(o_totalprice as decimal(12,2))) AS points FROM orders WHERE o_orderpriority <> '5-LOW')
    SELECT c.email, cast(points as int) AS points FROM p JOIN s_pos2_customer c ON c.customer_id = p.customer_id WHERE points <> 0""")
def _(t):
    paid = t.orders.select(F.when(F.col("o_orderpriority") == "5-LOW", "").otherwise(F.concat(F.lit("C"), "o_custkey")).alias("customer_id"),
                           F.concat(F.lit("$"), F.format_number("o_totalprice", 2)).alias("total_collected"))
    return customers.pos2_points(paid, t.s_pos2_customer)


# Reports


@query("best_sellers", """
    WITH s AS (SELECT adjust_msku, sum(qty)::BIGINT AS total FROM s_sales GROUP BY 1),
    j AS (SELECT s.*, m.category_sku AS category, coalesce(m.category_sku, '') || '-' || coalesce(m.print_sku, '') AS spu FROM s LEFT JOIN s_master m ON m.msku = s.adjust_msku),
    x AS (SELECT *, sum(total) OVER (PARTITION BY spu)::BIGINT AS total_spu FROM j)
    SELECT x.*, cast(e.warehouse_available as double) AS available FROM x LEFT JOIN s_erp e ON e.name = adjust_msku AND e.inventory_warehouse = 'WH-CENTRAL' WHERE category IN ('B1', 'B4', 'B9')""")
def _(t):
    out = reports.best_sellers(t.s_sales, t.s_master, ["B1", "B4", "B9"], t.s_erp.filter("inventory_warehouse = 'WH-CENTRAL'"))
    return _as_double(out, "available")


@query("sales_summary", """
    WITH r AS (SELECT adjust_msku, sales_channel, sum(qty)::BIGINT AS qty, CASE sales_channel WHEN 'STORE' THEN 0 WHEN 'WEB' THEN 1 END AS rk FROM s_sales WHERE year = 2000 GROUP BY 1, 2)
    SELECT r.adjust_msku, sales_channel, qty FROM r JOIN (SELECT adjust_msku, min(rk) AS best FROM r WHERE rk IS NOT NULL GROUP BY 1) b ON b.adjust_msku = r.adjust_msku AND best = rk""")
def _(t):
    return reports.sales_summary(t.s_sales, "adjust_msku", 2000, ["STORE", "WEB"])


@query("sku_summary", "SELECT adjust_msku, sum(qty)::BIGINT AS qty FROM s_sales WHERE year = 2000 GROUP BY 1 HAVING sum(qty) > 0")
def _(t):
    return reports.sku_summary(t.s_sales, 2000)


@query("sales_trend", """
    SELECT 'G' || substr(category, 1, 2) AS category_group, category, year, cast(NULL as double) AS month, sum(qty)::BIGINT AS sales FROM s_cat_month WHERE category <> 'B5' GROUP BY 1, 2, 3
    UNION ALL SELECT 'G' || substr(category, 1, 2), category, year, cast(month as double), sum(qty)::BIGINT FROM s_cat_month WHERE category <> 'B5' GROUP BY 1, 2, 3, 4""")
def _(t):
    groups = t.s_sku.select(renamed("cat", F.col("cat") != "B5").alias("category_sku")).distinct().withColumn(
        "category_group", F.concat(F.lit("G"), F.substring("category_sku", 1, 2)))
    yearly, monthly = reports.sales_trend(t.s_cat_month, groups)
    return yearly.withColumn("month", F.lit(None).cast("double")).unionByName(monthly.withColumn("month", F.col("month").cast("double")))


def _invoices(t):
    serial = "cast(datediff(o_orderdate, date '1899-12-30') as int)"
    base = t.orders.join(t.customer, F.col("c_custkey") == F.col("o_custkey"))
    a = base.filter("o_orderstatus = 'O'").selectExpr(
        "cast(o_orderkey as string) AS so_ref_number", f"{serial} AS date", "o_orderpriority AS sales_rep", "'CAD' AS currency_code", "cast(o_totalprice as decimal(12,2)) AS total_amount",
        "cast(1 as decimal(12,2)) AS shipping_cost", "cast(2 as decimal(12,2)) AS total_discount", "cast(3 as decimal(12,2)) AS total_tax_amount", "cast(o_orderkey % 9 as int) AS total_qty",
        "cast(c_nationkey as string) AS ship_to_country", "c_mktsegment AS ship_to_state", "c_name AS customer_name", "concat('u', c_custkey) AS main_email")
    b = base.filter("o_orderstatus = 'P'").selectExpr(
        "cast(o_orderkey as string) AS ref_no", f"{serial} AS date", "o_orderpriority AS sales_rep", "'USD' AS currency", "cast(o_totalprice as decimal(12,2)) AS amount_foreign_currency",
        "cast(1 as decimal(12,2)) AS shipping_cost", "cast(null as decimal(12,2)) AS amount_discount", "cast(3 as decimal(12,2)) AS tax_total", "cast(o_orderkey % 9 as int) AS total_qty_r",
        "cast(c_nationkey as string) AS country_code", "c_mktsegment AS state_province", "concat('Co ', c_custkey) AS company_name", "concat('u', c_custkey) AS email")
    lines = t.lineitem.join(base.filter("o_orderstatus = 'F'"), F.col("o_orderkey") == F.col("l_orderkey"))
    c = lines.selectExpr("cast(o_orderkey as string) AS order_number", f"{serial} AS order_date", "cast(l_extendedprice as decimal(12,2)) AS wholesale_price", "cast(l_quantity as int) AS quantity",
                         "case when c_nationkey % 2 = 0 then 'United States' else 'Canada' end AS country", "c_mktsegment AS state", "c_name AS retailer_name")
    return reports.unify_wholesale(a, b, c, [1999, 2000])


INVOICES = """base AS (SELECT * FROM orders JOIN customer ON c_custkey = o_custkey),
    inv AS (
      SELECT cast(o_orderkey as varchar) AS ref_no, cast(o_orderdate as date) AS date, o_orderpriority AS sales_rep, cast(o_totalprice as decimal(12,2)) AS amount, cast(o_orderkey % 9 as int) AS qty,
             cast(c_nationkey as varchar) AS country, c_name AS customer_name FROM base WHERE o_orderstatus = 'O'
      UNION ALL SELECT cast(o_orderkey as varchar), cast(o_orderdate as date), o_orderpriority, cast(o_totalprice as decimal(12,2)), cast(o_orderkey % 9 as int), cast(c_nationkey as varchar),
             CASE WHEN c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'O') THEN c_name ELSE 'Co ' || c_custkey END FROM base WHERE o_orderstatus = 'P'
      UNION ALL SELECT cast(o_orderkey as varchar), cast(min(o_orderdate) as date), 'Faire', sum(cast(l_extendedprice as decimal(12,2))), sum(cast(l_quantity as int))::INT,
             min(CASE WHEN c_nationkey % 2 = 0 THEN 'US-Faire' ELSE 'CA' END), min(c_name) FROM base JOIN lineitem ON l_orderkey = o_orderkey
             WHERE o_orderstatus = 'F' AND year(o_orderdate) IN (1999, 2000) GROUP BY 1)"""


@query("wholesale_by_country", f"""
    WITH {INVOICES}, g AS (SELECT country, year(date) AS year, cast(sum(amount) as double) / count(amount) AS average_amount, cast(sum(amount) as double) AS total_amount, cast(sum(qty) as double) AS total_qty FROM inv GROUP BY 1, 2)
    SELECT country, year, r.total, r.value FROM g, LATERAL (VALUES ('average_amount', CASE WHEN country = '4' THEN 0.0 ELSE average_amount END), ('total_amount', total_amount), ('total_qty', total_qty)) AS r(total, value)""")
def _(t):
    return reports.wholesale_by(_invoices(t), ["country"], F.col("country") == "4")


@query("wholesale_by_rep", f"""
    WITH {INVOICES}, g AS (SELECT sales_rep, year(date) AS year, cast(sum(amount) as double) / count(amount) AS average_amount, cast(sum(amount) as double) AS total_amount, cast(sum(qty) as double) AS total_qty FROM inv GROUP BY 1, 2)
    SELECT sales_rep, year, r.total, r.value FROM g, LATERAL (VALUES ('average_amount', average_amount), ('total_amount', total_amount), ('total_qty', total_qty)) AS r(total, value)""")
def _(t):
    return reports.wholesale_by(_invoices(t), ["sales_rep"])


@query("wholesale_pivot", f"""
    WITH {INVOICES}, g AS (SELECT customer_name, sum(CASE WHEN year(date) = 1999 THEN amount END) AS a0, sum(CASE WHEN year(date) = 2000 THEN amount END) AS a1,
        count(CASE WHEN year(date) = 1999 THEN amount END) AS n0, count(CASE WHEN year(date) = 2000 THEN amount END) AS n1,
        sum(CASE WHEN year(date) = 1999 THEN qty END) AS q0, sum(CASE WHEN year(date) = 2000 THEN qty END) AS q1, min(date) AS start_date, min_by(sales_rep, (date, ref_no)) AS sales_rep, min_by(country, (date, ref_no)) AS country
      FROM inv GROUP BY 1)
    SELECT customer_name, cast(a0 as double) AS total_amount_1999, cast(a1 as double) AS total_amount_2000, cast(q0 as double) AS total_qty_1999, cast(q1 as double) AS total_qty_2000,
      {half_even(cents('a0'), 'nullif(n0, 0)')} / 100.0::DOUBLE AS average_amount_1999, {half_even(cents('a1'), 'nullif(n1, 0)')} / 100.0::DOUBLE AS average_amount_2000,
      CASE WHEN a0 IS NULL THEN 1.0 WHEN a1 IS NULL THEN -1.0 ELSE round_even(cast(a1 - a0 as double) / cast(a0 as double), 3) END AS growth_rate, strftime(start_date, '%Y-%m-%d') AS start_date, sales_rep, country
    FROM g WHERE a0 IS NOT NULL OR a1 IS NOT NULL""")
def _(t):
    return _as_double(reports.wholesale_stores(_invoices(t), (1999, 2000)), "total_qty_1999", "total_qty_2000")


def _days(t):
    return calendar(t.spark, date(1998, 1, 1), date(2000, 12, 31), closed=(date(1999, 1, 1), date(2000, 7, 1)))


def _paid(t):
    return reports.store_payments(t.s_payment, "Ann")


PAID = "pay AS (SELECT *, cast(o_orderdate as date) AS d FROM s_payment WHERE result = 'SUCCESS' AND amount <> 0 AND order_employee_name <> 'Ann')"


@query("store_kpis", f"""
    WITH {PAID}, cal AS (SELECT cast(unnest(generate_series(date '1998-01-01', date '2000-12-31', interval 1 day)) as date) AS d),
    work AS (SELECT d FROM cal WHERE dayofweek(d) <> 0 AND d NOT IN (date '1999-01-01', date '2000-07-01')),
    n AS (SELECT (SELECT count(*) FROM (SELECT d FROM pay UNION SELECT d FROM work)) AS days, (SELECT cast(sum(amount) as double) FROM pay) AS revenue, (SELECT count(*) FROM pay) AS orders,
      (SELECT cast(sum(order_total) as double) FROM s_web_order) AS web_revenue, (SELECT count(*) FROM s_web_order) AS web_orders,
      (SELECT cast(sum(refund_amount) as double) FROM s_payment WHERE refund_amount IS NOT NULL) AS refund, (SELECT count(*) FROM s_payment WHERE refund_amount IS NOT NULL) AS refunds)
    SELECT revenue, orders, web_revenue, web_orders, revenue / web_revenue AS revenue_share, orders / web_orders AS order_share, refund, refunds, refunds / orders AS refund_share,
      revenue / days AS daily_amount, orders / days AS daily_orders, revenue / orders AS order_size FROM n""")
def _(t):
    return reports.store_kpis(_paid(t), t.s_web_order, t.s_payment.filter("refund_amount IS NOT NULL"), _days(t))


@query("by_weekday", f"""
    WITH {PAID} SELECT dayofweek(d)::INT + 1 AS weekday, strftime(d, '%a') AS label, cast(sum(amount) as double) AS amount, count(*) AS n, cast(sum(amount) as double) / count(*) AS average FROM pay GROUP BY 1, 2""")
def _(t):
    return reports.by_weekday(_paid(t))


@query("by_month", f"""
    WITH {PAID} SELECT year(d) AS year, month(d) AS month, cast(sum(amount) as double) AS amount, count(*) AS n, cast(sum(amount) as double) / count(*) AS average FROM pay GROUP BY 1, 2""")
def _(t):
    return reports.by_month(_paid(t))


@query("web_region_yoy", """
    WITH o AS (SELECT year(o_orderdate) AS year, month(o_orderdate) AS month, country_code AS country, CASE WHEN country_code = 'US' THEN 'US' ELSE state_code END AS state, order_total FROM s_web_order
      WHERE year(o_orderdate) IN (1999, 2000) AND country_code <> '' AND month(o_orderdate) * 100 + day(o_orderdate) < 1225 AND o_orderkey IN (SELECT l_orderkey FROM lineitem)),
    g AS (SELECT year, month, country, state, cast(count(*) as double) AS orders, cast(sum(order_total) as double) AS amount FROM o GROUP BY 1, 2, 3, 4)
    SELECT year, month, country, state, r.measure, r.value FROM g, LATERAL (VALUES ('orders', orders), ('amount', amount)) AS r(measure, value)""")
def _(t):
    return reports.web_region_yoy(t.s_web_line, [1999, 2000], (12, 25))


@query("customer_counts", f"""
    WITH {PAID}, {NAMED}, per AS (SELECT n.email_address AS email, count(*) AS c FROM pay JOIN named n ON n.name = pay.customer_name GROUP BY 1),
    x AS (SELECT count(*) AS known, count(CASE WHEN c > 100 THEN 1 END) AS unused, count(CASE WHEN c > 1 THEN 1 END) AS repeat,
            count(CASE WHEN email NOT IN (SELECT customer_email FROM s_web_order WHERE country_code = 'US') THEN 1 END) AS new FROM per)
    SELECT known, repeat, new, repeat / known AS repeat_share, new / known AS new_share FROM x""")
def _(t):
    web = t.s_web_order.filter("country_code = 'US'").select(F.col("customer_email").alias("email"))
    return reports.customer_counts(_paid(t), customers.named_emails(t.s_customer), web)


@query("fsa_rollup", """
    WITH reg AS (SELECT DISTINCT 'V' || (n_nationkey % 9) || CASE WHEN n_nationkey % 2 = 0 THEN 'B' ELSE 'C' END AS fsa FROM nation),
    o AS (SELECT upper(substr(postcode, 1, 3)) AS fsa, count(*) AS order_count, cast(sum(order_total) as double) AS amount FROM s_web_order GROUP BY 1),
    c AS (SELECT 'V' || (s_suppkey % 9) || 'B' AS fsa, count(*) AS childcares FROM supplier GROUP BY 1)
    SELECT reg.fsa, coalesce(order_count, 0) AS order_count, coalesce(amount, 0.0) AS amount, CASE WHEN reg.fsa < 'V5' THEN 1234.0 ELSE 0.0 END AS dwellings, coalesce(childcares, 0) AS childcares
    FROM reg LEFT JOIN o ON o.fsa = reg.fsa LEFT JOIN c ON c.fsa = reg.fsa""")
def _(t):
    side = F.when(F.col("n_nationkey") % 2 == 0, "B").otherwise("C")
    region = t.nation.select(F.concat(F.lit("V"), (F.col("n_nationkey") % 9).cast("string"), side).alias("fsa")).distinct().withColumn("in_region", F.lit(True))
    census = region.select(renamed("fsa", F.col("fsa") < "V5").alias("fsa"), F.lit("1,234").alias("occupied_dwellings"))
    care = t.supplier.select(F.concat(F.lit("v"), (F.col("s_suppkey") % 9).cast("string"), F.lit("b 2X2")).alias("postal_code"))
    return reports.fsa_rollup(t.s_web_order, "postcode", "order_total", region, census, care)


@query("top_categories", f"SELECT {cat('item_sku')} AS category, count(*) AS qty FROM s_line WHERE order_id IN (SELECT order_id FROM s_payment WHERE result = 'SUCCESS') GROUP BY 1 ORDER BY qty DESC, category LIMIT 10")
def _(t):
    return reports.top_categories(t.s_line, 10, orders=t.s_payment.filter("result = 'SUCCESS'"))


@query("top_categories_daily", f"""
    WITH g AS (SELECT cast(ts as date) AS d, {cat('item_sku')} AS category, count(*) AS qty FROM s_line GROUP BY 1, 2),
    r AS (SELECT *, row_number() OVER (PARTITION BY d ORDER BY qty DESC, category) AS rn FROM g) SELECT strftime(d, '%Y-%m-%d') AS day, category, qty FROM r WHERE rn <= 5""")
def _(t):
    return reports.top_categories(t.s_line.withColumn("day", F.to_date("ts")), 5, ["day"])


@query("event_sales", f"SELECT strftime(cast(ts as date), '%Y-%m-%d') AS date, {cat('item_sku')} AS category, count(*) AS qty FROM s_line WHERE item_sku NOT LIKE '%OLD%' GROUP BY 1, 2")
def _(t):
    return reports.event_sales(t.s_line, "OLD")


@query("pivot_return_rate", """
    WITH x AS (SELECT CASE c_nationkey % 4 WHEN 0 THEN 'BC' WHEN 1 THEN 'ON' WHEN 2 THEN 'QC' ELSE 'NWT' END AS state, k.cat AS category, l_returnflag AS f, cast(l_quantity as int) AS q
      FROM lineitem JOIN s_sku k ON k.p_partkey = l_partkey JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey WHERE l_returnflag <> 'A' AND k.cat LIKE 'B1%' AND k.cat <> 'B12'),
    g AS (SELECT state, category, sum(CASE WHEN f = 'N' THEN q END)::BIGINT AS orders, coalesce(sum(CASE WHEN f = 'R' THEN q END), 0)::BIGINT AS refunds FROM x GROUP BY 1, 2)
    SELECT state, category, orders, refunds, refunds / orders AS return_rate FROM g WHERE orders >= 10""")
def _(t):
    rows = t.lineitem.join(t.s_sku, F.col("p_partkey") == F.col("l_partkey")).join(t.orders, F.col("o_orderkey") == F.col("l_orderkey")).join(t.customer, F.col("c_custkey") == F.col("o_custkey"))
    names = F.element_at(F.array(*[F.lit(x) for x in ("British Columbia", "ONTARIO ", "Québec", "NWT")]), (F.col("c_nationkey") % 4 + 1))
    tx = rows.select(F.when(F.col("l_returnflag") == "N", "Order").when(F.col("l_returnflag") == "R", "Refund").otherwise("Fee").alias("type"), "sku",
                     F.col("l_quantity").cast("int").alias("quantity"), names.alias("order_state"))
    return reports.return_rate(tx, min_orders=10, category_pattern="^B1", skip=["B12"])


@query("regional_share", """
    WITH r AS (SELECT CASE WHEN m.msku IS NOT NULL THEN m.category_sku ELSE regexp_replace(w.sku, '-.*', '') END AS category, country_code AS c, state_code AS s, quantity AS q
      FROM s_web_line w LEFT JOIN s_master m ON m.msku = w.sku WHERE order_status = 'Completed' AND country_code <> ''),
    a AS (SELECT category, cast(sum(CASE WHEN c = 'CA' THEN q ELSE 0 END) as double) / sum(q) AS share, count(CASE WHEN c = 'CA' THEN 1 END) AS n FROM r GROUP BY 1),
    e AS (SELECT category, cast(sum(CASE WHEN s IN ('MB', 'ON', 'QC', 'NB', 'NS', 'NL', 'PE') THEN q ELSE 0 END) as double) / sum(q) AS share FROM r WHERE c = 'CA' GROUP BY 1)
    SELECT a.category, round_even(a.share, 2) AS country_share, round_even(coalesce(e.share, 0.0), 2) AS east_share FROM a LEFT JOIN e ON e.category = a.category WHERE a.n > 0""")
def _(t):
    return reports.regional_share(t.s_web_line, t.s_master, shared=t.shared)


@query("cat_spu_sales", f"SELECT {cat('adjust_msku')} AS category, {spu('adjust_msku')} AS spu, sales_channel, sum(qty)::BIGINT AS qty FROM s_sales GROUP BY 1, 2, 3")
def _(t):
    from ..functions import sku
    return t.s_sales.groupBy(sku.category("adjust_msku").alias("category"), sku.spu("adjust_msku").alias("spu"), "sales_channel").agg(F.sum("qty").alias("qty"))
