"""Job inputs shaped out of the star-schema test tables.

Every input is plain SQL that both engines read, over whole tables: ``part`` is the product master,
``lineitem`` the sales lines, ``orders`` the payments, ``customer`` the customers, ``events`` the till log in
file order (``event_id`` is the source position).
"""

from __future__ import annotations

import atexit
import contextlib
import re
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..session import SharedFrames

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

_MONTHS = "'JanFebMarAprMayJunJulAugSepOctNovDec'"


def _dmy(c: str) -> str:
    return (f"lpad(cast(day({c}) as string), 2, '0') || '-' || substr({_MONTHS}, cast((month({c}) - 1) * 3 + 1 as int), 3)"
            f" || '-' || cast(year({c}) as string)")


def _ymd(c: str) -> str:
    return f"cast(year({c}) as string) || '-' || lpad(cast(month({c}) as string), 2, '0') || '-' || lpad(cast(day({c}) as string), 2, '0')"


def _province(c: str) -> str:
    codes = ("BC", "ON", "QC", "AB", "NB", "NS", "NL", "PE", "MB", "SK", "YT")
    whens = " ".join(f"when {i} then '{p}'" for i, p in enumerate(codes))
    return f"case {c} % {len(codes)} {whens} end"


_K = "cast(substr(props, 7, length(props) - 7) as int)"

STANDINS: dict[str, str] = {
    "s_sku": """
        SELECT p_partkey, replace(p_brand, 'Brand#', 'B') || '-' || p_type || '-' || cast(p_size as string) || '-P'
                 || cast(p_partkey as string) AS sku,
               replace(p_brand, 'Brand#', 'B') AS cat, p_type AS print, cast(p_size as string) AS size,
               cast(24 + p_size % 3 as string) || case when p_partkey % 2 = 0 then 'F' else 'S' end AS seasons,
               cast(p_retailprice as decimal(12,2)) AS price, p_name, p_size
        FROM part""",
    "s_web": """
        SELECT p_partkey AS id, sku, p_name AS name,
               case when p_partkey % 41 = 0 then null else price end AS regular_price,
               case when p_size % 3 = 0 then cast(price - 100 - p_size * 5 as decimal(12,2)) end AS sale_price,
               case p_size % 4 when 0 then timestamp '2024-01-01 00:00:00' when 1 then timestamp '2024-07-01 00:00:00' end AS sale_starts,
               case p_size % 5 when 0 then timestamp '2024-12-31 23:59:59' when 1 then timestamp '2024-02-01 00:00:00' end AS sale_ends,
               case when p_partkey % 3 = 0 then 'full' when p_partkey % 3 = 1 then 'reduced' end AS tax_class,
               case when p_partkey % 23 = 0 then 0 else 1 end AS published
        FROM s_sku""",
    "s_master": """
        SELECT case when p_partkey % 7 = 3 then 'X' || sku else sku end AS msku,
               case when p_partkey % 7 = 3 then sku end AS adjust_sku,
               case when p_partkey % 11 = 0 then 'Inactive' else 'Active' end AS msku_status,
               seasons, seasons AS seasons_sku, cat AS category_sku, print AS print_sku, p_name AS print_name, 'CN ' || p_name AS print_chinese, size,
               cast(100000 + p_partkey as string) || case p_partkey % 4 when 0 then '/77' when 1 then '|88' when 2 then ' 99' else '' end AS upc_active,
               p_name AS item_name,
               case when p_partkey % 5 = 0 then 'US-' || sku end AS fbasku_us,
               case when p_partkey % 6 = 0 then 'DE-' || sku end AS fbasku_de
        FROM s_sku""",
    "s_erp": """
        SELECT k.sku AS name, case l.f when 'A' then 'WH-CENTRAL' when 'R' then 'WH-STORE' else 'WH-3PL' end AS inventory_warehouse,
               cast(l.q % 40 as int) AS warehouse_available, k.cat AS item_category_sku, k.print AS item_print_sku,
               k.size AS item_size, k.seasons AS item_sku_seasons, cast(l.q % 3 as int) AS on_po
        FROM (SELECT l_partkey, l_returnflag AS f, cast(sum(l_quantity) as bigint) AS q FROM lineitem GROUP BY l_partkey, l_returnflag) l
        JOIN s_sku k ON k.p_partkey = l.l_partkey""",
    "s_pos": """
        SELECT 'C' || cast(k.p_partkey as string) AS clover_id,
               case when k.p_partkey % 19 = 0 then 'Z' || k.sku else k.sku end AS name,
               case when k.p_partkey % 29 = 0 then null else cast(coalesce(l.q, 0) % 13 - 3 as int) end AS quantity,
               case when k.p_partkey % 17 = 0 then null else k.price end AS price
        FROM s_sku k LEFT JOIN (SELECT l_partkey, cast(sum(l_quantity) as bigint) AS q FROM lineitem GROUP BY l_partkey) l
          ON l.l_partkey = k.p_partkey""",
    "s_sales": """
        SELECT l.sales_channel, k.sku AS adjust_msku, k.cat AS cat_sku, l.year, l.month, l.qty
        FROM (SELECT l_partkey, case l_linenumber % 4 when 0 then 'Amazon.com' when 1 then 'Amazon.ca' when 2 then 'WEB' else 'STORE' end AS sales_channel,
                     year(l_shipdate) AS year, month(l_shipdate) AS month, cast(sum(l_quantity) as bigint) AS qty
              FROM lineitem GROUP BY 1, 2, 3, 4) l
        JOIN s_sku k ON k.p_partkey = l.l_partkey""",
    "s_inv": """
        SELECT k.sku AS adjust_msku, l.f AS source_sheet, cast(l.q % 13 + l.q % 9 as int) AS inv_total_end_wk,
               cast(l.q % 13 as int) AS inv_warehouse, cast(l.q % 5 as int) AS inv_amz_usa, cast(l.q % 3 as int) AS inv_amz_ca
        FROM (SELECT l_partkey, l_returnflag AS f, cast(sum(l_quantity) as bigint) AS q FROM lineitem GROUP BY l_partkey, l_returnflag) l
        JOIN s_sku k ON k.p_partkey = l.l_partkey""",
    "s_cat_month": """
        SELECT k.cat AS category, l.year, l.month, cast(sum(l.qty) as bigint) AS qty
        FROM (SELECT l_partkey, year(l_shipdate) AS year, month(l_shipdate) AS month, cast(sum(l_quantity) as bigint) AS qty
              FROM lineitem GROUP BY 1, 2, 3) l
        JOIN s_sku k ON k.p_partkey = l.l_partkey
        GROUP BY 1, 2, 3""",
    "s_ratio": """
        SELECT m.category, m.month, cast(cast(floor(m.q * 10000 / t.q) as decimal(12,0)) * 0.0001 as decimal(12,4)) AS ratio
        FROM (SELECT category, month, sum(qty) AS q FROM s_cat_month WHERE year <= 2000 GROUP BY category, month) m
        JOIN (SELECT category, sum(qty) AS q FROM s_cat_month WHERE year <= 2000 GROUP BY category) t ON t.category = m.category""",
    "s_customer": """
        SELECT c_custkey AS _pos, 'C' || cast(c_custkey as string) AS id,
               case when c_custkey % 23 = 0 then '' else substr(c_mktsegment, 1, 4) end AS first_name,
               case when c_custkey % 23 = 0 then '' else 'N' || cast(c_custkey % 60 as string) end AS last_name,
               case when c_custkey % 3 = 0 then '' else '555' || lpad(cast(c_nationkey as string), 4, '0') end AS phone_number,
               case when c_custkey % 4 = 0 then '' else 'u' || cast(c_custkey % 1100 as string) || '@x.ca' end AS email_address,
               c_nationkey, c_custkey, c_acctbal, c_mktsegment
        FROM customer""",
    "s_payment": """
        SELECT o_orderkey AS _pos, cast(o_orderkey as string) AS order_id, 'PAY' || cast(o_orderkey as string) AS payment_id,
               """ + _dmy("o_orderdate") + """ || ' 10:15 AM' AS payment_date, o_orderdate,
               c.first_name || ' ' || c.last_name AS customer_name,
               case o_orderpriority when '1-URGENT' then 'Cash' when '2-HIGH' then 'WeChat Pay' when '3-MEDIUM' then 'Credit Card'
                 when '5-LOW' then 'Debit' end AS tender,
               cast(o_totalprice as decimal(12,2)) AS amount, cast(o_orderkey % 50 as decimal(12,2)) AS tax_amount,
               case when o_orderkey % 9 = 0 then cast(o_orderkey % 100 as decimal(12,2)) end AS refund_amount,
               case when o_orderstatus = 'F' then 'FAIL' else 'SUCCESS' end AS result,
               case when o_orderkey % 5 = 0 then 'Ann' else 'Bob' end AS order_employee_name
        FROM orders JOIN s_customer c ON c.c_custkey = o_custkey""",
    "s_event": f"SELECT event_id, ts, user_id, event_type, value, {_K} AS k FROM events",
    "s_line": """
        SELECT event_id AS _pos, cast(cast(floor(event_id / 3) as bigint) + user_id % 2 as string) AS order_id,
               """ + _dmy("ts") + """ || ' 09:30 AM' AS line_item_date, coalesce(s.sku, 'OLD-' || cast(e.k as string)) AS item_sku,
               cast(value as decimal(12,2)) AS item_total, cast(event_id % 7 as decimal(12,2)) AS total_discount,
               cast(event_id % 2 as decimal(12,2)) AS order_discount_proportion,
               case event_id % 6 when 0 then 'Staff -10%' when 1 then 'Partner channel' when 3 then 'Wholesaler -40%' when 4 then '' end AS order_discounts,
               case event_id % 5 when 0 then 'Wholesaler line' when 1 then 'Sale - 5' end AS discounts,
               case event_type when 'view' then 0.05 when 'click' then 0.12 when 'signup' then 0.0 when 'purchase' then 0.05 end AS item_tax_rate,
               cast(event_id % 11 as decimal(12,2)) AS tax_amount,
               case when event_type = 'error' then 'Open' else 'Paid' end AS order_payment_state,
               case when event_id % 23 = 0 then 'true' else 'false' end AS refunded,
               case when event_id % 29 = 0 then 'true' else 'false' end AS exchanged,
               case when user_id % 3 = 0 then 'Ann' else 'Bob' end AS order_employee_name, ts
        FROM s_event e LEFT JOIN s_sku s ON s.p_partkey = e.k AND e.k % 10 <> 0""",
    "s_pos2_line": """
        SELECT event_id AS _pos, """ + _ymd("ts") + """ AS date, 'T' || cast(cast(floor(event_id / 2) as bigint) + user_id % 2 as string) AS transaction_id,
               cast(user_id as string) AS payment_id, coalesce(s.sku, 'OLD-' || cast(e.k as string)) AS item,
               cast(event_id % 5 as double) AS qty, '$' || cast(cast(event_id % 4 as decimal(12,2)) as string) AS discounts,
               '$' || cast(cast(value as decimal(12,2)) as string) AS net_sales,
               '$' || cast(cast(cast(value as decimal(12,2)) * case event_id % 3 when 0 then 0.05 when 1 then 0.12 else 0.00 end as decimal(12,2)) as string) AS tax,
               case when user_id % 4 = 0 then 'South' else 'North' end AS location,
               case when event_id % 6 = 0 then null else 'C' || cast(user_id as string) end AS customer_id,
               case when event_id % 6 = 0 then null when event_id % 50 = 1 then 'R Pickup' else 'N' || cast(user_id as string) end AS customer_name
        FROM s_event e LEFT JOIN s_sku s ON s.p_partkey = e.k AND e.k % 10 <> 0""",
    "s_pos2_payment": """
        SELECT o_orderkey AS _pos, cast(o_orderkey as string) AS payment_id, case when o_orderkey % 3 = 0 then '$0.00' else '$12.50' end AS cash,
               case when o_orderstatus = 'F' then 'Refund' else 'Payment' end AS event_type
        FROM orders""",
    "s_pos2_customer": """
        SELECT 'C' || cast(c_custkey as string) AS customer_id, case when c_custkey % 8 = 0 then '' else substr(c_mktsegment, 1, 4) end AS first_name,
               case when c_custkey % 8 = 0 then '' else 'N' || cast(c_custkey as string) end AS last_name,
               'u' || cast(c_custkey as string) || '@x.ca' AS email, '555' || lpad(cast(c_nationkey as string), 4, '0') AS phone,
               cast(c_custkey as string) || case when c_nationkey = 3 then ' U Pickup' else ' Main St' end AS address1,
               case when c_custkey % 2 = 0 then 'Unit 1' else '' end AS address2, 'City' || cast(c_nationkey as string) AS city,
               """ + _province("c_nationkey") + """ AS state, 'V' || cast(c_nationkey as string) AS zip
        FROM customer""",
    "s_market": """
        SELECT cast(o_orderkey as string) AS order_no, case o_orderstatus when 'F' then 'refunded' else 'paid' end AS financial_status,
               """ + _ymd("o_orderdate") + """ || ' 11:00:00' AS created_at, k.sku AS lineitem_sku, k.cat AS cat,
               cast(l_quantity as int) AS lineitem_quantity, k.price AS lineitem_unit_price,
               cast(l_extendedprice as decimal(12,2)) AS lineitem_total, cast(l_orderkey % 20 as decimal(12,2)) AS lineitem_total_discount,
               case when l_orderkey % 20 = 0 then null else 'PROMO' end AS promotion_detail, cast(l_orderkey % 3 as decimal(12,2)) AS shipping,
               cast(o_totalprice as decimal(12,2)) AS total, case when o_custkey % 2 = 0 then 'Stripe' else 'Wallet' end AS payment_method,
               case when o_custkey % 3 = 0 then 'pickup' else 'delivery' end AS delivery_method, 'P' || cast(o_custkey as string) AS pickup_person_name,
               'F' || cast(o_custkey as string) AS shipping_first_name, 'L' || cast(o_custkey as string) AS shipping_last_name,
               cast(o_custkey as string) || ' Main St' AS shipping_address1, case when o_custkey % 2 = 0 then 'Unit 2' end AS shipping_address2,
               'City' || cast(c_nationkey % 4 as string) AS shipping_city,
               case when o_custkey % 5 = 0 then '不列颠哥伦比亚' else """ + _province("c_nationkey") + """ end AS shipping_province,
               case c_nationkey % 3 when 0 then '中国' when 1 then case when o_custkey % 2 = 0 then '加拿大' else 'CA' end else case when o_custkey % 4 = 0 then '美国' else 'US' end end AS shipping_country, 'V' || cast(c_nationkey as string) AS shipping_zip,
               '555' || cast(c_nationkey as string) AS phone, 'u' || cast(o_custkey as string) || '@x.ca' AS email
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey JOIN s_sku k ON k.p_partkey = l_partkey""",
    "s_web_order": """
        SELECT cast(o_orderkey as string) AS order_number, """ + _ymd("o_orderdate") + """ || ' 08:00' AS order_date,
               case o_orderstatus when 'F' then 'Cancelled' else 'Completed' end AS order_status, cast(o_totalprice as decimal(12,2)) AS order_total,
               case c_nationkey % 4 when 0 then 'US' when 3 then '' else 'CA' end AS country_code, """ + _province("c_nationkey") + """ AS state_code,
               'v' || cast(c_nationkey % 7 as string) || case when c_custkey % 2 = 0 then 'b' else 'C' end || ' 1A1' AS postcode,
               'u' || cast(c_custkey % 1100 as string) || '@x.ca' AS customer_email, o_orderkey, o_orderdate
        FROM orders JOIN customer ON c_custkey = o_custkey""",
    "s_web_line": """
        SELECT w.*, k.sku, cast(l_quantity as int) AS quantity
        FROM lineitem JOIN s_web_order w ON w.o_orderkey = l_orderkey
        JOIN s_sku k ON k.p_partkey = l_partkey""",
    "s_po": """
        SELECT 'P' || cast(l.s as string) || case when l.s < 6 then '-CA' else '' end AS ref_no, k.sku AS item, 'PO#' || cast(l.s as string) AS document_number,
               case when l.s % 2 = 0 then 'WH-CENTRAL' else 'WH-STORE' end AS warehouse, 'Open' AS status, l.quantity, l.quantity_on_shipments, l.quantity_fulfilled_received
        FROM (SELECT l_suppkey % 10 AS s, l_partkey, cast(sum(floor(l_quantity / case when l_returnflag = 'A' then 10 else 2 end)) as double) AS quantity,
                     cast(sum(case when l_linestatus = 'F' then floor(l_quantity / 4) end) as double) AS quantity_on_shipments,
                     cast(sum(case when l_linenumber = 1 then l_quantity else 0 end) as double) AS quantity_fulfilled_received
              FROM lineitem GROUP BY 1, 2) l
        JOIN s_sku k ON k.p_partkey = l.l_partkey""",
    "s_request": """
        SELECT 'P' || cast(l.s50 as string) AS po, k.cat AS category, 'F' || cast(l.s3 as string) AS vendor, 'P' || cast(l.s50 as string) || ' - ' || k.cat AS memo, k.sku,
               l.total_qty, l.qty_ca, l.qty_uk, l.qty_de, l.qty_au, l.qty_jp, l.qty_cn, l.qty_wholesale, '2025.03.' || lpad(cast(l.s28 + 1 as string), 2, '0') AS ship_date
        FROM (SELECT l_partkey, l_suppkey % 50 AS s50, l_suppkey % 3 AS s3, l_suppkey % 28 AS s28,
                     cast(sum(case when l_linenumber = 1 then l_quantity end) as int) AS qty_ca,
                     cast(sum(case when l_linenumber = 2 then l_quantity end) as int) AS qty_uk,
                     cast(sum(case when l_linenumber = 3 then l_quantity end) as int) AS qty_de,
                     cast(sum(case when l_linenumber = 4 then l_quantity end) as int) AS qty_au,
                     cast(sum(case when l_linenumber = 5 then l_quantity end) as int) AS qty_jp,
                     cast(sum(case when l_linenumber = 6 then l_quantity end) as int) AS qty_cn,
                     cast(sum(case when l_linenumber = 7 then l_quantity end) as int) AS qty_wholesale,
                     cast(sum(l_quantity) as int) AS total_qty
              FROM lineitem GROUP BY 1, 2, 3, 4) l
        JOIN s_sku k ON k.p_partkey = l.l_partkey""",
    "s_packing": """
        SELECT event_id AS _pos, cast(user_id % 5 + 1 as int) AS sheet, case when user_id % 5 = 4 then 'F25 reserve' else 'Sheet' || cast(user_id % 5 as string) end AS sheet_name,
               case when user_id % 5 % 2 = 0 and event_id % 3 = 0 then cast(event_id as string) end AS ctn_no,
               case when user_id % 5 % 2 = 1 and event_id % 3 = 0 then cast(event_id % 40 as int) end AS ctn_start,
               case when user_id % 5 % 2 = 1 and event_id % 3 = 0 then cast(event_id % 40 + k % 4 as int) end AS ctn_end,
               case when event_id % 4 = 0 then 'P' || cast(user_id % 12 as string) end AS po, s.sku || case when event_id % 9 = 0 then '-V1' else '' end AS sku,
               case when event_id % 5 = 0 then '25F' end AS season, cast(k % 12 + 1 as double) AS qty_shipped, cast(k % 6 + 1 as double) AS qty_per_box,
               case when k % 3 = 0 then '0.' || cast(100 + k as string) else cast(200 + k as string) end AS unit_weight, cast(k % 9 as double) + 2.25 AS gross_weight_per_ctn
        FROM s_event e JOIN s_sku s ON s.p_partkey = e.k""",
}


def needed(names: list[str] | tuple[str, ...]) -> list[str]:
    """The named inputs and what they are made of, in order of definition."""
    found: set[str] = set()

    def visit(n: str) -> None:
        if n not in found:
            found.add(n)
            for m in re.findall(r"\bs_[a-z0-9_]+\b", STANDINS[n]):
                if m in STANDINS and m != n:
                    visit(m)

    for n in names:
        visit(n)
    return [n for n in STANDINS if n in found]


def ctes(names: list[str] | tuple[str, ...]) -> str:
    return "WITH " + ",\n".join(f"{n} AS ({STANDINS[n]})" for n in needed(names)) if names else ""


_SCHEMAS: dict[str, T.StructType] = {}


def _closed(owner: SharedFrames) -> None:
    with contextlib.suppress(Exception):  # the session may have ended before
        owner.close()


class Inputs:
    """Job inputs of one data directory: ``t.s_web``, ``t.lineitem``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @cached_property
    def shared(self) -> SharedFrames:
        """Owner of the query's shared frames; a result is read after its query returns, so they go when Python ends."""
        owner = SharedFrames(self.spark)
        atexit.register(_closed, owner)
        return owner

    def table(self, name: str) -> DataFrame:
        path = f"{self.sf_dir}/{name}.parquet"
        if path not in _SCHEMAS:
            _SCHEMAS[path] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(_SCHEMAS[path]).parquet(path)

    def sql(self, text: str) -> DataFrame:
        """Run SQL over the test tables and the job inputs it names."""
        names = [n for n in STANDINS if re.search(rf"\b{n}\b", text)]
        full = f"{ctes(names)} {text}" if names else text
        used = [t for t in TABLES if re.search(rf"\b{t}\b", full)]
        for t in used:
            full = re.sub(rf"\b(FROM|JOIN|from|join) {t}\b", rf"\1 {{{t}}}", full)
        return self.spark.sql(full, **{t: self.table(t) for t in used})

    def __getattr__(self, name: str) -> DataFrame:
        if name in STANDINS:
            return self.sql(f"SELECT * FROM {name}")
        if name in TABLES:
            return self.table(name)
        raise AttributeError(name)
