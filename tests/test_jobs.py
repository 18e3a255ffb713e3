"""Business rules on small hand-made tables with the awkward rows."""

import re
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import rows
from retailflow import schemas
from retailflow.constants import PROVINCE_CODES
from retailflow.operators.reshape import calendar
from retailflow.jobs import clearance, customers, demand, inbound, ledger, orders, pricing, purchasing, reports, stock


def table(spark, name, data, extra=""):
    """Rows given as dicts over a fixed schema; absent columns are null."""
    s = schemas.schema(name)
    if extra:
        from pyspark.sql import types as T
        s = T.StructType(s.fields + T.StructType.fromDDL(extra).fields)
    dec = {f.name for f in s.fields if f.dataType.typeName() == "decimal"}
    return spark.createDataFrame([tuple(Decimal(str(r[f.name])) if f.name in dec and r.get(f.name) is not None else r.get(f.name) for f in s.fields) for r in data], s)


def test_sale_window(spark):
    d = datetime
    web = table(spark, "web_product", [
        dict(id=1, sku="A-A-1", regular_price=10, sale_price=8),
        dict(id=2, sku="A-A-2", regular_price=10, sale_price=8, sale_starts=d(2024, 1, 1)),
        dict(id=3, sku="A-A-3", regular_price=10, sale_price=8, sale_ends=d(2024, 1, 1)),
        dict(id=4, sku="A-A-4", regular_price=10, sale_price=8, sale_starts=d(2025, 1, 1)),
        dict(id=5, sku="A-A-5", regular_price=10), dict(id=6, sku="A-A-6", sale_price=8),
        dict(id=7, sku="A-A-1", regular_price=99), dict(id=8, sku="", regular_price=5)])
    got = {r["sku"]: r["sale_price"] for r in pricing.effective_price(web, d(2024, 6, 1)).collect()}
    assert got == {"A-A-1": 8, "A-A-2": 8, "A-A-3": 10, "A-A-4": 10, "A-A-5": 10}
    assert {r["sku"]: r["sale_price"] for r in pricing.effective_price(web, None).collect()}["A-A-4"] == 8


def test_pos_price_own_category_rule(spark):
    web = table(spark, "web_product", [dict(id=1, sku="AAA-B-1", name="n", regular_price=10, sale_price=7), dict(id=2, sku="AAA-B-2", regular_price=12, sale_price=12)])
    pos = table(spark, "pos_item", [dict(name="AAA-B-1"), dict(name="AAA-C-9"), dict(name="ZZZ-C-9"), dict(name="AAA-CLR-1"), dict(name=None)])
    rule = table(spark, "clearance_rule", [dict(item="CLR", sales=3, _pos=1), dict(item="^AAA-CLR", sales=2, _pos=2)])
    out = pricing.sync_pos_catalog(pos, web, pricing.category_price(web), rule)
    got = {r["name"]: (r["price"], r["price_type"], r["tax_rates"]) for r in out.collect()}
    assert got == {"AAA-B-1": (7, "Fixed", "GST+PST"), "AAA-C-9": (12, "Fixed", "GST+PST"), "ZZZ-C-9": (None, "Variable", "GST"), "AAA-CLR-1": (3, "Fixed", "GST+PST")}


def test_adjustment_floors_pos_and_counts_absent_stock_as_zero(spark):
    erp = table(spark, "erp_item", [dict(name="a", inventory_warehouse="S", warehouse_available=3), dict(name="b", inventory_warehouse="C", warehouse_available=9),
                                    dict(name="c", inventory_warehouse="S", warehouse_available=2)])
    pos = table(spark, "pos_item", [dict(name="a", quantity=-2), dict(name="b", quantity=4), dict(name="c", quantity=2), dict(name="x", quantity=5)])
    got = {r["item"]: r["adjust_qty_by"] for r in stock.inventory_adjustment(pos, erp, "S", date(2024, 3, 9)).collect()}
    assert got == {"a": -3, "b": 4}


def test_replenish_targets(spark):
    donor = table(spark, "erp_item", [dict(name=n, warehouse_available=q, item_category_sku=c, item_size=z, item_sku_seasons=s) for n, q, c, z, s in [
        ("AAA-P-2T", 9, "AAA", "2T", "26F"), ("AAA-Q-2T", 9, "AAA", "2T", "25F"), ("AAA-R-2T", 8, "AAA", "2T", "26F"), ("BBB-P-2T", 20, "BBB", "2T", "26F"), ("CCC-P-2T", 20, "CCC", "2T", "26F")]])
    pos = table(spark, "pos_item", [dict(name="AAA-P-2T", quantity=None), dict(name="AAA-Q-2T", quantity=-1), dict(name="AAA-R-2T", quantity=0), dict(name="BBB-P-2T", quantity=1), dict(name="CCC-P-2T", quantity=0), dict(name="AAA-X-1", quantity=0)])
    out = stock.replenish(pos, donor, ["AAA", "BBB"], ["AAA"], ["2T"], "26F", date(2024, 3, 9))
    assert {r["item"]: r["quantity"] for r in out.collect()} == {"AAA-P-2T": 5, "AAA-Q-2T": 2, "BBB-P-2T": 1}


def test_interleaved_orders_get_new_run_ids(spark):
    base = dict(line_item_date="05-Sep-2024 09:00 AM", item_sku="A-A-1", item_total=5, total_discount=0, order_discount_proportion=0, item_tax_rate=0.05,
                order_payment_state="Paid", refunded="false", exchanged="false", order_employee_name="Bob")
    ids = ["A", "A", "B", "A", "C", "N"]
    lines = table(spark, "pos_line", [dict(base, order_id=o, _pos=i, **({"item_sku": "zzz", "total_discount": 2} if i == 4 else {})) for i, o in enumerate(ids)]
                  + [dict(base, order_id="Z", _pos=9, refunded="true"), dict(base, order_id="Y", _pos=10, order_discounts="Partner 5")], "_pos bigint")
    pays = table(spark, "pos_payment", [dict(order_id="A", tender="Cash", result="SUCCESS", customer_name="x y"), dict(order_id="B", tender="WeChat Pay", result="SUCCESS"),
                                        dict(order_id="C", tender="Visa", result="SUCCESS"), dict(order_id="N", tender="Cash", result="FAIL")])
    contacts = spark.createDataFrame([("x y", "1", "e@x")], "name string, phone_number string, email_address string")
    out = orders.pos_sales_orders(lines, pays, contacts, spark.createDataFrame([("A-A-1",)], "name string"), "Ann", ["Partner"], block_rows=2)
    got = sorted((r["ref_id"], r["order_id"], r["payment_option"], r["item_sku"], r["coupon_discount"], r["recipient_email"]) for r in out.collect())
    assert got == [("CLR240905-01", "A", "Cash", "A-A-1", None, "e@x"), ("CLR240905-01", "A", "Cash", "A-A-1", None, "e@x"), ("CLR240905-02", "B", "AlphaPay", "A-A-1", None, None),
                   ("CLR240905-03", "A", "Cash", "A-A-1", None, "e@x"), ("CLR240905-04", "C", "Clover", "MISC-ITEM", Decimal("2.00"), None)]


def carried(df, capsys, column):
    """Exchanges of the plan that carry ``column``: their other columns."""
    df.explain("formatted")
    nodes = re.findall(r"\n\(\d+\) Exchange\n(?:Input|Output) \[\d+\]: \[(.*)\]", capsys.readouterr().out)
    nodes = [set(re.sub(r"#\d+L?", "", n).split(", ")) for n in nodes]
    return [n for n in nodes if column in n]


def till(spark):
    lines = table(spark, "pos_line", [dict(order_id=o, _pos=i, line_item_date="05-Sep-2024 09:00 AM", item_sku="A-A-1", item_total=5, total_discount=1, tax_amount=1, item_tax_rate=0.05, order_payment_state="Paid",
                                           refunded="false", exchanged="false", discounts="Wholesaler line") for i, o in enumerate(["A", "A", "B", "C", None])], "_pos bigint")
    pays = table(spark, "pos_payment", [dict(order_id=o, tender="Cash", amount=7, result="SUCCESS", customer_name=n, _pos=i) for i, (o, n) in enumerate([("A", "x y"), ("A", "p q"), ("B", "p q"), ("C", None)])], "_pos bigint")
    contacts = spark.createDataFrame([("x y", "1", "e@x"), ("p q", "2|3", "f@x|g@x")], "name string, phone_number string, email_address string")
    return lines, pays, contacts


TEXTS = {"phone", "email", "phone_number", "email_address", "recipient_phone", "recipient_email", "__phone", "__email"}


def test_sales_orders_travel_without_contact_texts(spark, capsys):
    lines, pays, contacts = till(spark)
    out = orders.pos_sales_orders(lines, pays, contacts, spark.createDataFrame([("A-A-1",)], "name string"))
    moved = carried(out, capsys, "order_id")
    assert moved and not any(n & TEXTS for n in moved)
    assert sorted((r["order_id"], r["recipient"] or "", r["recipient_phone"] or "") for r in out.collect()) == [("A", "x y", "1"), ("A", "x y", "1"), ("B", "p q", "2|3"), ("C", "", "")]


def test_store_wholesale_travels_without_contact_texts(spark, capsys):
    lines, pays, contacts = till(spark)
    wholesalers = spark.createDataFrame([("e@x", "X Ltd", "777")], "email string, company_name string, phone string")
    done = spark.createDataFrame([("A", "REF1"), ("B", "REF2")], "order_id string, ref_id string")
    per_line, per_order, months = orders.store_wholesale(lines, pays, contacts, wholesalers, done)
    for out in (per_line, per_order, months):
        moved = carried(out, capsys, "order_id")
        assert moved and not any(n & TEXTS for n in moved)
    got = rows(per_line.select("order_id", "ref_id", "quantity", "tender", "company_name", "recipient_phone", "recipient_email"))
    assert got == [("A", "REF1", 2, "Cash:$7.00|Cash:$7.00", "X Ltd", "777", "e@x"), ("B", "REF2", 1, "Cash:$7.00", "p q", "2|3", "f@x|g@x"),
                   ("C", None, 1, "Cash:$7.00", None, None, None), (None, None, 1, None, None, None, None)]
    assert rows(per_order.select("order_id", "amount", "company_name", "discount", "tax"))[0] == ("A", Decimal("14.00"), "X Ltd", Decimal("2.00"), Decimal("2.00"))
    assert rows(months.select("month", "amount", "tax")) == [("09", Decimal("28.00"), Decimal("5.00"))]


def test_contacts(spark):
    c = table(spark, "pos_customer", [dict(first_name="a", last_name="b", phone_number="1", email_address="", _pos=1), dict(first_name="a", last_name="b", phone_number="1", email_address="x@", _pos=2),
                                      dict(first_name="a", last_name="b", phone_number=None, email_address="y@", _pos=3), dict(first_name="", last_name="", phone_number="9", _pos=4),
                                      dict(first_name="n", last_name="o", _pos=5)], "_pos bigint")
    out = customers.consolidate_contacts(c)
    assert rows(out) == [("a b", "1", "x@|y@"), ("n o", None, None)]
    assert rows(customers.ambiguous_contacts(out)) == [("a b", "1", "x@|y@")]
    values = customers.contact_values(c).select("name", "field", "value", "n", "first_pos")
    assert rows(values) == [("a b", "email_address", "x@", 1, 2), ("a b", "email_address", "y@", 1, 3), ("a b", "phone_number", "1", 2, 1)]
    apart = customers.contact_conflicts(c).select("name", "field", "value", "n", "first_pos", "n_values", "n_rows")
    assert rows(apart) == [("a b", "email_address", "x@", 1, 2, 2, 2), ("a b", "email_address", "y@", 1, 3, 2, 2)]
    assert customers.contact_conflicts(c.limit(0)).count() == 0


def test_province_tax(spark):
    df = spark.createDataFrame([("US", "WA", True), ("CA", "AB", True), ("CA", "NL", False), ("CA", "ON", True), ("CA", "ON", False), ("CA", "BC", True), ("CA", "BC", False)], "c string, p string, t boolean")
    got = [r[0] for r in df.select(orders.province_tax_code(F.col("c"), F.col("p"), F.col("t"))).collect()]
    assert got == [".", "CA-AB-GST", "CA-NL-HST", "CA-ON-HST", "CA-ON-GST", "CA-BC-TAX", "CA-BC-GST"]


def test_month_ratio_keeps_elapsed_share(spark):
    last = spark.createDataFrame([(c, m, v) for c in ("A", "B", "C") for m, v in zip(range(1, 13), [.1, .1, .05, .05, .1, .1, .05, .05, .1, .1, .1, .1])], "category string, month int, ratio double")
    sales = spark.createDataFrame([("A", m, float(m * 10)) for m in range(1, 13)] + [("B", m, 0.0) for m in range(1, 13)] + [("Z", 1, 5.0)], "category string, month int, qty double")
    for month in range(1, 13):
        got = {(r["category"], r["month"]): r["ratio"] for r in demand.refresh_month_ratio(sales, last, date(2024, month, 5)).collect()}
        if month <= 2:
            assert len(got) == 36
            continue
        assert {c for c, _ in got} == {"A", "B"}
        assert sum(got["A", m] for m in range(1, 13)) == pytest.approx(1.0)
        assert got["B", 1] == .1 and got["A", 12] == .1
        assert got["A", 1] / got["A", 2] == pytest.approx(.5)


def test_years_of_stock_rules(spark):
    items = spark.createDataFrame([(s, s[:5], "A") for s in ("AA-BB-1", "AA-CC-1", "AA-DD-1", "AA-EE-1", "AA-FF-1")], "sku string, spu string, cat string")
    inv = table(spark, "inventory_week", [dict(adjust_msku=s, inv_total_end_wk=t, inv_warehouse=w) for s, t, w in [("AA-BB-1", 100, 40), ("AA-CC-1", 100, 90), ("AA-DD-1", 10, 10), ("AA-EE-1", 5, 5)]])
    sales = spark.createDataFrame([(ch, s, 2, q) for ch, s, q in [("WEB", "AA-BB-1", 10.0), ("Amazon.com", "AA-BB-1", 5.0), ("WEB", "AA-CC-1", 10.0), ("Amazon.com", "AA-CC-1", 40.0),
                                                                   ("WEB", "AA-DD-1", 0.0), ("Amazon.com", "AA-DD-1", 0.0), ("WEB", "AA-EE-1", 1.0)]], "sales_channel string, adjust_msku string, month int, qty double")
    ratio = spark.createDataFrame([("A", m, .125) for m in range(1, 9)], "category string, month int, ratio double")
    missing = spark.createDataFrame([], "spu string, percent double")
    out = demand.with_years(items, inv, sales, ratio, missing, 4, "WEB", "^Amazon")
    got = {r["spu"]: r["time_yr"] for r in out.collect()}
    # 10 sold in 3 of 8 equal months: 26.67 a year
    assert got["AA-BB"] == pytest.approx(40 / (10 / .375)) and got["AA-CC"] == pytest.approx(100 / (50 / .375))
    assert got["AA-DD"] == float("inf") and got["AA-EE"] is None and "AA-FF" not in got


def test_missing_sizes(spark):
    erp = table(spark, "erp_item", [dict(name=n, warehouse_available=q) for n, q in [("A-B-1", 5), ("A-B-2", 0), ("A-B-3", 1), ("A-B-3-V1", 9), ("A-C-1", 0), ("A-D-1", 5), ("A-D-1-V1", 5)]])
    got = {r["spu"]: r["percent"] for r in demand.size_missing(erp, 1).collect()}
    assert got == {"A-B": pytest.approx(1 / 3), "A-D": 0.0}


def packing(spark):
    return table(spark, "packing_line", [
        dict(_pos=1, sheet=2, sheet_name="s2", ctn_no="7", po="P1", season="25F", sku="A-B-1", qty_shipped=4.0, unit_weight="0.2", gross_weight_per_ctn=1.0),
        dict(_pos=2, sheet=2, sheet_name="s2", sku="A-B-2", qty_shipped=6.0, unit_weight="300"),
        dict(_pos=3, sheet=2, sheet_name="s2", sku="total", qty_shipped=10.0),
        dict(_pos=4, sheet=3, sheet_name="s3", ctn_start=3, ctn_end=6, po="P9", sku="A-B-1", qty_per_box=2.0, unit_weight="200"),
        dict(_pos=5, sheet=3, sheet_name="s3", sku="A-B-2-V1", qty_per_box=1.0, unit_weight="300")], "_pos bigint")


def test_packing_layouts(spark):
    out = inbound.normalise_packing(packing(spark))
    got = rows(out.select("box_no", "po", "sku", "quantity", "unit_weight_g"))
    assert got == sorted([("2-7", "P1", "A-B-1", 4.0, 200.0), ("2-7", "P1", "A-B-2", 6.0, 300.0)]
                         + [(f"3-{n}", "P9", s, q, w) for n in range(3, 7) for s, q, w in (("A-B-1", 2.0, 200.0), ("A-B-2-V1", 1.0, 300.0))])
    est = {r["box_no"]: r["est_weight"] for r in inbound.box_weight(out, spark.createDataFrame([], "category string, size string, unit_weight double")).collect()}
    assert est["2-7"] == 3.6 and est["3-3"] == 1.7
    check = inbound.check_totals(out, spark.createDataFrame([(1, 1, 1), (22, 5, 2)], "qty int, number_of_box int, _pos int")).first()
    assert check["qty_ok"] and check["boxes_ok"]


def test_over_receipt_conserves_quantity(spark):
    ship = spark.createDataFrame([("P1-CA", "over", 10.0, "D1", "2-1"), ("P1-CA", "even", 5.0, "D1", "2-2"), ("P1-CA", "below", 3.0, "D1", "2-3"), ("P1-CA", "gone", 2.0, "D1", "x" * 310),
                                  ("P7", "lost", 4.0, None, "2-5")], "po_ref string, item string, quantity double, document string, box_no string")
    po = spark.createDataFrame([("P1-CA", "over", 6.0), ("P1-CA", "even", 5.0), ("P1-CA", "below", 8.0)], "ref_no string, item string, quantity_remain double")
    out = inbound.split_over_receipt(ship, po, "S1", "PO#9")
    got = {(r["po_ref"], r["item"]): r["quantity"] for r in out.collect()}
    assert got == {("P1-CA", "over"): 6.0, ("Over.S1", "over"): 4.0, ("P1-CA", "even"): 5.0, ("P1-CA", "below"): 3.0, ("Over.S1", "gone"): 2.0, ("Over.S1", "lost"): 4.0}
    assert sum(got.values()) == 24.0
    assert max(len(r["box_no"]) for r in out.collect()) == 310  # boxes are never cut from the list
    assert {r["item"]: r["over"] for r in inbound.over_received(ship, po).collect()} == {"over": 4.0, "gone": 2.0, "lost": 4.0}


def test_po_reference_retry(spark):
    po = table(spark, "po_line", [dict(ref_no="P1-CA", document_number="D1"), dict(ref_no="P2", document_number="D2"), dict(ref_no="P3-CA", document_number=None), dict(ref_no="P3", document_number="D3")])
    lines = spark.createDataFrame([("P1",), ("P2",), ("P3",), ("P4",)], "po string")
    got = {r["po"]: (r["po_ref"], r["document"]) for r in inbound.resolve_po(lines, po).collect()}
    assert got == {"P1": ("P1-CA", "D1"), "P2": ("P2", "D2"), "P3": ("P3-CA", None), "P4": ("P4", None)}


def test_plan_lines_are_summed_before_regions_become_rows(spark):
    req = table(spark, "po_request", [dict(po="P1", sku="A-B-1", total_qty=5, qty_uk=2), dict(po="P1", sku=" A-B-1", total_qty=4, qty_uk=0), dict(po="P1", sku="Total", total_qty=9),
                                      dict(po=None, sku="A-B-2", qty_ca=1), dict(po="P2", sku="A-B-1")])
    out = ledger.plan_lines(req)
    assert rows(out) == [("P1", "A-B-1", "Total", 9), ("P1", "A-B-1", "UK", 2), (None, "A-B-2", "CA/US", 1)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Expand") < plan.index("HashAggregate")


def test_web_orders_travel_with_the_used_columns(spark, capsys):
    names = "order_number string, order_date string, order_status string, order_total decimal(12,2), country_code string, state_code string, sku string, quantity int"
    lines = spark.createDataFrame([("1", "2000-05-02 08:00", "b", Decimal(7), "CA", "BC", "x", 1), ("1", "2000-05-02 08:00", "a", Decimal(9), "CA", "ON", "y", 2), ("1", "2000-05-02 08:00", "a", Decimal(9), "CA", "ON", "x", 1),
                                   ("2", "1999-05-02 08:00", "a", Decimal(5), "US", "WA", "x", 1)], names)
    out = reports.web_region_yoy(lines, [1999, 2000])
    assert not any(n & {"sku", "quantity"} for n in carried(out, capsys, "order_number"))
    assert rows(out) == [(1999, 5, "US", "US", "amount", 5.0), (1999, 5, "US", "US", "orders", 1.0), (2000, 5, "CA", "ON", "amount", 9.0), (2000, 5, "CA", "ON", "orders", 1.0)]
    last = lines.withColumn("_pos", -F.monotonically_increasing_id())
    assert ("amount", 9.0) in rows(reports.web_region_yoy(last, [2000]).select("measure", "value"))


def test_ledger_is_idempotent_and_conserves(spark):
    plan = spark.createDataFrame([("P1", "A-B-1", "Total", 10), ("P1", "A-B-1", "UK", 4), ("P1", "A-B-1", "CA/US", 6), ("P1", "A-B-2", "Total", 0)], "po string, sku string, region string, plan int")
    ship = spark.createDataFrame([("P1", "A-B-1", "UK", 3), ("P1", "A-B-1", "UK", 2), ("P1", "X-Y-1", "UK", 1)], "po string, sku string, region string, quantity int")
    out = ledger.apply_shipments(plan, ship)
    got = {(r["sku"], r["region"]): (r["remaining"], r["percent"], r["flag"], r["unplanned"]) for r in out.filter("level = 'line'").collect()}
    assert got["A-B-1", "Total"] == (5, 50.0, True, False) and got["A-B-1", "UK"] == (-1, -25.0, True, False) and got["A-B-2", "Total"] == (0, 0.0, False, False)
    assert got["X-Y-1", "Total"][3] is True and got["A-B-1", "CA/US"] == (6, 100.0, True, False)
    assert out.filter("remaining + shipped != plan").count() == 0
    assert rows(ledger.apply_shipments(plan, ship)) == rows(out)


def test_region_orders_due_dates(spark):
    req = table(spark, "po_request", [dict(po="P1", category="AAA", vendor="v", memo="m", sku="AAA-B-1", qty_ca=5, qty_uk=0, ship_date="2025.03.01"),
                                      dict(po="P1", category="BBB", vendor="v", memo="m", sku="BBB-B-1", qty_uk=2, ship_date="2025.03.01"), dict(po="P1", category="AAA", sku="Total", qty_ca=9)])
    start = table(spark, "season_start", [dict(category="BBB", arrival_date="2025-08-01")])
    out = purchasing.region_pos(req, start, date(2025, 1, 2), "25F", {"CA": "W", "UK": "U"})
    assert {(r["ref_no"], r["item"]): (r["quantity"], r["due_date"], r["warehouse"]) for r in out.collect()} == {
        ("P1-CA", "AAA-B-1"): (5, "04/10/2025", "W"), ("P1-UK", "BBB-B-1"): (2, "08/01/2025", "U")}


def test_returns_by_province_names(spark):
    names = ["Québec", "QUEBEC", "Ontario", "toronto", "Colombie-Britannique", "british columbia", "Nouveau-Brunswick"]
    tx = table(spark, "amz_transaction", [dict(type="Order", sku="IAA-B-1", quantity=10, order_state=n) for n in names] + [dict(type="Refund", sku="IAA-B-1", quantity=2, order_state="Québec")])
    got = {r["state"]: (r["orders"], r["return_rate"]) for r in reports.return_rate(tx, PROVINCE_CODES).collect()}
    assert got == {"QC": (20, .1), "ON": (20, 0.0), "BC": (20, 0.0), "NB": (10, 0.0)}


def test_winter_bins_stay_inside_their_subset(spark):
    rows_ = [(f"A-P{i}-1", f"A-P{i}", "24F" if i % 2 else "23F", Decimal("10.00"), 0.0, 50, float(i), 100.0, 10.0 + i) for i in range(40)]
    frame = spark.createDataFrame(rows_, "sku string, spu string, seasons string, regular_price decimal(12,2), discount double, qty int, qty_spu double, sales_yr double, sales_half double")
    got = {r["suggest_discount"] for r in clearance.clearance_carry_over(frame, "24").collect()}
    assert got <= {0.05, 0.1, 0.15000000000000002, 0.2, 0.25}


def test_store_day_without_sales_is_zero(spark):
    pay = table(spark, "pos_payment", [dict(payment_date="02-Jan-2024 10:00", amount=5, result="SUCCESS"), dict(payment_date="07-Jan-2024 10:00", amount=7, result="SUCCESS"), dict(payment_date="03-Jan-2024", amount=0, result="SUCCESS")])
    days = calendar(spark, date(2024, 1, 1), date(2024, 1, 8), closed=[date(2024, 1, 1)])
    got = {r["date"].day: int(r["amount"]) for r in reports.daily_sales(reports.store_payments(pay), days).collect()}
    assert got == {2: 5, 3: 0, 4: 0, 5: 0, 6: 0, 7: 7, 8: 0}


def test_first_row_of_a_sku_decides_even_without_a_price(spark):
    web = spark.createDataFrame([(1, "A-A-1", None, None), (2, "A-A-1", Decimal("9.00"), None), (3, "B-B-1", Decimal("5.00"), None)],
                                "id bigint, sku string, regular_price decimal(12,2), sale_price decimal(12,2)")
    assert [r.sku for r in pricing.effective_price(web, None).collect()] == ["B-B-1"]


def test_an_email_belongs_to_its_first_customer(spark):
    from retailflow.jobs import customers
    df = spark.createDataFrame([(1, "", "", "a@x"), (2, "Ann", "B", "a@x"), (3, "Cy", "D", "c@x"), (4, "Cy", "D", "d@x")],
                               "_pos bigint, first_name string, last_name string, email_address string")
    assert [(r.name, r.email_address) for r in customers.named_emails(df).collect()] == [("Cy D", "c@x")]


def test_flags_read_one_decimal(spark):
    plan = spark.createDataFrame([("p", f"s{i}", "CA/US", 10_000) for i in range(4)], "po string, sku string, region string, plan bigint")
    ship = spark.createDataFrame([("p", "s0", "CA/US", 9_896), ("p", "s1", "CA/US", 9_895), ("p", "s2", "CA/US", 11_004), ("p", "s3", "CA/US", 11_005)],
                                 "po string, sku string, region string, quantity bigint")
    got = {r.sku: r.flag for r in ledger.apply_shipments(plan, ship).collect() if r.level == "line" and r.region == "CA/US"}
    assert got == {"s0": False, "s1": True, "s2": False, "s3": True}


def test_last_alias_and_last_order_decide(spark):
    master = spark.createDataFrame([(1, "a-b-1", "X", None), (2, "a-b-2", "X", None), (3, "c-d-1", None, None)], "_pos bigint, msku string, fbasku_de string, fbasku_us string")
    po = spark.createDataFrame([(1, "A-b-1", "P9-CA"), (2, "A-b-2", "P1-CA")], "_pos bigint, sku string, po string")
    out = ledger.manifest_to_po(spark.createDataFrame([("X", 3), ("C-D-1-A7", 2)], "merchant_sku string, quantity bigint"), master, po)
    assert rows(out) == rows(spark.createDataFrame([("P1", "A-B-2", 3), (None, "C-D-1", 2)], "po string, sku string, quantity bigint"))
    wide = spark.createDataFrame([("K", "L"), ("M", "K")], "f1 string, f2 string")
    assert {r.category: r.factory for r in ledger.factory_by_category(wide, ["f1", "f2"]).collect()} == {"K": "f2", "L": "f2", "M": "f1"}


def test_all_boxes_of_an_item_are_listed(spark):
    from retailflow.jobs import inbound
    df = spark.createDataFrame([(i, 0, "P1", "A-B-1", f"b{i}", 1.0, "d") for i in range(200)], "_pos bigint, _box_seq int, po_ref string, sku string, box_no string, quantity double, document string")
    assert inbound.collapse_shipment(df).first()["box_no"].split(" | ") == [f"b{i}" for i in range(200)]


def test_duplicate_pos_names_do_not_multiply_rows(spark):
    master = spark.createDataFrame([("A-B-1", "Active", "24F")], "msku string, msku_status string, seasons_sku string")
    pos = spark.createDataFrame([(2, "A-B-1", 5), (1, "A-B-1", 0)], "_pos bigint, name string, quantity int")
    inv = spark.createDataFrame([("A-B-1", 0)], "adjust_msku string, inv_total_end_wk int")
    assert [(r.msku, r.inv_pos) for r in demand.to_inactivate(master, pos, inv, "26S").collect()] == [("A-B-1", 0)]


def test_status_log_twice_is_once(spark, tmp_path):
    from retailflow.schemas import STATUS_LOG_HEADERS
    from retailflow.sources.writers import VersionedTable
    from pyspark.sql import types as T
    log = VersionedTable(spark, str(tmp_path / "log"), T.StructType.fromDDL(", ".join(f"{c} {'int' if c.endswith('qty') else 'string'}" for c in STATUS_LOG_HEADERS)))
    order = "extra_note_1 string, shipment_order_date string, sku string, total_quantity int, shipping_service string, billing_state string"
    synced = spark.createDataFrame([("A", "2024-01-02 10:00", "s1", 1, "Cheapest Service", "BC"), ("A", "2024-01-02 10:00", "s2", 1, "Fast", "BC")], order)
    shipped = spark.createDataFrame([("B", "2024-01-03 10:00", "s3", 4, "Fast", "ON")], order)
    for version in (1, 2, 3):
        assert stock.tpl_refresh(log, synced, shipped) == version
        got = sorted((r.order_id, r.status, r["items"], r.shipping_required, r.total_qty, r.shipped_qty, r.shipped_from) for r in log.read().collect())
        assert got == [("A", "Synced", "s1", "", 1, 1, "Whole"), ("B", "Shipped", "", "Express", 4, 4, "Whole")]
    stock.tpl_refresh(log, spark.createDataFrame([], order), synced)
    assert {r.order_id: r.status for r in log.read().collect()} == {"A": "Shipped", "B": "Shipped"}


def test_ledger_is_checked_against_stated_totals(spark, tmp_path):
    from retailflow.jobs import ledger
    from retailflow.sources.writers import TotalsDiffer, write_checked
    lines = spark.createDataFrame([("P1", "A-B-1", "Total", 5), ("P1", "A-B-2", "Total", 7), ("P1", "A-B-2", "CA/US", 3), ("P2", "C-D-1", "Total", 2), ("P3", "C-D-1", "Total", 2)],
                                  "po string, sku string, region string, plan int")
    stated = spark.createDataFrame([("P1", 12), ("P2", 3)], "po string, total_qty int")
    out = ledger.stated_totals(lines, stated)
    assert {(r.po, r.total_ok) for r in out.collect()} == {("P1", True), ("P2", False), ("P3", None)}
    assert write_checked(out.filter("po = 'P1'"), str(tmp_path / "a"), ledger.totals_hold()) == {"lines_off": 0}
    with pytest.raises(TotalsDiffer):
        write_checked(out, str(tmp_path / "b"), ledger.totals_hold())
