"""Point-of-sale and marketplace sales to ERP sales orders; returns; store wholesale."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import (
    CARRIER_HOME, CARRIER_US, CLASS_HOME, CLASS_MARKET, COMMIT_AVAILABLE, GST_ONLY_PROVINCES, HST_ONLY_PROVINCES,
    HST_PROVINCES, MARKET_CARRIER, MARKET_COUNTRIES, MARKET_PROVINCES, MISC_ITEM, PAY_CARD_ONLINE, PAY_CASH, PAY_POS, PAY_POS2, PAY_WALLET, PRICE_LEVEL,
    REASON_EXCHANGE, REASON_RETURN, SHIP_FREE, SHIP_PAID, SHIP_STANDARD, TAXABLE_CATEGORIES, TAX_ABROAD,
    TAX_FEDERAL, TAX_FULL, TERMS, WALK_IN, WALK_IN_NOTE,
)
from ..functions import sku
from ..functions.semantics import any_field_rlike, isin0, money, money_round, not_blank, parse_date, r_ifelse, rlike0, substitutions, trunc_cents
from ..operators.groups import BLOCK_ROWS, join_text, with_group_total
from ..operators.keys import first_per_key, source_order
from ..operators.lookup import anti, lookup, semi
from ..operators.scan import run_id
from ..schemas import MARKET_ORDER_HEADERS, SALES_ORDER_HEADERS, STORE_WHOLESALE_HEADERS


@dataclass(frozen=True)
class Store:
    """How a store is named in the ERP."""

    customer: str
    order_type: str
    department: str
    warehouse: str
    prefix: str = ""


MAIN = Store("store 1", "SHOP 1", "Retail : Store 1", "WH-STORE", "CLR")
SECOND = Store("store 2", "SHOP 2", "Retail : Store 2", "WH-CENTRAL", "CLS")

SALES_ORDER = tuple(SALES_ORDER_HEADERS)


def _pick(cond: Column, field: str, second: Store, main: Store) -> Column:
    return F.when(cond, F.lit(getattr(second, field))).otherwise(F.lit(getattr(main, field)))


def known_item(lines: DataFrame, items: DataFrame, col: str) -> DataFrame:
    """Items the ERP does not know become the miscellaneous item."""
    out = lookup(lines, items.select(F.col("name")).distinct(), {col: "name"}, {}, unique="grouped", flag="__known")
    return out.withColumn(col, F.when(F.col("__known"), F.col(col)).otherwise(F.lit(MISC_ITEM))).drop("__known")


def rate_tax_code(rate: Column, gst: str = TAX_FEDERAL, full: str = TAX_FULL) -> Column:
    return F.when(rate == 0.05, gst).when(rate == 0.12, full).otherwise("")


def zero_to_null(c: Column) -> Column:
    return F.when(c == 0, F.lit(None)).otherwise(c)


def payment_option(tender: Column, card: str) -> Column:
    return r_ifelse(tender == PAY_CASH, F.lit(PAY_CASH), F.when(rlike0(tender, "WeChat"), PAY_WALLET).otherwise(card))


def coupon_code(*cols: str) -> Column:
    return F.regexp_replace(F.concat(*[F.coalesce(F.col(c), F.lit("")) for c in cols]), " -.*", "")


def ref_id(prefix: Column, day: Column, run: Column) -> Column:
    return F.concat(prefix, F.date_format(day, "yyMMdd"), F.lit("-"), F.format_string("%02d", run))


def order_payments(payments: DataFrame) -> DataFrame:
    """Successful payments, one per order."""
    paid = payments.filter(F.col("result") == "SUCCESS")
    return first_per_key(paid, "order_id", source_order(paid))


def pos_sales_orders(lines: DataFrame, payments: DataFrame, contacts: DataFrame, items: DataFrame,
                     second_employee: str = "", exclude_discounts: Sequence[str] = (), main: Store = MAIN,
                     second: Store = SECOND, card: str = PAY_POS, memo: str = "POS sales",
                     block_rows: int = BLOCK_ROWS) -> DataFrame:
    """POS line items as ERP sales orders.

    Paid, not refunded, not exchanged lines; reference = store prefix + date + run number of the order within
    the day, in file order (``_pos``); lines whose order has no successful payment are dropped.
    A contact's text grows with the customers of a name: it is looked up last, no exchange carries it with the lines.
    """
    kept = known_item(lines, items, "item_sku").filter(
        (F.col("order_payment_state") == "Paid") & (F.col("refunded") == "false") & (F.col("exchanged") == "false"))
    for mark in exclude_discounts:
        kept = kept.filter(~F.coalesce(F.col("order_discounts").contains(mark), F.lit(False)))
    kept = kept.withColumn("__day", parse_date("line_item_date", "dd-MMM-yyyy"))
    runs = run_id(kept, "order_id", "_pos", ["__day"], "__run", block_rows)
    runs = lookup(runs, order_payments(payments), "order_id", {"customer_name": "recipient", "tender": "__tender"}, unique="grouped")
    two = F.coalesce(F.col("order_employee_name") == second_employee, F.lit(False))
    out = runs.withColumns({
        "payment_option": payment_option(F.col("__tender"), card),
        "class": F.lit(CLASS_HOME), "memo": F.lit(memo),
        "order_date": F.date_format("__day", "MM/dd/yyyy"),
        "ref_id": ref_id(_pick(two, "prefix", second, main), F.col("__day"), F.col("__run")),
        "customer": _pick(two, "customer", second, main), "order_type": _pick(two, "order_type", second, main),
        "department": _pick(two, "department", second, main), "warehouse": _pick(two, "warehouse", second, main),
        "quantity": F.lit(1), "price_level": F.lit(PRICE_LEVEL), "rate": F.col("item_total"),
        "coupon_discount": zero_to_null(F.col("total_discount") + F.col("order_discount_proportion")),
        "coupon_code": coupon_code("order_discounts", "discounts"),
        "tax_code": F.when(F.col("item_tax_rate").isNotNull(), rate_tax_code(F.col("item_tax_rate"))),
        "shipping_carrier": F.lit(""), "shipping_method": F.lit(""), "shipping_cost": F.lit(0),
    })
    contact = {"phone_number": "recipient_phone", "email_address": "recipient_email"}
    out = out.filter(F.col("payment_option").isNotNull()).select(*[c for c in SALES_ORDER if c not in contact.values()])
    return lookup(out, contacts, {"recipient": "name"}, contact, unique=True).select(*SALES_ORDER)


def sold_by_employee(lines: DataFrame, employee: str) -> DataFrame:
    """Pieces sold by one till user per item: the other store's sales, to put back into POS stock."""
    return lines.filter(F.col("order_employee_name") == employee).groupBy(F.col("item_sku").alias("item")).agg(
        F.count(F.lit(1)).alias("quantity"))


def pos2_sales_orders(lines: DataFrame, payments: DataFrame, customers: DataFrame, items: DataFrame,
                      second_location: str = "", main: Store = MAIN, second: Store = SECOND, card: str = PAY_POS2,
                      memo: str = "POS 2 sales", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Second POS as sales orders: the store from the location, rate = net / quantity, tax code from the tax share."""
    kept = known_item(lines, items, "item").withColumn("__day", F.to_date("date"))
    kept = run_id(kept, "transaction_id", "_pos", ["__day"], "__run", block_rows)
    paid = payments.filter(F.col("event_type") != "Refund")
    kept = lookup(kept, paid, "payment_id", {"cash": "__cash"}, order=source_order(paid))
    kept = lookup(kept, customers, "customer_id", {"email": "recipient_email", "phone": "recipient_phone"},
                  unique=True, defaults={"recipient_email": None, "recipient_phone": None})
    two = F.coalesce(F.col("location") == second_location, F.lit(False))
    net, tax = money("net_sales"), money("tax")
    share = F.bround(F.try_divide(tax, net), 2).cast("double")
    out = kept.withColumns({
        "payment_option": F.when((F.col("__cash") == "$0.00") | F.col("__cash").isNull(), card).otherwise(PAY_CASH),
        "class": F.lit(CLASS_HOME), "memo": F.lit(memo), "order_date": F.date_format("__day", "MM/dd/yyyy"),
        "ref_id": ref_id(F.lit("SQ"), F.col("__day"), F.col("__run")),
        "customer": _pick(two, "customer", second, main), "order_type": _pick(two, "order_type", second, main),
        "department": _pick(two, "department", second, main), "warehouse": _pick(two, "warehouse", second, main),
        "order_id": F.col("transaction_id"), "item_sku": F.col("item"), "quantity": F.col("qty"),
        "price_level": F.lit(PRICE_LEVEL), "rate": money_round(F.try_divide(net, F.col("qty").cast("decimal(12,2)"))),
        "coupon_discount": zero_to_null(money("discounts")), "coupon_code": F.lit(""),
        "tax_code": F.when(share.isNotNull(), rate_tax_code(share)), "tax_amount": tax,
        "recipient": F.coalesce("customer_name", F.lit("")),
        "shipping_carrier": F.lit(""), "shipping_method": F.lit(""), "shipping_cost": F.lit(0),
    })
    return out.filter(F.col("quantity") > 0).select(*SALES_ORDER)


def translated(orders: DataFrame, countries: Sequence[tuple[str, str]] = MARKET_COUNTRIES,
               provinces: Sequence[tuple[str, str]] = MARKET_PROVINCES) -> DataFrame:
    """Marketplace orders with country and province names as codes."""
    return orders.withColumns({"shipping_country": substitutions("shipping_country", countries), "shipping_province": substitutions("shipping_province", provinces)})


def market_cash_sales(orders: DataFrame, home_country: str, warehouse: str = "WH-STORE", account: str = "market",
                      prefix: str = "MKT-") -> DataFrame:
    """Paid marketplace orders of the home country; rate is net of the line discount."""
    paid = translated(orders).filter((F.col("financial_status") == "paid") & (F.col("shipping_country") == home_country))
    net = F.col("lineitem_total") - F.col("lineitem_total_discount")
    out = paid.withColumns({
        "payment_option": F.lit(PAY_WALLET), "class": F.lit(CLASS_MARKET), "memo": F.lit("Marketplace sales"),
        "customer": F.lit(account), "order_date": F.date_format(F.to_date(F.split("created_at", " ")[0]), "MM/dd/yyyy"),
        "order_id": F.col("order_no"), "ref_id": F.concat(F.lit(prefix), "order_no"), "order_type": F.lit("MARKET"),
        "department": F.lit("Retail : Marketplace"), "warehouse": F.lit(warehouse), "item_sku": F.col("lineitem_sku"),
        "quantity": F.col("lineitem_quantity"), "price_level": F.lit(PRICE_LEVEL),
        "rate": money_round(F.try_divide(net, F.col("lineitem_quantity").cast("decimal(10,0)"))),
        "coupon_discount": zero_to_null(F.col("lineitem_total_discount")), "coupon_code": F.lit(""),
        "tax_code": F.lit(""), "tax_amount": F.lit(None).cast("decimal(12,2)"),
        "recipient": F.concat("shipping_last_name", "shipping_first_name"), "recipient_phone": F.col("phone"),
        "recipient_email": F.col("email"), "shipping_carrier": F.lit(MARKET_CARRIER), "shipping_method": F.lit(""),
        "shipping_cost": F.col("shipping"),
    })
    return out.select(*SALES_ORDER)


def province_tax_code(country: Column, province: Column, taxable: Column) -> Column:
    """Sales tax code: none abroad, federal only, harmonised, or federal plus provincial for taxable goods."""
    code = lambda kind: F.concat(F.lit("CA-"), province, F.lit(kind))
    return (F.when(country == "US", TAX_ABROAD)
            .when(isin0(province, GST_ONLY_PROVINCES), code("-GST"))
            .when(isin0(province, HST_ONLY_PROVINCES), code("-HST"))
            .when(isin0(province, HST_PROVINCES) & taxable, code("-HST"))
            .when(isin0(province, HST_PROVINCES), code("-GST"))
            .when(taxable, code("-TAX")).otherwise(code("-GST")))


def market_sales_orders(orders: DataFrame, home_country: str, as_of: date, taxable: Sequence[str] = TAXABLE_CATEGORIES,
                        pickup_points: Sequence[tuple[str, str]] = (), pickup_default: str = "Pickup at Warehouse",
                        service_points: Sequence[tuple[str, str]] = (), warehouse: str = "WH-CENTRAL",
                        accounts: tuple[str, str] = ("market CA", "market US"), department: str = "Retail : Marketplace",
                        memo: str = "Marketplace order") -> DataFrame:
    """Paid marketplace orders shipped to CA or US in the upload's layout (``MARKET_ORDER_HEADERS``), with tax code, pickup or
    shipping method, ship-by = as_of + 1.  ``accounts`` are the customers of home and other orders.

    ``pickup_points`` and ``service_points`` map a city to its pickup method and service label.
    """
    paid = translated(orders).filter((F.col("financial_status") == "paid") & (F.col("shipping_country") != home_country))
    country, city = F.col("shipping_country"), F.col("shipping_city")
    pickup = F.coalesce(F.col("delivery_method") == "pickup", F.lit(False))
    name = F.when(pickup, F.col("pickup_person_name")).otherwise(F.concat_ws(" ", "shipping_first_name", "shipping_last_name"))
    at = lambda points, default: F.coalesce(*[F.when(city == c, F.lit(v)) for c, v in points], default)
    ca = country == "CA"
    order_id = F.concat(F.lit("MKT"), country, F.lit("-"), "order_no")
    order_date = F.date_format(F.to_date(F.split("created_at", " ")[0]), "MM/dd/yyyy")
    address = F.concat_ws(" ", "shipping_address1", F.coalesce("shipping_address2", F.lit("")))
    out = {
        "customer_id": F.when(ca, accounts[0]).otherwise(accounts[1]), "order_type_code": F.concat(F.lit("MARKET "), country),
        "order_id": order_id, "ref_number": order_id, "date": F.lit(as_of.strftime("%m/%d/%Y")), "order_date": order_date,
        "sales_effective_date": order_date, "ship_by_date": F.lit((as_of + timedelta(days=1)).strftime("%m/%d/%Y")),
        "price_level": F.lit(PRICE_LEVEL), "sku": F.col("lineitem_sku"), "unit_price": F.col("lineitem_unit_price"),
        "qty": F.col("lineitem_quantity"), "amount": F.col("lineitem_total") - F.col("lineitem_total_discount"),
        "tax_code": province_tax_code(country, F.col("shipping_province"), isin0(sku.category("lineitem_sku"), taxable)),
        "coupon_discount": F.col("lineitem_total_discount"), "order_coupon_code": F.col("promotion_detail"),
        "shipping_cost": F.col("shipping"), "shipping_tax_code": F.lit(TAX_ABROAD), "order_total": F.col("total"),
        "shipping_method": F.when(~pickup, F.when(F.col("shipping") == 0, SHIP_FREE).otherwise(SHIP_PAID)).otherwise(at(pickup_points, F.lit(pickup_default))),
        "commit": F.lit(COMMIT_AVAILABLE), "marketplace_payment_method": F.col("payment_method"),
        "payment_option": F.when(F.col("payment_method") == "Stripe", PAY_CARD_ONLINE).otherwise(PAY_WALLET),
        "terms": F.lit(TERMS), "to_be_emailed": F.lit("No"),
        "shipping_name": name, "shipping_address1": address, "shipping_city": city, "shipping_province": F.col("shipping_province"),
        "shipping_country": country, "shipping_postal_code": F.col("shipping_zip"),
        "billing_name": name, "billing_address1": address, "billing_city": city, "billing_province": F.col("shipping_province"),
        "billing_country": country, "billing_postal_code": F.col("shipping_zip"),
        "department": F.lit(department), "class": F.concat(F.lit("FBM : "), country), "warehouse": F.lit(warehouse),
        "recipient": name, "recipient_email": F.col("email"), "recipient_phone": F.col("phone"),
        "carrier": F.when(ca, CARRIER_HOME[0]).otherwise(CARRIER_US[0]), "shipping_service": F.when(ca, CARRIER_HOME[1]).otherwise(CARRIER_US[1]),
        "service": F.when(~pickup, SHIP_STANDARD).otherwise(at(service_points, F.concat_ws(" ", city, F.lit("Pickup")))),
        "order_issue": F.lit(""), "memo": F.lit(memo),
    }
    return paid.select(*[out[c].alias(c) for c in MARKET_ORDER_HEADERS])


def returns_adjustment(returns: DataFrame, as_of: date, warehouse: str = "WH-STORE") -> DataFrame:
    """Unprocessed returns and exchanges as stock adjustments."""
    todo = returns.filter(F.col("ns_action").isNull() & (F.col("return_qty") != 0))
    text = [F.coalesce(F.col(c), F.lit("")) for c in ("original_order_id", "order_channel", "return_reason", "notes")]
    return todo.select(
        F.lit(as_of.strftime("%m/%d/%Y")).alias("date"), F.col("return_item_sku").alias("item"),
        F.col("return_qty").alias("adjust_qty_by"), F.when(F.col("exchange_qty").isNull(), REASON_RETURN).otherwise(REASON_EXCHANGE).alias("reason_code"),
        F.concat_ws(" | ", *text).alias("memo"), F.lit(warehouse).alias("warehouse"),
        F.lit(f"IAR-{as_of:%y%m%d}-1").alias("external_id"))


@dataclass(frozen=True)
class Pickup:
    """A pickup point: what names it, the till location that implies it, its address."""

    pattern: str
    location: str | None
    address: tuple[str, str, str, str, str]


def pos2_import_orders(items: DataFrame, customers: DataFrame, pickups: Sequence[Pickup], walk_in_location: str = "",
                       prefix: str = "POP", by_file: str | None = None, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Second POS items in the import layout of the order system.

    The order number grows whenever the transaction changes along the file; a pickup point named in any
    field of the line or in the customer's address replaces the address; nameless customers are walk-ins.
    """
    fields = [c for c in items.columns if c not in ("_pos", by_file)]
    numbered = run_id(items, "transaction_id", "_pos", [by_file] if by_file else [], "__no", block_rows)
    c = {k: f"__{k}" for k in ("first_name", "last_name", "phone", "email", "address1", "address2", "city", "state", "zip")}
    out = lookup(numbered, customers, "customer_id", c, unique=True)
    nameless = (F.coalesce("__first_name", F.lit("")) == "") & (F.coalesce("__last_name", F.lit("")) == "")
    hits = [any_field_rlike([*fields, "__address1"], "(?i)" + p.pattern)
            | (F.coalesce(F.col("location") == p.location, F.lit(False)) if p.location else F.lit(False)) for p in pickups]

    def where(i: int, own: str) -> Column:
        value = None
        for hit, p in zip(hits, pickups):
            value = F.when(hit, F.lit(p.address[i])) if value is None else value.when(hit, F.lit(p.address[i]))
        return F.col(own) if value is None else value.otherwise(F.col(own))

    walk_in = F.coalesce(F.col("location") == walk_in_location, F.lit(False))
    return out.select(
        F.regexp_replace("date", "-", "").alias("order_date"),
        F.concat(F.lit(prefix), F.regexp_replace("date", "-", ""), F.lit("-"), F.format_string("%02d", F.col("__no"))).alias("order_number"),
        F.when(nameless, WALK_IN).otherwise(F.col("__last_name")).alias("last_name"),
        F.when(nameless, F.col("location")).otherwise(F.col("__first_name")).alias("first_name"),
        F.regexp_replace("__phone", r"'\+", "").alias("main_phone"), F.col("__email").alias("main_email"),
        F.when(walk_in, WALK_IN_NOTE).otherwise("").alias("customer_note"), F.lit(TERMS).alias("payment_terms"),
        F.col("item").alias("sku"), trunc_cents(F.try_divide(money("net_sales"), F.col("qty").cast("decimal(12,2)"))).alias("unit_price"),
        F.col("qty"), where(0, "__address1").alias("shipping_address"), where(1, "__address2").alias("shipping_address_2"),
        where(2, "__city").alias("shipping_city"), where(3, "__state").alias("shipping_state"), F.lit("CA").alias("shipping_country"),
        where(4, "__zip").alias("shipping_zip"), F.col("transaction_id").alias("po_no"))


def recode_oversold(errors: DataFrame, stock: DataFrame) -> DataFrame:
    """Rejected rows whose item is asked for beyond its stock become the miscellaneous item."""
    out = with_group_total(errors, "item_sku", {"qty_total": F.sum("quantity")})
    out = lookup(out, stock, {"item_sku": "name"}, {"warehouse_available": "qty_stock"}, unique=True)
    over = F.col("qty_total") > F.col("qty_stock")
    return out.withColumn("item_sku", r_ifelse(over, F.lit(MISC_ITEM), F.col("item_sku")))


def unstocked_errors(errors: DataFrame, stock: DataFrame) -> DataFrame:
    """Rejected rows of items without stock."""
    return anti(errors, stock.filter(F.col("warehouse_available") > 0), {"item_sku": "name"})


def store_wholesale(lines: DataFrame, payments: DataFrame, contacts: DataFrame, wholesalers: DataFrame, orders: DataFrame,
                    mark: str = "Wholesaler", store: Store = MAIN, block_rows: int = BLOCK_ROWS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Wholesale orders taken in the store: lines summed by (reference, item) in the upload's layout and their tender, orders, months.

    ``orders`` are the sales orders already uploaded (for the reference); ``payments`` need ``_pos``.
    """
    named = F.coalesce(F.col("order_discounts").contains(mark), F.lit(False)) | F.coalesce(F.col("discounts").contains(mark), F.lit(False))
    whole = lines.filter(named & (F.col("order_payment_state") == "Paid"))
    paid = semi(payments.filter(F.col("result") == "SUCCESS"), whole, "order_id")
    paid = paid.withColumn("__part", F.concat(F.col("tender"), F.lit(":$"), F.col("amount").cast("string")))
    tender = join_text(paid, ["order_id"], {"__part": "tender"}, "|", "_pos", block_rows)
    total = paid.groupBy("order_id").agg(F.sum("amount").alias("amount"), F.min_by("customer_name", "_pos").alias("customer_name"))
    per_order = lookup(total, tender, "order_id", ["tender"], unique="grouped")
    known = first_per_key(wholesalers.filter(not_blank("email")), "email", source_order(wholesalers))
    names = lookup(contacts, known, {"email_address": "email"}, {"company_name": "__company", "phone": "__phone"}, unique="grouped", flag="__known")
    per_order = lookup(per_order, names, {"customer_name": "name"}, {"__known": "__known", "__company": "company_name"}, unique=True)
    per_order = per_order.withColumn("company_name", F.when(F.col("__known"), F.col("company_name")).otherwise(F.col("customer_name")))
    refs = first_per_key(orders.select("order_id", "ref_id"), "order_id", "ref_id")
    per_order = lookup(per_order, refs, "order_id", ["ref_id"], unique="grouped")
    rows = whole.withColumns({
        "order_date": F.date_format(parse_date("line_item_date", "dd-MMM-yyyy"), "MM/dd/yyyy"),
        "__discount": F.coalesce("total_discount", F.lit(0)) + F.coalesce("order_discount_proportion", F.lit(0)),
    })
    # of what lines of one item say beside their sums, the first line in file order speaks
    summed = rows.groupBy("order_date", "order_id", "item_sku").agg(
        F.count(F.lit(1)).alias("quantity"), F.sum("item_total").alias("rate"),
        zero_to_null(F.sum("__discount")).alias("coupon_discount"), F.sum("tax_amount").alias("tax_amount"),
        F.min_by(coupon_code("order_discounts", "discounts"), "_pos").alias("coupon_code"),
        F.min_by(F.when(F.col("item_tax_rate").isNotNull(), rate_tax_code(F.col("item_tax_rate"))), "_pos").alias("tax_code"))
    summed = lookup(summed, per_order, "order_id", ["ref_id", "tender", "amount", "company_name", "customer_name"], unique="grouped")
    # a contact's text grows with the customers of a name: last, so that no exchange carries it with the lines
    phone = F.when(F.col("__known"), F.col("__phone")).otherwise(F.col("phone_number"))
    texts = names.select("name", phone.alias("recipient_phone"), F.col("email_address").alias("recipient_email"))
    lines_out = lookup(summed, texts, {"customer_name": "name"}, ["recipient_phone", "recipient_email"], unique=True)
    lines_out = lines_out.withColumns({"warehouse": F.lit(store.warehouse), "price_level": F.lit(PRICE_LEVEL), "customer": F.lit(store.customer),
                                       "shipping_carrier": F.lit(""), "shipping_method": F.lit(""), "shipping_cost": F.lit(0)})
    lines_out = lines_out.select(*STORE_WHOLESALE_HEADERS, "tender")
    orders_out = summed.groupBy("order_date", "ref_id", "order_id", "tender", "amount", "company_name").agg(
        F.sum(F.coalesce("coupon_discount", F.lit(0))).alias("discount"), F.sum("tax_amount").alias("tax"))
    months_out = orders_out.groupBy(F.substring("order_date", 1, 2).alias("month")).agg(
        F.sum("discount").alias("discount"), F.sum("tax").alias("tax"), F.sum("amount").alias("amount"))
    return lines_out, orders_out, months_out
