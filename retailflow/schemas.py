"""Fixed schemas of the source tables (columns the jobs read) and header spellings of the exports."""

from __future__ import annotations

from pyspark.sql import types as T

# name: DDL.  Money is decimal(12,2); text money and text dates are parsed by the jobs.
_DDL = {
    "erp_item": "name string, inventory_warehouse string, warehouse_available int, warehouse_on_hand int, "
                "item_category_sku string, item_print_sku string, item_size string, item_sku_seasons string",
    "web_product": "id bigint, sku string, name string, regular_price decimal(12,2), sale_price decimal(12,2), "
                   "sale_starts timestamp, sale_ends timestamp, tax_class string, published int, stock int, weight_g int",
    "sku_master": "msku string, adjust_sku string, msku_status string, seasons string, seasons_sku string, "
                  "category_sku string, print_sku string, print_name string, print_chinese string, size string, "
                  "upc_active string, item_name string, fba_flag string, fbasku_us string, fbasku_de string",
    "pos_item": "clover_id string, name string, alternate_name string, price decimal(12,2), price_type string, "
                "tax_rates string, product_code string, sku string, quantity int",
    "pos_category": "category_id string, category_name string",
    "clearance_rule": "item string, sales decimal(12,2), _pos bigint",
    "market_product": "spu string, sku string, inventory int, price decimal(12,2), compare_at_price decimal(12,2), "
                      "tags string, product_name string, description string",
    "product_description": "spu string, cat string, product_name string, description string, categories string, "
                           "option1_name string, image_src string",
    "tpl_inventory": "sku string, current_atp int",
    "dimension_log": "category string, size string, length_in double, width_in double, height_in double, "
                     "weight_lb double, sample_weight_g double",
    "recount_sheet": "sku string, quantity int, new_qty string, counter string",
    "pos_line": "order_id string, line_item_date string, item_name string, item_sku string, item_total decimal(12,2), "
                "total_discount decimal(12,2), order_discount_proportion decimal(12,2), order_discounts string, "
                "discounts string, item_tax_rate double, tax_amount decimal(12,2), order_payment_state string, "
                "refunded string, exchanged string, order_employee_name string",
    "pos_payment": "order_id string, payment_id string, payment_date string, customer_name string, tender string, "
                   "amount decimal(12,2), tax_amount decimal(12,2), refund_amount decimal(12,2), result string, "
                   "order_employee_name string",
    "pos_refund": "refund_id string, refund_date string, refund_amount decimal(12,2)",
    "pos_customer": "first_name string, last_name string, phone_number string, email_address string",
    "pos2_item_line": "date string, transaction_id string, payment_id string, item string, qty double, count int, "
                      "discounts string, net_sales string, tax string, location string, customer_id string, "
                      "customer_name string",
    "pos2_payment": "payment_id string, cash string, event_type string, total_collected string, customer_id string",
    "pos2_customer": "customer_id string, first_name string, last_name string, email string, phone string, "
                     "address1 string, address2 string, city string, state string, zip string",
    "market_order": "order_no string, financial_status string, created_at string, lineitem_sku string, "
                    "lineitem_quantity int, lineitem_unit_price decimal(12,2), lineitem_total decimal(12,2), "
                    "lineitem_total_discount decimal(12,2), promotion_detail string, shipping decimal(12,2), "
                    "total decimal(12,2), payment_method string, delivery_method string, pickup_person_name string, "
                    "shipping_first_name string, shipping_last_name string, shipping_address1 string, "
                    "shipping_address2 string, shipping_city string, shipping_province string, shipping_country string, "
                    "shipping_zip string, phone string, email string",
    "return_record": "return_item_sku string, return_qty int, exchange_qty int, original_order_id string, "
                     "order_channel string, return_reason string, notes string, ns_action string",
    "web_order": "order_number string, order_date string, order_status string, order_total decimal(12,2), "
                 "country_code string, state_code string, postcode string, sku string, quantity int, "
                 "customer_email string, shipping_zone string",
    "web_customer": "email string, city string, region string, postal_code string",
    "points_file": "email string, points int",
    "tpl_order": "order_code string, extra_note_1 string, shipment_order_date string, sku string, total_quantity int, "
                 "shipping_service string, billing_state string, status string",
    "inventory_week": "adjust_msku string, inv_total_end_wk int, inv_warehouse int, inv_amz_usa int, inv_amz_ca int, "
                      "source_sheet string",
    "sales_month": "sales_channel string, adjust_msku string, cat_sku string, month int, qty double",
    "month_ratio": "category string, month int, ratio double",
    "discount_grid": "time_band string, missing_band string, discount double",
    "po_line": "ref_no string, item string, document_number string, warehouse string, status string, quantity double, "
               "quantity_fulfilled_received double, quantity_on_shipments double",
    "po_request": "po string, category string, vendor string, memo string, sku string, name_en string, name_cn string, "
                  "total_qty int, qty_ca int, qty_uk int, qty_de int, qty_au int, qty_jp int, qty_cn int, "
                  "qty_wholesale int, ship_date string",
    "season_start": "category string, arrival_date string",
    "packing_line": "sheet int, sheet_name string, ctn_no string, ctn_start int, ctn_end int, po string, sku string, "
                    "season string, qty_shipped double, qty_per_box double, unit_weight string, "
                    "gross_weight_per_ctn double",
    "packing_summary": "qty int, number_of_box int",
    "unit_weight_manual": "category string, size string, unit_weight double",
    "shipment_manifest": "merchant_sku string, quantity int",
    "amz_transaction": "type string, sku string, quantity int, order_state string",
    "census": "fsa string, occupied_dwellings string",
    "postal_prefix": "fsa string, province string, in_region boolean",
}


def schema(name: str) -> T.StructType:
    return T.StructType.fromDDL(_DDL[name])


# Header spellings of the upload files.
SALES_ORDER_HEADERS = {
    "payment_option": "Payment Option", "class": "Class", "order_date": "Order date", "ref_id": "REF ID",
    "order_type": "Order Type", "department": "Department", "warehouse": "Warehouse", "memo": "MEMO",
    "order_id": "Order ID", "item_sku": "Item SKU", "quantity": "Quantity", "price_level": "Price level",
    "rate": "Rate", "coupon_discount": "Coupon Discount", "coupon_code": "Coupon Code", "tax_code": "Tax Code",
    "tax_amount": "Tax Amount", "customer": "Customer", "recipient": "Recipient",
    "recipient_phone": "Recipient Phone", "recipient_email": "Recipient Email",
    "shipping_carrier": "SHIPPING CARRIER", "shipping_method": "SHIPPING METHOD", "shipping_cost": "SHIPPING COST",
}
MARKET_ORDER_HEADERS = {
    "customer_id": "Customer ID", "order_type_code": "Order Type Code", "order_id": "Order ID", "ref_number": "Ref Number", "date": "Date",
    "order_date": "Order Date", "sales_effective_date": "Sales Effective Date", "ship_by_date": "Ship By Date",
    "price_level": "Price Level", "sku": "SKU", "unit_price": "Unit Price", "qty": "QTY", "amount": "Amount", "tax_code": "Tax Code",
    "coupon_discount": "Coupon_Discount", "order_coupon_code": "Order Coupon Code", "shipping_cost": "Shipping cost",
    "shipping_tax_code": "Shipping Tax Code", "order_total": "Woocommerce Order Total", "shipping_method": "Marketplace Shipping Method",
    "commit": "Commit", "marketplace_payment_method": "Marketplace PAYMENT METHOD", "payment_option": "Payment Option", "terms": "Terms",
    "to_be_emailed": "To Be Emailed", "shipping_name": "Shipping Name", "shipping_address1": "Shipping Address1",
    "shipping_city": "Shipping City", "shipping_province": "Shipping Province", "shipping_country": "Shipping Country",
    "shipping_postal_code": "Shipping Postal Code", "billing_name": "Billing Name", "billing_address1": "Billing Address1",
    "billing_city": "Billing City", "billing_province": "Billing Province", "billing_country": "Billing Country",
    "billing_postal_code": "Billing Postal Code", "department": "Department", "class": "Class", "warehouse": "Warehouse",
    "recipient": "Recipient", "recipient_email": "Recipient Email", "recipient_phone": "Recipient Phone", "carrier": "Shipstation Carrier",
    "shipping_service": "Shipstation Shipping Service", "service": "SHIPSTATION SERVICE", "order_issue": "Order Issue", "memo": "Memo",
}
STORE_WHOLESALE_HEADERS = {
    "order_date": "Order date", "ref_id": "REF ID", "warehouse": "Warehouse", "order_id": "Order ID", "item_sku": "Item SKU",
    "quantity": "Quantity", "price_level": "Price level", "rate": "Rate", "coupon_discount": "Coupon Discount",
    "coupon_code": "Coupon Code", "tax_code": "Tax Code", "tax_amount": "Tax Amount", "amount": "Amount", "customer": "Customer",
    "company_name": "Company Name", "recipient_phone": "Recipient Phone", "recipient_email": "Recipient Email",
    "shipping_carrier": "SHIPPING CARRIER", "shipping_method": "SHIPPING METHOD", "shipping_cost": "SHIPPING COST",
}
SHIPMENT_HEADERS = {
    "ref_no": "REF NO", "expected_shipping_date": "EXPECTED SHIPPING DATE", "expected_delivery_date": "EXPECTED DELIVERY DATE",
    "memo": "MEMO", "po_ref": "PO REF NO", "box_no": "BOX NO", "item": "ITEM", "quantity": "QUANTITY", "location": "LOCATION",
    "document": "PO", "amz_shipment_id": "AMZ Shipment ID",
}
STATUS_LOG_HEADERS = {
    "date": "Date", "order_id": "Order ID", "shipped_from": "Shipped from eShipper", "province": "Province", "total_qty": "Total Qty",
    "shipped_qty": "eShipper Qty", "auto_fr": "Auto FR", "shipping_required": "Shipping Required", "fr_created": "FR Created",
    "status": "eShipper Status", "items": "Items",
}
ADJUSTMENT_HEADERS = {
    "date": "Date", "item": "ITEM", "adjust_qty_by": "ADJUST QTY. BY", "reason_code": "Reason Code",
    "status": "Status", "memo": "MEMO", "warehouse": "WAREHOUSE", "external_id": "External ID",
}
TRANSFER_HEADERS = {
    "date": "Date", "to_type": "TO TYPE", "season": "SEASON", "from_warehouse": "FROM WAREHOUSE",
    "to_warehouse": "TO WAREHOUSE", "ref_no": "REF NO", "memo": "Memo", "order_placed_by": "ORDER PLACED BY",
    "item": "ITEM", "quantity": "Quantity",
}
PURCHASE_ORDER_HEADERS = {
    "po_type": "PO TYPE", "category": "CATEGORY", "season": "SEASON", "ref_no": "REF NO", "warehouse": "WAREHOUSE",
    "vendor": "VENDOR", "currency": "CURRENCY", "order_date": "ORDER DATE", "order_placed_by": "ORDER PLACED BY",
    "approval_status": "APPROVAL STATUS", "due_date": "DUE DATE", "memo": "MEMO", "item": "ITEM",
    "quantity": "QUANTITY", "tax_code": "Tax Code", "external_id": "External ID",
}
