"""Results depend on exactly these lists, labels and prices.  Jobs take them as defaults."""

# Categories that carry the second sales tax.
TAXABLE_CATEGORIES = (
    "AAA", "ACA", "ACB", "AHJ", "AJA", "AJC", "AJM", "AJP", "AJR", "AJS", "ALF", "ALC", "AWWJ", "DRC",
    "XBK", "XBM", "XBY", "XLB", "XPC", "GUX", "GUA", "GUB", "GBX", "GHA", "GHX",
)

# Prices of categories that are not in the web catalog.
CONSTANT_CATEGORY_PRICES = (
    ("MISC5", 5), ("MISC10", 10), ("MISC15", 15), ("MISC20", 20), ("MISC25", 25), ("MISC30", 30), ("MISC35", 35),
    ("MISC45", 45), ("DBRC", 30), ("DBTB", 35), ("DBTL", 40), ("DBTP", 40), ("DLBS", 25), ("DWJA", 50),
    ("DWJT", 40), ("DWPF", 30), ("DWPS", 25), ("DWSF", 60), ("DWSS", 55), ("DXBK", 30), ("MAJC", 99.99),
)

# Canadian provinces by sales tax.
HST_ONLY_PROVINCES = ("NB", "NL")
HST_PROVINCES = ("NS", "ON", "PE")
GST_ONLY_PROVINCES = ("AB", "NT", "NU", "YT")
EAST_PROVINCES = ("MB", "ON", "QC", "NB", "NS", "NL", "PE")

# Province names as marketplaces write them.
PROVINCE_CODES = {
    "ALBERTA": "AB", "BRITISH COLUMBIA": "BC", "COLOMBIE-BRITANNIQUE": "BC", "MANITOBA": "MB",
    "NEW BRUNSWICK": "NB", "NOUVEAU-BRUNSWICK": "NB", "NEWFOUNDLAND": "NL", "NEWFOUNDLAND AND LABRADOR": "NL",
    "NORTHWEST TERRITORIES": "NT", "NOVA SCOTIA": "NS", "NUNAVUT": "NU", "ONTARIO": "ON", "TORONTO": "ON",
    "PRINCE EDWARD ISLAND": "PE", "QUEBEC": "QC", "QUÉBEC": "QC", "QU": "QC", "CANADA / QUEBEC": "QC",
    "SASKATCHEWAN": "SK", "YUKON": "YT",
}

# Country and province names marketplaces write beside the codes, replaced in this order.
MARKET_COUNTRIES = (("美国", "US"), ("加拿大", "CA"))
MARKET_PROVINCES = (("不列颠哥伦比亚", "BC"),)
MARKET_HOME = "中国"

# Line for sales of items the ERP does not know.
MISC_ITEM = "MISC-ITEM"

# Channel column values that are no channel.
CHANNEL_MARKERS = ("Summary", "Sales Channel", "All Marketplaces")

# Months of the two seasons.
SUMMER_MONTHS = (3, 4, 5, 6, 7, 8)
WINTER_MONTHS = (9, 10, 11, 12, 1, 2)

# Rank bands of the holiday sale: last rank, discount.
HOLIDAY_BANDS = ((54, 0.4), (101, 0.3), (250, 0.2), (500, 0.1))

# Regions of a factory order: quantity column -> region.
ORDER_REGIONS = {"qty_ca": "CA", "qty_uk": "UK", "qty_de": "DE", "qty_au": "AU", "qty_jp": "JP", "qty_cn": "CN"}
LEDGER_REGIONS = {"qty_ca": "CA/US", "qty_uk": "UK", "qty_de": "DE", "qty_cn": "CN", "qty_wholesale": "Wholesaler"}

# Texts the receiving systems expect.
PAY_CASH = "Cash"
PAY_WALLET = "AlphaPay"
PAY_POS = "Clover"
PAY_POS2 = "Square"
PAY_CARD_ONLINE = "Stripe CAD Allvalue"
CLASS_HOME = "FBM : CA"
CLASS_MARKET = "FBM : CN"
PRICE_LEVEL = "Custom"
MARKET_CARRIER = "Longxing"
TAX_FEDERAL = "CA-BC-GST"
TAX_FULL = "CA-BC-TAX"
TAX_ABROAD = "."
TAX_ZERO = "CA-Zero"
POS_TAX = "GST"
POS_TAX_FULL = "GST+PST"
SHIP_FREE = "Free shipping over $69"
SHIP_PAID = "Parcel with Tracking"
SHIP_STANDARD = "Standard"
CARRIER_HOME = ("Canada Post", "Expedited Parcel")
CARRIER_US = ("USPS", "USPS Priority Mail")
REASON_RETURN = "RT"
REASON_EXCHANGE = "EXC"
REASON_COUNT = "CC"
WALK_IN = "Walk-in"
WALK_IN_NOTE = "Walk in customer-Picked"
TERMS = "CIA"
COMMIT_AVAILABLE = "Available QTY"
LOG_WHOLE = "Whole"
LOG_YES = "Y"
PO_REGULAR = "Regular"
PO_OVER = "Over Received"
PO_UNIFORM = "Daycare Uniforms"
PO_MIXED = "MIX"
PO_VENDOR = "China"
PO_CURRENCY = "CAD"
PO_APPROVED = "APPROVED"
STATUS_SYNCED = "Synced"
STATUS_SHIPPED = "Shipped"

# Wholesale marketplace: sales rep label and country labels of its orders.
WHOLESALE_MARKET = "Faire"
WHOLESALE_MARKET_COUNTRIES = {"United States": "US-Faire", "Canada": "CA"}
