"""Fixed values of the order-cleaning rules.

Everything in this module is data: word lists, lookup tables, patterns, key names and
messages that decide results and therefore must have exactly these values.
"""

# --- fixed values: digits and whitespace -------------------------------------------------

ARABIC_DIGITS = "٠١٢٣٤٥٦٧٨٩"
LATIN_DIGITS = "0123456789"

# Unicode whitespace stripped from both ends of every text field.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# --- fixed values: prices and currencies --------------------------------------------------

PRICE_WORDS = {
    "الف": 1000, "ألف": 1000,
    "الفان": 2000, "ألفان": 2000, "ألفين": 2000, "الفين": 2000,
    "ثلاثة آلاف": 3000, "ثلاثة الاف": 3000,
    "اربعة آلاف": 4000, "أربعة آلاف": 4000, "اربعة الاف": 4000,
    "خمسة آلاف": 5000, "خمسة الاف": 5000,
    "ستة آلاف": 6000, "ستة الاف": 6000,
    "سبعة آلاف": 7000, "سبعة الاف": 7000,
    "ثمانية آلاف": 8000, "ثمانية الاف": 8000,
    "تسعة آلاف": 9000, "تسعة الاف": 9000,
    "عشرة آلاف": 10000, "عشرة الاف": 10000,
    "مئة": 100, "مية": 100,
    "الفين وخمسمئة": 2500,
}

CURRENCY_SYNONYMS = {
    "لاير": "YER", "ريال": "YER", "ريال يمني": "YER", "لاير يمني": "YER",
    "yer": "YER", "yr": "YER",
    "دولار": "USD", "usd": "USD", "$": "USD",
    "سعودي": "SAR", "ريال سعودي": "SAR", "sar": "SAR",
}

ISO_CURRENCIES = ["YER", "USD", "SAR", "EUR"]

CURRENCY_TOKEN_PATTERN = r"(لاير|ريال|دولار|usd|yer|sar|\$)"

# No status is translated; spelling variants of one canonical value would be listed here.
STATUS_SYNONYMS: dict[str, str] = {}

# --- fixed values: patterns ---------------------------------------------------------------

EMAIL_PATTERN = r"^[^@\s]+@[^@\s]+\.[^@\s]+$"
ISO_DATE_TIME_PATTERN = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2})?(\.\d+)?)?$"
NUMBER_PATTERN = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"

FIRST_PLAUSIBLE_YEAR = 2000
LAST_PLAUSIBLE_YEAR = 2100

# Stated and recomputed totals may differ by this much before the stated one is replaced.
TOTAL_TOLERANCE = "0.01"

# --- fixed values: names ------------------------------------------------------------------

# Logical field -> physical CSV column.
COLUMN_MAP = {
    "order_id": "order_id",
    "order_date": "order_date",
    "status": "status",
    "customer_id": "customer_id",
    "customer_name": "customer_name",
    "customer_phone": "customer_phone",
    "customer_email": "customer_email",
    "city": "city",
    "district": "district",
    "delivery_type": "delivery_type",
    "delivery_fee": "delivery_cost",
    "payment_method": "payment_method",
    "payment_status": "payment_status",
    "payment_amount": "payment_amount",
    "currency": "currency",
    "total_amount": "total_amount",
    "items": "items_json",
}

ITEM_QUANTITY_KEYS = ["quantity", "qty", "count", "amount_units"]
ITEM_UNIT_PRICE_KEYS = ["unit_price", "price", "item_price", "price_per_unit"]
ITEM_PRODUCT_KEYS = ["product_id", "product_name", "product", "sku", "item_name", "name"]
UNKNOWN_PRODUCT = "UNKNOWN"
UNKNOWN_CITY = "غير محدد"

# --- fixed values: error codes and their messages -----------------------------------------

QUARANTINE_REASONS = {
    "ID_ORDER_MISSING": "معرف الطلب مفقود ولا يمكن استنتاجه.",
    "ID_CUSTOMER_MISSING": "معرف العميل مفقود.",
    "DATE_IMPOSSIBLE_INVALID": "تاريخ غير منطقي أو مستحيل.",
    "JSON_ITEMS_CORRUPTED": "JSON ناقص أو غير قابل للتحليل.",
    "ITEMS_EMPTY": "لا توجد عناصر للطلب.",
    "PRICE_UNKNOWN": "السعر الأصلي غير موجود أو غير قابل للاستنتاج.",
    "VALUE_NEGATIVE_AMBIGUOUS": "كمية أو مبلغ سالب لا يمكن تحديد معناه.",
    "ID_ORDER_DUPLICATE": "تكرار يحتاج سياسة دمج أو مراجعة.",
    "ERRORS_CONFLICTING_MULTIPLE": "عدة أخطاء جوهرية تمنع التصحيح الآمن.",
}
MULTIPLE_ERRORS = "ERRORS_CONFLICTING_MULTIPLE"
MULTIPLE_ERRORS_PREFIX = "أخطاء جوهرية متعددة: "
DUPLICATE_ERROR = "ID_ORDER_DUPLICATE"

# --- fixed values: defaults of lookups and jobs -------------------------------------------

DEFAULT_STATUS = "مؤكد"
DEFAULT_MIN_AMOUNT = 1000
SAMPLE_ROWS = 100_000
SPLIT_ROWS = 500_000
REFRESH_INTERVAL = "15 minutes"
REPORT_INTERVAL = "6 hours"
