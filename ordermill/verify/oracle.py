"""The registered queries restated in SQL.

Common table expressions build up in the order of the pipeline: ``dirty`` (the derived order
records), ``ruled`` (every rule), ``classified`` (with duplicates and the verdict), ``accepted``
and ``validated`` (last row per order). A query's SQL takes the prefix it needs.
"""

from __future__ import annotations

from ordermill import constants as C

WS = "e'" + "".join(
    {"\t": "\\t", "\n": "\\n", "\r": "\\r"}.get(c, f"\\x{ord(c):02x}" if ord(c) < 0x20 else c)
    for c in C.WHITESPACE
) + "'"


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def lookup(table: dict[str, object], key: str) -> str:
    cases = " ".join(f"WHEN {q(k)} THEN {q(str(v))}" for k, v in table.items())
    return f"CASE {key} {cases} END"


def arabic(x: str) -> str:
    return f"translate({x}, '{C.LATIN_DIGITS}', '{C.ARABIC_DIGITS}')"


def latin(x: str) -> str:
    return f"translate({x}, '{C.ARABIC_DIGITS}', '{C.LATIN_DIGITS}')"


def clean(x: str) -> str:
    return f"trim(coalesce({x}, ''), {WS})"


def strip(x: str) -> str:
    return f"trim({x}, {WS})"


def number(x: str) -> str:
    value = f"try_cast({strip(x)} AS DOUBLE)"
    return (
        f"CASE WHEN regexp_matches({strip(x)}, '{C.NUMBER_PATTERN}') AND isfinite({value}) "
        f"THEN {value} END"
    )


def money(x: str) -> str:
    return f"try_cast({x} AS DECIMAL(38,2))"


# --- the derived order records --------------------------------------------------------------

_PLAIN_PRICE = (
    "regexp_replace(regexp_replace(cast(cast(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR), "
    "'0+$', ''), '\\.$', '')"
)

_DERIVED = f"""
lines AS (
  SELECT l_orderkey, l_linenumber, 'P' || l_partkey AS product,
         cast(l_quantity AS BIGINT) AS qty, cast(l_extendedprice AS DECIMAL(18,2)) AS price,
         CASE l_orderkey % 3
           WHEN 0 THEN '{{"product_id":"P' || l_partkey || '","quantity":' || cast(l_quantity AS BIGINT)
                       || ',"unit_price":' || cast(l_extendedprice AS DECIMAL(18,2)) || '}}'
           WHEN 1 THEN '{{"sku":"P' || l_partkey || '","qty":' || cast(l_quantity AS BIGINT)
                       || ',"price":' || cast(l_extendedprice AS DECIMAL(18,2)) || '}}'
           ELSE '{{"name":"P' || l_partkey || '","count":' || cast(l_quantity AS BIGINT)
                       || ',"item_price":' || cast(l_extendedprice AS DECIMAL(18,2)) || '}}'
         END AS item,
         CASE l_orderkey % 3
           WHEN 0 THEN '{{"product_id":"P' || l_partkey || '","quantity":' || cast(l_quantity AS BIGINT)
                       || ',"unit_price":' || {_PLAIN_PRICE} || '}}'
           WHEN 1 THEN '{{"price":' || {_PLAIN_PRICE} || ',"qty":' || cast(l_quantity AS BIGINT)
                       || ',"sku":"P' || l_partkey || '"}}'
           ELSE '{{"count":' || cast(l_quantity AS BIGINT) || ',"item_price":' || {_PLAIN_PRICE}
                       || ',"name":"P' || l_partkey || '"}}'
         END AS canonical
  FROM lineitem
),
order_items AS (
  SELECT l_orderkey, list(item ORDER BY l_linenumber, item) AS items,
         list(canonical ORDER BY l_linenumber, item) AS canonicals, sum(qty * price) AS lines_total
  FROM lines GROUP BY l_orderkey
),
base AS (
  SELECT o_orderkey AS k, o_custkey, o_orderstatus, o_orderpriority, c_name, n_name, r_name,
         coalesce(items, []) AS items, coalesce(canonicals, []) AS canonicals,
         cast(o_orderdate + INTERVAL 10 YEARS AS DATE) AS od,
         cast(coalesce(lines_total, 0) + 10 AS DECIMAL(18,2)) AS total,
         cast(cast(coalesce(lines_total, 0) + 10 AS DECIMAL(18,2)) AS VARCHAR) AS ts
  FROM orders
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
  LEFT JOIN order_items ON l_orderkey = o_orderkey
),
"""

_ALL_AT_ONCE = "deliveries AS (SELECT 1 AS run, * FROM base),"

_TWO_DELIVERIES = """deliveries AS (
  SELECT 1 AS run, * FROM base WHERE od < DATE '2008-01-01'
  UNION ALL
  SELECT 2 AS run, * REPLACE (
    CASE o_orderstatus WHEN 'O' THEN od + 1 ELSE od END AS od,
    CASE o_orderstatus WHEN 'P' THEN items[2:] ELSE items END AS items,
    CASE o_orderstatus WHEN 'P' THEN canonicals[2:] ELSE canonicals END AS canonicals)
  FROM base
),"""

_FAULTS = f"""
copies AS (
  SELECT *, 1 AS copy_no FROM deliveries UNION ALL SELECT *, 2 AS copy_no FROM deliveries WHERE k % 41 = 0
),
dirty AS (
  SELECT run, k, copy_no,
    CASE WHEN k % 97 = 0 THEN '' ELSE 'ORD' || k END AS order_id,
    CASE WHEN k % 67 = 0 THEN '2025-13-45'
         WHEN k % 11 = 0 THEN strftime(od, '%Y/%m/%d')
         WHEN k % 11 = 1 THEN strftime(od, '%d-%m-%Y')
         WHEN k % 11 = 2 THEN {arabic("strftime(od, '%Y-%m-%d')")}
         WHEN k % 11 = 3 THEN strftime(od, '%Y-%m-%dT%H:%M:%S')
         WHEN k % 11 = 4 THEN strftime(od, '%Y%m%d')
         WHEN k % 11 = 5 THEN strftime(od, '%G-W%V-%u')
         ELSE strftime(od, '%Y-%m-%d') END AS order_date,
    CASE o_orderstatus WHEN 'P' THEN 'مؤكد' WHEN 'F' THEN 'تم التسليم' ELSE ' قيد الشحن ' END AS status,
    CASE WHEN k % 89 = 0 THEN '' ELSE 'CUST' || o_custkey
         || CASE WHEN copy_no = 2 AND k % 82 = 0 THEN 'X' ELSE '' END END AS customer_id,
    c_name AS customer_name,
    CASE WHEN k % 7 = 0 THEN '967+ 77 ' ELSE '+96777' END || (1000000 + k) AS customer_phone,
    'u' || k || CASE WHEN k % 6 = 0 THEN '@@mail..com' ELSE '@mail.com' END AS customer_email,
    CASE WHEN n_name = 'NATION_0' THEN '' ELSE n_name END AS city,
    r_name AS district,
    'standard' AS delivery_type,
    '10' AS delivery_cost,
    o_orderpriority AS payment_method,
    o_orderstatus AS payment_status,
    ts AS payment_amount,
    CASE k % 5 WHEN 0 THEN 'لاير يمني' WHEN 1 THEN 'YER' WHEN 2 THEN 'usd' WHEN 3 THEN 'ريال سعودي'
               ELSE 'EUR' END AS currency,
    CASE WHEN k % 73 = 0 THEN 'unknown'
         WHEN k % 71 = 0 THEN '-5'
         WHEN k % 13 = 0 THEN {arabic("ts")} || ' لاير'
         WHEN k % 13 = 1 THEN ts[1] || ',' || ts[2:]
         WHEN k % 13 = 2 THEN 'خمسة آلاف'
         WHEN k % 13 = 3 THEN cast(cast(total + 100 AS DECIMAL(18,2)) AS VARCHAR)
         ELSE ts END AS total_amount,
    CASE WHEN k % 61 = 0 THEN '{{broken' ELSE '[' || array_to_string(items, ',') || ']' END AS items_json,
    '[' || array_to_string(canonicals, ',') || ']' AS items_canonical
  FROM copies
)"""

DIRTY = _DERIVED + _ALL_AT_ONCE + _FAULTS
DIRTY_TWICE = _DERIVED + _TWO_DELIVERIES + _FAULTS

# --- the rules ------------------------------------------------------------------------------

_ISO = C.ISO_DATE_TIME_PATTERN


def _shape(text: str, first: bool, separators: str) -> str:
    parts = [
        rf"^\d{{4}}[{s}]\d{{1,2}}[{s}]\d{{1,2}}$" if first else rf"^\d{{1,2}}[{s}]\d{{1,2}}[{s}]\d{{4}}$"
        for s in separators
    ]
    return "(" + " OR ".join(f"regexp_matches({text}, '{p}')" for p in parts) + ")"


def _first_filled(keys: list[str]) -> str:
    return "coalesce(" + ", ".join(f"nullif(json_extract_string(item, '$.{k}'), '')" for k in keys) + ")"


def _first_present(keys: list[str]) -> str:
    return "coalesce(" + ", ".join(f"json_extract_string(item, '$.{k}')" for k in keys) + ")"


def _item_number(x: str) -> str:
    text = latin(clean(x))
    return f"CASE {text} WHEN 'true' THEN 1.0 WHEN 'false' THEN 0.0 ELSE {number(text)} END"


_DASHED = "regexp_replace(date_digits, '[/.]', '-', 'g')"
_NO_Z = "replace(date_digits, 'Z', '')"

RULES = f""",
stripped AS (
  SELECT *,
    {clean("order_id")} AS t_order_id, {clean("customer_id")} AS t_customer_id,
    {clean("order_date")} AS t_date, {latin(clean("order_date"))} AS date_digits,
    {clean("total_amount")} AS p0, {clean("currency")} AS t_currency,
    {clean("customer_phone")} AS t_phone, {clean("customer_email")} AS t_email,
    {clean("status")} AS t_status, {clean("items_json")} AS t_items
  FROM dirty
),
price_words AS (
  SELECT *, {latin("p0")} AS p1,
    coalesce({lookup(C.PRICE_WORDS, latin("p0"))}, {latin("p0")}) AS p2
  FROM stripped
),
price_currency AS (
  SELECT *, {strip(f"regexp_replace(p2, '{C.CURRENCY_TOKEN_PATTERN}', '', 'gi')")} AS p3 FROM price_words
),
price_commas AS (
  SELECT *, CASE WHEN contains(p3, ',') AND regexp_matches({strip("replace(p3, ',', '')")}, '{C.NUMBER_PATTERN}')
                 THEN replace(p3, ',', '') ELSE p3 END AS p4
  FROM price_currency
),
priced AS (
  SELECT *, {money(number("p4"))} AS stated,
    list_filter([CASE WHEN p1 <> p0 THEN 'ARABIC_NUMERALS' END,
                 CASE WHEN p2 <> p1 THEN 'PRICE_IN_WORDS' END,
                 CASE WHEN p3 <> p2 THEN 'CURRENCY_TEXT_STRIPPED' END,
                 CASE WHEN p4 <> p3 THEN 'THOUSANDS_SEPARATOR' END], lambda x: x IS NOT NULL) AS stated_codes
  FROM price_commas
),
fixed AS (
  SELECT *,
    CASE WHEN t_currency = '' THEN NULL
         ELSE coalesce({lookup(C.CURRENCY_SYNONYMS, "lower(t_currency)")},
                       CASE WHEN upper(t_currency) IN ('YER', 'USD', 'SAR', 'EUR') THEN upper(t_currency) END,
                       t_currency) END AS c_currency,
    regexp_replace({latin("t_phone")}, '[^0-9+]', '', 'g') AS phone_kept,
    regexp_replace(regexp_replace(replace(t_email, ' ', ''), '@{{2,}}', '@', 'g'), '\\.{{2,}}', '.', 'g') AS c_email,
    CASE WHEN regexp_matches(date_digits, '{_ISO}') THEN date_digits[1:10]
         ELSE strftime(coalesce(
           CASE WHEN {_shape("date_digits", True, "-/.")} THEN try_strptime({_DASHED}, '%Y-%m-%d') END,
           CASE WHEN {_shape("date_digits", False, "-/.")} THEN try_strptime({_DASHED}, '%d-%m-%Y') END,
           CASE WHEN {_shape("date_digits", False, "-/")} THEN try_strptime({_DASHED}, '%m-%d-%Y') END,
           CASE WHEN regexp_matches({_NO_Z}, '^\\d{{4}}-\\d{{2}}-\\d{{2}}([T ].*)?$')
                THEN try_strptime({_NO_Z}[1:10], '%Y-%m-%d') END,
           CASE WHEN regexp_matches({_NO_Z}, '^\\d{{8}}$') THEN try_strptime({_NO_Z}, '%Y%m%d') END,
           CASE WHEN regexp_matches({_NO_Z}, '^\\d{{4}}-W\\d{{2}}-[1-7]$')
                THEN try_strptime({_NO_Z}, '%G-W%V-%u') END), '%Y-%m-%d') END AS c_date,
    CASE WHEN t_items = '' OR NOT json_valid(t_items) THEN 'JSON_ITEMS_CORRUPTED'
         WHEN json_type(t_items) <> 'ARRAY' THEN 'JSON_ITEMS_CORRUPTED'
         WHEN json_array_length(t_items) = 0 THEN 'ITEMS_EMPTY' END AS e_items
  FROM priced
),
good_items AS (SELECT run, k, copy_no, t_items FROM fixed WHERE e_items IS NULL),
item_rows AS (
  SELECT run, k, copy_no, unnest(from_json(t_items, '["json"]')) AS item,
         generate_subscripts(from_json(t_items, '["json"]'), 1) AS pos
  FROM good_items
),
item_lines AS (
  SELECT run, k, copy_no, pos,
    coalesce({_first_present(C.ITEM_PRODUCT_KEYS)}, 'UNKNOWN') AS product,
    CASE WHEN {_first_filled(C.ITEM_QUANTITY_KEYS)} IS NULL THEN 1.0
         ELSE {_item_number(_first_filled(C.ITEM_QUANTITY_KEYS))} END AS qty,
    {_item_number(_first_filled(C.ITEM_UNIT_PRICE_KEYS))} AS unit_price,
    json_type(item) = 'OBJECT' AS is_object
  FROM item_rows
),
computed_totals AS (
  SELECT run, k, copy_no,
    CASE WHEN bool_and(coalesce(is_object AND qty >= 0 AND unit_price >= 0, false))
         THEN sum(qty * unit_price) END AS lines_sum
  FROM item_lines GROUP BY run, k, copy_no
),
computed AS (
  SELECT f.*,
    CASE WHEN coalesce(delivery_cost, '') = '' THEN 0.0 ELSE {_item_number("delivery_cost")} END AS fee,
    lines_sum,
    CASE WHEN length(phone_kept) - length(replace(phone_kept, '+', '')) > 1
           OR (length(phone_kept) - length(replace(phone_kept, '+', '')) = 1 AND NOT starts_with(phone_kept, '+'))
         THEN '+' || replace(phone_kept, '+', '') ELSE phone_kept END AS c_phone,
    regexp_matches(c_email, '{C.EMAIL_PATTERN}') AS email_valid,
    coalesce(year(try_strptime(c_date, '%Y-%m-%d')) NOT BETWEEN {C.FIRST_PLAUSIBLE_YEAR}
             AND {C.LAST_PLAUSIBLE_YEAR}, true) AS bad_date
  FROM fixed f LEFT JOIN computed_totals USING (run, k, copy_no)
),
compared AS (
  SELECT *, CASE WHEN fee >= 0 THEN {money("lines_sum + fee")} END AS computed_total FROM computed
),
ruled AS (
  SELECT *,
    coalesce(e_items IS NULL AND abs(stated - computed_total) > {C.TOTAL_TOLERANCE}, false) AS recomputed,
    list_filter([
      CASE WHEN t_order_id = '' THEN 'ID_ORDER_MISSING' END,
      CASE WHEN t_customer_id = '' THEN 'ID_CUSTOMER_MISSING' END,
      CASE WHEN bad_date THEN 'DATE_IMPOSSIBLE_INVALID' END,
      e_items,
      CASE WHEN stated IS NULL AND e_items IS NOT NULL THEN 'PRICE_UNKNOWN'
           WHEN stated < 0 THEN 'VALUE_NEGATIVE_AMBIGUOUS' END], lambda x: x IS NOT NULL) AS errors,
    list_filter([
      CASE WHEN NOT bad_date AND (NOT regexp_matches(date_digits, '{_ISO}') OR date_digits <> t_date)
           THEN {{'f': 'order_date', 'o': t_date, 'c': c_date, 'r': 'DATE_NORMALIZED'}} END,
      CASE WHEN len(stated_codes) > 0 AND stated IS NOT NULL
           THEN {{'f': 'total_amount', 'o': p0, 'c': cast(stated AS VARCHAR),
                 'r': array_to_string(stated_codes, '+')}} END,
      CASE WHEN c_currency <> t_currency
           THEN {{'f': 'currency', 'o': t_currency, 'c': c_currency, 'r': 'CURRENCY_NORMALIZED'}} END,
      CASE WHEN t_phone <> '' AND c_phone <> t_phone
           THEN {{'f': 'customer_phone', 'o': t_phone, 'c': c_phone, 'r': 'PHONE_NORMALIZED'}} END,
      CASE WHEN t_email <> '' AND c_email <> t_email
           THEN {{'f': 'customer_email', 'o': t_email, 'c': c_email, 'r': 'EMAIL_REPEATED_SYMBOLS'}} END,
      CASE WHEN t_status <> '' AND t_status <> status
           THEN {{'f': 'status', 'o': t_status, 'c': t_status, 'r': 'STATUS_NORMALIZED'}} END,
      CASE WHEN e_items IS NULL AND abs(stated - computed_total) > {C.TOTAL_TOLERANCE}
           THEN {{'f': 'total_amount', 'o': cast(stated AS VARCHAR), 'c': cast(computed_total AS VARCHAR),
                 'r': 'TOTAL_RECOMPUTED_FROM_ITEMS'}} END], lambda x: x IS NOT NULL) AS corrections,
    CASE WHEN e_items IS NULL AND abs(stated - computed_total) > {C.TOTAL_TOLERANCE}
         THEN computed_total ELSE stated END AS final_total,
    nullif(t_order_id, '') AS id, nullif(t_customer_id, '') AS cust
  FROM compared
)"""

# --- duplicates, verdict, last row per order ------------------------------------------------

_REASONS = lookup(C.QUARANTINE_REASONS, "code")

VERDICTS = f""",
chained AS (
  SELECT *, lag({{'c': cust, 't': final_total}}) OVER (PARTITION BY run, id ORDER BY k, copy_no) AS before
  FROM ruled
),
flagged AS (
  SELECT *, CASE WHEN id IS NOT NULL AND before IS NOT NULL
                  AND before IS DISTINCT FROM {{'c': cust, 't': final_total}}
                 THEN list_append(errors, '{C.DUPLICATE_ERROR}') ELSE errors END AS codes
  FROM chained
),
verdicts AS (
  SELECT *, CASE WHEN len(codes) >= 2 THEN '{C.MULTIPLE_ERRORS}' WHEN len(codes) = 1 THEN codes[1] END AS code,
    CASE WHEN len(codes) > 0 THEN 'quarantined' WHEN len(corrections) > 0 THEN 'corrected'
         ELSE 'valid' END AS verdict
  FROM flagged
),
classified AS (
  SELECT *, CASE WHEN code = '{C.MULTIPLE_ERRORS}'
      THEN '{C.MULTIPLE_ERRORS_PREFIX}' || array_to_string(codes, ', ') || '. ' || {_REASONS}
      ELSE {_REASONS} END AS reason,
    array_to_string(list_transform(corrections,
      lambda x: concat_ws('|', x.f, x.o, x.c, x.r)), ';') AS corrections_text,
    array_to_string(codes, ',') AS codes_text
  FROM verdicts
)"""

CLEANED = """
    run, k, copy_no, id AS order_id, cust AS customer_id, nullif(customer_name, '') AS customer_name,
    CASE WHEN email_valid THEN c_email ELSE t_email END AS customer_email,
    CASE WHEN t_phone = '' THEN customer_phone ELSE c_phone END AS customer_phone,
    c_date AS order_date, items_canonical AS items, c_currency AS currency, delivery_cost AS delivery_fee,
    nullif(delivery_type, '') AS delivery_type, nullif(payment_method, '') AS payment_method,
    nullif(payment_status, '') AS payment_status, final_total AS total_amount,
    t_status AS status, nullif(city, '') AS city, nullif(district, '') AS district,
    verdict AS quality_status, corrections, corrections_text"""

LAST_ROWS = f""",
accepted AS (SELECT {CLEANED} FROM classified WHERE verdict <> 'quarantined'),
last_rows AS (
  SELECT * FROM accepted
  QUALIFY row_number() OVER (PARTITION BY run, order_id ORDER BY k DESC, copy_no DESC) = 1
)"""

BUSINESS = [
    "customer_id", "customer_name", "customer_email", "customer_phone", "order_date", "items",
    "currency", "delivery_fee", "delivery_type", "payment_method", "payment_status",
    "total_amount", "status", "city", "district", "quality_status", "corrections_text",
]

_SAME = " AND ".join(f"n.{c} IS NOT DISTINCT FROM o.{c}" for c in BUSINESS)

# The second run compared with the first, and the table after both.
_MERGED = f""",
compared_runs AS (
  SELECT n.*, CASE WHEN o.order_id IS NULL THEN 'inserted' WHEN {_SAME} THEN 'unchanged'
                   ELSE 'updated' END AS action
  FROM (SELECT * FROM last_rows WHERE run = 2) n
  LEFT JOIN (SELECT * FROM last_rows WHERE run = 1) o ON n.order_id = o.order_id
),
validated AS (
  SELECT * EXCLUDE (action), 'run-2' AS last_run_id,
         CASE action WHEN 'inserted' THEN 'run-2' ELSE 'run-1' END AS first_seen_run_id
  FROM compared_runs WHERE action <> 'unchanged'
  UNION ALL
  SELECT *, 'run-1', 'run-1' FROM last_rows
  WHERE run = 1 AND order_id NOT IN (SELECT order_id FROM compared_runs WHERE action <> 'unchanged')
)"""

CLASSIFIED = DIRTY + RULES + VERDICTS
VALIDATED = CLASSIFIED + LAST_ROWS + """,
validated AS (SELECT *, 'run-1' AS last_run_id, 'run-1' AS first_seen_run_id FROM last_rows)"""
MERGED = DIRTY_TWICE + RULES + VERDICTS + LAST_ROWS + _MERGED
# The table before the second run.
FIRST_RUN = DIRTY_TWICE + RULES + VERDICTS + LAST_ROWS + """,
validated AS (SELECT *, 'run-1' AS last_run_id, 'run-1' AS first_seen_run_id FROM last_rows WHERE run = 1)"""

# --- one statement per query ----------------------------------------------------------------

from ordermill.constants import COLUMN_MAP, UNKNOWN_CITY  # noqa: E402
from ordermill.schema import CLEANED_FIELDS, PHYSICAL_FIELDS  # noqa: E402


def _physical(value=lambda c: f"nullif({c}, '')") -> str:
    return ", ".join(f"{value(c)} AS {c}" for c in PHYSICAL_FIELDS)


def _logical(prefix: str = "") -> str:
    return ", ".join(f"nullif({prefix}{p}, '') AS {l}" for l, p in COLUMN_MAP.items())


_FLAT = ", ".join(
    "cast(total_amount AS DOUBLE) AS total_amount" if c == "total_amount" else c
    for c in CLEANED_FIELDS
) + ", quality_status, corrections_text AS corrections"

_TRACKED = _FLAT + ", {run1} AS last_run_id, {run2} AS first_seen_run_id"


def _average(total: str, n: str) -> str:
    cents = f"cast({total} * 100 AS HUGEINT)"
    return f"CASE WHEN {n} > 0 THEN cast((2 * {cents} + {n}) // (2 * {n}) AS DOUBLE) / 100.0 END"


def _percent(part: str, total: str, digits: int) -> str:
    scale = 10**digits
    a = f"cast({part} AS HUGEINT) * {200 * scale}"
    return f"cast(({a} + {total}) // (2 * {total}) AS DOUBLE) / {float(scale)}"


_LINES = """,
order_lines AS (
  SELECT l.product, cast(l.qty AS DECIMAL(38,6)) AS units,
         cast(l.qty * coalesce(l.unit_price, 0) AS DECIMAL(38,6)) AS revenue, v.order_id,
         cast(l.qty AS DOUBLE) AS qty, cast(l.unit_price AS DOUBLE) AS unit_price
  FROM validated v JOIN item_lines l ON v.run = l.run AND v.k = l.k AND v.copy_no = l.copy_no
)"""

_DAILY = f"""
SELECT order_date AS day, cast(coalesce(sum(total_amount), 0) AS DOUBLE) AS total_sales,
       count(*) AS orders_count, {_average("coalesce(sum(total_amount), 0)", "count(total_amount)")} AS avg_order_value
FROM validated GROUP BY order_date"""

_PRODUCTS = """
SELECT product, cast(round(sum(revenue), 2) AS DOUBLE) AS revenue, cast(sum(units) AS DOUBLE) AS units_sold,
       count(*) AS orders_count
FROM order_lines WHERE product <> '' GROUP BY product"""

_CITY = f"""
SELECT coalesce(city, '{UNKNOWN_CITY}') AS city, cast(coalesce(sum(total_amount), 0) AS DOUBLE) AS total_sales,
       count(*) AS orders_count, {_average("coalesce(sum(total_amount), 0)", "count(total_amount)")} AS avg_order_value
FROM validated GROUP BY validated.city
ORDER BY coalesce(sum(total_amount), 0) DESC, validated.city ASC NULLS FIRST LIMIT {{limit}}"""

_TOP_PRODUCTS = """
SELECT product, cast(round(sum(revenue), 2) AS DOUBLE) AS revenue, cast(sum(units) AS DOUBLE) AS units_sold,
       count(*) AS orders_count
FROM order_lines GROUP BY product ORDER BY round(sum(revenue), 2) DESC, product LIMIT 10"""

_STATUS = f"""
SELECT status, orders_count, {_percent("orders_count", "total", 2)} AS percentage
FROM (SELECT status, count(*) AS orders_count, sum(count(*)) OVER () AS total FROM validated GROUP BY status)"""

_LOOKUP_FILTERS = {
    "orders_by_status": ("status = 'مؤكد'", "order_date"),
    "orders_by_customer": ("customer_id = 'CUST7'", "order_date"),
    "high_value_orders_by_city": ("city = 'NATION_5' AND total_amount >= 1000", "total_amount"),
    "orders_by_payment": ("payment_method = '1-URGENT' AND payment_status = 'F'", "order_date"),
    "orders_needing_review": ("quality_status = 'corrected'", "last_run_id"),
}


def _lookup(name: str, columns: str) -> str:
    condition, order = _LOOKUP_FILTERS[name]
    return (
        f"SELECT {columns} FROM (SELECT * FROM validated WHERE {condition} "
        f"ORDER BY {order} DESC NULLS LAST, order_id LIMIT 10)"
    )


_CLUSTERED = " UNION ALL ".join(
    _lookup(name, f"'{name}' AS lookup, order_id, order_date, cast(total_amount AS DOUBLE) AS total_amount")
    for name in _LOOKUP_FILTERS if name != "orders_by_payment"
)

# The compared lookups and the columns that their layouts are sorted by.
_LAYOUTS = {
    "orders_by_status": "status,order_date",
    "orders_by_customer": "customer_id,order_date",
    "high_value_orders_by_city": "city,total_amount",
}
_EXPLAINED = " UNION ALL ".join(
    f"SELECT '{name}' AS query, '{layout}' AS layout, count(*) AS rows_matching, "
    f"least(count(*), 10) AS rows_returned, true AS in_no_more_files "
    f"FROM validated WHERE {_LOOKUP_FILTERS[name][0]}"
    for name, columns in _LAYOUTS.items() for layout in ("none", columns)
)

_ROLLED_BACK = """
FROM (SELECT * FROM validated WHERE last_run_id <> 'run-2')"""

_KEPT_ROWS = "FROM (SELECT * FROM validated WHERE last_run_id <> 'run-2') "

_COUNTS = """,
counts AS (
  SELECT (SELECT count(*) FROM dirty) AS read_rows, (SELECT count(*) FROM dirty) AS loaded_raw,
         count(*) FILTER (verdict = 'valid') AS count_valid,
         count(*) FILTER (verdict = 'corrected') AS count_corrected,
         count(*) FILTER (verdict = 'quarantined') AS count_quarantine,
         (SELECT count(*) FROM validated) AS count_inserted, 0::BIGINT AS count_updated,
         0::BIGINT AS count_unchanged, (SELECT count(DISTINCT order_id) FROM accepted) AS distinct_accepted
  FROM classified
)"""

_BYTES = " + ".join(f"strlen(coalesce({c}, ''))" for c in PHYSICAL_FIELDS) + f" + {len(PHYSICAL_FIELDS)}"
_HEADER = len((",".join(PHYSICAL_FIELDS) + "\n").encode())


def _pair(raw: str, value: str, corrected: str, more: str = "") -> str:
    return (
        f"WITH {DIRTY + RULES} SELECT nullif({raw}, '') AS raw, {value} AS value, "
        f"{corrected} AS corrected{more} FROM ruled"
    )


def oracle_sql() -> dict[str, str]:
    tracked = _TRACKED.format(run1="last_run_id", run2="first_seen_run_id")
    streamed = _TRACKED.format(
        run1="CASE last_run_id WHEN 'run-1' THEN 'chunk-000000' ELSE 'chunk-000001' END",
        run2="CASE first_seen_run_id WHEN 'run-1' THEN 'chunk-000000' ELSE 'chunk-000001' END",
    )
    return {
        "csv_scan": f"WITH {DIRTY} SELECT {_physical()} FROM dirty",
        "csv_scan_mixed_headers": f"WITH {DIRTY} SELECT {_physical()}, CASE WHEN k % 2 = 1 THEN 'C' || k END AS coupon FROM dirty",
        "raw_extra_columns": f"WITH {DIRTY} SELECT {_logical()}, CASE WHEN k % 2 = 1 THEN 'C' || k END AS coupon FROM dirty",
        "run_id_reuse": f"WITH {DIRTY} SELECT count(*) AS raw_rows, true AS refused FROM dirty",
        "csv_scan_cp1256": f"WITH {DIRTY} SELECT {_physical(lambda c: 'nullif(' + latin(c) + chr(44) + repr('') + ')')} FROM dirty",
        "column_map": f"WITH {DIRTY} SELECT {_logical()} FROM dirty",
        "raw_envelope": f"WITH {DIRTY} SELECT 'run-1' AS id_run, 'spark' AS engine_used, "
                        f"true AS has_lineage, {_logical()} FROM dirty",
        "preview": f"WITH {DIRTY} SELECT {_physical()}, {len(PHYSICAL_FIELDS)}::BIGINT AS column_count "
                   f"FROM (SELECT * FROM dirty ORDER BY k, copy_no LIMIT 5)",
        "stream_dir_ingest": f"WITH {MERGED} SELECT {streamed} FROM validated",
        "stream_bad_file": f"WITH {MERGED} SELECT {_FLAT}, replace(replace(last_run_id, 'run-1', 'chunk-000000'), "
                           "'run-2', 'chunk-000002') AS last_run_id, 1::BIGINT AS failures FROM validated",
        "quarantine": f"""WITH {CLASSIFIED}
            SELECT 'run-1' AS id_run, nullif(order_id, '') AS order_id_raw, codes_text AS codes_error,
                   reason AS details_error, code AS quarantine_code,
                   corrections_text AS corrections_attempted, nullif(customer_id, '') AS customer_id_raw,
                   order_date AS order_date_raw, total_amount AS total_amount_raw, items_json AS items_raw
            FROM classified WHERE verdict = 'quarantined'""",
        "upsert_merge": f"WITH {MERGED} SELECT {tracked} FROM validated",
        "upsert_actions": f"WITH {MERGED} SELECT order_id, action FROM compared_runs",
        "split_rows": f"WITH {DIRTY} SELECT {_physical()}, true AS one_file, "
                      "(row_number() OVER (ORDER BY k, copy_no) - 1) // 500 AS chunk FROM dirty",
        "small_sample": f"WITH {DIRTY} SELECT {_physical()}, true AS few_files "
                        "FROM (SELECT * FROM dirty ORDER BY k, copy_no LIMIT 200)",
        "rule_arabic_digits": _pair("total_amount", "p1", "p1 <> p0"),
        "rule_currency": _pair("currency", "c_currency", "coalesce(c_currency <> t_currency, false)"),
        "rule_thousands": _pair(
            "total_amount",
            f"CASE WHEN contains(p0, ',') AND regexp_matches(replace(p0, ',', ''), '{C.NUMBER_PATTERN}') "
            "THEN replace(p0, ',', '') ELSE total_amount END",
            f"contains(p0, ',') AND regexp_matches(replace(p0, ',', ''), '{C.NUMBER_PATTERN}')",
        ),
        "rule_price_words": _pair(
            "total_amount", f"coalesce({lookup(C.PRICE_WORDS, 'p0')}, total_amount)",
            f"({lookup(C.PRICE_WORDS, 'p0')}) IS NOT NULL",
        ),
        "rule_parse_price": f"WITH {DIRTY + RULES} SELECT total_amount AS raw, cast(stated AS DOUBLE) AS price, "
                            "len(stated_codes) > 0 AS corrected, array_to_string(stated_codes, '+') AS codes FROM ruled",
        "rule_phone": _pair("customer_phone", "c_phone", "c_phone <> t_phone"),
        "rule_email": _pair("customer_email", "c_email", "c_email <> t_email", ", email_valid AS is_valid"),
        "rule_date": _pair(
            "order_date", "c_date",
            f"c_date IS NOT NULL AND (NOT regexp_matches(date_digits, '{_ISO}') OR date_digits <> t_date)",
            ", bad_date AS is_impossible",
        ),
        "rule_status": _pair("status", "t_status", "t_status <> status"),
        "rule_items_json": f"""WITH {DIRTY + RULES} SELECT items_json AS raw,
            CASE WHEN e_items IS DISTINCT FROM 'JSON_ITEMS_CORRUPTED' THEN items_canonical END AS items,
            e_items AS error_code FROM ruled""",
        "rule_recompute_total": f"""WITH {DIRTY + RULES} SELECT nullif(order_id, '') AS order_id,
            cast(stated AS DOUBLE) AS stated, cast(computed_total AS DOUBLE) AS computed,
            recomputed AS corrected FROM ruled WHERE e_items IS NULL""",
        "error_codes": f"WITH {CLASSIFIED} SELECT nullif(order_id, '') AS order_id_raw, "
                       "nullif(customer_id, '') AS customer_id_raw, codes_text AS codes_error FROM classified",
        "corrections_audit": f"""WITH {DIRTY + RULES},
            entries AS (SELECT nullif(order_id, '') AS order_id_raw, unnest(corrections) AS c,
                               generate_subscripts(corrections, 1) - 1 AS place FROM ruled)
            SELECT order_id_raw, place::BIGINT AS place, c.f AS field, c.o AS original_value,
                   c.c AS corrected_value, c.r AS rule_code FROM entries""",
        "classify": f"WITH {CLASSIFIED} SELECT nullif(order_id, '') AS order_id_raw, "
                    "nullif(customer_id, '') AS customer_id_raw, verdict AS quality_status, "
                    "code AS quarantine_code, reason AS details_error FROM classified",
        "dup_conflicts": f"WITH {CLASSIFIED} SELECT id AS order_id, cust AS customer_id, "
                         "cast(final_total AS DOUBLE) AS total_amount FROM classified "
                         f"WHERE list_contains(codes, '{C.DUPLICATE_ERROR}')",
        "last_wins": f"WITH {VALIDATED} SELECT order_id, customer_id, cast(total_amount AS DOUBLE) AS total_amount, "
                     "quality_status FROM last_rows",
        "cleaned": f"WITH {VALIDATED} SELECT {_FLAT} FROM accepted",
        "classified_sample": f"""WITH {CLASSIFIED} SELECT nullif(order_id, '') AS order_id_raw, code AS quarantine_code
            FROM (SELECT * FROM classified WHERE verdict = 'quarantined' ORDER BY k, copy_no LIMIT 10)""",
        **{n: f"WITH {VALIDATED} {_lookup(n, _FLAT)}" for n in _LOOKUP_FILTERS},
        "explain_layout": f"WITH {VALIDATED} {_EXPLAINED}",
        "clustered_lookup": f"WITH {VALIDATED} {_CLUSTERED}",
        "layout_top_up": f"WITH {MERGED} {_CLUSTERED.replace('FROM validated ', _KEPT_ROWS)}",
        "sales_by_city": f"WITH {VALIDATED} {_CITY.format(limit=20)}",
        "top_products": f"WITH {VALIDATED + _LINES} {_TOP_PRODUCTS}",
        "top_customers": f"""WITH {VALIDATED}
            SELECT customer_id, min_by(customer_name, {{'d': order_date, 'i': order_id}}) AS customer_name,
                   cast(coalesce(sum(total_amount), 0) AS DOUBLE) AS total_spent, count(*) AS orders_count
            FROM validated GROUP BY customer_id
            ORDER BY coalesce(sum(total_amount), 0) DESC, customer_id LIMIT 10""",
        "sales_by_month": f"""WITH {VALIDATED} SELECT order_date[1:7] AS period,
            cast(coalesce(sum(total_amount), 0) AS DOUBLE) AS total_sales, count(*) AS orders_count
            FROM validated GROUP BY order_date[1:7]""",
        "sales_by_day": f"""WITH {VALIDATED} SELECT order_date AS period,
            cast(coalesce(sum(total_amount), 0) AS DOUBLE) AS total_sales, count(*) AS orders_count
            FROM validated GROUP BY order_date""",
        "status_distribution": f"WITH {VALIDATED} {_STATUS}",
        "items_normalized": f"""WITH {VALIDATED + _LINES}
            SELECT order_id, product, qty, coalesce(unit_price, 0) AS unit_price FROM order_lines""",
        "table_counts": f"""WITH {VALIDATED}
            SELECT 'orders_raw' AS table_name, count(*) AS rows_count, NULL::BIGINT AS distinct_order_ids,
                   false AS has_duplicates FROM dirty
            UNION ALL SELECT 'orders_validated', count(*), count(DISTINCT order_id),
                   count(*) <> count(DISTINCT order_id) FROM validated
            UNION ALL SELECT 'orders_quarantine', count(*), NULL, false FROM classified
            WHERE verdict = 'quarantined'""",
        "mv_daily_sales_full": f"WITH {VALIDATED} {_DAILY}",
        "mv_daily_sales_incremental": f"WITH {MERGED} {_DAILY}",
        "mv_top_products_full": f"WITH {VALIDATED + _LINES} {_PRODUCTS}",
        "mv_top_products_incremental": f"WITH {MERGED + _LINES} {_PRODUCTS}",
        "stream_mv_refresh": f"WITH {MERGED} {_DAILY}",
        "periodic_report": f"""WITH {VALIDATED + _LINES}
            SELECT 'sales_by_city' AS section, row_number() OVER () AS rank, city AS key, total_sales AS value
            FROM ({_CITY.format(limit=10)})
            UNION ALL SELECT 'top_products', row_number() OVER (), product, revenue FROM ({_TOP_PRODUCTS})
            UNION ALL SELECT 'orders_status_distribution', NULL, status, percentage FROM ({_STATUS})""",
        "latest_job_runs": """
            SELECT event_type AS job_name, date_trunc('hour', cast(ts AS TIMESTAMP)) AS started_at,
                   cast(ts AS TIMESTAMP) AS finished_at,
                   cast(epoch_us(cast(ts AS TIMESTAMP)) - epoch_us(date_trunc('hour', cast(ts AS TIMESTAMP))) AS DOUBLE)
                     AS duration_seconds,
                   CASE WHEN value > 50 THEN 'failure' ELSE 'success' END AS status,
                   CASE WHEN value > 50 THEN 'value ' || cast(cast(trunc(value) AS BIGINT) AS VARCHAR) END AS error,
                   cast(event_id AS VARCHAR) AS result
            FROM events
            QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts DESC,
              CASE WHEN value > 50 THEN 0 ELSE 1 END DESC, error DESC NULLS LAST, cast(event_id AS VARCHAR) DESC) = 1""",
        "run_metrics": f"WITH {VALIDATED + _COUNTS} SELECT * FROM counts",
        "run_checks": f"""WITH {VALIDATED + _COUNTS}
            SELECT count_valid + count_corrected + count_quarantine AS consistency_expected_total,
                   loaded_raw = count_valid + count_corrected + count_quarantine AS consistency_check_passed,
                   count_inserted + count_updated + count_unchanged = distinct_accepted AS upsert_applied,
                   count_inserted + count_updated + count_unchanged = count_valid + count_corrected
                     AS upsert_matches_rows,
                   count_inserted = 0 AS idempotent_run FROM counts""",
        "error_code_counts": f"""WITH {CLASSIFIED},
            uses AS (SELECT code AS code, 1 AS p, 0 AS m FROM classified WHERE code IS NOT NULL
                     UNION ALL SELECT unnest(codes), 0, 1 FROM classified)
            SELECT code, cast(sum(p) AS BIGINT) AS orders_count, cast(sum(m) AS BIGINT) AS mentions_count
            FROM uses GROUP BY code""",
        "correction_rule_counts": f"""WITH {VALIDATED},
            uses AS (SELECT unnest(corrections).r AS rule_code FROM accepted)
            SELECT rule_code, count(*) AS corrections_count,
                   {_percent("count(*)", "(SELECT count(*) FROM accepted WHERE quality_status = 'corrected')", 1)}
                     AS share_of_corrected
            FROM uses GROUP BY rule_code""",
        "reconcile_counts": f"""WITH {DIRTY} SELECT 'run-1' AS id_run, count(*) AS csv_rows, count(*) AS raw_rows,
            0::BIGINT AS difference, true AS all_arrived FROM dirty""",
        "rollback_restore": f"WITH {FIRST_RUN} SELECT {tracked} FROM validated",
        "mv_daily_sales_restored": f"WITH {FIRST_RUN} {_DAILY}",
        "rollback_run": f"WITH {MERGED} SELECT {tracked} {_ROLLED_BACK}",
        "prefix_sample": f"WITH {DIRTY} SELECT {_physical()} FROM (SELECT * FROM dirty ORDER BY k, copy_no LIMIT 1000)",
        "size_sample": f"""WITH {DIRTY}, sized AS (
              SELECT *, coalesce(sum({_BYTES}) OVER (ORDER BY k, copy_no
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + {_HEADER} AS before FROM dirty)
            SELECT {_physical()} FROM sized WHERE before < {int(0.25 * 1024 * 1024)}""",
    }
