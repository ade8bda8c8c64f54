"""Single-field rules: literal inputs and outputs."""

import datetime
import json
import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ordermill.constants import ITEM_QUANTITY_KEYS, ITEM_UNIT_PRICE_KEYS
from ordermill.functions import dates, items, rules
from ordermill.functions.layers import add_layers
from ordermill.functions.money import with_price
from ordermill.functions.text import clean


def outputs(spark, rule, inputs):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(inputs)], "i int, x string")
    columns = rule(F.col("x"))
    rows = df.select("i", *[c.alias(f"c{n}") for n, c in enumerate(columns)]).orderBy("i").collect()
    return [tuple(r)[1:] for r in rows]


CASES = {
    rules.arabic_numerals: [
        ("٧٢٩", ("729", True)), ("88", ("88", False)), (None, ("", False)),
        (" 12 ", ("12", False)), ("٠١٢٣٤٥٦٧٨٩", ("0123456789", True)),
    ],
    rules.currency: [
        ("ريال يمني", ("YER", True)), ("SAR", ("SAR", False)), ("yer", ("YER", True)),
        ("$", ("USD", True)), ("eur", ("EUR", True)), ("EUR", ("EUR", False)),
        ("gold", ("gold", False)), ("", (None, False)), (None, (None, False)),
        (" ريال سعودي ", ("SAR", True)), ("  USD ", ("USD", False)),
    ],
    rules.thousands_separator: [
        ("9,876,543.2", ("9876543.2", True)), ("431", ("431", False)),
        ("a,b", ("a,b", False)), ("1,2,3", ("123", True)), (",", (",", False)),
    ],
    rules.price_in_words: [
        ("ثلاثة آلاف", ("3000", True)), ("بلا سعر", ("بلا سعر", False)),
        ("الفين وخمسمئة", ("2500", True)), (" مئة ", ("100", True)),
    ],
    rules.phone: [
        ("966 50+555 0142", ("+966505550142", True)), ("+966505550142", ("+966505550142", False)),
        ("٧٧١", ("771", True)), ("++1+2", ("+12", True)), ("", ("", False)), ("  ", ("  ", False)),
        ("abc", ("", True)),
    ],
    rules.email: [
        ("mona@@@shop...example", ("mona@shop.example", True, True)),
        ("mona@shop.example", ("mona@shop.example", False, True)),
        ("mo na@shop.example", ("mona@shop.example", True, True)),
        ("nobody", ("nobody", False, False)), ("a@@b", ("a@b", True, False)),
        ("", ("", False, False)),
    ],
    rules.date: [
        ("2024/06/17", ("2024-06-17", True)), ("2024-06-17", ("2024-06-17", False)),
        ("2025-02-24T21:29:00", ("2025-02-24", False)), ("2025-02-24 21:29", ("2025-02-24", False)),
        ("٢٠٢٤-٠٦-١٧", ("2024-06-17", True)), ("2024-00-77", ("2024-00-77", False)),
        ("02/03/2025", ("2025-03-02", True)), ("02/13/2025", ("2025-02-13", True)),
        ("13.02.2025", ("2025-02-13", True)), ("02.13.2025", (None, False)),
        ("2025.2.3", ("2025-02-03", True)), ("2025-1-5", ("2025-01-05", True)),
        ("31-04-2025", (None, False)), ("015/1/2025", (None, False)), ("1/2-2025", (None, False)),
        ("2024-06-17T08:15:30Z", ("2024-06-17", True)),
        ("2024-06-17T08:15:30-05:00", ("2024-06-17", True)),
        ("2024-06-17T24:59:00+01:00", (None, False)),
        ("20250105", ("2025-01-05", True)), ("٢٠٢٥٠١٠٥", ("2025-01-05", True)),
        ("20250105T1015+0300", ("2025-01-05", True)), ("20250230", (None, False)),
        ("2025-W02-3", ("2025-01-08", True)), ("2025W023", ("2025-01-08", True)),
        ("2025-W02", ("2025-01-06", True)), ("2020-W53-7", ("2021-01-03", True)),
        ("2025-W01-1", ("2024-12-30", True)), ("2021-W53-1", (None, False)),
        ("2025-W00-1", (None, False)), ("2025-W02-8", (None, False)),
        ("soon", (None, False)), ("", (None, False)), (None, (None, False)),
    ],
    rules.status: [
        (" ملغي ", ("ملغي", True)), ("ملغي", ("ملغي", False)), ("lost", ("lost", False)),
        ("", ("", False)),
    ],
}


@pytest.mark.parametrize("rule", CASES, ids=lambda r: r.__name__)
def test_rule(spark, rule):
    cases = CASES[rule]
    assert outputs(spark, rule, [c[0] for c in cases]) == [c[1] for c in cases]


def test_clean_strips_every_unicode_space(spark):
    texts = ["\t a b ", "　x ", "\x1cy\x1f", None, "  "]
    assert outputs(spark, lambda c: [clean(c)], texts) == [
        ("" if t is None else t.strip(),) for t in texts
    ]


def test_impossible_dates(spark):
    days = ["2024-00-77", None, "1999-12-31", "2000-01-01", "2100-12-31", "2101-01-01", "2025-02-29"]
    assert [r[0] for r in outputs(spark, lambda c: [dates.is_impossible(c)], days)] == [
        True, True, True, False, False, True, True,
    ]


def test_price(spark):
    cases = [
        ("٧٢٩ ريال", 729.0, "ARABIC_NUMERALS+CURRENCY_TEXT_STRIPPED"),
        ("88.25", 88.25, ""), ("بلا سعر", None, ""), (None, None, ""), ("  ", None, ""),
        ("ثلاثة آلاف", 3000.0, "PRICE_IN_WORDS"), ("1,250.50", 1250.5, "THOUSANDS_SEPARATOR"),
        ("USD 1,000", 1000.0, "CURRENCY_TEXT_STRIPPED+THOUSANDS_SEPARATOR"),
        ("100 ريال يمني", None, "CURRENCY_TEXT_STRIPPED"), ("-5", -5.0, ""), ("1e3", 1000.0, ""),
        ("20000000000000000", 2e16, ""), ("1e400", None, ""), ("nan", None, ""), ("5d", None, ""), ("1_000", None, ""),
    ]
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "i int, x string")
    rows = df.transform(with_price("x")).orderBy("i").collect()
    got = [(r["x"], None if r["price"] is None else float(r["price"]), r["price_codes"]) for r in rows]
    assert got == cases
    assert [r["price_corrected"] for r in rows] == [bool(c[2]) for c in cases]


ITEM_CASES = [
    ('[{"count": 4, "item_price": 2.25}]', None, 19.0),
    ("{broken", "JSON_ITEMS_CORRUPTED", None), ("[]", "ITEMS_EMPTY", None),
    ("", "JSON_ITEMS_CORRUPTED", None), (None, "JSON_ITEMS_CORRUPTED", None),
    ('{"a": 1}', "JSON_ITEMS_CORRUPTED", None), ("[1] x", "JSON_ITEMS_CORRUPTED", None),
    ("[1],[2]", "JSON_ITEMS_CORRUPTED", None), ("null", "JSON_ITEMS_CORRUPTED", None),
    ("[1]", None, None), ("[null]", None, None), ('[{"qty": 2}]', None, None),
    ('[{"price": 7}]', None, 17.0), ('[{"qty": "", "count": 3, "price": "2"}]', None, 16.0),
    ('[{"qty": "٣", "price": " 5 "}]', None, 25.0), ('[{"qty": true, "price": 4}]', None, 14.0),
    ('[{"qty": -1, "price": 4}]', None, None), ('[{"qty": 1, "price": -4}]', None, None),
    ('[{"qty": "x", "price": 4}]', None, None), ('[{"qty": [1], "price": 4}]', None, None),
    ('[{"qty": 1e400, "price": 4}]', None, None),
    ('[{"qty": 1, "price": 1}, {"qty": 2}]', None, None),
    ('[{"qty": 1, "price": 1}, {"sku": "a", "item_price": 2.5, "amount_units": 2}]', None, 16.0),
]


def test_items_and_total(spark):
    df = spark.createDataFrame(
        [(i, c[0], "10") for i, c in enumerate(ITEM_CASES)], "i int, x string, fee string"
    )
    df = add_layers(df, items.item_layers(clean(F.col("x")), F.col("fee")))
    rows = df.select(
        "i", F.col("e_items").alias("e"), F.col("computed").cast("double").alias("t")
    ).orderBy("i").collect()
    expected = [(e, t) for _, e, t in ITEM_CASES]
    got = [(r["e"], None if r["e"] else r["t"]) for r in rows]
    assert got == expected


@pytest.mark.parametrize(
    "fee,expected", [("", 200.0), (None, 200.0), ("x", None), ("-1", None), ("٥", 205.0)]
)
def test_fee(spark, fee, expected):
    df = spark.createDataFrame([('[{"qty": 2, "price": 100}]', fee)], "x string, fee string")
    df = add_layers(df, items.item_layers(F.col("x"), F.col("fee")))
    assert df.select(F.col("computed").cast("double")).first()[0] == expected


def test_canonical_items_ignore_key_order_and_number_form(spark):
    df = spark.createDataFrame([('[{"b": 1.0, "a": "x"}]',), ('[ {"a":"x","b":1} ]',)], "x string")
    texts = {r[0] for r in df.select(items.canonical_items(items.parse_wrapped(F.col("x")))).collect()}
    assert texts == {'[{"a":"x","b":1}]'}


# --- against a plain statement of the total rule, on generated item lists -------------------

_values = st.one_of(
    st.none(), st.booleans(), st.integers(-3, 50), st.sampled_from(["", "7", "2.5", "x", " 3 "]),
    st.lists(st.integers(), max_size=1),
)
_names = st.sampled_from(["quantity", "qty", "count", "unit_price", "price", "note"])
_lists = st.lists(
    st.one_of(st.dictionaries(_names, _values, max_size=4), st.integers(), st.none()),
    min_size=1, max_size=4,
)


def plain_total(parsed):
    total = 0.0
    for item in parsed:
        if not isinstance(item, dict):
            return None
        filled = {k: v for k, v in item.items() if v is not None and v != ""}
        price = next((filled[k] for k in ITEM_UNIT_PRICE_KEYS if k in filled), None)
        qty = next((filled[k] for k in ITEM_QUANTITY_KEYS if k in filled), 1)
        try:
            price, qty = float(price), float(qty)
        except (TypeError, ValueError):
            return None
        if price < 0 or qty < 0:
            return None
        total += price * qty
    return round(total, 2)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(_lists, min_size=40, max_size=60))
def test_total_of_generated_items(spark, generated):
    df = spark.createDataFrame(
        [(i, json.dumps(g)) for i, g in enumerate(generated)], "i int, x string"
    )
    df = add_layers(df, items.item_layers(F.col("x"), F.lit("")))
    total = F.col("computed").cast("double")
    got = [r[0] for r in df.select("i", total.alias("t")).orderBy("i").select("t").collect()]
    for value, expected in zip(got, map(plain_total, generated)):
        assert (value is None) == (expected is None)
        assert expected is None or math.isclose(value, expected, abs_tol=0.005)


def test_iso_spellings_read_as_the_standard_library_does(spark):
    days = [
        "2025-01-05", "20250105", "20240229", "20250229", "20251301", "2025W02", "2025-W02", "2025-W02-3",
        "2025W023", "2020-W53-7", "2021-W53-1", "2026W531", "2024W527", "2025-W00-1", "2025W020",
        "2025-W02-8", "2025-W023", "2025W54", "9999-W52-7", "2025-W1-1", "202501", "00010101", "0000W011",
    ]
    times = ["", "10", "1000", "10:00", "235959", "10:00:30", "100030.25", "10:00:30,123456789", "24", "10:00:60"]
    offsets = ["", "Z", "+03", "-0330", "+03:30", "+03:30:15", "+24"]
    clocks = ["", *(s + t + o for s in "T -\nx" for t in times if t for o in offsets)]
    texts = [d + c for d in days for c in clocks]
    expected = []
    for text in texts:
        try:
            expected.append(datetime.datetime.fromisoformat(text.replace("Z", "")).date().isoformat())
        except ValueError:
            expected.append(None)
    # ISO shape is cut without a look at the calendar; that is another rule.
    got = outputs(spark, lambda c: [dates.fix_date(c), dates.is_iso_shaped(c)], texts)
    wrong = [(t, e, g) for t, e, (g, shaped) in zip(texts, expected, got) if not shaped and e != g]
    assert not wrong, wrong[:20]
    assert sum(e is not None for e in expected) > 1000


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.dates(datetime.date(1990, 1, 1), datetime.date(2110, 1, 1)), min_size=50))
def test_every_date_spelling_reads_back(spark, days):
    spellings = [
        (d, d.strftime(f)) for d in days
        for f in ("%Y-%m-%d", "%Y/%m/%d", "%d-%m-%Y", "%d/%m/%Y", "%Y.%m.%d", "%d.%m.%Y", "%Y%m%d", "%G-W%V-%u", "%GW%V%u")
    ]
    got = outputs(spark, rules.date, [text for _, text in spellings])
    assert [g[0] for g in got] == [d.isoformat() for d, _ in spellings]
    again = outputs(spark, rules.date, [g[0] for g in got])
    assert again == [(g[0], False) for g in got]
