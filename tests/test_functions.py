from datetime import date

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from orchardflow.functions import records, text, values

TODAY = date(2026, 8, 24)


def outcome(spark, rows, make, schema="t string, a string"):
    made = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"i int, {schema}").select("i", make.alias("x")).orderBy("i").collect()
    return [r.x for r in made]


MONEY = [
    ("$1,234.50", "auto", ("USD", 123450), None),
    ("1.234,50 EUR", "auto", ("EUR", 123450), None),
    ("£7.505", "auto", ("GBP", 750500), None),
    ("£7.505", "dot", None, "unparsable"),
    ("€7,505", "comma", None, "unparsable"),
    ("€7,505", "dot", ("EUR", 750500), None),
    ("1.234.567 USD", "dot", ("USD", 123456700), None),
    ("£1,234.567,89", "auto", None, "unparsable"),
    ("¥49.80", "auto", None, "unparsable"),
    ("¥ 4,980", "auto", ("JPY", 4980), None),
    ("CHF 1'234.50", "auto", ("CHF", 123450), None),
    ("R$ 10,00", "auto", ("BRL", 1000), None),
    ("19.99", "auto", None, "no_currency"),
    ("N/A", "auto", None, "no_currency"),
    ("USD19.99", "auto", None, "no_currency"),
    ("RRP GBP 5.00", "auto", None, "no_currency"),
    ("-£5.00", "auto", ("GBP", 500), None),
    ("2 for £10", "auto", ("GBP", 200), None),
    ("££", "auto", None, "unparsable"),
    ("£0.5", "auto", ("GBP", 50), None),
    ("£1.2300", "auto", ("GBP", 123), None),
    ("£99999999999999999999", "auto", None, "unparsable"),
    (None, "auto", None, None),
]


def test_money(spark):
    got = outcome(spark, [(t, s) for t, s, *_ in MONEY], values.money(F.col("t"), F.col("a")))
    assert [(tuple(x.value) if x.value else None, x.code) for x in got] == [(v, c) for *_, v, c in MONEY]


def test_money_options(spark):
    got = outcome(spark, [("19.99", ""), ("-£5.00", "")], values.money(F.col("t"), default_currency="GBP", strict_sign=True))
    assert tuple(got[0].value) == ("GBP", 1999) and got[1].code == "out_of_range"


def test_amounts(spark):
    rows = [("GBP", "5"), ("GBP", "123"), ("JPY", "4980"), ("USD", "0"), ("EUR", "123450")]
    assert outcome(spark, rows, values.amount_text(F.col("t"), F.col("a").cast("long"))) == ["0.05", "1.23", "4980", "0.00", "1234.50"]


DATES = [
    ("2026-08-01", "dmy", date(2026, 8, 1)),
    ("3 days ago", "dmy", date(2026, 8, 21)),
    ("Today", "dmy", TODAY),
    ("yesterday", "dmy", date(2026, 8, 23)),
    ("2 weeks ago", "dmy", date(2026, 8, 10)),
    ("5 hours ago", "dmy", date(2026, 8, 19)),
    ("13/04/2026", "dmy", date(2026, 4, 13)),
    ("13/04/2026", "mdy", None),
    ("1/2/26", "dmy", date(2026, 2, 1)),
    ("1/2/26", "mdy", date(2026, 1, 2)),
    ("2026/08/01", "mdy", date(2026, 8, 1)),
    ("Sept. 3rd, 2026", "dmy", date(2026, 9, 3)),
    ("3 Sept 2026", "dmy", date(2026, 9, 3)),
    ("1 August 2026", "dmy", date(2026, 8, 1)),
    ("2026-06-30T09:15:00Z", "dmy", date(2026, 6, 30)),
    ("Foo 3, 2026", "dmy", None),
    ("31/02/2026", "dmy", None),
    ("29/02/2028", "dmy", date(2028, 2, 29)),
    ("an hour ago", "dmy", None),
    ("99999999 weeks ago", "dmy", None),
    ("0000-01-01", "dmy", None),
]


def test_dates(spark):
    got = outcome(spark, [(t, o) for t, o, _ in DATES] + [(None, "dmy")], values.listing_date(F.col("t"), TODAY, F.col("a")))
    assert [(x.value, x.code) for x in got] == [(v, None if v else "unparsable") for *_, v in DATES] + [(None, None)]
    assert outcome(spark, [("30 hours ago", "")], values.listing_date(F.col("t"), TODAY, hours_as_days=False))[0].value == date(2026, 8, 23)


RATINGS = [("star-rating Three", 3.0, None), ("4.5 out of 5", 4.5, None), ("4/5", 4.0, None), ("7/10", 3.5, None), ("3", 3.0, None), ("4,5", 4.5, None), ("8/20", None, "unparsable"), ("Twelve", None, "unparsable"), ("threefold", None, "unparsable"), ("6", None, "out_of_range"), ("12/10", None, "out_of_range"), ("3 12", None, "unparsable"), (None, None, None)]


def test_ratings(spark):
    assert [(x.value, x.code) for x in outcome(spark, [(t, "") for t, *_ in RATINGS], values.rating(F.col("t")))] == [(v, c) for _, v, c in RATINGS]


STOCK = [("Unavailable", "out_of_stock"), ("Sold out", "out_of_stock"), ("Not in stock", "out_of_stock"), ("No longer available", "discontinued"), ("Available for pre-order", "preorder"), ("not available", "in_stock"), ("Backorder", "unknown"), (None, None)]


def test_availability(spark):
    assert outcome(spark, [(t, "") for t, _ in STOCK], values.availability(F.col("t"))) == [v for _, v in STOCK]


LINKS = [("/product/nc-1001.html", "https://example.test/product/nc-1001.html"), ("p/9#reviews", "https://example.test/catalog/p/9"), ("//cdn.test/x", "https://cdn.test/x"), ("javascript:void(0)", None), ("mailto:a@b", None), ("http://[broken", None)]


def test_links(spark):
    got = outcome(spark, [(t, "https://example.test/catalog/page-1.html") for t, _ in LINKS] + [(None, "x")], text.resolve_url(F.col("t"), F.col("a")))
    assert [(x.value, x.code) for x in got] == [(v, None if v else "unparsable") for _, v in LINKS] + [(None, None)]


@pytest.mark.parametrize("raw,clean", [(None, None), ("", None), (" \n\t ", None), ("a  b", "a b"), ("a&amp;b&nbsp;c", "a&b c"), ("zero​width­", "zerowidth"), ("ﬁ１２", "fi12"), ("x\x1fy z", "x y z")])
def test_clean_text(spark, raw, clean):
    assert text.cleaned(raw) == clean


def test_clean_text_column(spark):
    assert outcome(spark, [(" a&amp;b ", ""), (None, ""), ("ß", "")], text.clean_text(F.col("t"))) == ["a&b", None, "ß"]
    assert outcome(spark, [("Straße  X", ""), (None, "")], text.fold(F.col("t"))) == ["strasse x", ""]
    assert outcome(spark, [("a \n b\t", ""), ("  ", "")], text.squeeze(F.col("t"))) == ["a b", None]


def test_native_and_python_forms_agree(spark):
    """Texts of all ASCII characters and of others: each goes its own way, with one result."""
    import random

    rng = random.Random(1)
    chars = [chr(i) for i in range(1, 128)] + list("\u00a0\u200b\u00adßéİﬁ漢😀\u2028") + [" ", "&amp;", "&#169", "\\u00E9", "\\\\"]
    rows = [("".join(rng.choice(chars[:127] if i % 2 else chars) for _ in range(rng.randint(0, 12))), "") for i in range(600)]
    assert outcome(spark, rows, text.clean_text(F.col("t"))) == [text.cleaned(t) for t, _ in rows]
    assert outcome(spark, rows, text.fold(F.col("t"))) == [" ".join(t.casefold().split()) for t, _ in rows]
    import json

    made = F.to_json(F.struct(F.col("t")), {"writeNonAsciiCharacterAsCodePoint": "true"})
    assert outcome(spark, rows, text.escape_json(made)) == [json.dumps({"t": t}, separators=(",", ":")) for t, _ in rows]


def test_content_hash_runs_no_python(spark):
    df = spark.createDataFrame([product()], PRODUCT).withColumn("h", records.content_hash())
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()


def product(sku="NC-1", title="Té", minor=5177, rating=3.0):
    return ("s", sku, title, ("GBP", minor), "in_stock", rating, None, date(2026, 7, 14), "http://x.test/1")


PRODUCT = "source_id string, sku string, title string, price struct<currency:string,minor:bigint>, availability string, rating double, category string, listed_on date, url string"


def test_content_hash_is_of_canonical_json(spark):
    import hashlib
    import json

    df = spark.createDataFrame([product(), product(title="plain", rating=None)], PRODUCT)
    payload = lambda r: {"sku": r.sku, "title": r.title, "currency": "GBP", "minor": 5177, "availability": "in_stock", "rating": r.rating, "category": None, "listed_on": "2026-07-14", "url": r.url}
    want = [hashlib.sha256(json.dumps(payload(r), sort_keys=True, separators=(",", ":")).encode()).hexdigest() for r in df.collect()]
    assert [r.h for r in df.select(records.content_hash().alias("h")).collect()] == want
    assert df.select(records.content_hash(True).alias("h")).collect()[1].h == want[1]


def test_keys(spark):
    df = spark.createDataFrame([product(" nc-1  A", "Straße"), product(None, "x")], PRODUCT)
    assert [r.k for r in df.select(records.dedupe_key(["sku", "title", "price"]).alias("k")).collect()] == ["nc-1 a\u001fstrasse\u001f5177GBP", "\u001fx\u001f5177GBP"]
    assert df.select(records.dedupe_key(["sku"], True).alias("k")).collect()[0].k == "nc-1 a"


def test_plain_links_are_resolved_without_python(spark, monkeypatch):
    """Native and Python's rules give the same for every pair, and the plain ones reach Python as nulls."""
    links = ["/p/1", "/a-b/c_D/9", "/", "/a/", "//h.test/x", "/a//b", "/a/../b", "/a.html", "/a?b=1", "/a#b", "/a b", " /a", "/a\n", "/é", "/a&amp;b", "a/b", "", "?q", "#x", "/a;b", "http://h.test/p", "mailto:x", None]
    pages = ["http://s0.test/list?page=1", "https://s0.test:8090", "http://s0.test#x", "http://a-b.test/x/y", "http://s0.test\n", "http://S0.test/x", "HTTP://s0.test/x", "http://u@s0.test/x", "http://[bad/x", "http://-x.test/", "http://a_b.test/", "ftp://s0.test/x", "http:///x", "s0.test", "", None]
    pairs = [(a, b) for a in links for b in pages]
    got = outcome(spark, pairs, text.resolve_url(F.col("t"), F.col("a")))
    assert [tuple(x) for x in got] == [text.resolved(*p) for p in pairs]

    @F.arrow_udf("struct<value:string,code:string>")
    def only_null(link: pa.Array, page: pa.Array) -> pa.Array:
        assert link.null_count == len(link) and page.null_count == len(page)
        return pa.array([None] * len(link), pa.struct([("value", pa.string()), ("code", pa.string())]))

    monkeypatch.setattr(text, "_resolve", only_null)
    assert [x.value for x in outcome(spark, [("/p/1", pages[0]), (None, pages[0])], text.resolve_url(F.col("t"), F.col("a")))] == ["http://s0.test/p/1", None]
