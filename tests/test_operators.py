from datetime import date

import pytest
from pyspark.sql import functions as F

from orchardflow.operators import changes, dedupe, paging, report
from tests.test_functions import PRODUCT, product


def keyed(spark, rows):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"n int, {PRODUCT}")
    return df.withColumn("key", F.lower(F.trim("sku"))).withColumn("seq", F.struct(F.lit(0).alias("s"), F.col("n").alias("n")))


def dups(spark, rows, policy):
    paired = dedupe.pair_up(keyed(spark, rows), policy)
    return dedupe.duplicates(paired, policy).orderBy("seq").collect(), dedupe.survivors(paired).orderBy("first_seq").collect()


def test_case_of_key_still_differs(spark):
    found, left = dups(spark, [product(" NC-1 "), product("nc-1")], "keep_first")
    assert [(d.kind, d.differing_fields) for d in found] == [("conflicting", ["sku"])] and [r.sku for r in left] == [" NC-1 "]


def test_both_prices_are_told(spark):
    found, left = dups(spark, [product(minor=1200), product(minor=999)], "keep_first")
    assert found[0].kept_values == {"price": "12.00 GBP"} and found[0].dropped_values == {"price": "9.99 GBP"} and left[0].price.minor == 1200


def test_keep_last_replaces_in_place(spark):
    found, left = dups(spark, [product("a", minor=1200), product("b"), product("a", minor=999)], "keep_last")
    assert [(r.sku, r.price.minor) for r in left] == [("a", 999), ("b", 5177)]
    assert found[0].kept_values == {"price": "9.99 GBP"} and found[0].dropped_values == {"price": "12.00 GBP"}


@pytest.mark.parametrize("policy,kinds", [("keep_first", ["conflicting", "identical"]), ("keep_last", ["conflicting", "conflicting"])])
def test_a_b_a(spark, policy, kinds):
    found, _ = dups(spark, [product(minor=1), product(minor=2), product(minor=1)], policy)
    assert [d.kind for d in found] == kinds


def test_unknown_policy(spark):
    with pytest.raises(ValueError):
        dedupe.pair_up(keyed(spark, [product()]), "keep_best")


def test_changes(spark):
    now = spark.createDataFrame([("a", "1", "s"), ("b", "2", "s"), ("c", "3", "t")], "key string, content_hash string, source_id string")
    before = spark.createDataFrame([("a", "1", "s"), ("b", "x", "s"), ("d", "9", "t")], "key string, content_hash string, source_id string")
    told = lambda state: {r.key: r.change for r in changes.classify(now, state).collect()}
    assert told(before) == {"a": "unchanged", "b": "changed", "c": "new"}
    assert set(told(None).values()) == {"unknown"} and set(told(before.limit(0)).values()) == {"new"}
    assert {r.key for r in changes.only_changed(changes.classify(now, before)).collect()} == {"b", "c"}
    assert [r.key for r in changes.removed(now, before).collect()] == ["d"]
    assert {r.key for r in changes.merged_state(now.where("source_id = 's'"), before, ["s"]).collect()} == {"a", "b", "d"}


def test_cut_and_cap(spark):
    pages = spark.createDataFrame([("a", i, n) for i, n in enumerate([3, 2, 0, 5], 1)] + [("b", 1, 0), ("b", 2, 4), ("c", 1, 1)], "source_id string, page_no int, n int")
    got = paging.cut(pages, F.col("n") == 0).orderBy("source_id", "page_no").collect()
    assert [(r.source_id, r.page_no) for r in got] == [("a", 1), ("a", 2), ("a", 3), ("b", 1), ("c", 1)]
    assert paging.capped(pages, 2).count() == 5
    kinds = pages.select(paging.empty_page(F.col("n"), F.col("page_no") == 1).alias("k")).collect()
    assert [r.k for r in kinds] == [None, None, "empty_page", None, "no_records", None, None]


def test_follow(spark):
    links = spark.createDataFrame([("a", "1", "2"), ("a", "2", "3"), ("a", "3", None), ("b", "1", "2"), ("b", "2", "1"), ("c", "1", "gone"), ("d", "1", "2"), ("d", "2", "3"), ("d", "3", "4")], "source_id string, url string, next_url string")
    start = spark.createDataFrame([(x, "1") for x in "abcd"], "source_id string, url string")
    got = {}
    for r in paging.follow(links, start, 3).orderBy("page_no").collect():
        got.setdefault(r.source_id, []).append((r.url, r.stopped_because))
    assert got == {"a": [("1", None), ("2", None), ("3", "no_next_link")], "b": [("1", None), ("2", "loop_detected")], "c": [("1", None), ("gone", "page_failed")], "d": [("1", None), ("2", None), ("3", "max_pages")]}


def test_page_urls(spark):
    rows = spark.createDataFrame([("a", "http://x/l?page=9&q=1&blank=#f", "page", 2, 3)], "source_id string, start_url string, page_param string, start_page int, max_pages int")
    assert [r.url for r in paging.page_urls(rows).orderBy("page_no").collect()] == [f"http://x/l?q=1&page={n}#f" for n in (2, 3, 4)]


def test_response_rules(spark):
    rows = spark.createDataFrame([(200, "3", 1), (429, " 1 ", 2), (503, "x", 3), (404, None, 9), (301, "-2", 1)], "s int, h string, n int")
    got = rows.select(paging.response_kind(F.col("s")).alias("k"), paging.retry_after_seconds(F.col("h")).alias("r"), paging.backoff_seconds(F.col("n"), 0.1, 1.0, paging.retry_after_seconds(F.col("h"))).alias("b")).collect()
    assert [r.k for r in got] == [None, "rate_limited", "server_error", "client_error", None]
    assert [r.r for r in got] == [3.0, 1.0, None, None, None] and [round(r.b, 3) for r in got] == [3.0, 1.0, 0.4, 1.0, 0.1]
    robots = spark.createDataFrame([(200, True), (200, None), (404, None), (500, None), (None, None)], "s int, d boolean")
    assert [r.a for r in robots.select(paging.robots_allows(F.col("s"), F.col("d")).alias("a")).collect()] == [False, True, True, False, False]


def test_counters(spark):
    sources = spark.createDataFrame([("a",), ("b",)], "source_id string")
    events = spark.createDataFrame([("a", "records_found", 3), ("a", "valid", 2), ("a", "rejected", 1)], "source_id string, counter string, n long")
    got = report.source_counters(sources, events)
    assert {r.source_id: (r.records_found, r.valid) for r in got.collect()} == {"a": (3, 2), "b": (0, 0)}
    assert report.unbalanced(got).count() == 0 and [r.valid for r in report.with_total(got).where("source_id is null").collect()] == [2]
    assert report.unbalanced(got.withColumn("valid", F.col("valid") + 1)).count() == 2
    many = spark.createDataFrame([(i, str(i)) for i in range(60)], "seq int, warning string")
    assert len(report.capped_warnings(many)) == 51 and date
