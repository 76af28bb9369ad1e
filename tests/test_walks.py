"""Long page walks, and keys with very many records."""

import random

import pytest
from pyspark.sql import functions as F

from orchardflow.operators import dedupe, paging
from tests.test_functions import PRODUCT, product


def walked(links, start, most):
    """The same page by page."""
    out = []
    for source, url in start:
        seen = set()
        for n in range(1, most + 1):
            seen.add(url)
            there, following = (source, url) in links, links.get((source, url))
            why = "page_failed" if not there else "no_next_link" if following is None else "loop_detected" if following in seen else "max_pages" if n == most else None
            out.append((source, n, url, why))
            if why:
                break
            url = following
    return sorted(out)


@pytest.mark.parametrize("most", [1, 2, 3, 8, 1000])
def test_walks_of_all_shapes(spark, most):
    rng = random.Random(most)
    links, start = {}, []
    for s in range(60):
        n = rng.choice([1, 2, 3, 5, 8, 17, 60])
        for i in range(n):
            links[f"s{s}", f"u{i}"] = f"u{i + 1}" if i + 1 < n else rng.choice([None, "gone", f"u{rng.randrange(n)}", f"u{n - 1}"])
        start.append((f"s{s}", rng.choice(["u0", "u0", f"u{rng.randrange(n)}", "nowhere"])))
    rows = [(*k, v) for k, v in links.items()] + [("other", "u0", "u1"), ("s1", None, "u1"), (None, "u0", "u1"), ("s1", "u0", links["s1", "u0"])]
    got = paging.follow(spark.createDataFrame(rows, "source_id string, url string, next_url string"), spark.createDataFrame([*start, ("s2", None)], "source_id string, url string"), most)
    assert sorted(map(tuple, got.collect())) == walked(links, start, most)


def test_ten_thousand_pages_in_few_rounds(spark, monkeypatch):
    """A chain and a loop of 10,000 pages: the rounds are logarithmic."""
    n, rounds = 10_000, []
    monkeypatch.setattr(paging, "discard", lambda df: rounds.append(df))
    pages = spark.range(n).select(F.explode(F.array(F.lit("chain"), F.lit("loop"))).alias("source_id"), "id")
    last = F.when(F.col("source_id") == "loop", "p123")
    links = pages.select("source_id", F.concat(F.lit("p"), F.col("id")).alias("url"), F.when(F.col("id") < n - 1, F.concat(F.lit("p"), F.col("id") + 1)).otherwise(last).alias("next_url"))
    got = paging.follow(links, spark.createDataFrame([("chain", "p0"), ("loop", "p0")], "source_id string, url string"), 20_000).cache()
    assert got.where(F.concat(F.lit("p"), F.col("page_no") - 1) != F.col("url")).isEmpty() and got.count() == 2 * n
    assert {(r.source_id, r.page_no, r.stopped_because) for r in got.where("stopped_because is not null").collect()} == {("chain", n, "no_next_link"), ("loop", n, "loop_detected")}
    assert len(rounds) < 32
    got.unpersist()


def test_cap_is_cut_before_the_shuffle(spark):
    pages = spark.range(3000).select((F.col("id") % 2).cast("string").alias("source_id"), F.col("id").alias("page_no"), (F.col("id") % 2 + 2).alias("most"))
    got = paging.capped(pages, F.col("most"))
    assert sorted((r.source_id, r.page_no) for r in got.collect()) == [("0", 0), ("0", 2), ("1", 1), ("1", 3), ("1", 5)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan.split("Exchange")[-1] and "WindowGroupLimit" in plan.split("Exchange")[-1]


@pytest.mark.parametrize("many", [0, 3, 50, 10**6])
def test_keep_last_in_ranges(spark, many):
    rng = random.Random(5)
    rows = [product(rng.choice("aaaaabcdefgh"), minor=rng.randrange(4)) for _ in range(400)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"n int, {PRODUCT}").repartition(7)
    df = df.withColumn("key", F.col("sku")).withColumn("seq", F.struct(F.lit(0).alias("s"), F.col("n").alias("n")))
    last, first, want = {}, {}, []
    for i, r in enumerate(rows):
        want.append((i, last.get(r[1]), first.setdefault(r[1], i)))
        last[r[1]] = r[3][1]
    got = dedupe.pair_up(df, "keep_last", many=many)
    assert sorted(((r.n, r.other and r.other.price.minor, r.first_seq.n) for r in got.collect()), key=lambda x: x[0]) == want
    ends = {r[1]: i for i, r in enumerate(rows)}
    assert {r.sku: r.n for r in dedupe.survivors(got).collect()} == ends
    assert dedupe.duplicates(got, "keep_last").count() == 400 - len(ends)


def test_a_hot_key_is_dealt_over_tasks(spark):
    hot = spark.range(200_000).select(F.lit("k").alias("key"), F.struct(F.col("id").alias("n")).alias("seq"), *(F.lit("x").alias(c) for c in ("sku", "title", "availability", "category", "url", "source_id")), F.struct(F.lit("GBP").alias("currency"), (F.col("id") % 3).alias("minor")).alias("price"), F.lit(1.0).alias("rating"), F.current_date().alias("listed_on"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranged = dedupe.pair_up(hot, "keep_last", many=1000)
        plan = ranged._jdf.queryExecution().optimizedPlan().toString()
        assert "_range" in plan
        told = ranged.agg(F.count("other").alias("others"), F.sum(F.col("survives").cast("int")).alias("left"), F.sum((F.col("other.price.minor") == (F.col("price.minor") + 2) % 3).cast("int")).alias("before")).first()
        assert (told.others, told.left, told.before) == (199_999, 1, 199_999)
        parts = ranged.groupBy(F.spark_partition_id()).count().count()
        assert parts > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_robots_rules_as_the_crawler_has_them(spark):
    """Random files against the parser that the crawler uses, which takes the first rule that fits."""
    import urllib.robotparser

    rng = random.Random(2)
    lines = ["User-agent: *", "User-agent: orchard", "user-agent: other # x", "User-agent: bot", "Disallow: /a", "Allow: /a/b", "Disallow:", "Allow: /", "Disallow: /a?x=%31", "Disallow: /caf%C3%A9", "Crawl-delay: 2", "", "", "# note", "   ", "Sitemap: /s", "nonsense", "Allow: /a b"]
    bodies = ["\n".join(rng.choice(lines) for _ in range(rng.randint(0, 14))) for _ in range(120)]
    paths = ["", "/", "/a", "/a/b", "/a/bc?q", "/a?x=1", "/b", "/caf%c3%a9/x", "/a%20b", "/a+b", "?x", "/a#f", "/%zz"]
    files = spark.createDataFrame([(f"http://h{i}.test", 200, x) for i, x in enumerate(bodies)], "origin string, status int, body string")
    urls = spark.createDataFrame([(i, f"http://H{i}.test{p}", p) for i in range(len(bodies)) for p in paths], "i int, url string, p string")
    got = paging.robots_verdicts(urls, files, "OrchardBot/2.1").collect()
    for r in got:
        parser = urllib.robotparser.RobotFileParser()
        parser.parse(bodies[r.i].splitlines())
        assert r.allowed == parser.can_fetch("OrchardBot/2.1", r.url), (bodies[r.i], r.p)
    assert len(got) == len(bodies) * len(paths) and len({r.allowed for r in got}) == 2


def test_longest_rule_and_missing_files(spark):
    body = "User-agent: *\nDisallow: /a\nAllow: /a/b\nDisallow: /a/b/c\nAllow: /a/b/c"
    files = spark.createDataFrame([("http://x", 200, body), ("http://gone", 404, None), ("http://down", 500, body), ("http://empty", 200, None)], "origin string, status int, body string")
    urls = spark.createDataFrame([(u,) for u in ("http://x/a/b", "http://x/a/b/c", "http://x/a", "http://gone/a", "http://down/z", "http://unknown/", "http://empty/a", None)], "url string")
    told = lambda longest: {r.url: r.allowed for r in paging.robots_verdicts(urls, files, "bot", longest).collect()}
    always = {"http://gone/a": True, "http://down/z": False, "http://unknown/": False, "http://empty/a": True, None: False}
    assert told(False) == always | {"http://x/a/b": False, "http://x/a/b/c": False, "http://x/a": False}
    assert told(True) == always | {"http://x/a/b": True, "http://x/a/b/c": True, "http://x/a": False}
