import csv
import dataclasses
import json
import threading
from datetime import UTC, datetime
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest

from orchardflow.cli import main
from orchardflow.operators.report import Unreconciled
from orchardflow.plans import run as plan
from orchardflow.schemas import PAGES
from orchardflow.sources.config import Config, ConfigError, Http, load_config
from orchardflow.sources.crawl import BrowserFetcher, CatalogueReader, Fetcher, FetchError, Page, PageStore, crawl, crawl_source, render_failure
from orchardflow.sources.css import Selector, SelectorError, parse
from orchardflow.sources.sinks import read_report, write_files, write_tables
from orchardflow.sources.state import read_state, write_state
from tests import catalogue

NOW = datetime(2026, 8, 24, 9, tzinfo=UTC)


@pytest.fixture(scope="module")
def config(tmp_path_factory) -> Config:
    path = tmp_path_factory.mktemp("c") / "c.yaml"
    path.write_text(catalogue.CONFIG)
    return load_config(path, {})


@pytest.fixture(scope="module")
def result(spark, config):
    return plan.run(spark, config, spark.createDataFrame(catalogue.rows(), PAGES), NOW)


def test_totals(result):
    r = result.report
    assert r["totals"] == {"pages_fetched": 8, "pages_failed": 1, "records_found": 22, "valid": 11, "rejected": 7, "duplicates_identical": 2, "duplicates_conflicting": 2}
    assert (r["exported"], r["exit_code"], len(r["warnings"])) == (11, 1, 1) and "Made to order" in r["warnings"][0]
    counts = {s["source_id"]: (*(s[c] for c in ("pages_fetched", "pages_failed", "records_found", "valid", "rejected", "duplicates_identical", "duplicates_conflicting")), s["stopped_because"]) for s in r["sources"]}
    assert counts == {
        "orchard": (3, 0, 16, 7, 7, 1, 1, "no_next_link"),
        "grove": (3, 0, 4, 3, 0, 1, 0, "empty_page"),
        "twin": (1, 0, 2, 1, 0, 0, 1, "single_page"),
        "barn": (1, 1, 0, 0, 0, 0, 0, "no_records"),
    }
    assert r["rejections_by_reason"] == {"listed_on:unparsable": 1, "price:missing": 1, "price:no_currency": 1, "price:unparsable": 1, "rating:unparsable": 1, "sku:missing": 1, "title:missing": 1}


def test_products(result):
    rows = result.products.collect()
    got = {r.sku: r for r in rows}
    assert [r.sku for r in rows][:4] == ["PL-310", "PL-311", "PL-312", "PL-313"] and len(got) == 11
    assert {k: (r.price.currency, r.price.minor, r.availability, r.rating, str(r.listed_on)) for k, r in got.items() if k < "PL-32"} == {
        "PL-310": ("EUR", 1840, "in_stock", 2.0, "2026-05-02"),
        "PL-311": ("EUR", 108000, "out_of_stock", 5.0, "2026-06-03"),
        "PL-312": ("GBP", 7450, "preorder", 1.0, "2026-05-09"),
        "PL-313": ("KRW", 125000, "discontinued", None, "2026-08-10"),
        "PL-314": ("USD", 900, "unknown", 0.0, "2026-08-24"),
    }
    assert got["PL-311"].title == "Pear & quince set" and got["PL-401"].price.currency == "BRL" and got["PL-401"].rating == 4.5
    assert got["PL-310"].url == "http://127.0.0.1:8090/item/pl-310"
    assert got["PL-501"].availability == "unknown" and not got["PL-501"].availability_present
    assert all(r.change == "unknown" for r in got.values())


def test_conflicts_and_failures(result):
    found = {(d.source_id, d.key): d for d in result.duplicates.collect()}
    d = found["orchard", "pl-312"]
    assert (d.kind, d.kept_values, d.dropped_values) == ("conflicting", {"price": "74.50 GBP"}, {"price": "79.50 GBP"})
    assert found["twin", "pl-310"].kept_source_id == "orchard" and found["grove", "pl-310"].kind == "identical"
    assert [(f.source_id, f.kind) for f in result.failures.collect()] == [("barn", "no_records")]


def test_missing_and_blank_are_told_apart(result):
    details = {r.raw_fields["title"].strip() or "blank": r.reasons[0].detail for r in result.rejected.collect()}
    assert "nothing on the page for .cost" == details["Hoe"] and "blank" in details["blank"] and "nothing on the page for code" == details["Rope"]


def test_files(result, tmp_path):
    written = write_files(result, tmp_path)
    assert len(written) == 9
    products = list(csv.DictReader((tmp_path / "products.csv").open(encoding="utf-8-sig")))
    assert (tmp_path / "products.csv").read_bytes().startswith(b"\xef\xbb\xbf") and products[1]["price_amount"] == "1080.00" and products[3]["rating"] == ""
    assert json.loads((tmp_path / "products.json").read_text())[3]["price"] == {"currency": "KRW", "amount": "125000", "minor_units": 125000, "minor_unit_digits": 0}
    assert json.loads((tmp_path / "duplicates.json").read_text())[0]["differing_fields"] in ([], ["price"])
    assert read_report(tmp_path / "run-report.json")["totals"]["valid"] == 11
    broken = json.loads((tmp_path / "run-report.json").read_text())
    broken["sources"][0]["valid"] += 1
    (tmp_path / "broken.json").write_text(json.dumps(broken))
    with pytest.raises(Unreconciled):
        read_report(tmp_path / "broken.json")
    assert "price:missing" in (tmp_path / "rejected.csv").read_text() and json.loads((tmp_path / "run-report.json").read_text())["exported"] == 11


def test_empty_run_writes_all_files(spark, config, tmp_path):
    r = plan.run(spark, config, spark.createDataFrame([], PAGES), NOW)
    write_files(r, tmp_path)
    assert (tmp_path / "products.csv").read_text(encoding="utf-8-sig").startswith("sku,title") and json.loads((tmp_path / "products.json").read_text()) == []
    assert r.report["exit_code"] == 1 and {s["stopped_because"] for s in r.report["sources"]} == {"not_started"}


def test_failed_page_is_not_an_empty_one(spark, config):
    rows = [catalogue.rows()[0], ("orchard", 2, "u", "u", None, 3, "static", None, "server_error", "HTTP 503", "page_failed")]
    r = plan.run(spark, config, spark.createDataFrame(rows, PAGES), NOW)
    assert [(f.kind, f.attempts) for f in r.failures.collect()] == [("server_error", 3)] and r.report["exit_code"] == 1
    assert r.report["sources"][0]["stopped_because"] == "page_failed" and r.report["exported"] == 5


def test_counters_that_disagree_publish_nothing(spark, config, monkeypatch):
    whole = plan.valid
    monkeypatch.setattr(plan, "valid", lambda rows: whole(rows).where("sku <> 'PL-310'"))
    with pytest.raises(Unreconciled):
        plan.run(spark, config, spark.createDataFrame(catalogue.rows(), PAGES), NOW)


def test_state_between_runs(spark, config, tmp_path):
    path = str(tmp_path / "state")
    pages = spark.createDataFrame(catalogue.rows(), PAGES)
    assert read_state(spark, None) is None
    first = plan.run(spark, config, pages, NOW, read_state(spark, path))
    assert first.report["changes"] == {"new": 11, "filtered_out": 0}
    write_state(spark, path, first.state, NOW)
    again = plan.run(spark, config, pages, NOW, read_state(spark, path), only_changed=True)
    assert again.report["changes"] == {"unchanged": 11, "filtered_out": 11} and again.report["exit_code"] == 1 and again.products.count() == 0
    write_state(spark, path, again.state, NOW.replace(hour=10))
    assert read_state(spark, path).count() == 11
    (tmp_path / "state" / "meta-00000003.json").write_text("{broken")
    with pytest.raises(ConfigError):
        read_state(spark, path)


def test_keep_last_run(spark, config):
    last = dataclasses.replace(config, dedupe=dataclasses.replace(config.dedupe, on_conflict="keep_last"))
    r = plan.run(spark, last, spark.createDataFrame(catalogue.rows(), PAGES), NOW)
    got = r.products.collect()
    assert got[0].price.minor == 1790 and got[0].sku == "PL-310" and r.report["totals"]["valid"] == 11


def test_tables_and_stream(spark, config, tmp_path, result):
    from orchardflow.streaming import incremental

    write_tables(result, str(tmp_path / "t"))
    assert spark.read.option("header", True).csv(str(tmp_path / "t/products.csv")).count() == 11
    spark.createDataFrame(catalogue.rows(), PAGES).coalesce(1).write.parquet(str(tmp_path / "in"))
    live = dataclasses.replace(config, run=dataclasses.replace(config.run, state_file=str(tmp_path / "s")))
    for _ in range(2):
        incremental.start(spark.readStream.schema(PAGES).parquet(str(tmp_path / "in")), live, str(tmp_path / "out"), str(tmp_path / "cp"), once=True).awaitTermination()
    assert spark.read.json(str(tmp_path / "out/batch=0/products.json")).count() == 11
    assert read_state(spark, str(tmp_path / "s")).count() == 11


@pytest.fixture
def site():
    hits: dict[str, int] = {}

    class Site(BaseHTTPRequestHandler):
        def do_GET(self):
            path = self.path
            hits[path] = hits.get(path, 0) + 1
            status, body, headers = 404, "", {}
            if path == "/robots.txt":
                status, body = 200, "User-agent: *\nDisallow: /private"
            elif path.startswith("/unsteady") and hits[path] < 3:
                status = 503
            elif path == "/limited" and hits[path] == 1:
                status, headers = 429, {"Retry-After": "1"}
            elif path in ("/limited", "/private/x"):
                status, body = 200, "ok"
            else:
                for s, n in catalogue.ROWS:
                    if path == catalogue.URLS[s].format(n):
                        status, body = 200, catalogue.page(s, n)
            data = body.encode()
            self.send_response(status)
            for k, v in headers.items():
                self.send_header(k, v)
            self.send_header("Content-Type", "text/html; charset=utf-8")
            self.send_header("Content-Length", str(len(data)))
            self.end_headers()
            self.wfile.write(data)

        def log_message(self, *a):
            pass

    server = ThreadingHTTPServer(("127.0.0.1", 0), Site)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}", hits
    server.shutdown()


def fetcher(**more):
    waits: list[float] = []
    return Fetcher(Http(max_attempts=3, backoff_base_seconds=0.1, backoff_max_seconds=1.0, delay_seconds=0.0, timeout_seconds=2.0, **more), sleep=waits.append), waits


def test_retries(site):
    base, hits = site
    f, waits = fetcher()
    assert f.fetch(f"{base}/unsteady/twin").attempts == 3 and waits == [0.1, 0.2]
    f, waits = fetcher()
    assert f.fetch(f"{base}/limited").attempts == 2 and waits == [1.0]
    with pytest.raises(FetchError) as wrong:
        f.fetch(f"{base}/nowhere")
    assert wrong.value.kind == "client_error" and hits["/nowhere"] == 1
    with pytest.raises(FetchError) as wrong:
        f.fetch(f"{base}/private/x")
    assert wrong.value.kind == "robots_disallowed" and "/private/x" not in hits
    with pytest.raises(FetchError) as wrong:
        Fetcher(f.http.__class__(max_attempts=1, respect_robots=False)).fetch("http://127.0.0.1:9/x")
    assert wrong.value.kind == "connection_error"


def test_spacing():
    now, waits = [0.0], []
    f = Fetcher(Http(delay_seconds=0.5, respect_robots=False), clock=lambda: now[0], sleep=waits.append)
    f._get = lambda url: (url, 200, "", None)
    f.fetch("http://a/1")
    f.fetch("http://a/2")
    f.fetch("http://b/1")
    assert waits == [0.5]


def test_crawl_and_command_line(spark, site, tmp_path, monkeypatch, capsys):
    base, hits = site
    path = tmp_path / "c.yaml"
    path.write_text(catalogue.CONFIG.replace("${BASE:-http://127.0.0.1:8090}", base).replace("output_dir: out", f"output_dir: {tmp_path}/out"))
    config = load_config(path)
    pages = crawl(spark, config).collect()
    got = {}
    for r in pages:
        got.setdefault(r.source_id, []).append((r.page_no, r.attempts, r.error_kind, r.stopped_because))
    assert got["orchard"] == [(1, 1, None, None), (2, 1, None, None), (3, 1, None, "no_next_link")]
    assert got["grove"] == [(1, 1, "browser_unavailable", "page_failed")] and got["barn"] == [(1, 1, None, "no_records")]
    js = dataclasses.replace(config.source("grove"), kind="static", wait_for_selector=None)
    f, _ = fetcher()
    assert [(r[1], r[-1]) for r in crawl_source(js, f.fetch)] == [(1, None), (2, None), (3, "empty_page")]
    assert main(["validate", "--config", str(path)]) == 0 and "grove" in capsys.readouterr().out
    assert main(["scrape", "--config", str(path), "--source", "twin", "--now", "2026-08-24T09:00:00+00:00"]) == 0
    assert len(list(csv.DictReader((tmp_path / "out/products.csv").open(encoding="utf-8-sig")))) == 2
    assert main(["scrape", "--config", str(path), "--source", "twin", "--tables", "--output-dir", str(tmp_path / "folders"), "--now", "2026-08-24T09:00:00+00:00"]) == 0
    assert spark.read.json(str(tmp_path / "folders/products.json")).count() == 2 and json.loads((tmp_path / "folders/run-report.json").read_text())["exported"] == 2
    before = dict(hits)
    assert main(["scrape", "--config", str(path), "--events", str(tmp_path / "events"), "--output-dir", str(tmp_path / "again"), "--now", "2026-08-24T09:00:00+00:00"]) == 1
    assert {n - before.get(path, 0) for path, n in hits.items()} <= {0, 1, 2}  # robots.txt once for each of two kinds of fetchers, a page once
    assert all(n - before.get(path, 0) <= 1 for path, n in hits.items() if path != "/robots.txt")
    events = spark.read.json(str(tmp_path / "events")).groupBy("event").count().collect()
    assert {r.event: r["count"] for r in events} == {"page fetched": 5, "page failed": 1, "pagination stopped": 4, "record rejected": 7, "duplicate dropped": 3}
    said = capsys.readouterr().err
    assert all(x in said for x in ("source started", "pagination stopped", "run finished"))
    assert main(["scrape", "--config", str(path), "--source", "nobody"]) == 2
    assert main(["scrape", "--config", str(path), "--only-changed"]) == 2


def test_a_killed_crawl_goes_on(spark, site, tmp_path):
    """A read that ends after two pages, then another, then a Spark job: each page is fetched once; stored failures only if asked."""
    base, hits = site
    path = tmp_path / "c.yaml"
    path.write_text(catalogue.CONFIG.replace("${BASE:-http://127.0.0.1:8090}", base))
    config, store = load_config(path).only(["orchard", "twin", "barn"]), f"file://{tmp_path}/store"
    reader = CatalogueReader(config, store)
    killed = reader.read(reader.partitions()[0])
    first = [next(killed) for _ in range(2)]
    killed.close()
    before = dict(hits)
    rows = list(CatalogueReader(config, store).read(reader.partitions()[0]))
    assert [r[:6] for r in rows[:2]] == [r[:6] for r in first] and rows[0][7] == first[0][7]
    fetched = {p for p in hits if not p.endswith("robots.txt")}
    assert len(rows) == 5 and all(before.get(p, 0) in (0, hits[p]) for p in fetched) and any(before.get(p) for p in fetched)
    after = dict(hits)
    assert sorted(map(str, crawl(spark, config, store).drop("html").collect())) == sorted(map(str, crawl(spark, config, store).drop("html").collect()))
    assert {p: n for p, n in hits.items() if not p.endswith("robots.txt")} == {p: n for p, n in after.items() if not p.endswith("robots.txt")}
    pages = PageStore(store)

    def fail(url):
        raise FetchError("server_error", "HTTP 503", 3)

    for again in (False, True):
        with pytest.raises(FetchError) as wrong:
            pages.kept("s", fail, again)("http://x/1")
        assert (wrong.value.kind, wrong.value.attempts) == ("server_error", 3)
    with pytest.raises(FetchError, match="503"):
        pages.kept("s", lambda url: Page(url, "late", 200, 1))("http://x/1")
    assert pages.kept("s", lambda url: Page(url, "late", 200, 1), True)("http://x/1").html == "late" == pages.get("s", "http://x/1").html
    assert pages.get("other", "http://x/1") is None and not [x for x in (tmp_path / "store").iterdir() if x.suffix != ".json"]


class FakeBrowser:
    def __init__(self, status=200, error=None):
        self.status, self.error, self.closed, self.open_tabs = status, error, False, 0

    def new_page(self, user_agent):
        if self.error == "tab":
            raise OSError("no tab")
        self.open_tabs += 1
        return self

    def goto(self, url, wait_until, timeout):
        self.url = url
        return self

    def wait_for_selector(self, selector, state, timeout):
        if self.error:
            raise type(self.error, (Exception,), {})("late")

    def content(self):
        return "<p>made</p>"

    def close(self):
        if self.open_tabs:
            self.open_tabs -= 1
        else:
            self.closed = True


def test_browser():
    polite = Fetcher(Http(respect_robots=False, delay_seconds=0.0))
    from orchardflow.sources.config import Browser

    fake = FakeBrowser()
    b = BrowserFetcher(polite, Browser(), lambda: fake)
    page = b.fetch("http://x/1", ".r")
    assert (page.html, page.attempts, page.fetched_with, fake.open_tabs) == ("<p>made</p>", 1, "browser", 0)
    b.close()
    assert fake.closed
    for made, kind in ((FakeBrowser(429), "client_error"), (FakeBrowser(502), "server_error"), (FakeBrowser(error="TimeoutError"), "timeout"), (FakeBrowser(error="Crash"), "connection_error"), (FakeBrowser(error="tab"), "connection_error")):
        with pytest.raises(FetchError) as wrong:
            BrowserFetcher(polite, Browser(), lambda made=made: made).fetch("http://x/1", ".r")
        assert (wrong.value.kind, made.open_tabs) == (kind, 0)
    with pytest.raises(FetchError) as wrong:
        BrowserFetcher(polite, Browser(enabled=False)).fetch("http://x/1")
    assert wrong.value.kind == "browser_unavailable" and render_failure("TimeoutError", ".r", "u")[1].startswith("'.r'")


def test_loop_is_found():
    page = type("P", (), {})
    config = dataclasses.replace(SOURCE, pagination=dataclasses.replace(SOURCE.pagination, strategy="next_link", next_selector="a.next"))

    def fetch(url):
        p = page()
        p.url, p.status, p.attempts, p.fetched_with = url, 200, 1, "static"
        p.html = f"<p class=r></p><a class=next href='http://x/{1 - int(url[-1])}'>n</a>"
        return p

    rows = list(crawl_source(dataclasses.replace(config, start_url="http://x/0"), fetch))
    assert [r[2] for r in rows] == ["http://x/0", "http://x/1"] and rows[-1][-1] == "loop_detected"


from orchardflow.sources.config import Mapping, Source  # noqa: E402

SOURCE = Source("s", "http://x/0", ".r", {k: Mapping(".a") for k in ("sku", "title", "price", "url")})

BAD = [
    ("version: 2\nsources: [{S}]", "version"),
    ("run: {typo_format: json}\nsources: [{S}]", "typo_format"),
    ("sources: []", "sources"),
    ("sources: [{S}, {S}]", "duplicate"),
    ("http: {backoff_base_seconds: 5, backoff_max_seconds: 1}\nsources: [{S}]", "backoff_max"),
    ("dedupe: {key_fields: [colour]}\nsources: [{S}]", "colour"),
    ("url: '${MISSING}/x'", "MISSING"),
    ("sources: [{id: a, start_url: 'http://x', record_selector: 'p[', fields: F}]", "selector"),
    ("sources: [{id: a, kind: browser, start_url: 'http://x', record_selector: p, fields: F}]", "wait_for"),
    ("sources: [{id: a, start_url: 'ftp://x', record_selector: p, fields: F}]", "start_url"),
    ("sources: [{id: a, start_url: 'http://x', record_selector: p, fields: {sku: {selector: p}}}]", "required"),
    ("sources: [{id: a, start_url: 'http://x', record_selector: p, fields: F, pagination: {strategy: next_link}}]", "next_selector"),
    ("- a", "mapping"),
    ("http: {timeout_seconds: soon}\nsources: [{S}]", "timeout"),
]


@pytest.mark.parametrize("body,says", BAD)
def test_bad_configs(tmp_path, body, says):
    fields = "{sku: {selector: p}, title: {selector: p}, price: {selector: p}, url: {selector: p}}"
    source = f"{{id: a, start_url: 'http://x', record_selector: p, fields: {fields}}}"
    (tmp_path / "c.yaml").write_text(body.replace("{S}", source).replace("fields: F", f"fields: {fields}"))
    with pytest.raises(ConfigError, match=says):
        load_config(tmp_path / "c.yaml", {})


def test_environment(tmp_path):
    (tmp_path / "c.yaml").write_text(catalogue.CONFIG)
    found = load_config(tmp_path / "c.yaml", {"BASE": "http://127.0.0.1:9123"})
    assert found.source("orchard").start_url.startswith("http://127.0.0.1:9123/") and found.http.max_attempts == 3 and len(found.sha256) == 64
    with pytest.raises(KeyError):
        found.source("nobody")


SELECTORS = [("li.a", ["x"]), ("#z p b", ["s"]), ("div[data-k=v]", ["t"]), ("ul > li:nth-child(2) > p + p", ["r s"]), ("li:not(.a)", ["q r s"]), ("b, div", ["s", "t"]), ("p ~ p", ["r s"]), ("[data-k^=v], li:first-child", ["x", "t"]), ("*[class~=b]", ["x"])]


@pytest.mark.parametrize("selector,texts", SELECTORS)
def test_selectors(selector, texts):
    root = parse('<ul><li class="a b">x<li id=z><p>q<p>r<b>s</b></ul><div data-k="v">t</div>')
    assert [e.text() for e in Selector(selector).all(root)] == texts


@pytest.mark.parametrize("selector", ["", "p[", ">p", "p >", "..a", "p:hover", "a,,b"])
def test_bad_selectors(selector):
    with pytest.raises(SelectorError):
        Selector(selector)
