"""Fetching pages: a polite HTTP fetcher, and a Spark data source whose partitions are hosts, so that spacing holds within each."""

from __future__ import annotations

import dataclasses
import hashlib
import json
import logging
import socket
import time
import urllib.error
import urllib.parse
import urllib.request
import urllib.robotparser
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from orchardflow.operators.extract import PageReader
from orchardflow.schemas import PAGES
from orchardflow.sources.config import Browser, Config, Http, Source

log = logging.getLogger("orchardflow")
RETRYABLE = ("timeout", "connection_error", "rate_limited", "server_error")


class FetchError(Exception):
    def __init__(self, kind: str, message: str, attempts: int = 1, retry_after: float | None = None) -> None:
        super().__init__(message)
        self.kind, self.attempts, self.retry_after = kind, attempts, retry_after


@dataclass(frozen=True)
class Page:
    url: str
    html: str
    status: int
    attempts: int
    fetched_with: str = "static"


def kind_of(status: int) -> str | None:
    if status < 400:
        return None
    return "rate_limited" if status == 429 else "server_error" if status >= 500 else "client_error"


def seconds_of(header: str | None) -> float | None:
    try:
        found = float((header or "").strip())
    except ValueError:
        return None
    return found if 0 <= found < float("inf") else None


@dataclass
class Fetcher:
    """Fetches with spacing by host, robots rules by origin, and retries with doubling waits."""

    http: Http
    clock: Callable[[], float] = time.monotonic
    sleep: Callable[[float], None] = time.sleep
    last: dict[str, float] = field(default_factory=dict)
    rules: dict[str, urllib.robotparser.RobotFileParser | bool] = field(default_factory=dict)

    def _get(self, url: str) -> tuple[str, int, str, str | None]:
        """(final URL, status, body, Retry-After), or FetchError if there was no response."""
        request = urllib.request.Request(url, headers={"User-Agent": self.http.user_agent})
        try:
            with urllib.request.urlopen(request, timeout=self.http.timeout_seconds) as r:
                return r.geturl(), r.status, r.read().decode(r.headers.get_content_charset() or "utf-8", "replace"), None
        except urllib.error.HTTPError as r:
            return url, r.code, "", r.headers.get("Retry-After")
        except (TimeoutError, socket.timeout) as wrong:
            raise FetchError("timeout", f"no answer from {url} in {self.http.timeout_seconds} s") from wrong
        except (OSError, urllib.error.URLError) as wrong:
            kind = "timeout" if isinstance(getattr(wrong, "reason", None), TimeoutError) else "connection_error"
            raise FetchError(kind, f"{url}: {wrong}") from wrong

    def allowed(self, url: str) -> bool:
        """By the origin's robots.txt, read once: absent allows all, a server error or no answer denies all."""
        parts = urllib.parse.urlsplit(url)
        origin = f"{parts.scheme}://{parts.netloc}"
        if origin not in self.rules:
            try:
                _, status, body, _ = self._get(f"{origin}/robots.txt")
                if status < 300:
                    parser = urllib.robotparser.RobotFileParser()
                    parser.parse(body.splitlines())
                    self.rules[origin] = parser
                else:
                    self.rules[origin] = 400 <= status < 500
            except FetchError:
                self.rules[origin] = False
        rule = self.rules[origin]
        return rule if isinstance(rule, bool) else rule.can_fetch(self.http.user_agent, url)

    def _space(self, url: str) -> None:
        host = urllib.parse.urlsplit(url).netloc
        if host in self.last:
            wait = self.http.delay_seconds - (self.clock() - self.last[host])
            if wait > 0:
                self.sleep(wait)
        self.last[host] = self.clock()

    def fetch(self, url: str) -> Page:
        if self.http.respect_robots and not self.allowed(url):
            raise FetchError("robots_disallowed", f"robots.txt does not allow {url}", 0)
        attempt = 0
        while True:
            attempt += 1
            self._space(url)
            try:
                final, status, body, after = self._get(url)
                kind = kind_of(status)
                if kind is None:
                    return Page(final, body, status, attempt)
                raise FetchError(kind, f"HTTP {status} from {url}", attempt, seconds_of(after))
            except FetchError as wrong:
                wrong.attempts = attempt
                if wrong.kind not in RETRYABLE or attempt >= self.http.max_attempts:
                    raise
                log.info("page fetch tried again", extra={"data": {"url": url, "attempt": attempt, "kind": wrong.kind}})
                wait = min(self.http.backoff_base_seconds * 2 ** (attempt - 1), self.http.backoff_max_seconds)
                self.sleep(max(wait, wrong.retry_after or 0.0))


class BrowserFetcher:
    """Pages as a browser renders them, one attempt each, under the HTTP fetcher's spacing, robots rules and name.

    ``launch`` gives a browser with ``new_page(user_agent=...)`` and ``close()``; without it Playwright's Chromium is used where it is
    installed. It starts with the first page. A browser that is switched off or does not start fails its pages as ``browser_unavailable``.
    """

    def __init__(self, polite: Fetcher, settings: Browser, launch: Callable | None = None) -> None:
        self.polite, self.settings, self.launch = polite, settings, launch
        self.browser = None
        self.driver = None

    def _started(self):
        if not self.settings.enabled:
            raise FetchError("browser_unavailable", "the browser is switched off")
        if self.browser is None:
            try:
                if self.launch is None:
                    from playwright.sync_api import sync_playwright

                    self.driver = sync_playwright().start()
                    self.browser = self.driver.chromium.launch(headless=self.settings.headless)
                else:
                    self.browser = self.launch()
                log.info("browser launched")
            except Exception as wrong:
                raise FetchError("browser_unavailable", f"the browser did not start: {wrong}") from wrong
        return self.browser

    def fetch(self, url: str, wait_for: str | None = None) -> Page:
        browser = self._started()
        if self.polite.http.respect_robots and not self.polite.allowed(url):
            raise FetchError("robots_disallowed", f"robots.txt does not allow {url}", 0)
        self.polite._space(url)
        limit, tab, waiting = self.settings.timeout_seconds * 1000, None, False
        try:
            tab = browser.new_page(user_agent=self.polite.http.user_agent)
            answer = tab.goto(url, wait_until="domcontentloaded", timeout=limit)
            status = answer.status if answer else 200
            if status >= 400:
                raise FetchError("server_error" if status >= 500 else "client_error", f"HTTP {status} from {url}")
            if wait_for:
                waiting = True
                tab.wait_for_selector(wait_for, state="attached", timeout=limit)
            return Page(tab.url, tab.content(), status, 1, "browser")
        except FetchError:
            raise
        except Exception as wrong:
            raise FetchError(*render_failure(type(wrong).__name__, wait_for if waiting else None, url)) from wrong
        finally:
            if tab is not None:
                _quietly(tab.close)

    def close(self) -> None:
        for what in (self.browser and self.browser.close, self.driver and self.driver.stop):
            if what:
                _quietly(what)
        self.browser = self.driver = None


def _quietly(close: Callable) -> None:
    try:
        close()
    except Exception as wrong:
        log.warning("close failed: %s", wrong)


def render_failure(error: str, selector: str | None, url: str) -> tuple[str, str]:
    """(kind, message) of a renderer's error, by its name."""
    if "Timeout" in error:
        return "timeout", f"{selector!r} did not appear on {url}" if selector else f"{url} did not load in time"
    return "connection_error", f"{url}: {error}"


class PageStore:
    """Fetched pages and failures of one crawl in a shared folder, a small file each, written as they come.

    A task that starts again, or a run that goes on with the folder, takes from here what was fetched before. A file appears by one rename, so it is whole or not there.
    """

    def __init__(self, path: str) -> None:
        from pyarrow import fs

        self.store, self.base = fs.FileSystem.from_uri(path)
        self.store.create_dir(self.base, recursive=True)

    def _at(self, source_id: str, url: str) -> str:
        return f"{self.base}/{hashlib.sha256(json.dumps([source_id, url]).encode()).hexdigest()}.json"

    def get(self, source_id: str, url: str) -> Page | FetchError | None:
        try:
            with self.store.open_input_stream(self._at(source_id, url)) as file:
                found = json.loads(file.read())
        except FileNotFoundError:
            return None
        return Page(**found["page"]) if "page" in found else FetchError(*found["failure"])

    def put(self, source_id: str, url: str, what: Page | FetchError) -> None:
        told = {"page": dataclasses.asdict(what)} if isinstance(what, Page) else {"failure": [what.kind, str(what), what.attempts]}
        path = self._at(source_id, url)
        new = f"{path}.{uuid.uuid4().hex}"
        with self.store.open_output_stream(new) as file:
            file.write(json.dumps(told).encode())
        self.store.move(new, path)

    def kept(self, source_id: str, fetch: Callable[[str], Page], again: bool = False) -> Callable[[str], Page]:
        """``fetch``, but a stored page is not fetched anew; nor a stored failure, unless ``again``."""

        def one(url: str) -> Page:
            found = self.get(source_id, url)
            if isinstance(found, FetchError) and not again:
                raise found
            if isinstance(found, Page):
                return found
            try:
                page = fetch(url)
            except FetchError as wrong:
                self.put(source_id, url, wrong)
                raise
            self.put(source_id, url, page)
            return page

        return one


def with_parameter(url: str, name: str, value: int) -> str:
    parts = urllib.parse.urlsplit(url)
    query = [*((k, v) for k, v in urllib.parse.parse_qsl(parts.query) if k != name), (name, str(value))]
    return urllib.parse.urlunsplit(parts._replace(query=urllib.parse.urlencode(query)))


def crawl_source(source: Source, fetch: Callable[[str], Page]) -> Iterator[tuple]:
    """Rows of ``schemas.PAGES`` for one source, page after page until its pagination ends."""
    reader, paging = PageReader(source), source.pagination
    by_param = paging.strategy == "page_param"
    url: str | None = with_parameter(source.start_url, paging.page_param, paging.start_page) if by_param else source.start_url
    number, full, seen = paging.start_page, 0, set()
    while url is not None:
        seen.add(url)
        try:
            page = fetch(url)
        except FetchError as wrong:
            log.warning("page failed", extra={"data": {"source_id": source.id, "url": url, "kind": wrong.kind, "attempts": wrong.attempts}})
            yield source.id, number, url, url, None, wrong.attempts, source.kind, None, wrong.kind, str(wrong), "page_failed"
            return
        found, link = reader.read(page.html, page.url)
        following, why = None, None
        if not found:
            why = "empty_page" if full else "no_records"
        elif paging.strategy == "none":
            why = "single_page"
        else:
            full += 1
            following = with_parameter(source.start_url, paging.page_param, number + 1) if by_param else link
            why = "no_next_link" if following is None else "max_pages" if full >= paging.max_pages else "loop_detected" if following in seen else None
        log.info("page fetched", extra={"data": {"source_id": source.id, "url": page.url, "records": len(found), "attempts": page.attempts}})
        yield source.id, number, url, page.url, page.status, page.attempts, page.fetched_with, page.html, None, None, why
        url = following if why is None else None
        number += 1


class _HostPartition(InputPartition):
    def __init__(self, sources: list[Source]) -> None:
        self.sources = sources


class CatalogueReader(DataSourceReader):
    """A partition a host. With ``store`` a task that is tried again goes on where the last attempt was; ``again`` tries stored failures anew."""

    def __init__(self, config: Config, store: str | None = None, again: bool = False) -> None:
        self.config, self.store, self.again = config, store, again

    def partitions(self) -> list[InputPartition]:
        hosts: dict[str, list[Source]] = {}
        for s in self.config.sources:
            hosts.setdefault(urllib.parse.urlsplit(s.start_url).netloc, []).append(s)
        return [_HostPartition(x) for x in hosts.values()]

    def read(self, partition: _HostPartition) -> Iterator[tuple]:
        fetcher = Fetcher(self.config.http)
        browser = BrowserFetcher(fetcher, self.config.browser)
        store = PageStore(self.store) if self.store else None
        try:
            for source in partition.sources:
                fetch = (lambda url, s=source: browser.fetch(url, s.wait_for_selector)) if source.kind == "browser" else fetcher.fetch
                yield from crawl_source(source, store.kept(source.id, fetch, self.again) if store else fetch)
        finally:
            browser.close()


class CatalogueSource(DataSource):
    """``spark.read.format("catalogue").option("config", path)``."""

    @classmethod
    def name(cls) -> str:
        return "catalogue"

    def schema(self):
        return PAGES

    def reader(self, schema) -> DataSourceReader:
        from orchardflow.sources.config import load_config

        config = load_config(self.options["config"])
        only = self.options.get("sources")
        return CatalogueReader(config.only(json.loads(only)) if only else config, self.options.get("store"), self.options.get("again") == "true")


def crawl(spark: SparkSession, config: Config, store: str | None = None, again: bool = False) -> DataFrame:
    """The pages of all sources, fetched by the executors: one task for each host.

    ``store``, a folder that all executors share, keeps what is fetched: lost tasks and later calls fetch none of it again, but for failures if ``again``.
    """
    spark.dataSource.register(CatalogueSource)
    reader = spark.read.format("catalogue").option("config", config.path).option("sources", json.dumps([s.id for s in config.sources]))
    return (reader.options(store=store, again=str(again).lower()) if store else reader).load()


def rendered_pages(spark: SparkSession, path: str) -> DataFrame:
    """Pages fetched or rendered elsewhere, as Parquet with the columns of ``schemas.PAGES``; absent ones are null."""
    found = spark.read.parquet(path)
    from pyspark.sql import functions as F

    return found.select(*(F.col(f.name).cast(f.dataType) if f.name in found.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in PAGES))
