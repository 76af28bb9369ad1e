"""Pages to raw records: one parse of each page gives its records and its next link."""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orchardflow.sources.config import Config, Source
from orchardflow.sources.css import Element, Selector, parse


#: Pages whose trees and records are held at once; bounds a worker's memory.
FEW = 64


def few(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of ``FEW`` rows at most."""
    for batch in batches:
        for at in range(0, batch.num_rows, FEW):
            yield batch.slice(at, FEW)


def read_field(element: Element, selector: Selector, attr: str | None) -> str | None:
    """The first match's text or attribute; None for no match or attribute, a string that may be empty otherwise."""
    return _read(selector.first(element), attr)


def _read(found: Element | None, attr: str | None) -> str | None:
    if found is None:
        return None
    if attr is None:
        return found.text()
    value = found.attributes.get(attr.lower())
    return " ".join(value.split()) if value is not None and attr.lower() == "class" else value


def next_link(root: Element, selector: Selector | None, page_url: str) -> str | None:
    """The absolute http(s) URL of the next page; None where there is no such link."""
    found = selector.first(root) if selector else None
    href = (found.attributes.get("href", "") if found else "").strip()
    if not href or href.startswith("#"):
        return None
    try:
        full = urljoin(page_url, href)
    except ValueError:
        return None
    return full if full.lower().startswith(("http://", "https://")) else None


class PageReader:
    """A source's selectors, compiled."""

    def __init__(self, source: Source) -> None:
        self.records = Selector(source.record_selector)
        self.fields = {k: (m.selector, m.attr) for k, m in source.fields.items()}
        self.selectors = {m.selector: Selector(m.selector) for m in source.fields.values()}
        self.next = Selector(source.pagination.next_selector) if source.pagination.next_selector else None

    def read(self, html: str | None, page_url: str) -> tuple[list[dict[str, str | None]], str | None]:
        root = parse(html)
        return [self._fields(e) for e in self.records.all(root)], next_link(root, self.next, page_url)

    def _fields(self, record: Element) -> dict[str, str | None]:
        """The record's elements are listed once, and each selector is tried once, for however many fields."""
        below = list(record.walk())
        first = {k: s.first_of(below) for k, s in self.selectors.items()}
        return {k: _read(first[s], a) for k, (s, a) in self.fields.items()}


def read_pages(pages: DataFrame, config: Config) -> DataFrame:
    """(source_id, page_no, page_url, records: array<map>, next_url) for each fetched page of ``pages``; html goes no further."""
    sources = {s.id: s for s in config.sources}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        readers: dict[str, PageReader] = {}
        kind = pa.list_(pa.map_(pa.string(), pa.string()))
        for batch in few(batches):
            records, following = [], []
            for source_id, url, html in zip(*(batch.column(c).to_pylist() for c in ("source_id", "url", "html")), strict=True):
                if source_id not in readers:
                    readers[source_id] = PageReader(sources[source_id])
                found, link = readers[source_id].read(html, url)
                records.append([list(x.items()) for x in found])
                following.append(link)
            yield pa.RecordBatch.from_arrays([batch.column("source_id"), batch.column("page_no"), batch.column("url"), pa.array(records, kind), pa.array(following, pa.string())], ["source_id", "page_no", "page_url", "records", "next_url"])

    wanted = pages.where(F.col("source_id").isin(*sources) & F.col("error_kind").isNull()).select("source_id", "page_no", "url", "html")
    return wanted.mapInArrow(run, "source_id string, page_no int, page_url string, records array<map<string,string>>, next_url string")


def records(read: DataFrame) -> DataFrame:
    """One row for each record in document order: (source_id, page_no, page_url, record_no, fields)."""
    return read.select("source_id", "page_no", "page_url", F.posexplode("records").alias("record_no", "fields"))
