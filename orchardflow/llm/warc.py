"""WARC archives as a Spark data source: files in a folder of any store that pyarrow reaches, written and read by the executors.

Writing: each task makes files of its own, a gzip member a record, whose header tells the member's sizes (field ``sl``). A commit writes one manifest of the
files, each cut in ranges of about 64 MB with the record types in each; what a failed attempt left is in no manifest and is never read.

Reading: partitions are planned from the manifest (archives without one: a file is a range, none is split). Filters on the record type and on columns made
of headers are pushed down: ranges without a wanted type are not planned, and of each record the headers are inflated and parsed first. A record that is not
wanted, or whose payload is not asked for, is left by its sizes without inflating the rest; without sizes it is inflated, but not decoded.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualNullSafe,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    LessThan,
    LessThanOrEqual,
    Not,
    StringContains,
    StringEndsWith,
    StringStartsWith,
    WriterCommitMessage,
)

from orchardflow.llm._common import scratch, stored

FIELDS = "record_id string, record_type string, target_uri string, date string, content_type string, content_length long, payload_digest string, refers_to string, payload_length long, headers map<string,string>, file string, offset long"
#: Columns made of the headers of a record, on which filters are pushed down.
PUSHED = ("record_id", "record_type", "target_uri", "date", "content_type", "content_length", "payload_digest", "refers_to", "payload_length")
WRITTEN = ("record_id", "record_type", "target_uri", "date", "payload_digest", "refers_to", "payload_length", "payload")
SPLIT, ROLL, PEEK, READ = 64 << 20, 1 << 30, 4096, 1 << 18
# The words of the format.
MAGIC, EXTRA, END = b"\x1f\x8b\x08", b"sl", b"\r\n\r\n"
HTTP = "application/http"


def _store(path: str):
    """The file system of a path or address, and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def member(record: bytes, level: int = 4) -> bytes:
    """A gzip member of one record; field ``sl`` has the sizes of the member and of the record."""
    press = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = press.compress(record) + press.flush()
    head = MAGIC + b"\x04" + bytes(5) + b"\xff" + struct.pack("<H2sH", 12, EXTRA, 8)
    size = len(head) + 8 + len(body) + 8
    return head + struct.pack("<II", size, len(record)) + body + struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF)


def _clean(value: str) -> str:
    """A header's value on one line."""
    return "".join(f"%{ord(c):02X}" if ord(c) < 32 or ord(c) == 127 else c for c in value)


def record(row: dict, date: str) -> bytes:
    """A response or revisit record over HTTP headers that state the payload's length; a revisit has no payload."""
    payload = (row["payload"] or b"") if row["record_type"] != "revisit" else b""
    said = len(payload) if row["payload_length"] is None else row["payload_length"]
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {said}".encode() + END + payload
    named = [("WARC-Type", row["record_type"]), ("WARC-Record-ID", f"<{_clean(row['record_id'])}>"), ("WARC-Date", row["date"] or date)]
    if row["target_uri"] is not None:
        named.append(("WARC-Target-URI", _clean(row["target_uri"])))
    if row["payload_digest"] is not None:
        named.append(("WARC-Payload-Digest", f"sha256:{row['payload_digest']}"))
    if row["refers_to"] is not None:
        named += [("WARC-Refers-To", f"<{_clean(row['refers_to'])}>"), ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
    named += [("Content-Type", f"{HTTP}; msgtype=response"), ("Content-Length", str(len(block)))]
    return "WARC/1.1\r\n".encode() + "".join(f"{k}: {v}\r\n" for k, v in named).encode() + b"\r\n" + block + END


def parse_headers(head: bytes) -> dict[str, str]:
    """Names, lower-cased, and values below the first line; a line that begins with a blank goes on with the last, the first of equal names counts."""
    found: dict[str, str] = {}
    name = ""
    for line in head.split(b"\n")[1:]:
        text = line.rstrip(b"\r").decode("utf-8", "replace")
        if text[:1] in (" ", "\t") and name:
            found[name] += " " + text.strip()
        elif ":" in text:
            name, _, value = text.partition(":")
            name = name.strip().lower()
            found.setdefault(name, value.strip())
    return found


def _whole(text: str | None) -> int | None:
    return int(text) if text is not None and text.isascii() and text.isdigit() else None


class Bytes:
    """A file in a store, read in steps, with the last step kept."""

    def __init__(self, file) -> None:
        self.file, self.size = file, file.size()
        self.at, self.held = 0, b""

    def take(self, offset: int, n: int) -> bytes:
        """Up to ``n`` bytes from ``offset``."""
        n = min(n, self.size - offset)
        if n <= 0:
            return b""
        if offset < self.at or offset + n > self.at + len(self.held):
            self.file.seek(offset)
            self.at, self.held = offset, self.file.read(max(n, READ))
        return self.held[offset - self.at : offset - self.at + n]


class Record:
    """A record at an offset of a file, its headers parsed; the payload is read when asked for."""

    def __init__(self, source: Bytes, offset: int) -> None:
        self.source, self.offset = source, offset
        start = source.take(offset, PEEK)
        self.zipped = start[:3] == MAGIC
        self.inflate = zlib.decompressobj(31) if self.zipped else None
        self.read_to, self.raw, self.stop = offset, b"", None
        if self.zipped and start[3] & 4 and start[12:16] == EXTRA + b"\x08\x00":
            self.stop = offset + struct.unpack("<I", start[16:20])[0]
        while (end := self.raw.find(END)) < 0:
            if not self.more(PEEK):
                raise ValueError(f"no WARC headers at {offset}")
        if not self.raw.startswith(b"WARC/"):
            raise ValueError(f"no WARC record at {offset}")
        self.headers = parse_headers(self.raw[:end])
        self.block = end + len(END)
        self.length = _whole(self.headers.get("content-length")) or 0
        if not self.zipped:
            self.stop = offset + self.block + self.length + len(END)
        self.body, self.payload_length = self.block, self.length
        if self.headers.get("content-type", "").startswith(HTTP):
            while (end := self.raw.find(END, self.block)) < 0 and len(self.raw) < self.block + self.length:
                if not self.more(PEEK):
                    break
            if 0 <= end <= self.block + self.length - len(END):
                said = _whole(parse_headers(self.raw[self.block : end]).get("content-length"))
                self.body = end + len(END)
                rest = self.block + self.length - self.body
                self.payload_length = said if self.headers.get("warc-type") == "revisit" and said is not None else rest

    def more(self, n: int) -> bool:
        if self.inflate is None:
            part = self.source.take(self.read_to, n)
            self.read_to += len(part)
            self.raw += part
            return bool(part)
        if self.inflate.eof:
            return False
        part = self.inflate.unconsumed_tail or self.source.take(self.read_to, n)
        if not self.inflate.unconsumed_tail:
            self.read_to += len(part)
        self.raw += self.inflate.decompress(part, 4 * n)
        return bool(part)

    def payload(self) -> bytes:
        if self.headers.get("warc-type") == "revisit" and self.body > self.block:
            return b""
        parts, size, stop = [self.raw], len(self.raw), self.block + self.length
        while size < stop:
            self.raw = b""
            if not self.more(READ):
                raise ValueError(f"the record at {self.offset} ends early")
            parts.append(self.raw)
            size += len(self.raw)
        self.raw = b"".join(parts)
        return self.raw[self.body : stop]

    def next(self) -> int:
        """The next record's offset."""
        if self.stop is not None:
            return self.stop
        kept, self.raw = self.raw, b""
        while not self.inflate.eof:
            if not self.more(READ):
                raise ValueError(f"the record at {self.offset} ends early")
            self.raw = b""
        self.raw = kept
        return self.read_to - len(self.inflate.unused_data)

    def row(self, file: str) -> dict:
        h = self.headers
        bare = lambda x: x[1:-1] if x and x[0] == "<" and x[-1] == ">" else x
        digest = h.get("warc-payload-digest")
        return {
            "record_id": bare(h.get("warc-record-id")),
            "record_type": h.get("warc-type"),
            "target_uri": bare(h.get("warc-target-uri")),
            "date": h.get("warc-date"),
            "content_type": h.get("content-type"),
            "content_length": _whole(h.get("content-length")),
            "payload_digest": digest.rpartition(":")[2] if digest else None,
            "refers_to": bare(h.get("warc-refers-to")),
            "payload_length": self.payload_length,
            "headers": h,
            "file": file,
            "offset": self.offset,
        }


def holds(f: Filter, row: dict) -> bool | None:
    """A filter's value on a row: None where it is null in SQL."""
    if isinstance(f, Not):
        inner = holds(f.child, row)
        return None if inner is None else not inner
    x = row[f.attribute[0]]
    if isinstance(f, IsNull | IsNotNull):
        return (x is None) == isinstance(f, IsNull)
    if isinstance(f, EqualNullSafe):
        return x == f.value
    if x is None:
        return None
    if isinstance(f, In):
        return True if x in f.value else None if None in f.value else False
    return {
        EqualTo: lambda: x == f.value,
        GreaterThan: lambda: x > f.value,
        GreaterThanOrEqual: lambda: x >= f.value,
        LessThan: lambda: x < f.value,
        LessThanOrEqual: lambda: x <= f.value,
        StringStartsWith: lambda: x.startswith(f.value),
        StringEndsWith: lambda: x.endswith(f.value),
        StringContains: lambda: f.value in x,
    }[type(f)]()


def pushable(f: Filter) -> bool:
    inner = f
    while isinstance(inner, Not):
        inner = inner.child
    known = (EqualTo, EqualNullSafe, In, IsNull, IsNotNull, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual, StringStartsWith, StringEndsWith, StringContains)
    if not isinstance(inner, known) or len(inner.attribute) != 1 or inner.attribute[0] not in PUSHED:
        return False
    # text is compared by code points here and by UTF-8 bytes in Spark: the same order
    return getattr(inner, "value", "") is not None or isinstance(inner, EqualNullSafe)


@dataclass
class Ranges(InputPartition):
    """Parts of files, each from an offset up to another (None: the end)."""

    parts: list[tuple[str, int, int | None]]

    def __init__(self, parts: list[tuple[str, int, int | None]]) -> None:
        self.parts = parts


@dataclass
class Files(WriterCommitMessage):
    """Files of one task: (name, size, ranges of (offset, {record type: records}))."""

    files: list[tuple[str, int, list[tuple[int, dict[str, int]]]]] = field(default_factory=list)


class Reader(DataSourceReader):
    def __init__(self, options: dict, payload: bool) -> None:
        self.path, self.payload = options["path"], payload
        self.split = int(options.get("split", SPLIT))
        self.filters: list[Filter] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            if pushable(f):
                self.filters.append(f)
            else:
                yield f

    def wanted(self, row: dict) -> bool:
        return all(holds(f, row) is True for f in self.filters)

    def of_type(self, kind: str) -> bool:
        """Whether a record of this type could be wanted."""
        only = [f for f in self.filters if (f.child if isinstance(f, Not) else f).attribute == ("record_type",)] if all(not isinstance(f, Not) or not isinstance(f.child, Not) for f in self.filters) else []
        return all(holds(f, {"record_type": kind}) is True for f in only)

    def ranges(self) -> Iterator[tuple[str, int, int | None, int]]:
        from pyarrow import fs

        store, base = _store(self.path)
        found = store.get_file_info(fs.FileSelector(base, allow_not_found=True))
        manifests = sorted(x.path for x in found if x.base_name.startswith("_manifest-"))
        if not manifests:
            for x in sorted(found, key=lambda x: x.path):
                if x.is_file and x.base_name.endswith((".warc", ".warc.gz")):
                    yield x.base_name, 0, None, x.size
        for path in manifests:
            with store.open_input_stream(path) as lines:
                for line in lines.read().decode().splitlines():
                    name, size, cuts = json.loads(line)
                    for (start, kinds), stop in zip(cuts, [*(c[0] for c in cuts[1:]), size], strict=True):
                        if any(map(self.of_type, kinds)):
                            yield name, start, stop, stop - start

    def partitions(self) -> list[Ranges]:
        """Ranges in groups of about ``split`` bytes."""
        out: list[Ranges] = []
        held: list[tuple[str, int, int | None]] = []
        size = 0
        for name, start, stop, n in self.ranges():
            if held and size + n > self.split:
                out.append(Ranges(held))
                held, size = [], 0
            held.append((name, start, stop))
            size += n
        return [*out, Ranges(held)]

    def read(self, partition: Ranges) -> Iterator[pa.RecordBatch]:
        store, base = _store(self.path)
        kinds = {"content_length": pa.int64(), "payload_length": pa.int64(), "offset": pa.int64(), "headers": pa.map_(pa.string(), pa.string()), "payload": pa.binary()}
        names = [x.split()[0] for x in FIELDS.split(", ")] + ["payload"] * self.payload

        def batch(rows: list[dict]) -> pa.RecordBatch:
            columns = [pa.array([list(r[n].items()) if n == "headers" else r[n] for r in rows], kinds.get(n, pa.string())) for n in names]
            return pa.RecordBatch.from_arrays(columns, names)

        rows, size = [], 0
        for name, at, stop in partition.parts:
            with store.open_input_file(f"{base}/{name}") as file:
                source = Bytes(file)
                while at < (source.size if stop is None else stop):
                    one = Record(source, at)
                    row = one.row(name)
                    if self.wanted(row):
                        if self.payload:
                            row["payload"] = one.payload()
                            size += len(row["payload"])
                        rows.append(row)
                    at = one.next()
                    if len(rows) >= 2000 or size > 8 << 20:
                        yield batch(rows)
                        rows, size = [], 0
        yield batch(rows)


class Writer(DataSourceArrowWriter):
    def __init__(self, options: dict, overwrite: bool) -> None:
        self.path, self.overwrite = options["path"], overwrite
        self.split, self.roll = int(options.get("split", SPLIT)), int(options.get("roll", ROLL))
        self.date = options.get("date", "1970-01-01T00:00:00Z")
        self.level = int(options.get("level", 4))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Files:
        store, base = _store(self.path)
        store.create_dir(base, recursive=True)
        done, out, name, size, cuts = Files(), None, "", 0, []

        def close() -> None:
            out.close()
            done.files.append((name, size, cuts))

        for batch in iterator:
            for at in range(0, batch.num_rows, 64):
                for row in batch.slice(at, 64).to_pylist():
                    if out is None or size > self.roll:
                        if out is not None:
                            close()
                        name, size, cuts = f"part-{uuid.uuid4().hex}.warc.gz", 0, [(0, {"warcinfo": 1})]
                        out = store.open_output_stream(f"{base}/{name}", compression=None)
                        about = b"software: orchardflow\r\nformat: WARC File Format 1.1\r\n"
                        head = f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:{uuid.uuid4()}>\r\nWARC-Date: {self.date}\r\nWARC-Filename: {name}\r\nContent-Type: application/warc-fields\r\nContent-Length: {len(about)}".encode()
                        size += out.write(member(head + END + about + END, self.level))
                    if size - cuts[-1][0] > self.split:
                        cuts.append((size, {}))
                    kinds = cuts[-1][1]
                    kinds[row["record_type"]] = kinds.get(row["record_type"], 0) + 1
                    size += out.write(member(record(row, self.date), self.level))
        if out is not None:
            close()
        return done

    def commit(self, messages: list[Files | None]) -> None:
        from pyarrow import fs

        store, base = _store(self.path)
        store.create_dir(base, recursive=True)
        before = [x for x in store.get_file_info(fs.FileSelector(base)) if x.is_file] if self.overwrite else []
        files = [f for m in messages if m is not None for f in m.files]
        with store.open_output_stream(f"{base}/_manifest-{uuid.uuid4().hex}.jsonl") as out:
            out.write("".join(json.dumps(f) + "\n" for f in files).encode())
        new = {f[0] for f in files}
        for x in before:
            if x.base_name not in new:
                store.delete_file(x.path)

    def abort(self, messages: list[Files | None]) -> None:
        store, base = _store(self.path)
        for m in messages:
            for name, *_ in m.files if m is not None else ():
                store.delete_file(f"{base}/{name}")


class WarcSource(DataSource):
    """``spark.read.format("warc").option("path", folder)``; option ``payload`` false leaves payloads out. Writing takes the columns of ``WRITTEN``."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def _payload(self) -> bool:
        return self.options.get("payload", "true").lower() != "false"

    def schema(self) -> str:
        return FIELDS + ", payload binary" * self._payload()

    def reader(self, schema) -> Reader:
        return Reader(dict(self.options), self._payload())

    def writer(self, schema, overwrite: bool) -> Writer:
        lacking = [x for x in WRITTEN if x not in schema.names]
        if lacking:
            raise ValueError(f"WARC records need the columns {', '.join(lacking)}")
        return Writer(dict(self.options), overwrite)


def read(spark: SparkSession, path: str, payload: bool = True, **options) -> DataFrame:
    """The records of all archives in a folder. Filters on the columns of ``PUSHED`` reach the reader."""
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format("warc").options(payload=str(payload).lower(), path=path, **options).load()


def write(rows: DataFrame, path: str, mode: str = "append", **options) -> None:
    """Write records (columns ``WRITTEN``, others are ignored) to archives in a folder."""
    rows.sparkSession.dataSource.register(WarcSource)
    rows.select(*WRITTEN).write.format("warc").mode(mode).options(path=path, **options).save()


def deduplicated(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = 100) -> DataFrame:
    """Records (columns ``WRITTEN``) of pages: of equal payloads of at least ``least`` bytes that of the smallest id is a response, the others revisit it.

    Record ids are ``urn:page:<id>:<number>``, the number telling rows apart; rows are written once before, so that a task that is tried again makes the same. A null id
    comes after all others; of repeated rows any one is the response. Null html is an empty payload. Extra columns are ignored.
    """
    html = F.coalesce(F.col(html_col).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("target_uri"), html.alias("payload"), F.monotonically_increasing_id().alias("no"))
    rows = stored(rows.select("*", F.length("payload").cast("long").alias("payload_length"), F.sha2("payload", 256).alias("payload_digest")), "pages")
    row = F.struct(F.col("id").isNull().alias("none"), "id", "no")
    groups = rows.where(F.col("payload_length") >= least).groupBy("payload_digest", "payload_length").agg(F.count("*").alias("n"), F.min(row).alias("first"))
    # written, so that Spark knows its size: it broadcasts it only if small, and then the payloads are not shuffled; else it is a join whose skew Spark can split
    groups = stored(groups.where("n > 1").select("payload_digest", "payload_length", "first"), "copies")
    named = lambda i, n: F.concat(F.lit("urn:page:"), F.coalesce(i.cast("string"), F.lit("")), F.lit(":"), n.cast("string"))
    again = F.col("first.no") != F.col("no")
    joined = rows.join(groups, ["payload_digest", "payload_length"], "left")
    return joined.select(
        named(F.col("id"), F.col("no")).alias("record_id"),
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        "target_uri",
        F.lit(None).cast("string").alias("date"),
        "payload_digest",
        F.when(again, named(F.col("first.id"), F.col("first.no"))).alias("refers_to"),
        "payload_length",
        F.when(~F.coalesce(again, F.lit(False)), F.col("payload")).alias("payload"),
    )


def archived(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = 100) -> DataFrame:
    """(id_col, payload_bytes, payload_digest, record_type, refers_to) for each page, written to archives in the shared folder and read back.

    Payloads of responses are read and their digests computed again, a difference is an error; of revisits only headers are read. Cases as in
    :func:`deduplicated`; an empty table gives an empty result.
    """
    spark = pages.sparkSession
    path = scratch(spark, "warc")
    write(deduplicated(pages, id_col, url_col, html_col, least), path)
    responses = read(spark, path).where("record_type = 'response'")
    own = F.sha2("payload", 256)
    sound = (own == F.col("payload_digest")) & (F.length("payload") == F.col("payload_length"))
    digest = F.when(sound, own).otherwise(F.raise_error(F.concat(F.lit("damaged payload of "), "record_id")))
    revisits = read(spark, path, payload=False).where("record_type = 'revisit'")
    page = lambda c: F.nullif(F.regexp_extract(c, "^urn:page:(-?[0-9]*):", 1), F.lit("")).cast("long")
    both = responses.select("record_id", "payload_length", digest.alias("payload_digest"), "record_type", "refers_to").unionByName(revisits.select("record_id", "payload_length", "payload_digest", "record_type", "refers_to"))
    return both.select(page("record_id").alias(id_col), F.col("payload_length").alias("payload_bytes"), "payload_digest", "record_type", page("refers_to").alias("refers_to"))
