import gzip
import hashlib
from collections import defaultdict
from pathlib import Path

import pytest

from orchardflow.llm import warc


def brute(rows):
    groups = defaultdict(list)
    for at, (page, _, html) in enumerate(rows):
        groups[html or ""].append((page is None, page, at))
    out = []
    for html, found in groups.items():
        data = html.encode()
        found.sort(key=lambda x: (x[0], x[1] or 0, x[2]))
        for i, (_, page, _) in enumerate(found):
            again = i > 0 and len(data) >= 100
            out.append((page, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", found[0][1] if again else None))
    return sorted(out, key=str)


def pages(n=300):
    rows = [(i, f"https://x.example/{i}", f"<p>{i % 40} Straße \r\n\r\n WARC/1.1</p>" * (1 + i % 50)) for i in range(n)]
    rows += [(1000 + i, "https://copies.example/", "copy " * 40) for i in range(200)] + [(7, "a b\r\nc", "copy " * 40)] * 2
    rows += [(2000, None, None), (2001, "", ""), (None, None, "nameless " * 30), (None, "u", "nameless " * 30), (3000, "u", "nameless " * 30), (-5, "u", "x" * 99), (-4, "u", "x" * 99), (-3, "u", "x" * 100), (-2, "u", "x" * 100), (1, "u", "é" * 50), (0, "u", "é" * 50)]
    return [*rows, (4000, "long", "".join(chr(33 + i * 7919 % 90) for i in range(3_000_000)))]


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame([(*r, "clash", 1) for r in pages()], "page_id long, url string, html string, record_type string, payload int").repartition(5)


def test_against_brute_force(spark, table):
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.archived(table).collect()]
    assert sorted(got, key=str) == brute(pages())
    empty = warc.archived(table.limit(0))
    assert empty.count() == 0 and dict(empty.dtypes) == {"page_id": "bigint", "payload_bytes": "bigint", "payload_digest": "string", "record_type": "string", "refers_to": "bigint"}


@pytest.fixture(scope="module")
def folder(spark, table, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("warc") / "archive")
    warc.write(warc.deduplicated(table), path, roll=60_000, split=20_000)
    return path


def test_archives_are_standard(folder):
    """Each member inflates alone to one record with the stated length; ids are unique; files begin with warcinfo."""
    ids = set()
    for path in Path(folder).glob("*.warc.gz"):
        raw = path.read_bytes()
        whole = gzip.decompress(raw)
        at = 0
        while at < len(whole):
            end = whole.index(b"\r\n\r\n", at)
            head = warc.parse_headers(whole[at:end])
            assert whole[at:].startswith(b"WARC/1.1\r\n") and (at > 0) == (head["warc-type"] != "warcinfo")
            assert head["warc-record-id"] not in ids
            ids.add(head["warc-record-id"])
            at = end + 4 + int(head["content-length"])
            assert whole[at : at + 4] == b"\r\n\r\n"
            at += 4
    assert len(ids) == len(pages()) + len(list(Path(folder).glob("*.warc.gz")))


def test_payloads_and_headers(spark, folder):
    rows = warc.read(spark, folder).where("record_type <> 'warcinfo'").collect()
    want = defaultdict(set)
    for page, url, html in pages():
        want[page].add((html or "").encode())
    assert len(rows) == len(pages())
    for r in rows:
        page = r.record_id.split(":")[2]
        page = int(page) if page else None
        assert r.headers["warc-type"] == r.record_type and r.content_length > 0
        if r.record_type == "response":
            assert bytes(r.payload) in want[page] and r.payload_length == len(r.payload)
        else:
            assert r.payload == b"" and r.payload_length in {len(x) for x in want[page]} and r.refers_to
    assert "a b%0D%0Ac" in {r.target_uri for r in rows} and None in {r.target_uri for r in rows}
    light = warc.read(spark, folder, payload=False)
    assert "payload" not in light.columns and light.count() == len(rows) + len(list(Path(folder).glob("*.warc.gz")))


def test_filters_are_pushed(spark, folder):
    every = warc.read(spark, folder).collect()
    for text, keep in (
        ("record_type = 'revisit'", lambda r: r.record_type == "revisit"),
        ("record_type <> 'response'", lambda r: r.record_type != "response"),
        ("record_type in ('response', 'x') and target_uri like 'https://copies%'", lambda r: r.record_type == "response" and (r.target_uri or "").startswith("https://copies")),
        ("refers_to is not null and payload_length > 1000", lambda r: r.refers_to is not None and r.payload_length > 1000),
        ("target_uri is null", lambda r: r.target_uri is None),
        ("not (target_uri like '%9')", lambda r: r.target_uri is not None and not r.target_uri.endswith("9")),
        ("payload_length between 5 and 150 or date is null", lambda r: 5 <= r.payload_length <= 150),
        ("headers['warc-type'] = 'warcinfo'", lambda r: r.record_type == "warcinfo"),
        ("target_uri = null", lambda r: False),
    ):
        df = warc.read(spark, folder).where(text)
        assert {r.record_id for r in df.collect()} == {r.record_id for r in every if keep(r)}, text
    left = warc.read(spark, folder).where("record_type = 'revisit'")._jdf.queryExecution().optimizedPlan().toString()
    assert "'revisit'" not in left and "= revisit" not in left.split("RelationV2")[0]


def test_planning_leaves_out_ranges_and_payloads(spark, folder, monkeypatch):
    from pyspark.sql.datasource import EqualTo

    def reader(kind):
        made = warc.Reader({"path": folder, "split": "500000"}, True)
        assert list(made.pushFilters([EqualTo(("record_type",), kind)])) == []
        return made

    rows = {k: sum(len(p.parts) for p in reader(k).partitions()) for k in ("response", "warcinfo", "request")}
    assert rows["request"] == 0 and 0 < rows["warcinfo"] < rows["response"]
    assert max(len(p.parts) for p in reader("warcinfo").partitions()) > 1
    inflated, given = [], pages()
    monkeypatch.setattr(warc.Record, "payload", lambda self: inflated.append(self.offset) or b"")
    lazy = reader("revisit")
    assert sum(b.num_rows for p in lazy.partitions() for b in lazy.read(p)) == len(inflated) == 201 + 2 + 1 + 1 + sum(1 for i in range(300) if i >= 200 and len(given[i][2].encode()) >= 100)


def test_other_peoples_archives(spark, tmp_path):
    """Without manifest and sizes: plain files, and gzip members without the size field; folded headers, other record types and large headers."""

    def made(kind, url, block, extra=""):
        return f"WARC/1.0\r\nWARC-Type: {kind}\r\nwarc-record-id: <urn:x:{url}>\r\nWARC-Target-URI: {url}\r\n{extra}Content-Type: text/plain\r\nContent-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"

    records = [made("resource", "u1", b"WARC/1.0\r\n\r\n" * 5), made("metadata", "u2", b"m", "X-Note: one\r\n two\r\nX-Long: " + "z" * 50_000 + "\r\n"), made("resource", "u3", b"\x00" * 2_000_000), made("resource", "u4", b"")]
    (tmp_path / "a.warc").write_bytes(b"".join(records))
    (tmp_path / "b.warc.gz").write_bytes(b"".join(map(gzip.compress, records)))
    (tmp_path / "c.txt").write_text("no archive")
    for light in (True, False):
        rows = warc.read(spark, f"file://{tmp_path}", payload=not light).where("record_type = 'resource'").collect()
        assert sorted((r.file, r.target_uri, r.payload_length) for r in rows) == [(f, u, n) for f in ("a.warc", "b.warc.gz") for u, n in (("u1", 60), ("u3", 2_000_000), ("u4", 0))]
    assert all(len(r.payload) == r.payload_length for r in rows)
    (note,) = {r.headers["x-note"] for r in warc.read(spark, str(tmp_path)).where("record_id = 'urn:x:u2'").collect()}
    assert note == "one two"


def test_only_committed_files_count(spark, table, tmp_path):
    path = str(tmp_path / "w")
    rows = warc.deduplicated(table.where("page_id < 50"))
    warc.write(rows, path)
    first = warc.read(spark, path).count()
    (Path(path) / "part-left-over.warc.gz").write_bytes(b"of a failed attempt")
    assert warc.read(spark, path).count() == first
    warc.write(rows.where("record_type = 'response'"), path)
    assert warc.read(spark, path).count() > first
    warc.write(rows, path, mode="overwrite")
    assert warc.read(spark, path).count() == first and not (Path(path) / "part-left-over.warc.gz").exists()
    with pytest.raises(Exception, match="need the columns"):
        rows.drop("payload").write.format("warc").mode("append").option("path", path).save()
