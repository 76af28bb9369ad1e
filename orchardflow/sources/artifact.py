"""One file from many tasks: rows are rendered where they are, each task commits a part, and one stream joins the parts' bytes.

No row passes through the driver. A part counts once its task has committed and the driver has listed it; what failed attempts leave is not listed. The list is in the
order of the partitions, so a sorted frame gives a sorted file. A dataset without rows gives a header alone, or ``[]``.
"""

from __future__ import annotations

import csv
import io
import json
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from orchardflow.sources.shared import fresh, remove

LIST, CHUNK = "_parts.json", 1 << 20


def _store(path: str):
    """The file system of a path or address, and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def cell(value) -> str:
    """A value in CSV: null is empty, truth values are in lower case."""
    return "" if value is None else ("true" if value else "false") if isinstance(value, bool) else str(value)


def csv_rows(rows: list[dict], names: list[str]) -> str:
    out = io.StringIO()
    csv.writer(out, lineterminator="\n").writerows([cell(r[n]) for n in names] for r in rows)
    return out.getvalue()


def json_row(row: dict) -> str:
    """An element of an indented array, from its line break on."""
    return "\n  " + json.dumps(row, indent=2, ensure_ascii=False, default=str).replace("\n", "\n  ")


def plain_rows(batch: pa.RecordBatch) -> list[dict]:
    """Rows as mappings, columns of maps too."""
    maps = [f.name for f in batch.schema if pa.types.is_map(f.type)]
    return [r | {m: None if r[m] is None else dict(r[m]) for m in maps} for r in batch.to_pylist()]


@dataclass
class Part(WriterCommitMessage):
    place: int
    name: str
    rows: int


class PartWriter(DataSourceArrowWriter):
    def __init__(self, path: str, form: str, encoding: str) -> None:
        self.path, self.form, self.encoding = path, form, encoding

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Part:
        place = TaskContext.get().partitionId()
        name, n = f"{place:06d}-{uuid.uuid4().hex}", 0
        store, base = _store(self.path)
        store.create_dir(base, recursive=True)
        mark = "".encode(self.encoding)  # the byte order mark is the file's, not a part's
        with store.open_output_stream(f"{base}/{name}") as out:
            for batch in iterator:
                rows = plain_rows(batch)
                if self.form == "csv":
                    out.write(csv_rows(rows, batch.schema.names).encode(self.encoding).removeprefix(mark))
                else:
                    out.write("".join(("," if n + i else "") + json_row(r) for i, r in enumerate(rows)).encode())
                n += len(rows)
        return Part(place, name, n)

    def commit(self, messages: list[Part | None]) -> None:
        store, base = _store(self.path)
        store.create_dir(base, recursive=True)
        parts = sorted((m.place, m.name) for m in messages if m is not None and m.rows)
        with store.open_output_stream(f"{base}/{LIST}") as out:
            out.write(json.dumps([name for _, name in parts]).encode())

    def abort(self, messages: list[Part | None]) -> None:
        store, base = _store(self.path)
        for m in messages:
            if m is not None:
                store.delete_file(f"{base}/{m.name}")


class PartSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "artifact"

    def writer(self, schema, overwrite: bool) -> PartWriter:
        return PartWriter(self.options["path"], self.options["form"], self.options.get("encoding", "utf-8"))


@dataclass(frozen=True)
class Artifact:
    """A file to be made of committed parts."""

    parts: str
    path: str
    head: bytes
    between: bytes
    tail: bytes
    empty: bytes

    def join(self) -> None:
        """Write the file beside its place, then move it there, over what was there."""
        store, base = _store(self.parts)
        target, where = _store(self.path)
        with store.open_input_stream(f"{base}/{LIST}") as listed:
            names = json.loads(listed.read())
        folder, _, name = where.rpartition("/")
        target.create_dir(folder, recursive=True)
        new = f"{folder}/.{name}-{uuid.uuid4().hex}"
        with target.open_output_stream(new, compression=None) as out:
            out.write(self.head if names else self.empty)
            for i, part in enumerate(names):
                out.write(self.between if i else b"")
                with store.open_input_stream(f"{base}/{part}", compression=None) as source:
                    while data := source.read(CHUNK):
                        out.write(data)
            out.write(self.tail if names else b"")
        target.move(new, where)


def render(df: DataFrame, path: str, form: str, encoding: str = "utf-8") -> Artifact:
    """Have the executors render ``df`` in committed parts, in the shared folder; :func:`publish` makes the file at ``path`` of them."""
    spark = df.sparkSession
    spark.dataSource.register(PartSource)
    parts = fresh(spark, "parts")
    try:
        df.write.format("artifact").mode("append").options(path=parts, form=form, encoding=encoding).save()
    except Exception:
        remove(spark, parts)
        raise
    if form == "csv":
        head = csv_rows([dict(zip(df.columns, df.columns, strict=True))], df.columns).encode(encoding)
        return Artifact(parts, path, head, b"", b"", head)
    return Artifact(parts, path, b"[", b",", b"\n]", b"[]")


def publish(spark: SparkSession, artifacts: list[Artifact]) -> None:
    """Join the parts of each artifact: one task each. A plain path on a cluster is the driver's own, which then copies the bytes itself."""
    here = re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master)
    far = [a for a in artifacts if here or "://" in a.path]
    if far:

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in batch.column("id").to_pylist():
                    far[i].join()
                yield batch

        spark.range(0, len(far), 1, len(far)).mapInArrow(run, "id long").count()
    for a in artifacts:
        if a not in far:
            a.join()
        remove(spark, a.parts)


def read_json(spark: SparkSession, paths: str | list[str], schema: str) -> DataFrame:
    """The elements of arrays that :func:`render` wrote, each file read in parts by many tasks.

    Strings in JSON have no line breaks, so what stands between two elements stands nowhere else.
    """
    raw = spark.read.text(paths, lineSep=",\n  {").where("value <> '[]'")
    element = F.regexp_replace(F.regexp_replace("value", r"^\[\n  \{", ""), r"\n\]$", "")
    return raw.select(F.from_json(F.concat(F.lit("{"), element), schema).alias("row")).select("row.*")


def read_csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """The rows of a CSV file that :func:`render` wrote in UTF-8, as strings, with ``place`` (from 0) in the file; read in parts by many tasks.

    A first pass counts each part's quotes, which says what part begins within a quoted line break, and its rows; the driver holds three numbers a part.
    """
    lines = spark.read.text(path, lineSep="\n").select("value", F.col("_metadata.file_block_start").alias("part"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, list[int]] = {}  # of a part: whether its quotes are odd, rows that end in it if it begins outside of quotes, and if within
        for batch in batches:
            for text, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = seen.setdefault(part, [0, 0, 0])
                found[0] ^= text.count('"') & 1
                found[1 + found[0]] += 1
        yield pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.int64()), *(pa.array([x[i] for x in seen.values()], pa.int64()) for i in range(3))], ["part", "odd", "outside", "within"])

    begins, open_, n = {}, 0, 0
    for part, odd, *ends in sorted(tuple(r) for r in lines.mapInArrow(count, "part long, odd long, outside long, within long").collect()):
        begins[part] = open_, n
        n += ends[open_]
        open_ ^= odd

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, held = None, []
        for batch in batches:
            made = []
            for text, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if part != here:
                    if held:
                        made.append((place, here, "\n".join(held), True))
                    (within, place), here, held = begins[part], part, []
                    torn = bool(within)
                held.append(text)
                within ^= text.count('"') & 1
                if not within:
                    made.append((place, part, "\n".join(held), torn))
                    place, held, torn = place + 1, [], False
            yield packed(made)
        yield packed([(place, here, "\n".join(held), True)] if held else [])

    def packed(made: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([dict(zip(kinds.names, x, strict=True)) for x in made], kinds)

    kinds = pa.schema([("place", pa.int64()), ("part", pa.int64()), ("line", pa.string()), ("torn", pa.bool_())])
    found = lines.mapInArrow(rows, "place long, part long, line string, torn boolean")
    mended = found.where("torn").groupBy("place").agg(F.array_sort(F.collect_list(F.struct("part", "line"))).alias("x")).select("place", F.array_join("x.line", "\n").alias("line"))
    whole = found.where("not torn").select("place", "line").unionByName(mended).where("place > 0")  # but the header
    row = F.from_csv("line", ", ".join(f"`{c}` string" for c in columns), {"escape": '"'})
    return whole.select(row.alias("row"), (F.col("place") - 1).alias("place")).select("row.*", "place")
