"""Files from the executors, snapshots that survive a crash, a run's few actions, and keyed state of a stream."""

import csv
import dataclasses
import json
import os
from datetime import UTC, datetime

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from orchardflow.plans import run as plan
from orchardflow.schemas import PAGES
from orchardflow.sources import artifact, state
from orchardflow.sources.artifact import publish, render
from orchardflow.sources.config import ConfigError, load_config
from orchardflow.sources.shared import shared_dir
from orchardflow.sources.sinks import write_files
from orchardflow.sources.state import read_state, write_state
from orchardflow.streaming import keyed
from tests import catalogue

NOW = datetime(2026, 8, 24, 9, tzinfo=UTC)


@pytest.fixture(scope="module")
def config(tmp_path_factory):
    path = tmp_path_factory.mktemp("c") / "c.yaml"
    path.write_text(catalogue.CONFIG)
    return load_config(path, {})


def numbers(spark, n=1000):
    return spark.range(n).select("id", F.when(F.col("id") % 2 == 0, F.concat(F.lit('é,"\n'), "id")).alias("text"), (F.col("id") % 3 == 0).alias("third"), F.create_map(F.lit("k"), F.col("id").cast("string")).alias("m"))


@pytest.mark.parametrize("encoding", ["utf-8", "utf-8-sig", "utf-16"])
def test_one_sorted_csv_of_many_parts(spark, tmp_path, encoding, monkeypatch):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    monkeypatch.setattr(artifact, "remove", lambda *a: None)
    rows = numbers(spark).repartition(5).orderBy(F.desc("id")).drop("m")
    made = render(rows, str(tmp_path / "a" / "x.csv"), "csv", encoding)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    publish(spark, [made])
    with open(made.parts.removeprefix("file://") + "/_parts.json") as listed:
        assert len(json.load(listed)) > 1
    raw = (tmp_path / "a" / "x.csv").read_bytes()
    mark = "".encode(encoding)
    assert raw.startswith(mark) and raw.count(mark) == 1 or not mark
    found = list(csv.reader((tmp_path / "a" / "x.csv").open(encoding=encoding, newline="")))
    assert found[0] == ["id", "text", "third"] and [int(r[0]) for r in found[1:]] == list(range(999, -1, -1))
    assert found[1] == ["999", "", "true"] and found[2] == ["998", 'é,"\n998', "false"]
    assert [x.name for x in (tmp_path / "a").iterdir()] == ["x.csv"]


def test_json_array_and_empty_ones(spark, tmp_path):
    rows = numbers(spark).repartition(7)
    made = [render(rows, str(tmp_path / "x.json"), "json"), render(rows.where("false"), str(tmp_path / "none.json"), "json"), render(rows.where("false").drop("m"), str(tmp_path / "none.csv"), "csv"), render(rows.where("id = 3"), f"file://{tmp_path}/one.json", "json")]
    publish(spark, made)
    found = json.loads((tmp_path / "x.json").read_text())
    assert sorted(r["id"] for r in found) == list(range(1000)) and {r["m"]["k"] for r in found if r["id"] == 7} == {"7"}
    assert (tmp_path / "none.json").read_text() == "[]" and (tmp_path / "none.csv").read_text() == "id,text,third\n"
    assert (tmp_path / "one.json").read_text() == '[\n  {\n    "id": 3,\n    "text": null,\n    "third": true,\n    "m": {\n      "k": "3"\n    }\n  }\n]'


def test_failed_attempts_leave_nothing(spark, tmp_path):
    bad = F.udf(lambda i: i if i < 900 else 1 // 0, "long")
    (tmp_path / "x.csv").write_text("old")
    with pytest.raises(Exception, match="ZeroDivisionError"):
        publish(spark, [render(spark.range(1000).repartition(4).select(bad("id").alias("id")), str(tmp_path / "x.csv"), "csv")])
    assert (tmp_path / "x.csv").read_text() == "old"
    made = render(spark.range(10).repartition(2), str(tmp_path / "x.csv"), "csv")
    folder = made.parts.removeprefix("file://")
    with open(f"{folder}/000000-another-attempt", "w") as out:
        out.write("99\n")
    publish(spark, [made])
    assert sorted((tmp_path / "x.csv").read_text().split()) == ["0", "1", "2", "3", "4", "5", "6", "7", "8", "9", "id"]


def test_rows_stay_off_the_driver(spark, config, tmp_path, monkeypatch):
    result = plan.run(spark, config, spark.createDataFrame(catalogue.rows(), PAGES), NOW)

    parts = lambda: {x for x in os.listdir(shared_dir(spark).removeprefix("file://")) if x.startswith("parts-")}
    before = parts()

    def never(self, *a, **b):
        raise AssertionError("rows came to the driver")

    frame = type(result.products)
    for name in ("collect", "toLocalIterator", "toPandas", "toArrow", "take"):
        monkeypatch.setattr(frame, name, never)
    written = write_files(result, tmp_path / "o")
    assert len(written) == 9 and len(json.loads((tmp_path / "o" / "products.json").read_text())) == 11
    monkeypatch.undo()
    assert parts() == before


def test_a_run_is_one_action(spark, config):
    store = spark._jsparkSession.sharedState().statusStore()
    pages = spark.createDataFrame(catalogue.rows(), PAGES)
    before = store.executionsCount()
    result = plan.run(spark, config, pages, NOW)
    assert store.executionsCount() - before == 1 and result.report["totals"]["valid"] == 11
    result.release()


def test_snapshot_survives_a_crash(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "s")
    rows = lambda *keys: spark.createDataFrame([(k, "h", "a") for k in keys], state.COLUMNS)
    keys = lambda: sorted(r.key for r in read_state(spark, path).collect())
    write_state(spark, path, rows("a"), NOW)
    held = read_state(spark, path)

    def crash(*a):
        raise KeyboardInterrupt

    for step in ("_publish", "_prune"):
        monkeypatch.setattr(state, step, crash)
        with pytest.raises(KeyboardInterrupt):
            write_state(spark, path, rows("b", step), NOW)
        monkeypatch.undo()
        assert keys() == (["a"] if step == "_publish" else ["_prune", "b"])
    assert held.count() == 1
    for i in range(4):
        write_state(spark, path, rows(f"k{i}"), NOW)
    assert keys() == ["k3"] and sum(x.name.startswith("meta-") for x in (tmp_path / "s").iterdir()) == 2
    assert sum(x.name.startswith("records-") for x in (tmp_path / "s").iterdir()) == 3  # two snapshots and what the crash left today


def test_two_runs_at_once_do_not_overwrite(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "s")
    rows = spark.createDataFrame([("a", "h", "s")], state.COLUMNS)
    write_state(spark, path, rows, NOW)
    before = state._metas(spark, path)
    write_state(spark, path, rows, NOW)
    monkeypatch.setattr(state, "_metas", lambda *a: before)
    with pytest.raises(ConfigError, match="meanwhile"):
        write_state(spark, path, rows.limit(0), NOW)
    monkeypatch.undo()
    assert read_state(spark, path).count() == 1


def test_snapshot_is_read_without_an_exchange(spark, tmp_path):
    """Bucketed by key: the products are shuffled once, the snapshot not at all; no table stays behind."""
    from orchardflow.operators.changes import classify

    path, tables = str(tmp_path / "it's here"), len(spark.catalog.listTables())
    rows = spark.range(5000).select(F.col("id").cast("string").alias("key"), F.sha2(F.col("id").cast("string"), 256).alias("content_hash"), F.lit("s").alias("source_id"))
    write_state(spark, path, rows, NOW)
    found = read_state(spark, path)
    assert found.count() == 5000 and len(spark.catalog.listTables()) == tables
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        told = classify(rows.where("id % 2 = 0 or id % 3 = 0").withColumn("content_hash", F.when(F.col("key").cast("int") % 3 == 0, "x").otherwise(F.col("content_hash"))), found)
        plan = told._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1 and "Bucketed: true" in plan or "SelectedBucketsCount" in plan
        assert {r.change: r["count"] for r in told.groupBy("change").count().collect()} == {"changed": 1667, "unchanged": 1666}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert read_state(spark, path).where("key = '17'").count() == 1


def test_old_snapshots_are_read(spark, tmp_path):
    spark.createDataFrame([("a", "h", "s")], state.COLUMNS).write.parquet(str(tmp_path / "s" / "records-old"))
    (tmp_path / "s" / "meta.json").write_text(json.dumps({"version": 1, "updated_at": "x", "records": "records-old"}))
    assert read_state(spark, str(tmp_path / "s")).count() == 1
    write_state(spark, str(tmp_path / "s"), spark.createDataFrame([("b", "h", "s"), ("c", "h", "s")], state.COLUMNS), NOW)
    assert read_state(spark, str(tmp_path / "s")).count() == 2


def pages_in(spark, folder, rows):
    spark.createDataFrame(rows, PAGES).coalesce(1).write.mode("append").parquet(str(folder))


@pytest.mark.parametrize("policy", ["keep_first", "keep_last"])
def test_stream_with_keyed_state_is_as_batch_runs(spark, config, tmp_path, policy):
    """Two batches with a restart between give what two batch runs give; nothing is kept but the store, which then serves as a snapshot."""
    config = dataclasses.replace(config, dedupe=dataclasses.replace(config.dedupe, on_conflict=policy))
    first = [r for r in catalogue.rows() if (r[0], r[1]) != ("orchard", 1)]
    second = [(*r[:7], r[7].replace("74.5", "71.5").replace("£8.00", "£8.50"), *r[8:]) if r[7] else r for r in catalogue.rows()]
    failed = ("orchard", 9, "u", "u", None, 3, "static", None, "server_error", "HTTP 503", "page_failed")
    known, want = spark.createDataFrame([("pl-401", "old", "grove"), ("gone", "h", "x")], state.COLUMNS), []
    seed = known
    for rows in (first, second):
        result = plan.run(spark, config, spark.createDataFrame(rows, PAGES), datetime.now(UTC), known)
        got = result.products.collect()
        want.append({(r.sku, r.change, r.content_hash, r.price.minor, r.source_id) for r in got})
        before = known.join(result.state.select("key"), "key", "left_anti")
        known = spark.createDataFrame(result.state.unionByName(before).collect(), state.COLUMNS)
        result.release()
    said = []
    for rows in (first, [*second, failed]):
        pages_in(spark, tmp_path / "in", rows)
        stream = spark.readStream.schema(PAGES).parquet(str(tmp_path / "in"))
        for q in keyed.start(stream, config, str(tmp_path / "out"), str(tmp_path / "cp"), once=True, initial=seed):
            q.awaitTermination()
        now = {(r.sku, r.change, r.content_hash, round(float(r.price_amount) * 100) if r.price_currency not in ("KRW", "JPY") else int(r.price_amount), r.source_id): None for r in spark.read.json(str(tmp_path / "out/products")).collect()}
        said.append(now)
    assert set(said[0]) == want[0]
    assert set(said[1]) == want[0] | want[1]
    assert sorted(map(tuple, keyed.snapshot(spark, str(tmp_path / "cp/products")).collect())) == sorted(map(tuple, known.select("key", "content_hash", "source_id").collect()))
    assert {r.kind for r in spark.read.json(str(tmp_path / "out/failures")).collect()} == {"server_error"} and spark.read.json(str(tmp_path / "out/rejected")).count() == 14
    assert not list(tmp_path.rglob("records-*"))


def test_duplicates_of_a_batch_are_counted(spark, tmp_path):
    rows = [("a", h, "s", (i,), i) for i, h in enumerate("xyxxz")] + [("b", "q", "s", (9,), 9)]
    spark.createDataFrame(rows, "key string, content_hash string, source_id string, seq struct<n:int>, v int").write.parquet(str(tmp_path / "in"))
    for policy, want in (("keep_first", {("a", 0, 2, 2), ("b", 9, 0, 0)}), ("keep_last", {("a", 4, 1, 3), ("b", 9, 0, 0)})):
        stream = spark.readStream.schema("key string, content_hash string, source_id string, seq struct<n:int>, v int").parquet(str(tmp_path / "in"))
        told = keyed.classify(stream, policy)
        told.writeStream.format("parquet").option("path", str(tmp_path / policy)).option("checkpointLocation", str(tmp_path / f"{policy}-cp")).trigger(availableNow=True).start().awaitTermination()
        assert {(r.key, r.v, r.identical, r.conflicting) for r in spark.read.parquet(str(tmp_path / policy)).collect()} == want
    with pytest.raises(ValueError):
        keyed.classify(stream, "keep_best")


@pytest.mark.parametrize(("policy", "want"), [("keep_first", ("x", 2, 2, 1)), ("keep_last", ("z", 1, 3, 5))])
def test_a_stream_takes_records_one_by_one(policy, want):
    """No frame is made for a key: its records come as rows, in any order, are read once, and one row comes out."""

    class Last:
        kept = None

        def exists(self):
            return self.kept is not None

        def get(self):
            return self.kept

        def update(self, value):
            self.kept = value

    Record, works = Row("key", "place", "content_hash", "source_id", "record"), keyed.LastContent(policy)
    works.last = Last()
    rows = [Record("a", str(n), h, "s", str(n)) for n, h in ((3, "x"), (5, "z"), (1, "x"), (2, "y"), (4, "x"))]
    hash_, same, other, record = want
    for change in ("new", "unchanged"):
        (told,) = works.handleInputRows(("a",), iter(rows), None)
        assert told.asDict() == {"key": "a", "change": change, "identical": same, "conflicting": other, "record": str(record)}
    assert works.last.kept == (hash_, "s")
    works.handleInitialState(("a",), Row(content_hash="old", source_id="t"), None)
    (told,) = works.handleInputRows(("a",), iter(rows), None)
    assert told.change == "changed"


@pytest.mark.parametrize("size", [500, 3000])
def test_files_are_read_in_parts(spark, tmp_path, size):
    """JSON arrays and CSV files are read by many tasks, wherever the parts are cut: within quotes, line breaks, between elements."""
    quoted = F.concat(F.lit('[\n{"a":\n"'), F.repeat(F.lit('",\n  {\n'), (F.col("id") % 90).cast("int")), F.lit("\n]"))
    rows = numbers(spark).withColumn("more", F.when(F.col("id") % 7 < 5, quoted)).orderBy("id")
    flat = rows.drop("m")
    publish(spark, [render(rows, str(tmp_path / "x.json"), "json"), render(rows.where("false"), str(tmp_path / "none.json"), "json"), render(flat, str(tmp_path / "x.csv"), "csv", "utf-8-sig"), render(flat.where("false"), str(tmp_path / "none.csv"), "csv")])
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        read = artifact.read_json(spark, [str(tmp_path / "x.json"), str(tmp_path / "none.json")], "id long, text string, third boolean, m map<string,string>, more string")
        lines = artifact.read_csv(spark, str(tmp_path / "x.csv"), flat.columns)
        assert read.rdd.getNumPartitions() > 20 and lines.rdd.getNumPartitions() > 20
        want = [tuple(r) for r in rows.select("id", "text", "third", "m", "more").collect()]
        assert sorted(map(tuple, read.collect()), key=lambda r: r[0]) == want
        found = sorted(map(tuple, lines.collect()), key=lambda r: r[-1])
        assert found == [(str(i), text, str(third).lower(), more, i) for i, text, third, _, more in want]
        assert artifact.read_csv(spark, str(tmp_path / "none.csv"), flat.columns).count() == 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
