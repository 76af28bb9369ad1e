"""Queries that write what a run writes, files, snapshots and the report, and read it back; SQL gives what must be found there."""

from __future__ import annotations

import tempfile
from pathlib import Path

import yaml
from pyspark.sql import functions as F

from orchardflow.operators.changes import merged_state
from orchardflow.operators.dedupe import duplicates, pair_up
from orchardflow.plans.queries import NOW, PLACED, RUN_SQL, WHY, _catalogue, _config, _table, query
from orchardflow.plans.run import pages_of, run
from orchardflow.sources import sinks
from orchardflow.sources.artifact import publish, read_csv, read_json, render
from orchardflow.sources.config import ConfigError, Dedupe, load_config
from orchardflow.sources.shared import fresh
from orchardflow.sources.state import read_state, write_state

PRICED = "cast(cast(round(p_retailprice * 100) as bigint) // 100 as varchar) || '.' || lpad(cast(cast(round(p_retailprice * 100) as bigint) % 100 as varchar), 2, '0')"


def _products(spark, sf_dir):
    """Parts as products of a run, with quotes, commas, line breaks and letters beyond ASCII in their titles."""
    title = F.concat("p_name", F.element_at(F.array(*map(F.lit, (', "new"', "\n two lines", " café 漢", ""))), (F.col("p_partkey") % 4 + 1).cast("int")))
    return _table(spark, sf_dir, "part").select(
        F.concat(F.lit("SKU-"), "p_partkey").alias("sku"),
        title.alias("title"),
        F.struct(F.lit("USD").alias("currency"), F.round(F.col("p_retailprice") * 100).cast("long").alias("minor")).alias("price"),
        F.lit("in_stock").alias("availability"),
        F.when(F.col("p_partkey") % 3 > 0, F.col("p_size") / 10).alias("rating"),
        F.lit(None).cast("string").alias("category"),
        F.date_add(F.lit("2026-01-01").cast("date"), (F.col("p_partkey") % 200).cast("int")).alias("listed_on"),
        F.concat(F.lit("http://x.test/"), "p_partkey").alias("url"),
        F.concat(F.lit("s"), F.col("p_partkey") % 3).alias("source_id"),
        F.col("p_partkey").cast("int").alias("page_no"),
        F.lit(NOW).cast("timestamp").alias("scraped_at"),
        F.lit("new").alias("change"),
        F.sha2("p_name", 256).alias("content_hash"),
        "p_partkey",
    )


def _written(rows, form: str, encoding: str = "utf-8-sig") -> str:
    spark = rows.sparkSession
    path = f"{fresh(spark, 'files')}/rows.{form}"
    publish(spark, [render(rows, path, form, encoding)])
    return path


TITLE = "p_name || case p_partkey % 4 when 0 then ', \"new\"' when 1 then chr(10) || ' two lines' when 2 then ' café 漢' else '' end"
RATED = "case when p_partkey % 3 > 0 then p_size / 10.0 end"


@query(f"select 'SKU-' || p_partkey as sku, {TITLE} as title, {PRICED} as price_amount, 'USD' as price_currency, cast({RATED} * 10 as integer) as rating, cast(date '2026-01-01' + cast(p_partkey % 200 as integer) as varchar) as listed_on, '2026-08-24T09:00:00+00:00' as scraped_at, sha256(p_name) as content_hash, row_number() over (order by p_partkey) - 1 as place from part")
def csv_artifact(spark, sf_dir):
    """The products' one CSV file, sorted, with a byte order mark; its rows and their places in it as they are read back."""
    made = sinks.product_rows(_products(spark, sf_dir).orderBy("p_partkey"))
    rows = read_csv(spark, _written(made, "csv"), made.columns)
    return rows.select("sku", "title", "price_amount", "price_currency", F.round(F.col("rating").cast("double") * 10).cast("int").alias("rating"), "listed_on", F.regexp_replace("scraped_at", "Z$", "+00:00").alias("scraped_at"), "content_hash", "place")


@query(f"select 'SKU-' || p_partkey as sku, {TITLE} as title, {PRICED} as amount, cast(round(p_retailprice * 100) as bigint) as minor_units, cast({RATED} * 10 as integer) as rating, cast(null as varchar) as category from part")
def json_artifact(spark, sf_dir):
    """The products' one JSON array, with prices as objects, parsed again."""
    rows = _products(spark, sf_dir).withColumn("_price", sinks.price_object())
    path = _written(sinks.product_rows_with_price(rows), "json")
    read = read_json(spark, path, "sku string, title string, rating double, category string, price struct<currency:string,amount:string,minor_units:bigint,minor_unit_digits:int>")
    return read.select("sku", "title", F.col("price.amount").alias("amount"), F.col("price.minor_units").alias("minor_units"), F.round(F.col("rating") * 10).cast("int").alias("rating"), "category")


@query("select lower(p_brand) as key, 'conflicting' as kind, cast(count(*) as bigint) as n, cast(0 as bigint) as torn from (select p_brand, row_number() over (partition by lower(p_brand) order by p_partkey) as r from part) where r > 1 group by 1")
def duplicates_artifact(spark, sf_dir):
    """The duplicates' JSON array, read with the empty array of no duplicates beside it: records by key, and those whose maps do not fit their lists of fields."""
    brand = _table(spark, sf_dir, "part").select("p_partkey", F.lower("p_brand").alias("key"))
    found = duplicates(pair_up(_products(spark, sf_dir).withColumn("seq", F.struct("p_partkey")).join(brand, "p_partkey")))
    rows = found.select("key", "kind", "differing_fields", "kept_values", "dropped_values")
    schema = "key string, kind string, differing_fields array<string>, kept_values map<string,string>, dropped_values map<string,string>"
    read = read_json(spark, [_written(rows, "json"), _written(rows.where("false"), "json")], schema)
    fits = F.array_sort(F.map_keys("kept_values")) == F.array_sort("differing_fields")
    return read.groupBy("key", "kind").agg(F.count("*").alias("n"), F.count_if(~fits).alias("torn"))


@query(RUN_SQL)
def report_file(spark, sf_dir):
    """A run's report, written, read again with its checks, as rows by source."""
    result = run(spark, _config(dedupe=Dedupe(key_fields=("title", "price"))), _catalogue(spark, sf_dir), NOW)
    folder = fresh(spark, "report")
    sinks.write_report(result.report, folder, {})
    result.release()
    found = sinks.read_report(f"{folder.removeprefix('file://')}/run-report.json")
    columns = ("source_id", "pages_fetched", "records_found", "valid", "rejected", "duplicates_conflicting")
    return spark.createDataFrame([tuple(s[c] for c in columns) for s in found["sources"]], "source_id string, " + ", ".join(f"{c} long" for c in columns[1:]))


@query("select 'k' || p_partkey as key, case when p_partkey % 2 = 0 then sha256(p_name) else sha256(p_brand) end as content_hash, 's' || (p_partkey % 2) as source_id from part where p_partkey % 2 = 0 or p_partkey % 5 > 0")
def state_between_runs(spark, sf_dir):
    """A snapshot of all parts, then one after a run of the odd ones' source alone, which met four fifths of them with other content; read back."""
    path = fresh(spark, "state")
    part = _table(spark, sf_dir, "part").select("p_partkey", "p_brand", F.concat(F.lit("k"), "p_partkey").alias("key"), F.sha2("p_name", 256).alias("content_hash"), F.concat(F.lit("s"), F.col("p_partkey") % 2).alias("source_id"))
    write_state(spark, path, part.select("key", "content_hash", "source_id"), NOW)
    met = part.where("p_partkey % 2 = 1 and p_partkey % 5 > 0").withColumn("content_hash", F.sha2("p_brand", 256))
    write_state(spark, path, merged_state(met, read_state(spark, path), ["s1"]), NOW)
    return read_state(spark, path).select("key", "content_hash", "source_id")


EVENT_SQL = f"""
with placed as ({PLACED})
select 'page fetched' as event, source_id, count(distinct page_no) as n from placed group by source_id
union all select 'record rejected', source_id, count(*) from placed where len({WHY}) > 0 group by source_id
"""


@query(EVENT_SQL)
def event_log(spark, sf_dir):
    """A run's events as the executors write them, counted by kind and source."""
    result = run(spark, _config(), _catalogue(spark, sf_dir), NOW)
    folder = fresh(spark, "events")
    sinks.write_events(_catalogue(spark, sf_dir), result, folder, NOW)
    result.release()
    return spark.read.json(folder).groupBy("event", "source_id").agg(F.count("*").alias("n"))


def _loaded(tree: dict, env: dict[str, str]):
    """A config file written from a tree and loaded; the driver reads it, nothing else does."""
    with tempfile.TemporaryDirectory() as folder:
        path = Path(folder) / "config.yaml"
        path.write_text(yaml.safe_dump(tree), encoding="utf-8")
        return load_config(path, env)


def _source(key: int, name: str, **more) -> dict:
    fields = {x: {"selector": f".{x}"} for x in ("sku", "title", "price", "url")}
    return {"id": f"n{key}", "start_url": "${BASE:-http://x.test}/" + name.lower().replace(" ", "-"), "record_selector": "li", "fields": fields, **more}


def _nations(spark, sf_dir: str) -> list:
    return _table(spark, sf_dir, "nation").orderBy("n_nationkey").collect()  # a source each; a config is the driver's


@query("select 'n' || n_nationkey as source_id, 'http://live.test/' || replace(lower(n_name), ' ', '-') as start_url, if(n_nationkey % 2 = 0, 'next_link', 'none') as strategy, cast(if(n_nationkey % 2 = 0, n_nationkey + 1, 20) as integer) as max_pages, if(n_nationkey % 3 = 0, 'mdy', 'dmy') as date_order, cast(n_nationkey as integer) as place from nation")
def config_scan(spark, sf_dir):
    """A config with a source for each nation, its variables expanded and its defaults filled in, as rows in its order."""
    made = [_source(n.n_nationkey, n.n_name, **({"pagination": {"strategy": "next_link", "next_selector": "a.next", "max_pages": n.n_nationkey + 1}} if n.n_nationkey % 2 == 0 else {}), **({"date_order": "mdy"} if n.n_nationkey % 3 == 0 else {})) for n in _nations(spark, sf_dir)]
    config = _loaded({"version": 1, "sources": made}, {"BASE": "http://live.test"})
    rows = [(s.id, s.start_url, s.pagination.strategy, s.pagination.max_pages, s.date_order, i) for i, s in enumerate(config.sources)]
    return spark.createDataFrame(rows, "source_id string, start_url string, strategy string, max_pages int, date_order string, place int")


REJECTED = "case n_nationkey % 6 when 0 then 'maps unknown fields' when 1 then 'does not map the required fields' when 2 then 'is not set' when 3 then 'has unknown keys' when 4 then 'must be an absolute' end"


@query(f"select n_nationkey, {REJECTED} as why from nation")
def config_rejects(spark, sf_dir):
    """Each nation's source in a config of its own, most with a fault: why the config is refused, or null."""

    def told(n) -> str | None:
        source = _source(n.n_nationkey, n.n_name)
        fault = n.n_nationkey % 6
        if fault == 0:
            source["fields"]["colour"] = {"selector": "b"}
        elif fault == 1:
            del source["fields"]["price"]
        elif fault == 2:
            source["record_selector"] = "${NOWHERE}"
        elif fault == 3:
            source["colour"] = "red"
        elif fault == 4:
            source["start_url"] = "/list"
        try:
            _loaded({"version": 1, "sources": [source]}, {})
        except ConfigError as wrong:
            return next(x for x in ("maps unknown fields", "does not map the required fields", "is not set", "has unknown keys", "must be an absolute") if x in str(wrong))
        return None

    return spark.createDataFrame([(n.n_nationkey, told(n)) for n in _nations(spark, sf_dir)], "n_nationkey int, why string")


@query("select 'n' || (c_custkey % 25) as source_id, count(*) as n from customer where c_custkey % 25 in (select n_nationkey from nation where n_regionkey in (2, 3)) group by 1")
def source_selection(spark, sf_dir):
    """A run of some of the config's sources, those of two regions, takes the pages of these alone."""
    nations = _nations(spark, sf_dir)
    config = _loaded({"version": 1, "sources": [_source(n.n_nationkey, n.n_name) for n in nations]}, {}).only([f"n{n.n_nationkey}" for n in nations if n.n_regionkey in (2, 3)])
    pages = _table(spark, sf_dir, "customer").select(F.concat(F.lit("n"), F.col("c_custkey") % 25).alias("source_id"))
    return pages_of(pages, config).groupBy("source_id").agg(F.count("*").alias("n"))
