"""Raw records to typed products or reasons for rejection, in native expressions over once-cleaned fields."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orchardflow.functions import values
from orchardflow.functions.text import clean_text, resolve_url
from orchardflow.schemas import FIELDS, REASON
from orchardflow.sources.config import Config

LIMITS = {"sku": 64, "title": 300, "category": 120}


def settings(spark: SparkSession, config: Config) -> DataFrame:
    """A row for each source of the config: (source_id, at, settings struct). ``places`` has the mapping order of its fields, ``selectors`` their selectors."""
    rows = [(s.id, i, (s.decimal_separator, s.default_currency, s.date_order, {k: n for n, k in enumerate(s.fields)}, {k: m.selector for k, m in s.fields.items()})) for i, s in enumerate(config.sources)]
    return spark.createDataFrame(rows, "source_id string, at int, settings struct<separator:string,currency:string,order:string,places:map<string,int>,selectors:map<string,string>>")


def utc_today() -> Column:
    """The UTC date of the query or micro-batch, whatever the session's time zone."""
    return F.date_from_unix_date(F.floor(F.unix_seconds(F.current_timestamp()) / 86400).cast("int"))


def _steps() -> list[values.Step]:
    """From a struct of the raw and cleaned fields and the source's settings to the typed fields, reasons and warning."""
    parsed = ("price", "url", "rating", "listed_on")

    def outcomes(get):
        row = get("text")
        return {**{x: row[f"n_{x}"] for x in ("price", "listed_on", "rating")}, "availability": values.availability(row["c_availability"])}

    def value(get, name):
        row = get("text")
        return row["r_url"]["value"] if name == "url" else get(name)["value"] if name in parsed else get(name) if name == "availability" else row[f"c_{name}"]

    def codes(get):
        found = {}
        for name, (_, required) in FIELDS.items():
            code = get("text")["r_url"]["code"] if name == "url" else get(name)["code"] if name in parsed else F.lit(None).cast("string")
            missing = F.when(value(get, name).isNull(), F.lit("missing")) if required else F.lit(None).cast("string")
            found[f"k_{name}"] = F.when(get("text")["settings"]["places"].getItem(name).isNotNull(), F.coalesce(code, missing))
        return found

    def reason(get, name):
        row = get("text")
        raw, conf = row["fields"].getItem(name), row["settings"]
        absent = F.when(raw.isNull(), F.concat(F.lit("nothing on the page for "), conf["selectors"].getItem(name))).otherwise("the element is blank")
        detail = F.when(get(f"k_{name}") == "missing", absent).otherwise(F.concat(F.lit("cannot use '"), raw, F.lit("'")))
        why = F.struct(F.lit(name).alias("field_name"), get(f"k_{name}").alias("code"), detail.alias("detail"))
        return F.when(get(f"k_{name}").isNotNull(), F.struct(conf["places"].getItem(name).alias("at"), why.alias("why")))

    def reasons(get):
        long = F.concat_ws("; ", *(F.when(F.length(value(get, x)) > n, F.lit(f"{x} has more than {n} characters")) for x, n in LIMITS.items()))
        return {"found": F.array_sort(F.array_compact(F.array(*(reason(get, x) for x in FIELDS)))), "long": long}

    def result(get):
        row = get("text")
        invalid = F.array(F.struct(F.lit("<record>").alias("field_name"), F.lit("invalid").alias("code"), get("long").alias("detail")))
        why = F.when((F.size(get("found")) == 0) & (get("long") != ""), invalid).otherwise(F.transform(get("found"), lambda x: x["why"]))
        unmapped = F.concat(row["source_id"], F.lit(": no availability is known for '"), row["fields"].getItem("availability"), F.lit("', on "), row["page_url"])
        named = [value(get, x).alias(x) for x in FIELDS]
        return {"result": F.struct(*named, why.cast(f"array<{REASON.simpleString()}>").alias("reasons"), F.when(get("availability") == "unknown", unmapped).alias("warning"))}

    return [outcomes, codes, reasons, result]


def normalize(records: DataFrame, config: Config, now: datetime | None) -> DataFrame:
    """Records with typed columns, ``reasons`` (empty for a valid record) and ``warning``.

    Every mapped field is tried, in the source's mapping order, and all reasons are kept. ``now`` (with a time zone) stands for the
    run's time throughout; its UTC date is what relative dates count from. None stands for the time of the query or, in a stream, of the micro-batch.
    Records of sources that the config lacks are left out.
    """
    raw = lambda x: F.col("fields").getItem(x)
    known = records.join(F.broadcast(settings(records.sparkSession, config).drop("at")), "source_id")  # as many rows as sources
    rows = known.select(*records.columns, "settings", *(clean_text(raw(x)).alias(f"c_{x}") for x in FIELDS if x != "url"), resolve_url(raw("url"), F.col("page_url")).alias("r_url"))
    conf, today = F.col("settings"), utc_today() if now is None else F.lit(now.date())
    parsed = values.staged(
        rows,
        n_price=(F.col("c_price"), values.money_steps(conf["separator"], conf["currency"])),
        n_listed_on=(F.col("c_listed_on"), values.date_steps(today, conf["order"])),
        n_rating=(F.col("c_rating"), values.rating_steps()),
    )
    given = F.struct("source_id", "page_url", "fields", "settings", *(f"c_{x}" for x in FIELDS if x != "url"), "r_url", "n_price", "n_listed_on", "n_rating")
    made = values.staged(parsed.select(*records.columns, given.alias("given")), n=(F.col("given"), _steps()))
    return made.select(
        *records.columns,
        *(F.col(f"n.{x}").alias(x) for x in FIELDS if x != "availability"),
        F.coalesce("n.availability", F.lit("unknown")).alias("availability"),
        F.col("n.availability").isNotNull().alias("availability_present"),
        (F.current_timestamp() if now is None else F.lit(now).cast("timestamp")).alias("scraped_at"),
        F.col("n.reasons").alias("reasons"),
        F.col("n.warning").alias("warning"),
    )


def valid(rows: DataFrame) -> DataFrame:
    return rows.where(F.size("reasons") == 0).drop("reasons", "warning", "fields")


def rejected(rows: DataFrame) -> DataFrame:
    return rows.where(F.size("reasons") > 0).select("source_id", "page_url", "page_no", "record_no", "reasons", F.col("fields").alias("raw_fields"))


def reason_counts(rows: DataFrame, reasons: str = "reasons") -> DataFrame:
    """(reason, n) over all rejected rows, by reason."""
    each = rows.select(F.explode(reasons).alias("r")).select(F.concat_ws(":", "r.field_name", "r.code").alias("reason"))
    return each.groupBy("reason").agg(F.count("*").alias("n")).orderBy("reason")
