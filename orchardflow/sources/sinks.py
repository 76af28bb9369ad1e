"""Outputs: the four datasets as CSV and JSON, and the report.

``write_files`` makes single files, each joined by one task of what all tasks rendered. ``write_tables`` writes the same columns as CSV and JSON-lines
folders, a file a task. The names and order of the columns are fixed values: consumers read the files by them.
"""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orchardflow.functions.records import KEY_MARK
from orchardflow.functions.values import amount_text, minor_digits
from orchardflow.sources.artifact import publish, render


def product_rows(products: DataFrame) -> DataFrame:
    amount = amount_text(F.col("price.currency"), F.col("price.minor"))
    return products.select(
        "sku",
        "title",
        amount.alias("price_amount"),
        F.col("price.currency").alias("price_currency"),
        "availability",
        "rating",
        "category",
        F.col("listed_on").cast("string").alias("listed_on"),
        "url",
        "source_id",
        "page_no",
        F.date_format("scraped_at", "yyyy-MM-dd'T'HH:mm:ssXXX").alias("scraped_at"),
        "change",
        "content_hash",
    )


def price_object() -> Column:
    """The price as a nested object, for JSON."""
    money = F.col("price")
    return F.struct(money["currency"].alias("currency"), amount_text(money["currency"], money["minor"]).alias("amount"), money["minor"].alias("minor_units"), minor_digits(money["currency"]).alias("minor_unit_digits"))


def rejected_rows(rejected: DataFrame) -> DataFrame:
    sorted_map = F.map_from_entries(F.array_sort(F.map_entries("raw_fields")))
    return rejected.select(
        "source_id",
        "page_no",
        "page_url",
        F.array_join(F.transform("reasons", lambda r: F.concat_ws(":", r["field_name"], r["code"])), "; ").alias("reasons"),
        F.array_join(F.transform("reasons", lambda r: r["detail"]), " | ").alias("detail"),
        F.to_json(sorted_map, {"ignoreNullFields": "false"}).alias("raw"),
    )


def duplicate_rows(duplicates: DataFrame) -> DataFrame:
    pairs = lambda c: F.array_join(F.transform(F.map_entries(c), lambda e: F.concat_ws("=", e["key"], e["value"])), "; ")
    return duplicates.select(
        F.replace(F.col("key"), F.lit(KEY_MARK), F.lit(" | ")).alias("key"),
        "kind",
        F.array_join("differing_fields", ", ").alias("differing_fields"),
        pairs("kept_values").alias("kept_values"),
        pairs("dropped_values").alias("dropped_values"),
        "kept_source_id",
        "kept_url",
        "dropped_source_id",
        "dropped_url",
    )


def failure_rows(failures: DataFrame) -> DataFrame:
    return failures.select("source_id", "page_no", "url", "kind", "attempts", "message")


def datasets(result) -> dict[str, tuple[DataFrame, DataFrame]]:
    """name: (flat rows for CSV, structured rows for JSON)."""
    products, duplicates = product_rows(result.products), duplicate_rows(result.duplicates)
    nested = result.products.withColumn("_price", price_object())
    structured = result.duplicates.select(F.replace(F.col("key"), F.lit(KEY_MARK), F.lit(" | ")).alias("key"), "kind", "differing_fields", "kept_values", "dropped_values", "kept_source_id", "kept_url", "dropped_source_id", "dropped_url")
    return {
        "products": (products, product_rows_with_price(nested)),
        "rejected": (rejected_rows(result.rejected),) * 2,
        "duplicates": (duplicates, structured),
        "failures": (failure_rows(result.failures),) * 2,
    }


def product_rows_with_price(products: DataFrame) -> DataFrame:
    amount = amount_text(F.col("price.currency"), F.col("price.minor"))
    flat = product_rows(products).columns
    every = products.select("*", amount.alias("price_amount"), F.col("price.currency").alias("price_currency"))
    every = every.withColumns({"listed_on": F.col("listed_on").cast("string"), "scraped_at": F.date_format("scraped_at", "yyyy-MM-dd'T'HH:mm:ssXXX")})
    return every.select(*flat, F.col("_price").alias("price"))


def write_files(result, folder: str | Path, formats: tuple[str, ...] = ("csv", "json"), encoding: str = "utf-8-sig") -> dict[str, str]:
    """Each dataset in each format as one file, empty ones too, and ``run-report.json``. Gives the paths by name.

    The executors render the rows and join the files; see :mod:`orchardflow.sources.artifact`.
    """
    folder = str(folder) if "://" in str(folder) else str(Path(folder).absolute())
    made, spark = {}, result.products.sparkSession
    for name, (flat, structured) in datasets(result).items():
        for form, rows, code in (("csv", flat, encoding), ("json", structured, "utf-8")):
            if form in formats:
                made[f"{name}.{form}"] = render(rows, f"{folder}/{name}.{form}", form, code)
    publish(spark, list(made.values()))
    written = {name: a.path for name, a in made.items()} | {"run-report.json": f"{folder}/run-report.json"}
    write_report(result.report, folder, written)
    return written


def write_report(report: dict, folder: str | Path, outputs: dict[str, str]) -> None:
    """``run-report.json`` in a folder, of the driver's or of a store."""
    from pyarrow import fs

    store, base = fs.FileSystem.from_uri(str(folder) if "://" in str(folder) else str(Path(folder).absolute()))
    store.create_dir(base, recursive=True)
    with store.open_output_stream(f"{base}/run-report.json") as out:
        out.write(json.dumps(report | {"outputs": outputs}, indent=2, ensure_ascii=False).encode())


def read_report(path: str | Path) -> dict:
    """A written report, checked: every counter is there, and they reconcile."""
    from orchardflow.operators.report import COUNTERS, Unreconciled

    found = json.loads(Path(path).read_text(encoding="utf-8"))
    for s in found["sources"]:
        if s["records_found"] != s["valid"] + s["rejected"] + s["duplicates_identical"] + s["duplicates_conflicting"]:
            raise Unreconciled(f"counters of {s['source_id']} do not reconcile")
    if any(found["totals"][c] != sum(s[c] for s in found["sources"]) for c in COUNTERS):
        raise Unreconciled("totals are not the sums of the sources' counters")
    return found


def write_tables(result, folder: str, formats: tuple[str, ...] = ("csv", "json")) -> None:
    """Each dataset as a folder of part files, written by the executors."""
    for name, (flat, structured) in datasets(result).items():
        if "csv" in formats:
            keep = {"header": True, "nullValue": "", "emptyValue": "", "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
            flat.write.mode("overwrite").options(**keep).csv(f"{folder}/{name}.csv")
        if "json" in formats:
            structured.write.mode("overwrite").option("ignoreNullFields", False).json(f"{folder}/{name}.json")


def event_rows(pages: DataFrame, result, now) -> DataFrame:
    """(at, level, event, source_id, data): what happened to each page and each record that was not exported; ``data`` is JSON.

    The executors' own logs end with them; these rows come from the tables of the run, so they are as many and the same however often a task ran.
    """

    def rows(df: DataFrame, level: str, event: str, *data: Column) -> DataFrame:
        return df.select(F.date_format(F.lit(now).cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ssXXX").alias("at"), F.lit(level).alias("level"), F.lit(event).alias("event"), "source_id", F.to_json(F.struct(*data)).alias("data"))

    fetched, failed = pages.where("error_kind is null"), pages.where("error_kind is not null")
    reasons = F.transform("reasons", lambda r: F.concat_ws(":", r["field_name"], r["code"])).alias("reasons")
    parts = [
        rows(fetched, "INFO", "page fetched", F.col("url"), F.col("page_no"), F.col("status"), F.col("attempts"), F.col("fetched_with")),
        rows(failed, "WARNING", "page failed", F.coalesce("requested_url", "url").alias("url"), F.col("page_no"), F.col("error_kind").alias("kind"), F.col("attempts"), F.col("error_message").alias("message")),
        rows(pages.where(F.col("attempts") > 1), "INFO", "page fetch tried again", F.col("url"), F.col("attempts")),
        rows(pages.where("stopped_because is not null"), "INFO", "pagination stopped", F.col("page_no"), F.col("stopped_because").alias("reason")),
        rows(result.rejected, "INFO", "record rejected", F.col("page_url").alias("url"), F.col("record_no"), reasons),
        rows(result.duplicates, "INFO", "duplicate dropped", F.col("key"), F.col("kind"), F.col("dropped_url").alias("url")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def write_events(pages: DataFrame, result, folder: str, now) -> None:
    """The event rows as JSON lines, a file a task."""
    event_rows(pages, result, now).write.mode("append").json(folder)
