"""Keys, hashes and renderings of product records."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from orchardflow.functions.text import escape_json, fold, squeeze
from orchardflow.functions.values import amount_text
from orchardflow.schemas import COMPARED

#: Joins the parts of a key; appears in no text.
KEY_MARK = "\u001f"


def _key_part(name: str, ascii_only: bool) -> Column:
    if name == "price":
        return F.coalesce(F.concat(F.col("price.minor").cast("string"), F.col("price.currency")), F.lit(""))
    if name in ("rating", "listed_on"):
        return F.coalesce(F.col(name).cast("string"), F.lit(""))
    return F.coalesce(F.lower(squeeze(F.col(name))), F.lit("")) if ascii_only else fold(F.col(name))


def dedupe_key(fields: tuple[str, ...] | list[str] = ("sku",), ascii_only: bool = False) -> Column:
    """The key of a product: its fields rendered, texts case-folded, joined by the unit separator. ``ascii_only`` has no Python in its plan at all."""
    return F.concat_ws(KEY_MARK, *(_key_part(x, ascii_only) for x in fields))


def content_hash(ascii_only: bool = False) -> Column:
    """SHA-256 of the business fields as compact JSON with sorted names, nulls stated, and escapes outside ASCII; native throughout. ``ascii_only`` has no escapes to put right."""
    text = F.to_json(
        F.struct("availability", "category", F.col("price.currency").alias("currency"), F.col("listed_on").cast("string").alias("listed_on"), F.col("price.minor").alias("minor"), "rating", "sku", "title", "url"),
        {"ignoreNullFields": "false", "writeNonAsciiCharacterAsCodePoint": "true"},
    )
    return F.sha2(text if ascii_only else escape_json(text), 256)


def shown(record: Column, name: str) -> Column:
    """A field of a product struct as text for a report: empty for null, money as "51.77 GBP"."""
    value = record[name]
    if name == "price":
        return F.coalesce(F.concat_ws(" ", amount_text(value["currency"], value["minor"]), value["currency"]), F.lit(""))
    return F.coalesce(value.cast("string"), F.lit(""))


def differing_fields(kept: Column, dropped: Column) -> Column:
    """The names of the compared fields in which two product structs differ, nulls being equal."""
    return F.array_compact(F.array(*(F.when(~kept[x].eqNullSafe(dropped[x]), F.lit(x)) for x in COMPARED)))


def values_of(record: Column, names: Column) -> Column:
    """map of the named fields' renderings, in compared order."""
    every = F.map_from_arrays(F.array(*map(F.lit, COMPARED)), F.array(*(shown(record, x) for x in COMPARED)))
    return F.map_filter(every, lambda k, _: F.array_contains(names, k))
