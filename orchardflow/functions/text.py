"""Text functions. What needs Python's Unicode tables is an Arrow UDF; plain ASCII rows are worked natively and reach Python as nulls only."""

from __future__ import annotations

import html
import unicodedata
from urllib.parse import urljoin, urlsplit

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Characters of no width that are deleted.
NO_WIDTH = "​‌‍﻿­"

#: Paths and hosts in which nothing is to be decoded, resolved, dropped or refused, so that joining them is all there is to do.
PLAIN_PATH, PLAIN_ORIGIN = r"\A(?:/[A-Za-z0-9_-]+)+\z", r"\A(https?://[a-z0-9](?:[a-z0-9.-]*[a-z0-9])?(?::[0-9]+)?)(?:[/?#]|\z)"


def cleaned(raw: str | None) -> str | None:
    """Entities decoded, no-width characters deleted, NFKC, white space collapsed; None for what is then empty."""
    if raw is None:
        return None
    if "&" in raw:
        raw = html.unescape(raw)
    if not raw.isascii():
        for x in NO_WIDTH:
            if x in raw:
                raw = raw.replace(x, "")
        raw = raw.replace("\xa0", " ")  # as NFKC has it
        if not unicodedata.is_normalized("NFKC", raw):
            raw = unicodedata.normalize("NFKC", raw)
    return " ".join(raw.split()) or None


def resolved(link: str | None, page: str | None) -> tuple[str | None, str | None]:
    """(absolute http(s) URL without its fragment, None), or (None, rejection code); (None, None) for null."""
    text = cleaned(link)
    if text is None:
        return None, None
    try:
        scheme = urlsplit(text).scheme.lower()
        full = urljoin(page or "", text).partition("#")[0]
    except ValueError:  # a malformed host rejects its record only
        return None, "unparsable"
    if scheme not in ("", "http", "https") or not full.startswith(("http://", "https://")):
        return None, "unparsable"
    return full, None


@F.arrow_udf(T.StringType())
def _clean(raw: pa.Array) -> pa.Array:
    return pa.array([cleaned(x) for x in raw.to_pylist()] if raw.null_count < len(raw) else [None] * len(raw), pa.string())


def is_ascii(text: Column) -> Column:
    return F.length(text) == F.octet_length(text)


def clean_text(raw: Column) -> Column:
    """:func:`cleaned`, natively where the text is ASCII and has no entities."""
    plain = is_ascii(raw) & (F.instr(raw, "&") == 0)
    return F.when(plain, squeeze(raw)).otherwise(_clean(F.when(~plain, raw)))


@F.arrow_udf(T.StructType([T.StructField("value", T.StringType()), T.StructField("code", T.StringType())]))
def _resolve(link: pa.Array, page: pa.Array) -> pa.Array:
    pairs = [resolved(a, b) for a, b in zip(link.to_pylist(), page.to_pylist(), strict=True)]
    return pa.array([{"value": a, "code": b} for a, b in pairs], pa.struct([("value", pa.string()), ("code", pa.string())]))


def resolve_url(link: Column, page: Column) -> Column:
    """struct<value, code> of a link on a page: :func:`resolved`, natively for a plain path from the root of a plain host, and for null."""
    origin = F.regexp_extract(page, PLAIN_ORIGIN, 1)
    plain = F.coalesce(link.rlike(PLAIN_PATH) & (origin != ""), link.isNull())
    other = _resolve(F.when(~plain, link), F.when(~plain, page))
    native = F.struct(F.concat(origin, link).alias("value"), F.lit(None).cast("string").alias("code"))
    return F.when(~plain, other).otherwise(native)


@F.arrow_udf(T.StringType())
def _fold(text: pa.Array) -> pa.Array:
    return pa.array([None if x is None else " ".join(x.casefold().split()) for x in text.to_pylist()], pa.string())


def fold(text: Column) -> Column:
    """Full case folding with white space collapsed; null gives the empty string. ASCII is folded natively."""
    plain = is_ascii(text)
    return F.coalesce(F.when(plain, F.lower(squeeze(text))).otherwise(_fold(F.when(~plain, text))), F.lit(""))


def escape_json(text: Column) -> Column:
    """JSON text, in which everything outside ASCII is escaped already, with its escapes in lower case, as ``to_json`` has them in upper case.

    An escaped backslash is no part of an escape. DEL is escaped too.
    """
    pairs = F.replace(F.replace(text, F.lit("\\\\"), F.lit("\x01")), F.lit("\x7f"), F.lit("\\u007F"))  # no control character stands in JSON text
    parts = F.split(pairs, r"\\u")
    low = F.transform(parts, lambda x, i: F.when(i == 0, x).otherwise(F.concat(F.lower(F.left(x, F.lit(4))), F.substring(x, F.lit(5), F.length(x)))))
    escaped = F.replace(F.array_join(low, "\\u"), F.lit("\x01"), F.lit("\\\\"))
    return F.when(F.contains(text, F.lit("\\u")) | F.contains(text, F.lit("\x7f")), escaped).otherwise(text)


def squeeze(text: Column) -> Column:
    """Native form of :func:`clean_text` for ASCII text without entities."""
    plain = F.trim(F.regexp_replace(text, r"[ \t\n\x0B\f\r\x1C-\x1F]+", " "))
    return F.when(plain != "", plain)
