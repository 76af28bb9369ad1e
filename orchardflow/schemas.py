"""Table schemas and closed vocabularies."""

from __future__ import annotations

from pyspark.sql import types as T

# The vocabularies of the data model.
AVAILABILITIES = ("in_stock", "out_of_stock", "preorder", "discontinued", "unknown")
FAILURE_KINDS = ("timeout", "connection_error", "rate_limited", "server_error", "client_error", "robots_disallowed", "browser_unavailable", "parse_error", "no_records")
CHANGES = ("new", "unchanged", "changed", "unknown")
DUPLICATE_KINDS = ("identical", "conflicting")
DATE_ORDERS = ("dmy", "mdy")
DECIMAL_SEPARATORS = ("auto", "dot", "comma")
STOP_REASONS = ("not_started", "single_page", "no_next_link", "empty_page", "no_records", "page_failed", "loop_detected", "max_pages")
REJECTION_CODES = ("missing", "no_currency", "unparsable", "out_of_range", "invalid")

#: field name: (normaliser, required)
FIELDS = {
    "sku": ("text", True),
    "title": ("text", True),
    "price": ("money", True),
    "url": ("url", True),
    "availability": ("availability", False),
    "rating": ("rating", False),
    "category": ("text", False),
    "listed_on": ("date", False),
}
REQUIRED = tuple(k for k, (_, required) in FIELDS.items() if required)
#: Compared when two records share a key, in this order.
COMPARED = ("sku", "title", "price", "availability", "rating", "category", "listed_on", "url")
ZERO_DECIMAL_CURRENCIES = ("JPY", "KRW")

MONEY = T.StructType([T.StructField("currency", T.StringType()), T.StructField("minor", T.LongType())])
REASON = T.StructType([T.StructField(x, T.StringType()) for x in ("field_name", "code", "detail")])
TEXT_MAP = T.MapType(T.StringType(), T.StringType(), True)
PAGES = T.StructType(
    [
        T.StructField("source_id", T.StringType()),
        T.StructField("page_no", T.IntegerType()),
        T.StructField("requested_url", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("status", T.IntegerType()),
        T.StructField("attempts", T.IntegerType()),
        T.StructField("fetched_with", T.StringType()),
        T.StructField("html", T.StringType()),
        T.StructField("error_kind", T.StringType()),
        T.StructField("error_message", T.StringType()),
        T.StructField("stopped_because", T.StringType()),
    ]
)
RECORDS = T.StructType(
    [
        T.StructField("source_id", T.StringType()),
        T.StructField("page_no", T.IntegerType()),
        T.StructField("page_url", T.StringType()),
        T.StructField("record_no", T.IntegerType()),
        T.StructField("fields", TEXT_MAP),
    ]
)
FAILURES = T.StructType([T.StructField("source_id", T.StringType()), T.StructField("url", T.StringType()), T.StructField("page_no", T.IntegerType()), T.StructField("kind", T.StringType()), T.StructField("attempts", T.IntegerType()), T.StructField("message", T.StringType())])
STATE = T.StructType([T.StructField("key", T.StringType()), T.StructField("content_hash", T.StringType())])
