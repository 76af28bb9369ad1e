"""Pagination and fetch rules over tables of pages and responses."""

from __future__ import annotations

import urllib.parse

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orchardflow.sources.shared import discard, stored


def cut(pages: DataFrame, stops: Column, by: str = "source_id", order: str = "page_no") -> DataFrame:
    """The pages of each source up to and with its first that ``stops``, with ``is_stop``.

    The first stop of each source is an aggregate, combined before the shuffle, and pages meet it in a join that Spark can split.
    """
    marked = pages.withColumn("is_stop", F.coalesce(stops, F.lit(False)))
    first = marked.where("is_stop").groupBy(F.col(by).alias("_by")).agg(F.min(order).alias("_stop"))
    return marked.join(first, F.col(by).eqNullSafe(F.col("_by")), "left").where(F.col("_stop").isNull() | (F.col(order) <= F.col("_stop"))).drop("_by", "_stop")


def capped(pages: DataFrame, max_pages: Column | int, by: str = "source_id", order: str = "page_no", at_most: int = 1000) -> DataFrame:
    """At most ``max_pages`` pages of each source, in order; never more than ``at_most``, the bound of a config's page cap.

    The constant bound lets Spark cut each source's rows within every task before they are shuffled, however many a source has.
    """
    place = F.row_number().over(Window.partitionBy(by).orderBy(order))
    most = max_pages if isinstance(max_pages, int) else at_most
    return pages.withColumn("_place", place).where(F.col("_place") <= most).where(F.col("_place") <= max_pages).drop("_place")


def empty_page(n_records: Column, is_first: Column) -> Column:
    """``no_records`` for an empty first page, ``empty_page`` for a later one, null for pages with records."""
    return F.when(n_records == 0, F.when(is_first, "no_records").otherwise("empty_page"))


def follow(links: DataFrame, start: DataFrame, max_pages: int = 1000) -> DataFrame:
    """(source_id, page_no, url, stopped_because) along next links from each source's start.

    ``links`` has (source_id, url, next_url), ``start`` (source_id, url). A URL met before ends with ``loop_detected``, a missing link with
    ``no_next_link``, a page without a row in ``links`` with ``page_failed``, the cap with ``max_pages``. Of rows that repeat a page the least link counts.

    The step doubles: round k knows each page's 2^k-th successor, so that it reaches 2^k pages further from every page reached so far, and the rounds are as
    many as the logarithm of the longest walk. A page keeps its least number, so a walk in a loop stops growing when it is round. Each round
    is written to the shared folder.
    """
    links = links.where("source_id is not null and url is not null").groupBy("source_id", "url").agg(F.min("next_url").alias("next_url"))
    known = stored(links.join(start.select("source_id").distinct(), "source_id", "left_semi"), "links")
    jumps = known.where("next_url is not null").select("source_id", "url", F.col("next_url").alias("to"))
    reached = stored(start.where("source_id is not null and url is not null").select("source_id", "url", F.lit(1).alias("page_no")).distinct(), "reached")
    n, step = reached.count(), 1
    while step < max_pages:
        further = reached.join(jumps, ["source_id", "url"]).select("source_id", F.col("to").alias("url"), (F.col("page_no") + step).alias("page_no")).where(F.col("page_no") <= max_pages)
        now = stored(reached.unionByName(further).groupBy("source_id", "url").agg(F.min("page_no").alias("page_no")), "reached")
        before, n = n, now.count()
        discard(reached)
        reached = now
        step *= 2
        if n == before or step >= max_pages:
            break
        second = jumps.select("source_id", F.col("url").alias("to"), F.col("to").alias("beyond"))
        doubled = stored(jumps.join(second, ["source_id", "to"]).select("source_id", "url", F.col("beyond").alias("to")), "jumps")
        if step > 2:
            discard(jumps)
        jumps = doubled
    pages = reached.join(known.withColumn("there", F.lit(True)), ["source_id", "url"], "left")
    back = reached.select("source_id", F.col("url").alias("next_url"), F.col("page_no").alias("next_no"))
    why = (
        F.when(F.col("there").isNull(), "page_failed")
        .when(F.col("next_url").isNull(), "no_next_link")
        .when(F.col("next_no") <= F.col("page_no"), "loop_detected")
        .when(F.col("page_no") == max_pages, "max_pages")
    )
    return pages.join(back, ["source_id", "next_url"], "left").select("source_id", "page_no", "url", why.alias("stopped_because"))


def page_urls(sources: DataFrame) -> DataFrame:
    """(source_id, page_no, url) for sources paged by a parameter: start_url, page_param, start_page, max_pages."""
    numbered = sources.select("source_id", "start_url", "page_param", F.explode(F.sequence("start_page", F.col("start_page") + F.col("max_pages") - 1)).alias("page_no"))
    return numbered.select("source_id", "page_no", with_parameter(F.col("start_url"), F.col("page_param"), F.col("page_no").cast("string")).alias("url"))


def with_parameter(url: Column, name: Column, value: Column) -> Column:
    """The URL with one query parameter set: any old value goes, as do parameters without a value."""
    bare = F.substring_index(url, "#", 1)
    fragment = F.when(F.instr(url, "#") > 0, F.concat(F.lit("#"), F.substring_index(url, "#", -1))).otherwise("")
    query = F.when(F.instr(bare, "?") > 0, F.substring_index(bare, "?", -1)).otherwise("")
    pairs = F.filter(F.split(query, "&"), lambda p: (F.instr(p, "=") > 0) & ~p.endswith("=") & (F.substring_index(p, "=", 1) != name))
    return F.concat(F.substring_index(bare, "?", 1), F.lit("?"), F.array_join(F.concat(pairs, F.array(F.concat(name, F.lit("="), value))), "&"), fragment)


def response_kind(status: Column) -> Column:
    """The failure kind of an HTTP status; null for success."""
    return F.when(status < 400, None).when(status == 429, "rate_limited").when(status >= 500, "server_error").otherwise("client_error")


def is_retryable(kind: Column) -> Column:
    return kind.isin("timeout", "connection_error", "rate_limited", "server_error")


def retry_after_seconds(header: Column) -> Column:
    """The seconds form of a Retry-After header; null for anything else."""
    seconds = F.trim(header).try_cast("double")
    return F.when((seconds >= 0) & (seconds < float("inf")), seconds)


def backoff_seconds(attempt: Column, base: float, cap: float, retry_after: Column | None = None) -> Column:
    """The wait after a failed attempt: doubling from ``base`` up to ``cap``, and no less than the server asks."""
    wait = F.least(F.lit(base) * F.pow(F.lit(2.0), attempt - 1), F.lit(cap))
    return wait if retry_after is None else F.greatest(wait, F.coalesce(retry_after, F.lit(0.0)))


def robots_allows(status: Column, disallowed: Column) -> Column:
    """Whether a URL may be fetched: its origin's robots.txt was read and does not disallow it, or is absent (4xx).

    A server error or no answer (null) denies.
    """
    return F.when(status.between(200, 299), ~F.coalesce(disallowed, F.lit(False))).otherwise(F.coalesce(status.between(400, 499), F.lit(False)))


RULES = "array<struct<group:int,agents:array<string>,path:string,allow:boolean>>"


def robots_lines(body: str) -> list[dict]:
    """The rules of a robots.txt in order, as mappings with the fields of ``RULES``; paths are percent-decoded, agents in lower case.

    A group begins with its agents and ends at an empty line or at an agent line after a rule; its last rule here allows whatever none before decided.
    """
    found: list[dict] = []
    agents: list[str] = []
    group, ruled = 0, False
    for line in [*body.splitlines(), ""]:
        name, _, value = line.partition("#")[0].partition(":")
        name, value = name.strip().lower(), urllib.parse.unquote(value.strip())
        if not line or (name == "user-agent" and ruled):
            if ruled:
                found.append({"group": group, "agents": agents, "path": "", "allow": True})
            agents, group, ruled = [], group + 1, False
        if name == "user-agent":
            agents = [*agents, value.lower()]
        elif agents and name in ("allow", "disallow"):
            found.append({"group": group, "agents": agents, "path": value, "allow": name == "allow" or not value})
            ruled = True
        elif agents and name in ("crawl-delay", "request-rate"):
            ruled = True
    return found


def robots_verdicts(urls: DataFrame, files: DataFrame, agent: str, longest: bool = False) -> DataFrame:
    """``urls`` (url and more) with ``allowed``, by the robots files (origin, status, body) of their origins.

    The first group that names the agent holds, or else the first one for ``*``. In it the first rule whose path begins what follows the origin counts or, with ``longest``, the
    longest such rule, of equal ones one that allows; without any the URL is allowed. An absent file (4xx) allows all; a server error, or no row for the origin, nothing.

    The rules of an origin are one row, which meets the origin's URLs in an equi-join that Spark broadcasts or splits as sizes ask; they are tried within the row.
    """

    @F.arrow_udf(RULES)
    def parsed(body: pa.Array) -> pa.Array:
        kind = pa.list_(pa.struct([("group", pa.int32()), ("agents", pa.list_(pa.string())), ("path", pa.string()), ("allow", pa.bool_())]))
        return pa.array([[] if x is None else robots_lines(x) for x in body.to_pylist()], kind)

    own = F.lit(agent.split("/")[0].lower())
    for_all = lambda r: F.array_contains(r["agents"], "*")
    first = lambda fits: F.get(F.filter("_all", fits), F.lit(0))["group"]
    group = F.coalesce(first(lambda r: ~for_all(r) & F.exists(r["agents"], lambda a: F.contains(own, a))), first(for_all))
    held = files.select(F.lower("origin").alias("_origin"), F.col("status").alias("_status"), parsed(F.when(F.col("status").between(200, 299), F.col("body"))).alias("_all"))
    held = held.select("_origin", "_status", F.filter("_all", lambda r: r["group"] == group).alias("_rules"))
    start = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*"
    rest = F.regexp_replace("url", start, "")
    path = F.coalesce(F.try_url_decode(F.replace(rest, F.lit("+"), F.lit("%2B"))), rest)
    joined = urls.withColumns({"_at": F.lower(F.regexp_extract("url", start, 0)), "_path": F.when(path == "", "/").otherwise(path)}).join(held, F.col("_at") == F.col("_origin"), "left")
    fits = F.filter("_rules", lambda r: F.startswith(F.col("_path"), r["path"]))
    if longest:
        fits = F.array_sort(F.transform(fits, lambda r: F.struct((-F.length(r["path"])).alias("n"), (~r["allow"]).alias("denies"), r["allow"].alias("allow"))))
    verdict = F.coalesce(F.get(fits, F.lit(0))["allow"], F.lit(True))
    return joined.select(*urls.columns, robots_allows(F.col("_status"), ~verdict).alias("allowed"))
