"""Queries that apply the operators to the driver's tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orchardflow.llm import ann, bpe, divergence, embed_dedup, html_text, packing, quality, simhash, spelling, suffix_dedup, token_counts, toxicity, warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(_table(spark, sf_dir, "documents"), _vocabulary("byte_bpe_50k.tiktoken"), keep_ids=False)


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op4_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(_table(spark, sf_dir, "documents"), _vocabulary("word_bpe_49k.json"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's columns for strings of 400 bytes, and the texts without repeated passages of over 50 words."""
    return suffix_dedup.dedup(_table(spark, sf_dir, "documents"), keep_text=False, passage=suffix_dedup.PASSAGE)


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), _vocabulary("word_bpe_49k.json"), keep_ids=False)


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(_table(spark, sf_dir, "pages"))


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(_table(spark, sf_dir, "documents"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(_table(spark, sf_dir, "documents"))


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(_table(spark, sf_dir, "pages"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_byte_bpe, op2_quality, op3_toxicity, op4_nearest, op5_token_counts, op6_suffix_dedup, op7_simhash, op8_packing, op9_html_text, op10_embedding_dedup, op11_divergence, op12_spelling, op13_warc)}


#: Links and components of op10 by comparing all vectors of a label. The other operators rest on hashes, models, vocabularies or approximate search.
OP10_SQL = """
with recursive
rows_in as materialized (select vec_id, label, embedding::double[] as v from embeddings),
fine as materialized (
    select * from rows_in
    where vec_id is not null and label is not null and v is not null
      and len(list_filter(v, lambda x: x is not null and isfinite(x))) = len(v) and len(list_filter(v, lambda x: x <> 0)) > 0
),
common as materialized (select len(v) as size from fine group by 1 order by count(*) desc, 1 limit 1),
vectors as materialized (
    select row_number() over () as k, vec_id, label, v, sqrt(list_dot_product(v, v)) as norm
    from (select distinct vec_id, label, v from fine where len(v) = (select size from common))
),
links as materialized (
    select a.k as a, b.k as b
    from vectors a join vectors b on a.label = b.label and a.k <> b.k
    where list_dot_product(a.v, b.v) / (a.norm * b.norm) >= 0.93 or a.v = b.v
),
reached as (
    select k, vec_id as found from vectors
    union
    select links.b, reached.found from reached join links on links.a = reached.k
),
told as (
    select k, vec_id, label, v, (select count(*) from links where links.a = k) as n_links, (select min(found) from reached where reached.k = vectors.k) as component_id
    from vectors
)
select r.vec_id, coalesce(t.n_links, 0) as n_links, coalesce(t.component_id, r.vec_id) as component_id, coalesce(r.vec_id = coalesce(t.component_id, r.vec_id), true) as kept
from rows_in r left join told t on r.vec_id = t.vec_id and r.label = t.label and r.v = t.v
"""


#: Counts of all terms, smoothed shares of kept ones, all pairs of a language's groups and the first 50 terms of each.
OP11_SQL = r"""
with docs as materialized (
    select row_number() over () as d, coalesce(lang, '') as lang, coalesce(source, '') as source,
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text
    from documents
),
terms as materialized (select d, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term from docs),
kept as materialized (select lang, term, count(*)::hugeint as c from terms group by all having count(distinct d) >= 30),
langs as materialized (select lang, count(*)::hugeint as v, sum(c)::hugeint as total from kept group by lang),
groups as materialized (select distinct lang, source from docs),
counted as materialized (select lang, source, term, count(*)::hugeint as n from terms semi join kept using (lang, term) group by all),
totals as materialized (select lang, source, sum(n)::hugeint as total from counted group by all),
shares as materialized (
    select g.lang, g.source, k.term, coalesce(n, 0) as n, 1 + (1000000000 * (coalesce(n, 0) + 5)) // (coalesce(t.total, 0) + 5 * l.v) as p,
        1 + (1000000000 * (k.c + 5)) // (l.total + 5 * l.v) as q
    from groups g join kept k using (lang) join langs l using (lang)
    left join totals t on t.lang = g.lang and t.source = g.source
    left join counted c on c.lang = g.lang and c.source = g.source and c.term = k.term
),
pairs as (
    select a.lang, a.source, b.source as item, sum(abs(a.p - b.p)) as value
    from shares a join shares b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all
),
every as (
    select a.lang, a.source, 'pair' as part, b.source as item, coalesce(value, 0) as value
    from groups a join groups b on a.lang = b.lang and a.source <> b.source
    left join pairs p on p.lang = a.lang and p.source = a.source and p.item = b.source
    union all
    select lang, source, 'term', term, p - q from shares where n > 0 and p > q
),
ranked as (select *, row_number() over (partition by lang, source, part order by value desc, item) as rank from every)
select lang, source, part, item, value::bigint as value, rank::integer as rank from ranked where part = 'pair' or rank <= 50
"""


#: crc32 by its polynomial, a table of 256 remainders and a step a byte; near words share what is left when one place of each is dropped or blanked.
OP12_SQL = r"""
with recursive
remainders as materialized (
    select list(list_reduce(list_prepend(i, range(8)), lambda c, k: if(c & 1 = 1, xor(c >> 1, 3988292384), c >> 1)) order by i) as t from range(256) r(i)
),
runs as materialized (
    select coalesce(doc_id::varchar, '') as id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]+')) as run
    from documents
),
counted as materialized (select id, run, count(*) as n from runs where length(run) >= 6 group by all),
summed as materialized (
    select run, n, xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(rtrim(regexp_replace(hex(encode(id || ':' || run)), '(..)', '\1 ', 'g')), ' '), lambda x: ('0x' || x)::bigint)),
        lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1])), 4294967295::bigint) as h
    from counted, remainders
),
slipped as (
    select if(h % 199 = 0, left(run, (h % length(run))::bigint) || substr(run, (h % length(run))::bigint + 2), run) as word, n from summed
),
words as materialized (select word, sum(n)::bigint as n from slipped where length(word) >= 6 group by word having sum(n) >= 5),
places as materialized (select word, n, unnest(range(1, length(word) + 1)) as i from words),
dropped as materialized (select word, n, i, left(word, i - 1) || substr(word, i + 1) as rest from places),
pairs as materialized (
    select a.word, b.word as near, b.n as near_n from dropped a join dropped b on a.i = b.i and a.rest = b.rest and length(a.word) = length(b.word) and a.word <> b.word
    union
    select a.word, b.word, b.n from dropped a join words b on a.rest = b.word
    union
    select b.word, a.word, a.n from dropped a join words b on a.rest = b.word
),
best as materialized (select word, count(*) as n_near, max(near_n) as most from pairs group by word),
named as materialized (select p.word, min(near) as near from pairs p join best b on p.word = b.word and p.near_n = b.most group by p.word),
forms as materialized (
    select w.word, w.n, coalesce(n_near, 0) as n_near, if(most >= 5 * w.n, near, null) as form, if(most >= 5 * w.n, most, null) as form_n
    from words w left join best b using (word) left join named m using (word)
),
walk as (
    select word, form as at from forms where form is not null
    union all
    select walk.word, f.form from walk join forms f on f.word = walk.at where f.form is not null
),
ends as (select walk.word, walk.at as root from walk join forms f on f.word = walk.at where f.form is null)
select f.word, n, n_near, form, form_n, coalesce(root, f.word) as root from forms f left join ends using (word)
"""

#: Types and references of the records by a window over equal payloads; digests by DuckDB's own SHA-256.
OP13_SQL = """
with pages_in as (select page_id, coalesce(html, '') as html from pages),
placed as (
    select page_id, strlen(html)::bigint as payload_bytes, sha256(html) as payload_digest,
        row_number() over (partition by html order by page_id nulls last) as place, first_value(page_id) over (partition by html order by page_id nulls last) as first
    from pages_in
)
select page_id, payload_bytes, payload_digest, if(payload_bytes >= 100 and place > 1, 'revisit', 'response') as record_type, if(payload_bytes >= 100 and place > 1, first, null) as refers_to
from placed
"""


def oracle_sql() -> dict[str, str]:
    return {"op10_embedding_dedup": OP10_SQL, "op11_divergence": OP11_SQL, "op12_spelling": OP12_SQL, "op13_warc": OP13_SQL}
