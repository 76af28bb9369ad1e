"""Each stage of the pipeline against brute force over its own input, and the pipeline as a whole."""

import re
import zlib
from pathlib import Path

import pytest

import corpus_pipeline
from orchardflow.llm import suffix_dedup
from orchardflow.llm._common import map_batches
from tests.llm.test_suffix_dedup import brute_passages

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    if not Path(DATA).exists():
        pytest.skip("no test tables")
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    made = [docs]
    for _, f in corpus_pipeline.STAGES:
        made.append(f(spark, made[-1], DATA).cache())
    return made


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "quality", "simhash", "suffix_array", "packing"]


def test_columns_stay(stages):
    for df in stages[1:-1]:
        assert df.columns == stages[0].columns and [f.dataType for f in df.schema] == [f.dataType for f in stages[0].schema]


def test_filters_keep_clean_documents(spark, stages):
    labels = {r.doc_id: r for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    for before, after, bad in ((stages[0], stages[1], lambda r: r.toxic == 1), (stages[1], stages[2], lambda r: r.quality == 0)):
        had, has = {r.doc_id for r in before.collect()}, {r.doc_id for r in after.collect()}
        assert has <= had and after.count() == len(has)
        clean = [i for i in had if i in labels and not bad(labels[i])]
        assert sum(i in has for i in clean) >= 0.95 * len(clean)
        worse = [i for i in had if i in labels and bad(labels[i])]
        assert sum(i in has for i in worse) <= 0.3 * len(worse) + 1


def test_simhash_keeps_one_of_each(spark, stages):
    """Against exact Jaccard similarity of all pairs, no tolerance: planted near copies, of which some are alike by 0.8 and some are not."""
    import random

    from orchardflow.llm import simhash

    rng = random.Random(3)
    extra = []
    for r in stages[2].collect()[:60]:
        w = r.text.split()
        for _ in range(rng.randint(1, max(1, len(w) // 30))):
            w[rng.randrange(len(w))] = "edited"
        extra.append((10_000 + r.doc_id, " ".join(w), r.lang, r.source, r.n_chars))
    docs = stages[2].unionByName(spark.createDataFrame(extra, stages[2].schema))
    rows = docs.collect()
    sets = [frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) for w in (r.text.lower().split() for r in rows)]
    root, near = list(range(len(rows))), []

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                near.append((i, j))
                a, b = sorted((find(i), find(j)), key=lambda k: rows[k].doc_id)
                root[b] = a
    want = {rows[find(i)].doc_id for i in range(len(rows))}
    got = {r.doc_id for r in simhash.one_of_each(docs).collect()}
    assert len(near) > 20 and got == want
    assert {r.doc_id for r in stages[3].collect()} <= {r.doc_id for r in stages[2].collect()}


def test_suffix_stage(spark, stages):
    """Against brute force: runs of repeated strings of PASSAGE bytes that have more than 50 words go; also planted passages of 51 words."""
    import random

    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8)))
    prose = lambda n: " ".join(word() for _ in range(n))
    planted = [p for p in (prose(51) for _ in range(30)) if len(p) >= suffix_dedup.PASSAGE]
    extra = [(20_000 + 3 * i + k, f"{prose(60)} {p} {prose(50)}", "en", "a", 0) for i, p in enumerate(planted) for k in range(3)]
    docs = stages[3].unionByName(spark.createDataFrame(extra, stages[3].schema))
    before = {r.doc_id: r for r in docs.collect()}
    after = {r.doc_id: r for r in corpus_pipeline.passages_out(spark, docs, DATA).collect()}
    assert before.keys() == after.keys() and {r.doc_id for r in stages[4].collect()} == {r.doc_id for r in stages[3].collect()}
    want = brute_passages([r.text.encode() for r in before.values()], suffix_dedup.PASSAGE, 50)
    for (i, r), (removed, text) in zip(before.items(), want, strict=True):
        assert after[i].text == text and after[i].n_chars == (len(text) if removed else r.n_chars)
    assert len(planted) > 10 and not any(p in r.text for p in planted for r in after.values())


def test_packing_stage(stages):
    pieces = stages[5].collect()
    docs = {r.doc_id for r in stages[4].collect()}
    assert {r.doc_id for r in pieces} == docs
    for i in docs:
        mine = sorted((r for r in pieces if r.doc_id == i), key=lambda r: r.start)
        assert [r.start for r in mine] == [sum(x.length for x in mine[:k]) for k in range(len(mine))] and sum(r.length for r in mine) == mine[0].doc_tokens


def test_run_is_the_stages(spark, stages):
    got = corpus_pipeline.run(spark, DATA)
    assert sorted((r.doc_id, r.doc_tokens) for r in got.select("doc_id", "doc_tokens").distinct().collect()) == sorted((r.doc_id, r.doc_tokens) for r in stages[5].select("doc_id", "doc_tokens").distinct().collect())


def test_stages_take_odd_rows(spark, stages):
    rows = [(None, None, None, None, None), (1, None, "en", "a", 0), (2, "", "en", "a", 0), (3, "word " * 30_000, None, "a", 5), (3, "word " * 30_000, None, "a", 5), (4, "é" * 300, "fr", "b", 300), (5, "é" * 300 + "x", "fr", "b", 301)]
    odd = spark.createDataFrame(rows, stages[0].schema).coalesce(1)
    for df in (odd, odd.limit(0)):
        for _, f in corpus_pipeline.STAGES:
            df = f(spark, df, DATA).cache()
            df.count()
    cut = {r.doc_id: r.text for r in suffix_dedup.without_repeats(odd, over_words=None).collect()}
    assert cut[4] == "" and cut[5] == "x" and cut[1] is None and cut[2] == "" and cut[3] == ""
    assert {r.doc_id: r.text for r in suffix_dedup.without_repeats(odd).collect()}[4] == "é" * 300


def test_a_worker_keeps_no_freed_memory_after_a_task():
    class Frame:
        def mapInArrow(self, run, schema):
            return list(run(iter([])))

    def held_mb():
        return int(re.search(r"VmRSS:\s+(\d+)", Path("/proc/self/status").read_text())[1]) / 1024

    last = []

    def work(batches):
        blocks = [bytes(64 << 10) + b"x" for _ in range(3000)]
        last.append(blocks[-1])  # stands above the freed ones, so that they stay with the C library unless they are given back
        yield from batches

    before = held_mb()
    assert map_batches(Frame(), work, "id long") == []
    assert held_mb() - before < 60
