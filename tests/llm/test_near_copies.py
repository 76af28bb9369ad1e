"""Near copies by exact Jaccard similarity of five-word shingle sets, with no tolerance at the threshold."""

import random

import numpy as np
from pyspark.sql import functions as F

from orchardflow.llm import simhash


def pair(rng, n, shared):
    """Two texts of ``n`` shingles each, in order of one text's words, of which the first ``shared`` are the same."""
    word = lambda: f"w{rng.randrange(10**9)}"
    a = [word() for _ in range(n + 4)]
    return " ".join(a), " ".join(a[: shared + 4] + [word() for _ in range(n - shared)])


def test_threshold_is_exact(spark):
    rng = random.Random(4)
    rows, want = [], {}
    for n, shared in [(9, 8), (90, 80), (90, 79), (90, 78), (360, 320), (360, 319), (360, 310), (360, 325), (1800, 1600), (1800, 1599)]:
        for _ in range(20):
            a, b = pair(rng, n, shared)
            i = len(rows)
            rows += [(i, a), (i + 1, b)]
            want |= {i: i, i + 1: i if shared / (2 * n - shared) >= 0.8 else i + 1}
    line = " ".join(f"licence{i}" for i in range(60))  # a passage that many share is no similarity
    for _ in range(60):
        want[len(rows)] = len(rows)
        rows.append((len(rows), pair(rng, 100, 0)[0] + " " + line))
    chain = [f"c{i}" for i in range(400)]  # each like the next, the ends unlike: one component
    first = len(rows)
    for i in range(0, 200, 10):
        want[len(rows)] = first
        rows.append((len(rows), " ".join(chain[i : i + 200])))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.component_id for r in simhash.near_copies(df).collect()}
    assert got == want


def test_settled_against_brute_force():
    rng = np.random.default_rng(6)
    base = [np.unique(rng.integers(0, 1 << 62, 40).astype(np.uint64)) for _ in range(6)]
    sets = []
    for _ in range(150):
        x = base[rng.integers(6)].copy()
        x[: rng.integers(0, 8)] = rng.integers(0, 1 << 62)
        sets.append(np.unique(x))
    whole = [set(x.tolist()) for x in sets]
    root = list(range(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            if len(whole[i] & whole[j]) / len(whole[i] | whole[j]) >= 0.8 and root[i] != root[j]:
                a, b = root[i], root[j]
                root = [min(a, b) if x in (a, b) else x for x in root]
    assert simhash.settled(sets, 0.8).tolist() == root


def brute(texts):
    """The least place of each text's component of texts alike by 0.8."""
    sets = [set(simhash.shingles(x).tolist()) for x in texts]
    root = list(range(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            if root[i] != root[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                low, high = sorted((root[i], root[j]))
                root = [low if x == high else x for x in root]
    return root


def test_large_groups_are_dealt_in_blocks(spark):
    """Candidate groups far larger than one task compares: near copies, chains, and texts that are alike to nothing."""
    rng = random.Random(9)
    word = lambda: f"w{rng.randrange(10**6)}"
    texts = []
    for edits, n in ((4, 120), (9, 60), (13, 60)):
        base = [word() for _ in range(90)]
        for _ in range(n):
            w = base[:]
            for _ in range(rng.randint(0, edits)):
                w[rng.randrange(len(w))] = word()
            texts.append(" ".join(w))
    chain = [word() for _ in range(900)]
    texts += [" ".join(chain[i : i + 100]) for i in range(0, 800, 8)] + [" ".join(word() for _ in range(80)) for _ in range(40)]
    rng.shuffle(texts)
    texts = list(dict.fromkeys(texts))
    rows = [(7, i, x) for i, x in enumerate(texts)] + [(8, 10_000, "a b c d e f"), (8, 10_001, "a b c d e f g")]
    want = brute(texts)
    members = spark.createDataFrame(rows, "root long, node long, data string").repartition(3)
    for group in (1024, 40):
        got = {r.node: r.component for r in simhash._exact(members, 5, 0.8, group).collect()}
        same = {}
        for i, w in enumerate(want):
            same.setdefault(w, set()).add(got[i])
        assert all(len(x) == 1 for x in same.values()) and len({min(x) for x in same.values()}) == len(same)
        assert got[10_000] != got[10_001]


def template(rng, n, words=300, low=1, high=12):
    """Texts that share a template, each with some words replaced: few are alike by 0.8, nearly all by half."""
    base = [f"t{rng.randrange(10**9)}" for _ in range(words)]
    out = []
    for _ in range(n):
        w = base[:]
        for at in rng.sample(range(words), rng.randint(low, high)):
            w[at] = f"e{rng.randrange(10**9)}"
        out.append(" ".join(w))
    return out


def same_parts(got, want):
    """Whether two labellings part the same things the same way."""
    return len(set(zip(got, want, strict=True))) == len(set(got)) == len(set(want))


def test_one_template(spark, monkeypatch):
    texts = template(random.Random(12), 500) + template(random.Random(13), 100, 90, 0, 3)
    want = brute(texts)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    for group, columns in ((1024, 4096), (40, 4096), (40, 0)):
        monkeypatch.setattr(simhash, "GROUP", group)
        monkeypatch.setattr(simhash, "COLUMNS", columns)
        got = {r.doc_id: r.component_id for r in simhash.near_copies(df).collect()}
        assert [got[i] for i in range(len(texts))] == want
    assert 100 < len(set(want)) < 500


def test_both_ways_to_compare(monkeypatch):
    rng = random.Random(14)
    sets = [simhash.shingles(x) for x in template(rng, 120, 60, 0, 3) + ["", "a b", "a b c d e f"]]
    side, tied = np.array([rng.randrange(2) for _ in sets]), np.array([rng.randrange(60) for _ in sets])
    for args in ((), (tied,), (tied, side), (None, side)):
        found = []
        for columns in (4096, 0):
            monkeypatch.setattr(simhash, "COLUMNS", columns)
            found.append(simhash.settled(sets, 0.8, *args).tolist())
        assert found[0] == found[1] and same_parts(found[0], found[1])
    assert simhash.settled([], 0.8).tolist() == []


def test_bucket_too_large_to_compare(spark):
    """Texts of a bucket beyond its size are all candidates; nothing that could be alike stays apart."""
    n = 3 * simhash.BUCKET
    rows = spark.range(n).selectExpr("array(5L, 1000000L + id) as first", "id as node", "0L as mark", "2 as size")
    rows = rows.unionByName(spark.range(4).selectExpr("array(9L) as first", "-1L - id as node", "0L as mark", "2 as size"))
    got = simhash._candidates(rows.coalesce(1), 0.8).groupBy("root").count().collect()
    assert sorted(r["count"] for r in got) == [4, n]


def test_texts_that_share_an_id_and_rows_without_one(spark):
    a, b = " ".join(f"x{i}" for i in range(40)), " ".join(f"y{i}" for i in range(40))
    rows = [(1, a, "p"), (1, b, "q"), (2, a + " end", "r"), (None, b, "s"), (None, "alone " * 3 + "text", "t"), (None, "alone " * 3 + "text", "t"), (3, None, "u"), (4, "", "v"), (1, a, "p")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = sorted((str(r.doc_id), str(r.text), r.source) for r in simhash.one_of_each(df).collect())
    assert [x[::2] for x in got] == [("1", "p"), ("1", "q"), ("3", "u"), ("None", "t")]
    assert simhash.one_of_each(df.limit(0)).count() == 0


def test_fingerprints_link_in_the_grid(spark, monkeypatch):
    """Without the prefixes, near copies whose fingerprints differ in two bits at most are still one; exact similarity decides."""
    rng = random.Random(12)
    rows, near = [], set()
    for i in range(0, 60, 2):
        a = [f"w{rng.randrange(10**9)}" for _ in range(600)]
        b = a[:-1] + ["edited"]
        rows += [(i, " ".join(a)), (i + 1, " ".join(b))]
        if (simhash.sketch(simhash.shingles(rows[-2][1])) ^ simhash.sketch(simhash.shingles(rows[-1][1]))).bit_count() <= 2:
            near.add(i)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    monkeypatch.setattr(simhash, "_by_prefix", lambda made, similarity: made.select("node", "node").toDF("a", "b").where("false"))
    got = {r.doc_id: r.component_id for r in simhash.near_copies(df).collect()}
    assert len(near) > 20 and got == {i: i - i % 2 if i - i % 2 in near else i for i, _ in rows}


def test_a_stored_step_leaves_no_shuffle_files(spark):
    import time

    from orchardflow.llm._common import CLEANUP, stored

    def shuffled():
        files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString(" ").split()
        return {x for x in files if "/shuffle_" in x}

    before = shuffled()
    rows = stored(spark.range(10_000).repartition(7, "id"), "rows")
    end = time.monotonic() + 10
    while shuffled() - before and time.monotonic() < end:  # they go in the background
        time.sleep(0.1)
    assert not shuffled() - before and spark.conf.get(CLEANUP) == "false" and rows.count() == 10_000


def test_many_partitions_leave_few_files(spark):
    """A stored table of many small partitions has its rows in a few files for each core; one of few keeps them."""
    from orchardflow.llm import _common

    most = max(_common.LEAST_FILES, _common.FILES * spark.sparkContext.defaultParallelism)
    kept = _common.stored(spark.range(0, 4000, 1, 2 * most + 5), "many")
    assert kept.count() == 4000 and len(kept.inputFiles()) <= most
    few = _common.stored(spark.range(0, 10, 1, 3), "few")
    assert few.count() == 10 and len(few.inputFiles()) == 3


def test_a_shared_shingle_makes_no_group(spark, monkeypatch):
    """Texts that meet at a shingle of their prefixes and are alike in nothing else are no candidates, whatever their length; near copies among them are."""
    rng = random.Random(15)
    word = lambda: f"w{rng.randrange(10**9)}"
    line = next(x for x in iter(lambda: " ".join(word() for _ in range(5)), "") if simhash.shingles(x)[0] < 1 << 56)  # in each prefix, which is in order of hashes here
    texts = [" ".join([line, *(word() for _ in range(n))]) for n in (8, 20, 60, 300) for _ in range(80)]
    texts += [x + " more" for x in texts[::40]]
    rows, groups = list(enumerate(texts)), []
    monkeypatch.setattr(simhash, "_common_shingles", lambda texts, words: np.zeros(0, np.uint64))
    monkeypatch.setattr(simhash, "_exact", lambda members, *a, f=simhash._exact: groups.extend(r["n"] for r in members.groupBy("root").agg(F.count("*").alias("n")).collect()) or f(members, *a))
    got = {r.doc_id: r.component_id for r in simhash.near_copies(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    assert [got[i] for i in range(len(texts))] == brute(texts) and groups == [2] * 8


def test_no_similar_pair_of_short_sets_is_missed():
    """Parities differ at no more places than the sets have shingles not in common, so a pair at the threshold always passes."""
    rng = np.random.default_rng(16)
    for shared, each in ((8, 1), (16, 2), (40, 5), (64, 8), (72, 8)):
        sets = []
        for _ in range(200):
            x = rng.integers(0, 1 << 62, shared + 2 * each).astype(np.uint64)
            sets += [np.sort(x[: shared + each]), np.sort(np.delete(x, np.s_[shared : shared + each]))]
        words = [np.array([f(x) for x in sets], np.uint64) for f in (simhash.sketch, simhash.second)]
        a = np.arange(0, len(sets), 2)
        tried = simhash.may_be_alike(*words, np.array(list(map(len, sets))), a, a + 1, 0.8)
        others = simhash.may_be_alike(*words, np.array(list(map(len, sets))), a[:-1], a[1:], 0.8)
        assert tried.all() and others.sum() <= 2
