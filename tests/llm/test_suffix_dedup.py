import hashlib
import random

import numpy as np

from orchardflow.llm import suffix_dedup


def brute(texts, length):
    seen = {}
    for t in texts:
        for i in range(len(t) - length + 1):
            seen[t[i : i + length]] = seen.get(t[i : i + length], 0) + 1
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        out.append((len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def corpus():
    rng = random.Random(8)
    word = lambda: "".join(rng.choice(["th", "er", "on", "an", "é", "re", "漢"]) for _ in range(rng.randint(1, 5)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passages = [prose(rng.randint(60, 150)) for _ in range(6)]
    texts = [None, "", "short", "ab " * 400, "ab " * 700, "x" * 399, "x" * 400, "y" * 401, "z" * 900]
    for i in range(40):
        texts.append(prose(rng.randint(0, 120)) + " " + rng.choice(passages)[rng.randint(0, 50) :] + " " + prose(rng.randint(0, 60)))
        if i % 3 == 0:
            texts.append(texts[-1][rng.randint(0, 90) :] + rng.choice(["", " tail", prose(30)]))
        if i % 7 == 0:
            w = texts[-1].split(" ")
            w[len(w) // 2] = "edited"
            texts.append(" ".join(w))
    line = prose(20)
    return [*texts, *(f"{prose(50)} {line} {prose(50)}" for _ in range(30)), texts[-1], texts[9]]


def test_like_brute_force(spark):
    texts = corpus()
    df = spark.createDataFrame([(i if i != 4 else None, x, 1, "a", 2) for i, x in enumerate(texts)], "doc_id long, text string, n_bytes int, kept string, k1 int").repartition(4)
    rows = df.collect()
    want = brute([(r.text or "").encode() for r in rows], 400)
    got = suffix_dedup.dedup(df).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == sorted((str(r.doc_id), *w) for r, w in zip(rows, want, strict=True))
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in got)
    assert any(0 < w[1] < w[0] for w in want) and any(w[2] > 1 for w in want)
    assert suffix_dedup.dedup(df.limit(0)).count() == 0


def test_blocks_of_ties():
    """Suffixes that share their first and last 32 bytes and differ between, in every residue."""
    rng = np.random.default_rng(1)
    head, tail = rng.integers(97, 99, 40), rng.integers(97, 99, 700)
    data, starts = [], []
    for _ in range(300):
        middle = rng.integers(97, 100, 330)
        middle[3:] = 97
        part = np.concatenate([rng.integers(97, 122, rng.integers(0, 40)), head, middle, tail[: rng.integers(60, 120)], rng.integers(97, 122, 400)])
        at = sum(map(len, data))
        starts += [at + i for i in range(0, len(part) - 400, 1)]
        data.append(part)
    data = np.concatenate(data).astype(np.uint8)
    starts = np.array(starts)
    raw = data.tobytes()
    windows = [raw[i : i + 400] for i in starts.tolist()]
    counts = {}
    for w in windows:
        counts[w] = counts.get(w, 0) + 1
    want = np.array([counts[w] > 1 for w in windows])
    assert want.any() and not want.all()
    assert (suffix_dedup.repeating(data, starts, 400) == want).all()


def test_common_owner(spark):
    """An owner of very many rows is judged as a whole, however they are dealt."""
    from pyspark.sql import functions as F

    n = 2_300_000
    big = F.when(F.col("id") < 2, F.lit(1)).when(F.col("id") < n, 2).otherwise(3)
    for low, high, sizes in ((0, n, {1: 2, 2: n - 2}), (1, n + 1, {1: 1, 2: n - 2, 3: 1}), (2, n, {2: n - 2})):
        rows = spark.range(low, high).select(F.lit(7).cast("long").alias("owner"), big.cast("long").alias("region"), F.col("id").alias("k1"), F.lit(0).cast("long").alias("k2"), F.lit(0).cast("long").alias("first"), F.lit(1).alias("windows"), F.lit(1).cast("long").alias("times"), F.lit(1).cast("long").alias("copies"))
        rows = rows.unionByName(rows.limit(1).withColumns({"owner": F.lit(6).cast("long")})).unionByName(rows.limit(2).withColumns({"owner": F.lit(8).cast("long")}))
        members, classes = suffix_dedup.repeated(rows, rows.groupBy("owner").agg(F.sum("copies").alias("n")))
        got = classes.collect()
        assert not [r for r in got if r.owner == 6]
        assert {r.region: (r.weight, r.classes) for r in got if r.owner == 7} == {k: (v, len(sizes)) for k, v in sizes.items()} and len([r for r in got if r.owner == 7]) == len(sizes)
        assert {(r.owner, r.n) for r in members.groupBy("owner").agg(F.count("*").alias("n")).collect()} == {(7, high - low), (8, 2)}


def brute_passages(texts, length, words):
    """(bytes in passages, text without them): maximal runs of repeated windows that have more than ``words`` words."""
    seen = {}
    for t in texts:
        for i in range(len(t) - length + 1):
            seen[t[i : i + length]] = seen.get(t[i : i + length], 0) + 1
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        runs, kept, removed, i = [], [], 0, 0
        while i < len(t):
            j = i
            while j < len(t) and gone[j] == gone[i]:
                j += 1
            if gone[i] and len(t[i:j].split()) > words:
                removed += j - i
            else:
                kept.append(t[i:j])
            i = j
        out.append((removed, b"".join(kept).decode("utf-8", "ignore")))
    return out


def test_passages_like_brute_force(spark):
    """Strings of 400 bytes are found within the runs of shorter ones as they are without them, and passages of over 50 words are cut."""
    texts = corpus()
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7)))
    prose = lambda n: " ".join(word() for _ in range(n))
    planted = [prose(51) for _ in range(12)]
    short = [prose(46) for _ in range(6)]
    for p in planted + short:
        texts += [f"{prose(40)} {p} {prose(30)}" for _ in range(3)]
    df = spark.createDataFrame([(i, x, 1, "a", 2) for i, x in enumerate(texts)], "doc_id long, text string, n_bytes int, kept string, k1 int").repartition(4)
    rows = {r.doc_id: r.text for r in df.collect()}
    raw = [(x or "").encode() for x in rows.values()]
    want, passages = brute(raw, 400), brute_passages(raw, suffix_dedup.PASSAGE, 50)
    got = suffix_dedup.dedup(df, passage=suffix_dedup.PASSAGE).collect()
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, r.n_passage_bytes, r.text) for r in got) == sorted((i, *w, *p) for i, w, p in zip(rows, want, passages, strict=True))
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in got)
    cut = {r.doc_id: r.text for r in suffix_dedup.without_repeats(df).select("doc_id", "text").collect()}
    assert cut == {i: (p[1] if x is not None else None) for (i, x), p in zip(rows.items(), passages, strict=True)}
    long = [p for p in planted if len(p) >= suffix_dedup.PASSAGE]
    assert len(long) >= 5 and not any(p in (x or "") for p in long for x in cut.values()) and all(sum(p in (x or "") for x in cut.values()) == 3 for p in short)


def test_ends_shared(spark):
    """What is left out of a large bucket before it is sorted has no other window with its ends."""
    texts = corpus()
    df = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "doc_id long, text string")
    rows = sorted((r.doc_id, r.kept_sha256) for r in suffix_dedup.dedup(df).collect())
    rng = np.random.default_rng(3)
    parts = [bytes(rng.integers(97, 100, n).astype(np.uint8)) + b"same end of all these parts, long enough to count as one" * 3 for n in rng.integers(300, 700, 40)] * 2
    got = suffix_dedup.ends_shared(parts, 400)
    keys = [(p[i : i + 32], p[i + 368 : i + 400]) for p in parts for i in range(len(p) - 399)]
    counts = {}
    for k in keys:
        counts[k] = counts.get(k, 0) + 1
    assert got.tolist() == [counts[k] > 1 for k in keys]
    assert rows == sorted((r.doc_id, w[3]) for r, w in zip(df.collect(), brute([(x or "").encode() for x in texts], 400), strict=True))


def test_texts_are_read_once(spark, monkeypatch):
    """Owners are found once for all texts: their bytes go to the workers once, not once more to count the owners."""
    seen, real = spark.sparkContext.accumulator(0), suffix_dedup.map_batches

    def counting(df, function, schema):
        def run(batches):
            def counted():
                for batch in batches:
                    seen.add(sum(len(x.encode() if isinstance(x, str) else x) for x in batch.column(4).to_pylist()))
                    yield batch

            yield from function(counted())

        return real(df, run if "base" in df.columns else function, schema)

    monkeypatch.setattr(suffix_dedup, "map_batches", counting)
    texts = corpus()
    found = suffix_dedup.runs(suffix_dedup.distinct_texts(spark.createDataFrame([(x,) for x in texts], "text string"), "text", 400), 400)
    assert found.count() > 20
    assert seen.value == sum(len(raw) for raw in {x.encode() for x in texts if x} if len(raw) >= 400)


def test_owners_by_chunks(monkeypatch):
    """Regions do not depend on how many places are hashed at a time, and each holds the windows of one least gram."""
    parts = [x.encode() for x in corpus() if x and len(x.encode()) >= 240]
    data, sizes = np.frombuffer(b"".join(parts), np.uint8), np.array(list(map(len, parts)))
    whole = suffix_dedup.owners(data, sizes, 240)
    text, first, last, owner = (x.tolist() for x in whole)
    assert [(t, i) for t, a, b in zip(text, first, last, strict=True) for i in range(a, b + 1)] == [(t, i) for t, p in enumerate(parts) for i in range(len(p) - 239)]
    seen = {}
    for t, a, b, o in zip(text, first, last, owner, strict=True):
        for i in range(a, b + 1):
            assert seen.setdefault(parts[t][i : i + 240], o) == o
    for size in (97, 1000):
        monkeypatch.setattr(suffix_dedup, "CHUNK", size)
        assert all((a == b).all() for a, b in zip(whole, suffix_dedup.owners(data, sizes, 240), strict=True))


def test_grouped():
    """Pairs are ordered alike whether their places fit beside them in one number or not."""
    rng = np.random.default_rng(5)
    for top in (4, 1 << 20, 1 << 31):
        a, b = rng.integers(0, top, (2, 3000)).astype(np.uint64)
        a[1500:], b[1500:] = a[:1500], b[:1500]
        order, group = suffix_dedup._grouped(a, b)
        pairs = list(zip(a[order].tolist(), b[order].tolist(), strict=True))
        assert sorted(order.tolist()) == list(range(3000)) and pairs == sorted(pairs)
        assert group.tolist() == np.unique(np.array(pairs), axis=0, return_inverse=True)[1].reshape(-1).tolist()
