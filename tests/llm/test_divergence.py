import random
import re
from collections import Counter, defaultdict

import pytest

from orchardflow.llm import _words, divergence

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = {x: x + 32 for x in range(65, 91)}


def brute(rows, min_docs, most):
    count, df, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        text, lang, source = text or "", lang or "", source or ""
        groups.add((lang, source))
        found = [x.translate(LOWER) for x in TERM.findall(text)]
        count[lang, source].update(found)
        df[lang].update(set(found))
    out = set()
    for lang in {x for x, _ in groups}:
        kept = [t for t, n in df[lang].items() if n >= min_docs]
        own = [s for x, s in groups if x == lang]
        total = {s: sum(count[lang, s][t] for t in kept) for s in own}
        whole = {t: sum(count[lang, s][t] for s in own) for t in kept}
        p = {s: {t: 1 + 10**9 * (count[lang, s][t] + 5) // (total[s] + 5 * len(kept)) for t in kept} for s in own}
        q = {t: 1 + 10**9 * (whole[t] + 5) // (sum(whole.values()) + 5 * len(kept)) for t in kept}
        for s in own:
            pairs = sorted((-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode(), o) for o in own if o != s)
            terms = sorted((q[t] - p[s][t], t.encode(), t) for t in kept if count[lang, s][t] and p[s][t] > q[t])[:most]
            out |= {(lang, s, part, x, -v, i) for part, ranked in (("pair", pairs), ("term", terms)) for i, (v, _, x) in enumerate(ranked, 1)}
    return out


def texts(n, seed=1):
    rng = random.Random(seed)
    words = [f"w{'abcdefghij'[i % 10]}{'xyz'[i % 3]}{chr(97 + i // 30)}" for i in range(90)] + ["Straße", "ÉTÉ", "été", "naïve", "日本", "A", "a", "x" * 9, "y" * 40, "z" * 17]
    rows = []
    for i in range(n):
        source = rng.choice(["s1", "s1", "s1", "s2", "s3", None, "Zé"])
        lean = words[hash_of(source) : hash_of(source) + 30]
        some = [rng.choice(lean if rng.random() < 0.5 else words) for _ in range(rng.randint(0, 60))]
        rows.append((rng.choice([" ", ", ", "-", "_3 ", "\x7f", "\n"]).join(some), rng.choice(["en", "en", "de", None]), source))
    return rows


def hash_of(source):
    return {"s1": 0, "s2": 20, "s3": 40, None: 60, "Zé": 10}[source]


@pytest.mark.parametrize("block,chunk", [(_words.BLOCK, divergence.CHUNK), (200, 40)])
def test_against_brute_force(spark, monkeypatch, block, chunk):
    monkeypatch.setattr(_words, "BLOCK", block)
    monkeypatch.setattr(divergence, "CHUNK", chunk)
    rows = texts(400) + [(None, "fr", "only"), ("", "fr", "s1"), (None, None, None), ("1 2 3 !", "it", "s9"), ("wax wax " * 3000 + "tail", "en", "s2")] + texts(3) * 3
    df = spark.createDataFrame([(*r, 1, "clash") for r in rows], "text string, lang string, source string, n long, term string").repartition(3)
    for min_docs, most in ((30, 50), (5, 7)):
        got = [tuple(r) for r in divergence.audit(df, min_docs=min_docs, most=most).select("lang", "source", "part", "item", "value", "rank").collect()]
        assert len(got) == len(set(got)) and set(got) == brute(rows, min_docs, most)


def test_edges(spark):
    schema = "text string, lang string, source string"
    assert divergence.audit(spark.createDataFrame([], schema)).count() == 0
    assert divergence.audit(spark.createDataFrame([("a b", "en", "x")], schema)).count() == 0
    none_kept = divergence.audit(spark.createDataFrame([("a b", "en", "x"), ("c", "en", "y")], schema)).collect()
    assert sorted((r.source, r.part, r.item, r.value, r["rank"]) for r in none_kept) == [("x", "pair", "y", 0, 1), ("y", "pair", "x", 0, 1)]
    assert dict(divergence.audit(spark.createDataFrame([], schema)).dtypes) == {"lang": "string", "source": "string", "part": "string", "item": "string", "value": "bigint", "rank": "int"}


def test_search_stops_early_and_keeps_ties():
    import numpy as np

    rng = np.random.default_rng(3)
    n = np.sort(rng.integers(1, 300, 5000))
    p, q = n * 1000 + 7, rng.integers(1, 60_000, 5000)
    terms = [f"t{i:05d}" for i in rng.permutation(5000)]
    best, evaluated = divergence.searched(p, q, n, terms, 50, [])
    want = sorted((int(b - a), t.encode()) for a, b, t in zip(p, q, terms, strict=True) if a > b)[:50]
    assert best == want and evaluated < 2500
    tied, _ = divergence.searched(np.full(90, 10), np.full(90, 4), np.full(90, 2), [f"k{i:02d}" for i in range(89, -1, -1)], 50, [])
    assert [t for _, t in tied] == [f"k{i:02d}".encode() for i in range(50)]
