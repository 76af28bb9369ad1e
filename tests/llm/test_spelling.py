import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from orchardflow.llm import _words, spelling

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = {x: x + 32 for x in range(65, 91)}


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return a[i + (len(a) >= len(b)) :] == b[i + (len(b) >= len(a)) :]


def brute(rows, slip=199):
    counts = Counter()
    for doc, text in rows:
        for run in RUN.findall(text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % slip == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    out = {}
    for w, n in counts.items():
        near = sorted((-counts[x], x) for x in counts if one_edit(w, x))
        form = near[0][1] if near and -near[0][0] >= 5 * n else None
        out[w] = (n, len(near), form, counts.get(form))
    for w, found in list(out.items()):
        root = w
        while out[root][2]:
            root = out[root][2]
        out[w] = (*found, root)
    return out


def texts(seed=4):
    rng = random.Random(seed)
    stems = ["orchard", "Straße" + "nbahn", "élégante", "aaaaaa", "aaaaaaa", "baaaaaa", "mississippi", "counting", "recounting", "x" * 30, "y" * 90 + "z" * 80]
    words = []
    for s in stems:
        words += [s] * 40
        for _ in range(12):
            at, c = rng.randrange(len(s)), rng.choice("abcxyzéß")
            words += [rng.choice([s[:at] + s[at + 1 :], s[:at] + c + s[at:], s[:at] + c + s[at + 1 :]])] * rng.choice([4, 5, 7, 9, 30])
    words += ["".join(rng.choice("abcd") for _ in range(rng.randint(5, 8))) for _ in range(4000)]
    rng.shuffle(words)
    sep = [" ", "1", "Ā", "_", "日", "'"]
    return [(i % 50 if i % 7 else None, "".join(w + rng.choice(sep) for w in words[at : at + 40])) for i, at in enumerate(range(0, len(words), 40))]


@pytest.mark.parametrize("group,block", [(4096, 1 << 20), (6, 300), (1, 50)])
def test_against_brute_force(spark, monkeypatch, group, block):
    monkeypatch.setattr(spelling, "GROUP", group)
    monkeypatch.setattr(_words, "BLOCK", block)
    monkeypatch.setattr(spelling, "BLOCK", max(400, block))
    rows = texts() + [(1, None), (2, ""), (3, "Aaaaaa " * 9), (3, "Aaaaaa " * 9), (4, "1 2 3")]
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, text string, word string, n long").repartition(3)
    for slip in (199, 3):
        got = {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in spelling.variants(df, slip=slip).collect()}
        assert got == brute(rows, slip)
        assert any(x[2] for x in got.values()) and any(x[1] > 3 for x in got.values())


def test_active_nodes_in_random_tries():
    rng = random.Random(8)
    for _ in range(200):
        rows = sorted({(rng.randrange(3), "".join(rng.choice("ab") for _ in range(rng.randint(0, 6))).encode()) for _ in range(rng.randint(1, 40))})
        i, j = spelling.active_pairs(np.array([g for g, _ in rows]), [w for _, w in rows])
        got = list(zip(i.tolist(), j.tolist(), strict=True))
        want = {(x, y) for x, a in enumerate(rows) for y, b in enumerate(rows) if a[0] == b[0] and one_edit(a[1].decode(), b[1].decode())}
        assert len(got) == len(set(got)) and set(got) == want


def test_empty_and_chains(spark):
    empty = spelling.variants(spark.createDataFrame([], "doc_id long, text string"))
    assert empty.count() == 0 and dict(empty.dtypes)["n_near"] == "bigint"
    chain = spark.createDataFrame([(f"w{i}", f"w{i + 1}") for i in range(20)], "word string, form string")
    assert {r.word: r.root for r in spelling.roots(chain).collect()} == {f"w{i}": "w20" for i in range(20)}
