import random
import zlib

import numpy as np

from orchardflow.llm import quality, toxicity


def corpus(n=400, seed=1):
    rng = random.Random(seed)
    words = "the of and ation eau les der schen que para with from thing ing".split()
    docs, labels = [], []
    for i in range(n):
        w = [rng.choice(words) + rng.choice(["", "s", "en"]) for _ in range(rng.randint(3, 120))]
        bad, toxic = rng.random() < 0.2, rng.random() < 0.2
        if toxic:
            for _ in range(rng.randint(1, 4)):
                w.insert(rng.randrange(len(w)), rng.choice(["idiot", "scum", "moron", "zlorpen", "zlorpig"]))
        text = " ".join(w)
        if bad:
            text = rng.choice([text.upper() + "!!", " | ".join(w), "*** ".join(w), " ".join(w[:1] * 50)])
        docs.append((i, text))
        if i % 4:
            labels.append((i, int(not bad), int(toxic)))
    return docs, labels


def frames(spark, docs, labels):
    odd = [(None, "idiot scum", "a", 1.0), (9001, None, "a", 1.0), (9002, "", "a", 1.0), (9003, "word " * 60_000, "a", 1.0)]
    df = spark.createDataFrame([(i, x, "src", 0.5) for i, x in docs] + odd + [(0, docs[0][1], "src", 0.5)], "doc_id long, text string, label string, score double")
    return df, spark.createDataFrame([(*x, "clash") for x in labels] + [(None, 1, 1, "x"), (1, None, None, "x")], "doc_id long, quality int, toxic int, text string")


def test_quality_on_held_out(spark):
    docs, labels = corpus()
    df, known = frames(spark, docs, labels)
    got = quality.quality(df, known).collect()
    assert len(got) == df.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    truth = {i: q for i, q, _ in labels}
    unseen = [(truth[r.doc_id], r.predicted) for r in got if r.held_out and r.doc_id in truth]
    assert sum(a == b for a, b in unseen) / len(unseen) > 0.9
    assert len({r.score for r in got if r.doc_id == 0}) == 1


def test_quality_ignores_labels_of_held_out_rows(spark):
    docs, labels = corpus(200)
    df, known = frames(spark, docs, labels)
    flipped = [(i, 1 - q if zlib.crc32(str(i).encode()) % 5 == 0 else q, t) for i, q, t in labels]
    _, other = frames(spark, docs, flipped)
    score = lambda x: sorted((str(r.doc_id), r.score) for r in quality.quality(df, x).collect())
    assert score(known) == score(other)


def test_quality_without_labels_or_rows(spark):
    docs, labels = corpus(50)
    df, known = frames(spark, docs, labels)
    assert len({r.score for r in quality.quality(df, known.limit(0)).collect()}) == 1
    assert quality.quality(df.limit(0), known).count() == 0


def test_preference_order_by_brute_force():
    """The fitted strengths order nearly all pairs as the labels do."""
    docs, labels = corpus(300, seed=4)
    truth = {i: q for i, q, _ in labels}
    x = np.array([quality.features(t) for i, t in docs if i in truth])
    y = np.array([truth[i] for i, _ in docs if i in truth])
    s = quality.fit(x, y).strength(x)
    wins = (s[y == 1][:, None] > s[y == 0][None, :]).mean()
    assert wins > 0.97


def test_toxicity_on_unlabelled(spark):
    docs, labels = corpus(600)
    df, known = frames(spark, docs, labels)
    got = {r.doc_id: r for r in toxicity.toxicity(df, known).collect()}
    truth = {i: any(w in x for w in ("idiot", "scum", "moron", "zlorp")) or any(w in x.lower() for w in ("idiot", "scum", "moron", "zlorp")) for i, x in docs}
    unseen = [(truth[i], got[i].is_toxic) for i in truth if i % 4 == 0]
    assert sum(a == b for a, b in unseen) / len(unseen) > 0.9
    assert got[None].is_toxic and not got[9001].is_toxic and not got[9002].is_toxic and not got[9003].is_toxic
    assert all(0 <= p <= 1 for r in got.values() for p in (r.severe, r.pervasive, r.toxic))
    assert toxicity.toxicity(df.limit(0), known).count() == 0
    assert not any(r.is_toxic for r in toxicity.toxicity(df, known.limit(0)).collect())


def test_chain_feeds_out_of_fold_predictions():
    """A later category that equals the earlier one is predicted through it, although its own inputs say nothing more."""
    rng = np.random.default_rng(0)
    x = rng.integers(0, 2, (500, 6)).astype(float)
    first = (x[:, 0] + x[:, 1] > 1).astype(float)
    chain = toxicity.fit(x, np.stack([first, first], axis=1), np.arange(500) % toxicity.FOLDS, ("a", "b"), tuple("uvwxyz"))
    assert chain.weights[1][-1] > 1
    assert ((chain.predict(x)[:, 1] > 0.5) == first).all()


def test_contradictory_and_repeated_rows_teach_alike_in_any_order(spark):
    """An id with two labels teaches nothing, and which of its rows teaches does not depend on their order."""
    docs, labels = corpus(300)
    again = [(i, "idiot scum " + x) for i, x in docs[:40]]
    twice = [(i, 1 - q, 1 - t) for i, q, t in labels[:30]]
    scores = []
    for rows, known in ((docs + again, labels + twice), (again[::-1] + docs[::-1], twice + labels[::-1])):
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
        told = spark.createDataFrame(known, "doc_id long, quality int, toxic int").repartition(2)
        some = df.where("doc_id < 60")
        scores.append((sorted((r.doc_id, round(r.score, 9)) for r in quality.scored(quality.featured(some), quality.train(quality.featured(df), told, ~quality.held_out(quality.F.col("id")))).collect()), toxicity.train(df, told)))
    assert scores[0][0] == scores[1][0] and scores[0][1].terms == scores[1][1].terms
    assert np.allclose(np.concatenate(scores[0][1].weights), np.concatenate(scores[1][1].weights), atol=1e-6)


def test_terms_of_a_fold_are_chosen_without_it(spark):
    """Words that stand in one fold's toxic documents only are no terms of the model that predicts this fold."""
    rng = random.Random(2)
    rows = []
    for i in range(1500):
        toxic = i % 5 == 0
        fold = zlib.crc32(str(i).encode()) % toxicity.FOLDS
        words = [rng.choice("the of and ation eau".split()) for _ in range(30)] + ([f"vile{'abcde'[fold]}", "scum"] if toxic else [])
        rows.append((i, " ".join(words), int(toxic), fold))
    df = spark.createDataFrame(rows, "id long, text string, label int, fold int")
    yes, n = ([sum(f(r) for r in rows if r[3] == k) for k in range(toxicity.FOLDS)] for f in (lambda r: r[2], lambda r: 1))
    picked = toxicity._chosen_terms(df.select("fold", "label", "text"), yes, n, 400)
    assert {f"vile{x}" for x in "abcde"} <= set(picked[0])
    for k, x in enumerate("abcde"):
        assert f"vile{x}" not in picked[k + 1] and {f"vile{y}" for y in "abcde" if y != x} <= set(picked[k + 1]) and "scum" in picked[k + 1]


def test_withheld_labels_of_the_tables(spark):
    """Held-out recall and false positives on the real labels: a fifth of them is withheld from training."""
    from pathlib import Path

    import pytest

    data = "/root/testdata/sf0.1"
    if not Path(data).exists():
        pytest.skip("no test tables")
    docs, labels = spark.read.parquet(f"{data}/documents.parquet"), spark.read.parquet(f"{data}/labels.parquet")
    withheld = quality.held_out(quality.F.col("doc_id"))
    got = toxicity.toxicity(docs, labels.where(~withheld)).join(labels.where(withheld).withColumnRenamed("toxic", "truth"), "doc_id").collect()
    bad, good = [r.is_toxic for r in got if r.truth], [r.is_toxic for r in got if r.truth == 0]
    print(f"withheld: {len(bad)} toxic, caught {sum(bad)}; {len(good)} clean, rejected {sum(good)}")
    assert len(bad) >= 50 and sum(bad) >= 0.9 * len(bad) and sum(good) <= 0.02 * len(good)


def test_weights_against_the_exact_optimum_of_all_pairs():
    """Every pair of a better and a worse row, to the end of Newton's method, against the fit on drawn pairs."""
    rng = np.random.default_rng(11)
    n = 160
    label = rng.integers(0, 2, n)
    x = rng.standard_normal((n, len(quality.FEATURES))) + label[:, None] * np.linspace(-0.6, 0.8, len(quality.FEATURES))
    model = quality.fit(x, label)
    z = quality._expanded(x, np.array(model.mean), np.array(model.scale))
    good, bad = z[label == 1], z[label == 0]
    d = (good[:, None, :] - bad[None, :, :]).reshape(-1, z.shape[1])
    w = np.zeros(z.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-(d @ w)))
        gradient = d.T @ (p - 1) / len(d) + 1e-2 * w
        w -= np.linalg.solve((d * (p * (1 - p))[:, None]).T @ d / len(d) + 1e-2 * np.eye(len(w)), gradient)
    assert np.abs(gradient).max() < 1e-9
    assert np.corrcoef(z @ w, model.strength(x))[0, 1] > 0.995
    wins = lambda s: float((s[label == 1][:, None] > s[label == 0][None, :]).mean())
    assert abs(wins(z @ w) - wins(model.strength(x))) < 0.01
