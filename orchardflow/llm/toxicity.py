"""Toxicity by a chain of linear classifiers.

Each category has a logistic model over indicator terms. The chain predicts the categories in order, and each later model also gets
the probabilities of the earlier categories. While training, those probabilities are out-of-fold predictions, so that a later
model sees them as unsure as they will be on new texts. Terms are words and their first four and five letters, chosen by
how unevenly they occur in the labelled documents; the model that predicts a fold has terms, and categories derived from them, that were
chosen without that fold's labels.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orchardflow.llm._common import labelled, map_batches, slices, stored

#: In chain order: several different indicator terms; terms in the first and in the second half; toxic at all.
CATEGORIES = ("severe", "pervasive", "toxic")
WORD = re.compile(r"[^\W_]+")
FOLDS = 5
#: Most entries of a worker's cache of the terms in chunks of text.
CACHE = 300_000


def terms(word: str) -> list[str]:
    """A word's terms: itself, and the prefixes that longer words of its stem share."""
    return [word, *(f"{word[:n]}*" for n in (4, 5) if len(word) > n)]


def _terms_of(text: str) -> set[str]:
    found: set[str] = set()
    for word in set(WORD.findall(text.lower())):
        if len(word) <= 40:
            found.update(terms(word))
    return found


@dataclass(frozen=True)
class Chain:
    terms: tuple[str, ...]
    categories: tuple[str, ...]
    #: for each category: a bias, a weight for each term and for the log of their number, and for each earlier category
    weights: tuple[tuple[float, ...], ...]

    def predict(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros((len(x), len(self.categories)))
        for i, w in enumerate(self.weights):
            out[:, i] = _sigmoid(np.concatenate([np.ones((len(x), 1)), x, out[:, :i]], axis=1) @ np.array(w))
        return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 3e-4) -> np.ndarray:
    """Newton's method on rows that count ``weight`` times each; ``x`` has a first column of ones, which is not penalised."""
    w = np.zeros(x.shape[1])
    n = weight.sum()
    if not n:
        return w
    penalty = np.full(x.shape[1], ridge)
    penalty[0] = 1e-6
    for _ in range(12):
        p = _sigmoid(x @ w)
        gradient = x.T @ (weight * (p - y)) / n + penalty * w
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x / n + np.diag(penalty) + 1e-9 * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w -= np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-5:
            break
    return w


def fit(x: np.ndarray, y: np.ndarray, fold: np.ndarray, names: tuple[str, ...], vocabulary: tuple[str, ...], weight: np.ndarray | None = None, without=None) -> Chain:
    """Fit the chain on rows ``x`` with 0/1 columns ``y`` in chain order.

    ``without`` gives the rows' inputs and categories as they are known without a fold's labels; without it they are ``x`` and ``y``.
    """
    weight = np.ones(len(x)) if weight is None else weight
    ones = np.ones((len(x), 1))
    earlier = np.zeros((len(x), 0))
    weights = []
    for i in range(len(names)):
        weights.append(tuple(_logistic(np.concatenate([ones, x, earlier], axis=1), y[:, i], weight).tolist()))
        unseen = np.zeros(len(x))
        for k in range(FOLDS):
            out = fold == k
            if out.any():
                apart, known = without(k) if without else (x, y)
                inputs = np.concatenate([ones, apart, earlier], axis=1)
                unseen[out] = _sigmoid(inputs[out] @ _logistic(inputs[~out], known[~out, i], weight[~out]))
        earlier = np.concatenate([earlier, unseen[:, None]], axis=1)
    return Chain(vocabulary, names, tuple(weights))


def _inputs(hits: np.ndarray) -> np.ndarray:
    """Term indicators, and the log of how many there are."""
    return np.concatenate([hits, np.log1p(hits.sum(axis=1, keepdims=True))], axis=1)


class _Lookup:
    """Places in a vocabulary of the terms of chunks of text, with a cache of the chunks."""

    def __init__(self, vocabulary: tuple[str, ...]) -> None:
        self.place = {x: i for i, x in enumerate(vocabulary)}
        self.cache: dict[str, tuple[int, ...]] = {}

    def of(self, chunk: str) -> tuple[int, ...]:
        place = self.place
        found = tuple(sorted({place[t] for w in WORD.findall(chunk) if len(w) <= 40 for t in terms(w) if t in place}))
        if len(chunk) <= 64:
            self.cache[chunk] = found
        return found

    def __call__(self, chunks: list[str]) -> list[int]:
        different = set(chunks)
        got: set[int] = set()
        for x in filter(None, map(self.cache.get, different)):
            got.update(x)
        for x in different.difference(self.cache):
            got.update(self.of(x))
        if len(self.cache) > CACHE:
            self.cache.clear()
        return sorted(got)


def _hits(batches: Iterator[pa.RecordBatch], vocabulary: tuple[str, ...]) -> Iterator[tuple[pa.RecordBatch, list[list[int]]]]:
    """Each row's terms of the vocabulary."""
    lookup = _Lookup(vocabulary)
    for batch in slices(batches):
        yield batch, [lookup((x or "").lower().split()) for x in batch.column("text").to_pylist()]


def _chosen_terms(sample: DataFrame, yes: list[int], n: list[int], vocabulary: int) -> list[tuple[str, ...]]:
    """The terms of the highest gain: of all rows, then of all but each fold. ``yes`` and ``n`` count toxic and all rows by fold."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 32):
            out = [(t, y, k) for text, y, k in zip(*(batch.column(c).to_pylist() for c in ("text", "label", "fold")), strict=True) for t in _terms_of(text or "")]
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.int64()), pa.array([x[2] for x in out], pa.int32())], ["term", "label", "fold"])

    each = [f(F.when(F.col("fold") == k, x)).alias(f"{name}{k}") for k in range(FOLDS) for f, x, name in ((F.sum, F.col("label"), "yes"), (F.count, F.lit(1), "n"))]
    counts = map_batches(sample, found, "term string, label long, fold int").groupBy("term").agg(*each).fillna(0).withColumns({"yes": sum((F.col(f"yes{k}") for k in range(FOLDS)), F.lit(0)), "n": sum((F.col(f"n{k}") for k in range(FOLDS)), F.lit(0))})
    counts = stored(counts.where("n >= 3 and yes > 0"), "terms")
    best = None
    for k in (None, *range(FOLDS)):
        y, m = (F.col("yes"), F.col("n")) if k is None else (F.col("yes") - F.col(f"yes{k}"), F.col("n") - F.col(f"n{k}"))
        good, all_rows = (sum(yes), sum(n)) if k is None else (sum(yes) - yes[k], sum(n) - n[k])
        if not good or good == all_rows:
            continue
        odds = F.log((y + 0.1) / good) - F.log((m - y + 0.1) / (all_rows - good))
        top = counts.select("term", (odds * F.sqrt(y)).alias("gain"), odds.alias("odds"), m.alias("m"), y.alias("y")).where("m >= 3 and y > 0 and odds > 3")
        top = top.orderBy(F.desc("gain"), "term").limit(vocabulary).select("term", "gain", F.lit(-1 if k is None else k).alias("k"))
        best = top if best is None else best.unionByName(top)
    rows = sorted(best.collect(), key=lambda r: (-r.gain, r.term)) if best is not None else []  # at most ``vocabulary`` for each
    return [tuple(r.term for r in rows if r.k == k) for k in (-1, *range(FOLDS))]


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", most: int = 20_000, vocabulary: int = 400) -> Chain:
    """Fit on at most ``most`` labelled documents, chosen by a hash of the id, over at most ``vocabulary`` terms.

    Only ``label_col`` is labelled; the chain's other categories refine it, by rules on the chosen terms: ``severe`` if a
    toxic document has three or more of them, ``pervasive`` if both of its halves have one. An id with contradictory labels teaches nothing; of
    rows that repeat an id one teaches, the same in any order.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    chosen = labelled(labels, id_col, label_col, most)  # its size is proven: at most ``most`` rows of two numbers
    one = F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("t")
    sample = rows.join(F.broadcast(chosen), "id").groupBy("id", "label").agg(one).select(F.pmod(F.crc32(F.col("id").cast("string").cast("binary")), F.lit(FOLDS)).cast("int").alias("fold"), "label", "t.text")
    sample = stored(sample, "sample")
    counted = {r.fold: r for r in sample.groupBy("fold").agg(F.sum("label").alias("yes"), F.count("*").alias("n")).collect()}  # FOLDS rows
    yes, n = ([int(counted[k][c]) if k in counted else 0 for k in range(FOLDS)] for c in ("yes", "n"))
    if not sum(yes) or sum(yes) == sum(n):
        return Chain((), CATEGORIES, tuple((math.log((sum(yes) + 1e-3) / (sum(n) - sum(yes) + 1e-3)) if sum(n) else -20.0, 0.0, *([0.0] * i)) for i in range(len(CATEGORIES))))
    picked = _chosen_terms(sample, yes, n, vocabulary)
    every = tuple(sorted(set().union(*picked)))

    def hit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = _Lookup(every)
        for batch in slices(batches):
            halves = []
            for text in batch.column("text").to_pylist():
                chunks = (text or "").lower().split()
                halves.append((lookup(chunks[: len(chunks) // 2]), lookup(chunks[len(chunks) // 2 :])))
            yield pa.RecordBatch.from_arrays([batch.column("fold"), batch.column("label"), *(pa.array([h[i] for h in halves], pa.list_(pa.int32())) for i in (0, 1))], ["fold", "label", "first", "second"])

    # most documents have no term at all: equal rows are one with a weight
    hits = map_batches(sample, hit, "fold int, label int, first array<int>, second array<int>").groupBy("fold", "label", "first", "second").agg(F.count("*").alias("n")).toArrow()  # at most ``most`` rows
    got = sorted(zip(*(hits.column(c).to_pylist() for c in ("fold", "label", "first", "second", "n")), strict=True))
    fold, label, weight = (np.array([r[i] for r in got]) for i in (0, 1, 4))
    first, second = (np.zeros((len(got), len(every)), bool) for _ in range(2))
    for i, r in enumerate(got):
        first[i, r[2]] = True
        second[i, r[3]] = True
    place = {t: i for i, t in enumerate(every)}

    def known(terms: tuple[str, ...], columns: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Inputs over the terms of ``columns``, of which only ``terms`` count, and the categories by them."""
        mask = np.zeros(len(every), bool)
        mask[[place[t] for t in terms]] = True
        a, b = first & mask, second & mask
        x = (a | b)[:, columns].astype(float)
        y = np.stack([label * ((a | b).sum(axis=1) >= 3), label * (a.any(axis=1) & b.any(axis=1)), label], axis=1).astype(float)
        return _inputs(x), y

    own = [place[t] for t in picked[0]]
    x, y = known(picked[0], own)
    return fit(x, y, fold, CATEGORIES, picked[0], weight.astype(float), lambda k: known(picked[k + 1], list(range(len(every)))))


def scored(docs: DataFrame, chain: Chain, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.4) -> DataFrame:
    """(id_col, one probability for each category, is_toxic): is_toxic where the last category reaches ``threshold``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict[tuple[int, ...], list[float]] = {}
        for batch, hits in _hits(batches, chain.terms):
            keys = list(map(tuple, hits))
            new = [k for k in set(keys) if k not in memo]
            if len(memo) > 100_000:
                memo.clear()
                new = list(set(keys))
            if new:
                x = np.zeros((len(new), len(chain.terms)))
                for i, k in enumerate(new):
                    x[i, list(k)] = 1
                memo.update(zip(new, chain.predict(_inputs(x)).tolist(), strict=True))
            p = np.array([memo[k] for k in keys]).reshape(-1, len(chain.categories))
            yield pa.RecordBatch.from_arrays([batch.column("id"), *(pa.array(p[:, i]) for i in range(p.shape[1])), pa.array(p[:, -1] >= threshold)], ["id", *chain.categories, "is_toxic"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = "id long, " + ", ".join(f"`{x}` double" for x in chain.categories) + ", is_toxic boolean"
    return map_batches(rows, run, schema).withColumnRenamed("id", id_col)


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", threshold: float = 0.4, most: int = 20_000) -> DataFrame:
    """(id_col, severe, pervasive, toxic, is_toxic) for each row of ``docs``: the categories' probabilities and the decision.

    Null and empty texts have no terms and the chain's base probabilities. Repeated rows are scored each. Null ids are scored but
    teach nothing. Without labels of both kinds the probabilities are the labels' share. An empty table gives an empty result. Extra columns are ignored.
    """
    return scored(docs, train(docs, labels, id_col, text_col, label_col, most), id_col, text_col, threshold)


def without_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", threshold: float = 0.4, most: int = 20_000) -> DataFrame:
    """The rows of ``docs``, with all their columns, that :func:`toxicity` does not reject; the cases there hold."""
    chain = train(docs, labels, id_col, text_col, label_col, most)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def texts() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                held.append(batch)
                yield pa.RecordBatch.from_arrays([batch.column(text_col).cast(pa.string())], ["text"])

        held: list[pa.RecordBatch] = []
        at = 0
        for piece, hits in _hits(texts(), chain.terms):
            x = np.zeros((len(hits), len(chain.terms)))
            for i, k in enumerate(hits):
                x[i, k] = 1
            keep = chain.predict(_inputs(x))[:, -1] < threshold
            yield held[-1].slice(at, piece.num_rows).filter(pa.array(keep))
            at += piece.num_rows
            if at >= held[-1].num_rows:
                held.clear()
                at = 0

    return map_batches(docs, run, docs.schema)
