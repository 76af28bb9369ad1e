"""Document quality from preference pairs: a Bradley-Terry model over text features, thresholded by score quantile.

Labelled documents give pairs of a better and a worse one. The probability that i beats j is the logistic of w.(x_i - x_j); w comes
from Newton steps on the logistic loss of the feature differences. A document's strength is w.x; strengths are turned into scores between
0 and 1 so that a stated score lies at the quantile of the training strengths that parts the labels' shares.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orchardflow.llm._common import labelled, map_batches, slices, stored

FEATURES = ("log_words", "upper", "symbols", "digits", "other_marks", "distinct_words", "adjacent_repeats", "word_length", "bars", "word_ends", "compressed", "long_line")
SYMBOLS, DIGITS, MARKS = b"*$&%#!@^~<>{}[]=+_", b"0123456789", b".,;:'\"()-?/"


def features(text: str | None) -> list[float]:
    """Measures of a whole text; null counts as empty, for which all are 0."""
    if not text:
        return [0.0] * len(FEATURES)
    raw = text.encode()
    size = len(raw)
    words = text.split()
    n = max(1, len(words))
    lower = text.lower()
    if len(lower) == len(text):
        upper = int((np.frombuffer(text.encode("utf-32-le"), np.uint32) != np.frombuffer(lower.encode("utf-32-le"), np.uint32)).sum())
    else:
        upper = sum(map(str.isupper, text))
    share = lambda marks: (size - len(raw.translate(None, marks))) / size
    again = sum(map(str.__eq__, words, words[1:]))
    ended = sum(x[-1] in "*$&%#!" for x in words)
    return [
        float(np.log1p(len(words))),
        upper / len(text),
        share(SYMBOLS),
        share(DIGITS),
        share(MARKS),
        len(set(words)) / n if words else 0.0,
        again / n,
        min(20.0, len(text) / n) / 20,
        share(b"|"),
        ended / n,
        len(zlib.compress(raw, 1)) / (size + 20),
        float(np.log1p(max(map(len, text.split("\n"))))) / 10,
    ]


def featured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, x): the features of each row's whole text. Other columns are ignored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([features(x) for x in batch.column(1).to_pylist()], pa.list_(pa.float64()))], ["id", "x"])

    return map_batches(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")), run, "id long, x array<double>")


@dataclass(frozen=True)
class Model:
    """Strength w.z(x), z the standardised features with their squares; a score of ``at`` lies at strength ``cut``."""

    mean: tuple[float, ...]
    scale: tuple[float, ...]
    weights: tuple[float, ...]
    cut: float
    spread: float
    at: float

    def strength(self, x: np.ndarray) -> np.ndarray:
        return _expanded(x, np.array(self.mean), np.array(self.scale)) @ np.array(self.weights)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip((self.strength(x) - self.cut) / self.spread + np.log(self.at / (1 - self.at)), -40, 40)))


def _expanded(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    z = np.clip((x - mean) / scale, -6, 6)
    return np.concatenate([z, z * z], axis=1)


def fit(x: np.ndarray, label: np.ndarray, pairs: int = 60_000, ridge: float = 1e-2, at: float = 0.3, seed: int = 7) -> Model:
    """Learn from rows with labels 1 (better) and 0. Without both labels every strength is 0 and every score is ``at`` or the share of 1s."""
    if x.ndim != 2 or not len(x):
        x = np.zeros((0, len(FEATURES)))
    mean = x.mean(axis=0) if len(x) else np.zeros(x.shape[1])
    scale = np.where((s := x.std(axis=0) if len(x) else np.ones(x.shape[1])) > 1e-9, s, 1.0)
    good, bad = np.flatnonzero(label == 1), np.flatnonzero(label == 0)
    w = np.zeros(2 * x.shape[1])
    if not len(good) or not len(bad):
        return Model(tuple(mean), tuple(scale), tuple(w), 0.0 if len(bad) == 0 else 1.0, 1.0, at)
    z = _expanded(x, mean, scale)
    rng = np.random.default_rng(seed)
    for _ in range(3):  # pairs are drawn anew, so that most comparisons among many rows are seen
        d = z[rng.choice(good, pairs)] - z[rng.choice(bad, pairs)]
        for _ in range(8):
            p = 1 / (1 + np.exp(-np.clip(d @ w, -40, 40)))
            gradient = d.T @ (p - 1) / pairs + ridge * w
            hessian = (d * (p * (1 - p))[:, None]).T @ d / pairs + ridge * np.eye(len(w))
            step = np.linalg.solve(hessian, gradient)
            w -= step
            if np.abs(step).max() < 1e-6:
                break
    strength = z @ w
    share = len(bad) / len(label)
    low, high = np.quantile(strength, [max(0.0, share - 0.01), min(1.0, share + 0.01)])
    return Model(tuple(mean), tuple(scale), tuple(w), float((low + high) / 2), float(max(1e-6, strength.std() / 4)), at)


def train(rows: DataFrame, labels: DataFrame, allowed: Column, id_col: str = "doc_id", label_col: str = "quality", most: int = 20_000) -> Model:
    """Fit on the labelled rows of ``rows`` (id, x) that ``allowed`` (over id) admits: at most ``most``, chosen by a hash of the id.

    An id with contradictory labels teaches nothing; of rows that repeat an id one teaches, the same in any order.
    """
    chosen = labelled(labels, id_col, label_col, most, allowed)  # its size is proven: at most ``most`` rows of two numbers
    found = rows.join(F.broadcast(chosen), "id").groupBy("id").agg(F.min("x").alias("x"), F.min("label").alias("label")).orderBy("id").collect()  # as many
    return fit(np.array([r.x for r in found], float), np.array([r.label for r in found], int))


def good_only(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", at: float = 0.3, most: int = 20_000) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose score reaches ``at``; the cases of :func:`quality` hold."""
    sample = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    there = sample.select("id").distinct()
    known = labels.join(there, F.col(id_col).cast("long") == F.col("id"), "left_semi")
    chosen = labelled(known, id_col, label_col, most, ~held_out(F.col("id"))).select("id")  # bounded, as it says
    model = train(featured(sample.join(F.broadcast(chosen), "id"), "id"), known, ~held_out(F.col("id")), id_col, label_col, most)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            x = np.array([features(t) for t in batch.column(text_col).cast(pa.string()).to_pylist()], float).reshape(-1, len(FEATURES))
            yield batch.filter(pa.array(model.score(x) >= at))

    return map_batches(docs, run, docs.schema)


def scored(rows: DataFrame, model: Model, id_col: str = "doc_id") -> DataFrame:
    """(id_col, score, predicted): predicted is 1 where the score reaches the model's threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array(batch.column("x").to_pylist(), float).reshape(-1, len(FEATURES))
            score = model.score(x)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(score), pa.array((score >= model.at).astype(np.int32))], ["id", "score", "predicted"])

    return map_batches(rows.select("id", "x"), run, "id long, score double, predicted int").withColumnRenamed("id", id_col)


def held_out(key: Column) -> Column:
    """Whether a document is kept from training: crc32 of its id as text, modulo 5, is 0. A null id is not held out."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", at: float = 0.3, most: int = 20_000) -> DataFrame:
    """(id_col, held_out, score, predicted) for each row of ``docs``, learned from ``labels`` of documents that are not held out.

    Null and empty texts have a score like any other. Repeated rows are scored each; null ids are scored but teach nothing; null
    labels teach nothing; without any labels all scores are equal. An empty table gives an empty result. Extra columns are ignored.
    """
    rows = stored(featured(docs, id_col, text_col), "features")
    model = train(rows, labels, ~held_out(F.col("id")), id_col, label_col, most)
    if at != model.at:
        model = Model(model.mean, model.scale, model.weights, model.cut, model.spread, at)
    out = scored(rows, model, id_col)
    return out.select(id_col, held_out(F.col(id_col)).alias("held_out"), "score", "predicted")
