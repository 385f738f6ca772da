"""A toxicity classifier that must not react to who a sentence is about.

Logistic regression over words and word beginnings. Every labelled sentence that names a group gets a twin that
names another, and the fit is penalised for the squared change of the score between the two, so that identity
terms that are frequent in toxic text do not become evidence by themselves.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trailmark.llm.common import by_batch, cut, held_out

#: Groups of identity terms; a term's counterfactual is the next one of its group.
IDENTITY = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("girl", "boy"), ("female", "male"),
    ("gay", "straight", "lesbian", "bisexual"), ("transgender", "cisgender"),
    ("black", "white", "asian", "latino", "arab"), ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("immigrant", "native", "refugee"), ("immigrants", "natives", "refugees"), ("old", "young"), ("deaf", "blind"),
)

WORD = re.compile(r"[^\W\d_]+")
SENTENCE = re.compile(r"[^.!?\n]+")
STEMS = (3, 4, 5, 6)


def features_of(word: str) -> list[str]:
    """A lower-cased word and its beginnings of 3 to 6 letters, which stand for inflected forms."""
    return [word, *[word[:k] + "*" for k in STEMS if len(word) > k]]


def features(text: str) -> set[str]:
    return {f for w in set(WORD.findall(text.lower())) for f in features_of(w)}


def swapped(sentence: str, groups: Sequence[Sequence[str]]) -> str | None:
    """The sentence with each identity term replaced by the next of its group; None if it has none."""
    turn = {term: g[(i + 1) % len(g)] for g in groups for i, term in enumerate(g)}
    words = WORD.findall(sentence.lower())
    return " ".join(turn.get(w, w) for w in words) if any(w in turn for w in words) else None


@dataclass
class Model:
    """Weights by feature; what a word adds is remembered per task."""

    weights: dict[str, float]
    bias: float
    terms: dict[str, list[str]] = field(default_factory=dict)

    def score(self, text: str | None) -> float:
        seen, known = set(), self.terms
        for word in set(WORD.findall((text or "").lower())):
            hits = known.get(word)
            if hits is None:
                hits = [f for f in features_of(word) if f in self.weights]
                if len(known) >= 300_000:
                    known.clear()
                known[word] = hits
            seen.update(hits)
        total = self.bias + sum(self.weights[f] for f in sorted(seen))
        return float(1.0 / (1.0 + np.exp(-np.clip(total, -60, 60))))


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, rows: int, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """(id, text, label) of at most ``rows`` labelled documents outside the held-out fifth.

    The ids are those of smallest hash, so the sample is the same on every run. They are few by this bound, so
    they are broadcast and the texts are not shuffled. An id that repeats among the labels counts once, with its
    largest label; texts that repeat count once.
    """
    wanted = (
        labels.where(~held_out(F.col(f"`{id_column}`")) & F.col(f"`{label}`").isNotNull())
        .groupBy(F.col(f"`{id_column}`").alias("id"))
        .agg(F.max(F.col(f"`{label}`").cast("int")).alias("label"))
        .orderBy(F.xxhash64("id"), "id")
        .limit(rows)
    )
    texts = docs.select(F.col(f"`{id_column}`").alias("id"), F.coalesce(F.col(f"`{text_column}`"), F.lit("")).alias("text"))
    return cut(texts.join(F.broadcast(wanted), "id").dropDuplicates(["text", "label"]))


def _feature_counts(sample: DataFrame) -> DataFrame:
    """(feature, hit, miss): in how many toxic and other texts each feature stands."""
    schema = T.StructType.fromDDL("feature string, hit long, miss long")

    def count(batches):
        tallies = (Counter(), Counter())
        for frame in batches:
            for text, y in zip(frame["text"], frame["label"]):
                tallies[0 if y else 1].update(features(text))
        names = list(tallies[0].keys() | tallies[1].keys())
        for at in range(0, len(names), 50_000):
            part = names[at : at + 50_000]
            yield pd.DataFrame({"feature": part, "hit": [tallies[0][n] for n in part], "miss": [tallies[1][n] for n in part]})

    return sample.select("text", "label").mapInPandas(count, schema).groupBy("feature").agg(F.sum("hit").alias("hit"), F.sum("miss").alias("miss"))


def telling_features(sample: DataFrame, most: int, least_z: float) -> list[str]:
    """The ``most`` features whose rate differs most between the classes, by the two-proportion z statistic."""
    sizes = sample.agg(F.sum("label").alias("hit"), F.count(F.lit(1)).alias("n")).first()
    hit, miss = float(sizes["hit"] or 0), float((sizes["n"] or 0) - (sizes["hit"] or 0))
    if not hit or not miss:
        return []
    rate = (F.col("hit") + F.col("miss")) / (hit + miss)
    z = (F.col("hit") / hit - F.col("miss") / miss) / F.sqrt(rate * (1 - rate) * (1 / hit + 1 / miss) + 1e-12)
    scored = _feature_counts(sample).where("hit + miss >= 3").withColumn("z", F.abs(z)).where(F.col("z") > least_z)
    return [r["feature"] for r in scored.orderBy(F.desc("z"), "feature").limit(most).select("feature").collect()]


def _encoded(sample: DataFrame, vocabulary: list[str], groups) -> pd.DataFrame:
    """Per sampled text: label, feature numbers, and the feature numbers of its identity sentences and their twins."""
    place = {f: i for i, f in enumerate(vocabulary)}
    schema = T.StructType.fromDDL("label int, x array<int>, plain array<array<int>>, twin array<array<int>>")

    def numbers(text: str) -> list[int]:
        return sorted(place[f] for f in features(text) if f in place)

    def make():
        terms = {t for g in groups for t in g}

        def on(batch: pa.RecordBatch) -> pa.RecordBatch:
            out = {"label": [], "x": [], "plain": [], "twin": []}
            for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = set(WORD.findall(text.lower()))
                pairs = []
                if words & terms:
                    pairs = [(s, swapped(s, groups)) for s in SENTENCE.findall(text)]
                    pairs = [(numbers(s), numbers(t)) for s, t in pairs if t is not None]
                out["label"].append(y)
                out["x"].append(numbers(text))
                out["plain"].append([a for a, _ in pairs])
                out["twin"].append([b for _, b in pairs])
            kinds = [pa.int32(), pa.list_(pa.int32()), pa.list_(pa.list_(pa.int32())), pa.list_(pa.list_(pa.int32()))]
            return pa.RecordBatch.from_arrays([pa.array(out[n], k) for n, k in zip(schema.names, kinds)], schema.names)

        return on

    return sample.select("text", "label").mapInArrow(by_batch(make), schema).toPandas()


class _Sparse:
    """Rows of (column, value) with the two products that the fit needs."""

    def __init__(self, columns: int, cols: list[np.ndarray], vals: list[np.ndarray] | None = None) -> None:
        self.n, self.columns = len(cols), columns
        self.row = np.repeat(np.arange(self.n), [len(c) for c in cols])
        self.col = np.concatenate([np.asarray(c, dtype=np.int64) for c in cols] or [np.zeros(0, dtype=np.int64)])
        self.val = np.ones(len(self.col)) if vals is None else np.concatenate([*vals, np.zeros(0)])

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.val * w[self.col], self.n)

    def back(self, e: np.ndarray) -> np.ndarray:
        return np.bincount(self.col, self.val * e[self.row], self.columns)


def fit_weights(
    x: Sequence[Sequence[int]], y: np.ndarray, pairs: Sequence[tuple[Sequence[int], Sequence[int]]], columns: int,
    l1: float, fairness: float, rounds: int = 600,
) -> tuple[np.ndarray, float]:
    """Mean log loss + ``l1`` |w| + ``fairness`` x mean squared score change over the pairs, by FISTA."""
    rows = _Sparse(columns, x)
    moved = [np.setxor1d(a, b).astype(np.int64) for a, b in pairs]
    twins = _Sparse(columns, moved, [np.where(np.isin(c, a), 1.0, -1.0) for c, (a, _) in zip(moved, pairs)])
    n, m = max(rows.n, 1), max(twins.n, 1)

    def curvature(w, b):
        g = rows.dot(w) + b
        return rows.back(g) * 0.25 / n + 2 * fairness / m * twins.back(twins.dot(w)), 0.25 * g.sum() / n

    w, b = np.ones(columns), 1.0
    top = 1.0
    for _ in range(30):
        gw, gb = curvature(w, b)
        top = float(np.sqrt(gw @ gw + gb * gb)) or 1.0
        w, b = gw / top, gb / top
    step = 1 / (1.05 * top)
    w, b = np.zeros(columns), float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
    vw, vb, t = w.copy(), b, 1.0
    for _ in range(rounds):
        e = 1 / (1 + np.exp(-np.clip(rows.dot(vw) + vb, -60, 60))) - y
        gw = rows.back(e) / n + 2 * fairness / m * twins.back(twins.dot(vw))
        nw = vw - step * gw
        nw = np.sign(nw) * np.maximum(np.abs(nw) - step * l1, 0)
        nb = vb - step * e.sum() / n
        nt = (1 + np.sqrt(1 + 4 * t * t)) / 2
        vw, vb = nw + (t - 1) / nt * (nw - w), nb + (t - 1) / nt * (nb - b)
        w, b, t = nw, nb, nt
    return w, float(b)


def fit(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", label: str = "toxic",
    rows: int = 16_000, vocabulary: int = 4_000, least_z: float = 2.5, l1: float = 1e-4, fairness: float = 1.0,
    groups: Sequence[Sequence[str]] = IDENTITY,
) -> Model:
    """Learn from at most ``rows`` labelled documents whose id is not held out (see ``labelled_sample``).

    The ``vocabulary`` features that tell the classes best are chosen by counts in tasks; their rows, at most
    ``rows`` lists of feature numbers, are fitted on the driver. Without both classes among the labels the model
    is the constant share of label 1 (0.5 without any).
    """
    sample = labelled_sample(docs, labels, label, rows, id_column, text_column)
    names = telling_features(sample, vocabulary, least_z)
    data = _encoded(sample, names, groups)
    y = data["label"].to_numpy(dtype=float) if len(data) else np.array([])
    if not len(y) or y.min() == y.max():
        share = float(y.mean()) if len(y) else 0.5
        return Model({}, float(np.log((share + 1e-3) / (1 - share + 1e-3))))
    pairs = [(a, b) for ps, ts in zip(data["plain"], data["twin"]) for a, b in zip(ps, ts)]
    w, b = fit_weights(list(data["x"]), y, pairs, len(names), l1, fairness)
    return Model({f: float(v) for f, v in zip(names, w) if v}, b)


def score(text: Column, model: Model) -> Column:
    """The probability of label 1 for each whole text; NULL and empty texts get the model's bias alone."""

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series([model.score(t) for t in texts], dtype="float64")

    return scored(text)


def drop_toxic(docs: DataFrame, model: Model, text_column: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose score is under ``threshold``, with all columns."""
    return docs.where(score(F.col(f"`{text_column}`"), model) < threshold)
