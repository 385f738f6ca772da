"""Document quality from a linear-chain conditional random field over lines.

Every line gets features of its own and of its neighbours. The field has two states, bad and good, and learns
from documents' labels, which all their lines share. Forward-backward gives each line's probability of being
good; the mean over lines weighted by length, put on the scale of the labels, is the document's quality.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trailmark.llm.common import by_batch
from trailmark.llm.toxicity import labelled_sample

UPPER, LETTER, DIGIT, STOP, SYMBOL, BAR, SPACE = range(1, 8)
OWN = (
    "log words", "upper-case share", "digit share", "symbol share", "bar share", "same word again", "new word share",
    "ends a sentence", "line again", "mean word length", "exclamation share",
)
TRAIN_LINES = 64  # a longer document is fitted in runs of so many lines; scoring takes it whole


def _classes() -> np.ndarray:
    """The class of each code point below 2^16; others count as letters."""
    table = np.full(1 << 16, LETTER, dtype=np.uint8)
    for code in range(1 << 16):
        c = chr(code)
        if c.isupper():
            table[code] = UPPER
        elif c.isdigit():
            table[code] = DIGIT
        elif c.isspace():
            table[code] = SPACE
        elif c in ".,;:'\"-?()":
            table[code] = STOP
        elif c in "|<>{}[]=\\/_":
            table[code] = BAR
        elif not c.isalpha() and not 0xD800 <= code < 0xE000 and not c.isalnum() and code < 0x300:
            table[code] = SYMBOL
    return table


_TABLE: list[np.ndarray] = []


def line_features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(features by line, weight by line); a text without any line of words has one empty line."""
    if not _TABLE:
        _TABLE.append(_classes())
    lines = [line for line in (text or "").split("\n") if line and not line.isspace()] or [""]
    sizes = np.array([len(line) for line in lines], dtype=np.int64)
    codes = np.frombuffer("".join(lines).encode("utf-32-le", "replace"), dtype=np.uint32)
    kinds = _TABLE[0][np.minimum(codes, 0xFFFF)]
    out = np.zeros((len(lines), len(OWN)))
    if len(codes):
        starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))

        def share(mask: np.ndarray) -> np.ndarray:
            return np.add.reduceat(mask.astype(np.int32), starts) / sizes

        out[:, 1], out[:, 2], out[:, 3], out[:, 4] = (share(kinds == k) for k in (UPPER, DIGIT, SYMBOL, BAR))
        out[:, 10] = share(codes == ord("!"))
    met: dict[str, int] = {}
    for line in lines:
        met[line] = met.get(line, 0) + 1
    for i, line in enumerate(lines):
        words = line.split()
        n = len(words)
        out[i, 0] = np.log1p(n)
        if n > 1:
            out[i, 5] = sum(map(str.__eq__, words, words[1:])) / (n - 1)
        if n:
            out[i, 6] = len(set(words)) / n
            out[i, 9] = min(sizes[i] / n, 40) / 10
        out[i, 7] = line.rstrip()[-1:] in (".", "!", "?", ":")
        out[i, 8] = met[line] > 1
    return out, np.maximum(sizes, 1).astype(float)


def with_neighbours(own: np.ndarray) -> np.ndarray:
    """Own features, those of the line before and after (zero at the ends), whether there is one, and 1."""
    n = len(own)
    none = np.zeros((1, own.shape[1]))
    before, after = np.vstack([none, own[:-1]]), np.vstack([own[1:], none])
    first, last = np.zeros((n, 1)), np.zeros((n, 1))
    first[0], last[-1] = 1, 1
    return np.hstack([own, before, after, first, last, np.ones((n, 1))])


def good_marginals(potential: np.ndarray, move: np.ndarray) -> np.ndarray:
    """P(good) of every line: forward-backward over two states, scaled at each step.

    ``potential`` is the log weight of good against bad by line, ``move[a, b]`` that of state b after state a.
    """
    odds = np.exp(np.clip(potential, -30, 30)).tolist()
    (bb, bg), (gb, gg) = np.exp(move).tolist()
    n = len(odds)
    forward = [0.0] * n  # share of good among the two forward weights
    bad, good = 1.0, odds[0]
    forward[0] = good / (bad + good)
    for i in range(1, n):
        g = forward[i - 1]
        bad, good = (1 - g) * bb + g * gb, ((1 - g) * bg + g * gg) * odds[i]
        forward[i] = good / (bad + good)
    out = [0.0] * n
    back_bad, back_good = 1.0, 1.0
    for i in range(n - 1, -1, -1):
        g = forward[i] * back_good
        b = (1 - forward[i]) * back_bad
        out[i] = g / (g + b)
        up_bad, up_good = back_bad, back_good * odds[i]
        back_bad, back_good = bb * up_bad + bg * up_good, gb * up_bad + gg * up_good
        total = back_bad + back_good
        back_bad, back_good = back_bad / total, back_good / total
    return np.array(out)


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # good against bad, by feature of with_neighbours
    move: np.ndarray  # log weights of bad and good after bad and good
    slope: float
    offset: float

    def lines(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """(P(good), weight) of every line."""
        own, size = line_features(text)
        return good_marginals(with_neighbours((own - self.mean) / self.scale) @ self.weights, self.move), size

    def share(self, text: str | None) -> float:
        good, size = self.lines(text)
        return float((good * size).sum() / size.sum())

    def score(self, text: str | None) -> float:
        return float(_sigmoid(self.slope * _logit(self.share(text)) + self.offset))


def _logit(p):
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def _log_add(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.logaddexp(a, b)


def _expected(potential: np.ndarray, mask: np.ndarray, move: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Log partition sum, P(good) by line and expected moves, over padded chains (chain, line)."""
    chains, n = potential.shape
    alpha = np.zeros((chains, n, 2))
    alpha[:, 0, 1] = potential[:, 0]
    for i in range(1, n):
        for s in (0, 1):
            step = _log_add(alpha[:, i - 1, 0] + move[0, s], alpha[:, i - 1, 1] + move[1, s]) + s * potential[:, i]
            alpha[:, i, s] = np.where(mask[:, i], step, alpha[:, i - 1, s])
    total = _log_add(alpha[:, -1, 0], alpha[:, -1, 1])
    beta = np.zeros((chains, n, 2))
    for i in range(n - 2, -1, -1):
        for s in (0, 1):
            step = _log_add(beta[:, i + 1, 0] + move[s, 0], beta[:, i + 1, 1] + move[s, 1] + potential[:, i + 1])
            beta[:, i, s] = np.where(mask[:, i + 1], step, beta[:, i + 1, s])
    good = np.exp(alpha[:, :, 1] + beta[:, :, 1] - total[:, None]) * mask
    moves = np.zeros((2, 2))
    for a in (0, 1):
        for b in (0, 1):
            pair = alpha[:, :-1, a] + move[a, b] + b * potential[:, 1:] + beta[:, 1:, b] - total[:, None]
            moves[a, b] = (np.exp(pair) * mask[:, 1:]).sum()
    return float(total.sum()), good, moves


def fit_chain(chains: Sequence[np.ndarray], labels: np.ndarray, l2: float = 1e-3, rounds: int = 150) -> tuple[np.ndarray, np.ndarray]:
    """(weights, move) that maximise the likelihood of every line of a chain having the chain's label (Adam).

    Classes are weighted equal, so that rare bad documents count; the scale of the score is set afterwards.
    """
    width, longest = chains[0].shape[1], max(len(c) for c in chains)
    x, mask = np.zeros((len(chains), longest, width)), np.zeros((len(chains), longest), dtype=bool)
    for i, c in enumerate(chains):
        x[i, : len(c)], mask[i, : len(c)] = c, True
    y = labels.astype(float)
    weight = np.where(y == 1, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9))
    weight = weight / np.maximum(mask.sum(axis=1), 1)  # a document counts once, however many lines it has
    weight /= weight.sum()
    lines = mask.sum(axis=1)
    w, move = np.zeros(width), np.zeros((2, 2))
    m, v = np.zeros(width + 4), np.zeros(width + 4)
    for t in range(1, rounds + 1):
        potential = x @ w
        grad_w, grad_m = l2 * w, l2 * move
        for label in (0, 1):
            of = y == label
            if not of.any():
                continue
            # chains of one label, their weights folded into the line terms; moves use the mean weight
            _, good, moves = _expected(potential[of], mask[of], move)
            lift = ((label * mask[of]) - good) * weight[of][:, None]
            grad_w = grad_w - np.einsum("cl,clk->k", lift, x[of])
            seen = np.zeros((2, 2))
            seen[label, label] = (lines[of] - 1).sum()
            grad_m = grad_m - (seen - moves) * weight[of].mean()
        g = np.concatenate([grad_w, grad_m.ravel()])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        new = 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-9)
        w, move = w - new[:width], np.clip(move - new[width:].reshape(2, 2), -4, 4)
    return w, move


def _calibrated(share: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve from the good share to the label (Newton steps, slope at least 0.1)."""
    x = np.stack([_logit(share), np.ones(len(share))], axis=1)
    z, prior = np.array([1.0, 0.0]), 1e-2
    for _ in range(30):
        p = _sigmoid(x @ z)
        grad = x.T @ (p - y) + prior * (z - [1.0, 0.0])
        hess = (x * (p * (1 - p))[:, None]).T @ x + prior * np.eye(2)
        z = z - np.clip(np.linalg.solve(hess, grad), -1, 1)
    return max(float(z[0]), 0.1), float(z[1])


def _sampled_lines(sample: DataFrame) -> pd.DataFrame:
    schema = T.StructType.fromDDL("id long, label int, x array<double>, size array<double>")

    def make():
        def on(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [line_features(t) for t in batch.column(2).to_pylist()]
            lists = [pa.array([f[k].ravel().tolist() for f in found], pa.list_(pa.float64())) for k in (0, 1)]
            return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *lists], schema.names)

        return on

    rows = sample.select(F.col("id").cast("long").alias("id"), F.col("label").cast("int").alias("label"), "text")
    return rows.mapInArrow(by_batch(make), schema).toPandas().sort_values(["id", "label"], ignore_index=True)


def fit(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", label: str = "quality", rows: int = 4_000
) -> Model:
    """Learn from at most ``rows`` labelled documents whose id is not held out (see ``labelled_sample``).

    Their line features are computed in tasks; the driver gets a few numbers a line of this bounded sample.
    Without both classes among the labels the score is the constant share of label 1 (0.5 without any).
    """
    data = _sampled_lines(labelled_sample(docs, labels, label, rows, id_column, text_column))
    y = data["label"].to_numpy(dtype=float) if len(data) else np.array([])
    width = 3 * len(OWN) + 3
    if not len(y) or y.min() == y.max():
        share = float(y.mean()) if len(y) else 0.5
        constant = float(_logit(share))
        return Model(np.zeros(len(OWN)), np.ones(len(OWN)), np.zeros(width), np.zeros((2, 2)), 0.0, constant)
    own = [np.asarray(x).reshape(-1, len(OWN)) for x in data["x"]]
    every = np.vstack(own)
    mean, scale = every.mean(axis=0), every.std(axis=0) + 1e-6
    chains, marks = [], []
    for x, label_ in zip(own, y):
        ready = with_neighbours((x - mean) / scale)
        for at in range(0, len(ready), TRAIN_LINES):
            chains.append(ready[at : at + TRAIN_LINES])
            marks.append(label_)
    weights, move = fit_chain(chains, np.array(marks))
    model = Model(mean, scale, weights, move, 1.0, 0.0)
    share = []
    for x, size in zip(own, data["size"]):
        good = good_marginals(with_neighbours((x - mean) / scale) @ weights, move)
        share.append((good * size).sum() / np.sum(size))
    model.slope, model.offset = _calibrated(np.array(share), y)
    return model


def score(text: Column, model: Model) -> Column:
    """The quality in [0, 1] of each whole text; NULL, empty and white texts are one empty line."""

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series([model.score(t) for t in texts], dtype="float64")

    return scored(text)


def line_quality(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, line, good, weight): the field's labels by line, for those who drop bad lines and not documents."""
    schema = T.StructType.fromDDL("id long, good array<double>, weight array<double>")

    def make():
        def on(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [model.lines(t) for t in batch.column(1).to_pylist()]
            lists = [pa.array([f[k].tolist() for f in found], pa.list_(pa.float64())) for k in (0, 1)]
            return pa.RecordBatch.from_arrays([batch.column(0), *lists], schema.names)

        return on

    rows = docs.select(F.col(f"`{id_column}`").cast("long").alias("id"), F.col(f"`{text_column}`").alias("text"))
    found = rows.mapInArrow(by_batch(make), schema)
    return found.select("id", F.posexplode(F.arrays_zip("good", "weight")).alias("line", "c")).select("id", "line", "c.good", "c.weight")
