"""Quality scores by Bradley-Terry ranking of preference pairs.

A document's strength is a linear function of features of its text. For a pair in which the first is
preferred, the loss is the logistic loss on the difference of their features. Only a bounded sample of
labelled rows is fitted, on the driver; scoring covers all documents in one pass without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basetide.llm.common import texts

#: Characters whose shares are features of their own.
MARKS = "#*$%&|<>!?.,;:'\"-_/\\()[]{}=+@~^`"
_CLASSES = {"lower": b"abcdefghijklmnopqrstuvwxyz", "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": b"0123456789",
            "space": b" \t\r\x0b\x0c", "line": b"\n"}
FEATURES = ([*MARKS, *_CLASSES, "other_bytes", "log_words", "word_length", "long_words", "distinct_words", "dup_lines",
             "upper_words", "marked_words", "line_words", "mark_lines", "upper_lines", "worst_mark_line"])


def features(text: str) -> np.ndarray:
    """Measures of a whole text; shares as square roots. An empty text is all zeros."""
    raw = text.encode("utf-8", "replace")
    out = np.zeros(len(FEATURES))
    words = raw.split()
    if not words:
        return out
    a = np.frombuffer(raw, np.uint8)
    counts = np.bincount(a, minlength=256)
    share = lambda codes: counts[np.frombuffer(codes, np.uint8)].sum() / len(a)
    n = len(words)
    lengths = np.fromiter(map(len, words), np.int64, n)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    line_of = np.cumsum(a == 10)
    size = np.bincount(line_of)
    marks = np.bincount(line_of, weights=_IS_MARK[a]) / np.maximum(size, 1)
    upper = np.bincount(line_of, weights=_IS_UPPER[a]) / np.maximum(size, 1)
    values = [*(counts[ord(c)] / len(a) for c in MARKS), *(share(c) for c in _CLASSES.values()), counts[128:].sum() / len(a)]
    heavy, loud = marks > 0.12, upper > 0.5
    values += [np.log1p(n) ** 2 / 100, lengths.mean() / 10, (lengths > 14).mean(), len(set(words)) / n,
               1 - len(set(lines)) / len(lines), sum(map(bytes.isupper, words)) / n,
               sum(not w[-1:].isalnum() for w in words) / n, min(n / len(lines) / 100, 1.0),
               size[heavy].sum() / size.sum(), size[loud].sum() / size.sum(), marks.max(initial=0)]
    return np.sqrt(np.array(values, float))


_IS_MARK = np.zeros(256)
_IS_MARK[[ord(c) for c in MARKS if c not in ".,'\"-"]] = 1
_IS_UPPER = np.zeros(256)
_IS_UPPER[65:91] = 1


@dataclass(frozen=True)
class Ranker:
    """Strength ``(f - mean) / scale @ weights``, its mapping to a probability, and the quantiles of the
    preferred training documents' scores."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    slope: float
    shift: float
    preferred_scores: np.ndarray

    def strength(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.clip(self.slope * self.strength(x) + self.shift, -30, 30)
        return 1 / (1 + np.exp(-z))

    def threshold(self, quantile: float, at_most: float = 1.0) -> float:
        """Score that the given share of preferred training documents falls below."""
        return float(min(at_most, np.quantile(self.preferred_scores, quantile))) if len(self.preferred_scores) else 0.0


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float, steps: int = 60) -> np.ndarray:
    """Newton steps with halving for weighted logistic loss."""
    w = np.zeros(x.shape[1])

    def loss(v):
        z = x @ v
        return (weight * (np.logaddexp(0, z) - y * z)).sum() + ridge * (v @ v) / 2

    now = loss(w)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (weight * (p - y)) + ridge * w
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        t = 1.0
        while t > 1e-4 and (new := loss(w - t * step)) > now:
            t /= 2
        if t <= 1e-4 or now - new < 1e-9 * max(1.0, now):
            break
        w, now = w - t * step, new
    return w


def fit(x: np.ndarray, y: np.ndarray, share_preferred: float, pairs_per_row: int = 16, ridge: float = 1e-3) -> Ranker:
    """Fit a ranker to feature rows ``x`` with labels ``y``. Each row of the rarer label meets rows of the other
    one at even steps, as preference pairs. ``share_preferred`` is the share of label 1 among all labelled
    rows; it sets the level of the probabilities. One label or none gives a constant score."""
    good, bad = x[y == 1], x[y == 0]
    mean, scale = (x.mean(axis=0), x.std(axis=0) + 1e-3) if len(x) else (np.zeros(len(FEATURES)), np.ones(len(FEATURES)))
    if not len(good) or not len(bad):
        level = 0.5 if not len(x) else float(len(good) > 0)
        z = np.log((level * 0.98 + 0.01) / (0.99 - level * 0.98))
        n = len(good)
        return Ranker(mean, scale, np.zeros(len(mean)), 0.0, z, np.full(n, 1 / (1 + np.exp(-z))))
    longer, n = max(len(good), len(bad)), pairs_per_row
    i = np.arange(longer * n)
    g, b = i % len(good), (i * 7919 + i // longer) % len(bad)
    d = ((good[g] - mean) / scale) - ((bad[b] - mean) / scale)
    w = _logistic(d, np.ones(len(d)), np.full(len(d), 1 / n), ridge * longer)
    s = ((x - mean) / scale) @ w
    weight = np.where(y == 1, share_preferred / len(good), (1 - share_preferred) / len(bad)) * len(x)
    spread = s.std() + 1e-9
    a = _logistic(np.stack([s / spread, np.ones(len(s))], axis=1), y.astype(float), weight, 1e-2)
    ranker = Ranker(mean, scale, w, float(a[0] / spread), float(a[1]), np.zeros(0))
    return Ranker(mean, scale, w, ranker.slope, ranker.shift, np.sort(ranker.score(good)))


def train(docs: DataFrame, labels: DataFrame, learn_from: Column | None = None, max_labelled: int = 12_000,
          id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Ranker:
    """Learn from labelled documents.

    At most ``max_labelled`` rows are used, half of each label, chosen by a hash of the id; that bounds what is
    broadcast and what reaches the driver. ``learn_from`` restricts the labels by a condition on
    ``id_col``. Null ids and labels other than 0 and 1 are left out; an id labelled both ways counts as 0.
    """
    usable = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1))
    if learn_from is not None:
        usable = usable.where(learn_from)
    usable = usable.groupBy(F.col(id_col).alias("_id")).agg(F.min(label_col).cast("int").alias("_y"))
    n = {r["_y"]: r["n"] for r in usable.groupBy("_y").agg(F.count(F.lit(1)).alias("n")).collect()}  # two rows
    halves = [usable.where(F.col("_y") == v).orderBy(F.xxhash64("_id"), "_id").limit(max_labelled // 2) for v in (0, 1)]
    chosen = halves[0].unionByName(halves[1])
    rows = texts(docs, id_col, text_col).join(F.broadcast(chosen), F.col("id") == F.col("_id")).select("_y", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = [features(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("_y"), pa.array(x, pa.list_(pa.float64()))], ["y", "x"])

    # repeated document rows could exceed the bound
    sample = rows.mapInArrow(run, "y int, x array<double>").limit(2 * max_labelled).toPandas()
    # the order in which tasks deliver rows must not change the result
    x = np.array(sample["x"].tolist(), float).reshape(-1, len(FEATURES))
    order = np.lexsort((*x.T, sample["y"].to_numpy()))
    total = max(1, sum(n.values()))
    return fit(x[order], sample["y"].to_numpy()[order], min(max(n.get(1, 0) / total, 0.01), 0.99))


def score_documents(docs: DataFrame, ranker: Ranker, score_col: str = "score", text_col: str = "text") -> DataFrame:
    """``docs`` with its score between 0 and 1 as a last column. Null and empty texts are scored as texts without
    words; each row is scored by its text alone, whatever its id and however often it repeats."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.array([features(t or "") for t in b.column(text_col).to_pylist()]).reshape(-1, len(FEATURES))
            yield b.append_column(score_col, pa.array(ranker.score(x)))

    out = type(docs.schema)([*docs.schema.fields]).add(score_col, "double")
    return docs.mapInArrow(run, out)
