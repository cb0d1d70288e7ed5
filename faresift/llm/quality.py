"""Quality of a text by a generalised additive model with pairwise interactions.

Features are counts and shares of the whole text. Cyclic boosting visits one feature after the other,
round by round, and adds a shallow tree on its bins to the feature's lookup table; then the pairs
that explain most of what is left get tables of their own. A score is a sum of table entries.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from faresift.llm.common import bounded_sample, held_out

FOLDS, FOLD = 5, 0
THRESHOLD = 0.3
# Bound of the fitted sample; its rows are taken by hash of the id.
SAMPLE_ROWS = 20_000
BINS = 32
PAIR_BINS = 8
PAIRS = 5
ROUNDS = 120
RATE = 0.15
LEAF_WEIGHT = 2.0
DEPTH = 2

FEATURES = (
    "log_words",
    "mean_word",
    "long_words",
    "upper_share",
    "digit_share",
    "symbol_share",
    "stop_share",
    "non_ascii_share",
    "marked_words",
    "bare_words",
    "distinct_share",
    "repeated_neighbours",
    "commonest_share",
    "repeated_lines",
    "words_per_line",
)
_STOPS = np.frombuffer(b".,;:'\"-()", np.uint8)


def features(text: str | None) -> list[float]:
    """FEATURES of one text, in order; all zero without words."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    if not words:
        return [0.0] * len(FEATURES)
    n, counts = len(words), np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    upper, lower, digits = counts[65:91].sum(), counts[97:123].sum(), counts[48:58].sum()
    blank, stops, wide = counts[:33].sum(), counts[_STOPS].sum(), counts[128:].sum()
    visible = max(1, len(raw) - blank)
    symbols = visible - upper - lower - digits - stops - wide
    seen = Counter(words)
    lines = [line for line in raw.split(b"\n") if line.strip()]
    lengths = np.fromiter(map(len, words), np.int64, n)
    return [
        float(np.log1p(n)),
        float(lengths.mean()),
        float((lengths > 20).mean()),
        float(upper / max(1, upper + lower)),
        float(digits / visible),
        float(symbols / visible),
        float(stops / visible),
        float(wide / visible),
        sum(w[-2:] in _MARKS for w in words) / n,
        sum(len(w) == 1 and not w.isalnum() and w < b"\x80" for w in words) / n,
        len(seen) / n,
        sum(map(bytes.__eq__, words, words[1:])) / n,
        seen.most_common(1)[0][1] / n,
        1 - len(set(lines)) / max(1, len(lines)),
        float(np.log1p(n / max(1, len(lines)))),
    ]


# Doubled symbols at the end of a word.
_MARKS = frozenset(bytes([c, c]) for c in range(33, 127) if not chr(c).isalnum())


@dataclass(frozen=True)
class Model:
    """Bin edges and tables: one table per feature, one per chosen pair on coarser bins."""

    intercept: float
    edges: tuple[np.ndarray, ...]
    tables: tuple[np.ndarray, ...]
    pairs: tuple[tuple[int, int], ...] = ()
    pair_edges: tuple[np.ndarray, ...] = ()
    pair_tables: tuple[np.ndarray, ...] = ()

    def scores(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.intercept)
        for j, (edges, table) in enumerate(zip(self.edges, self.tables, strict=True)):
            total += table[np.searchsorted(edges, x[:, j], side="right")]
        for (a, b), table in zip(self.pairs, self.pair_tables, strict=True):
            total += table[_binned(self.pair_edges[a], x[:, a]), _binned(self.pair_edges[b], x[:, b])]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _binned(edges: np.ndarray, values: np.ndarray) -> np.ndarray:
    return np.searchsorted(edges, values, side="right")


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1])) if len(values) else np.array([])


def _tree(gradient: np.ndarray, weight: np.ndarray, depth: int = DEPTH) -> np.ndarray:
    """Step values of a shallow tree over ordered bins: each split is where the gain is largest."""
    g, h = gradient.sum(), weight.sum()
    leaf = np.full(len(gradient), g / (h + LEAF_WEIGHT))
    if depth == 0 or len(gradient) < 2:
        return leaf
    left_g, left_h = np.cumsum(gradient)[:-1], np.cumsum(weight)[:-1]
    part = lambda a, b: a * a / (b + LEAF_WEIGHT)
    gain = part(left_g, left_h) + part(g - left_g, h - left_h) - part(g, h)
    at = int(gain.argmax()) + 1
    if gain[at - 1] <= 1e-9:
        return leaf
    return np.concatenate([_tree(gradient[:at], weight[:at], depth - 1), _tree(gradient[at:], weight[at:], depth - 1)])


def _pair_tree(gradient: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, float]:
    """Step values of a tree over a grid: the best row split, then a column split on each side; and its gain."""
    part = lambda a, b: a * a / (b + LEAF_WEIGHT)
    best, values = 0.0, np.zeros_like(gradient)
    for at in range(1, len(gradient)):
        sides, gain = [], -part(gradient.sum(), weight.sum())
        for rows in (slice(None, at), slice(at, None)):
            g, h = gradient[rows].sum(axis=0), weight[rows].sum(axis=0)
            steps = _tree(g, h, 1)
            for level in np.unique(steps):
                gain += part(g[steps == level].sum(), h[steps == level].sum())
            sides.append(np.repeat(steps[None], at if rows.start is None else len(gradient) - at, axis=0))
        if gain > best:
            best, values = gain, np.concatenate(sides)
    return values, best


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """Fit to rows of FEATURES and 0/1 labels; without rows every score is one half."""
    if not len(y):
        none = tuple(np.array([]) for _ in FEATURES)
        return Model(0.0, none, tuple(np.zeros(1) for _ in FEATURES))
    share = float(np.clip(y.mean(), 0.001, 0.999))
    intercept = float(np.log(share / (1 - share)))
    edges = tuple(_edges(x[:, j], BINS) for j in range(x.shape[1]))
    places = [_binned(e, x[:, j]) for j, e in enumerate(edges)]
    tables = [np.zeros(len(e) + 1) for e in edges]
    total = np.full(len(y), intercept)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for place, table in zip(places, tables, strict=True):
            g, h = slopes()
            step = RATE * _tree(np.bincount(place, g, len(table)), np.bincount(place, h, len(table)))
            table += step
            total += step[place]

    coarse = tuple(_edges(x[:, j], PAIR_BINS) for j in range(x.shape[1]))
    spots = [_binned(e, x[:, j]) for j, e in enumerate(coarse)]

    def grid(a: int, b: int, values: np.ndarray) -> np.ndarray:
        shape = len(coarse[a]) + 1, len(coarse[b]) + 1
        return np.bincount(spots[a] * shape[1] + spots[b], values, shape[0] * shape[1]).reshape(shape)

    g, h = slopes()
    gains = {(a, b): _pair_tree(grid(a, b, g), grid(a, b, h))[1] for a, b in combinations(range(x.shape[1]), 2)}
    pairs = tuple(sorted(gains, key=lambda p: (-gains[p], p))[:PAIRS])
    pair_tables = [np.zeros((len(coarse[a]) + 1, len(coarse[b]) + 1)) for a, b in pairs]
    for _ in range(ROUNDS // 4):
        for (a, b), table in zip(pairs, pair_tables, strict=True):
            g, h = slopes()
            step = RATE * _pair_tree(grid(a, b, g), grid(a, b, h))[0]
            table += step
            total += step[spots[a], spots[b]]
    return Model(intercept, edges, tuple(tables), pairs, coarse, tuple(pair_tables))


@F.arrow_udf(ArrayType(DoubleType()))
def _features(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in texts:
        yield pa.array([features(t.as_py()) for t in batch], pa.list_(pa.float64()))


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit on at most SAMPLE_ROWS labelled rows outside the held-out fold; only their features reach the driver.

    Of several labels of a document the smallest counts; rows without a label or id are not used.
    """
    labelled = (
        labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out("doc_id", FOLDS, FOLD))
        .groupBy("doc_id")
        .agg(F.min("quality").alias("label"))
    )
    known = bounded_sample(labelled, SAMPLE_ROWS, "doc_id")
    # At most SAMPLE_ROWS pairs of numbers are broadcast.
    rows = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").select(_features("text").alias("x"), "label")
    found = sorted((r["x"], r["label"]) for r in rows.collect())
    return fit(np.array([x for x, _ in found]).reshape(-1, len(FEATURES)), np.array([label for _, label in found], float))


def scorer(model: Model):
    def score(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            x = np.array([features(t.as_py()) for t in batch]).reshape(-1, len(FEATURES))
            yield pa.array(model.scores(x), pa.float64())

    return F.arrow_udf(score, DoubleType())


def accepted(score: Column) -> Column:
    return score >= THRESHOLD


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per row of docs: doc_id, held_out, score, predicted.

    Null and empty texts have features of zero and a score like any other. Without labels every score
    is one half. Other columns of docs and labels are not read.
    """
    score = scorer(train(docs, labels))
    scored = docs.select("doc_id", held_out("doc_id", FOLDS, FOLD).alias("held_out"), score("text").alias("score"))
    return scored.withColumn("predicted", accepted(F.col("score")).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs, all columns as they are, that are not rejected."""
    return docs.filter(accepted(scorer(train(docs, labels))("text")))
