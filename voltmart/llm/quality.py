"""Quality scores by a generalised additive model with pairwise interactions.

Each feature of a text has a lookup table over its bins, and a few pairs of features have a table over
both. The tables are learned by cyclic boosting: feature after feature, round after round, a shallow tree
on that feature alone is fitted to the current residuals and added to its table; then the same for the
pairs whose residuals a tree on two features explains best. A score is a sum of table entries.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS, HELD_FOLD = 4, 2
SAMPLE = 20_000  # labelled rows the tables are learned from: those of smallest id hash
BINS = 32  # bins of a feature
PAIR_BINS = 8  # bins of a feature in a pair
PAIRS = 6  # interactions
ROUNDS, PAIR_ROUNDS, RATE = 120, 60, 0.1
SMOOTH = 2.0  # added to the curvature of a leaf
ACCEPT = 0.7  # scores from here on are predicted 1

FEATURES = [
    "log_bytes", "log_words", "log_lines", "mean_word", "long_words", "short_words", "upper", "digits",
    "marks", "spaces", "newlines", "beyond_ascii", "control", "distinct_words", "top_word", "repeats",
    "same_lines", "shouted", "marked_ends", "lone_marks", "letterless", "sentences", "top_byte",
]

_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = np.zeros(256, bool)
_LETTER[97:123] = _LETTER[65:91] = _LETTER[128:] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_CONTROL = np.zeros(256, bool)
_CONTROL[:9] = _CONTROL[14:32] = True
_CONTROL[127] = True
_MARK = ~(_LETTER | _DIGIT | _SPACE | _CONTROL)
_PLAIN_ENDS = frozenset(b".,;:?!\"')]}")


def features(text: str) -> list[float]:
    """The features of one whole text, in the order of FEATURES; an empty text has zeros."""
    raw = text.encode()
    if not raw:
        return [0.0] * len(FEATURES)
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    size = len(raw)
    words = text.split()
    n = max(1, len(words))
    kinds = Counter(words)
    lines = [line for line in text.split("\n") if line.strip()]
    lengths = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1, np.int64)
    shouted = sum(c for w, c in kinds.items() if len(w) > 1 and w.isupper())
    odd_end = lone = letterless = 0
    for word, count in kinds.items():
        if not word[-1].isalnum():
            if ord(word[-1]) not in _PLAIN_ENDS or not word[-2:-1].isalnum() and len(word) > 1:
                odd_end += count
            if len(word) == 1:
                lone += count
        if not any(map(str.isalpha, word)):
            letterless += count
    repeats = sum(map(str.__eq__, words, words[1:]))
    ends = raw.count(b".") + raw.count(b"?") + raw.count(b"!")
    share = lambda mask: float(counts[mask].sum()) / size
    return [
        math.log1p(size), math.log1p(len(words)), math.log1p(len(lines)), float(lengths.mean()),
        float((lengths > 12).mean()), float((lengths <= 3).mean()), share(_UPPER), share(_DIGIT),
        share(_MARK), share(_SPACE), counts[10] / size, float(counts[128:].sum()) / size,
        share(_CONTROL), len(kinds) / n, max(kinds.values(), default=0) / n, repeats / n,
        1 - len(set(lines)) / max(1, len(lines)), shouted / n, odd_end / n, lone / n, letterless / n,
        ends / n, float(counts.max()) / size,
    ]


# ---- the model -----------------------------------------------------------------------------------


def _cuts(values: np.ndarray, bins: int) -> np.ndarray:
    """Distinct quantiles that part the values into at most `bins` bins."""
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1]))


def _tree(gradient: np.ndarray, curve: np.ndarray, depth: int) -> np.ndarray:
    """A regression tree over ordered bins; the value of each bin."""
    whole = gradient.sum() / (curve.sum() + SMOOTH)
    if depth == 0 or len(gradient) < 2:
        return np.full(len(gradient), whole)
    g, h = np.cumsum(gradient)[:-1], np.cumsum(curve)[:-1]
    gain = g**2 / (h + SMOOTH) + (gradient.sum() - g) ** 2 / (curve.sum() - h + SMOOTH)
    at = int(np.argmax(gain)) + 1
    if gain[at - 1] <= gradient.sum() ** 2 / (curve.sum() + SMOOTH) + 1e-12:
        return np.full(len(gradient), whole)
    return np.concatenate(
        [_tree(gradient[:at], curve[:at], depth - 1), _tree(gradient[at:], curve[at:], depth - 1)]
    )


def _pair_tree(gradient: np.ndarray, curve: np.ndarray) -> tuple[np.ndarray, float]:
    """A tree over a grid of bins that splits one feature and then each half by the other; its gain."""
    best, table = -1.0, np.zeros_like(gradient)
    for turned in (False, True):
        g, h = (gradient.T, curve.T) if turned else (gradient, curve)
        for at in range(1, len(g)):
            found = np.concatenate(
                [
                    np.broadcast_to(_tree(part_g.sum(axis=0), part_h.sum(axis=0), 1), part_g.shape)
                    for part_g, part_h in ((g[:at], h[:at]), (g[at:], h[at:]))
                ]
            )
            gain = float((found * g).sum())
            if gain > best + 1e-12:
                best, table = gain, found.T if turned else found
    return table, best


@dataclass
class Model:
    """Log odds: an intercept, a table per feature and a table per pair."""

    intercept: float = 0.0
    cuts: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_cuts: list[np.ndarray] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Probability of label 1 for rows of features: bins, table entries, a sum."""
        odds = np.full(len(rows), self.intercept)
        for i, (cuts, table) in enumerate(zip(self.cuts, self.tables)):
            odds += table[np.searchsorted(cuts, rows[:, i], "right")]
        for (i, j), table in zip(self.pairs, self.pair_tables):
            odds += table[
                np.searchsorted(self.pair_cuts[i], rows[:, i], "right"),
                np.searchsorted(self.pair_cuts[j], rows[:, j], "right"),
            ]
        return 1 / (1 + np.exp(-odds))


def fit(rows: np.ndarray, labels: np.ndarray) -> Model:
    """Learn the tables. No rows: every score is 1, so that nothing is rejected without evidence. Labels
    all alike: the intercept alone, from a count smoothed by one."""
    if not len(rows):
        return Model(intercept=math.inf)
    good = float(labels.sum())
    model = Model(intercept=math.log((good + 1) / (len(labels) - good + 1)))
    if good in (0, len(labels)):
        return model
    number = rows.shape[1]
    model.cuts = [_cuts(rows[:, i], BINS) for i in range(number)]
    model.pair_cuts = [_cuts(rows[:, i], PAIR_BINS) for i in range(number)]
    bins = [np.searchsorted(model.cuts[i], rows[:, i], "right") for i in range(number)]
    coarse = [np.searchsorted(model.pair_cuts[i], rows[:, i], "right") for i in range(number)]
    model.tables = [np.zeros(len(c) + 1) for c in model.cuts]
    odds = np.full(len(rows), model.intercept)

    def sums(at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        chance = 1 / (1 + np.exp(-odds))
        return (
            np.bincount(at, labels - chance, size),
            np.bincount(at, chance * (1 - chance), size),
        )

    for _ in range(ROUNDS):
        for i in range(number):
            step = RATE * _tree(*sums(bins[i], len(model.tables[i])), 2)
            model.tables[i] += step
            odds += step[bins[i]]

    def grid(i: int, j: int):
        shape = (len(model.pair_cuts[i]) + 1, len(model.pair_cuts[j]) + 1)
        at = coarse[i] * shape[1] + coarse[j]
        return at, shape, [x.reshape(shape) for x in sums(at, shape[0] * shape[1])]

    gains = {
        (i, j): _pair_tree(*grid(i, j)[2])[1] for i in range(number) for j in range(i + 1, number)
    }
    model.pairs = sorted(gains, key=lambda pair: (-gains[pair], pair))[:PAIRS]
    model.pair_tables = [np.zeros(grid(*pair)[1]) for pair in model.pairs]
    for _ in range(PAIR_ROUNDS):
        for number, (i, j) in enumerate(model.pairs):
            at, _, both = grid(i, j)
            step = RATE * _pair_tree(*both)[0]
            model.pair_tables[number] += step
            odds += step.reshape(-1)[at]
    return model


# ---- on Spark ------------------------------------------------------------------------------------


def fold(key: Column) -> Column:
    return F.crc32(key.cast("string")) % FOLDS


def learn(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit on labelled documents outside the held-out fold: a bounded sample, the SAMPLE ids of smallest
    hash. Null labels and ids are not learned from; of several labels of an id the smallest one counts."""
    known = (
        labels.where("quality is not null and doc_id is not null")
        .where(fold(F.col("doc_id")) != HELD_FOLD)
        .groupBy("doc_id")
        .agg(F.min(F.col("quality").cast("double")).alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(SAMPLE)
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = pd.DataFrame([features(t or "") for t in batch["text"]], columns=FEATURES)
            yield out.assign(
                at=batch["at"].to_numpy(), quality=batch["quality"].to_numpy()
            )

    # At most SAMPLE rows by the limit above: a bounded broadcast, and a bounded result.
    chosen = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")
    found = (
        chosen.select("text", "quality", F.xxhash64("doc_id", "text").alias("at"))
        .mapInPandas(run, ", ".join(f"{f} double" for f in FEATURES) + ", at long, quality double")
        .orderBy("at")
        .limit(2 * SAMPLE)  # ids that repeat in docs
        .toPandas()
    )
    return fit(found[FEATURES].to_numpy(float), (found["quality"].to_numpy() > 0.5).astype(float))


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """All columns of docs and `quality_score`, from the whole text; null texts count as empty. A column
    of that name is replaced. The rows are not moved."""
    names = docs.columns
    at = next(i for i, f in enumerate(names) if f == "text")

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            if not len(texts):
                yield pd.Series([], dtype=float)
                continue
            rows = np.array([features(t or "") for t in texts])
            yield pd.Series(model.score(rows))

    scored = F.pandas_udf(run, "double")
    return docs.withColumn("quality_score", scored(F.col(names[at])))


def score_table(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, text, ...) -> (doc_id, held_out, score, predicted), learning from labels (doc_id,
    quality, ...). held_out: the document's crc32(doc_id as text) mod 4 is 2 (null ids are not); its label
    is never looked at. Empty and null texts are scored like any other, an empty table gives no rows, rows
    that repeat a doc_id are scored one by one. Other columns are no inputs."""
    scored = score_documents(docs.select("doc_id", "text"), learn(docs, labels))
    return scored.select(
        "doc_id",
        F.coalesce(fold(F.col("doc_id")) == HELD_FOLD, F.lit(False)).alias("held_out"),
        F.col("quality_score").alias("score"),
        (F.col("quality_score") >= ACCEPT).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents predicted 1, with the columns of docs."""
    scored = score_documents(docs, learn(docs, labels))
    return scored.where(F.col("quality_score") >= ACCEPT).select(*docs.columns)
