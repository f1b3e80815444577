"""The quality classifier's fit against a plain, slow version of it, and its accuracy on held-out labels."""

import math
import zlib

import numpy as np
import pandas as pd
import pytest

from voltmart.llm import quality


def best_tree(groups, depth):
    """The value of every bin of a regression tree: groups are lists of (gradient, curve) per bin."""
    total_g = math.fsum(g for bin_ in groups for g, _ in bin_)
    total_h = math.fsum(h for bin_ in groups for _, h in bin_)
    leaf = [total_g / (total_h + quality.SMOOTH)] * len(groups)
    if depth == 0 or len(groups) < 2:
        return leaf
    best, cut = total_g**2 / (total_h + quality.SMOOTH) + 1e-12, None
    for at in range(1, len(groups)):
        gain = 0.0
        for side in (groups[:at], groups[at:]):
            g = math.fsum(x for bin_ in side for x, _ in bin_)
            h = math.fsum(x for bin_ in side for _, x in bin_)
            gain += g**2 / (h + quality.SMOOTH)
        if gain > best * (1 + 1e-13):
            best, cut = gain, at
    return leaf if cut is None else best_tree(groups[:cut], depth - 1) + best_tree(groups[cut:], depth - 1)


def best_pair_tree(grid):
    """grid[a][b]: list of (gradient, curve). A split of one feature, each half split by the other."""
    best, table = -1.0, None
    for turned in (False, True):
        cells = [list(row) for row in zip(*grid)] if turned else grid
        for at in range(1, len(cells)):
            rows = []
            for half in (cells[:at], cells[at:]):
                columns = [[x for row in half for x in row[b]] for b in range(len(cells[0]))]
                rows += [best_tree(columns, 1)] * len(half)
            gain = math.fsum(rows[a][b] * g for a in range(len(cells)) for b in range(len(cells[0])) for g, _ in cells[a][b])
            if gain > best + 1e-12:
                best, table = gain, [list(row) for row in zip(*rows)] if turned else rows
    return table, best


def plain_fit(rows, labels):
    """Cyclic boosting row by row; returns the scores of the rows it learned from, and its pairs."""
    good = sum(labels)
    odds = [math.log((good + 1) / (len(labels) - good + 1))] * len(rows)
    number = len(rows[0])
    place = lambda cuts, x: sum(x >= c for c in cuts)
    cuts = [quality._cuts(np.array([r[i] for r in rows]), quality.BINS) for i in range(number)]
    coarse = [quality._cuts(np.array([r[i] for r in rows]), quality.PAIR_BINS) for i in range(number)]
    bins = [[place(cuts[i], r[i]) for i in range(number)] for r in rows]
    cells = [[place(coarse[i], r[i]) for i in range(number)] for r in rows]

    def pulls():
        chances = [1 / (1 + math.exp(-o)) for o in odds]
        return [(y - p, p * (1 - p)) for y, p in zip(labels, chances)]

    for _ in range(quality.ROUNDS):
        for i in range(number):
            groups = [[] for _ in range(len(cuts[i]) + 1)]
            for b, pull in zip(bins, pulls()):
                groups[b[i]].append(pull)
            values = best_tree(groups, 2)
            odds = [o + quality.RATE * values[b[i]] for o, b in zip(odds, bins)]

    def grid(i, j):
        found = [[[] for _ in range(len(coarse[j]) + 1)] for _ in range(len(coarse[i]) + 1)]
        for c, pull in zip(cells, pulls()):
            found[c[i]][c[j]].append(pull)
        return found

    gains = {(i, j): best_pair_tree(grid(i, j))[1] for i in range(number) for j in range(i + 1, number)}
    pairs = sorted(gains, key=lambda p: (-gains[p], p))[: quality.PAIRS]
    for _ in range(quality.PAIR_ROUNDS):
        for i, j in pairs:
            table = best_pair_tree(grid(i, j))[0] or [[0.0] * (len(coarse[j]) + 1)] * (len(coarse[i]) + 1)
            odds = [o + quality.RATE * table[c[i]][c[j]] for o, c in zip(odds, cells)]
    return [1 / (1 + math.exp(-o)) for o in odds], pairs


@pytest.mark.parametrize("seed", [1, 2])
def test_fit_equals_the_plain_version(monkeypatch, seed):
    monkeypatch.setattr(quality, "ROUNDS", 12)
    monkeypatch.setattr(quality, "PAIR_ROUNDS", 6)
    monkeypatch.setattr(quality, "PAIRS", 2)
    monkeypatch.setattr(quality, "BINS", 8)
    monkeypatch.setattr(quality, "PAIR_BINS", 4)
    rng = np.random.default_rng(seed)
    rows = np.column_stack([rng.normal(size=150), rng.normal(size=150), rng.integers(0, 3, 150), np.zeros(150)]).round(3)
    # One feature by itself, two only together: the pair has to be found.
    odds = 1.5 * rows[:, 0] + 3 * ((rows[:, 1] > 0) ^ (rows[:, 2] > 0)) - 1.5
    labels = (rng.random(150) < 1 / (1 + np.exp(-odds))).astype(float)
    model = quality.fit(rows, labels)
    expected, pairs = plain_fit(rows.tolist(), labels.tolist())
    assert model.pairs == pairs and (1, 2) in pairs
    assert model.score(rows) == pytest.approx(expected, abs=1e-9)


def test_held_out_accuracy_on_given_labels():
    docs = pd.read_parquet("/root/testdata/sf0.01/documents.parquet")
    labels = pd.read_parquet("/root/testdata/sf0.01/labels.parquet").dropna(subset=["quality"])
    both = docs.merge(labels[["doc_id", "quality"]], on="doc_id")
    out = both["doc_id"].map(lambda i: zlib.crc32(str(i).encode()) % quality.FOLDS == quality.HELD_FOLD).to_numpy(bool)
    rows = np.array([quality.features(t or "") for t in both["text"]])
    y = both["quality"].to_numpy(float)
    model = quality.fit(rows[~out], y[~out])
    said = model.score(rows[out]) >= quality.ACCEPT
    right = (said == (y[out] == 1)).mean()
    majority = max(y[out].mean(), 1 - y[out].mean())
    assert out.sum() > 60 and right >= 0.96 and right > majority + 0.1
