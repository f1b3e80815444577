"""Embedding near-duplicates by an epsilon grid order join.

Unit vectors with cosine >= c lie within epsilon = sqrt(2 - 2c) of each other, also after a projection
onto orthonormal axes. The vectors of a label are sorted by their cells (side epsilon) on the leading
principal axes; the sorted sequence is cut into intervals, and each pair of intervals that may hold a
link is joined in a task of its own, recursively: halves whose bounding boxes are more than epsilon
apart are skipped, small pieces are compared by a matrix product in double precision.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltmart.llm.common import components, task_number
from voltmart.session import cut_lineage

COSINE = 0.93
AXES = 3  # leading principal axes of the grid
AXES_SAMPLE = 4096  # vectors the axes are fitted on; they steer the pruning, not the result
INTERVAL = 512  # vectors of an interval of the sorted sequence
LEAF = 128  # vectors compared at once inside a pair of intervals
SLACK = 1e-9  # rounding allowance of the distance bounds


def clean(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """Rows whose vector is not null and holds finite components only; the column as doubles."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf))
    as_double = F.col(column).cast("array<double>")
    return vectors.where(F.col(column).isNotNull() & F.forall(as_double, finite)).withColumn(
        column, as_double
    )


def principal_axes(vectors: DataFrame) -> dict[int, np.ndarray]:
    """Orthonormal leading axes per vector length, from the AXES_SAMPLE vectors of smallest id hash."""
    sample = (
        vectors.select("low", "vector")
        .orderBy(F.xxhash64("low"), "low", "vector")
        .limit(AXES_SAMPLE)
        .select("vector")
        .toPandas()["vector"]
    )
    axes: dict[int, np.ndarray] = {}
    for length in {len(v) for v in sample}:
        units = np.array([np.asarray(v, float) for v in sample if len(v) == length])
        units /= np.linalg.norm(units, axis=1, keepdims=True)
        _, _, rows = np.linalg.svd(units - units.mean(axis=0), full_matrices=False)
        axes[length] = rows[:AXES]
    return axes


def _units(values) -> np.ndarray:
    """Vectors of one length, scaled to length 1; first by their largest component, against overflow."""
    matrix = np.array([np.asarray(v, float) for v in values])
    matrix /= np.abs(matrix).max(axis=1, keepdims=True)
    return matrix / np.sqrt((matrix * matrix).sum(axis=1, keepdims=True))


def _project(units: np.ndarray, axes: dict[int, np.ndarray]) -> np.ndarray:
    """Coordinates on the axes of this length; without axes (an unsampled length) the first ones."""
    base = axes.get(units.shape[1])
    coords = units[:, :AXES] if base is None else units @ base.T
    return np.pad(coords, ((0, 0), (0, AXES - coords.shape[1])))


def _box_gap(low_a, high_a, low_b, high_b) -> float:
    gap = np.maximum(0, np.maximum(low_a - high_b, low_b - high_a))
    return float(np.sqrt((gap * gap).sum()))


class _Join:
    """The links between two intervals: weighted link counts, and a forest over the linked vectors."""

    def __init__(self, left: pd.Series, right: pd.Series, cosine: float, epsilon: float):
        self.cosine, self.epsilon, self.same = cosine, epsilon, left["block"] == right["block"]
        sides = [left] if self.same else [left, right]
        self.ids = np.concatenate([np.frombuffer(s["ids"], np.int64) for s in sides])
        self.weights = np.concatenate([np.frombuffer(s["weights"], np.int64) for s in sides])
        length = left["length"]
        self.units = np.concatenate([np.frombuffer(s["units"]).reshape(-1, length) for s in sides])
        self.coords = np.concatenate([np.frombuffer(s["coords"]).reshape(-1, AXES) for s in sides])
        self.count = np.zeros(len(self.ids), np.int64)
        self.parent = np.arange(len(self.ids))
        cut = len(np.frombuffer(left["ids"], np.int64))
        if self.same:
            self.within(0, cut)
        else:
            self.between(0, cut, cut, len(self.ids))

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def within(self, low: int, high: int) -> None:
        if high - low <= LEAF:
            self.leaf(low, high, low, high)
            return
        half = (low + high) // 2
        self.within(low, half)
        self.within(half, high)
        self.between(low, half, half, high)

    def between(self, a: int, b: int, c: int, d: int) -> None:
        one, two = self.coords[a:b], self.coords[c:d]
        far = _box_gap(one.min(axis=0), one.max(axis=0), two.min(axis=0), two.max(axis=0))
        if far > self.epsilon + SLACK:
            return
        if b - a <= LEAF and d - c <= LEAF:
            self.leaf(a, b, c, d)
        elif b - a >= d - c:
            half = (a + b) // 2
            self.between(a, half, c, d)
            self.between(half, b, c, d)
        else:
            half = (c + d) // 2
            self.between(a, b, c, half)
            self.between(a, b, half, d)

    def leaf(self, a: int, b: int, c: int, d: int) -> None:
        linked = self.units[a:b] @ self.units[c:d].T >= self.cosine
        if a == c:
            linked = np.triu(linked, 1)
        self.count[a:b] += linked @ self.weights[c:d]
        self.count[c:d] += linked.T @ self.weights[a:b]
        # Row by row, hook the trees of all columns found to the row's tree.
        for i in np.flatnonzero(linked.any(axis=1)):
            mine = self.root(a + int(i))
            for near in np.unique(self.parent[c + np.flatnonzero(linked[i])]):
                other = self.root(int(near))
                if other != mine:
                    self.parent[max(mine, other)] = min(mine, other)
                    mine = min(mine, other)

    def rows(self) -> pd.DataFrame:
        hit = np.flatnonzero(self.count)
        roots = np.array([self.root(int(i)) for i in hit], dtype=np.int64)
        return pd.DataFrame(
            {"id": self.ids[hit], "links": self.count[hit], "towards": self.ids[roots]}
        )


def near_vectors(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """(vec_id, embedding, label, ...) -> (vec_id, n_links, component_id, kept), one row per input row.

    Vectors of one label link if their cosine in double precision is at least `cosine`. Equal vectors of a
    label form one class with a multiplicity, and only classes are compared; classes linked to many are
    counted, their pairs are never written out. Null, empty or zero vectors, vectors holding null or
    non-finite components, and null labels link with nothing: they get n_links 0 and their own
    component. Vectors of different lengths do not link. Repeated rows are vectors of their own, also rows
    that repeat a vec_id under another label or with another vector: their classes have names of their own, so that
    neither links nor components of one reach the other. Rows without a vec_id link like others but are never a
    component's id; a component of such rows only has a null id, and all of them are kept. Other columns are not
    looked at.
    """
    rows = vectors.select("vec_id", "embedding", "label")
    usable = clean(rows).where(
        F.col("label").isNotNull() & F.exists("embedding", lambda x: x != 0.0)
    )
    # -0.0 and 0.0 are one value to grouping and to the cosine alike.
    classes = cut_lineage(
        usable.groupBy("label", F.col("embedding").alias("vector")).agg(
            F.min("vec_id").cast("long").alias("low"), F.count(F.lit(1)).alias("weight")
        ).withColumn("id", F.monotonically_increasing_id()),
        "classes",
    )
    pieces = _pair_results(classes, cosine)
    linked = pieces.groupBy("id").agg(F.sum("links").alias("links"))
    roots = components(pieces.select(F.col("id").alias("a"), F.col("towards").alias("b")))
    rooted = cut_lineage(
        classes.join(linked, "id", "left")
        .join(roots.withColumnRenamed("node", "id"), "id", "left")
        .select(
            "label",
            "vector",
            "low",
            (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("links"),
            F.coalesce("root", "id").alias("root"),
        ),
        "vector_classes",
    )
    smallest = rooted.groupBy("root").agg(F.min("low").alias("component"))
    known = rooted.join(smallest, "root").select("label", "vector", "links", "component")
    # Rows that cannot link find no class: their label or vector is null there.
    usable_id = usable.select("vec_id", "label", F.col("embedding").alias("vector"))
    found = usable_id.join(known, ["label", "vector"]).select("vec_id", "links", "component")
    bad = (
        rows.where(
            F.col("label").isNull()
            | F.col("embedding").isNull()
            | ~F.coalesce(
                F.forall(
                    F.col("embedding").cast("array<double>"),
                    lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)),
                ),
                F.lit(False),
            )
            | ~F.coalesce(
                F.exists(F.col("embedding").cast("array<double>"), lambda x: x != 0.0), F.lit(False)
            )
        )
        .select("vec_id", F.lit(0).cast("long").alias("links"), F.col("vec_id").alias("component"))
    )
    return found.unionByName(bad).select(
        "vec_id",
        F.col("links").cast("long").alias("n_links"),
        F.col("component").alias("component_id"),
        F.col("vec_id").eqNullSafe(F.col("component")).alias("kept"),
    )


def _pair_results(classes: DataFrame, cosine: float) -> DataFrame:
    """Classes (label, vector, low, id, weight) -> (id, links, towards): link counts and forest edges."""
    epsilon = math.sqrt(max(0.0, 2 - 2 * cosine))
    axes = principal_axes(classes)

    def coordinates(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            lengths = batch["vector"].map(len).to_numpy()
            out = []
            for length in np.unique(lengths):
                part = batch[lengths == length]
                cells = np.floor(_project(_units(part["vector"]), axes) / epsilon).astype(np.int64)
                out.append(
                    part.assign(length=int(length), **{f"c{i}": cells[:, i] for i in range(AXES)})
                )
            yield pd.concat(out)

    cells = ", ".join(f"c{i} long" for i in range(AXES))
    kind = classes.schema["label"].dataType.simpleString()
    order = ["label", "length", *(f"c{i}" for i in range(AXES)), "id"]
    sequence = (
        classes.select("label", "vector", "id", "weight").mapInPandas(
            coordinates, f"label {kind}, vector array<double>, id long, weight long, length int, {cells}"
        )
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
    )

    def intervals(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number, held = 0, None
        for batch in batches:
            held = batch if held is None else pd.concat([held, batch])
            while len(held):
                head = held.iloc[0]
                same = ((held["label"] == head["label"]) & (held["length"] == head["length"])).to_numpy()
                run = len(held) if same.all() else int(np.argmin(same))
                if run < INTERVAL and run == len(held):
                    break
                size = min(run, INTERVAL)
                yield _interval(held.iloc[:size], number, axes, epsilon)
                number += 1
                held = held.iloc[size:]
        if held is not None and len(held):
            yield _interval(held, number, axes, epsilon)

    blocks = cut_lineage(
        sequence.mapInPandas(
            intervals,
            f"block long, label {kind}, length int, low array<double>, high array<double>, "
            "first_cell long, last_cell long, ids binary, weights binary, units binary, coords binary",
        ),
        "intervals",
    )
    # Intervals are near if their cells on the first axis touch; their boxes decide the rest.
    spans = blocks.select("block", "label", "length", "low", "high", "first_cell", "last_cell")
    at = lambda name, last: spans.select(
        F.col("block").alias(name),
        "label",
        "length",
        F.col("low").alias(f"{name}_low"),
        F.col("high").alias(f"{name}_high"),
        F.explode(F.sequence(F.col("first_cell"), last)).alias("cell"),
    )
    gap = F.lit(0.0)
    for i in range(AXES):
        side = F.greatest(
            F.lit(0.0),
            F.col("one_low")[i] - F.col("two_high")[i],
            F.col("two_low")[i] - F.col("one_high")[i],
        )
        gap = gap + side * side
    pairs = cut_lineage(
        at("one", F.col("last_cell") + 1)
        .join(at("two", F.col("last_cell") + 1), ["label", "length", "cell"])
        .where((F.col("one") <= F.col("two")) & (gap <= (epsilon + SLACK) ** 2))
        .select("one", "two")
        .distinct(),
        "interval_pairs",
    )
    load = blocks.select("block", "length", "ids", "weights", "units", "coords")
    sides = pairs.join(load, F.col("one") == F.col("block")).unionByName(
        pairs.where("one <> two").join(load, F.col("two") == F.col("block"))
    )

    def joined(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("block")
        return _Join(frame.iloc[0], frame.iloc[-1], cosine, epsilon).rows()

    return cut_lineage(
        sides.groupBy("one", "two").applyInPandas(joined, "id long, links long, towards long"),
        "links",
    )


def _interval(rows: pd.DataFrame, number: int, axes, epsilon: float) -> pd.DataFrame:
    """One row for a run of the sorted sequence: its vectors, and the box they lie in."""
    units = _units(rows["vector"])
    coords = np.ascontiguousarray(_project(units, axes))
    low, high = coords.min(axis=0), coords.max(axis=0)
    cell = np.floor(np.array([low[0], high[0]]) / epsilon).astype(int)
    return pd.DataFrame(
        {
            "block": [(task_number() << 32) | number],
            "label": [rows["label"].iloc[0]],
            "length": [int(rows["length"].iloc[0])],
            "low": [low.tolist()],
            "high": [high.tolist()],
            "first_cell": [int(cell[0])],
            "last_cell": [int(cell[1])],
            "ids": [rows["id"].to_numpy(np.int64).tobytes()],
            "weights": [rows["weight"].to_numpy(np.int64).tobytes()],
            "units": [units.tobytes()],
            "coords": [coords.tobytes()],
        }
    )
