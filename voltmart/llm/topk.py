"""Exact top-k search by inner product, with MaxScore over dimension postings.

Candidates are dealt to shards, which lie in the tasks that read them: no candidate is shuffled. Queries
are searched in blocks of a bounded size; a block is handed to all tasks, each of which goes through its
shards and carries every query's k best along, so that the score to beat rises from shard to shard. The tasks'
lists are merged per query.

In a shard a query's terms are the dimensions. A dimension adds between its least and its largest product
over the shard; the difference is its bound. The terms of smallest bounds which together cannot lift a
candidate over the score to beat are non-essential. Essential postings, sorted by product, are traversed down to the
product that at least one essential term of any competitive candidate must reach; the candidates met are scored on all
essential terms, and the non-essential ones are probed while score and remaining bounds still compete. Queries whose
postings would be traversed nearly whole share the pass over the shard: a group of them is scored by one matrix product.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voltmart.llm.common import returns_memory, task_number
from voltmart.llm.vectors import clean
from voltmart.session import cut_lineage

TOP = 20
SCALE = 64
SHARD = 4096  # candidates of a shard
BLOCK = 4096  # queries searched together; they pass through the driver
GROUP = 256  # queries that share a pass over a shard
STEP = 8  # dimensions probed before candidates are looked through again
FEW = 8  # probed one by one where less than one in so many candidates is left, else for all of them at once
EXACT = 2.0**52  # sums of absolute products up to here are exact in double precision


def _quantise(vector) -> np.ndarray:
    return np.floor(SCALE * np.asarray(vector, float))


def _blocks(vectors: DataFrame, size: int) -> DataFrame:
    """(vec_id, embedding) -> rows of up to `size` vectors of equal length."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number, held = 0, {}

        def flush(length: int) -> pd.DataFrame:
            nonlocal number
            ids, rows = held.pop(length)
            number += 1
            return pd.DataFrame(
                {
                    "block": [(task_number() << 32) | number],
                    "length": [length],
                    "ids": [np.array(ids, np.int64).tobytes()],
                    "rows": [np.array(rows).reshape(len(ids), length).tobytes()],
                }
            )

        for batch in batches:
            for key, vector in zip(batch["vec_id"], batch["embedding"]):
                ids, rows = held.setdefault(len(vector), ([], []))
                ids.append(key)
                rows.append(_quantise(vector))
                if len(ids) == size:
                    yield flush(len(vector))
        for length in list(held):
            yield flush(length)

    return cut_lineage(
        vectors.select("vec_id", "embedding").mapInPandas(
            run, "block long, length int, ids binary, rows binary"
        ),
        "blocks",
    )


class Shard:
    """Candidates by dimension: their values, the range of each dimension, and its posting in order of value."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        self.ids, self.columns = ids, np.ascontiguousarray(rows.T)
        self.low, self.high = rows.min(axis=0), rows.max(axis=0)
        self.postings = np.argsort(self.columns, axis=1, kind="stable")
        self.sorted = np.take_along_axis(self.columns, self.postings, 1)

    def reaching(self, dim: int, weight: float, least: float) -> np.ndarray:
        """The candidates whose product with a query's component in a dimension is `least` or more: the end
        of the posting where products are largest."""
        if weight > 0:
            return self.postings[dim, np.searchsorted(self.sorted[dim], least / weight - SLACK) :]
        return self.postings[dim, : np.searchsorted(self.sorted[dim], least / weight + SLACK, "right")]


SLACK = 1e-6  # values are whole numbers: a quotient may be this far off


def max_score(query: np.ndarray, own: int, shard: Shard, k: int, floor: float) -> tuple[np.ndarray, np.ndarray]:
    """Candidates of a shard (places) with their scores: all that may be among the k best of a query, equal scores
    included, given a score to beat. Rows with the query's own id are left out."""
    others = shard.ids != own
    width = min(len(query), len(shard.columns))
    query, columns = query[:width], shard.columns[:width]
    ends = np.stack([query * shard.low[:width], query * shard.high[:width]])
    if np.abs(ends).max(axis=0).sum() > EXACT:  # beyond exact doubles: whole products in integers
        alive = np.flatnonzero(others)
        exact = [sum(int(a) * int(b) for a, b in zip(query, columns[:, i])) for i in alive]
        return alive, np.array(exact, dtype=object)
    least, gain = ends.min(axis=0), ends.max(axis=0) - ends.min(axis=0)
    base, order = least.sum(), np.argsort(-gain, kind="stable")
    if base + gain.sum() < floor:
        return np.zeros(0, np.int64), np.zeros(0)  # no candidate of the shard can compete
    if floor == -np.inf:  # nothing to beat yet: the best of the longest postings set a score
        seeds = np.unique(np.concatenate([
            shard.postings[d, -2 * k :] if query[d] > 0 else shard.postings[d, : 2 * k] for d in order[:4]
        ]))
        seeds = seeds[others[seeds]]
        if len(seeds) >= k:
            floor = np.partition(query @ columns[:, seeds], len(seeds) - k)[len(seeds) - k]
    # Non-essential: the longest tail of small bounds that stays below the score to beat by itself.
    tail = np.append(np.cumsum(gain[order][::-1])[::-1], 0.0)  # what the terms from a place on can add
    essential = int(np.argmax(base + tail < floor)) if floor > -np.inf and base + tail[-1] < floor else len(order)
    need = floor - base - tail[essential]  # what essential terms have to add
    terms = order[:essential]
    whole = gain[terms].sum()
    if essential and need > 0 and whole > 0:
        met = np.zeros(len(shard.ids), bool)
        for d in terms:
            if gain[d] > 0:
                # Were every essential term below its share of the need, their sum would be too.
                met[shard.reaching(d, query[d], least[d] + need * gain[d] / whole)] = True
                if 2 * met.sum() > len(met):  # dense: scoring all costs less than traversing on
                    met[:] = True
                    break
        alive = np.flatnonzero(met & others)
    else:
        alive = np.flatnonzero(others)
    part = columns[terms] if len(alive) == len(shard.ids) else columns[np.ix_(terms, alive)]
    # Terms not scored yet count at their least: scores so far are lower bounds.
    scores = query[terms] @ part + (base - least[terms].sum())
    for at in range(essential, len(order) + STEP, STEP):
        bar = floor
        if len(alive) > k:
            bar = max(bar, np.partition(scores, len(scores) - k)[len(scores) - k])
        near = scores + tail[min(at, len(order))] >= bar
        alive, scores = alive[near], scores[near]
        dims = order[at : at + STEP]
        if not len(dims):
            break
        scores = scores + query[dims] @ columns[np.ix_(dims, alive)] - least[dims].sum()
    return alive, scores


def _bounds(queries: np.ndarray, shard: Shard, floors: np.ndarray):
    """What max_score finds out before it looks at candidates, for queries over the shard's dimensions: the terms' least
    products and gains, the terms by falling gain, what those from a place on can add, and how many are essential."""
    ends = np.stack([queries * shard.low[: queries.shape[1]], queries * shard.high[: queries.shape[1]]])
    least, gain = ends.min(axis=0), ends.max(axis=0) - ends.min(axis=0)
    order = np.argsort(-gain, axis=1, kind="stable")
    falling = np.take_along_axis(gain, order, 1)
    tail = np.pad(np.cumsum(falling[:, ::-1], axis=1)[:, ::-1], ((0, 0), (0, 1)))
    below = least.sum(axis=1)[:, None] + tail < floors[:, None]
    essential = np.where(below.any(axis=1), below.argmax(axis=1), queries.shape[1])
    return least, gain, order, tail, essential, np.abs(ends).max(axis=0).sum(axis=1)


def _reached(queries: np.ndarray, shard: Shard, least: np.ndarray) -> np.ndarray:
    """The lengths of the postings that `reaching` would return for each query and dimension."""
    found = np.zeros(queries.shape, np.int64)
    for d in range(queries.shape[1]):
        weight, values = queries[:, d], shard.sorted[d]
        for side in (weight > 0, weight < 0):
            at = least[side, d] / weight[side]
            found[side, d] = (
                len(values) - np.searchsorted(values, at - SLACK)
                if len(at) and weight[side][0] > 0
                else np.searchsorted(values, at + SLACK, "right")
            )
    return found


def max_scores(
    queries: np.ndarray, owns: np.ndarray, shard: Shard, k: int, floors: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """max_score for a group of queries of one length: (places of queries, places of candidates, scores as long)."""
    width = min(queries.shape[1], len(shard.columns))
    whole, queries, columns = queries, queries[:, :width], shard.columns[:width]
    least, gain, order, tail, essential, largest = _bounds(queries, shard, floors)
    base = least.sum(axis=1)
    exact = largest <= EXACT
    competes = ~(base + gain.sum(axis=1) < floors) | ~exact
    places = np.arange(width)
    inside = np.zeros(queries.shape, bool)  # the essential terms
    np.put_along_axis(inside, order, places < essential[:, None], 1)
    # Queries that traverse short postings, and those beyond exact doubles, go through the shard by themselves.
    need = floors - base - np.take_along_axis(tail, essential[:, None], 1)[:, 0]
    total = np.where(inside, gain, 0.0).sum(axis=1)
    alone = competes & ~exact
    short = np.flatnonzero(competes & exact & (essential > 0) & (need > 0) & (total > 0) & (floors > -np.inf))
    if len(short):
        share = least[short] + (need[short] / total[short])[:, None] * gain[short]
        posted = _reached(queries[short], shard, share)
        met = np.where(inside[short] & (gain[short] > 0), posted, 0).sum(axis=1)
        alone[short] = met * FEW <= len(shard.ids)
    rows, cols, found = [], [], []
    for at in np.flatnonzero(alone):
        alive, values = max_score(whole[at], owns[at], shard, k, floors[at])
        rows.append(np.full(len(alive), at))
        cols.append(alive)
        found.append(np.array([int(v) for v in values], np.int64))
    at = np.flatnonzero(competes & ~alone)
    if len(at):
        asked, inside, bar = queries[at], inside[at], floors[at]
        # Terms not scored yet count at their least: scores so far are lower bounds.
        scores = np.where(inside, asked, 0.0) @ columns + np.where(inside, 0.0, least[at]).sum(axis=1)[:, None]
        mine = shard.ids == owns[at][:, None]
        scores[mine] = -np.inf
        rest = np.take_along_axis(tail[at], essential[at][:, None], 1)
        near = (scores + rest >= bar[:, None]) & ~mine
        dense = near.sum(axis=1) * FEW > len(shard.ids)
        dense &= essential[at] < width
        if dense.any():  # probing all costs less than picking out the many
            scores[dense] += np.where(inside[dense], 0.0, asked[dense]) @ columns
            scores[dense] -= np.where(inside[dense], 0.0, least[at][dense]).sum(axis=1)[:, None]
            rest[dense] = 0.0
            near[dense] = (scores[dense] >= bar[dense][:, None]) & ~mine[dense]
        many = near.sum(axis=1) > 4 * k
        if many.any():
            kth = np.partition(scores[many], len(shard.ids) - k, axis=1)[:, len(shard.ids) - k]
            bar[many] = np.maximum(bar[many], kth)
            near[many] &= scores[many] + rest[many] >= bar[many][:, None]
        row, col = np.nonzero(near)
        done, ready = np.where(dense, width, essential[at]), scores[row, col]
        while len(row) and (done[row] < width).any():  # the non-essential terms of what is left
            place = done[row][:, None] + np.arange(STEP)
            dims = np.take_along_axis(order[at][row], np.minimum(place, width - 1), 1)
            more = asked[row[:, None], dims] * columns[dims, col[:, None]] - least[at][row[:, None], dims]
            ready = ready + np.where(place < width, more, 0.0).sum(axis=1)
            done = np.minimum(done + STEP, width)
            left = ready + tail[at][row, done[row]] >= bar[row]
            row, col, ready = row[left], col[left], ready[left]
        rows.append(at[row])
        cols.append(col)
        found.append(ready.astype(np.int64))
    none = [np.zeros(0, np.int64)]
    return tuple(np.concatenate(parts + none) for parts in (rows, cols, found))


def _asked(queries: DataFrame, blocks: int, block: int) -> list[tuple[int, np.ndarray]]:
    """The queries of one block: (vec_id, whole components)."""
    mine = queries.where(F.expr(f"pmod(xxhash64(vec_id), {blocks}L)") == block)
    found = mine.select("vec_id", "embedding").orderBy("vec_id").collect()
    return [(row.vec_id, _quantise(row.embedding)) for row in found]


def _groups(wanted: list[tuple[int, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(vec_ids, components) of up to GROUP queries of equal length."""
    by_length: dict[int, list] = {}
    for own, query in wanted:
        by_length.setdefault(len(query), []).append((own, query))
    for length, found in by_length.items():
        for at in range(0, len(found), GROUP):
            owns, rows = zip(*found[at : at + GROUP])
            yield np.array(owns, np.int64), np.array(rows).reshape(len(rows), length)


def _rank(groups: np.ndarray) -> np.ndarray:
    """The place of each entry within its run of equal ones."""
    return np.arange(len(groups)) - np.searchsorted(groups, groups)


def _merge(of: np.ndarray, scores: np.ndarray, keys: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best of each query, in order; equal scores by the smaller vec_id."""
    order = np.lexsort((keys, -scores, of))
    order = order[_rank(of[order]) < k]
    return of[order], scores[order], keys[order]


def top_products(candidates: DataFrame, queries: DataFrame, k: int = TOP, block: int = BLOCK) -> DataFrame:
    """Both (vec_id whole number, embedding, ...) -> (query_id, rank, vec_id, score): each query's k best candidates.

    Components x become floor(64 * x); the score is the integer inner product, which has to fit a long.
    Rows with the query's vec_id are not its candidates. Ties go to the smaller vec_id. Vectors that are
    null or hold null or non-finite components take no part, nor do rows without a vec_id, which could
    not be named. A candidate of another length than the query is compared over the shorter length (the missing components
    count as zero). Candidates that repeat a vec_id are ranked one by one; of queries that repeat a vec_id
    one row is taken (the smallest vector). Queries are searched in blocks of about `block`, each of which reads
    the shards once.
    """
    named = lambda df: clean(df).where(F.col("vec_id").isNotNull()).select(
        F.col("vec_id").cast("long").alias("vec_id"), "embedding"
    )
    shards = _blocks(named(candidates), SHARD)
    asked = cut_lineage(named(queries).groupBy("vec_id").agg(F.min("embedding").alias("embedding")), "queries")
    blocks = max(1, -(-asked.count() // block))
    found = None
    for number in range(blocks):
        wanted = _asked(asked, blocks, number)

        def run(batches: Iterator[pa.RecordBatch], wanted=wanted) -> Iterator[pa.RecordBatch]:
            groups = list(_groups(wanted))
            none = np.zeros(0, np.int64)
            best = [(none, none, none)] * len(groups)  # places of queries, scores, vec_ids: sorted, k of each at most
            for batch in batches:
                for place in range(batch.num_rows):
                    ids = np.frombuffer(batch.column("ids")[place].as_py(), np.int64)
                    length = batch.column("length")[place].as_py()
                    shard = Shard(ids, np.frombuffer(batch.column("rows")[place].as_py()).reshape(len(ids), length))
                    for at, (owns, rows) in enumerate(groups):
                        of, scores, keys = best[at]
                        floors = np.full(len(owns), -np.inf)
                        last = np.flatnonzero(_rank(of) == k - 1)
                        floors[of[last]] = scores[last]
                        query, alive, values = max_scores(rows, owns, shard, k, floors)
                        if len(query):
                            best[at] = _merge(
                                np.append(of, query), np.append(scores, values), np.append(keys, ids[alive]), k
                            )
            for (owns, _), (of, scores, keys) in zip(groups, best):
                if len(of):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(owns[of]), pa.array(keys), pa.array(scores)],
                        names=["query_id", "vec_id", "score"],
                    )

        hits = shards.select("length", "ids", "rows").mapInArrow(
            returns_memory(run), "query_id long, vec_id long, score long"
        )
        found = hits if found is None else found.unionByName(hits)
    place = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(place))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
