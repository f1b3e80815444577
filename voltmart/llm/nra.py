"""Ranked lexical search by NRA: sequential reads of impact-sorted lists, no look-ups by document.

The index is a table of chunks, each a bounded number of documents with their postings grouped by term;
every task writes the chunks of its own documents, so postings are never shuffled. A search reads the
chunks once per block of queries. Within a chunk the lists of the block's terms are sorted by impact and
read from the top, deeper in each round. A document's score lies between the impacts read for it (lower)
and these plus the next impact of every list where it was not seen yet (upper); a list whose next impact is below
the least that the document's length allows cannot hold it any more. A query is done with a chunk when
no unseen document and no loser can reach the k-th score, equal scores included, and lower and upper agree for all that
remain. Its k best go with the task from chunk to chunk and raise the score to beat; the bests of all tasks are merged.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voltmart.llm.common import returns_memory
from voltmart.session import cut_lineage

TOP = 50
FIRST_DEPTH = 256  # postings of every list read in the first round
PIECE = 1 << 20  # bytes of a text split into words at once
PENDING = 1 << 18  # words counted at once
CHUNK_POSTINGS = 1 << 20
CHUNK_DOCS = 1 << 16
BLOCK_TERMS = 100_000  # terms of the queries searched together; they pass through the driver

# Bytes of a term as they are, A-Z in lower case, every other byte of ASCII a space.
TERM_BYTES = bytes(
    b | 32 if 65 <= b <= 90 else b if b > 127 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)

INDEX = (
    "doc_ids array<bigint>, lengths binary, terms array<string>, dfs array<int>, posting_docs binary, "
    "posting_tfs binary, n_docs bigint, n_terms bigint"
)


def terms(text: str | None) -> Iterator[list[bytes]]:
    """The terms of a text in order, a bounded number at a time."""
    body = (text or "").encode(errors="replace").translate(TERM_BYTES)
    start = 0
    while start < len(body):
        end = body.find(b" ", start + PIECE)
        end = len(body) if end < 0 else end
        yield body[start:end].split()
        start = end


class Chunk:
    """Documents on their way into one row of the index."""

    def __init__(self):
        self.ids: list[int | None] = []
        self.lengths: list[int] = []
        self.vocabulary: dict[bytes, int] = {}
        self.words: list[np.ndarray] = []
        self.pending = 0
        self.counted: list[tuple[np.ndarray, np.ndarray]] = []
        self.postings = 0

    def add(self, doc_id: int | None, text: str | None) -> None:
        number, length, ids = len(self.ids), 0, self.vocabulary
        for part in terms(text):
            if not part:
                continue
            found = np.fromiter((ids.setdefault(w, len(ids)) for w in part), np.int64, len(part))
            self.words.append(found << 20 | number)
            length += len(part)
            self.pending += len(part)
            if self.pending >= PENDING:
                self._count()
        if length:
            self.ids.append(doc_id)
            self.lengths.append(length)

    def _count(self) -> None:
        keys, counts = np.unique(np.concatenate(self.words), return_counts=True)
        self.counted.append((keys, counts))
        self.postings += len(keys)
        self.words, self.pending = [], 0

    def full(self) -> bool:
        return self.postings >= CHUNK_POSTINGS or len(self.ids) >= CHUNK_DOCS

    def row(self) -> pa.RecordBatch:
        if self.words:
            self._count()
        keys = np.concatenate([k for k, _ in self.counted])
        counts = np.concatenate([c for _, c in self.counted])
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        keys, counts = keys[first], np.add.reduceat(counts, first)
        dfs = np.bincount(keys >> 20, minlength=len(self.vocabulary)).astype(np.int32)
        packed = lambda values: [values.astype("<i4").tobytes()]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([self.ids], pa.list_(pa.int64())),
                pa.array(packed(np.array(self.lengths)), pa.binary()),
                pa.array([[w.decode() for w in self.vocabulary]], pa.list_(pa.string())),
                pa.array([dfs], pa.list_(pa.int32())),
                pa.array(packed(keys & (1 << 20) - 1), pa.binary()),
                pa.array(packed(counts), pa.binary()),
                pa.array([len(self.ids)], pa.int64()),
                pa.array([sum(self.lengths)], pa.int64()),
            ],
            names=["doc_ids", "lengths", "terms", "dfs", "posting_docs", "posting_tfs", "n_docs", "n_terms"],
        )


def build_index(docs: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id whole number, text, ...) -> the index, written. Documents without a term are not in it; rows that
    repeat a doc_id are documents of their own, and so are rows without one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = Chunk()
        for batch in batches:
            for doc_id, body in zip(batch.column(0), batch.column(1)):
                chunk.add(doc_id.as_py(), body.as_py())
                if chunk.full():
                    yield chunk.row()
                    chunk = Chunk()
        if chunk.ids:
            yield chunk.row()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text"))
    return cut_lineage(rows.mapInArrow(returns_memory(run), INDEX), "index")


def _queries(items: DataFrame, text: str) -> DataFrame:
    """(item_id, text) -> (query, item_id, term), each term once; query tells rows apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for query, body in zip(batch.column("query"), batch.column("text")):
                found = list(dict.fromkeys(w.decode() for part in terms(body.as_py()) for w in part))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([query.as_py()] * len(found), pa.int64()), pa.array(found, pa.string())],
                    names=["query", "term"],
                )

    numbered = cut_lineage(
        items.select("item_id", F.col(text).alias("text"), F.monotonically_increasing_id().alias("query")), "queries"
    )
    split = numbered.select("query", "text").mapInArrow(run, "query long, term string")
    return cut_lineage(split.join(numbered.select("query", "item_id"), "query"), "query_terms")


def weigh(index: DataFrame, queries: DataFrame, n_docs: int) -> DataFrame:
    """(query, item_id, term) -> the same with the weight of every term that a document holds."""
    wanted = cut_lineage(queries.select("term").distinct(), "terms")
    found = (
        index.select(F.explode(F.arrays_zip("terms", "dfs")).alias("t"))
        .select(F.col("t.terms").alias("term"), F.col("t.dfs").alias("df"))
        .join(wanted, "term", "left_semi")
        .groupBy("term")
        .agg(F.sum("df").alias("df"))
    )
    ratio = F.lit(2.0 * n_docs + 2) / (2 * F.col("df") + 1).cast("double")
    weighted = found.withColumn("weight", F.floor(F.lit(1000.0) * F.ln(ratio)))
    return cut_lineage(queries.join(weighted, "term"), "weights")


class Lists:
    """The impact-sorted lists of one chunk for the terms of a block."""

    def __init__(self, row: dict[str, pa.Scalar], numbers: dict[str, int], n_docs: int, n_terms: int):
        unpacked = lambda name: np.frombuffer(row[name].as_py(), "<i4")
        lengths = unpacked("lengths").astype(np.int64)
        norm = 50 + (50 * lengths * n_docs) // n_terms
        # What a single occurrence in the document is worth, the least of any list that holds it.
        self.least = 1_000_000_000 // (1000 + 20 * norm)
        ends = np.cumsum(row["dfs"].values.to_numpy(), dtype=np.int64)
        known = enumerate(row["terms"].as_py())
        hits = [(number, place) for place, term in known if (number := numbers.get(term)) is not None]
        self.spans: dict[int, tuple[int, int]] = {}
        docs, tfs = unpacked("posting_docs"), unpacked("posting_tfs")
        parts, sizes = [], []
        at = 0
        for number, place in hits:
            start, end = (int(ends[place - 1]) if place else 0), int(ends[place])
            parts.append(np.arange(start, end))
            sizes.append(end - start)
            self.spans[number] = (at, at + end - start)
            at += end - start
        chosen = np.concatenate(parts) if parts else np.zeros(0, np.int64)
        docs, tfs = docs[chosen], tfs[chosen].astype(np.int64)
        values = (1_000_000_000 * tfs) // (1000 * tfs + 20 * norm[docs])
        order = np.lexsort((-values, np.repeat(np.arange(len(sizes)), sizes)))
        self.docs, self.values = docs[order], values[order]
        self.lower = np.zeros(len(lengths), np.int64)
        self.seen = np.zeros(len(lengths), np.int64)
        self.stamp = 0

    def top(self, query: list[tuple[int, int]], k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents of the chunk, with their exact scores, that may be among the k best of a query: all
        that reach both `floor` and the k-th score of the chunk, ties included."""
        spans = [(*self.spans[number], weight) for number, weight in query if number in self.spans]
        if not spans:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        lower, read, depth = self.lower, 0, FIRST_DEPTH
        touched = np.zeros(0, np.int64)
        while True:
            fresh = []
            for start, end, weight in spans:
                part = slice(start + read, min(start + read + depth, end))
                if part.start < end:
                    lower[self.docs[part]] += weight * self.values[part]
                    fresh.append(self.docs[part])
            read, depth = read + depth, 2 * depth
            touched = np.unique(np.concatenate([touched, *fresh]))
            ahead = [
                int(self.values[start + read]) if start + read < end else 0 for start, end, _ in spans
            ]
            unseen = sum(weight * value for (_, _, weight), value in zip(spans, ahead))
            beat = max(floor, 1)
            if len(touched) >= k:
                beat = max(beat, int(np.partition(lower[touched], -k)[-k]))
            if unseen >= beat:
                continue  # a document not seen in any list may still enter
            alive = touched[lower[touched] + unseen >= beat]
            upper = lower[alive]
            for (start, end, weight), value in zip(spans, ahead):
                if value:
                    self.stamp += 1
                    self.seen[self.docs[start : start + read]] = self.stamp
                    may = (self.seen[alive] != self.stamp) & (self.least[alive] <= value)
                    upper = upper + np.where(may, weight * value, 0)
            alive, upper = alive[upper >= beat], upper[upper >= beat]
            scores = lower[alive]
            if (upper == scores).all():
                break
        lower[touched] = 0
        return alive, scores


def _best(scores: np.ndarray, ids: np.ndarray, absent: np.ndarray, k: int):
    """The k best by score, then by id, rows without an id last."""
    order = np.lexsort((ids, absent, -scores))[:k]
    return scores[order], ids[order], absent[order]


def search(
    index: DataFrame, items: DataFrame, k: int = TOP, text: str = "text", block_terms: int = BLOCK_TERMS
) -> DataFrame:
    """(item_id, text) -> (item_id, rank, doc_id, score): the k best documents of each row of items with a score
    above 0, ranks from 1, equal scores by ascending doc_id, rows without a doc_id after those with one.

    Rows of items that repeat an item_id are queries of their own, each with ranks from 1. Items without a
    term that any document holds, and null texts, get no rows. Queries are searched in blocks of about
    `block_terms` terms, which pass through the driver; the index is read once per block.
    """
    totals = index.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    n_docs, n_terms = int(totals[0] or 0), int(totals[1] or 0)
    queries = _queries(items, text)
    weights = weigh(index, queries, n_docs)
    blocks = max(1, -(-weights.count() // block_terms))
    found = None
    for block in range(blocks):
        mine = weights.where(F.col("weight") > 0)
        if blocks > 1:
            mine = mine.where(F.expr(f"pmod(xxhash64(query), {blocks}L)") == block)
        asked: dict[int, list[tuple[int, int]]] = {}
        numbers: dict[str, int] = {}
        for row in mine.select("query", "term", "weight").orderBy("query", "term").collect():
            number = numbers.setdefault(row.term, len(numbers))
            asked.setdefault(row.query, []).append((number, row.weight))

        def run(batches: Iterator[pa.RecordBatch], asked=asked, numbers=numbers) -> Iterator[pa.RecordBatch]:
            best = {query: (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)) for query in asked}
            for batch in batches:
                for place in range(batch.num_rows):
                    row = {name: batch.column(name)[place] for name in batch.schema.names}
                    lists = Lists(row, numbers, n_docs, n_terms)
                    keyed = row["doc_ids"].values
                    absent = keyed.is_null().to_numpy(zero_copy_only=False)
                    ids = keyed.fill_null(0).to_numpy()
                    for query, wanted in asked.items():
                        scores, keys, missing = best[query]
                        floor = int(scores[-1]) if len(scores) == k else 0
                        docs, values = lists.top(wanted, k, floor)
                        if len(docs):
                            best[query] = _best(
                                np.append(scores, values), np.append(keys, ids[docs]),
                                np.append(missing, absent[docs]), k,
                            )
            for query, (scores, keys, missing) in best.items():
                if len(scores):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(scores), query)), pa.array(keys, mask=missing), pa.array(scores)],
                        names=["query", "doc_id", "score"],
                    )

        hits = index.select("doc_ids", "lengths", "terms", "dfs", "posting_docs", "posting_tfs").mapInArrow(
            returns_memory(run), "query long, doc_id long, score long"
        )
        found = hits if found is None else found.unionByName(hits)
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    names = queries.select("query", "item_id").distinct()
    return ranked.join(names, "query").select("item_id", "rank", "doc_id", "score")


def rank_documents(docs: DataFrame, items: DataFrame, k: int = TOP) -> DataFrame:
    """Index docs (doc_id, text, ...) and search them for items (item_id, text, ...). Null texts have no
    terms. Other columns are not looked at; an empty table on either side gives no rows."""
    return search(build_index(docs), items, k)


# ---- the same in DuckDB's SQL --------------------------------------------------------------------

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def oracle() -> str:
    """SQL for rank_documents(documents, benchmark)."""
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    found = f"regexp_extract_all({lower}, '{TERM}')"
    return f"""
    WITH q AS (
      SELECT query, item_id, unnest(list_distinct(t)) AS term
      FROM (SELECT row_number() OVER () AS query, item_id, {found} AS t FROM benchmark)
    ), tf AS (
      SELECT r, doc_id, term, count(*) AS tf
      FROM (SELECT r, doc_id, unnest(t) AS term
            FROM (SELECT row_number() OVER () AS r, doc_id, {found} AS t FROM documents)) GROUP BY ALL
    ), d AS (SELECT r, sum(tf)::BIGINT AS n FROM tf GROUP BY r),
    total AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM d),
    m AS (SELECT r, 50 + (50 * n * n_docs) // n_terms AS m FROM d, total),
    w AS (
      SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
      FROM tf, total GROUP BY term, n_docs
    ), s AS (
      SELECT query, item_id, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
      FROM q JOIN w USING (term) JOIN tf USING (term) JOIN m USING (r) GROUP BY ALL
    )
    SELECT item_id, rank, doc_id, score FROM (
      SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, doc_id NULLS LAST, r)::INT AS rank
      FROM s WHERE score > 0
    ) WHERE rank <= {TOP}
    """
