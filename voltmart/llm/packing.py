"""Packing documents into training sequences by Karmarkar-Karp multiway differencing.

A document's ids are cut into whole windows and a remainder. Remainders are dealt to blocks of about
BLOCK windows, and each block is partitioned into near-equal windows: of two partial partitions the
fullest windows of one are joined with the emptiest of the other, most unequal partitions first. If a
window exceeds the capacity, the block gets one window more.
"""

from __future__ import annotations

import heapq
import os
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltmart.llm.bpe import PATTERN, Vocabulary, is_newer
from voltmart.llm.common import map_documents, task_number
from voltmart.session import cut_lineage

CAPACITY = 1024
END = 0  # the id that ends every document
BLOCK = 256  # windows of a block, about
TAIL = 8  # an eighth of each remainder is cut off: small pieces even out what large ones leave open
WHOLE = 1 << 62  # sequences from here on hold one whole window of a document


class TextEncoder:
    """Ids as the tokenizers library gives them.

    Texts are merged by tiktoken, over the vocabulary of the same file (a token's id is its rank); texts
    with special tokens or characters newer than Python's tables, on which the two libraries could
    differ, go through tokenizers.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as file:
            vocabulary = Vocabulary(file.read())
        self.special = list(vocabulary.special)
        names = {s.encode() for s in self.special}
        self.fast = tiktoken.Encoding(
            "plain",
            pat_str=PATTERN,
            mergeable_ranks={t: n for t, n in vocabulary.ids.items() if t not in names},
            special_tokens={},
        )

    def encode(self, text: str) -> np.ndarray:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        if any(s in text for s in self.special) or is_newer(text):
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        else:
            ids = self.fast.encode_ordinary(text)
        return np.array(array("I", ids), "<u4")


@lru_cache(1)
def _encoder(path: str) -> TextEncoder:
    return TextEncoder(path)


def cut_lengths(total: int, capacity: int = CAPACITY) -> list[int]:
    """Lengths of a document's pieces: whole windows, then the remainder in a large and a small part."""
    whole, rest = divmod(total, capacity)
    return [capacity] * whole + [part for part in (rest - rest // TAIL, rest // TAIL) if part]


def karmarkar_karp(sizes: list[int], windows: int) -> np.ndarray:
    """The window of each size, windows being near-equal in sum."""
    if not len(sizes):
        return np.zeros(0, np.int64)
    nodes: list[tuple[int, int, np.ndarray | None]] = [(0, 0, None)] * len(sizes)
    heap = []
    for number, size in enumerate(sizes):
        sums = np.zeros(windows, np.int64)
        sums[0] = size
        heap.append((-int(sums[0] - sums[-1]), number, sums))
    heapq.heapify(heap)
    while len(heap) > 1:
        _, a, left = heapq.heappop(heap)
        _, b, right = heapq.heappop(heap)
        sums = left + right[::-1]
        order = np.argsort(-sums, kind="stable")
        sums = sums[order]
        heapq.heappush(heap, (-int(sums[0] - sums[-1]), len(nodes), sums))
        nodes.append((a, b, order))
    place: list[np.ndarray | None] = [None] * len(nodes)
    place[-1] = np.arange(windows)
    for number in range(len(nodes) - 1, len(sizes) - 1, -1):
        a, b, order = nodes[number]
        before = np.empty(windows, np.int64)
        before[order] = place[number]
        place[a], place[b] = before, before[::-1]
        place[number] = None
    return np.array([p[0] for p in place[: len(sizes)]])


def pack(sizes: list[int], capacity: int = CAPACITY) -> np.ndarray:
    """The window of each size, no window above the capacity; no size may be above it."""
    windows = max(1, -(-sum(sizes) // capacity))
    while True:
        found = karmarkar_karp(sizes, windows)
        if not len(sizes) or np.bincount(found, sizes).max() <= capacity:
            return found
        windows += max(1, windows // 128)


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """(doc_id, text) -> one row per piece: (doc_id, start, length, ids_crc32, doc_tokens, task, number)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, number = _encoder(tokenizer), 0
        for batch in batches:
            rows = []
            for key, text in zip(batch["doc_id"], batch["text"]):
                ids = np.append(encoder.encode(text or ""), np.uint32(end))
                raw, start = memoryview(ids.astype("<u4").tobytes()), 0
                for length in cut_lengths(len(ids), capacity):
                    crc = zlib.crc32(raw[4 * start : 4 * (start + length)])
                    rows.append((key, start, length, crc, len(ids), task_number(), number))
                    start, number = start + length, number + 1
            yield pd.DataFrame(rows, columns=columns)

    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "task", "number"]
    return map_documents(docs, run, ", ".join(f"{c} long" for c in columns[1:]))


def pack_documents(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = END
) -> DataFrame:
    """(doc_id, text, ...) -> one row per piece with its sequence and its place there.

    Every id of every document, and the `end` id after it, lies in exactly one piece; null or empty
    texts consist of that id. offset counts from 0 without gaps within a sequence. Rows that repeat a
    doc_id are documents of their own. Columns: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset. An empty table gives no rows. Other columns are not looked at.
    """
    cut = cut_lineage(pieces(docs, tokenizer, capacity, end), "pieces")
    rest = cut.where(F.col("length") < capacity)
    whole = cut.where(F.col("length") == capacity).select(
        "doc_id",
        "start",
        "length",
        "ids_crc32",
        "doc_tokens",
        (F.lit(WHOLE) + F.shiftleft("task", 40) + F.col("number")).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )
    tokens = rest.agg(F.sum("length")).first()[0] or 0
    blocks = max(1, round(tokens / (capacity * BLOCK)))
    out = "doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset".split(", ")
    kind = cut.schema["doc_id"].dataType

    def fill(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["task", "number"], ignore_index=True)
        frame["window"] = pack(frame["length"].tolist(), capacity)
        frame = frame.sort_values(["window", "task", "number"], ignore_index=True)
        frame["sequence_id"] = frame["block"] * (1 << 24) + frame["window"]
        before = frame.groupby("window")["length"].cumsum() - frame["length"]
        return frame.assign(offset=before)[out]

    packed = (
        rest.withColumn("doc_id", F.col("doc_id").cast("string"))
        .withColumn("block", F.expr(f"pmod(xxhash64(task, number), {blocks}L)"))
        .groupBy("block")
        .applyInPandas(fill, ", ".join([f"{out[0]} string", *(f"{c} long" for c in out[1:])]))
        .withColumn("doc_id", F.col("doc_id").cast(kind))
    )
    return whole.unionByName(packed)
