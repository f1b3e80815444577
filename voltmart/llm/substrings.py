"""Removal of byte strings that occur more than once, by sorting sampled suffixes.

A window is a string of LENGTH bytes at one place. Every byte covered by a window that also starts
anywhere else goes. Sorting a suffix for every byte of the corpus would multiply it; so suffixes are
sampled by content: of the GRAM-byte strings inside a window the one of least hash is the window's
anchor. Equal windows have their anchors at the same place, so that only suffixes at anchors have to be
sorted, and the windows that share an anchor are told apart in a few steps:

1. Suffixes at anchors are range-partitioned by sampled splitters over their leading GRAM bytes and the
   whole stretch that their windows cover, sorted in each range and compared with their neighbours, also
   across ranges. Equal stretches: all their windows are repeated. Leading bytes found once: none is.
2. Stretches whose leading bytes are shared but which differ as a whole are cut into groups of GROUP
   windows, sorted and compared again by what the group's windows have in common and what they cover.
3. Windows of groups that remain undecided are sorted and compared one by one.

Sorting keys are digests of the strings (64 and 128 bits), not the strings: the order is not
alphabetical, but equal strings meet, which is all that is asked of it. A passage found in a third of all
documents is no problem to a sort: it runs over as many ranges as it needs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltmart.llm.common import repeated_neighbours, returns_memory, task_number
from voltmart.session import cut_lineage

LENGTH = 200
GRAM = 32
GROUP = 8

# Odd multipliers of a 64-bit mixing function.
MULTIPLIERS = [
    np.uint64(m)
    for m in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)
]
SPAN = 1 << 22  # windows looked at together


def gram_hashes(text: bytes) -> np.ndarray:
    """A 64-bit hash of the GRAM bytes at every place of the text."""
    count = len(text) - GRAM + 1
    eights = np.ndarray((len(text) - 7,), "<u8", text, strides=(1,))
    found = np.zeros(count, np.uint64)
    with np.errstate(over="ignore"):
        for number, multiplier in enumerate(MULTIPLIERS):
            found += eights[8 * number : 8 * number + count] * multiplier
            found ^= found >> np.uint64(29 + number)
        found *= MULTIPLIERS[1]
    return found ^ (found >> np.uint64(32))


def anchors(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows that share their anchor: (anchor, first window, last window, anchor's hash)."""
    if len(text) < LENGTH:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64))
    hashes = gram_hashes(text)
    windows = len(text) - LENGTH + 1
    width = LENGTH - GRAM + 1
    picked = []
    for low in range(0, windows, SPAN):
        high = min(low + SPAN, windows)
        near = hashes[low : high + width - 1]
        # The least hash (its upper half), the first one where equal: both depend on the window alone.
        value = (near & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(near), dtype=np.uint64)
        size = 1
        while size * 2 <= width:
            value = np.minimum(value[:-size], value[size:])
            size *= 2
        rest = width - size
        if rest:
            value = np.minimum(value[:-rest], value[rest:])
        picked.append((value & np.uint64(0xFFFFFFFF)).astype(np.int64) + low)
    place = np.concatenate(picked)
    first = np.flatnonzero(np.diff(place, prepend=-1))
    last = np.append(first[1:], len(place)) - 1
    anchor = place[first]
    return anchor, first, last, hashes[anchor]


def _digest(text: bytes) -> int:
    return xxhash.xxh3_64_intdigest(text)


def _digests(texts) -> np.ndarray:
    return np.fromiter(map(_digest, texts), np.uint64).view(np.int64)


def _rows(docs: DataFrame) -> DataFrame:
    """(text, ...) -> (row, key, copy, text): row has all other columns; key and copy, 96 bits, stand for
    doc_id and text. Equal rows stay equal: they repeat each other, and what is found for one holds for
    the other."""
    return docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("row"),
        F.xxhash64("doc_id", "text").alias("key"),
        F.hash("doc_id", "text").alias("copy"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )


def _sampled(rows: DataFrame) -> DataFrame:
    """A row per run of windows with one anchor: its leading bytes (core) and all it covers (whole)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number = 0
        for batch in batches:
            held, size = [], 0
            for key, copy, text in zip(batch["key"], batch["copy"], batch["text"]):
                raw = text.encode()
                anchor, first, last, core = anchors(raw)
                if not len(anchor):
                    continue
                ends = (last + LENGTH).tolist()
                whole = _digests(raw[a:b] for a, b in zip(first.tolist(), ends))
                held.append((key, copy, anchor, first, last, core.view(np.int64), whole))
                size += len(anchor)
                if size >= 100_000:
                    yield frame(held, number)
                    number, held, size = number + size, [], 0
            if held:
                yield frame(held, number)
                number += size

    def frame(held: list, number: int) -> pd.DataFrame:
        counts = [len(h[2]) for h in held]
        column = lambda i: np.concatenate([h[i] for h in held])
        return pd.DataFrame(
            {
                "key": np.repeat([h[0] for h in held], counts),
                "copy": np.repeat([h[1] for h in held], counts),
                "anchor": column(2),
                "first": column(3),
                "last": column(4),
                "core": column(5),
                "whole": column(6),
                # Of equal rows of the table only this tells the places apart.
                "place": (task_number() << 36) + number + np.arange(sum(counts)),
            }
        )

    return rows.select("key", "copy", "text").mapInPandas(
        returns_memory(run), "key long, copy int, anchor int, first int, last int, core long, whole long, place long"
    )


def _contexts(rows: DataFrame, unsettled: DataFrame) -> DataFrame:
    """The bytes that the windows of each unsettled run cover: (id, key, copy, anchor, first, known,
    bytes). known: the run is there for others to be compared with, its own windows are decided."""
    wanted = unsettled.groupBy("key", "copy").agg(
        F.collect_set(F.struct("anchor", "first", "last", "known")).alias("runs")
    )
    found = _with_texts(rows, wanted, "inner")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number, out = 0, []
        unpack = zstandard.ZstdDecompressor().decompress

        def frame() -> pd.DataFrame:
            nonlocal number
            rows = pd.DataFrame(out, columns=["key", "copy", "anchor", "first", "known", "bytes"])
            rows["id"] = (task_number() << 36) + number + np.arange(len(out))
            number += len(out)
            out.clear()
            return rows

        for batch in batches:
            for key, copy, data, runs in zip(
                batch["key"], batch["copy"], batch["packed"], batch["runs"]
            ):
                raw = unpack(data)
                for held in runs:
                    first, data = held["first"], raw[held["first"] : held["last"] + LENGTH]
                    out.append((key, copy, held["anchor"], first, held["known"], data))
                if len(out) >= 10_000:
                    yield frame()
        if out:
            yield frame()

    return found.drop("row").mapInPandas(
        returns_memory(run), "id long, key long, copy int, anchor int, first int, known boolean, bytes binary"
    )


def _with_texts(rows: DataFrame, side: DataFrame, how: str) -> DataFrame:
    """Join texts, packed before they are shuffled, with what is known of them."""

    @F.pandas_udf("binary")
    def pack(texts: pd.Series) -> pd.Series:
        press = zstandard.ZstdCompressor(level=3).compress
        return pd.Series([press(t.encode()) for t in texts])

    packed = rows.withColumn("packed", pack("text")).drop("text")
    return packed.join(side, ["key", "copy"], how)


def _groups(contexts: DataFrame) -> DataFrame:
    """Contexts cut into groups of windows: (id, low, high, core, whole). Groups are counted from the
    anchor, so that equal windows lie in the same group; the first and last ones may be cut short."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for key, anchor, first, data in zip(
                batch["id"], batch["anchor"], batch["first"], batch["bytes"]
            ):
                windows, back = len(data) - LENGTH + 1, anchor - first
                low = 0
                while low < windows:
                    # The group's farthest window starts `far` bytes before the anchor.
                    far = (back - low) // GROUP * GROUP + GROUP - 1
                    start = back - far  # where the whole group would start; may be below 0
                    high = min(start + GROUP, windows)
                    shared = data[start + GROUP - 1 : start + LENGTH]
                    out.append((key, low, high, _digest(shared), _digest(data[low : high + LENGTH - 1])))
                    low = high
            frame = pd.DataFrame(out, columns=["id", "low", "high", "core", "whole"])
            for name in ("core", "whole"):
                frame[name] = frame[name].to_numpy(np.uint64).view(np.int64)
            yield frame

    return contexts.select("id", "anchor", "first", "bytes").mapInPandas(
        returns_memory(run), "id long, low int, high int, core long, whole long"
    )


def _windows(contexts: DataFrame, groups: DataFrame) -> DataFrame:
    """Single windows of undecided groups: (id, low, core, whole), core and whole being 128 bits."""
    wanted = groups.groupBy("id").agg(F.collect_list(F.struct("low", "high")).alias("spans"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out: list[tuple[int, int]] = []
            digests: list[bytes] = []
            for key, data, spans in zip(batch["id"], batch["bytes"], batch["spans"]):
                for span in spans:
                    for low in range(span["low"], span["high"]):
                        out.append((key, low))
                        digests.append(xxhash.xxh3_128_digest(data[low : low + LENGTH]))
            frame = pd.DataFrame(out, columns=["id", "low"])
            both = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
            yield frame.assign(core=both[:, 0], whole=both[:, 1])

    return (
        contexts.select("id", "bytes")
        .join(wanted, "id")
        .mapInPandas(returns_memory(run), "id long, low int, core long, whole long")
    )


def repeated_windows(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, text) -> (rows as of _rows, repeated windows as (key, copy, low, high)): windows that
    start from low to high - 1 are found elsewhere, too."""
    rows = _rows(docs)
    runs = repeated_neighbours(_sampled(rows), "core", "whole", ["place"])
    runs = runs.where("same_core").drop("core", "place")
    settled = runs.where("same_whole").select(
        "key", "copy", F.col("first").alias("low"), (F.col("last") + 1).alias("high")
    )
    unsettled = runs.where("not same_whole or edge").select(
        "key", "copy", "anchor", "first", "last", F.col("same_whole").alias("known")
    )
    contexts = cut_lineage(_contexts(rows, unsettled), "contexts")
    groups = repeated_neighbours(_groups(contexts), "core", "whole", ["id", "low"])
    groups = groups.where("same_core").select("id", "low", "high", "same_whole", "edge")
    undecided = groups.where("not same_whole or edge")
    windows = repeated_neighbours(_windows(contexts, undecided), "core", "whole", ["id", "low"])
    windows = windows.where("same_whole").select("id", "low", (F.col("low") + 1).alias("high"))
    decided = groups.where("same_whole").select("id", "low", "high").unionByName(windows)
    place = contexts.where("not known").select("id", "key", "copy", "first")
    found = decided.join(place, "id").select(
        "key",
        "copy",
        (F.col("first") + F.col("low")).alias("low"),
        (F.col("first") + F.col("high")).alias("high"),
    )
    return rows, settled.unionByName(found)


def spans(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of the bytes covered by windows that start from low to high - 1."""
    turn = np.argsort(low, kind="stable")
    low, end = low[turn], np.maximum.accumulate(high[turn] + LENGTH - 1)
    opens = np.flatnonzero(np.append(True, low[1:] > end[:-1]))
    return low[opens], end[np.append(opens[1:], len(low)) - 1]


def remove_repeated(docs: DataFrame) -> DataFrame:
    """(doc_id, text, ...) -> (row, removal): row has all columns but text, removal is a struct of n_bytes,
    n_removed, n_spans and kept (binary). One row per row.

    Texts are taken as UTF-8 bytes; null texts are empty. A byte is removed if it lies in a string of
    LENGTH bytes that also starts at any other place of the table, in the same document or another;
    strings never run over the end of a document and are judged before anything is removed. All places
    lose it, the first one too. kept are the bytes that remain; cutting through a character is possible.
    Texts shorter than LENGTH bytes are kept. Equal rows are documents of their own (and repeat each
    other). Columns other than doc_id and text are carried along.
    """
    rows, repeated = repeated_windows(docs)
    merged = (
        repeated.groupBy("key", "copy")
        .agg(F.collect_set(F.struct("low", "high")).alias("pairs"))
        .select("key", "copy", F.col("pairs.low").alias("low"), F.col("pairs.high").alias("high"))
    )
    remove = F.pandas_udf(_removal, "n_bytes long, n_removed long, n_spans long, kept binary")
    return _with_texts(rows, merged, "left").select(
        "row", remove("packed", "low", "high").alias("removal")
    )


def _removal(packed: pd.Series, lows: pd.Series, highs: pd.Series) -> pd.DataFrame:
    unpack, out = zstandard.ZstdDecompressor().decompress, []
    for data, low, high in zip(packed, lows, highs):
        raw = unpack(data)
        total, removed, count = len(raw), 0, 0
        if low is not None and len(low):
            starts, ends = spans(np.asarray(low, np.int64), np.asarray(high, np.int64))
            removed, count = int((ends - starts).sum()), len(starts)
            raw = b"".join(raw[a:b] for a, b in zip([0, *ends.tolist()], [*starts.tolist(), total]))
        out.append((total, removed, count, raw))
    return pd.DataFrame(out, columns=["n_bytes", "n_removed", "n_spans", "kept"])


def removal_digests(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every document."""
    return remove_repeated(docs.select("doc_id", "text")).select(
        "row.doc_id",
        "removal.n_bytes",
        "removal.n_removed",
        "removal.n_spans",
        F.sha2("removal.kept", 256).alias("kept_sha256"),
    )


def _readable(kept: pd.Series) -> pd.Series:
    return pd.Series([bytes(b).decode("utf-8", "ignore") for b in kept])


def strip_repeated(docs: DataFrame) -> DataFrame:
    """The documents without their repeated strings, with all columns of docs. Those that lose text and
    have none but white space left go; null texts become empty. What is left of a character that was cut
    through goes, and n_chars, where docs has it, is counted anew."""
    readable = F.pandas_udf(_readable, "string")
    found = remove_repeated(docs).select("row", readable("removal.kept").alias("rest"), "removal.n_removed")
    found = found.where((F.col("n_removed") == 0) | (F.trim(F.translate("rest", "\t\r\n", "   ")) != ""))
    kinds = dict(docs.dtypes)
    column = lambda c: (
        F.col("rest")
        if c == "text"
        else F.length("rest").cast(kinds[c])
        if c == "n_chars"
        else F.col(f"row.`{c}`")
    )
    return found.select(*[column(c).alias(c) for c in docs.columns])
