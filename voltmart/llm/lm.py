"""Language-model scores by a weighted backoff automaton over smoothed word bigrams.

States are the empty history and one state per known word; the start of a text is the state of the end
token. A state h has an arc for each word w seen after it in training, and a failure arc to the empty
history. Weights are those of interpolated absolute discounting, D being the discount:

    unigram   p(w) = (c(w) - D) / N,  unknown words together D * V / N
    arc       p(w | h) = (c(h, w) - D) / c(h) + D * T(h) / c(h) * p(w)
    failure   D * T(h) / c(h), T(h) being the number of different words seen after h

so that every state's probabilities add up to one. A text is read once from left to right: from the state
it is in, the next word's arc is taken if there is one, else the failure arc, until a state has the arc; weights
are added up on the way, and the arc's target is carried on to the next word. All documents of a block are read side by
side, one word of each per step. The order is two: states are words, and failure arcs lead to the empty history.

The model grows with the corpus, so it is neither collected nor broadcast. Documents are read in blocks,
each holding its tokens as numbers of its own word list. Blocks send their n-gram keys (64-bit hashes,
sorted, one piece per key range) with the counts of their training documents; each key range is merged in
a task of its own and tells the blocks where the whole corpus counts differ from their own. The blocks
then build the part of the automaton that their texts can reach.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltmart.llm.common import task_number
from voltmart.session import cut_lineage, work_dir

DISCOUNT = 0.75
BLOCK_TOKENS = 1 << 20  # tokens of a block, about; documents are not split
RANGE_KEYS = 1 << 21  # keys of a key range, about
BUCKET_BYTES = 1 << 26  # bytes of text in a bucket of blocks, which is one task's work
MOST_BUCKETS = 100_000  # Spark's own limit; beyond it buckets grow
FOLDS, HELD_FOLD = 5, 1
SHIFT = np.uint64(32)


def held_out(key: str | None) -> bool:
    """Whether a document is kept out of training. Null ids are trained on."""
    return key is not None and zlib.crc32(key.encode()) % FOLDS == HELD_FOLD


# ---- compact columns -----------------------------------------------------------------------------


def _squeeze(values: np.ndarray, width: int = 4) -> bytes:
    """Unsigned integers by byte planes, compressed."""
    planes = np.ascontiguousarray(values.astype(f"<u{width}")).view(np.uint8).reshape(-1, width).T
    return zstandard.ZstdCompressor(level=3).compress(np.ascontiguousarray(planes).tobytes())


def _expand(data: bytes, width: int = 4) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(width, -1)
    return np.ascontiguousarray(raw.T).view(f"<u{width}").reshape(-1)


def _squeeze_keys(keys: np.ndarray) -> bytes:
    """Ascending 64-bit keys, as differences."""
    return _squeeze(np.diff(keys, prepend=np.uint64(0)), 8)


def _expand_keys(data: bytes) -> np.ndarray:
    return np.cumsum(_expand(data, 8), dtype=np.uint64)


# ---- blocks --------------------------------------------------------------------------------------


class Block:
    """Documents of a block as numbers of its word list (0: the end token), and their n-grams."""

    def __init__(self, keys: list, lengths: np.ndarray, tokens: np.ndarray, words: np.ndarray):
        self.keys, self.lengths, self.tokens, self.words = keys, lengths, tokens, words
        self.held = np.array([held_out(k) for k in keys], bool)

    def payload(self) -> bytes:
        parts = [
            zstandard.compress(json.dumps(self.keys).encode()),
            _squeeze(self.lengths, 8),
            _squeeze(self.tokens),
            self.words.tobytes(),
        ]
        return b"".join(len(p).to_bytes(8, "little") + p for p in parts)

    @staticmethod
    def load(data: bytes) -> Block:
        parts, at = [], 0
        while at < len(data):
            size = int.from_bytes(data[at : at + 8], "little")
            parts.append(data[at + 8 : at + 8 + size])
            at += 8 + size
        return Block(
            json.loads(zstandard.decompress(parts[0])),
            _expand(parts[1], 8).astype(np.int64),
            _expand(parts[2]).astype(np.int64),
            np.frombuffer(parts[3], np.uint64),
        )

    def count(self) -> None:
        """Distinct n-grams, where each token's bigram is among them, and the block's own counts."""
        starts = np.cumsum(self.lengths) - self.lengths
        self.before = np.roll(self.tokens, 1)  # the state each token is read from
        self.before[starts] = 0
        self.trained = np.repeat(~self.held, self.lengths)
        self.bigrams, self.at = np.unique(
            (self.before << 32) | self.tokens, return_inverse=True
        )
        self.c2 = np.bincount(self.at[self.trained], minlength=len(self.bigrams))
        self.c1 = np.bincount(self.tokens[self.trained], minlength=len(self.words))
        self.first, self.second = self.bigrams >> 32, self.bigrams & 0xFFFFFFFF

    def grams(self, order: int) -> tuple[np.ndarray, np.ndarray]:
        """Keys of an order in ascending order, and which n-gram each one is."""
        keys = self.words if order == 1 else _mix(self.words[self.first], self.words[self.second])
        turn = np.argsort(keys, kind="stable")
        return keys[turn], turn


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    # Odd multipliers of a 64-bit mixing function.
    with np.errstate(over="ignore"):
        x = a * np.uint64(0x9E3779B97F4A7C15) + (b ^ (b >> SHIFT))
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> SHIFT)) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def blocks(docs: DataFrame) -> DataFrame:
    """(doc_id, text) -> (block, tokens, trained, payload)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number, digest = 0, xxhash.xxh64_intdigest
        keys, lengths, tokens, places, size = [], [], [], {b"": 0}, 0

        def close() -> pd.DataFrame:
            nonlocal number, keys, lengths, tokens, places, size
            block = Block(
                keys,
                np.array(lengths, np.int64),
                np.concatenate(tokens).astype(np.int64),
                np.fromiter(map(digest, places), np.uint64, len(places)),
            )
            row = pd.DataFrame(
                {
                    "block": [(task_number() << 32) | number],
                    "tokens": [size],
                    "trained": [int(block.lengths[~block.held].sum())],
                    "payload": [block.payload()],
                }
            )
            number += 1
            keys, lengths, tokens, places, size = [], [], [], {b"": 0}, 0
            return row

        for batch in batches:
            for key, text in zip(batch["doc_id"], batch["text"]):
                words = text.encode().lower().split() if text else []
                # A word's number is its place in the order of first occurrence; the end token is 0.
                ids = [places.setdefault(w, len(places)) for w in words]
                ids.append(0)
                keys.append(key)
                lengths.append(len(ids))
                tokens.append(np.array(ids, np.int32))
                size += len(ids)
                if size >= BLOCK_TOKENS:
                    yield close()
        if keys:
            yield close()

    found = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    return found.mapInPandas(run, "block long, tokens long, trained long, payload binary")


# ---- merging counts ------------------------------------------------------------------------------

PIECES = "order int, part long, block long, keys binary, counts binary"


def _pieces(block: int, order: int, keys: np.ndarray, counts: np.ndarray, bits: int) -> pd.DataFrame:
    """One row per key range: the block's keys there and their counts."""
    part = (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
    cuts = np.flatnonzero(np.diff(part, prepend=-1))
    ends = np.append(cuts[1:], len(keys))
    return pd.DataFrame(
        {
            "order": order,
            "part": part[cuts],
            "block": block,
            "keys": [_squeeze_keys(keys[a:b]) for a, b in zip(cuts, ends)],
            "counts": [_squeeze(counts[a:b]) for a, b in zip(cuts, ends)],
        }
    )


def _merge(frame: pd.DataFrame) -> pd.DataFrame:
    """Add up a key range over all blocks. Each block hears which of its counts differ from the sum,
    and of which keys it is the owner: the first block, of those that share it, to have counted it.
    One more row, of block -1, has the number of keys counted at least once."""
    frame = frame.sort_values("block", ignore_index=True)
    keys = [_expand_keys(k) for k in frame["keys"]]
    counts = [_expand(c).astype(np.int64) for c in frame["counts"]]
    sizes = [len(k) for k in keys]
    own = np.concatenate(counts)
    known, at = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.zeros(len(known), np.int64)
    np.add.at(total, at, own)
    counted = np.flatnonzero(own > 0)
    first = np.full(len(known), len(own))
    np.minimum.at(first, at[counted], counted)
    differs, owner = total[at] != own, first[at] == np.arange(len(own))
    rows, start = [], 0
    for block, size in zip(frame["block"], sizes):
        here = slice(start, start + size)
        index = np.flatnonzero(differs[here])
        start += size
        if len(index):
            value = total[at[here]][index] * 2 + owner[here][index]
            rows.append((block, _squeeze(np.diff(index, prepend=0)), _squeeze(value, 8), 0))
    rows.append((-1, b"", b"", int((total > 0).sum())))
    out = pd.DataFrame(rows, columns=["block", "index", "value", "known"])
    out.insert(0, "order", int(frame["order"].iloc[0]))
    out.insert(1, "part", int(frame["part"].iloc[0]))
    return out


MERGED = "order int, part long, block long, index binary, value binary, known long"


def _merged(pieces: DataFrame) -> DataFrame:
    return cut_lineage(pieces.groupBy("order", "part").applyInPandas(_merge, MERGED), "merged")


def _heard(merged: DataFrame) -> DataFrame:
    """What each block hears, as one row per block."""
    return (
        merged.where("block >= 0")
        .groupBy("block")
        .agg(F.collect_list(F.struct("order", "part", "index", "value")).alias("heard"))
    )


def _correct(
    block: Block, heard, order: int, bits: int, counts: np.ndarray, slot: int | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """A block's counts of an order over the whole corpus, and which n-grams it is the owner of."""
    keys, turn = block.grams(order)
    counts = counts.copy()
    owned = counts > 0  # where nothing was heard, nobody else has counted it
    for row in heard if heard is not None else []:
        if row["order"] != (order if slot is None else slot):
            continue
        low = 0
        if bits:
            low = int(np.searchsorted(keys, np.uint64(row["part"]) << np.uint64(64 - bits)))
        which = turn[low + np.cumsum(_expand(row["index"]).astype(np.int64))]
        value = _expand(row["value"], 8).astype(np.int64)
        counts[which], owned[which] = value >> 1, (value & 1).astype(bool)
    return counts, owned


# ---- scores --------------------------------------------------------------------------------------


class Automaton:
    """The part of the automaton that a block's texts can reach. State 0 is the empty history, state w + 1 the
    word w; arcs lie in one sorted array, keyed by state and word, and weights are log10."""

    def __init__(self, block: Block, c1: np.ndarray, c2: np.ndarray, types: np.ndarray, total: int, known: int):
        d, n = DISCOUNT, max(total, 1)
        unigram = np.where(c1 > 0, (c1 - d) / n, d * known / n if known else 1.0)
        with np.errstate(divide="ignore", invalid="ignore"):
            failure = np.where(c1 > 0, d * types / c1, 1.0)
        seen = np.flatnonzero(c2 > 0)
        first, second = block.first[seen], block.second[seen]
        weight = (c2[seen] - d) / c1[first] + failure[first] * unigram[second]
        words = np.arange(len(c1))
        # Every word has an arc from the empty history, so that failure arcs always end. Bigrams are sorted already.
        self.keys = np.concatenate([words, (first + 1) << 32 | second])
        self.weights = np.log10(np.concatenate([unigram, weight]))
        # The state a word leads to: its own, or the empty history where training has not met it.
        self.target = np.where(c1 > 0, words + 1, 0)
        self.fail_to = np.zeros(len(c1) + 1, np.int64)
        self.fail_weight = np.append(0.0, np.log10(failure))
        self.start = self.target[0]  # a text begins after an end token

    def read(self, tokens: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Log10 probability of each document, all of them read side by side."""
        order = np.argsort(-lengths, kind="stable")
        starts = (np.cumsum(lengths) - lengths)[order]
        # How many documents have a word at each place.
        going = np.searchsorted(-lengths[order], -np.arange(int(lengths.max(initial=0))), "left")
        state = np.full(len(lengths), self.start)
        scores = np.zeros(len(lengths))
        for place, count in enumerate(going.tolist()):
            word = tokens[starts[:count] + place]
            open_, at = np.arange(count), state[:count]
            while len(open_):
                key = at << 32 | word[open_]
                arc = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
                hit = self.keys[arc] == key
                scores[open_[hit]] += self.weights[arc[hit]]
                if hit.all():
                    break
                open_, at = open_[~hit], at[~hit]
                scores[open_] += self.fail_weight[at]
                at = self.fail_to[at]
            state[:count] = self.target[word]
        out = np.empty(len(lengths))
        out[order] = scores
        return out


def base_scores(block: Block, c1: np.ndarray, total: int, known: int) -> np.ndarray:
    """The unigram base of each document."""
    base = np.log10((c1 + 0.5) / (total + 0.5 * (known + 1)))[block.tokens]
    return np.add.reduceat(base, np.cumsum(block.lengths) - block.lengths)


def score_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, text, ...) -> (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score).

    Tokens are the text's words, A-Z lower-cased, and one end token. Documents whose crc32(doc_id as
    text) mod 5 is 1 are held out; all others are trained on, all of them. n_known counts the tokens met
    in training. Null and empty texts consist of the end token. Null ids are trained on. Rows that repeat
    a doc_id are documents of their own. Without training documents every token is unknown and has
    probability one. Columns other than doc_id and text are not looked at.
    """
    spark, kind = docs.sparkSession, docs.schema["doc_id"].dataType
    # A table bucketed by block: what blocks hear is dealt to the same buckets, so that the texts'
    # tokens are not shuffled at all.
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name, buckets = f"lm_blocks_{uuid.uuid4().hex}", min(max(least, -(-size // BUCKET_BYTES)), MOST_BUCKETS)
    blocks(docs).write.bucketBy(buckets, "block").option(
        "path", work_dir(spark, "lm_blocks")
    ).saveAsTable(name)
    try:
        return _scores(spark.table(name), kind)
    finally:
        spark.sql(f"DROP TABLE {name}")  # the files stay, as those of every written step do


def _scores(held: DataFrame, kind) -> DataFrame:
    sums = held.agg(F.sum("tokens").alias("tokens"), F.sum("trained").alias("trained")).first()
    tokens, total = sums["tokens"] or 0, sums["trained"] or 0
    bits = max(0, int(np.ceil(np.log2(max(1, tokens / RANGE_KEYS)))))

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for number, data in zip(batch["block"], batch["payload"]):
                block = Block.load(data)
                block.count()
                for order, counts in ((1, block.c1), (2, block.c2)):
                    keys, turn = block.grams(order)
                    yield _pieces(number, order, keys, counts[turn], bits)

    merged = _merged(held.select("block", "payload").mapInPandas(send, PIECES))
    known = merged.where("order = 1 and block < 0").agg(F.sum("known")).first()[0] or 0

    def send_types(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for number, data, heard in zip(batch["block"], batch["payload"], batch["heard"]):
                block = Block.load(data)
                block.count()
                _, owned = _correct(block, heard, 2, bits, block.c2)
                types = np.bincount(block.first[owned], minlength=len(block.words))
                keys, turn = block.grams(1)
                yield _pieces(number, 3, keys, types[turn], bits)

    first = held.select("block", "payload").join(_heard(merged), "block", "left")
    types = _merged(first.mapInPandas(send_types, PIECES))

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for data, heard in zip(batch["payload"], batch["heard"]):
                block = Block.load(data)
                block.count()
                c1, _ = _correct(block, heard, 1, bits, block.c1)
                c2, owned = _correct(block, heard, 2, bits, block.c2)
                own = np.bincount(block.first[owned], minlength=len(block.words))
                follow, _ = _correct(block, heard, 1, bits, own, slot=3)
                scores = Automaton(block, c1, c2, follow, total, known).read(block.tokens, block.lengths)
                base = base_scores(block, c1, total, known)
                starts = np.cumsum(block.lengths) - block.lengths
                yield pd.DataFrame(
                    {
                        "doc_id": block.keys,
                        "held_out": block.held,
                        "n_tokens": block.lengths,
                        "n_known": np.add.reduceat((c1 > 0)[block.tokens].astype(np.int64), starts),
                        "train_tokens": total,
                        "base_score": base,
                        "score": scores,
                    }
                )

    second = held.select("block", "payload").join(_heard(merged.unionByName(types)), "block", "left")
    scored = cut_lineage(
        second.mapInPandas(
            score,
            "doc_id string, held_out boolean, n_tokens long, n_known long, train_tokens long, "
            "base_score double, score double",
        ),
        "scores",
    )
    return scored.withColumn("doc_id", F.col("doc_id").cast(kind))
