"""Byte-level BPE with a minimal acyclic transducer for frequent words and exact merges for the rest.

The tokenizer file (vocabulary, merges, special tokens) is a parameter. Word counts come from the whole
corpus; the most frequent words are compiled, with their ids as outputs, into a minimal acyclic
automaton whose suffixes are shared. It is written once as one flat file, shipped to the executors, and
memory-mapped there by every Python worker. Words that it lacks are merged by the ranks of the merges.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import sys
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import cache, lru_cache

import numpy as np
import pandas as pd
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltmart.llm.common import map_documents
from voltmart.session import cut_lineage, shared_root

LEXICON = 1 << 17  # words compiled into the automaton
KNOWN_WORDS = 1 << 17  # words a worker remembers
COUNTED_WORDS = 1 << 18  # words a worker counts before it hands them on
LONG_WORD = 64  # bytes; longer words are merged one by one and stay out of the automaton
TOGETHER = 1 << 14  # words merged side by side
EXACT_COUNTS = 4096  # counts of words told apart one by one in the histogram; doublings beyond


@cache
def byte_names() -> dict[int, str]:
    """The printable character that stands for each byte in the vocabulary file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


def _class(*kinds: str) -> str:
    """A regular expression class body of all characters whose category starts so."""
    spans, start = [], None
    for code in range(sys.maxunicode + 2):
        inside = code <= sys.maxunicode and unicodedata.category(chr(code)).startswith(kinds)
        if inside and start is None:
            start = code
        elif not inside and start is not None:
            spans.append(re.escape(chr(start)) + "-" + re.escape(chr(code - 1)))
            start = None
    return "".join(spans)


# Fixed value: the characters that the tokenizer's splitting pattern takes as white space.
SPACES = "\t-\r \x85\xa0  -     　"


# Fixed value: the tokenizer's splitting pattern.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@cache
def splitter() -> re.Pattern:
    """The splitting pattern of the tokenizer, spelled out in character ranges."""
    letters, numbers = _class("L"), _class("N")
    return re.compile(
        f"'s|'t|'re|'ve|'m|'ll|'d| ?[{letters}]+| ?[{numbers}]+| ?[^{SPACES}{letters}{numbers}]+"
        f"|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+"
    )


_assigned: set[str] = set()


def is_newer(text: str) -> bool:
    """Whether a text has a character that this Python's tables do not know; newer tables may count it
    as a letter."""
    for character in set(text) - _assigned:
        if unicodedata.category(character) == "Cn":
            return True
        _assigned.add(character)
    return False


_SINGLE = [bytes([byte]) for byte in range(256)]


class Vocabulary:
    """Tokens, merges and special tokens of a tokenizer file."""

    def __init__(self, text: str):
        self.text = text
        held = json.loads(text)
        self.to_byte = to_byte = {name: byte for byte, name in byte_names().items()}
        model = held["model"]
        as_bytes = lambda token: bytes(to_byte[c] for c in token)
        self.ids = {as_bytes(token): number for token, number in model["vocab"].items() if
                    all(c in to_byte for c in token)}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.ranks = {(as_bytes(a), as_bytes(b)): n for n, (a, b) in enumerate(pairs)}
        self.special = {t["content"]: t["id"] for t in held["added_tokens"]}
        self.tokens = {number: token for token, number in self.ids.items()}
        self.tokens |= {number: text.encode() for text, number in self.special.items()}
        longest_first = sorted(self.special, key=len, reverse=True)
        self.special_pattern = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")")

    def split(self, piece: str) -> list[bytes]:
        """The words of the splitting pattern. Where a character is newer than this Python's tables, the
        tokenizer library's own splitter decides."""
        if not is_newer(piece):
            return [word.encode() for word in splitter().findall(piece)]
        from tokenizers import Tokenizer

        if not hasattr(self, "library"):
            self.library = Tokenizer.from_str(self.text).pre_tokenizer
        found = self.library.pre_tokenize_str(piece)
        return [bytes(self.to_byte[c] for c in word) for word, _ in found]

    def cut(self, piece: str, raw: bytes) -> list[bytes]:
        """The words of a piece: a space and letters are one word, a mark behind them another."""
        if piece[0] == " ":
            if piece[1:].isalpha():
                return [raw]
            if piece[-1] in ".,;:!?" and piece[1:-1].isalpha():
                return [raw[:-1], raw[-1:]]
        return self.split(piece)

    def ids_of(self, piece: str) -> list[int]:
        return [i for word in self.split(piece) for i in self.merge(word)]

    def merge_all(self, words: list[bytes]) -> list[bytes]:
        """The ids of many words, as little-endian unsigned 32-bit integers: words of up to LONG_WORD bytes
        side by side, one merge of each per round, longer ones by themselves."""
        if not hasattr(self, "pairs"):
            self.pairs = Pairs(self)
        out: list[bytes] = [b""] * len(words)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        for place in np.flatnonzero(lengths > LONG_WORD).tolist():
            out[place] = np.array(self.merge(words[place]), "<u4").tobytes()
        low = 0
        for high in (4, 8, 12, 16, 24, 32, LONG_WORD):
            mine = np.flatnonzero((lengths > low) & (lengths <= high))
            for start in range(0, len(mine), TOGETHER):
                chosen = mine[start : start + TOGETHER].tolist()
                for place, ids in zip(chosen, self.pairs.merge([words[i] for i in chosen], high)):
                    out[place] = ids
            low = high
        return out

    def merge(self, word: bytes) -> list[int]:
        """The ids of one word: the pair of lowest rank is merged, leftmost first, until none is left."""
        parts = [_SINGLE[byte] for byte in word]
        if len(parts) > 256:
            return self._merge_long(parts)
        rank, none = self.ranks.get, len(self.ranks)
        found = [rank(pair, none) for pair in zip(parts, parts[1:])]
        while found:
            low = min(found)
            if low == none:
                break
            at = found.index(low)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del found[at]
            if at:
                found[at - 1] = rank((parts[at - 1], parts[at]), none)
            if at < len(found):
                found[at] = rank((parts[at], parts[at + 1]), none)
        return [self.ids[p] for p in parts]

    def _merge_long(self, parts: list[bytes]) -> list[int]:
        """The same for a very long word, with a heap over a linked list instead of rescans."""
        import heapq

        after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
        heap = [
            (rank, i, *pair)
            for i, pair in enumerate(zip(parts, parts[1:]))
            if (rank := self.ranks.get(pair)) is not None
        ]
        heapq.heapify(heap)
        end = len(parts)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if parts[i] != a or j >= end or parts[j] != b:
                continue  # one of the two has been merged since
            parts[i], parts[j] = a + b, None
            after[i] = after[j]
            if after[i] < end:
                before[after[i]] = i
            for left in (before[i], i):
                if left >= 0 and after[left] < end:
                    pair = (parts[left], parts[after[left]])
                    if (rank := self.ranks.get(pair)) is not None:
                        heapq.heappush(heap, (rank, left, *pair))
        return [self.ids[p] for p in parts if p is not None]


class Pairs:
    """The merges as arrays: what a pair of tokens becomes, and in which order pairs are merged."""

    def __init__(self, vocabulary: Vocabulary):
        ids, rows = vocabulary.ids, []
        for (a, b), rank in vocabulary.ranks.items():
            rows.append((ids[a], ids[b], rank, ids[a + b]))
        first, second, ranks, merged = np.array(rows or np.zeros((0, 4)), np.int64).T
        order = np.argsort(ranks)
        keys = (first << 32 | second)[order]
        self.none = np.int32(len(keys))  # the rank of pairs that are never merged
        self.keys = np.append(keys, -1)
        self.merged = np.append(merged[order], 0).astype(np.int32)  # what the pair of a rank becomes
        # Open addressing: a pair's rank lies in the first free slot from its own on.
        self.slots = np.full(1 << 21, self.none, np.int32)
        for rank, slot in enumerate(self._slot(keys).tolist()):
            while self.slots[slot] != self.none:
                slot = (slot + 1) & len(self.slots) - 1
            self.slots[slot] = rank
        self.single = np.array([ids[byte] for byte in _SINGLE], np.int32)

    def rank(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """The rank of each pair; the number of merges for pairs that have none."""
        wanted = first.astype(np.int64) << 32 | second
        slot = self._slot(wanted)
        found = self.slots[slot]
        open_ = np.flatnonzero((found != self.none) & (self.keys[found] != wanted))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & len(self.slots) - 1
            found[open_] = self.slots[slot[open_]]
            open_ = open_[(found[open_] != self.none) & (self.keys[found[open_]] != wanted[open_])]
        return found

    @staticmethod
    def _slot(keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(43)).astype(np.int64)

    @property
    def of_bytes(self) -> np.ndarray:
        if not hasattr(self, "_of_bytes"):
            self._of_bytes = self.rank(np.repeat(self.single, 256), np.tile(self.single, 256))
        return self._of_bytes

    def merge(self, words: list[bytes], width: int) -> list[bytes]:
        """Each round merges, in every word, the leftmost of the pairs of lowest rank."""
        count = len(words)
        raw = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(count, width)
        lengths = np.fromiter(map(len, words), np.int64, count)
        tokens = self.single[raw]
        ranks = np.full((count, width), self.none)
        ranks[:, :-1] = self.of_bytes[raw[:, :-1].astype(np.int64) << 8 | raw[:, 1:]]
        places = np.arange(width)
        ranks[places >= lengths[:, None] - 1] = self.none
        active = np.arange(count)
        while len(active):
            mine = ranks[active]
            at = mine.argmin(axis=1)
            lowest = mine[np.arange(len(active)), at]
            found = lowest < self.none
            active, at, lowest, mine = active[found], at[found], lowest[found], mine[found]
            if not len(active):
                break
            row = np.arange(len(active))
            # Everything behind the pair's second token moves up by one place.
            shifted = np.minimum(places + (places > at[:, None]), width - 1)
            held = np.take_along_axis(tokens[active], shifted, 1)
            mine = np.take_along_axis(mine, shifted, 1)
            held[row, at] = self.merged[lowest]
            lengths[active] -= 1
            size = lengths[active]
            right = np.minimum(at + 1, width - 1)
            mine[row, at] = np.where(at + 1 < size, self.rank(held[row, at], held[row, right]), self.none)
            left = np.maximum(at - 1, 0)
            before = np.where(at > 0, self.rank(held[row, left], held[row, at]), mine[row, left])
            mine[row, left] = before
            mine[row, size - 1] = self.none
            tokens[active], ranks[active] = held, mine
        flat = tokens[places < lengths[:, None]].astype("<u4").tobytes()
        ends = np.cumsum(4 * lengths)
        return [flat[a:b] for a, b in zip((ends - 4 * lengths).tolist(), ends.tolist())]


def words_of(text: str) -> list[str]:
    """Cut a text where the splitting pattern always cuts: before a space that a non-space follows.

    The pieces keep that space. What lies between such cuts may hold several words of the pattern.
    Between two cuts the pattern matches as it does on the whole text: each alternative ends before such
    a space, and each begins anew at it.
    """
    pieces = text.split(" ")
    if len(pieces) == 1:
        return pieces if text else []
    spaced = _odd_space().search(text) is not None
    out = [pieces[0]] if pieces[0] else []
    if not spaced:
        out.extend([" " + p for p in pieces[1:]])
        return out
    leads = _leading_space().match
    for piece in pieces[1:]:
        if out and (not piece or leads(piece)):
            out[-1] += " " + piece
        else:
            out.append(" " + piece)
    return out


@cache
def _odd_space() -> re.Pattern:
    return re.compile(f" (?:[{SPACES}]|$)")


@cache
def _leading_space() -> re.Pattern:
    return re.compile(f"[{SPACES}]")


# ---- the automaton -------------------------------------------------------------------------------


def compile_lexicon(entries: dict[bytes, list[int]]) -> bytes:
    """A minimal acyclic automaton of the words, numbering them, and the ids by that number.

    Words are added in order; once a branch is left, its states are replaced by equal ones met before, so
    that suffixes are shared. A word's number is the count of words before it, summed over its arcs; the
    ids lie in one array, found by number. Layout: see Lexicon.
    """
    register: dict[tuple, int] = {}
    states: list[tuple] = []  # (final, ((byte, target), ...))

    def settle(node: list) -> int:
        key = (node[0], tuple(node[1]))
        if key not in register:
            register[key] = len(states)
            states.append(key)
        return register[key]

    path: list[list] = [[False, []]]  # the states of the last word, not settled yet
    last = b""
    words = sorted(entries)
    for word in words:
        common = len(os.path.commonprefix([last, word]))
        while len(path) > common + 1:
            done = settle(path.pop())
            path[-1][1].append((last[len(path) - 1], done))
        for _ in range(common, len(word)):
            path.append([False, []])
        path[-1][0] = True
        last = word
    while len(path) > 1:
        done = settle(path.pop())
        path[-1][1].append((last[len(path) - 1], done))
    start = settle(path[0])

    below: list[int] = []  # words accepted from each state; targets are settled before their sources
    arcs: list[tuple[int, int, int]] = []  # key state * 256 + byte, target, words before this arc
    for number, (final, out) in enumerate(states):
        passed = int(final)
        for byte, target in out:
            arcs.append((number * 256 + byte, target, passed))
            passed += below[target]
        below.append(passed)
    final = np.array([f for f, _ in states], np.int64)
    keys, targets, before = (np.array(x, np.int64) for x in (zip(*arcs) if arcs else ((), (), ())))
    ids = [entries[w] for w in words]
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int64)
    flat = np.array([i for x in ids for i in x], np.int64)
    head = np.array([start, len(states), len(keys), len(words), len(flat)], np.int64)
    return b"".join(x.tobytes() for x in (head, final, keys, targets, before, offsets, flat))


class Lexicon:
    """The automaton, memory-mapped from a file of longs: start state and sizes, then per state whether
    it is final, per arc (sorted) its key, target and number of words before, then offsets and ids."""

    def __init__(self, path: str):
        data = np.memmap(path, np.int64, "r")
        self.start, states, arcs, self.words, ids = data[:5].tolist()
        cuts = np.cumsum([5, states, arcs, arcs, arcs, self.words + 1, ids])
        parts = [data[a:b] for a, b in zip(cuts, cuts[1:])]
        self.final, self.keys, self.targets, self.before, self.offsets, self.ids = parts

    def look_up(self, words: list[bytes]) -> np.ndarray:
        """The number of each word, -1 if the automaton lacks it; all words advance byte by byte."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        found = np.full(len(words), -1, np.int64)
        if not len(words) or not len(self.keys):
            return found
        flat = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
        starts = np.cumsum(lengths) - lengths
        alive = np.arange(len(words))
        state, number = np.full(len(words), self.start), np.zeros(len(words), np.int64)
        step = 0
        while len(alive):
            ended = lengths[alive] == step
            done = ended & (self.final[state] == 1)
            found[alive[done]] = number[done]
            alive, state, number = alive[~ended], state[~ended], number[~ended]
            if not len(alive):
                break
            key = state * 256 + flat[starts[alive] + step]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[at] == key
            at, alive = at[hit], alive[hit]
            number = number[hit] + self.before[at]
            state = self.targets[at]
            step += 1
        return found

    def outputs(self, numbers: np.ndarray) -> list[bytes]:
        """The ids of words by number, as little-endian unsigned 32-bit integers."""
        starts, ends = self.offsets[numbers], self.offsets[numbers + 1]
        sizes = ends - starts
        places = np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(int(sizes.sum()))
        flat, upto = self.ids[places].astype("<u4").tobytes(), np.cumsum(4 * sizes)
        return [flat[a:b] for a, b in zip((upto - 4 * sizes).tolist(), upto.tolist())]


class Encoder:
    """Ids of texts: remembered words, then the automaton, then exact merges."""

    def __init__(self, vocabulary: Vocabulary, lexicon: Lexicon | None):
        self.vocabulary, self.lexicon = vocabulary, lexicon
        self.known: dict[str, bytes] = {}

    def learn(self, pieces: set[str]) -> list[str]:
        """Ids of pieces not met yet: as whole words of the automaton, or by the splitting pattern."""
        new = [p for p in pieces if p not in self.known]
        raw = [p.encode() for p in new]
        numbers = self.lexicon.look_up(raw) if self.lexicon else np.full(len(raw), -1)
        hits = np.flatnonzero(numbers >= 0)
        if len(hits):
            for place, ids in zip(hits.tolist(), self.lexicon.outputs(numbers[hits])):
                self.known[new[place]] = ids
        unseen = np.flatnonzero(numbers < 0).tolist()
        words = [self.vocabulary.cut(new[i], raw[i]) for i in unseen]
        merged = iter(self.vocabulary.merge_all([w for part in words for w in part]))
        for i, part in zip(unseen, words):
            self.known[new[i]] = next(merged) if len(part) == 1 else b"".join([next(merged) for _ in part])
        return new

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        pattern = self.vocabulary.special_pattern if self.vocabulary.special else None
        cut = []
        for text in texts:
            parts = []
            for n, part in enumerate(pattern.split(text) if pattern else [text]):
                parts.append(self.vocabulary.special[part] if n % 2 else words_of(part))
            cut.append(parts)
        new = self.learn({w for parts in cut for p in parts if isinstance(p, list) for w in p})
        known = self.known
        out = [
            b"".join(
                b"".join(map(known.__getitem__, p)) if isinstance(p, list) else p.to_bytes(4, "little")
                for p in parts
            )
            for parts in cut
        ]
        if len(known) > KNOWN_WORDS:  # frequent words came early; later ones are not remembered
            for piece in new:
                del known[piece]
        return out

    def decode(self, ids: bytes) -> str:
        tokens = self.vocabulary.tokens
        raw = b"".join(map(tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        return raw.decode("utf-8", "replace")


# ---- on Spark ------------------------------------------------------------------------------------


def _batches(texts: list[str], limit: int = 1 << 22) -> Iterator[list[str]]:
    """Consecutive texts of about `limit` characters in all."""
    held, size = [], 0
    for text in texts:
        held.append(text)
        size += len(text)
        if size >= limit:
            yield held
            held, size = [], 0
    if held:
        yield held


@lru_cache(1)
def _vocabulary(path: str) -> Vocabulary:
    with open(path, encoding="utf-8") as file:
        return Vocabulary(file.read())


@lru_cache(1)
def _encoder(tokenizer: str, lexicon: str | None) -> Encoder:
    """One per worker: the file of the automaton is the executor's copy, shared by its workers."""
    return Encoder(_vocabulary(tokenizer), Lexicon(SparkFiles.get(lexicon)) if lexicon else None)


def word_counts(docs: DataFrame) -> DataFrame:
    """(text) -> (word, n): how often each piece of `words_of` occurs, over all documents."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: Counter[str] = Counter()
        for batch in batches:
            for text in batch["text"]:
                if text:
                    counts.update(words_of(text))
                if len(counts) > COUNTED_WORDS:
                    yield pd.DataFrame({"word": list(counts), "n": list(counts.values())})
                    counts.clear()
        if counts:
            yield pd.DataFrame({"word": list(counts), "n": list(counts.values())})

    return (
        docs.select("text").mapInPandas(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    )


def frequent_words(docs: DataFrame, size: int) -> list[str]:
    """At most `size` words, those above a count that a histogram of all words' counts gives. The words
    are the only thing that reaches the driver, and none is longer than LONG_WORD bytes."""
    counts = cut_lineage(word_counts(docs).where(F.octet_length("word") <= LONG_WORD), "words")
    doubling = F.expr("shiftleft(1L, length(bin(n)) - 1)")
    above = F.when(F.col("n") < EXACT_COUNTS, F.col("n")).otherwise(doubling)
    histogram = counts.groupBy(above.alias("low")).agg(F.count(F.lit(1)).alias("words")).collect()
    least, taken = None, 0
    for row in sorted(histogram, key=lambda r: -r.low):
        taken += row.words
        if taken > size:
            break
        least = row.low
    if least is None:
        return []
    return [r.word for r in counts.where(F.col("n") >= least).select("word").collect()]


def _write_shared(spark: SparkSession, path: str, data: bytes) -> None:
    """Write a file where all executors and the driver can reach it, whatever file system that is."""
    context = spark.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(context._jsc.hadoopConfiguration()).create(target, True)
    out.write(bytearray(data))
    out.close()


def ship_lexicon(docs: DataFrame, tokenizer: str, size: int = LEXICON) -> str:
    """Compile up to `size` of the most frequent words and hand the file to all executors, later ones too.

    It is named by its content and lies in the shared folder; a session that shipped it before uses it again.
    """
    spark: SparkSession = docs.sparkSession
    top = sorted(frequent_words(docs, size))
    vocabulary = _vocabulary(tokenizer)
    data = compile_lexicon({w.encode(): vocabulary.ids_of(w) for w in top})
    name = f"lexicon-{hashlib.sha256(data).hexdigest()[:24]}.bin"
    if not any(path.endswith(f"/{name}") for path in spark.sparkContext.listFiles):
        path = f"{shared_root(spark)}/{name}"
        _write_shared(spark, path, data)
        spark.sparkContext.addFile(path)
    return name


def encode_documents(
    docs: DataFrame, tokenizer: str, size: int = LEXICON
) -> DataFrame:
    """(doc_id, text, ...) -> (doc_id, ids binary, decoded string), one row per row of docs.

    ids are little-endian unsigned 32-bit integers as the tokenizer gives them without added special
    tokens; special tokens spelled out in a text become their id, as the tokenizers library does by
    default. decoded is the text of those ids. Null or empty text: no ids, empty decoded text. `tokenizer`
    is a path that every executor can open. Other columns are not looked at.
    """
    lexicon = ship_lexicon(docs, tokenizer, size)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = _encoder(tokenizer, lexicon)
        for batch in batches:
            keys, texts = batch["doc_id"], [t or "" for t in batch["text"]]
            at = 0
            for part in _batches(texts):
                ids = encoder.encode(part)
                yield pd.DataFrame(
                    {
                        "doc_id": keys.iloc[at : at + len(part)],
                        "ids": ids,
                        "decoded": [encoder.decode(x) for x in ids],
                    }
                )
                at += len(part)

    return map_documents(docs, run, "ids binary, decoded string")


def encoding_digests(docs: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every document."""
    return encode_documents(docs, tokenizer).select(
        "doc_id",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2(F.col("ids"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
