"""Ranked search against a plain computation of every score."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from voltmart.llm import nra

TERM = re.compile(nra.TERM)


def split(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return TERM.findall(lowered)


def plain(docs, items, k):
    bags = [(doc_id, Counter(split(t))) for doc_id, t, *_ in docs]
    bags = [(d, b) for d, b in bags if b]
    n_docs, n_terms = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(w for _, b in bags for w in b)
    out = []
    for item, text, *_ in items:
        scores = []
        for doc, bag in bags:
            n = sum(bag.values())
            m = 100 - 50 + (50 * n * n_docs) // n_terms
            score = 0
            for w in set(split(text)):
                if w in bag:
                    weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1)))
                    score += weight * ((10**9 * bag[w]) // (1000 * bag[w] + 20 * m))
            if score > 0:
                scores.append((-score, doc is None, doc or 0, doc))
        out += [(item, r + 1, s[3], -s[0]) for r, s in enumerate(sorted(scores, key=lambda s: s[:3])[:k])]
    return sorted(map(str, out))


def corpus(n=400):
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(300)] + ["Straße", "ÄB", "naïve", "X9", "日本"]
    weights = 1 / np.arange(1, len(words) + 1)
    weights /= weights.sum()
    docs = [(i, " ".join(rng.choice(words, int(rng.integers(1, 120)), p=weights))) for i in range(n)]
    docs += [(n + i, docs[3][1].upper()) for i in range(70)]  # equal scores across the k-th place
    docs += [(7, "w1 w2 w3"), (7, "w1 w2 w3"), (None, docs[3][1]), (None, "w250 w251"), (9001, None), (9002, ""),
             (9003, " .,;\n"), (9004, "w5 " * 300_000), (-5, "w1\x00w2\x7fw299-w298")]
    items = [(i, " ".join(rng.choice(words, 12))) for i in range(25)]
    items += [(100, docs[3][1]), (101, None), (102, "unheard of"), (103, "w1"), (103, "w299 w1"), (None, "w2 w2 W2 x9"),
              (104, "w0"), (105, "Straße äb ÄB 日本")]
    return docs, items


@pytest.mark.parametrize("k", [1, 50, 100_000])
def test_all_ranks_and_scores(spark, k):
    docs, items = corpus()
    got = nra.rank_documents(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(3),
        spark.createDataFrame(items, "item_id long, text string"), k,
    )
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(str(tuple(r)) for r in got.collect()) == plain(docs, items, k)


def test_small_chunks_and_blocks_give_the_same(spark, monkeypatch):
    docs, items = corpus(120)
    frames = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(nra, "FIRST_DEPTH", 2)
    chunk = nra.Chunk()
    for doc in docs:
        chunk.add(*doc)
        assert not chunk.full()
    index = nra.build_index(frames[0].repartition(40))
    assert index.count() > 10
    found = nra.search(index, frames[1], 5, block_terms=30)
    assert sorted(str(tuple(r)) for r in found.collect()) == plain(docs, items, 5)


def test_one_chunk_reads_no_further_than_it_must():
    """Lists are read from the top until the k best are settled."""
    chunk = nra.Chunk()
    for i in range(20_000):
        chunk.add(i, "common " * (1 + i % 3) + f"pad{i} " * (i % 50) + ("rare" if i % 1000 == 0 else ""))
    batch = chunk.row()
    row = {name: batch.column(name)[0] for name in batch.schema.names}
    lists = nra.Lists(row, {"common": 0, "rare": 1}, 20_000, row["n_terms"].as_py())
    full = sum(end - start for start, end in lists.spans.values())
    read = []
    values = lists.values

    class Counted:
        def __getitem__(self, part):
            if isinstance(part, slice):
                read.append(part.stop - part.start)
            return values[part]

    lists.values = Counted()
    assert len(lists.top([(0, 1)], 5, 0)[0]) >= 5
    assert sum(read) < full / 4
    docs, scores = lists.top([(0, 1), (1, 9000)], 5, 0)
    assert len(docs) >= 5 and len(scores) == len(docs)
    everything, all_scores = lists.top([(0, 1), (1, 9000)], 20_000, 0)
    best = sorted(zip(-all_scores, everything))[:5]
    assert sorted(zip(-scores, docs))[:5] == best


def test_empty_tables_and_clashing_names(spark):
    docs = spark.createDataFrame([(1, "a b", 5, "x")], "doc_id int, text string, score int, term string")
    items = spark.createDataFrame([(1, "B", 5, 6)], "item_id int, text string, doc_id int, query int")
    assert [tuple(r)[:3] for r in nra.rank_documents(docs, items).collect()] == [(1, 1, 1)]
    assert nra.rank_documents(docs.limit(0), items).collect() == []
    assert nra.rank_documents(docs, items.limit(0)).collect() == []
    nothing = spark.createDataFrame([(1, None)], "doc_id long, text string")
    assert nra.rank_documents(nothing, items).collect() == []


def test_the_index_counts_long_texts_in_parts(monkeypatch):
    monkeypatch.setattr(nra, "PIECE", 64)
    monkeypatch.setattr(nra, "PENDING", 100)
    text = " ".join(f"w{i % 37}" for i in range(5000)) + " Last"
    chunk = nra.Chunk()
    chunk.add(4, text)
    batch = chunk.row()
    docs = np.frombuffer(batch.column("posting_docs")[0].as_py(), "<i4")
    tfs = np.frombuffer(batch.column("posting_tfs")[0].as_py(), "<i4")
    assert dict(zip(batch.column("terms")[0].as_py(), tfs)) == Counter(split(text))
    assert not docs.any() and batch.column("n_terms")[0].as_py() == 5001
