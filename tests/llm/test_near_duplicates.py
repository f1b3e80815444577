"""SimHash groups, vector groups and exact search, against brute force on small tables."""

import itertools
import math

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from voltmart.llm import common, simhash, topk, vectors


def roots(ids, pairs):
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in pairs:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def fingerprint(text, words=3):
    parts = (text or "").encode().lower().split()
    shingles = [b" ".join(parts[i : i + words]) for i in range(len(parts) - words + 1)]
    shingles = shingles or ([b" ".join(parts)] if parts else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


WORDS = [f"w{i}" for i in range(60)]


def texts():
    rng = np.random.default_rng(7)
    base = [" ".join(rng.choice(WORDS, 300)) for _ in range(12)]
    near = []
    for text in base[:6]:
        parts = text.split()
        for place in (0, 150, 299):
            near.append(" ".join([*parts[:place], "new", *parts[place + 1 :]]))
    odd = [None, "", "  \t\n", "one", "One", "two words", "ÀB c", "long " * 70_000, base[0], base[0].upper()]
    return base + near + odd


def test_simhash_against_brute_force(spark):
    rows = [(i, t, "x", i) for i, t in enumerate(texts())]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string, root long")
    prints = {i: fingerprint(t) for i, t, *_ in rows}
    near = [(a, b) for a, b in itertools.combinations(prints, 2) if (prints[a] ^ prints[b]).bit_count() <= 2]
    expected = roots(prints, near)
    got = simhash.near_duplicates(docs).collect()
    assert {r.doc_id: r.fingerprint for r in got} == {i: f"{p:016x}" for i, p in prints.items()}
    assert {r.doc_id: r.component_id for r in got} == expected
    assert len(set(expected.values())) < len(expected) - 5


def test_anchors_meet_every_pair_within_two_bits(spark):
    rng = np.random.default_rng(3)
    base = rng.integers(-(2**63), 2**63 - 1, 40)
    flipped = set(base.tolist())
    for value in base.tolist():
        for a, b in itertools.combinations(rng.choice(64, 6, replace=False).tolist(), 2):
            bits = (value & (2**64 - 1)) ^ (1 << a) ^ (1 << b)
            flipped.add(bits - 2**64 if bits >= 2**63 else bits)
    prints = spark.createDataFrame([(v,) for v in flipped], "fp long")
    expected = {
        (a, b)
        for a, b in itertools.combinations(sorted(flipped), 2)
        if ((a ^ b) & (2**64 - 1)).bit_count() <= 2
    }
    assert sorted(map(tuple, simhash.near_prints(prints).collect())) == sorted(expected)


def test_every_word_has_one_home():
    patterns = simhash.golay_patterns()
    assert len(patterns) == sum(math.comb(23, k) for k in range(6))
    homes = patterns[patterns.level == 0].groupby("syndrome").size()
    assert len(homes) == 2048 and (homes == 1).all()


def test_one_document_of_each_group_stays(spark):
    rows = [(5, "a b c d e f", "x"), (3, "a b c d e f", "y"), (3, "a b c d e f", "y"), (9, None, "z"),
            (8, "", "z"), (None, "g h i j k l", "n"), (None, "g h i j k l", "n"), (None, "a b c d e f", "n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    kept = sorted(map(tuple, simhash.keep_one(docs).collect()), key=str)
    assert kept == [(3, "a b c d e f", "y"), (8, "", "z"), (None, "g h i j k l", "n")]


def test_different_texts_under_one_doc_id_all_stay(spark):
    rows = [(1, "quick brown fox jumps", 5), (1, "lorem ipsum dolor sit amet", 6), (2, "lorem ipsum dolor sit amet", 7),
            (1, "Quick brown fox jumps", 8), (10, "over the lazy dog", 9), (2, "over the lazy dog", 10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp int")
    kept = sorted(simhash.keep_one(docs).select("doc_id", F.lower("text")).collect())
    assert [tuple(r) for r in kept] == [(1, "lorem ipsum dolor sit amet"), (1, "quick brown fox jumps"), (2, "over the lazy dog")]
    again = sorted(simhash.keep_one(docs.repartition(5)).collect())
    assert again == sorted(simhash.keep_one(docs.coalesce(1)).collect())


def test_stage_keeps_one_of_each_component(spark):
    rows = [(i, t, "x", i) for i, t in enumerate(texts())]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string, root long")
    groups = {r.component_id for r in simhash.near_duplicates(docs).collect()}
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted(groups)


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(docs).count() == 0 and simhash.keep_one(docs).count() == 0
    rows = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert vectors.near_vectors(rows).count() == 0
    assert topk.top_products(rows, rows).count() == 0


@pytest.mark.parametrize("shape", ["path", "star", "mixed"])
def test_components(spark, shape):
    rng = np.random.default_rng(5)
    edges = {
        "path": [(i, i + 1) for i in range(120)],
        "star": [(500, i) for i in range(200)] + [(700, 701)],
        "mixed": [tuple(p) for p in rng.integers(0, 300, (200, 2)).tolist()],
    }[shape]
    nodes = {n for a, b in edges if a != b for n in (a, b)}
    got = common.components(spark.createDataFrame([*edges, (None, 3)], "a long, b long")).collect()
    assert {r.node: r.root for r in got} == {n: r for n, r in roots({n for e in edges for n in e}, edges).items() if n in nodes}


def clustered(n=260, length=8):
    rng = np.random.default_rng(11)
    centres = rng.normal(size=(9, length))
    rows = centres[rng.integers(0, 9, n)] + 0.35 * rng.normal(size=(n, length))
    rows[5] = rows[6] = rows[7]
    rows[8] = 3 * rows[7]
    return rows


def test_vector_groups_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(vectors, "INTERVAL", 16)
    monkeypatch.setattr(vectors, "LEAF", 4)
    data = clustered()
    labels = [None if i % 41 == 0 else i % 3 for i in range(len(data))]
    rows = [(i, [float(x) for x in v], lab, "x") for i, (v, lab) in enumerate(zip(data, labels))]
    n = len(rows)
    odd = [None, [], [0.0] * 8, [None] * 8, [math.nan] + [1.0] * 7, [math.inf] + [1.0] * 7, [1.0, 1.0], [2.0, 2.0]]
    rows += [(n + i, v, 1, "x") for i, v in enumerate(odd)]
    rows.append((n + 100, rows[7][1], rows[7][2], "again"))
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, links string")
    usable = [r for r in rows if r[2] is not None and r[1] and all(x is not None and math.isfinite(x) for x in r[1])
              and any(r[1])]
    linked = []
    for a, b in itertools.combinations(usable, 2):
        if a[2] == b[2] and len(a[1]) == len(b[1]):
            x, y = np.array(a[1]), np.array(b[1])
            if x @ y / math.sqrt((x @ x) * (y @ y)) >= 0.93:
                linked.append((a[0], b[0]))
    component = roots([r[0] for r in rows], linked)
    count = {r[0]: 0 for r in rows}
    for pair in linked:
        for i in pair:
            count[i] += 1
    got = {r.vec_id: r for r in vectors.near_vectors(frame).collect()}
    assert len(linked) > 150
    assert {i: r.n_links for i, r in got.items()} == count
    assert {i: r.component_id for i, r in got.items()} == component
    assert all(r.kept == (i == r.component_id) for i, r in got.items())


@pytest.mark.parametrize("blocks", [3, 4096])
def test_top_products_against_brute_force(spark, monkeypatch, blocks):
    monkeypatch.setattr(topk, "SHARD", 24)
    data = clustered(150) / 4
    rows = [(i, [float(x) for x in v], 1) for i, v in enumerate(data)]
    rows += [(200, None, 1), (220, [math.nan] * 8, 1), (240, [None] * 8, 1), (260, rows[20][1], 1), (261, rows[20][1], 1),
             (300, [0.0] * 8, 1), (320, [1e7] * 8, 1), (None, rows[20][1], 1), (2**60 + 4, [0.5] * 8, 1), (400, [0.25] * 5, 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score int")
    found = topk.top_products(frame, frame.where((F.col("vec_id") % 20 == 0) | F.col("vec_id").isNull()), 7, block=blocks)
    usable = {i: [math.floor(64 * x) for x in v] for i, v, _ in rows
              if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    got = {}
    for r in found.collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    for q in (i for i in usable if i % 20 == 0):
        scores = sorted((-sum(a * b for a, b in zip(usable[q], v)), i) for i, v in usable.items() if i != q)
        wanted = [(i, -s) for s, i in scores]
        mine = [(v, s) for _, v, s in sorted(got[q])]
        assert mine == wanted[:7]


def test_max_score_probes_less_than_everything():
    """With a score to beat, a shard of far candidates is left at once, and essential postings leave most out."""
    rng = np.random.default_rng(2)
    rows = np.floor(rng.normal(size=(2000, 6)) * 20 * np.array([8, 4, 1, 1, 1, 1]))
    shard = topk.Shard(np.arange(2000), rows)
    query = np.floor(rng.normal(size=6) * 64)
    scores = rows @ query
    kth = np.sort(scores)[-5]
    alive, found = topk.max_score(query, -1, shard, 5, float(kth))
    assert set(np.flatnonzero(scores >= kth)) <= set(alive) and len(alive) < 50
    assert (scores[alive] == found).all()
    assert len(topk.max_score(query, -1, shard, 5, float(scores.max()) * 10 + 1e9)[0]) == 0
    for k in (1, 7, 5000):
        alive, found = topk.max_score(query, 3, shard, k, -np.inf)
        mine = sorted(zip(-found, alive))[:k]
        assert mine == sorted((-s, i) for i, s in enumerate(scores) if i != 3)[:k]


@pytest.mark.parametrize("scales, alone", [([1] * 12, False), ([40, 1, 1, 1, 1, 1], True)])
def test_queries_of_a_group_share_the_pass_over_a_shard(monkeypatch, scales, alone):
    """Where postings are traversed nearly whole no query goes through the shard by itself; where they are short each
    does. Both find the best of every query, ties, repeated ids and other lengths included."""
    rng = np.random.default_rng(4)
    rows = np.floor(rng.normal(size=(900, len(scales))) * 20 * np.array(scales))
    rows[100:160] = rows[40:100]
    ids = rng.permutation(900)
    ids[:30] = ids[30:60]
    shard = topk.Shard(ids, rows)
    queries, owns = np.floor(rng.normal(size=(40, len(scales) + 1)) * 30), ids[rng.integers(0, 900, 40)]
    scores = queries[:, : len(scales)] @ rows.T
    calls, once = [], topk.max_score
    monkeypatch.setattr(topk, "max_score", lambda *a: calls.append(1) or once(*a))
    for k, floors in ((1, None), (7, None), (2000, None), (7, 0), (7, 5), (7, 10**9)):
        best = np.sort(scores, axis=1)[:, -7]
        beat = np.full(40, -np.inf) if floors is None else best + floors
        calls.clear()
        at, alive, found = topk.max_scores(queries, owns, shard, k, beat)
        assert (found == scores[at, alive]).all()
        of, values, keys = topk._merge(at, found, ids[alive], k)
        for q in range(40):
            wanted = sorted((-s, i) for i, s in zip(ids, scores[q]) if i != owns[q] and s >= beat[q])[:k]
            mine = [(-v, i) for v, i in zip(values[of == q], keys[of == q]) if v >= beat[q]]
            assert mine == wanted
        if floors in (0, 5):
            assert (len(calls) > 20) == alone and (not calls or alone)


def test_null_and_repeated_ids_of_vectors(spark):
    a, b, c = [1.0, 0.0], [0.999, 0.01], [0.0, 1.0]
    rows = [(1, a, 1), (2, b, 1), (1, c, 2), (3, [0.01, 0.999], 2), (None, b, 1), (None, c, 3), (None, [0.5, -0.5], 4), (7, None, 1), (None, None, None)]
    got = vectors.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    found = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in got), key=str)
    assert found == sorted([(1, 2, 1, True), (2, 2, 1, False), (1, 1, 1, True), (3, 1, 1, False), (None, 2, 1, False),
                            (None, 0, None, True), (None, 0, None, True), (7, 0, 7, True), (None, 0, None, True)], key=str)
