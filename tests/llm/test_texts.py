"""Encoding, packing, language-model scores, repeated strings, quality, licences on small tables."""

import collections
import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from voltmart.llm import bpe, licenses, lm, packing, quality, substrings
from voltmart.llm.license_texts import NOTICES, TEXTS
from voltmart.llm.queries import tokenizer_file

SCHEMA = "doc_id long, text string, key string, copy string"


def odd_texts():
    rng = random.Random(1)
    letters = " \n\t  ab'sreé1２9!?.ßñ🎉　\x85ᲉAZ"
    made = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 80))) for _ in range(150)]
    return made + [None, "", " ", "  ", "\n", "x" * 3000, "ab" * 4000, "a<|endoftext|>  b  <|endoftext|>", "the end " * 9000]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokenizer_file())


@pytest.fixture
def odd(spark):
    rows = [(i, t, "k", "c") for i, t in enumerate(odd_texts())]
    rows += [(3, rows[3][1], "k", "c"), (None, "no id at all", "k", "c"), (2**60 + 1, "large id", "k", "c")]
    return rows, spark.createDataFrame(rows, SCHEMA)


def packed_ids(library, text):
    return np.array(library.encode(text or "", add_special_tokens=False).ids, "<u4").tobytes()


def test_encoding_equals_the_library(odd, library):
    rows, docs = odd
    got = sorted(bpe.encoding_digests(docs, tokenizer_file()).collect(), key=str)
    expected = []
    for key, text, *_ in rows:
        ids = packed_ids(library, text)
        decoded = library.decode(np.frombuffer(ids, "<u4").tolist(), skip_special_tokens=False)
        expected.append((key, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
    assert [tuple(r) for r in got] == sorted(expected, key=lambda r: str(next(g for g in got if tuple(g) == r)))


def test_automaton_shares_suffixes_and_finds_all_words(tmp_path):
    words = {w.encode(): [n, n + 1] for n, w in enumerate(["tap", "taps", "top", "tops", "a", "é"])}
    path = tmp_path / "lexicon.bin"
    path.write_bytes(bpe.compile_lexicon(words))
    lexicon = bpe.Lexicon(str(path))
    asked = [*words, b"", b"ta", b"tapss", b"z"]
    found = lexicon.look_up(asked)
    assert (found[len(words):] == -1).all()
    ids = [np.frombuffer(x, "<u4").tolist() for x in lexicon.outputs(found[: len(words)])]
    assert ids == list(words.values())
    assert len(lexicon.final) < 9  # tap(s) and top(s) share their ends
    empty = tmp_path / "empty.bin"
    empty.write_bytes(bpe.compile_lexicon({}))
    assert bpe.Lexicon(str(empty)).look_up([b"a", b""]).tolist() == [-1, -1]


def test_words_merged_side_by_side_equal_single_ones():
    vocabulary = bpe._vocabulary(tokenizer_file())
    rng = random.Random(8)
    pieces = [" the", "straße", "internationalisation", "été", "aaaa", "0" * 64, "z" * 65, "ab" * 500, "\x00\x01", "🎉🎉"]
    pieces += ["".join(rng.choice("etaoins rhldcué") for _ in range(rng.randint(1, 70))) for _ in range(3000)]
    words = [p.encode() for p in pieces]
    expected = [np.array(vocabulary.merge(w), "<u4").tobytes() for w in words]
    assert vocabulary.merge_all(words) == expected
    assert vocabulary.merge_all([]) == []
    for piece in (" word", " word.", "word", " 12.", " a.b", " ..", " été!", " don't", " "):
        assert vocabulary.cut(piece, piece.encode()) == vocabulary.split(piece)


def test_the_lexicon_is_shipped_once_and_its_words_are_bounded(spark):
    docs = spark.createDataFrame([(i, "some words come again and again, others once: " + "x" * i) for i in range(90)], "doc_id long, text string")
    first = bpe.ship_lexicon(docs, tokenizer_file())
    files = set(spark.sparkContext.listFiles)
    assert bpe.ship_lexicon(docs, tokenizer_file()) == first
    assert set(spark.sparkContext.listFiles) == files
    words = bpe.frequent_words(docs, 5)
    assert 0 < len(words) <= 5 and set(words) <= {"some", " words", " come", " again", " and", " again,", " others", " once:"} or not words
    assert bpe.frequent_words(docs, 10_000) and all(len(w.encode()) <= bpe.LONG_WORD for w in bpe.frequent_words(docs, 10_000))
    assert len(bpe.frequent_words(docs, 20)) <= 20


def test_splitting_only_differs_on_characters_newer_than_the_tables(library):
    import unicodedata

    splitter, rng = library.pre_tokenizer, random.Random(2)
    for code in [*range(0x3000), *rng.sample(range(0x3000, 0x110000), 3000)]:
        if not 0xD800 <= code < 0xE000 and unicodedata.category(chr(code)) != "Cn":
            text = f"a{chr(code)}1{chr(code)} {chr(code)}  "
            assert len(splitter.pre_tokenize_str(text)) == len(bpe.splitter().findall(text)), hex(code)


def test_packing_places_every_id_once(odd, library):
    rows, docs = odd
    pieces = packing.pack_documents(docs, tokenizer_file()).toPandas()
    by_sequence = pieces.sort_values(["sequence_id", "offset"]).groupby("sequence_id")
    assert by_sequence["length"].sum().max() <= 1024
    for _, part in by_sequence:
        assert (part["offset"] == part["length"].cumsum() - part["length"]).all()
    # Cut anew from what the library gives, the pieces are the same ones.
    expected = collections.Counter()
    for key, text, *_ in rows:
        ids, start = packed_ids(library, text) + bytes(4), 0
        for length in packing.cut_lengths(len(ids) // 4):
            crc = zlib.crc32(ids[4 * start : 4 * (start + length)])
            expected[key, start, length, crc, len(ids) // 4] += 1
            start += length
        assert start == len(ids) // 4
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    found = packing.pack_documents(docs, tokenizer_file()).select(*columns).collect()
    assert collections.Counter(map(tuple, found)) == expected


def test_windows_are_near_equal():
    rng = random.Random(3)
    sizes = [rng.randint(1, 900) for _ in range(400)]
    windows = packing.karmarkar_karp(sizes, 50)
    sums = np.bincount(windows, sizes)
    assert sums.max() - sums.min() < 40
    found = packing.pack(sizes)
    assert np.bincount(found, sizes).max() <= 1024 and found.max() + 1 <= 1.1 * sum(sizes) / 1024 + 1
    assert packing.pack([]).tolist() == [] and packing.pack([1024] * 3).tolist() in ([0, 1, 2], [2, 1, 0], [0, 2, 1], [1, 0, 2], [1, 2, 0], [2, 0, 1])


def model(rows):
    """The definition, token by token."""
    texts = [(k, [*(t or "").encode().lower().split(), None]) for k, t, *_ in rows]
    held = [lm.held_out(None if k is None else str(k)) for k, _ in texts]
    c1, c2 = collections.Counter(), collections.Counter()
    for (_, t), out in zip(texts, held):
        if not out:
            c1.update(t)
            c2.update(zip([None, *t], t))
    types, n, v, d = collections.Counter(a for a, _ in c2), sum(c1.values()), len(c1), lm.DISCOUNT

    def word(w):
        return (c1[w] - d) / n if c1[w] else d * v / n

    def after(h, w):
        return max(c2[h, w] - d, 0) / c1[h] + d * types[h] / c1[h] * word(w) if c1[h] else word(w)

    return [
        (k, out, len(t), sum(c1[w] > 0 for w in t), n,
         sum(math.log10((c1[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t),
         sum(math.log10(after(h, w)) for h, w in zip([None, *t], t)))
        for (k, t), out in zip(texts, held)
    ]


@pytest.mark.parametrize("block, keys", [(1 << 22, 1 << 21), (300, 200)])
def test_scores_against_the_definition(spark, monkeypatch, block, keys):
    monkeypatch.setattr(lm, "BLOCK_TOKENS", block)
    monkeypatch.setattr(lm, "RANGE_KEYS", keys)
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice("ab cd EF gh ij kl".split()) for _ in range(rng.randint(0, 40))), "k", "c") for i in range(80)]
    rows += [(100, None, "k", "c"), (101, "", "k", "c"), (None, "ab never", "k", "c"), (7, rows[7][1], "k", "c"), (8, "x" * 500_000, "k", "c")]
    got = lm.score_documents(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    order = lambda rs: sorted(rs, key=lambda r: (str(r[0]), r[2], round(r[6], 6)))
    for mine, wanted in zip(order(got), order(model(rows)), strict=True):
        assert tuple(mine)[:5] == wanted[:5]
        assert tuple(mine)[5:] == pytest.approx(wanted[5:], abs=1e-8)


def test_probabilities_of_a_state_add_up_to_one():
    block = lm.Block(["0", "2"], np.array([4, 3]), np.array([1, 2, 1, 0, 2, 2, 0]), np.arange(3, dtype=np.uint64))
    block.held = np.array([False, False])
    block.count()
    types = np.bincount(block.first, minlength=3)
    d, n = lm.DISCOUNT, 7
    words = [(c - d) / n for c in block.c1] + [d * 3 / n]
    assert sum(words) == pytest.approx(1)
    for state in range(3):
        seen = {w: c for h, w, c in zip(block.first, block.second, block.c2) if h == state}
        arcs = sum(max(seen.get(w, 0) - d, 0) / block.c1[state] for w in range(3))
        assert arcs + d * types[state] / block.c1[state] * sum(words) == pytest.approx(1)


def test_traversal_follows_arcs_and_failure_arcs():
    """Hand-made: the arc where there is one, else the failure arc and the arc of the empty history."""
    tokens, lengths = np.array([1, 2, 0, 1, 1, 0, 3, 0, 0]), np.array([3, 3, 2, 1])
    block = lm.Block(["0", "2", "3", "4"], lengths, tokens, np.arange(4, dtype=np.uint64))
    block.held = np.array([False, False, True, True])
    block.count()
    types = np.bincount(block.first[block.c2 > 0], minlength=4)
    d, n = lm.DISCOUNT, 6
    word = lambda w: (block.c1[w] - d) / n if block.c1[w] else d * 3 / n
    count = {(a, b): c for a, b, c in zip(block.first, block.second, block.c2)}
    fail = lambda h: d * types[h] / block.c1[h]
    arc = lambda h, w: (count[h, w] - d) / block.c1[h] + fail(h) * word(w)
    automaton = lm.Automaton(block, block.c1, block.c2, types, n, 3)
    got = automaton.read(tokens, lengths)
    assert got[0] == pytest.approx(math.log10(arc(0, 1) * arc(1, 2) * arc(2, 0)))
    assert got[1] == pytest.approx(math.log10(arc(0, 1) * arc(1, 1) * arc(1, 0)))
    # An unknown word by the failure arc of the start; from the empty history then the end token.
    assert got[2] == pytest.approx(math.log10(fail(0) * word(3) * word(0)))
    assert got[3] == pytest.approx(math.log10(fail(0) * word(0)))
    assert automaton.read(np.zeros(0, np.int64), np.zeros(0, np.int64)).tolist() == []


def removed(rows, length):
    counts = collections.Counter()
    raws = [(k, (t or "").encode()) for k, t, *_ in rows]
    for _, raw in raws:
        counts.update(raw[i : i + length] for i in range(len(raw) - length + 1))
    out = []
    for key, raw in raws:
        gone = np.zeros(len(raw), bool)
        for i in range(len(raw) - length + 1):
            if counts[raw[i : i + length]] > 1:
                gone[i : i + length] = True
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((key, len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def repeating_rows():
    rng = random.Random(6)
    make = lambda n: "".join(rng.choice("abcdefgh é\n") for _ in range(n))
    shared, rows = [make(260), make(199), make(200), make(700)], []
    for i in range(40):
        parts = [make(rng.randint(0, 300))]
        for passage in rng.sample(shared, rng.randint(0, 3)):
            low = rng.randint(0, 80)
            parts += [passage[low : len(passage) - rng.randint(0, 60)], make(rng.randint(0, 50))]
        rows.append("".join(parts))
    rows += [rows[0], rows[1], None, "", "a" * 199, "b" * 200, "c" * 201, "d" * 900, make(30) * 20, shared[3][:350] + "#" + shared[3][351:]]
    return [(i, t, "k", "c") for i, t in enumerate(rows)]


def test_repeated_strings_against_brute_force(spark):
    rows = repeating_rows()
    rows += [rows[5], (None, rows[9][1], "k", "c"), (5, "another text of the same id", "k", "c")]
    got = substrings.removal_digests(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()
    assert collections.Counter(map(tuple, got)) == collections.Counter(removed(rows, substrings.LENGTH))


def test_stripped_documents_keep_their_columns(spark):
    copy = "word and more of it é " * 20
    rows = [(1, copy, "en", 400), (2, copy, "en", 400), (3, "own words", "en", 9), (4, None, "en", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row string, n_chars long")
    got = sorted(map(tuple, substrings.strip_repeated(docs).collect()))
    assert [r[0] for r in got] == [3, 4] and got[0] == (3, "own words", "en", 9) and got[1][1:] == ("", "en", 0)


def test_empty_tables(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert bpe.encoding_digests(docs, tokenizer_file()).count() == 0
    assert packing.pack_documents(docs, tokenizer_file()).count() == 0
    assert lm.score_documents(docs).count() == 0
    assert substrings.removal_digests(docs).count() == 0 and substrings.strip_repeated(docs).count() == 0
    assert licenses.scan(docs).count() == 0
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert quality.score_table(docs, labels).count() == 0


def test_quality_separates_junk_and_ignores_held_out_labels(spark):
    rng = random.Random(8)
    words = "river stone garden letter window summer morning bread table light".split()
    rows, labels = [], []
    for i in range(400):
        n = rng.randint(5, 60)
        text = " ".join(rng.choice(words) for _ in range(n)).capitalize() + "."
        bad = i % 5 == 0
        rows.append((i, text.upper().replace(" ", "!! ") if bad else text, "k", "c"))
        held = zlib.crc32(str(i).encode()) % 4 == 2
        labels.append((i, int(bad) if held else int(not bad), 1))  # turned around where nobody may look
    labels += [(None, 1, 1), (3, None, 1)]
    rows += [(1000, None, "k", "c"), (1001, "", "k", "c"), (None, "a sentence.", "k", "c"), (1002, "y " * 300_000, "k", "c")]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = quality.score_table(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    judged = [r for r in got if r.doc_id is not None and r.doc_id < 400]
    assert all(r.predicted == (r.doc_id % 5 != 0) for r in judged)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in judged)
    good = quality.keep_good(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert good.columns == docs.columns


def test_quality_without_labels_rejects_nothing(spark):
    docs = spark.createDataFrame([(1, "text", "k", "c"), (2, None, "k", "c")], SCHEMA)
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.predicted for r in quality.score_table(docs, none).collect()} == {1}


def test_licences(spark):
    mit = dict(TEXTS)["MIT"]
    notice = NOTICES[0][1]
    british = mit.replace("sublicense", "sub-licence").upper()
    rows = [(1, "Copyright (c) 2020 A. Author\n\n" + british), (2, mit + " and more"), (3, f"Text.\n  {notice.lower()}\nMore."),
            (4, None), (5, ""), (6, "SPDX-License-Identifier: MIT\nReleased under the MIT Licence"), (1, "x"),
            (None, notice), (7, "word " * 50_000)]
    docs = spark.createDataFrame([(k, t, "k", "c") for k, t in rows], SCHEMA)
    got = {(r.doc_id, r.license, r.notices) for r in licenses.scan(docs).collect()}
    assert got == {(1, "MIT", ""), (2, None, ""), (3, None, "Apache-2.0"), (4, None, ""), (5, None, ""), (6, None, "MIT"),
                   (1, None, ""), (None, None, "Apache-2.0"), (7, None, "")}


def test_whole_long_licences_and_given_notices(spark):
    rows = [(i, open(f"/usr/share/common-licenses/{f}", encoding="utf-8").read()) for i, f in enumerate(["Apache-2.0", "GPL-2", "GPL-3", "LGPL-2.1", "LGPL-3", "MPL-2.0", "CC0-1.0"])]
    rows += [(10, rows[0][1][: rows[0][1].index("APPENDIX")]), (11, rows[2][1].upper()), (12, rows[2][1][:-200]), (13, "Some text\nfree for ANY use.\nmore")]
    docs = spark.createDataFrame([(k, t, "k", "c") for k, t in rows], SCHEMA)
    got = {r.doc_id: r.license for r in licenses.scan(docs).collect()}
    assert got == {0: "Apache-2.0", 1: "GPL-2.0-only", 2: "GPL-3.0-only", 3: "LGPL-2.1-only", 4: "LGPL-3.0-only", 5: "MPL-2.0",
                   6: "CC0-1.0", 10: "Apache-2.0", 11: "GPL-3.0-only", 12: None, 13: None}
    given = spark.createDataFrame([("Free", "Free for any use")], "license string, text string")
    assert {r.doc_id: r.notices for r in licenses.scan(docs, notices=given).collect()}[13] == "Free"


def test_known_notices_carry_a_hint():
    assert all(any(h in text.lower() for h in licenses.HINTS) or "cc" in text.lower() for _, text in NOTICES)
