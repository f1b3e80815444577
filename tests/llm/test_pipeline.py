"""The pipeline's stages, one after the other, against the same steps in plain Python."""

import itertools
import random

from test_near_duplicates import fingerprint, roots
from test_texts import packed_ids
from tokenizers import Tokenizer

import corpus_pipeline
from voltmart.llm import quality
from voltmart.llm.queries import tokenizer_file


def corpus(sf_dir):
    import pandas as pd

    docs = pd.read_parquet(f"{sf_dir}/documents.parquet").head(60)
    rows = [tuple(r) for r in docs[["doc_id", "text", "lang", "source", "n_chars"]].itertuples(index=False)]
    dice = random.Random(2)
    passage = " ".join(f"passage{dice.randrange(10**6)}" for _ in range(40))
    filler = lambda n: " ".join(f"w{dice.randrange(10**5)}" for _ in range(n))
    for i in range(6):
        rows.append((10_000 + i, f"{filler(60)} {passage} {filler(60)}", "en", "made", 0))
    rows += [(20_000, rows[-1][1], "en", "made", 0), (20_001, rows[-1][1].upper(), "en", "made", 0), (20_002, passage, "en", "made", 0)]
    return rows


def stripped(texts):
    raw = [t.encode() for t in texts]
    seen = {}
    for text in raw:
        for i in range(len(text) - 199):
            seen[text[i : i + 200]] = seen.get(text[i : i + 200], 0) + 1
    out = []
    for text in raw:
        gone = bytearray(len(text))
        for i in range(len(text) - 199):
            if seen[text[i : i + 200]] > 1:
                gone[i : i + 200] = b"\x01" * 200
        out.append(bytes(b for b, g in zip(text, gone) if not g))
    return out


def test_stages_against_plain_steps(spark, tmp_path):
    rows = corpus("/root/testdata/sf0.001")
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    frame = spark.createDataFrame(rows, schema)
    frame.write.parquet(str(tmp_path / "documents.parquet"))
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    labels.write.parquet(str(tmp_path / "labels.parquet"))

    good = quality.keep_good(frame, labels).collect()  # learned: the stages after it are checked
    ids = list(range(len(good)))
    prints = [fingerprint(r.text) for r in good]
    pairs = [(a, b) for a, b in itertools.combinations(ids, 2) if (prints[a] ^ prints[b]).bit_count() <= 2]
    groups = {}
    for i, root in roots(ids, pairs).items():
        groups.setdefault(root, []).append(good[i])
    kept = sorted((min(g, key=lambda r: r.doc_id) for g in groups.values()), key=lambda r: r.doc_id)
    assert len(kept) < len(good)
    left = stripped([r.text for r in kept])
    assert sum(map(len, left)) < sum(len(r.text.encode()) for r in kept)
    library = Tokenizer.from_file(tokenizer_file())

    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "near_duplicates", "repeated_text", "packing"]
    docs = frame
    for name, stage in corpus_pipeline.STAGES[:3]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == frame.columns
        if name == "near_duplicates":
            assert sorted(r.doc_id for r in docs.collect()) == [r.doc_id for r in kept]
    clean = {r.doc_id: r.text for r in docs.collect()}
    whole = {r.doc_id: raw for r, raw in zip(kept, left) if raw}
    cut = {k: v for k, v in whole.items() if len(v) != len(next(r.text for r in kept if r.doc_id == k).encode())}
    assert set(clean) <= {r.doc_id for r in kept} and set(clean) >= {k for k in whole if k not in cut}
    assert all(clean[k] == v.decode() for k, v in whole.items() if k not in cut)

    packed = corpus_pipeline.run(spark, str(tmp_path)).toPandas()
    assert set(packed["doc_id"]) == set(clean)
    for doc_id, part in packed.groupby("doc_id"):
        total = len(packed_ids(library, clean[doc_id])) // 4 + 1
        assert part["length"].sum() == total and (part["doc_tokens"] == total).all()


def test_empty_tables_pass_through(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([], schema).write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet("/root/testdata/sf0.001/labels.parquet").write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


