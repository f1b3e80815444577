"""Near-duplicate documents by SimHash, found through the anchors of a covering code.

Fingerprints of 64 bits link at two or fewer differing bits. The anchors are the code words of two
binary Golay codes side by side, on bits 0-22 and 23-45: every 23-bit word lies within 3 bits (the
covering radius) of exactly one Golay word. A fingerprint's home is its nearest anchor. If x and y
differ in e1 and e2 bits of the two fields, e1 + e2 <= 2, then y lies within 3 + e1 and 3 + e2 bits of
x's home, so y is sent to all anchors within the covering radius plus the threshold, spread over the
two fields: 61 anchors of 16.8 million on average. Each anchor compares its home fingerprints with
those sent to it, so that each pair is found once, at the home of its smaller fingerprint.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from voltmart.llm.common import components, map_documents
from voltmart.session import cut_lineage

# The generator polynomial of the binary Golay code and its parameters.
GOLAY_POLYNOMIAL = 0b110001110101
GOLAY_BITS, GOLAY_CHECKS, GOLAY_RADIUS = 23, 11, 3

THRESHOLD = 2
SHINGLE_WORDS = 3
HASH_SEED = 42
CHUNK = 1 << 16  # shingles whose bits are counted at once


def simhash(text: bytes, words: int = SHINGLE_WORDS) -> int:
    """The fingerprint of one text, unsigned. No words: zero."""
    parts = text.lower().split()  # on bytes: A-Z only, and exactly the ASCII white space
    if not parts:
        return 0
    digest = xxhash.xxh64_intdigest
    joined = b" ".join(parts)
    if len(parts) < words:
        return digest(joined, HASH_SEED)
    lengths = np.fromiter(map(len, parts), np.int64, len(parts))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths).tolist()
    ends = ends[words - 1 :].tolist()
    total = len(ends)
    counts = np.zeros(64, np.int64)
    for low in range(0, total, CHUNK):
        high = min(low + CHUNK, total)
        hashes = np.fromiter(
            (digest(joined[a:b], HASH_SEED) for a, b in zip(starts[low:high], ends[low:high])),
            np.uint64,
            high - low,
        )
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > total, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, text) -> (doc_id, fp), fp being the fingerprint as a signed long. Null text: empty."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [simhash(t.encode() if t else b"", words) for t in batch["text"]]
            yield pd.DataFrame(
                {"doc_id": batch["doc_id"], "fp": np.array(found, np.uint64).view(np.int64)}
            )

    return map_documents(docs, run, "fp long")


@cache
def golay_patterns() -> pd.DataFrame:
    """All error patterns up to the covering radius plus the threshold, by syndrome.

    level: by how many bits a pattern exceeds the covering radius, 0 within it. 44,552 rows, built from
    the polynomial; the size is fixed by the code, not by the data.
    """
    unit = _unit_syndromes()
    rows = []
    for weight in range(GOLAY_RADIUS + THRESHOLD + 1):
        for places in combinations(range(GOLAY_BITS), weight):
            pattern = syndrome = 0
            for place in places:
                pattern |= 1 << place
                syndrome ^= unit[place]
            rows.append((syndrome, pattern, max(0, weight - GOLAY_RADIUS)))
    return pd.DataFrame(rows, columns=["syndrome", "pattern", "level"])


def _unit_syndromes() -> list[int]:
    """The remainder of each power of x modulo the polynomial."""
    remainder, found = 1, []
    for _ in range(GOLAY_BITS):
        found.append(remainder)
        remainder <<= 1
        if remainder >> GOLAY_CHECKS:
            remainder ^= GOLAY_POLYNOMIAL
    return found


def _syndrome(word: Column) -> Column:
    unit = _unit_syndromes()
    total = F.lit(0).cast("long")
    for check in range(GOLAY_CHECKS):
        mask = sum(1 << place for place in range(GOLAY_BITS) if unit[place] >> check & 1)
        parity = F.bit_count(word.bitwiseAND(F.lit(mask))).cast("long").bitwiseAND(F.lit(1))
        total = total + F.shiftleft(parity, check)
    return total


def _anchored(spark: SparkSession, prints: DataFrame, reach: int) -> DataFrame:
    """(fp) -> (fp, anchor) for all anchors within the covering radius and `reach` more bits."""
    table = F.broadcast(
        spark.createDataFrame(golay_patterns(), "syndrome long, pattern long, level int").where(
            F.col("level") <= reach
        )
    )
    width, mask = GOLAY_BITS, (1 << GOLAY_BITS) - 1
    field = lambda n: F.shiftrightunsigned(F.col("fp"), n * width).bitwiseAND(F.lit(mask))
    named = lambda n: table.select(
        F.col("syndrome").alias(f"s{n}"), F.col("pattern").alias(f"p{n}"), F.col("level").alias(f"l{n}")
    )
    return (
        prints.select("fp", _syndrome(field(0)).alias("s0"), _syndrome(field(1)).alias("s1"))
        .join(F.broadcast(named(0)), "s0")
        .join(F.broadcast(named(1)), "s1")
        .where(F.col("l0") + F.col("l1") <= reach)
        .select(
            "fp",
            field(0)
            .bitwiseXOR(F.col("p0"))
            .bitwiseOR(F.shiftleft(field(1).bitwiseXOR(F.col("p1")), width))
            .alias("anchor"),
        )
    )


def near_prints(prints: DataFrame) -> DataFrame:
    """Distinct fingerprints (fp) -> all pairs (a, b), a < b, with at most THRESHOLD differing bits."""
    spark = prints.sparkSession
    home = _anchored(spark, prints, 0).select(F.col("fp").alias("a"), "anchor")
    sent = _anchored(spark, prints, THRESHOLD).select(F.col("fp").alias("b"), "anchor")
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= THRESHOLD
    return home.join(sent, "anchor").where((F.col("a") < F.col("b")) & near).select("a", "b")


def keep_one(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """One document of each group of near copies, with all columns of docs: the one of smallest doc_id, of
    several texts under that doc_id the one of smallest MD5 digest. Rows without a doc_id come after all others.
    Rows of the same doc_id and different texts are documents of their own: each belongs to its text's group.
    Of rows equal in doc_id and text one stays, chosen by a hash of its other columns."""
    kind = docs.schema["doc_id"].dataType
    known = F.coalesce(F.concat(F.lit("v"), F.col("doc_id").cast("string")), F.lit("n"))
    key = F.concat(known, F.md5(F.coalesce("text", F.lit(""))))
    prints, rooted = _rooted(docs.select(key.alias("doc_id"), "text"), words)
    named = prints.join(rooted, "fp").select("root", F.col("doc_id").alias("key"))
    held = F.when(F.col("key").startswith("v"), F.expr("substring(key, 2, length(key) - 33)").cast(kind))
    first = F.min(F.struct(held.isNull().alias("absent"), held.alias("held"), "key"))
    chosen = named.groupBy("root").agg(first.alias("first")).select(F.col("first.key").alias("_key"))
    rest = F.xxhash64(*[F.col(f"`{c}`").cast("string") for c in docs.columns])
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    rows = docs.select(key.alias("_key"), rest.alias("_rest"), row).join(chosen, "_key", "left_semi")
    order = Window.partitionBy("_key").orderBy("_rest")
    return rows.withColumn("_place", F.row_number().over(order)).where("_place = 1").select("_row.*")


def near_duplicates(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, text, ...) -> (doc_id, fingerprint, component_id), one row per row of docs.

    A text's fingerprint has a bit set if over half of its shingles' XXH64 have it, repeats included;
    fewer words than a shingle: the whole sequence is the one shingle; no words, empty or null text:
    zero, and all such documents link. Equal fingerprints form one class before anything is compared, so
    copies cost no pairs. component_id is the smallest doc_id reachable by links. Rows with the same
    doc_id are separate documents. Null doc_ids are not candidates for component_id. Columns of docs
    other than doc_id and text are not looked at.
    """
    prints, rooted = _rooted(docs, words)
    smallest = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    named = cut_lineage(rooted.join(smallest, "root").select("fp", "component_id"), "named")
    return prints.join(named, "fp").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def _rooted(docs: DataFrame, words: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, fp) of every document, and (fp, low, root) of every fingerprint, root being its group's name."""
    prints = cut_lineage(fingerprints(docs, words), "fingerprints")
    classes = cut_lineage(prints.groupBy("fp").agg(F.min("doc_id").alias("low")), "classes")
    reached = components(near_prints(classes.select("fp")))
    rooted = classes.join(reached.withColumnRenamed("node", "fp"), "fp", "left")
    return prints, rooted.select("fp", "low", F.coalesce("root", "fp").alias("root"))
