"""The text operators as registered queries, and SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltmart.llm import (
    bpe,
    html,
    licenses,
    lm,
    nra,
    packing,
    quality,
    rules,
    simhash,
    substrings,
    topk,
    trie,
    vectors,
)
from voltmart.session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(sql: str | None = None):
    def add(build):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(lambda name: tune(spark).read.parquet(f"{sf_dir}/{name}.parquet"))

        QUERIES[build.__name__] = run
        if sql:
            ORACLES[build.__name__] = sql
        return run

    return add


@register()
def op1_simhash(table) -> DataFrame:
    return simhash.near_duplicates(table("documents"))


def tokenizer_file() -> str:
    """The tokenizer of the contract; its files are installed on every executor, never copied here."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@register()
def op2_packing(table) -> DataFrame:
    return packing.pack_documents(table("documents"), tokenizer_file())


@register(
    """
    WITH v AS (
      SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS q FROM embeddings
      WHERE embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), s AS (
      SELECT a.vec_id AS query_id, b.vec_id, list_inner_product(a.q, b.q)::BIGINT AS score
      FROM v a, v b WHERE a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id
    )
    SELECT query_id, rank, vec_id, score FROM (
      SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s
    ) WHERE rank <= 20
    """
)
def op3_topk(table) -> DataFrame:
    rows = table("embeddings")
    return topk.top_products(rows, rows.where(F.col("vec_id") % 20 == 0))


@register()
def op4_lm(table) -> DataFrame:
    return lm.score_documents(table("documents"))


@register()
def op5_html(table) -> DataFrame:
    return html.extract_pages(table("pages"))


@register()
def op6_quality(table) -> DataFrame:
    return quality.score_table(table("documents"), table("labels"))


@register()
def op7_substrings(table) -> DataFrame:
    return substrings.removal_digests(table("documents"))


@register()
def op8_bpe(table) -> DataFrame:
    return bpe.encoding_digests(table("documents"), tokenizer_file())


@register()
def op9_vectors(table) -> DataFrame:
    return vectors.near_vectors(table("embeddings"))


@register(licenses.oracle())
def op10_licenses(table) -> DataFrame:
    return licenses.scan(table("documents"))


@register(rules.oracle())
def op11_rules(table) -> DataFrame:
    return rules.judge(table("documents")).drop("lang", "source", "n_lines")


@register(nra.oracle())
def op12_nra(table) -> DataFrame:
    return nra.rank_documents(table("documents"), table("benchmark"))


@register(trie.oracle())
def op13_trie(table) -> DataFrame:
    return trie.prefix_trie(table("conversations"))
