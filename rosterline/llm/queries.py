"""Registered queries of the training-data operators, and their SQL where it exists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterline.llm import (
    decontamination,
    jaccard_join,
    language,
    lexical,
    multiset_hash,
    packing,
    pivot_dedup,
    secrets,
    sharding,
    substring_dedup,
    toxicity,
    warc,
    whitening,
)
from rosterline.llm.common import read_table

QueryFn = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, QueryFn] = {}
_ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def keep(fn: QueryFn) -> QueryFn:
        _QUERIES[name] = fn
        if sql:
            _ORACLE[name] = sql
        return fn

    return keep


def pack_publicly(docs: DataFrame) -> DataFrame:
    """Packing by the public 50k byte-level vocabulary."""
    import public_tokenizers as public

    ranks = (public.path("byte_bpe_50k.tiktoken"), public.PATTERN)
    return packing.pack(docs, public.path("byte_bpe_50k.json"), ranks)


def queries() -> dict[str, QueryFn]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLE)


@register("op1_substring_dedup")
def _op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.dedup(read_table(spark, sf_dir, "documents"), with_text=False)
    return out.select("doc_id", "n_words", "n_removed", "kept_sha256")


@register("op2_secret_scan", secrets.scan_sql())
def _op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(read_table(spark, sf_dir, "documents"))


@register("op3_pu_toxicity")
def _op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.score(docs, toxicity.learn(docs, read_table(spark, sf_dir, "labels")))


@register("op4_multiset_fingerprint", multiset_hash.compare_edited_sql())
def _op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multiset_hash.compare_edited(read_table(spark, sf_dir, "documents"))


@register("op5_hilbert_sharding")
def _op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    text = F.coalesce(F.col("text"), F.lit(""))
    size = F.octet_length(text).cast("long") + 1
    out = sharding.hilbert_shards(
        docs,
        {"lang": sharding.category_cell("lang"), "source": sharding.category_cell("source"), "size": sharding.size_cell(size)},
        8,
        {"doc_id": F.col("doc_id"), "size": size, "text_crc32": F.crc32(text.cast("binary"))},
        [F.xxhash64(text), F.col("doc_id")],
    )
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "curve_index",
    )


@register("op6_warc_source")
def _op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(read_table(spark, sf_dir, "pages"))


@register("op7_jaccard_join")
def _op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = jaccard_join.join_components(read_table(spark, sf_dir, "documents"), n=3, percent=90)
    return out.select("doc_id", "n_shingles", "component_id")


@register("op8_hierarchical_packing")
def _op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_publicly(read_table(spark, sf_dir, "documents"))


@register("op9_benchmark_decontamination", decontamination.find_sql())
def _op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


@register("op10_language_id")
def _op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    return language.predict(docs, language.learn(docs))


@register("op11_bit_sliced_whitening")
def _op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read_table(spark, sf_dir, "embeddings"))


@register("op12_lexical_search", lexical.search_sql())
def _op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


@register("op13_pivot_dedup")
def _op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_dedup.near_duplicates(read_table(spark, sf_dir, "embeddings"))
