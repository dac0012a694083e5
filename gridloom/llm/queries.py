"""The operators as registered queries, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gridloom.llm.common import read


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gridloom.llm.line_dedup import line_dedup

    return line_dedup(read(spark, sf_dir, "documents"))


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gridloom.llm.embedding_dedup import vector_groups

    return vector_groups(read(spark, sf_dir, "embeddings"), t=0.9)


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gridloom.llm.quality import classify

    return classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from gridloom.llm.bpe import encode

    return encode(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gridloom.llm.toxicity import toxicity

    return toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gridloom.llm.pii import find_pii

    return find_pii(read(spark, sf_dir, "documents"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gridloom.llm.exact_dedup import exact_groups

    return exact_groups(read(spark, sf_dir, "documents"))


def op8_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gridloom.llm.suffix_dedup import repeated_passages

    return repeated_passages(read(spark, sf_dir, "documents"))


def op9_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gridloom.llm.jaccard import near_groups

    return near_groups(read(spark, sf_dir, "documents"), k=3, t=(90, 100))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gridloom.llm.mixing import label_weights, mix

    return mix(read(spark, sf_dir, "documents"), label_weights(read(spark, sf_dir, "labels")))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_line_dedup, op2_embedding_dedup, op3_quality_classifier, op4_byte_bpe, op5_toxicity, op6_pii, op7_exact_dedup, op8_suffix_array, op9_ngram_jaccard, op10_mixing)}


def oracle_sql() -> dict[str, str]:
    from gridloom.llm import embedding_dedup, jaccard
    from gridloom.llm.exact_dedup import EXACT_SQL
    from gridloom.llm.line_dedup import LINE_SQL
    from gridloom.llm.mixing import MIX_SQL

    return {"op1_line_dedup": LINE_SQL, "op2_embedding_dedup": embedding_dedup.PAIRS_SQL, "op9_ngram_jaccard": jaccard.PAIRS_SQL, "op7_exact_dedup": EXACT_SQL, "op10_mixing": MIX_SQL}
