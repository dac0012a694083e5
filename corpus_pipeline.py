"""A training corpus from documents: junk out, exact copies out, near copies out, sources mixed, texts encoded.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; all but the last return the columns of documents, whatever others
these have. Null text is kept as it is and counts as empty; rows without an id pass the joins on ids as one document. Rows that repeat an id and a text
become one at the second stage, and so do equal texts; ties go to the smaller id. An empty table gives an empty result. Results agree from run to run.
"""

from __future__ import annotations

from functools import partial

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm.bpe import encode
from gridloom.llm.common import read, release, settled, unused
from gridloom.llm.exact_dedup import exact_dedup
from gridloom.llm.jaccard import near_dedup
from gridloom.llm.mixing import label_weights, mix
from gridloom.llm.quality import accepted_documents


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the importance-resampling classifier accepts."""
    return accepted_documents(docs, read(spark, sf_dir, "labels"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five words, similarity 0.8)."""
    return near_dedup(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as many times as the mix takes it; those that it does not take go."""
    id_, n, copy = (unused(docs, c) for c in ("_id", "_n", "_copy"))
    taken = mix(docs, label_weights(read(spark, sf_dir, "labels"))).select(F.col("doc_id").alias(id_), (F.col("epochs") + F.col("picked").cast("int")).alias(n))
    # rows of one id share what their source takes; ids are distinct after the stages before
    taken = taken.where(F.col(n) > 0).groupBy(id_).agg(F.max(n).alias(n))
    out = docs.join(taken, F.col("doc_id").eqNullSafe(F.col(id_)))
    return out.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(n)))).select(*(F.col(f"`{c}`") for c in docs.columns))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document (little-endian unsigned 32 bits each), with digests of the ids and of the decoded text."""
    return encode(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, with_ids=True)


STAGES = [
    ("quality classifier", quality_classifier),
    ("exact dedup", exact_copies),
    ("n-gram Jaccard join", near_copies),
    ("mixing sources to target weights", mixed_sources),
    ("byte-level BPE encoding", encoded),
]

#: The classifier and the joins have no SQL; tests/llm holds run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each one's output is written as Parquet and read again."""
    docs = read(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES[:-1]):
        last, docs = docs, settled(partial(stage, spark, docs, sf_dir))
        if i:
            release(last)
    return STAGES[-1][1](spark, docs, sf_dir)
