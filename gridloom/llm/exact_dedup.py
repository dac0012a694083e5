"""Exact dedup by skew-safe combining.

Texts are equal when identical after every space and 0x09-0x0D is deleted. Combining runs in three steps, each
grouping by digest AND full normalised content, so a digest collision never merges two texts:
within a task (partial aggregation), over salted digest groups, then over the winners of the salts. A group
of any number of copies reaches the last step as at most SALTS rows. Members then learn their winner by digest
alone where one digest has one content, by content where it has several.

Null text counts as empty. A null id is an id like any other, and loses ties. Rows that repeat an id and a text
are members like others: each counts in group_size, and every row that carries the winner's id has kept = true, as
rows of one id cannot be told apart in the result; exact_dedup() keeps one of them, the longest. An empty table gives an empty
result. Other columns of the input are not looked at, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import keep, unused

#: Salts of a digest group.
SALTS = 16


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), " \t\n\x0b\x0c\r", "")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256; a row for each row of docs."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.length(F.coalesce(F.col(text_col), F.lit(""))).alias("len"), normalised(F.col(text_col)).alias("norm")).withColumn("digest", F.sha2("norm", 256))
    # the best row is the greatest of one number (fixed width, so hash aggregation can hold it):
    # most code points first, then the smallest id, null last
    rank = F.col("len").cast("decimal(38,0)") * F.expr(f"{1 << 65}BD") + F.coalesce(F.expr(f"{1 << 63}BD - doc_id"), F.expr("0BD"))
    salted = (
        rows.select("digest", "norm", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).alias("salt"), rank.cast("decimal(38,0)").alias("rank"))
        .groupBy("digest", "salt", "norm")
        .agg(F.max("rank").alias("rank"), F.count(F.lit(1)).alias("n"))
    )
    whole = salted.groupBy("digest", "norm").agg(F.max("rank").alias("rank"), F.sum("n").alias("n"))
    # which of the contents of a digest this is: 0 unless digests collide, so the text itself need not be kept
    per_digest = whole.groupBy("digest").agg(F.count(F.lit(1)).alias("contents"), F.max("rank").alias("rank"), F.max("n").alias("n"))
    won = keep(per_digest)
    one = won.where("contents = 1").select("digest", "rank", F.col("n").alias("group_size"))
    out = rows.select("doc_id", "digest").join(one, "digest")
    if not won.where("contents > 1").isEmpty():  # never yet seen for SHA-256
        many = whole.join(won.where("contents > 1").select("digest"), "digest", "left_semi")
        out = out.unionByName(rows.select("doc_id", "digest", "norm").join(many.select("digest", "norm", "rank", F.col("n").alias("group_size")), ["digest", "norm"]).drop("norm"))
    low = F.col("rank") % F.expr(f"{1 << 65}BD")
    keep_id = F.when(low > 0, (F.expr(f"{1 << 63}BD") - low).cast("long"))
    return out.select("doc_id", keep_id.alias("keep_id"), "group_size", F.col("digest").alias("text_sha256")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id"))).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def exact_dedup(docs: DataFrame) -> DataFrame:
    """The rows of docs that stay, all columns as they are. Of rows repeated with their id one stays. An id that stands for several texts stays
    with those of them that win."""
    id_, n, kept, digest = (unused(docs, c) for c in ("_id", "_n", "_kept", "_digest"))
    groups = keep(exact_groups(docs).select(F.col("doc_id").alias(id_), F.col("kept").alias(kept), F.col("text_sha256").alias(digest)))
    ids = keep(groups.groupBy(id_).agg(F.count(F.lit(1)).alias(n), F.max(kept).alias(kept)).where(kept))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(id_))
    out = docs.join(ids.where(F.col(n) == 1).select(id_), same, "left_semi")
    several = ids.where(F.col(n) > 1).select(id_)
    if not several.isEmpty():
        again = docs.join(several, same, "left_semi").withColumn(digest, F.sha2(normalised(F.col("text")), 256))
        won = groups.where(kept).select(id_, F.col(digest).alias(n)).distinct()
        again = again.join(won, same & (F.col(digest) == F.col(n)), "left_semi")
        longest = F.max_by(F.struct(*(F.col(f"`{c}`") for c in docs.columns)), F.coalesce(F.length("text"), F.lit(0))).alias(kept)
        out = out.unionByName(again.groupBy(F.col("doc_id").alias(id_), digest).agg(longest).select(f"{kept}.*"))
    return out


EXACT_SQL = r"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS len, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents),
g AS (SELECT doc_id, norm, first_value(doc_id) OVER (PARTITION BY norm ORDER BY len DESC, doc_id) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size FROM d)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM g
"""
