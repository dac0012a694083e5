"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Sources in code point order, null last, weigh 1, 2, 3, repeating, and share all words; a target stops at
MAX_EPOCHS times its source's words and the excess is reshared by weight, which is the water level
min(3 * size, level * weight). A source first gives its complete epochs; the rest of its target comes from
documents in order of exponential keys, -ln(u) / quality, ascending, as long as the prefix sum stays within it. What is then still
open goes, FILLS times over, to that of the other documents whose size is nearest to it (ties by key), where it brings the
sum nearer the target: so a source of a few long documents meets its target too. u is a hash of the id, so reruns agree.

Prefix sums never put a source into one task: keys are cut into BINS ranges, a source's sums are added range by
range (at most BINS rows a source), and the one range on the edge is cut again; only documents of the last
range are ordered one by one.

Null text has size 0 and takes nothing; a null id is hashed as the word null; null quality counts as 1. Rows
that repeat an id tie and are taken by text hash order, each by itself. An empty table gives an empty result. Extra columns
are not looked at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from gridloom.llm.common import keep

MAX_EPOCHS = 3
BINS = 2048
SEED = "mix"
#: Documents a source may take besides the prefix, to fill what it leaves open.
FILLS = 3
#: Sources whose figures are broadcast; beyond this many a shuffle join is used.
BROADCAST_SOURCES = 50_000


def source_targets(sizes: DataFrame) -> DataFrame:
    """sizes (source, source_size) with target; a row for each source, so one task can order them."""
    all_ = W.partitionBy(F.lit(0))
    s = sizes.withColumn("w", (F.row_number().over(all_.orderBy(F.col("source").asc_nulls_last())) - 1) % 3 + 1)
    s = s.withColumn("cap", F.lit(MAX_EPOCHS) * F.col("source_size")).withColumn("full_at", F.col("cap") / F.col("w"))
    up = all_.orderBy("full_at", F.col("source").asc_nulls_last())
    s = s.withColumn("rest", F.sum("source_size").over(all_) - F.coalesce(F.sum("cap").over(up.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    s = s.withColumn("w_rest", F.sum("w").over(up.rowsBetween(W.currentRow, W.unboundedFollowing)))
    # the level is right at the first source that doesn't fill up under it
    s = s.withColumn("level", F.min(F.when(F.col("rest") / F.col("w_rest") <= F.col("full_at"), F.struct("full_at", (F.col("rest") / F.col("w_rest")).alias("level")))).over(all_)["level"])
    return s.select("source", "source_size", F.least(F.col("cap").cast("double"), F.col("level") * F.col("w")).alias("target"))


def _edge(sums: DataFrame, by: list[str], bin_: str) -> DataFrame:
    """For each source the bin in which the running sum passes what is wanted (need), and the sum before it."""
    w = W.partitionBy(*by).orderBy(bin_).rowsBetween(W.unboundedPreceding, -1)
    s = sums.withColumn("before", F.coalesce(F.sum("words").over(w), F.lit(0)))
    return s.where((F.col("before") < F.col("need")) & (F.col("before") + F.col("words") >= F.col("need")))


def mix(docs: DataFrame, quality: DataFrame | None = None, seed: str = SEED) -> DataFrame:
    """doc_id, size, source_size, target, taken, epochs, picked. quality: (doc_id, weight) for some of the ids."""
    u = (F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))), 1, 12), 16, 10).cast("long") + 0.5) / F.lit(float(1 << 48))
    rows = docs.select("doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long").alias("size"), F.xxhash64("text").alias("tie"), u.alias("u"))
    if quality is not None:
        rows = rows.join(quality.groupBy(F.col("doc_id").alias("_q")).agg(F.max("weight").alias("weight")), F.col("doc_id") == F.col("_q"), "left").drop("_q")
    else:
        rows = rows.withColumn("weight", F.lit(1.0))
    # 1 - u^(1/w) orders as -ln(u) / w does, and lies between 0 and 1
    rows = keep(rows.withColumn("key", 1 - F.pow("u", 1 / F.coalesce("weight", F.lit(1.0)))).select("doc_id", "source", "size", "tie", "key").withColumn("row", F.monotonically_increasing_id()))
    targets = keep(source_targets(rows.groupBy("source").agg(F.sum("size").alias("source_size"))))
    targets = targets.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0))
    targets = targets.withColumn("need", F.col("target") - F.col("epochs") * F.col("source_size"))
    few = targets.count() <= BROADCAST_SOURCES
    small = (lambda d: F.broadcast(d)) if few else (lambda d: d)
    on = lambda a, b: a.join(small(b.withColumnRenamed("source", "_s")), F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s")
    fine = F.floor(F.col("key") * BINS * BINS).cast("long")
    rows = rows.withColumn("bin", F.floor(fine / BINS).cast("int")).withColumn("sub", (fine % BINS).cast("int"))
    first = _edge(on(rows.groupBy("source", "bin").agg(F.sum("size").alias("words")), targets.select("source", "need")), ["source"], "bin")
    first = keep(first.select("source", F.col("bin").alias("edge_bin"), F.col("before").alias("before_bin"), "need"))
    inside = on(rows, first).where("bin = edge_bin")
    second = _edge(inside.groupBy("source", "sub", "before_bin").agg(F.sum("size").alias("words"), F.first("need").alias("need0")).withColumn("need", F.col("need0") - F.col("before_bin")), ["source"], "sub")
    second = keep(second.select("source", F.col("sub").alias("edge_sub"), (F.col("before") + F.col("before_bin")).alias("before_sub")))
    edges = keep(on(on(targets, first.drop("need")), second))
    last = on(rows, edges.select("source", "need", "edge_bin", "edge_sub", "before_sub")).where("bin = edge_bin AND sub = edge_sub")
    here = F.struct("key", F.coalesce(F.col("doc_id"), F.lit((1 << 63) - 1)).alias("id"), "tie", "row")
    order = W.partitionBy("source").orderBy("key", F.col("doc_id").asc_nulls_last(), "tie", "row")
    last = last.withColumn("upto_sum", F.col("before_sub") + F.sum("size").over(order.rowsBetween(W.unboundedPreceding, W.currentRow))).where(F.col("upto_sum") <= F.col("need"))
    last = last.groupBy("source").agg(F.max(here).alias("upto"), F.max("upto_sum").alias("upto_sum"))
    edges = on(edges, last).withColumn("rest", F.col("need") - F.coalesce("upto_sum", "before_sub"))
    below = (F.col("bin") < F.col("edge_bin")) | ((F.col("bin") == F.col("edge_bin")) & (F.col("sub") < F.col("edge_sub")))
    at = (F.col("bin") == F.col("edge_bin")) & (F.col("sub") == F.col("edge_sub")) & (here <= F.col("upto"))
    picked = F.coalesce(F.col("need") > 0, F.lit(False)) & F.coalesce(below | at, below, F.lit(False))
    # what the prefix leaves open goes to the document that comes nearest to it, and so on
    fills = []
    for i in range(FILLS):
        edges = keep(edges)
        free = on(rows, edges).where((F.col("size") > 0) & ~picked & (F.abs(F.col("size") - F.col("rest")) < F.col("rest")))
        for f in fills:
            free = free.where(~F.coalesce(F.col("row") == F.col(f), F.lit(False)))
        best = free.groupBy("source").agg(F.min(F.struct(F.abs(F.col("size") - F.col("rest")).alias("gap"), *(here[c].alias(c) for c in ("key", "id", "tie", "row")), "size")).alias("best"))
        edges = on(edges, best.select("source", F.col("best.row").alias(f"fill{i}"), F.col("best.size").alias("fill_size"))).withColumn("rest", F.col("rest") - F.coalesce("fill_size", F.lit(0))).drop("fill_size")
        fills.append(f"fill{i}")
    filled = F.greatest(*(F.coalesce((F.col("row") == F.col(f)).cast("int"), F.lit(0)) for f in fills)) == 1
    out = on(rows, keep(edges)).withColumn("picked", picked | filled).withColumn("epochs", F.col("epochs").cast("int"))
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * (F.col("epochs") + F.col("picked").cast("int"))).alias("taken"), "epochs", "picked")


def label_weights(labels: DataFrame) -> DataFrame:
    """Quality weights for mix(): 2 for rows labelled good, 0.5 for rows labelled bad."""
    return labels.select("doc_id", F.when(F.col("quality") > 0, 2.0).otherwise(0.5).alias("weight"))


MIX_SQL = r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    (('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, 'null')), 1, 12))::BIGINT + 0.5::DOUBLE) / 281474976710656::DOUBLE AS u FROM documents),
q AS (SELECT doc_id, CASE WHEN quality > 0 THEN 2.0 ELSE 0.5 END::DOUBLE AS weight FROM labels),
k AS (SELECT d.*, 1 - pow(u, 1 / coalesce(weight, 1::DOUBLE)) AS key FROM d LEFT JOIN q USING (doc_id)),
s AS (SELECT source, sum(size)::BIGINT AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w FROM d GROUP BY source),
c AS (SELECT *, 3 * source_size AS cap, 3 * source_size / w::DOUBLE AS full_at FROM s),
r AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY full_at, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
    / (sum(w) OVER (ORDER BY full_at, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS lv FROM c),
t AS (SELECT source, source_size, least(cap::DOUBLE, (SELECT arg_min(lv, full_at) FROM r WHERE lv <= full_at) * w) AS target FROM r),
e AS (SELECT source, source_size, target, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs FROM t),
o AS (SELECT k.doc_id, k.source, k.key, k.size, e.source_size, e.target, e.epochs, e.target - e.epochs * e.source_size AS need,
    sum(size) OVER (PARTITION BY k.source ORDER BY key, doc_id ROWS UNBOUNDED PRECEDING) AS upto FROM k JOIN e ON k.source IS NOT DISTINCT FROM e.source),
p AS (SELECT *, need > 0 AND upto <= need AS picked, need - coalesce(max(upto) FILTER (upto <= need) OVER (PARTITION BY source), 0) AS rest0 FROM o),
f0 AS (SELECT *, NOT picked AND size > 0 AND abs(size - rest0) < rest0 AND row_number() OVER (PARTITION BY source ORDER BY picked OR size = 0, abs(size - rest0), key, doc_id) = 1 AS a0 FROM p),
r0 AS (SELECT *, rest0 - coalesce(max(size) FILTER (a0) OVER (PARTITION BY source), 0) AS rest1 FROM f0),
f1 AS (SELECT *, NOT (picked OR a0) AND size > 0 AND abs(size - rest1) < rest1 AND row_number() OVER (PARTITION BY source ORDER BY picked OR a0 OR size = 0, abs(size - rest1), key, doc_id) = 1 AS a1 FROM r0),
r1 AS (SELECT *, rest1 - coalesce(max(size) FILTER (a1) OVER (PARTITION BY source), 0) AS rest2 FROM f1),
f2 AS (SELECT *, NOT (picked OR a0 OR a1) AND size > 0 AND abs(size - rest2) < rest2 AND row_number() OVER (PARTITION BY source ORDER BY picked OR a0 OR a1 OR size = 0, abs(size - rest2), key, doc_id) = 1 AS a2 FROM r1)
SELECT doc_id, size, source_size, target, (size * (epochs + (picked OR a0 OR a1 OR a2)::INT))::BIGINT AS taken, epochs::INT AS epochs, picked OR a0 OR a1 OR a2 AS picked FROM f2
"""
