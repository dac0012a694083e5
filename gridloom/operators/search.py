"""Suggestions: names that hold all words, merged lists, and the closest keys of a mistyped one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from gridloom.functions.tags import folded
from gridloom.functions.text import UNIT_PREFIX, compact, confusable, norm
from gridloom.operators.entities import osa_distance
from gridloom.session import ship


def _grams(c: Column, n: int) -> Column:
    return F.when(F.length(c) >= n, F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(c) - n + 1), lambda p: F.substring(c, p, F.lit(n))))).otherwise(F.array().cast("array<string>"))


def name_suggest(queries: DataFrame, index: DataFrame, k: int, least: int = 3) -> DataFrame:
    """queries (q), index (key, name) -> q, key, name, position: names that hold every word of the query, case aside. A query meets names by the first `least`
    characters of its longest word; queries that have none of that length suggest nothing."""
    words = F.filter(F.split(norm(F.col("q")), " "), lambda w: w != "")
    lead = F.aggregate(words, F.lit(""), lambda a, w: F.when(F.length(w) > F.length(a), w).otherwise(a))
    q = queries.select("q").distinct().withColumn("_w", words).withColumn("_g", F.substring(lead, 1, least)).where(F.length("_g") == least)
    names = index.select("key", "name", F.upper("name").alias("_n")).distinct().withColumn("_g", F.explode(_grams(F.upper("name"), least)))
    hit = names.join(q, "_g").where(F.forall("_w", lambda w: F.contains(F.col("_n"), w))).select("q", "key", "name").distinct()
    return hit.withColumn("position", F.row_number().over(W.partitionBy("q").orderBy("key", "name"))).where(F.col("position") <= k)


def merged(items: DataFrame, k: int) -> DataFrame:
    """items (q, key, scope, position) -> q, key, scopes, n, slot: keys that are equal without signs come once, as the first of them is written, with their scopes in order of
    appearance; k at most."""
    c = compact(F.col("key"))
    each = items.groupBy("q", c.alias("_c"), "scope").agg(F.min("position").alias("at"), F.min_by("key", "position").alias("key"), F.count(F.lit(1)).alias("n"))
    one = each.groupBy("q", "_c").agg(F.min("at").alias("at"), F.min_by("key", "at").alias("key"), F.sum("n").alias("n"), F.array_sort(F.collect_list(F.struct("at", "scope"))).alias("x"))
    slot = F.row_number().over(W.partitionBy("q").orderBy("at", "key"))
    return one.withColumn("slot", slot).where(F.col("slot") <= k).select("q", "key", F.array_join(F.transform("x", lambda x: x["scope"]), "／").alias("scopes"), "n", "slot")


def _cuts(c: Column, most: int) -> Column:
    """The text and what is left of it without any one character, or (most = 2) any two."""
    less = lambda s: F.transform(F.sequence(F.lit(1), F.length(s)), lambda p: F.concat(F.substring(s, F.lit(1), p - 1), F.substring(s, p + 1, F.length(s))))
    one = F.when(F.length(c) > 0, less(c)).otherwise(F.array().cast("array<string>"))
    out = F.concat(F.array(c), one)
    if most > 1:
        out = F.concat(out, F.flatten(F.transform(F.filter(one, lambda s: F.length(s) > 0), less)))
    return F.array_distinct(out)


def fuzzy(queries: DataFrame, index: DataFrame, k: int) -> DataFrame:
    """queries (q), index (key) -> q, key, dc, d, slot: the closest keys of a query that is no key, k at most.

    dc is the distance with characters that look alike taken as one, d the plain one; dc may be 1, or 2 where nine characters or more are compared without the
    unit's prefix. Only the nearest tier of dc is given, by d, then key. Keys of digits alone count for queries of digits alone, from six digits on. Texts
    within two edits share one of what is left of them without two characters, so queries meet keys in an equi-join.
    """
    ship(queries.sparkSession)
    text = folded(F.col("q"))
    q = queries.select("q", compact(text).alias("_q")).distinct().where((F.length("_q") >= 4) & ~text.rlike("[぀-ヿ㐀-鿿豈-﫿]"))
    q = q.withColumn("_wide", F.when(F.length(F.regexp_replace("_q", UNIT_PREFIX + "(?:90)?", "")) >= 9, 2).otherwise(1))
    keys = index.select("key").distinct().withColumn("_k", compact(F.col("key"))).where(F.length("_k") >= 4)
    asked = q.withColumn("_cut", F.explode(F.when(F.col("_wide") == 2, _cuts(confusable(F.col("_q")), 2)).otherwise(_cuts(confusable(F.col("_q")), 1))))
    offered = keys.withColumn("_cut", F.explode(_cuts(confusable(F.col("_k")), 2)))
    digits = lambda c: F.col(c).rlike("^[0-9]+$")
    met = asked.join(offered, "_cut").where((F.abs(F.length("_q") - F.length("_k")) <= F.col("_wide")) & (F.col("_q") != F.col("_k")) & (~digits("_k") | (digits("_q") & (F.length("_k") >= 6)))).select("q", "_q", "_wide", "key", "_k").distinct()
    met = met.withColumn("dc", osa_distance(confusable(F.col("_q")), confusable(F.col("_k")), 2)).where(F.col("dc") <= F.col("_wide")).withColumn("d", osa_distance(F.col("_q"), F.col("_k"), 5))
    best = met.withColumn("_top", F.min("dc").over(W.partitionBy("q"))).where(F.col("dc") == F.col("_top"))
    return best.withColumn("slot", F.row_number().over(W.partitionBy("q").orderBy("d", "key"))).where(F.col("slot") <= k).select("q", "key", "dc", "d", "slot")


def most_trusted(hits: DataFrame, most: int = 4000) -> DataFrame:
    """The hits of the most trusted documents, `most` of them."""
    return hits.orderBy(F.desc("trust"), "doc", "page").limit(most)
