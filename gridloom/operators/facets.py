"""Facets: value counts, and live counts under all other filters in one scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W


#: Fixed value: what stands for blank cells in a facet.
BLANK = "∅"


def facet_counts(df: DataFrame, column: str, options: list[str] = (), order: list[str] = ()) -> DataFrame:
    """value, n, place; blanks as ∅, last and only where there are any. Values of a declared order come first in it, options after what was found; both appear with 0."""
    value = F.coalesce(F.nullif(F.col(column).cast("string"), F.lit("")), F.lit(BLANK))
    got = df.groupBy(value.alias("value")).agg(F.count(F.lit(1)).alias("n"))
    listed = list(dict.fromkeys([*order, *options]))
    if listed:
        rows = df.sparkSession.createDataFrame([(v, i if v in order else None, i) for i, v in enumerate(listed)], "value string, first int, late int")
        got = got.join(rows, "value", "full")
    else:
        got = got.withColumn("first", F.lit(None).cast("int")).withColumn("late", F.lit(None).cast("int"))
    rank = F.when(F.col("value") == BLANK, 3).when(F.col("first").isNotNull(), 0).when(F.col("n").isNotNull(), 1).otherwise(2)
    # one row a value of a facet
    place = F.row_number().over(W.partitionBy(F.lit(0)).orderBy(rank, F.coalesce("first", F.when(F.col("n").isNull(), F.col("late"))), "value"))
    return got.select("value", F.coalesce("n", F.lit(0)).cast("long").alias("n"), place.alias("place"))


def live_facets(df: DataFrame, predicates: dict[str, Column], facets: list[str]) -> DataFrame:
    """facet, value, n: each facet counted over rows that pass all filters but its own. A row counts for a facet if
    no filter fails, or if the facet's own is the only one that does; so one scan and one aggregation serve all facets."""
    fail = {k: ~F.coalesce(p, F.lit(False)) for k, p in predicates.items()}
    fails = sum((f.cast("int") for f in fail.values()), F.lit(0))
    only = F.coalesce(*(F.when(f, F.lit(k)) for k, f in fail.items()), F.lit("")) if fail else F.lit("")
    rows = df.select(fails.alias("_fails"), only.alias("_only"), F.explode(F.array(*(F.struct(F.lit(c).alias("facet"), F.coalesce(F.col(c).cast("string"), F.lit("")).alias("value")) for c in facets))).alias("x"))
    rows = rows.where((F.col("_fails") == 0) | ((F.col("_fails") == 1) & (F.col("_only") == F.col("x.facet"))))
    return rows.groupBy("x.facet", "x.value").agg(F.count(F.lit(1)).alias("n"))


def auto_facets(df: DataFrame, most: int = 40, columns: int = 8) -> DataFrame:
    """column, n_unique of text columns worth a facet: more than one and at most `most` values in a table of more than 20 rows; the first `columns` of them."""
    text = [c for c, t in df.dtypes if t == "string"]
    counts = df.agg(F.count(F.lit(1)).alias("_rows"), *(F.count_distinct(c).alias(c) for c in text)).where("_rows > 20")
    long = counts.select(F.explode(F.array(*(F.struct(F.lit(i).alias("i"), F.lit(c).alias("column"), F.col(c).alias("n_unique")) for i, c in enumerate(text)))).alias("x")).select("x.*")
    return long.where(F.col("n_unique").between(2, most)).orderBy("i").limit(columns).select("column", "n_unique")


def profile(df: DataFrame) -> DataFrame:
    """column, n_rows, n_blank, n_numeric, n_text, max_len: a class mix of every column in one aggregation."""
    from gridloom.functions.text import NUMERIC, is_blank

    one = []
    for c in df.columns:
        s = F.col(c).cast("string")
        blank, numeric = is_blank(F.col(c)), F.coalesce(s.rlike(NUMERIC), F.lit(False))
        one.append(F.struct(F.lit(c).alias("column"), F.count(F.lit(1)).alias("n_rows"), F.count_if(blank).alias("n_blank"), F.count_if(numeric).alias("n_numeric"), F.count_if(~blank & ~numeric).alias("n_text"), F.coalesce(F.max(F.length(s)), F.lit(0)).cast("long").alias("max_len")).alias(f"_{c}"))
    return df.agg(*one).select(F.explode(F.array(*(f"_{c}" for c in df.columns))).alias("x")).select("x.*")
