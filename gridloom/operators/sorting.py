"""Sorting as the tables do it: numbers, then texts in natural order, blanks last whatever the direction; custom orders, proxy keys, pinned rows, pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from gridloom.functions.text import natural_key
from gridloom.session import kept

#: Fixed value: a text that sorts as a number.
_NUMBER = r"^\s*-?\d+(\.\d+)?\s*$"


def sort_key(c: Column, values: list[str] | None = None) -> tuple[Column, Column, Column]:
    """kind (0 number, 1 text, 2 blank), number and text of a cell. values: an order of its own, in which the listed ones stand first by their place and others follow in
    natural order."""
    s = c.cast("string")
    blank = s.isNull() | (s == "")
    if values is not None:
        place = F.array_position(F.array(*map(F.lit, values)), s)
        known = place > 0
        number = F.when(known, place.cast("double"))
    else:
        known = s.rlike(_NUMBER)
        number = F.when(known, F.trim(s).try_cast("double"))
    return F.when(blank, 2).when(known, 0).otherwise(1), number, F.when(~known & ~blank, natural_key(s))


def order_by(df: DataFrame, column: str, tie: list[str], descending: bool = False, values: list[str] | None = None, proxy: str | None = None, pinned: Column | None = None) -> list[Column]:
    """Columns to order by: pinned rows (subtotals) last in their own order, then the column's cells, or those of the proxy that stands for it. Ties keep the order of tie, in
    both directions."""
    kind, number, text = sort_key(F.col(f"`{proxy or column}`"), None if proxy else values)
    way = (lambda c: c.desc_nulls_last()) if descending else (lambda c: c.asc_nulls_last())
    out = [way(F.when(kind < 2, kind)), way(number), way(text)]
    if pinned is not None:
        held = F.coalesce(pinned, F.lit(False))
        out = [F.when(held, 1).otherwise(0), *(way(F.when(~held, c)) for c in (F.when(kind < 2, kind), number, text))]
    return [*out, *map(F.col, tie)]


def page(df: DataFrame, keys: list[Column], first: int, rows: int) -> DataFrame:
    """The rows that a window onto the sorted table shows, with their position from 1. The top of the order is kept while sorting, nothing beyond it is."""
    top = df.orderBy(*keys).limit(first + rows)  # first + rows of them
    return top.withColumn("position", F.row_number().over(W.orderBy(*keys))).where(F.col("position") > first)


def reindexed(df: DataFrame, keys: list[str], name: str = "row_index") -> DataFrame:
    """df with its rows' numbers from 0 in the order of keys that tell all rows apart, range by range; so no task gets them all."""
    rows = kept(df.repartitionByRange(*keys).withColumn("_range", F.spark_partition_id()))
    sizes = {r: n for r, n in rows.groupBy("_range").count().collect()}  # as many rows as ranges
    start, at = [], 0
    for r in sorted(sizes):
        start += [F.lit(r), F.lit(at)]
        at += sizes[r]
    base = F.try_element_at(F.create_map(*start), F.col("_range")) if start else F.lit(0)
    return rows.withColumn(name, (base + F.row_number().over(W.partitionBy("_range").orderBy(*keys)) - 1).cast("long")).drop("_range")


def unpinned_facets(df: DataFrame, column: str, pinned: Column) -> DataFrame:
    """value, n of the rows that are no subtotals; blanks as ∅."""
    value = F.coalesce(F.nullif(F.col(column).cast("string"), F.lit("")), F.lit("∅"))
    return df.where(~F.coalesce(pinned, F.lit(False))).groupBy(value.alias("value")).agg(F.count(F.lit(1)).alias("n"))
