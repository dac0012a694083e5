"""Conditional formats as columns: priority, stop-if-true, colour scales, data bars, duplicates."""

from __future__ import annotations

from itertools import pairwise

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from gridloom.functions.text import any_of
from gridloom.session import kept


def first_setters(rules: list[dict], properties: list[str]) -> dict[str, Column]:
    """Each property from the first rule by priority that holds and sets it; nothing below a rule that holds and stops. Rules: {when, set, stop}."""
    out = {}
    for p in properties:
        c, open_ = F.lit(None).cast("string"), F.lit(True)
        picks = []
        for r in rules:
            if p in r["set"]:
                picks.append(F.when(open_ & r["when"], F.lit(r["set"][p])))
            if r.get("stop"):
                open_ = open_ & ~F.coalesce(r["when"], F.lit(False))
        out[p] = F.coalesce(*picks, c)
    return out


def data_bar(df: DataFrame, column: str) -> DataFrame:
    """bar: share of the way from the least to the greatest value, 0 to 1, four places."""
    ends = df.agg(F.min(column).alias("_lo"), F.max(column).alias("_hi"))
    x = (F.col(column) - F.col("_lo")) / F.nullif(F.col("_hi") - F.col("_lo"), F.lit(0))
    return df.crossJoin(F.broadcast(ends)).withColumn("bar", F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), x)), 4)).drop("_lo", "_hi")  # one row


def exact_percentiles(df: DataFrame, column: str, stops: list[float]) -> list[float | None]:
    """Inclusive, interpolated percentiles. Counts of equal values are summed in ranges of them, so no task holds all values; what comes to the driver is one count a
    range and the two neighbours of each stop."""
    values = df.where(F.col(column).isNotNull()).groupBy(F.col(column).cast("double").alias("v")).agg(F.count(F.lit(1)).alias("n"))
    parts = kept(values.repartitionByRange("v").withColumn("_range", F.spark_partition_id()))
    sizes = {r: n for r, n in parts.groupBy("_range").agg(F.sum("n")).collect()}
    total = sum(sizes.values())
    if not total:
        return [None] * len(stops)
    before, at = {}, 0
    for r in sorted(sizes):
        before[r], at = at, at + sizes[r]
    places = sorted({p for s in stops for p in (int(s * (total - 1)), min(total - 1, int(s * (total - 1)) + 1))})
    start = F.create_map(*(F.lit(x) for kv in before.items() for x in kv))
    upto = F.try_element_at(start, F.col("_range")) + F.sum("n").over(W.partitionBy("_range").orderBy("v"))
    found = parts.where(F.col("_range").isin([r for r in before if any(before[r] <= p < before[r] + sizes[r] for p in places)])).select("v", (upto - F.col("n")).alias("a"), upto.alias("b"))
    rows = found.where(" OR ".join(f"a <= {p} AND {p} < b" for p in places)).collect()  # two a stop at most
    value = lambda p: next(r.v for r in rows if r.a <= p < r.b)
    out = []
    for s in stops:
        i, part = divmod(s * (total - 1), 1)
        lo, hi = value(int(i)), value(min(total - 1, int(i) + 1))
        out.append(lo + (hi - lo) * part)
    return out


def colour_scale(df: DataFrame, column: str, stops: list[float]) -> DataFrame:
    """stop: how many of the inclusive percentiles the value reaches."""
    cuts = exact_percentiles(df, column, stops)
    reached = [F.when(F.coalesce(F.col(column) >= F.lit(c), F.lit(False)), 1).otherwise(0) for c in cuts if c is not None]
    return df.withColumn("stop", sum(reached[1:], reached[0]) if reached else F.lit(0))


def threshold(df: DataFrame, column: str, kind: str, value: float = 0.0) -> float | None:
    """Where a stop of a colour scale or data bar lies: min, max, num, percent (of the way from least to greatest) or percentile."""
    if kind == "num":
        return value
    if kind == "percentile":
        return exact_percentiles(df, column, [value / 100])[0]
    lo, hi = df.agg(F.min(F.col(column).cast("double")), F.max(F.col(column).cast("double"))).first()
    return lo if kind == "min" else hi if kind == "max" else None if lo is None else lo + (hi - lo) * value / 100


def scale_colours(df: DataFrame, column: str, stops: list[tuple[str, float, str]]) -> DataFrame:
    """colour: #rrggbb between the stops' (kind, value, colour) on either side of the value, channel by channel; beyond the ends the end's colour."""
    at = [(threshold(df, column, k, v), [int(c[i : i + 2], 16) for i in (1, 3, 5)]) for k, v, c in stops]
    x = F.col(column).cast("double")
    hexed = lambda rgb: F.concat(F.lit("#"), *(F.lower(F.lpad(F.hex(c.cast("long")), 2, "0")) for c in rgb))
    fixed = lambda rgb: hexed([F.lit(c) for c in rgb])
    out = F.when(x.isNull(), None).when(x <= at[0][0], fixed(at[0][1]))
    for (lo, a), (hi, b) in pairwise(at):
        part = (x - lo) / (hi - lo) if hi > lo else F.lit(1.0)
        out = out.when(x <= hi, hexed([F.floor(F.lit(float(p)) + F.lit(float(q - p)) * part + 0.5) for p, q in zip(a, b, strict=True)]))
    return df.withColumn("colour", out.otherwise(fixed(at[-1][1])))


def cell_is(c: Column, operator: str, a: object, b: object = None) -> Column:
    """A cellIs rule: equal, notEqual, greaterThan(OrEqual), lessThan(OrEqual), between, notBetween. Blank cells meet none but notEqual."""
    tests = {"equal": lambda: c == a, "greaterThan": lambda: c > a, "greaterThanOrEqual": lambda: c >= a, "lessThan": lambda: c < a, "lessThanOrEqual": lambda: c <= a, "between": lambda: c.between(min(a, b), max(a, b)), "notBetween": lambda: ~c.between(min(a, b), max(a, b))}
    return ~F.coalesce(c == a, F.lit(False)) if operator == "notEqual" else F.coalesce(tests[operator](), F.lit(False))


def text_is(c: Column, operator: str, text: str = "") -> Column:
    """A text rule, case aside: containsText, notContainsText, beginsWith, endsWith; containsBlanks, notContainsBlanks; containsErrors, notContainsErrors (an error is NULL here)."""
    s, t = F.lower(F.coalesce(c.cast("string"), F.lit(""))), text.lower()
    blank = F.trim(s) == ""
    return {"containsText": s.contains(t), "notContainsText": ~s.contains(t), "beginsWith": s.startswith(t), "endsWith": s.endswith(t), "containsBlanks": blank, "notContainsBlanks": ~blank, "containsErrors": c.isNull(), "notContainsErrors": c.isNotNull()}[operator]


def duplicates(df: DataFrame, column: str) -> DataFrame:
    """is_duplicate, case aside; nulls are neither. Values that occur more than once are counted, combined before the shuffle, and joined back: no value's rows share a task."""
    again = df.groupBy(F.lower(column).alias("_v")).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1 AND _v IS NOT NULL")
    marked = df.join(again, F.lower(column) == F.col("_v"), "left")
    return marked.withColumn("is_duplicate", F.when(F.col(column).isNotNull(), F.col("_n").isNotNull())).drop("_v", "_n")


def layered(layers: list[dict[str, Column]]) -> dict[str, Column]:
    """Styles of a cell from layers, uppermost first: bold, italic, underline and strike hold where any layer sets them, every other property is the uppermost's that has one."""
    names = list(dict.fromkeys(n for layer in layers for n in layer))
    flags = ("bold", "italic", "underline", "strike")
    return {n: any_of([F.coalesce(layer[n], F.lit(False)) for layer in layers if n in layer]) if n in flags else F.coalesce(*(layer[n] for layer in layers if n in layer)) for n in names}
