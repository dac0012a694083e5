"""Entity resolution: cascades, suggestions, crosswalks, alignment, spatial dedup, graph walks."""

from __future__ import annotations

from bisect import bisect_left
from itertools import pairwise

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from gridloom.functions.text import compact, norm
from gridloom.session import kept, ship


def resolve(queries: DataFrame, index: DataFrame) -> DataFrame:
    """queries (q), index (key, alias) -> q, alias, rule: exact, then compact-equal, then the longest key (6 or more) that the query contains.

    The first two are equi-joins. Containment joins on every 6-character gram of the compact query, which any contained
    key must begin with, so there is no cross join.
    """
    q = queries.select("q", norm(F.col("q")).alias("qn"), compact(F.col("q")).alias("qc")).distinct()
    i = index.select("alias", norm(F.col("key")).alias("kn"), compact(F.col("key")).alias("kc"))
    cols = ["q", "alias", "rule", "rank", "len"]
    exact = q.join(i, q["qn"] == i["kn"]).select("q", "alias", F.lit("exact").alias("rule"), F.lit(1).alias("rank"), F.length("kn").alias("len"))
    same = q.join(i, (q["qc"] == i["kc"]) & (F.length("qc") > 0)).select("q", "alias", F.lit("compact").alias("rule"), F.lit(2).alias("rank"), F.length("kc").alias("len"))
    grams = q.where(F.length("qc") >= 6).select("q", "qc", F.explode(F.array_distinct(F.transform(F.sequence(F.lit(1), F.length("qc") - 5), lambda p: F.substring("qc", p, F.lit(6))))).alias("g"))
    within = grams.join(i.where(F.length("kc") >= 6), F.col("g") == F.substring("kc", 1, 6)).where(F.expr("contains(qc, kc)")).select("q", "alias", F.lit("contains").alias("rule"), F.lit(3).alias("rank"), F.length("kc").alias("len"))
    found = exact.select(cols).unionByName(same.select(cols)).unionByName(within.select(cols))
    best = F.row_number().over(W.partitionBy("q").orderBy("rank", F.desc("len"), "alias"))
    return found.withColumn("rn", best).where("rn = 1").select("q", "alias", "rule")


def grams(c: str, n: int) -> Column:
    """The different runs of n characters of a text."""
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(c) - n + 1), lambda p: F.substring(c, p, F.lit(n))))


def containing(queries: DataFrame, index: DataFrame) -> DataFrame:
    """q, key, kind (0 equal, 1 prefix, 2 elsewhere): keys that hold a query, case aside. A query of three characters or more meets the keys by its first three as
    they stand anywhere in a key, shorter ones by what they have, so it is an equi-join."""
    q = queries.select("q", F.lower("q").alias("ql")).distinct()
    n = F.least(F.length("ql"), F.lit(3))
    keys = index.select("key").distinct().withColumn("_low", F.lower("key"))
    out = None
    for size in (1, 2, 3):
        some = q.where(n == size).withColumn("_g", F.substring("ql", 1, size))
        met = keys.where(F.length("_low") >= size).select("key", "_low", F.explode(grams("_low", size)).alias("_g"))
        hit = met.join(some, "_g").where(F.expr("contains(_low, ql)")).select("q", "key", F.when(F.col("_low") == F.col("ql"), 0).when(F.col("_low").startswith(F.col("ql")), 1).otherwise(2).alias("kind"))
        out = hit if out is None else out.unionByName(hit)
    return out.distinct()


def suggest(queries: DataFrame, index: DataFrame, k: int) -> DataFrame:
    """q, key, kind, position: exact, prefix, then substring matches, k at most for each query."""
    return containing(queries, index).withColumn("position", F.row_number().over(W.partitionBy("q").orderBy("kind", "key"))).where(F.col("position") <= k)


def two_tier(left: DataFrame, right: DataFrame, exact: str, family: str) -> DataFrame:
    """left rows with right's ids by exact code, or, for those without, by family; tier says which."""
    a = left.join(right.select(F.col(exact), F.col("id").alias("match")), exact).select(*left.columns, "match", F.lit(1).alias("tier"))
    rest = left.join(right.select(exact).distinct(), exact, "left_anti")
    b = rest.join(right.select(F.col(family), F.col("id").alias("match")), family).select(*left.columns, "match", F.lit(2).alias("tier"))
    return a.unionByName(b)


def numbered(df: DataFrame, key: str, name: str, ranges: int = 256) -> DataFrame:
    """df with name, its row's number from 1 in the order of a number key that no two rows share. Rows are numbered in ranges of the key, each from the count of
    those before it, so no task gets them all."""
    cuts = sorted(set(df.agg(F.percentile_approx(key, [k / ranges for k in range(1, ranges)], 100 * ranges)).first()[0] or []))
    rows = df.withColumn("_range", F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c <= F.col(key))) if cuts else F.lit(0))
    sizes = dict(map(tuple, rows.groupBy("_range").count().collect()))  # as many rows as ranges
    before = F.array(*(F.lit(sum(n for r, n in sizes.items() if r < k)).cast("long") for k in range(len(cuts) + 1)))
    return rows.withColumn(name, before[F.col("_range")] + F.row_number().over(W.partitionBy("_range").orderBy(key))).drop("_range")


def running(df: DataFrame, key: str, amount: str, name: str) -> DataFrame:
    """df with name, the sum of amount over the rows before each in the order of a key that no two rows share. Rows lie in ranges of the key, each counted from the sum of those before it."""
    rows = kept(df.repartitionByRange(key).withColumn("_range", F.spark_partition_id()))
    sizes = {r: n for r, n in rows.groupBy("_range").agg(F.sum(amount)).collect()}  # as many rows as ranges
    start, at = [], 0
    for r in sorted(sizes):
        start += [F.lit(r), F.lit(at)]
        at += sizes[r] or 0
    base = F.try_element_at(F.create_map(*start), F.col("_range")) if start else F.lit(0)
    inside = F.sum(amount).over(W.partitionBy("_range").orderBy(key).rowsBetween(W.unboundedPreceding, -1))
    return rows.withColumn(name, base + F.coalesce(inside, F.lit(0))).drop("_range")


def positional(left: DataFrame, right: DataFrame, a: str, b: str) -> DataFrame:
    """i, a, b, reason: the rows of both tables in the order of their keys a and b, side by side."""
    reason = F.when(F.col(a).isNull(), "left missing").when(F.col(b).isNull(), "right missing").when(F.col(a) != F.col(b), "differs").otherwise("same")
    return numbered(left.select(a), a, "i").join(numbered(right.select(b), b, "i"), "i", "full").select("i", a, b, reason.alias("reason"))


def paths(edges: DataFrame, roots: DataFrame, most: int = 16) -> DataFrame:
    """edges (child, parent, name), roots (node, name) -> node, path, depth. A join for each level, at most `most`; a level is written before the next one
    grows from it, so none is computed twice, and the walk ends with the first level that is empty."""
    level = roots.select("node", F.col("name").alias("path"), F.lit(0).alias("depth"))
    out = level
    for depth in range(1, most + 1):
        level = kept(edges.join(level.select(F.col("node").alias("parent"), F.col("path").alias("up")), "parent").select(F.col("child").alias("node"), F.concat_ws("/", "up", "name").alias("path"), F.lit(depth).alias("depth")))
        if level.isEmpty():
            break
        out = out.unionByName(level)
    return out


def hops(edges: DataFrame, start: DataFrame, most: int) -> DataFrame:
    """edges (a, b), start (node) -> node, target, hops: fewest hops to every node within `most`. Each level holds only what no level before it reached."""
    known = start.select("node", F.col("node").alias("target")).distinct()
    level, out = known, None
    for n in range(1, most + 1):
        level = kept(level.join(edges, F.col("target") == F.col("a")).select("node", F.col("b").alias("target")).distinct().join(known, ["node", "target"], "left_anti"))
        if level.isEmpty():
            break
        known = known.unionByName(level)
        step = level.withColumn("hops", F.lit(n))
        out = step if out is None else out.unionByName(step)
    return out if out is not None else known.limit(0).withColumn("hops", F.lit(0))


def majority(votes: DataFrame, keys: list[str], choice: str) -> DataFrame:
    """Each key's most voted choice; ties by the smaller one."""
    n = votes.groupBy(*keys, choice).agg(F.count(F.lit(1)).alias("votes"))
    return n.withColumn("rn", F.row_number().over(W.partitionBy(*keys).orderBy(F.desc("votes"), choice))).where("rn = 1").drop("rn")


def usable_version(versions: DataFrame, key: str, order: list[str], usable: Column) -> DataFrame:
    """versions with chosen and why: of each key the newest version that can be used, or the newest of all where none can; why others lost: 'unusable', 'older', or 'newer, unusable'."""
    w = W.partitionBy(key)
    v = versions.withColumn("_u", F.coalesce(usable, F.lit(False))).withColumn("_at", F.struct(*order))
    best = F.coalesce(F.max(F.when(F.col("_u"), F.col("_at"))).over(w), F.max("_at").over(w))
    v = v.withColumn("_best", best).withColumn("chosen", F.col("_at") == F.col("_best"))
    why = F.when(F.col("chosen"), F.when(F.col("_u"), "newest").otherwise("none usable")).when(F.col("_u"), "older").when(F.col("_at") > F.col("_best"), "newer, unusable").otherwise("unusable")
    return v.withColumn("why", why).drop("_u", "_at", "_best")


def best_class(df: DataFrame, entity: str, rank: str, group: str, order: list[Column], groups: int, each: int, always: Column | None = None) -> DataFrame:
    """Rows of each entity's best rank, and those that always count (exact references) beside them; at most `groups` groups and `each` rows of a group."""
    kept_too = F.lit(False) if always is None else F.coalesce(always, F.lit(False))
    best = df.withColumn("_best", F.min(rank).over(W.partitionBy(entity))).where((F.col(rank) == F.col("_best")) | kept_too)
    best = best.withColumn("_g", F.dense_rank().over(W.partitionBy(entity).orderBy(group))).withColumn("_r", F.row_number().over(W.partitionBy(entity, group).orderBy(*order)))
    return best.where((F.col("_g") <= groups) & (F.col("_r") <= each)).drop("_best", "_g", "_r")


def revision_key(c: Column) -> Column:
    """Sortable: numbers (with a letter behind: 1 < 1A < 2) over letters (shorter first) over none."""
    num = F.regexp_extract(c, r"^(\d+)[A-Za-z]?$", 1)
    return F.when(num != "", F.struct(F.lit(2).alias("class"), num.cast("int").alias("n"), F.upper(F.regexp_extract(c, r"^\d+([A-Za-z]?)$", 1)).alias("s"))).when(c.rlike("^[A-Za-z]+$"), F.struct(F.lit(1).alias("class"), F.length(c).alias("n"), F.upper(c).alias("s"))).otherwise(F.struct(F.lit(0).alias("class"), F.lit(0).alias("n"), F.lit("").alias("s")))


def osa_distance(a: Column, b: Column, most: int) -> Column:
    """Edit distance with adjacent transpositions, most + 1 beyond the cap. A transposition is two edits to Spark's levenshtein, which so never exceeds twice this distance:
    the JVM settles equal and far pairs, and only what lies between goes to Python in Arrow batches."""

    @F.pandas_udf("int")
    def osa(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([None if p is None or q is None else _banded(p, q, most) for p, q in zip(x, y, strict=True)], dtype="Int32")

    far = F.levenshtein(a, b, 2 * most) < 0
    some = F.when(a.isNotNull() & b.isNotNull() & (a != b) & ~far, a)
    return F.when(a == b, 0).when(far, most + 1).otherwise(osa(some, b))


def _banded(x: str, y: str, most: int) -> int:
    """The distance over the diagonals -most to most alone: cells further off cost more than the cap."""
    over = most + 1
    rows = [{j: j for j in range(min(len(y), most) + 1)}]
    for i in range(1, len(x) + 1):
        row = {}
        for j in range(max(0, i - most), min(len(y), i + most) + 1):
            ways = [rows[i - 1].get(j, over) + 1, row.get(j - 1, over) + 1]
            if j:
                ways.append(rows[i - 1].get(j - 1, over) + (x[i - 1] != y[j - 1]))
            if i > 1 and j > 1 and x[i - 2 : i] == y[j - 2 : j][::-1]:
                ways.append(rows[i - 2].get(j - 2, over) + 1)
            row[j] = min(over, *ways)
        rows.append(row)
    return rows[-1].get(len(y), over)


def lcs_pairs(left: DataFrame, right: DataFrame, key: str, order: str, label: str) -> DataFrame:
    """key, i, j, how: a longest common subsequence of the labels of each key (Hunt and Szymanski: the longest strictly rising chain of places
    that match), and of stretches of equal length between its pairs the rows one by one ('gap'). A key of one side alone has none."""

    def align(k: tuple, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        x, y = a.sort_values(order)[label].tolist(), b.sort_values("_order")["_label"].tolist()
        at: dict = {}
        for j, v in enumerate(y):
            at.setdefault(v, []).append(j)
        ends: list[int] = []  # the least j that ends a chain of each length
        links: list[tuple] = []  # and the chain itself, as (i, j, rest)
        for i, v in enumerate(x):
            for j in reversed(at.get(v, [])):
                n = bisect_left(ends, j)
                link = (i, j, links[n - 1] if n else None)
                if n == len(ends):
                    ends.append(j)
                    links.append(link)
                elif j < ends[n]:
                    ends[n], links[n] = j, link
        pairs, link = [], links[-1] if links else None
        while link:
            pairs.append(link[:2])
            link = link[2]
        pairs = [(-1, -1), *reversed(pairs), (len(x), len(y))]
        out = [(i, j, "label") for i, j in pairs[1:-1]]
        for (i, j), (p, q) in pairwise(pairs):
            if p - i == q - j:
                out += [(i + n, j + n, "gap") for n in range(1, p - i)]
        return pd.DataFrame([(*k, *o) for o in out], columns=[key, "i", "j", "how"])

    ship(left.sparkSession)
    kind = dict(left.dtypes)[key]
    # names of its own: a cogroup of two sides of one table loses columns that both share
    other = right.select(F.col(key).alias("_key"), F.col(order).alias("_order"), F.col(label).alias("_label"))
    return left.groupBy(key).cogroup(other.groupBy("_key")).applyInPandas(align, f"{key} {kind}, i int, j int, how string")


def drop_overlaps(boxes: DataFrame, page: str, share: float) -> DataFrame:
    """Boxes (id, x0, y0, x1, y1) by area, greatest first; one that an already kept box overlaps by `share` of its own area goes. Greedy, so a page at a time; a box looks
    only at kept ones in the cells of a grid that it touches, as wide as the page's median box."""

    def greedy(df: pd.DataFrame) -> pd.DataFrame:
        df = df.assign(area=(df.x1 - df.x0) * (df.y1 - df.y0)).sort_values(["area", "id"], ascending=[False, True])
        cell = max(float(np.median(np.maximum(df.x1 - df.x0, df.y1 - df.y0))), 1e-9)
        grid: dict = {}
        stay = []
        for r in df.itertuples(index=False):
            cells = [(u, v) for u in range(int(r.x0 // cell), int(r.x1 // cell) + 1) for v in range(int(r.y0 // cell), int(r.y1 // cell) + 1)]
            near = {k.id: k for c in cells for k in grid.get(c, ())}.values()
            hidden = any(max(0, min(r.x1, k.x1) - max(r.x0, k.x0)) * max(0, min(r.y1, k.y1) - max(r.y0, k.y0)) >= share * r.area for k in near)
            stay.append(not hidden)
            if not hidden:
                for c in cells:
                    grid.setdefault(c, []).append(r)
        return df[stay].drop(columns="area")

    ship(boxes.sparkSession)
    return boxes.groupBy(page).applyInPandas(greedy, boxes.schema)
