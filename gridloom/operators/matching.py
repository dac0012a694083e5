"""Ranked matches between tags, signals, catalogues and drawings, each a union of equi-joins of which the best rule wins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from gridloom.functions.tags import parse_kks, relation, relation_rank
from gridloom.functions.text import compact
from gridloom.session import kept, safe_unions

#: Controllers of a unit's prefix (none: any), and how well a controller point's relation to a device counts.
CONTROLLERS = {"S10": ["S1", "S1S", "SAMP1"], "G11": ["G11", "G11S"], "G12": ["G12", "G12S"], "C10": []}
POINT_RANK = {"same": 0, "logic": 1, "equip": 2, "suffix": 3, "alias": 5, "other": 6, "spare": 7}
#: Rows that one piece of a list gives when it is handed to the entities that share it, about.
BLOCK = 4_000_000


def best_rules(parts: list[tuple[str, DataFrame]], keys: list[str]) -> DataFrame:
    """All rows of each key's first rule that has any. What wins is one aggregate a key."""
    every = None
    for i, (name, d) in enumerate(parts):
        d = d.withColumn("rule", F.lit(name)).withColumn("_rank", F.lit(i))
        every = d if every is None else every.unionByName(d)
    best = every.groupBy(*keys).agg(F.min("_rank").alias("_rank"))
    return every.join(best, [*keys, "_rank"]).drop("_rank")


def signal_match(tags: DataFrame, channels: DataFrame) -> DataFrame:
    """tags (tag), channels (channel, ctrl, device, signal) -> tag, channel, ctrl, rule: the device's tag is the same, or the signal is the tag and XQ and two digits, or the
    device's tag is the same without the unit's prefix, in that unit's controllers."""
    t = tags.select("tag").distinct().withColumn("_t", F.upper(F.regexp_replace("tag", r"\s+", "")))
    c = channels.withColumn("_d", F.upper(F.regexp_replace("device", r"\s+", "")))
    unit = r"^(S10|G11|G12|C10)_?(.+)$"
    allowed = F.create_map(*(x for k, v in CONTROLLERS.items() for x in (F.lit(k), F.array(*map(F.lit, v)).cast("array<string>"))))
    bare = t.where(F.col("_t").rlike(unit)).withColumn("_u", F.try_element_at(allowed, F.regexp_extract("_t", unit, 1))).withColumn("_t", F.regexp_extract("_t", unit, 2))
    same = t.join(c, F.col("_t") == F.col("_d")).select("tag", "channel", "ctrl")
    by_signal = t.join(c.withColumn("_s", F.regexp_extract(F.upper("signal"), r"^(.+)XQ[0-9]{2}$", 1)).where("_s <> ''"), F.col("_t") == F.col("_s")).select("tag", "channel", "ctrl")
    without = bare.join(c, F.col("_t") == F.col("_d")).where((F.size("_u") == 0) | F.array_contains("_u", F.col("ctrl"))).select("tag", "channel", "ctrl")
    return best_rules([("device", same), ("signal", by_signal), ("no unit", without)], ["tag"])


def oem_match(tags: DataFrame, catalogue: DataFrame) -> DataFrame:
    """tags (tag), catalogue (entry, scope, name, core, suffix) -> tag, entry, unit, rule, level, place: a turbine's tag by the maker's name in its scope (a trailing _0n is the same
    device once more), or without a leading 90 (inferred); a plant code without a suffix by its core in its scope, entries without a suffix first."""
    t = tags.select("tag").distinct().withColumn("_t", F.upper(F.regexp_replace("tag", r"\s+", "")))
    named = r"^(G[0-9]{2})_(.+?)(_0[0-9])?$"
    g = t.where(F.col("_t").rlike(named)).select("tag", F.regexp_extract("_t", named, 1).alias("unit"), compact(F.regexp_extract("_t", named, 2)).alias("_n"))
    entries = catalogue.withColumn("_n", compact(F.col("name")))
    in_g = entries.where("scope = 'G'").select("entry", "_n", F.lit("").alias("suffix"))
    cols = ["tag", "entry", "unit", "suffix"]
    exact = g.join(in_g, "_n").select(cols)
    short = g.where(F.col("_n").startswith("90")).withColumn("_n", F.substring("_n", 3, 200)).join(in_g, "_n").select(cols)
    k = t.where(~F.col("_t").rlike(named)).withColumn("_k", parse_kks(F.col("_t"))).where("_k IS NOT NULL AND _k.suffix = '' AND _k.letter IN ('G', 'S')")
    by_core = k.select("tag", F.concat("_k.letter", "_k.unit").alias("unit"), F.col("_k.letter").alias("scope"), F.col("_k.core").alias("core")).join(catalogue.select("entry", "scope", "core", "suffix"), ["scope", "core"]).select(cols)
    got = best_rules([("name", exact), ("name without 90", short), ("core", by_core)], ["tag"])
    place = F.row_number().over(W.partitionBy("tag").orderBy(F.when(F.col("suffix") == "", 0).otherwise(1), "entry"))
    return got.select("tag", "entry", "unit", "rule", F.when(F.col("rule") == "name without 90", "inferred").otherwise("doc").alias("level"), place.alias("place"))


def attributed(labels: DataFrame, tags: DataFrame, names: DataFrame, loops: DataFrame) -> DataFrame:
    """labels (page, label, scope), tags (tag), names (tag, name), loops (tag, area, letter, kind, number) -> page, label, tag, relation, rank: whom a drawing's label stands for.

    A plant code: the same core and the same suffix, units related; without a unit only in the drawing's scope, if it has one. A maker's name: equal as a whole,
    neutral. A loop's name: equal as a whole is exact, the same area, letter and number is the loop. A label's best relation to a tag counts.
    """
    labels = labels.select("page", "label", "scope").distinct()
    k = labels.withColumn("k", parse_kks(F.col("label"))).where("k IS NOT NULL").select("page", "label", "scope", "k.letter", "k.unit", "k.core", "k.suffix")
    own = tags.select("tag").distinct().withColumn("t", parse_kks(F.col("tag"))).where("t IS NOT NULL").select("tag", F.col("t.letter").alias("_tl"), F.col("t.unit").alias("_tu"), F.col("t.core").alias("core"), F.regexp_replace("t.suffix", "^[^A-Z].*$", "").alias("_ts"))
    by_code = k.join(own, "core").where(F.col("suffix") == F.col("_ts")).withColumn("relation", relation(F.col("_tl"), F.col("_tu"), F.col("letter"), F.col("unit")))
    by_code = by_code.where((F.col("unit") != "") | F.col("scope").isNull() | (F.col("scope") == F.col("_tl"))).select("page", "label", "tag", "relation")
    by_name = labels.join(names.select("tag", F.upper("name").alias("_n")).distinct(), F.upper("label") == F.col("_n")).select("page", "label", "tag", F.lit("neutral").alias("relation"))
    shape = r"^([0-9]+)-([A-Z])[A-Z]*-([A-Z]+)([0-9]+)"
    part = lambda i: F.regexp_extract("label", shape, i)
    lab = labels.where(F.col("label").rlike(shape)).select("page", "label", part(1).alias("area"), part(2).alias("letter"), part(3).alias("kind"), part(4).alias("number"))
    by_loop = lab.join(loops, ["area", "letter", "kind", "number"]).select("page", "label", "tag", F.when(F.col("label") == F.col("tag"), "exact").otherwise("loop").alias("relation"))
    every = by_code.unionByName(by_name).unionByName(by_loop).where("relation IS NOT NULL").withColumn("rank", relation_rank(F.col("relation")))
    return every.groupBy("page", "label", "tag").agg(F.min_by("relation", "rank").alias("relation"), F.min("rank").alias("rank"))


def page_entities(hits: DataFrame, symbol: Column, table: Column, flagged: Column) -> DataFrame:
    """hits (entity, page, x0, y0, x1, y1, ...) -> with note (0 symbol, 1 row of a list, 2 flagged), one hit for each entity and box: the best note, then the least word id."""
    note = F.when(flagged, 2).when(table, 1).when(symbol, 0)
    h = hits.withColumn("note", note).where("note IS NOT NULL")
    rn = F.row_number().over(W.partitionBy("entity", "page", "x0", "y0", "x1", "y1").orderBy("note", "word"))
    return h.withColumn("_rn", rn).where("_rn = 1").drop("_rn")


def graded_points(points: DataFrame, devices: DataFrame) -> DataFrame:
    """points (point, screw, device, variable), devices (entity, tag, screw) -> entity, point, grade, rank, place: how the point on a device's screw stands to it. Rules in order: same tag (or a part
    of it), logic (the variable's name holds it), equip (the first ten characters of a plant code agree), suffix (one is the other and a letter or number), spare (nothing is set), other (the
    digits differ), alias. The best point of a device comes first.

    Most points stand to every device of their screw alike, so entities are told apart only by the kinds of points (device, variable) that stand to them unlike that. Of the entities between which
    nothing differs one has its points graded and ordered; the others take its list as it is."""
    safe_unions(points.sparkSession)
    upper = lambda c: F.upper(F.coalesce(F.col(c).cast("string"), F.lit("")))
    points = points.select("point", "screw", upper("device").alias("_d"), upper("variable").alias("_v"))
    devices = devices.select("entity", upper("tag").alias("_t"), "screw")
    grade = _grade(F.col("_t"), F.col("_d"), F.col("_v"))
    usual = F.when(F.col("_d") != "", "other").otherwise("alias")

    kinds = points.where("_d <> '' OR _v <> ''").select("screw", "_d", "_v").distinct()
    own = devices.groupBy("entity", "_t", "screw").agg(F.count(F.lit(1)).alias("_n"))
    unlike = own.join(kinds, "screw").select("entity", "_t", "screw", "_n", F.struct("_d", "_v", grade.alias("_g")).alias("_x"), usual.alias("_u")).where("_x._g <> _u").drop("_u")
    row = own.withColumn("_x", F.lit(None).cast(unlike.schema["_x"].dataType)).unionByName(unlike).groupBy("entity", "_t", "screw", "_n").agg(F.array_sort(F.collect_list("_x")).alias("_x"))
    row = row.join(points.groupBy("screw").agg(F.count(F.lit(1)).alias("_m")), "screw")  # devices on screws without points have no rows
    entity = row.groupBy("entity").agg(F.array_sort(F.collect_list(F.struct("screw", "_n", "_x"))).alias("_like"), F.sum(F.col("_n") * F.col("_m")).alias("_m"))
    entity = kept(entity.withColumn("_like", F.struct("_like")))

    first = entity.groupBy("_like").agg(F.min(F.struct("entity")).alias("_first"), F.ceil(F.count(F.lit(1)) * F.max("_m") / BLOCK).alias("_blocks"))
    block = F.pmod(F.xxhash64("entity"), F.col("_blocks")).alias("_block")
    members = entity.join(first, "_like").select("entity", F.col("_first.entity").alias("_e"), block)
    listed = first.select(F.col("_first.entity").alias("_e"), "_blocks").join(devices, F.col("_e").eqNullSafe(F.col("entity"))).drop("entity").join(points, "screw")
    listed = listed.select("_e", "_blocks", "point", grade.alias("grade"))
    ranks = F.create_map(*(F.lit(x) for kv in POINT_RANK.items() for x in kv))
    listed = listed.withColumn("rank", F.try_element_at(ranks, F.col("grade"))).withColumn("place", F.row_number().over(W.partitionBy("_e").orderBy("rank", "point")))
    listed = listed.select(F.col("_e").alias("_of"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1)).alias("_part"), "point", "grade", "rank", "place")
    listed = listed.repartition(_partitions(points.sparkSession), "_of", "_part")
    return listed.join(members, F.col("_of").eqNullSafe(F.col("_e")) & (F.col("_part") == F.col("_block"))).select("entity", "point", "grade", "rank", "place")


def _partitions(spark) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _grade(tag: Column, dev: Column, var: Column) -> Column:
    parts = F.transform(F.filter(F.split(dev, r"[\s,/]+"), lambda p: p != ""), compact)
    core = lambda c: F.regexp_extract(c, r"([A-Z]{3}[0-9]{2}[A-Z]{2}[0-9]{3})", 1)
    more = lambda a, b: F.startswith(a, b) & F.substring(a, F.length(b) + 1, F.length(a)).rlike("^(-?[A-Z]|-[0-9])$")
    number = lambda c: F.regexp_replace(c, "[^0-9]", "")
    return (
        F.when((dev == "") & (var == ""), "spare").when(F.array_contains(parts, compact(tag)) | (compact(dev) == compact(tag)), "same").when((F.length(compact(tag)) >= 4) & F.contains(compact(var), compact(tag)), "logic")
        .when((core(tag) != "") & (core(tag) == core(dev)), "equip").when((dev != "") & (more(tag, dev) | more(dev, tag)), "suffix").when((dev != "") & (number(dev) != number(tag)), "other").otherwise("alias")
    )


def io_index(points: DataFrame, modules: DataFrame, boards: DataFrame, variables: DataFrame) -> DataFrame:
    """points (point, module, board), modules (module, ctrl), boards (module, board, kind), variables (point, variable) -> each point with its module (which it must have) and, where there are any,
    its board's kind and its variable."""
    return points.join(modules, "module").join(boards, ["module", "board"], "left").join(variables, "point", "left").select("point", "ctrl", "module", "board", "kind", "variable")


def inverted(devices: DataFrame, codes: list[tuple[str, str]]) -> DataFrame:
    """index, code, aliases: for each of the named code columns the sorted set of aliases that carry a code; blank codes and families left open (*) are left out."""
    each = F.explode(F.array(*(F.struct(F.lit(n).alias("index"), F.col(c).alias("code")) for n, c in codes))).alias("x")
    rows = devices.select("alias", each).select("x.index", "x.code", "alias").where("code IS NOT NULL AND code <> '' AND NOT endswith(code, '*')").distinct()
    return rows.groupBy("index", "code").agg(F.array_sort(F.collect_list("alias")).alias("aliases"))


def nested_rows(entries: DataFrame, key: str, lists: list[str], most: int) -> DataFrame:
    """key, list, position, and the fields of its items: the first `most` items of each nested list of an entry, level 'doc' where none is told."""
    out = None
    for name in lists:
        rows = entries.select(key, F.lit(name).alias("list"), F.posexplode(F.slice(name, 1, most)).alias("position", "x")).select(key, "list", "position", "x.*")
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    return out.withColumn("level", F.coalesce(F.nullif("level", F.lit("")), F.lit("doc")))


def united(paths: DataFrame, point: str, screws: str) -> DataFrame:
    """point, screws: the union of the screw sets of all paths of a point, sorted."""
    return paths.select(point, F.explode(screws).alias("s")).distinct().groupBy(point).agg(F.array_sort(F.collect_list("s")).alias(screws))


def dictionary(table: DataFrame, keys: list[str], order: str, take: list[str]) -> DataFrame:
    """One row a composite key: the first in order."""
    return table.groupBy(*keys).agg(F.min_by(F.struct(*take), order).alias("x")).select(*keys, "x.*")


def primary_name(names: DataFrame, entity: str, name: str, known: DataFrame) -> DataFrame:
    """entity, name: of an entity's names that are known the first by alphabet."""
    return names.join(known.select(name).distinct(), name, "left_semi").groupBy(entity).agg(F.min(name).alias(name))


def status_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """counter, value, n of several status columns in one scan; blanks as ''."""
    each = F.explode(F.array(*(F.struct(F.lit(c).alias("counter"), F.coalesce(F.col(c).cast("string"), F.lit("")).alias("value")) for c in columns))).alias("x")
    return df.select(each).groupBy("x.counter", "x.value").agg(F.count(F.lit(1)).alias("n"))


def inventory_summary(items: DataFrame) -> DataFrame:
    """items, updated, low of an inventory (qty, min, updated_at): how many, the latest change, and how many are at their minimum or below."""
    return items.agg(F.count(F.lit(1)).alias("items"), F.max("updated_at").alias("updated"), F.count_if(F.coalesce(F.col("qty") <= F.col("min"), F.lit(False))).alias("low"))


def stock_status(qty: Column, least: Column) -> Column:
    """out, low (at the item's minimum or below, where it has one) or ok."""
    return F.when(F.coalesce(qty, F.lit(0)) <= 0, "out").when(F.coalesce(qty <= least, F.lit(False)), "low").otherwise("ok")


def configuration_changes(changes: DataFrame, parameter: str, code: str, dynamic: str, codes: list[str]) -> DataFrame:
    """Changes but those of parameters that change by themselves: named by the pattern, or of one of the codes."""
    return changes.where(~F.coalesce(F.col(parameter).rlike(dynamic) | F.col(code).isin(codes), F.lit(False)))


def not_revoked(sessions: DataFrame, revoked: DataFrame, key: str) -> DataFrame:
    return sessions.join(revoked.select(key), key, "left_anti")


def current(assignments: DataFrame, until: str, open_: int, key: str) -> DataFrame:
    """Assignments that still hold: their end is the mark for none, and their key is a real one."""
    return assignments.where((F.col(until) == open_) & (F.col(key) >= 0))
