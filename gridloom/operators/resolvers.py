"""Resolver cascades: every query is rewritten into ranked candidate keys, candidates meet the index in one equi-join, the best rank wins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from gridloom.functions.text import compact, norm

#: Ranks of candidates by containment and by token: behind every other one.
CONTAINED, TOKEN = 1_000, 200_000
_CANDIDATE = "array<struct<rank:int,via:string,key:string,unit:string>>"


def candidate(rank: int, via: str, key: Column, unit: Column | None = None) -> Column:
    """A candidate key, or none where key is NULL or ''."""
    made = F.struct(F.lit(rank).alias("rank"), F.lit(via).alias("via"), key.alias("key"), (unit if unit is not None else F.lit("")).alias("unit"))
    return F.array(F.when(F.coalesce(key, F.lit("")) != "", made))


def matched(c: Column, pattern: str, group: int) -> Column:
    """A group of the pattern, NULL where it does not match."""
    return F.when(c.rlike(pattern), F.regexp_extract(c, pattern, group))


def cascade(queries: DataFrame, candidates: list[Column], index: DataFrame, covers: Column | None = None, strict: bool = False) -> DataFrame:
    """queries (q, ...), index (key, entity, ...) -> q, entity, via, key, unit: all entities of each query's best candidate.

    covers holds where an entry serves the candidate's unit. Where entries of the best unit candidate do, the others go;
    where none does, all stay and via says unit-other, or, if strict, the next candidate gets its turn.
    """
    c = F.explode(F.array_compact(F.concat(*candidates)).cast(_CANDIDATE)).alias("c")
    asked = queries.select("q", c).select("q", "c.rank", "c.via", F.col("c.key").alias("key"), "c.unit")
    hit = asked.where(F.col("rank") != CONTAINED).join(index, "key")
    # keys that the query contains: met by their first six characters, the longest first
    inside = asked.where(F.col("rank") == CONTAINED).withColumnRenamed("key", "_gram").join(index, (F.col("_gram") == F.substring("key", 1, 6)) & (F.length("key") >= 6)).where(F.contains(compact(F.col("q")), F.col("key")))
    hit = hit.unionByName(inside.withColumn("rank", F.lit(CONTAINED) + 100_000 - F.least(F.length("key"), F.lit(99_999))).select(*hit.columns))
    hit = hit.withColumn("_ok", F.coalesce(covers, F.lit(False)) | (F.col("unit") == "") if covers is not None else F.lit(True))
    if strict:
        hit = hit.where("_ok")
    # what wins is settled by one aggregate a query, so hits are sorted by nothing
    best = hit.groupBy("q").agg(F.min("rank").alias("rank")).join(hit.groupBy("q", "rank").agg(F.max("_ok").alias("_any")), ["q", "rank"])
    won = hit.join(best, ["q", "rank"]).where(F.col("_ok") | ~F.col("_any"))
    return won.select("q", "entity", F.when(F.col("_any"), F.col("via")).otherwise("unit-other").alias("via"), "key", "unit").distinct()


def contained(c: Column, least: int = 6) -> Column:
    """Grams of `least` characters of the query, as candidates for "the query contains a key": every such key begins with one of them. within() sorts them out."""
    starts = F.sequence(F.lit(1), F.length(c) - least + 1)
    grams = F.array_distinct(F.transform(starts, lambda p: F.substring(c, p, F.lit(least))))
    made = F.transform(grams, lambda k: F.struct(F.lit(CONTAINED).alias("rank"), F.lit("contain").alias("via"), k.alias("key"), F.lit("").alias("unit")))
    return F.when(F.length(c) >= least, made).otherwise(F.array().cast(_CANDIDATE))


def _named(space: str, *parts: Column) -> Column:
    """A key in a space of its own, so that one join serves several indexes. Compact keys hold no bar."""
    return F.when(parts[-1].isNotNull(), F.concat_ws("|", F.lit(space), *parts))


def _bare(found: DataFrame) -> DataFrame:
    """Answers with their keys as the indexes have them."""
    return found.withColumn("key", F.substring_index("key", "|", -1))


def resolve_valves(queries: DataFrame, index: DataFrame, weak: DataFrame | None = None) -> DataFrame:
    """index (key compact, entity, units array); weak (key compact, entity): a maker's names that several valves share. The whole query, then without an
    attachment's suffix, then without the unit's prefix (entries that serve the unit first), then weak names without the unit and whole, then the longest contained
    key, then a part between signs."""
    c = compact(F.col("q"))
    prefix = r"^([GCS]\d\d)(90)?(.+)$"
    unit = matched(c, prefix, 1)
    ninety = F.when(matched(c, prefix, 2) == "90", F.concat(F.lit("90"), matched(c, prefix, 3)))
    token = F.transform(F.split(norm(F.col("q")), r"[_.\s]+"), lambda t: F.regexp_replace(compact(t), r"^L(?=\d\d[A-Z])", ""))
    tokens = F.transform(F.filter(token, lambda t: (F.length(t) >= 4) & (t != c)), lambda t, i: F.struct((i + TOKEN).cast("int").alias("rank"), F.lit("token").alias("via"), t.alias("key"), F.lit("").alias("unit")))
    ask = [
        candidate(1, "key", c),
        candidate(2, "suffix", matched(c, r"^(.{4,}?)(?:KH|MB|BG|XG|XS|XB)\d\d$", 1)),
        candidate(3, "unit", F.when(F.length(matched(c, prefix, 3)) >= 3, matched(c, prefix, 3)), unit),
        candidate(4, "unit", ninety, unit),
        candidate(5, "weak", _named("weak", matched(c, prefix, 3))),
        candidate(6, "weak", _named("weak", c)),
        contained(c),
        tokens,
    ]
    if weak is not None:
        index = index.select("key", "entity", "units").unionByName(weak.select(_named("weak", F.col("key")).alias("key"), "entity", F.array().cast("array<string>").alias("units")))
    return _bare(cascade(queries, ask, index, F.array_contains("units", F.col("unit")) | (F.size("units") == 0)))


#: How gas (G) and steam (S) turbines are written, their controllers' names, a plant code (unit, XX for any gas and YY for any steam turbine; body; part of it), and what may follow a signal.
GAS, STEAM = r"^GT?([123][12])(.{2,})$", r"^ST?([123]0)(.{2,})$"
GAS_CONTROLLER, STEAM_CONTROLLER = r"^G([123][12])S?$", r"^S(?:AMP([123])|([123])S?)$"
PLANT_CODE = r"^([A-Z]\d\d|XX|YY)?([A-Z]{3}\d\d[A-Z]{2}\d{3}[A-Z]??)([A-Z]{1,2}\d\d)?$"
SIGNAL_ENDS = ("PV", "VALUE")


def resolve_oem(queries: DataFrame, index: DataFrame, bodies: DataFrame | None = None, signals: DataFrame | None = None) -> DataFrame:
    """index (key compact, entity, scope: first letter of a unit or NULL for any), bodies (key, entity, scope, kind 'kks' or 'oldkks') by a plant code's
    body, signals (key compact, entity, scope). The whole query, then without the unit (in scope only), then without a leading 90, then the body of a plant code of
    its scope, else of none (now valid codes before old ones), then one signal's name, which a controller's may precede. A signal's name that has no controller and
    no underscore counts only where no longer key of index begins with it: it may be half a key."""
    first = compact(F.get("_said", F.lit(0)))
    number = F.concat(*(F.regexp_extract(first, STEAM_CONTROLLER, i) for i in (1, 2)))
    # step by step: an expression that others use more than once stays a column and is computed once
    asked = queries.select("q", compact(F.col("q")).alias("_c"), F.filter(F.split(F.trim("q"), r"[\s.:/\\]+"), lambda t: t != "").alias("_said"))
    c = F.col("_c")
    asked = asked.withColumns({
        "_unit": F.coalesce(F.concat(F.lit("G"), matched(c, GAS, 1)), F.concat(F.lit("S"), matched(c, STEAM, 1))),
        "_rest": F.coalesce(matched(c, GAS, 2), matched(c, STEAM, 2)),
        "_place": matched(c, PLANT_CODE, 1),
        "_body": matched(c, PLANT_CODE, 2),
        "_part": matched(c, PLANT_CODE, 3),
        "_controller": F.when(F.size("_said") > 1, F.coalesce(F.concat(F.lit("G"), matched(first, GAS_CONTROLLER, 1)), F.when(first.rlike(STEAM_CONTROLLER), F.concat(F.lit("S"), number, F.lit("0"))))),
    })
    asked = asked.withColumns({
        "_of": F.when(F.col("_place").rlike("^G[123][12]$|^S[123]0$"), F.col("_place")),
        "_names": F.when(F.col("_controller").isNotNull(), F.slice("_said", F.lit(2), F.size("_said"))).otherwise(F.col("_said")),
    })
    # one name, and behind it only what may follow a signal
    alone = F.forall(F.slice("_names", F.lit(2), F.size("_names")), lambda t: F.upper(t).isin(*SIGNAL_ENDS))
    asked = asked.withColumns({
        "_scope": F.when(F.col("_place") == "XX", "G").when(F.col("_place") == "YY", "S").otherwise(F.substring("_of", 1, 1)),
        "_name": F.when(alone, F.get("_names", F.lit(0))),
    })
    asked = asked.withColumn("_signal", F.when(F.length(compact(F.col("_name"))) >= 3, compact(F.col("_name"))))

    unit, rest, scope, signal, controller = (F.col(n) for n in ("_unit", "_rest", "_scope", "_signal", "_controller"))
    of, part = F.coalesce("_of", F.lit("")), F.coalesce("_part", F.lit(""))
    ask = [candidate(1, "key", c), candidate(2, "unit", rest, unit), candidate(3, "90", matched(rest, r"^90(.+)$", 1), unit), candidate(4, "90", matched(c, r"^90(.{2,})$", 1))]
    for rank, (kind, sc) in enumerate([("kks", scope), ("kks", F.lit("")), ("oldkks", scope), ("oldkks", F.lit(""))], 5):
        key = F.when(scope.isNotNull(), _named(kind, sc, F.col("_body")))
        ask += [candidate(rank, "kks", F.when(part == "", key), of), candidate(rank, "kks-sub", F.when(part != "", key), of)] if kind == "kks" else [candidate(rank, kind, key, of)]
    named = signal if signals is None else _named("signal", signal)
    marked = F.contains("_name", F.lit("_"))
    ask += [candidate(9, "signal", F.when(controller.isNotNull(), named), controller), candidate(10, "signal", F.when(controller.isNull() & marked, named)), candidate(11, "half", F.when(controller.isNull() & ~marked, named))]
    every = index.select("key", "entity", "scope")
    if bodies is not None:
        every = every.unionByName(bodies.select(F.concat_ws("|", "kind", F.coalesce("scope", F.lit("")), "key").alias("key"), "entity", "scope"))
    if signals is not None:
        every = every.unionByName(signals.select(_named("signal", F.col("key")).alias("key"), "entity", "scope"))
    in_scope = F.col("scope").isNull() | (F.col("scope") == F.substring("unit", 1, 1))
    found = _bare(cascade(asked, ask, every, in_scope, strict=True))
    begun = F.transform(F.sequence(F.lit(3), F.length("key") - 1), lambda n: F.substring("key", F.lit(1), n))
    begun = index.where("length(key) > 3").select(F.explode(begun).alias("key")).distinct().withColumn("_begun", F.lit(True))
    whole = found.join(begun, "key", "left").where("via <> 'half' OR _begun IS NULL")
    return whole.select("q", "entity", F.when(F.col("via") == "half", "signal").otherwise(F.col("via")).alias("via"), "key", "unit")


def resolve_kks(queries: DataFrame, index: DataFrame) -> DataFrame:
    """index (key, entity): the code itself, or a device's 13 characters before a signal's suffix."""
    c = compact(F.col("q"))
    return cascade(queries, [candidate(1, "key", c), candidate(2, "signal", matched(c, r"^([A-Z]\d\d[A-Z]{3}\d\d[A-Z]{2}\d{3})[A-Z]?X[A-Z]\d\d$", 1))], index)


def first_of(found: list[tuple[str, DataFrame]]) -> DataFrame:
    """q, entity, via, source: of several resolvers' answers those of the first that has any for the query."""
    parts = [d.select("q", F.col("entity").cast("string").alias("entity"), "via", F.lit(n).alias("source"), F.lit(i).alias("_rank")) for i, (n, d) in enumerate(found)]
    every = parts[0]
    for d in parts[1:]:
        every = every.unionByName(d)
    best = every.groupBy("q").agg(F.min("_rank").alias("_rank"))
    return every.join(best, ["q", "_rank"]).drop("_rank")


def longest_prefix(signals: DataFrame, tags: DataFrame, least: int = 8) -> DataFrame:
    """signals (signal), tags (tag) -> signal, tag, rule: R1 the signal itself, else R6 the longest tag of `least` or more that is a proper prefix of it."""
    lengths = F.sequence(F.lit(least), F.length("signal") - 1)
    ask = F.concat(F.array(F.struct(F.lit(0).alias("rank"), F.col("signal").alias("tag"))), F.when(F.length("signal") > least, F.transform(lengths, lambda n: F.struct((F.length("signal") - n).cast("int").alias("rank"), F.substring("signal", F.lit(1), n).alias("tag")))).otherwise(F.array().cast("array<struct<rank:int,tag:string>>")))
    hit = signals.select("signal", F.explode(ask).alias("c")).select("signal", "c.rank", F.col("c.tag").alias("tag")).join(tags.select("tag").distinct(), "tag")
    return hit.groupBy("signal").agg(F.min_by("tag", "rank").alias("tag"), F.min("rank").alias("rank")).select("signal", "tag", F.when(F.col("rank") == 0, "R1").otherwise("R6").alias("rule"))


#: Digits that a letter may stand for and letters that a digit may stand for on scanned drawings, the shape of a core (L letter, D digit), middles that
#: are no device but a diameter, pressure or the like.
TO_DIGIT = {"O": "0", "Q": "0", "D": "0", "I": "1", "L": "1", "T": "17", "S": "5", "B": "8", "Z": "27", "G": "6", "A": "4"}
TO_LETTER = {"0": "OQD", "1": "ILT", "5": "S", "8": "B", "2": "Z", "6": "G", "4": "A", "7": "TZ"}
SHAPE = "LLLDDLLDDD"
NO_DEVICE = ("DN", "PN", "NB", "NO", "OD", "ID")


def repair(tokens: DataFrame, cores: DataFrame, most: int = 2) -> DataFrame:
    """tokens (token), cores (core) -> token, core, how, fixes: known as it is, or a core of the shape that the token can be read as by taking characters of the wrong class
    for the ones they look like, `most` of them at most; where several known cores need equally few repairs, none is taken.

    Each place has few readings, so a token's are spelled out place by place and meet the known cores in one equi-join.
    """
    both = lambda kind, table: F.create_map(*(F.lit(x) for k, v in table.items() for x in (k, v)))
    digit, letter = both("D", TO_DIGIT), both("L", TO_LETTER)
    t = tokens.select("token").distinct()
    known = t.join(cores.select(F.col("core").alias("token")).distinct(), "token", "left_semi")
    rest = t.where(F.length("token") == len(SHAPE)).join(known, "token", "left_anti")
    readings = F.array(F.struct(F.lit("").alias("core"), F.lit(0).alias("fixes")))
    for i, kind in enumerate(SHAPE):
        ch = F.substring("token", i + 1, 1)
        fits = ch.rlike("^[A-Z]$") if kind == "L" else ch.rlike("^[0-9]$")
        other = F.coalesce(F.try_element_at(letter if kind == "L" else digit, ch), F.lit(""))
        options = F.when(fits, F.array(F.struct(ch.alias("c"), F.lit(0).alias("n")))).otherwise(F.transform(F.filter(F.split(other, ""), lambda x: x != ""), lambda x: F.struct(x.alias("c"), F.lit(1).alias("n"))))
        rest = rest.withColumn("_r", readings if i == 0 else F.col("_r")).withColumn("_o", options)
        grown = F.flatten(F.transform("_r", lambda r: F.transform("_o", lambda o: F.struct(F.concat(r["core"], o["c"]).alias("core"), (r["fixes"] + o["n"]).alias("fixes")))))  # noqa: B023
        rest = rest.withColumn("_r", F.filter(grown, lambda r: r["fixes"] <= most))
    read = rest.select("token", F.explode("_r").alias("r")).select("token", "r.core", "r.fixes").where(~F.substring("core", 6, 2).isin(*NO_DEVICE))
    hit = read.join(cores.select("core").distinct(), "core")
    least = hit.groupBy("token").agg(F.min("fixes").alias("fixes")).join(hit, ["token", "fixes"])
    one = least.groupBy("token", "fixes").agg(F.min("core").alias("core"), F.count_distinct("core").alias("n")).where("n = 1")
    return known.select("token", F.col("token").alias("core"), F.lit("known").alias("how"), F.lit(0).alias("fixes")).unionByName(one.select("token", "core", F.lit("repaired").alias("how"), "fixes"))


def serial_match(certs: DataFrame, entities: DataFrame) -> DataFrame:
    """certs (cert, tag, serial), entities (entity, tag, serial) -> cert, entity, rule: the tag, else the last seven digits of the serial where only one entity has them."""
    tail = F.regexp_extract(F.regexp_replace("serial", r"\D", ""), r"(\d{7})$", 1)
    by_tag = certs.join(entities.select("tag", "entity"), "tag").select("cert", "entity", F.lit("tag").alias("rule"))
    unique = entities.select(tail.alias("tail"), "entity").where("tail <> ''").groupBy("tail").agg(F.min("entity").alias("entity"), F.count_distinct("entity").alias("n")).where("n = 1")
    rest = certs.join(by_tag.select("cert").distinct(), "cert", "left_anti").withColumn("tail", tail)
    return by_tag.unionByName(rest.join(unique, "tail").select("cert", "entity", F.lit("serial").alias("rule")))


def direct_first(rows: DataFrame, keys: list[str], rank: Column, inferred: str) -> DataFrame:
    """Inferred rows go where their keys have a direct one; of the rest the best by rank."""
    w = W.partitionBy(*keys)
    kept = rows.withColumn("_direct", F.max((~F.col(inferred)).cast("int")).over(w)).where((F.col("_direct") == 0) | ~F.col(inferred))
    return kept.withColumn("_rn", F.row_number().over(w.orderBy(rank))).where("_rn = 1").drop("_rn", "_direct")
