"""Queries of ranked matches, relations on drawings, tags in prose, links and vendors."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridloom.functions import tags
from gridloom.operators import matching, shaping
from gridloom.plans.registry import query, table

_TWO = "lpad(({0} % 100)::VARCHAR, 2, '0')"
_THREE = "lpad(({0} % 1000)::VARCHAR, 3, '0')"


def _padded(c, n):
    return F.lpad((c % 10**n).cast("string"), n, "0")


@query("""WITH t AS (SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'FT-' || p_partkey WHEN 1 THEN 'G11_FT-' || p_partkey WHEN 2 THEN 'S10FT-' || p_partkey WHEN 3 THEN 'C10_ft-' || p_partkey ELSE 'SIG' || p_partkey END AS tag FROM part),
c AS (SELECT l_orderkey * 10 + l_linenumber AS channel, ['G11', 'G12S', 'S1', 'SAMP1'][l_suppkey % 4 + 1] AS ctrl, CASE WHEN l_partkey % 2 = 0 THEN 'FT-' || l_partkey WHEN l_partkey % 3 = 0 THEN 'G11_FT- ' || l_partkey ELSE 'none' END AS device, 'sig' || l_partkey || 'xq' || lpad((l_linenumber % 10)::VARCHAR, 2, '0') AS signal FROM lineitem),
x AS (SELECT *, upper(replace(device, ' ', '')) AS d, upper(signal) AS s FROM c), u AS (SELECT tag, upper(tag) AS t, regexp_extract(upper(tag), '^(S10|G11|G12|C10)_?(.+)$', 1) AS unit, regexp_extract(upper(tag), '^(S10|G11|G12|C10)_?(.+)$', 2) AS bare FROM t),
h AS (SELECT tag, channel, ctrl, 0 AS k FROM u JOIN x ON t = d UNION ALL SELECT tag, channel, ctrl, 1 FROM u JOIN x ON s LIKE t || 'XQ__' AND left(s, length(s) - 4) = t
 UNION ALL SELECT tag, channel, ctrl, 2 FROM u JOIN x ON bare = d WHERE bare <> '' AND CASE unit WHEN 'S10' THEN ctrl IN ('S1', 'S1S', 'SAMP1') WHEN 'G11' THEN ctrl IN ('G11', 'G11S') WHEN 'G12' THEN ctrl IN ('G12', 'G12S') ELSE true END)
SELECT tag, channel, ctrl, CASE k WHEN 0 THEN 'device' WHEN 1 THEN 'signal' ELSE 'no unit' END AS rule FROM h QUALIFY k = min(k) OVER (PARTITION BY tag)""")
def signal_match(spark, sf_dir):
    """Tags against the channels of controllers: same device, signal's name, or the tag without its unit in that unit's controllers."""
    p, li = table(spark, sf_dir, "part"), table(spark, sf_dir, "lineitem")
    k, key = F.col("p_partkey") % 5, F.col("p_partkey").cast("string")
    tag = F.when(k == 0, F.concat(F.lit("FT-"), key)).when(k == 1, F.concat(F.lit("G11_FT-"), key)).when(k == 2, F.concat(F.lit("S10FT-"), key)).when(k == 3, F.concat(F.lit("C10_ft-"), key)).otherwise(F.concat(F.lit("SIG"), key))
    part = F.col("l_partkey").cast("string")
    device = F.when(F.col("l_partkey") % 2 == 0, F.concat(F.lit("FT-"), part)).when(F.col("l_partkey") % 3 == 0, F.concat(F.lit("G11_FT- "), part)).otherwise("none")
    channels = li.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("channel"), F.get(F.array(*map(F.lit, ["G11", "G12S", "S1", "SAMP1"])), (F.col("l_suppkey") % 4).cast("int")).alias("ctrl"), device.alias("device"), F.concat(F.lit("sig"), part, F.lit("xq"), _padded(F.col("l_linenumber") % 10, 2)).alias("signal"))
    return matching.signal_match(p.select(tag.alias("tag")), channels)


@query(f"""WITH t AS (SELECT DISTINCT CASE c_custkey % 4 WHEN 0 THEN 'G11_VA-' || c_custkey % 300 WHEN 1 THEN 'G12_90VA-' || c_custkey % 300 || '_01' WHEN 2 THEN 'G11ABC' || {_TWO.format('c_custkey')} || 'BP' || {_THREE.format('c_nationkey')} ELSE 'S10ABC' || {_TWO.format('c_custkey')} || 'BP' || {_THREE.format('c_nationkey')} END AS tag FROM customer),
e AS (SELECT p_partkey AS entry, CASE WHEN p_partkey % 3 = 0 THEN 'S' ELSE 'G' END AS scope, CASE WHEN p_partkey % 7 = 0 THEN '90' ELSE '' END || 'VA-' || p_partkey % 400 AS name, 'ABC' || {_TWO.format('p_partkey')} || 'BP' || {_THREE.format('p_size % 25')} AS core, CASE WHEN p_partkey % 2 = 0 THEN '' ELSE 'A' END AS suffix FROM part),
n AS (SELECT *, regexp_replace(name, '[^A-Z0-9]', '', 'g') AS nm FROM e WHERE scope = 'G'), g AS (SELECT tag, left(tag, 3) AS unit, regexp_replace(regexp_extract(tag, '^G[0-9][0-9]_(.+?)(_0[0-9])?$', 1), '[^A-Z0-9]', '', 'g') AS nm FROM t WHERE regexp_matches(tag, '^G[0-9][0-9]_')),
h AS (SELECT tag, entry, unit, '' AS suffix, 0 AS k FROM g JOIN n USING (nm) UNION ALL SELECT tag, entry, unit, '', 1 FROM g JOIN n ON 'X' || g.nm = 'X90' || n.nm UNION ALL SELECT tag, entry, left(tag, 3), suffix, 2 FROM t JOIN e ON substr(tag, 4) = core AND left(tag, 1) = scope WHERE NOT regexp_matches(tag, '^G[0-9][0-9]_')),
b AS (SELECT * FROM h QUALIFY k = min(k) OVER (PARTITION BY tag))
SELECT tag, entry, unit, CASE k WHEN 0 THEN 'name' WHEN 1 THEN 'name without 90' ELSE 'core' END AS rule, CASE k WHEN 1 THEN 'inferred' ELSE 'doc' END AS level, row_number() OVER (PARTITION BY tag ORDER BY suffix <> '', entry) AS place FROM b""")
def oem_match(spark, sf_dir):
    """Tags against a maker's catalogue, by name in the turbine's scope or by the core of a plant code."""
    c, p = table(spark, sf_dir, "customer"), table(spark, sf_dir, "part")
    k, no = F.col("c_custkey"), (F.col("c_custkey") % 300).cast("string")
    code = F.concat(F.lit("ABC"), _padded(k, 2), F.lit("BP"), _padded(F.col("c_nationkey"), 3))
    tag = F.when(k % 4 == 0, F.concat(F.lit("G11_VA-"), no)).when(k % 4 == 1, F.concat(F.lit("G12_90VA-"), no, F.lit("_01"))).when(k % 4 == 2, F.concat(F.lit("G11"), code)).otherwise(F.concat(F.lit("S10"), code))
    e = F.col("p_partkey")
    entries = p.select(e.alias("entry"), F.when(e % 3 == 0, "S").otherwise("G").alias("scope"), F.concat(F.when(e % 7 == 0, "90").otherwise(""), F.lit("VA-"), (e % 400).cast("string")).alias("name"), F.concat(F.lit("ABC"), _padded(e, 2), F.lit("BP"), _padded(F.col("p_size") % 25, 3)).alias("core"), F.when(e % 2 == 0, "").otherwise("A").alias("suffix"))
    return matching.oem_match(c.select(tag.alias("tag")), entries)


@query(f"""WITH t AS (SELECT DISTINCT ['G11', 'G12', 'S10', 'G21'][s_suppkey % 4 + 1] || 'ABC' || {_TWO.format('s_suppkey % 7')} || 'BP' || {_THREE.format('s_suppkey % 5')} || CASE WHEN s_suppkey % 3 = 0 THEN 'A' ELSE '' END AS tag FROM supplier),
l AS (SELECT DISTINCT p_partkey % 10 AS page, ['', 'G11', 'GXX', '11', 'G1X', 'S10', 'XX', 'G12'][p_partkey % 8 + 1] AS pre, 'ABC' || {_TWO.format('p_partkey % 7')} || 'BP' || {_THREE.format('p_size % 5')} AS core, CASE WHEN p_size % 2 = 0 THEN 'A' ELSE '' END AS suf, CASE p_partkey % 3 WHEN 0 THEN 'G' WHEN 1 THEN 'S' END AS scope FROM part),
n AS (SELECT *, pre || core || suf AS label, CASE WHEN regexp_matches(pre, '^[A-Z][0-9X]{{2}}$') THEN left(pre, 1) ELSE '' END AS letter, right(pre, 2) AS unit FROM l),
j AS (SELECT page, label, tag, left(tag, 1) AS tl, substr(tag, 2, 2) AS tu, letter, unit, scope FROM n JOIN t ON substr(tag, 4, 10) = core AND substr(tag, 14) = suf),
r AS (SELECT *, CASE WHEN letter <> '' AND letter <> tl THEN NULL WHEN unit = '' THEN 'neutral' WHEN contains(unit, 'X') THEN CASE WHEN (unit[1] = 'X' OR unit[1] = tu[1]) AND (unit[2] = 'X' OR unit[2] = tu[2]) THEN 'neutral' END WHEN unit = tu THEN 'exact'
 WHEN tl = 'G' AND unit[1] = tu[1] AND unit[2] IN ('1', '2') AND tu[2] IN ('1', '2') THEN 'typical' END AS relation FROM j),
x AS (SELECT page, label, tag, relation, CASE relation WHEN 'exact' THEN 0 WHEN 'neutral' THEN 1 ELSE 2 END AS rank FROM r WHERE relation IS NOT NULL AND (unit <> '' OR scope IS NULL OR scope = tl)
 UNION ALL SELECT p_partkey % 10, 'VA-' || p_size, 'G11_VA-' || s_suppkey, 'neutral', 1 FROM part JOIN supplier ON p_size = s_suppkey UNION ALL SELECT p_partkey % 10, '1-TI-CW' || p_size, '1-TE-CW' || s_suppkey, 'loop', 3 FROM part JOIN supplier ON p_size = s_suppkey)
SELECT page, label, tag, arg_min(relation, rank) AS relation, min(rank)::INT AS rank FROM x GROUP BY 1, 2, 3""")
def label_attribution(spark, sf_dir):
    """Labels of drawings as plant codes with units of every kind, as makers' names and as loops."""
    s, p = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "part")
    sk, pk = F.col("s_suppkey"), F.col("p_partkey")
    pick = lambda values, c: F.get(F.array(*map(F.lit, values)), c.cast("int"))
    tag = F.concat(pick(["G11", "G12", "S10", "G21"], sk % 4), F.lit("ABC"), _padded(sk % 7, 2), F.lit("BP"), _padded(sk % 5, 3), F.when(sk % 3 == 0, "A").otherwise(""))
    page = (pk % 10).alias("page")
    code = F.concat(pick(["", "G11", "GXX", "11", "G1X", "S10", "XX", "G12"], pk % 8), F.lit("ABC"), _padded(pk % 7, 2), F.lit("BP"), _padded(F.col("p_size") % 5, 3), F.when(F.col("p_size") % 2 == 0, "A").otherwise(""))
    scope = F.when(pk % 3 == 0, "G").when(pk % 3 == 1, "S")
    size = F.col("p_size").cast("string")
    labels = p.select(page, code.alias("label"), scope.alias("scope")).unionByName(p.select(page, F.concat(F.lit("VA-"), size).alias("label"), F.lit(None).cast("string").alias("scope"))).unionByName(p.select(page, F.concat(F.lit("1-TI-CW"), size).alias("label"), F.lit(None).cast("string").alias("scope")))
    no = sk.cast("string")
    names = s.select(F.concat(F.lit("G11_VA-"), no).alias("tag"), F.concat(F.lit("va-"), no).alias("name"))
    loops = s.select(F.concat(F.lit("1-TE-CW"), no).alias("tag"), F.lit("1").alias("area"), F.lit("T").alias("letter"), F.lit("CW").alias("kind"), no.alias("number"))
    return matching.attributed(labels, s.select(tag.alias("tag")), names, loops)


@query("""WITH d AS (SELECT s_suppkey AS entity, 'WW-' || s_suppkey AS tag, s_suppkey % 50 AS screw FROM supplier), p AS (SELECT p_partkey AS point, p_partkey % 50 AS screw, CASE p_partkey % 6 WHEN 0 THEN '' WHEN 1 THEN 'WW-' || p_partkey % 100 WHEN 2 THEN 'WW-' || p_partkey % 100 || 'C' WHEN 3 THEN 'AB-' || p_partkey % 100 WHEN 4 THEN 'WW-' || (p_partkey + 1) % 100 ELSE '' END AS dev,
 CASE WHEN p_partkey % 6 = 5 THEN 'D_WW' || p_partkey % 100 || '_O' ELSE '' END AS var FROM part), j AS (SELECT *, replace(tag, '-', '') AS ct, replace(dev, '-', '') AS cd, replace(var, '_', '') AS cv FROM d JOIN p USING (screw)),
g AS (SELECT entity, point, CASE WHEN dev = '' AND var = '' THEN 'spare' WHEN cd = ct THEN 'same' WHEN length(ct) >= 4 AND contains(cv, ct) THEN 'logic' WHEN dev <> '' AND (dev = tag || 'C') THEN 'suffix' WHEN dev <> '' AND regexp_replace(dev, '[^0-9]', '', 'g') <> regexp_replace(tag, '[^0-9]', '', 'g') THEN 'other' ELSE 'alias' END AS grade FROM j)
SELECT entity, point, grade, CASE grade WHEN 'same' THEN 0 WHEN 'logic' THEN 1 WHEN 'suffix' THEN 3 WHEN 'alias' THEN 5 WHEN 'other' THEN 6 ELSE 7 END AS rank, row_number() OVER (PARTITION BY entity ORDER BY rank, point) AS place FROM g""")
def point_grades(spark, sf_dir):
    """How the points of a device's screw stand to it."""
    sk, pk = F.col("s_suppkey"), F.col("p_partkey")
    no = lambda c: (c % 100).cast("string")
    devices = table(spark, sf_dir, "supplier").select(sk.alias("entity"), F.concat(F.lit("WW-"), sk.cast("string")).alias("tag"), (sk % 50).alias("screw"))
    device = F.when(pk % 6 == 1, F.concat(F.lit("WW-"), no(pk))).when(pk % 6 == 2, F.concat(F.lit("WW-"), no(pk), F.lit("C"))).when(pk % 6 == 3, F.concat(F.lit("AB-"), no(pk))).when(pk % 6 == 4, F.concat(F.lit("WW-"), no(pk + 1)))
    points = table(spark, sf_dir, "part").select(pk.alias("point"), (pk % 50).alias("screw"), device.alias("device"), F.when(pk % 6 == 5, F.concat(F.lit("D_WW"), no(pk), F.lit("_O"))).alias("variable"))
    return matching.graded_points(points, devices)


@query("""SELECT o_orderkey AS point, n_name AS ctrl, o_custkey AS module, o_orderkey % 7 AS board, CASE WHEN (o_orderkey % 7) % 2 = 0 THEN 'AI' END AS kind, CASE WHEN o_orderkey % 3 = 0 THEN 'v' || o_orderkey END AS variable FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey""")
def io_index(spark, sf_dir):
    """Points that have a module; boards and variables where there are any."""
    o, c, n = (table(spark, sf_dir, t) for t in ("orders", "customer", "nation"))
    modules = c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("c_custkey").alias("module"), F.col("n_name").alias("ctrl"))
    points = o.select(F.col("o_orderkey").alias("point"), F.col("o_custkey").alias("module"), (F.col("o_orderkey") % 7).alias("board"))
    boards = c.select(F.col("c_custkey").alias("module"), F.explode(F.array(*(F.lit(i).cast("long") for i in (0, 2, 4, 6)))).alias("board")).withColumn("kind", F.lit("AI"))
    variables = o.where("o_orderkey % 3 = 0").select(F.col("o_orderkey").alias("point"), F.concat(F.lit("v"), F.col("o_orderkey").cast("string")).alias("variable"))
    return matching.io_index(points, modules, boards, variables)


@query("""WITH d AS (SELECT c_name AS alias, CASE WHEN c_custkey % 5 = 0 THEN c_mktsegment || '*' ELSE c_mktsegment END AS core, CASE WHEN c_custkey % 7 = 0 THEN '' ELSE 'N' || c_nationkey END AS family FROM customer),
x AS (SELECT DISTINCT 'core' AS "index", core AS code, alias FROM d UNION SELECT DISTINCT 'family', family, alias FROM d) SELECT "index", code, list(alias ORDER BY alias) AS aliases FROM x WHERE code <> '' AND NOT ends_with(code, '*') GROUP BY 1, 2""")
def device_index(spark, sf_dir):
    c, k = table(spark, sf_dir, "customer"), F.col("c_custkey")
    d = c.select(F.col("c_name").alias("alias"), F.when(k % 5 == 0, F.concat("c_mktsegment", F.lit("*"))).otherwise(F.col("c_mktsegment")).alias("core"), F.when(k % 7 == 0, "").otherwise(F.concat(F.lit("N"), F.col("c_nationkey").cast("string"))).alias("family"))
    return matching.inverted(d, [("core", "core"), ("family", "family")])


@query("""WITH i AS (SELECT l_orderkey, l_partkey AS tag, CASE WHEN l_linenumber % 2 = 0 THEN 'inferred' ELSE 'doc' END AS level, l_returnflag, row_number() OVER (PARTITION BY l_orderkey, l_returnflag = 'R' ORDER BY l_partkey, l_suppkey, l_linenumber) - 1 AS position FROM lineitem)
SELECT l_orderkey, CASE WHEN l_returnflag = 'R' THEN 'valves' ELSE 'instruments' END AS list, position::INT AS position, tag, level FROM i WHERE position < 2""")
def nested_relations(spark, sf_dir):
    """The first two items of each of two nested lists of an entry."""
    item = F.struct("l_partkey", "l_suppkey", "l_linenumber")
    pack = lambda when: F.transform(F.array_sort(F.collect_list(F.when(when, item))), lambda x: F.struct(x["l_partkey"].alias("tag"), F.when(x["l_linenumber"] % 2 == 0, "inferred").otherwise("").alias("level")))
    r = F.col("l_returnflag") == "R"
    entries = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(pack(r).alias("valves"), pack(~r).alias("instruments"))
    return matching.nested_rows(entries, "l_orderkey", ["valves", "instruments"], 2)


@query("""SELECT l_suppkey, list(DISTINCT x ORDER BY x) AS screws FROM (SELECT l_suppkey, unnest([l_linenumber, l_linenumber + l_partkey % 3]) AS x FROM lineitem) GROUP BY 1""")
def screw_union(spark, sf_dir):
    paths = table(spark, sf_dir, "lineitem").select("l_suppkey", F.array(F.col("l_linenumber").cast("long"), F.col("l_linenumber") + F.col("l_partkey") % 3).alias("screws"))
    return matching.united(paths, "l_suppkey", "screws")


@query("""SELECT l_returnflag, l_linestatus, arg_min(l_shipdate, (l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_shipdate)) AS l_shipdate FROM lineitem GROUP BY 1, 2""")
def parameter_dictionary(spark, sf_dir):
    """The first row of each pair of keys."""
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate"]
    li = table(spark, sf_dir, "lineitem").withColumn("at", F.struct(*order))
    return matching.dictionary(li, ["l_returnflag", "l_linestatus"], "at", ["l_shipdate"])


@query("""SELECT o_custkey, min(o_orderpriority) AS o_orderpriority FROM orders WHERE o_orderpriority IN (SELECT o_orderpriority FROM orders GROUP BY 1 HAVING min(o_orderkey) > 0) GROUP BY 1""")
def class_primary(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    known = o.groupBy("o_orderpriority").agg(F.min("o_orderkey").alias("m")).where("m > 0")
    return matching.primary_name(o, "o_custkey", "o_orderpriority", known)


@query("""SELECT event_id FROM events WHERE NOT (regexp_matches(event_type, '^(click|view)$') OR props IN ('{"k": 1}', '{"k": 2}'))""")
def configuration_changes(spark, sf_dir):
    return matching.configuration_changes(table(spark, sf_dir, "events"), "event_type", "props", "^(click|view)$", ['{"k": 1}', '{"k": 2}']).select("event_id")


@query("""SELECT event_id FROM events WHERE user_id NOT IN (SELECT s_suppkey * 2 FROM supplier)""")
def denylist(spark, sf_dir):
    return matching.not_revoked(table(spark, sf_dir, "events"), table(spark, sf_dir, "supplier").select((F.col("s_suppkey") * 2).alias("user_id")), "user_id").select("event_id")


@query("""SELECT o_orderkey FROM orders WHERE o_custkey - 3 >= 0 AND o_orderkey % 5 = 4""")
def live_assignments(spark, sf_dir):
    """Assignments without an end, of real devices."""
    a = table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_custkey") - 3).alias("device"), F.when(F.col("o_orderkey") % 5 == 4, 49710).otherwise(1).alias("until"))
    return matching.current(a, "until", 49710, "device").select("o_orderkey")


@query(f"""WITH k AS (SELECT p_partkey, ['', '=G11', 'XX', 'S10'][p_partkey % 4 + 1] AS pre, 'HAD' || {_TWO.format('p_size')} || 'BP' || {_THREE.format('p_partkey')} AS core, ['', 'A', 'B2', '-BL01', '/2/3'][p_partkey % 5 + 1] AS tail FROM part)
SELECT p_partkey, CASE p_partkey % 4 WHEN 1 THEN 'G' WHEN 3 THEN 'S' ELSE '' END AS letter, CASE p_partkey % 4 WHEN 1 THEN '11' WHEN 2 THEN 'XX' WHEN 3 THEN '10' ELSE '' END AS unit, core, CASE WHEN p_partkey % 5 = 4 THEN '' ELSE tail END AS suffix, p_partkey % 5 = 4 AS sequence,
CASE p_partkey % 3 WHEN 0 THEN ['G11ABC', 'G12ABC'] WHEN 1 THEN ['G11-X', 'G21-X'] ELSE ['S10ABC'] END AS units, ['LS-' || p_partkey + 100 || 'A', 'LS-' || p_partkey + 100 || 'B', 'LS-' || p_partkey + 100] AS tags, c_name AS plain FROM k JOIN customer ON c_custkey = p_partkey % 50""")
def tag_parsing(spark, sf_dir):
    """Plant codes taken apart, units expanded, several tags in one token, and full-width text with other dashes back to plain text."""
    pk, p = F.col("p_partkey"), table(spark, sf_dir, "part")
    pick = lambda values, c: F.get(F.array(*map(F.lit, values)), c.cast("int"))
    code = F.concat(pick(["", "=G11", "XX", "S10"], pk % 4), F.lit("HAD"), _padded(F.col("p_size"), 2), F.lit("BP"), _padded(pk, 3), pick(["", "A", "B2", "-BL01", "/2/3"], pk % 5))
    unit = tags.expand_units(F.when(pk % 3 == 0, "GXXABC").when(pk % 3 == 1, "G11/G21-X").otherwise(" s10abc "), F.lit("G11, G12 and S10"))
    wide = "".join(chr(c + 0xFEE0) for c in range(0x21, 0x7F))
    odd = F.translate(F.col("c_name"), "".join(chr(c) for c in range(0x21, 0x7F)), wide)
    j = p.join(table(spark, sf_dir, "customer"), F.col("c_custkey") == pk % 50)
    short = tags.shorthand(F.concat(F.lit("LS-"), (pk + 100).cast("string"), F.lit("A/B")))
    made = j.select("p_partkey", tags.parse_kks(code).alias("k"), F.transform(unit, lambda u: u["tag"]).alias("units"), short.alias("tags"), tags.folded(odd).alias("plain"))
    return made.select("p_partkey", "k.letter", "k.unit", "k.core", "k.suffix", "k.sequence", "units", "tags", "plain")


@query("""SELECT p_partkey, -p_size + 0.5::DOUBLE AS lo, (p_retailprice * 10)::BIGINT::DOUBLE AS hi, 'kPa' AS unit, [(p_size || ' ~ ' || p_size + 5 || ' bar')] AS found, 'see ␀x ↵ y⇥z' AS shown, 'a b' AS bare, ['HT0-1-GZD01-M' || lpad((p_partkey % 10000)::VARCHAR, 4, '0'), 'HT0-1-GZD01-M0001'] AS numbers, ['B', ''] AS revisions FROM part""")
def prose_parsing(spark, sf_dir):
    """Ranges, document numbers and control characters in prose."""
    pk, size = F.col("p_partkey"), F.col("p_size").cast("string")
    first = F.concat((-F.col("p_size") + 0.5).cast("string"), F.lit(" ~ "), F.format_number((F.col("p_retailprice") * 10).cast("long"), 0), F.lit(" kPa / 1 ~ 2 bar"))
    line = F.concat(F.lit("range 1 ~ 2 °C, "), size, F.lit(" ~ "), (F.col("p_size") + 5).cast("string"), F.lit(" bar"))
    docs = F.concat(F.lit("see HT0-1-GZD01-M"), _padded(pk, 4), F.lit(" rev.b and ht0-1-gzd01-m0001."))
    numbers = tags.document_numbers(docs, r"(HT0-1-[A-Z]{3}[0-9]{2}-[A-Z][0-9]{4})(?: REV\.([A-Z]))?")
    p = table(spark, sf_dir, "part").select("p_partkey", tags.parse_range(first).alias("r"), tags.find_ranges(line, F.lit("kPa")).alias("found"), tags.visible(F.lit("see \x00x\n y\tz".replace("\n y", "\ny"))).alias("shown"), tags.without_controls(F.lit("a\x07 b")).alias("bare"), numbers.alias("n"))
    return p.select("p_partkey", "r.lo", "r.hi", "r.unit", "found", "shown", "bare", F.transform("n", lambda x: x["number"]).alias("numbers"), F.transform("n", lambda x: x["revision"]).alias("revisions"))


@query("""SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 'G11.C10' || p_brand ELSE '{none}C10' || p_brand END AS expanded, 'AB' || lpad((p_partkey % 1000)::VARCHAR, 3, '0') || ' AB002 AB' || lpad((p_partkey % 1000)::VARCHAR, 3, '0')[1:2] || '7' AS points, 'from ' || p_brand || ' to site' AS named, p_partkey % 4 <> 3 AS same FROM part""")
def text_expansion(spark, sf_dir):
    """Variables of an object and of what is around it, points in short, placeholders, and vendors of one group."""
    pk, p = F.col("p_partkey"), table(spark, sf_dir, "part")
    own = F.create_map(F.lit("unit_no"), F.lit("10"), F.lit("name"), F.concat(F.lit("C{UNIT_NO}"), F.col("p_brand")))
    text = F.when(pk % 3 == 0, F.lit("{Unit}{NAME}")).otherwise(F.lit("{none}{NAME}"))
    points = tags.expand_points(F.concat(F.lit("AB"), _padded(pk, 3), F.lit("\\002\\7")))
    pairs = F.array(*(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in (("Endress + Hauser", "E+H"), ("Rosemount", ""), ("Bently  Nevada", "GE Druck"), ("Yokogawa", "ABB"))))
    pair = F.get(pairs, (pk % 4).cast("int"))
    return p.select("p_partkey", tags.expand_variables(text, own, F.create_map(F.lit("unit"), F.lit("G11."))).alias("expanded"), points.alias("points"), tags.placeholders(F.concat(F.lit("from "), F.col("p_brand"), F.lit(" to ⟦PLACE⟧")), {"PLACE": "site"}).alias("named"), tags.same_vendor(pair["a"], pair["b"]).alias("same"))


@query("""WITH l AS (SELECT event_id, ['grid', 'table', 'card', NULL][event_id % 4 + 1] AS mode, event_id % 120 AS place FROM events), r AS (SELECT *, CASE WHEN mode = 'grid' THEN place WHEN mode = 'table' AND place >= 5 THEN place - 5 END AS row FROM l)
SELECT event_id, row, CASE WHEN mode IS NULL THEN 'no sheet' WHEN mode = 'grid' AND (row < 1 OR row > 100) THEN 'out of range' WHEN mode = 'table' AND row >= 100 THEN 'out of range' END AS problem FROM r""")
def link_targets(spark, sf_dir):
    """Links to rows of sheets of every kind, resolved and held against the sheets' numbers of rows."""
    k = F.col("event_id")
    mode = F.get(F.array(F.lit("grid"), F.lit("table"), F.lit("card"), F.lit(None).cast("string")), (k % 4).cast("int"))
    e = table(spark, sf_dir, "events").select("event_id", mode.alias("mode"), tags.link_row(mode, k % 120, F.lit(5)).alias("row"))
    return e.select("event_id", "row", tags.link_problem(F.col("mode"), F.col("row"), F.lit(100)).alias("problem"))


@query("""WITH h AS (SELECT p_partkey AS word, p_partkey % 40 AS entity, p_partkey % 6 AS page, p_size AS x0, CASE WHEN p_size % 3 = 0 THEN 2 WHEN p_partkey % 4 = 0 THEN 1 WHEN p_partkey % 5 > 0 THEN 0 END AS note FROM part) SELECT word, entity, page, x0, note FROM h WHERE note IS NOT NULL QUALIFY row_number() OVER (PARTITION BY entity, page, x0 ORDER BY note, word) = 1""")
def page_entities(spark, sf_dir):
    """One hit for each entity and box of a page, as a symbol, a list's row or flagged."""
    k, size = F.col("p_partkey"), F.col("p_size")
    h = table(spark, sf_dir, "part").select(k.alias("word"), (k % 40).alias("entity"), (k % 6).alias("page"), size.alias("x0"), F.lit(0).alias("y0"), (size + 9).alias("x1"), F.lit(8).alias("y1"))
    out = matching.page_entities(h, F.col("word") % 5 > 0, F.col("word") % 4 == 0, F.col("x0") % 3 == 0)
    return out.select("word", "entity", "page", "x0", "note")


@query("""WITH c AS (SELECT p_brand AS sheet, p_partkey % 40 + 1 AS r, p_size % 12 + 1 AS c, p_name AS value FROM part), o AS (SELECT * FROM c WHERE r > 30 OR c > 10) SELECT sheet, min(r) AS r1, min(c) AS c1, max(r) AS r2, max(c) AS c2, CASE WHEN min(r) > 30 THEN 'below' ELSE 'beside' END AS position FROM o GROUP BY 1""")
def outside_blocks(spark, sf_dir):
    """What stands beside and below the tables of sheets."""
    cells = table(spark, sf_dir, "part").select(F.col("p_brand").alias("sheet"), (F.col("p_partkey") % 40 + 1).alias("r"), (F.col("p_size") % 12 + 1).alias("c"), F.col("p_name").alias("value"))
    return shaping.outside_block(cells, 30, 10)


@query("""SELECT p_brand AS sheet, p_partkey + 1 AS r, p_name AS title FROM part WHERE p_partkey > 0 AND (p_size >= 19 OR (p_size % 2 = 0 AND p_retailprice >= 1000))""")
def sheet_sections(spark, sf_dir):
    """Headings of sheets: merged banners and bold text of a heading's size."""
    p = table(spark, sf_dir, "part")
    cells = p.select(F.col("p_brand").alias("sheet"), (F.col("p_partkey") + 1).alias("r"), F.lit(1).alias("c"), F.col("p_name").alias("value"), F.col("p_size").alias("span"), ((F.col("p_size") % 2 == 0) | (F.col("p_size") >= 19)).alias("bold"), (F.col("p_size") >= 19).alias("filled"), F.when(F.col("p_retailprice") >= 1000, 14.0).otherwise(9.0).alias("size"), F.lit("x").alias("colour"))
    return shaping.sections(cells, 20)
