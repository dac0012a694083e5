"""Queries of formulas, formats, resolver cascades, selection and layout."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridloom.functions import formats
from gridloom.functions.formula import with_formula
from gridloom.operators import entities, resolvers, selection
from gridloom.plans.registry import query, table


@query("""SELECT p_partkey, CASE WHEN p_size > 25 THEN 'big' WHEN p_size > 10 THEN 'mid' ELSE 'small' END AS size_class, upper(left(p_name, 3)) || '-' || p_size AS code, round(p_size::DECIMAL(9, 2) * 1.05, 1)::DOUBLE AS marked_up,
coalesce(100 / nullif(p_size - 25, 0)::DOUBLE, -1) AS ratio, (count(*) OVER (PARTITION BY p_brand))::DOUBLE AS same_brand, p_size / (sum(p_size) OVER ())::DOUBLE AS share, ((p_brand = 'Brand#13' AND p_size >= 10) OR NOT (p_size % 2 = p_size % 2)) AS wanted,
(count(*) FILTER (p_size >= 40) OVER ())::DOUBLE AS large FROM part""")
def formula_columns(spark, sf_dir):
    df = table(spark, sf_dir, "part")
    for name, formula in {
        "size_class": '=IF(E2>25,"big",IF(E2>10,"mid","small"))',
        "code": '=UPPER(LEFT(B2,3))&"-"&E2',
        "marked_up": "=ROUND(E2*1.05,1)",
        "ratio": "=IFERROR(100/(E2-25),-1)",
        "same_brand": "=COUNTIF(C:C,C2)+0",
        "share": "=E2/SUM(E:E)",
        "wanted": '=OR(AND([p_brand]="brand#13",E2>=10),NOT(E2=E2))',
        "large": '=COUNTIF(E:E,">=40")+0',
    }.items():
        df = with_formula(df, name, formula)
    return df.drop("p_name", "p_brand", "p_type", "p_size", "p_retailprice")


@query("""SELECT o_orderkey, format('{:,.2f}', o_totalprice) AS money, lpad(o_orderkey::VARCHAR, greatest(8, length(o_orderkey::VARCHAR))::INT, '0') AS padded, (o_orderkey % 7 * 5) || '%' AS percent,
CASE WHEN o_orderkey % 7 = 3 THEN '-' WHEN o_orderkey % 7 < 3 THEN '(' || (3 - o_orderkey % 7) || ')' ELSE (o_orderkey % 7 - 3)::VARCHAR END AS signed, strftime(o_orderdate, '%Y/%m/%d %H:%M') AS day, month(o_orderdate) || '月' || strftime(o_orderdate, '%y') AS month,
substr('日一二三四五六', dayofweek(o_orderdate) + 1, 1) AS weekday FROM orders""")
def cell_formats(spark, sf_dir):
    o, key = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    n = lambda c, f: formats.display(c, f, "number")
    d = lambda f: formats.display(F.col("o_orderdate"), f, "date")
    return o.select("o_orderkey", n(F.col("o_totalprice"), "#,##0.00").alias("money"), n(key, "00000000").alias("padded"), n(key % 7 * 0.05, "0%").alias("percent"), n(key % 7 - 3, '0;(0);"-"').alias("signed"), d("yyyy/mm/dd hh:mm").alias("day"), d("mmmyy").alias("month"), d("ddd").alias("weekday"))


@query("""SELECT event_id, strftime(make_timestamp(((epoch_us(ts) + 500000) // 1000000) * 1000000), '%H:%M:%S') AS clock, strftime(ts, '%-d-%-m-%y') AS day, CASE WHEN hour(ts) % 12 = 0 THEN 12 ELSE hour(ts) % 12 END || ':' || strftime(ts, '%M') || CASE WHEN hour(ts) < 12 THEN ' AM' ELSE ' PM' END AS half FROM events""")
def time_formats(spark, sf_dir):
    d = lambda f, n: formats.date_format(F.col("ts"), f).alias(n)
    return table(spark, sf_dir, "events").select("event_id", d("hh:mm:ss", "clock"), d("d-m-yy", "day"), d("h:mm am/pm", "half"))


_VALVES = ["Brand#13", "BRAND21-KH01", "G11_Brand#14", "G12 90Brand#15", "see Brand#16 here", "nothing"]


@query("""WITH i AS (SELECT DISTINCT 'BRAND' || substr(p_brand, 7) AS key FROM part), a(q, via, key, unit) AS (VALUES ('Brand#13', 'key', 'BRAND13', ''), ('BRAND21-KH01', 'suffix', 'BRAND21', ''), ('G11_Brand#14', 'unit', 'BRAND14', 'G11'),
('G12 90Brand#15', 'unit-other', 'BRAND15', 'G12'), ('see Brand#16 here', 'contain', 'BRAND16', '')) SELECT q, key AS entity, via, key, unit FROM a JOIN i USING (key)""")
def valve_resolver(spark, sf_dir):
    index = table(spark, sf_dir, "part").select(F.concat(F.lit("BRAND"), F.substring("p_brand", 7, 9)).alias("key")).distinct().withColumn("entity", F.col("key")).withColumn("units", F.array(F.lit("G11")))
    return resolvers.resolve_valves(spark.createDataFrame([(q,) for q in _VALVES], "q string"), index)


@query("""WITH i AS (SELECT 'SUPPLIER' || lpad(s_suppkey::VARCHAR, 9, '0') AS key, s_suppkey FROM supplier), a(q, via, key, unit, source) AS (VALUES ('Supplier#000000001', 'key', 'SUPPLIER000000001', '', 'oem'), ('G11_Supplier#000000002', 'unit', 'SUPPLIER000000002', 'G11', 'oem'),
('90Supplier#000000004', '90', 'SUPPLIER000000004', '', 'oem'), ('G11.Supplier#000000006.PV', 'signal', 'SUPPLIER000000006', 'G11', 'oem'), ('C10PAC11BS101XQ01', 'signal', 'C10PAC11BS101', '', 'kks'))
SELECT q, CASE WHEN source = 'kks' THEN 'pump' ELSE s_suppkey::VARCHAR END AS entity, via, source FROM a LEFT JOIN i USING (key) WHERE source = 'kks' OR s_suppkey IS NOT NULL""")
def lookup_precedence(spark, sf_dir):
    """OEM tags, then plant codes; odd suppliers' tags are of scope S, so G11 finds none of them."""
    scope = F.when(F.col("s_suppkey") % 2 == 1, "S").otherwise("G")
    index = table(spark, sf_dir, "supplier").select(F.concat(F.lit("SUPPLIER"), F.lpad(F.col("s_suppkey").cast("string"), 9, "0")).alias("key"), F.col("s_suppkey").alias("entity"), scope.alias("scope"))
    q = spark.createDataFrame([("Supplier#000000001",), ("G11_Supplier#000000002",), ("G11_Supplier#000000003",), ("90Supplier#000000004",), ("G11.Supplier#000000006.PV",), ("C10PAC11BS101XQ01",)], "q string")
    kks = spark.createDataFrame([("C10PAC11BS101", "pump")], "key string, entity string")
    return resolvers.first_of([("oem", resolvers.resolve_oem(q, index)), ("kks", resolvers.resolve_kks(q, kks))])


@query("""WITH b AS (SELECT p_partkey AS entity, 'HAD' || lpad(p_size::VARCHAR, 2, '0') || 'BP' || lpad((p_partkey % 1000)::VARCHAR, 3, '0') AS body, CASE p_partkey % 3 WHEN 0 THEN 'G' WHEN 1 THEN 'S' ELSE '' END AS sc, CASE WHEN p_partkey % 2 = 0 THEN 'kks' ELSE 'oldkks' END AS kind FROM part),
w(pre, sc, unit) AS (VALUES ('G11', 'G', 'G11'), ('S20', 'S', 'S20'), ('XX', 'G', ''), ('C10', NULL, '')), e(sub) AS (VALUES (''), ('KH01')),
q AS (SELECT DISTINCT pre || '_' || body || sub AS q, body, sub, w.sc, unit FROM b, w, e),
h AS (SELECT q, entity, CASE kind WHEN 'kks' THEN 0 ELSE 2 END + (b.sc = '')::INT AS rank, CASE WHEN kind = 'oldkks' THEN kind WHEN sub = '' THEN 'kks' ELSE 'kks-sub' END AS via, body AS key, unit FROM q JOIN b USING (body) WHERE q.sc IS NOT NULL AND b.sc IN (q.sc, ''))
SELECT q, entity, via, key, unit FROM h QUALIFY rank = min(rank) OVER (PARTITION BY q)""")
def oem_plant_codes(spark, sf_dir):
    """Plant codes of gas, steam and common units, with and without a part behind, by the bodies of the codes that are valid and of the old ones."""
    body = F.concat(F.lit("HAD"), F.lpad(F.col("p_size").cast("string"), 2, "0"), F.lit("BP"), F.lpad((F.col("p_partkey") % 1000).cast("string"), 3, "0"))
    scope = F.when(F.col("p_partkey") % 3 == 0, "G").when(F.col("p_partkey") % 3 == 1, "S")
    b = table(spark, sf_dir, "part").select(body.alias("key"), F.col("p_partkey").alias("entity"), scope.alias("scope"), F.when(F.col("p_partkey") % 2 == 0, "kks").otherwise("oldkks").alias("kind"))
    forms = F.array(*(F.concat(F.lit(f"{unit}_"), F.col("key"), F.lit(part)) for unit in ("G11", "S20", "XX", "C10") for part in ("", "KH01")))
    return resolvers.resolve_oem(b.select(F.explode(forms).alias("q")).distinct(), b.limit(0), b)


@query("""WITH i AS (SELECT DISTINCT 'BRAND' || substr(p_brand, 7) AS key FROM part), w AS (SELECT DISTINCT upper(regexp_replace(p_type, '[^A-Za-z0-9]', '', 'g')) AS key, p_brand FROM part), n AS (SELECT DISTINCT p_type, p_brand FROM part),
f AS (SELECT DISTINCT p_type AS q, 'weak' AS via, upper(regexp_replace(p_type, '[^A-Za-z0-9]', '', 'g')) AS key, '' AS unit FROM n UNION SELECT 'G11_' || p_type, 'weak', upper(regexp_replace(p_type, '[^A-Za-z0-9]', '', 'g')), '' FROM n)
SELECT q, p_brand AS entity, via, key, unit FROM f JOIN w USING (key) UNION ALL SELECT DISTINCT p_brand || '-KH01', p_brand, 'suffix', upper(regexp_replace(p_brand, '[^A-Za-z0-9]', '', 'g')), '' FROM n""")
def valve_weak_names(spark, sf_dir):
    """Makers' names, which several brands share, with and without a unit ahead; brands with an attachment's suffix."""
    p = table(spark, sf_dir, "part").select("p_type", "p_brand").distinct()
    clean = lambda c: F.upper(F.regexp_replace(F.col(c), "[^A-Za-z0-9]", ""))
    index = p.select(clean("p_brand").alias("key"), F.col("p_brand").alias("entity"), F.array(F.lit("G12")).alias("units")).distinct()
    asked = p.select(F.explode(F.array("p_type", F.concat(F.lit("G11_"), "p_type"), F.concat("p_brand", F.lit("-KH01")))).alias("q")).distinct()
    return resolvers.resolve_valves(asked, index, p.select(clean("p_type").alias("key"), F.col("p_brand").alias("entity")))


@query("""WITH s AS (SELECT c_name AS signal FROM customer WHERE c_custkey % 3 = 0 UNION ALL SELECT c_name || 'XQ01' FROM customer), t AS (SELECT c_name AS tag FROM customer WHERE c_custkey % 2 = 0 UNION ALL SELECT 'Customer#00000000')
SELECT signal, tag, CASE WHEN signal = tag THEN 'R1' ELSE 'R6' END AS rule FROM s JOIN t ON starts_with(signal, tag) QUALIFY row_number() OVER (PARTITION BY signal ORDER BY length(tag) DESC) = 1""")
def prefix_longest_match(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    signals = c.where("c_custkey % 3 = 0").select(F.col("c_name").alias("signal")).unionByName(c.select(F.concat("c_name", F.lit("XQ01")).alias("signal")))
    tags = c.where("c_custkey % 2 = 0").select(F.col("c_name").alias("tag")).unionByName(spark.createDataFrame([("Customer#00000000",)], "tag string"))
    return resolvers.longest_prefix(signals, tags)


@query("""WITH p AS (SELECT p_partkey AS k, p_size, 'HAD' || lpad(p_size::VARCHAR, 2, '0') || 'BP' || lpad((p_partkey % 1000)::VARCHAR, 3, '0') AS core FROM part), c AS (SELECT DISTINCT core FROM p WHERE p_size > 10),
d AS (SELECT k, substr(core, 1, (k % 10)::INT) || translate(substr(core, (k % 10 + 1)::INT, 1), '01245678DB', 'OIZASGTB08') || substr(core, (k % 10 + 2)::INT) AS t1 FROM p),
t AS (SELECT DISTINCT CASE WHEN k % 3 = 0 THEN substr(t1, 1, (k * 7 % 10)::INT) || translate(substr(t1, (k * 7 % 10 + 1)::INT, 1), '01245678DB', 'OIZASGTB08') || substr(t1, (k * 7 % 10 + 2)::INT) ELSE t1 END AS token FROM d),
f(kind, a, b) AS (VALUES ('D', 'O', '0'), ('D', 'Q', '0'), ('D', 'D', '0'), ('D', 'I', '1'), ('D', 'L', '1'), ('D', 'T', '17'), ('D', 'S', '5'), ('D', 'B', '8'), ('D', 'Z', '27'), ('D', 'G', '6'), ('D', 'A', '4'),
 ('L', '0', 'OQD'), ('L', '1', 'ILT'), ('L', '5', 'S'), ('L', '8', 'B'), ('L', '2', 'Z'), ('L', '6', 'G'), ('L', '4', 'A'), ('L', '7', 'TZ')),
r AS (SELECT token, core, generate_subscripts([1, 2, 3, 4, 5, 6, 7, 8, 9, 10], 1) AS i FROM t JOIN c ON length(token) = length(core) WHERE token NOT IN (SELECT core FROM c)),
m AS (SELECT token, core, sum(CASE WHEN substr(token, i, 1) = substr(core, i, 1) THEN 0 WHEN f.a IS NOT NULL THEN 1 ELSE 100 END) AS fixes FROM r LEFT JOIN f ON f.kind = substr('LLLDDLLDDD', i, 1) AND f.a = substr(token, i, 1) AND contains(f.b, substr(core, i, 1))
 GROUP BY 1, 2 HAVING sum(CASE WHEN substr(token, i, 1) = substr(core, i, 1) THEN 0 WHEN f.a IS NOT NULL THEN 1 ELSE 100 END) <= 2), o AS (SELECT token, min(fixes) AS fixes FROM m GROUP BY 1)
SELECT token, token AS core, 'known' AS how, 0 AS fixes FROM t WHERE token IN (SELECT core FROM c) UNION ALL SELECT token, min(core), 'repaired', fixes::INT FROM o JOIN m USING (token, fixes) GROUP BY token, fixes HAVING count(*) = 1""")
def scan_repair(spark, sf_dir):
    """Codes of which one or two characters are read as others that look alike; those of small parts are not known."""
    key = F.col("p_partkey")
    p = table(spark, sf_dir, "part").select(key, "p_size", F.concat(F.lit("HAD"), F.lpad(F.col("p_size").cast("string"), 2, "0"), F.lit("BP"), F.lpad((key % 1000).cast("string"), 3, "0")).alias("core"))

    def damaged(c, at):
        at = at.cast("int")
        return F.concat(F.substring(c, F.lit(1), at), F.translate(F.substring(c, at + 1, F.lit(1)), "01245678DB", "OIZASGTB08"), F.substring(c, at + 2, F.length(c)))

    once = damaged(F.col("core"), key % 10)
    tokens = p.select(F.when(key % 3 == 0, damaged(once, key * 7 % 10)).otherwise(once).alias("token"))
    return resolvers.repair(tokens, p.where("p_size > 10").select("core").distinct())


@query("""WITH e AS (SELECT s_suppkey AS entity, s_name AS tag, right(lpad((s_suppkey % 40)::VARCHAR, 7, '0'), 7) AS tail FROM supplier), c AS (SELECT c_custkey AS cert, 'Supplier' || substr(c_name, 9) AS tag, right(c_name, 7) AS tail FROM customer),
c2 AS (SELECT cert, CASE WHEN cert % 2 = 0 THEN tag ELSE 'none' END AS tag, tail FROM c), u AS (SELECT tail, min(entity) AS entity FROM e GROUP BY tail HAVING count(*) = 1), t AS (SELECT cert, entity FROM c2 JOIN e USING (tag))
SELECT cert, entity, 'tag' AS rule FROM t UNION ALL SELECT cert, entity, 'serial' FROM c2 JOIN u USING (tail) WHERE cert NOT IN (SELECT cert FROM t)""")
def unique_fallback_match(spark, sf_dir):
    return _certificates(spark, sf_dir, table(spark, sf_dir, "customer"))


def _certificates(spark, sf_dir, c):
    e = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("entity"), F.col("s_name").alias("tag"), F.concat(F.lit("SN-"), F.lpad((F.col("s_suppkey") % 40).cast("string"), 7, "0")).alias("serial"))
    tag = F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit("Supplier"), F.substring("c_name", 9, 99))).otherwise("none")
    return resolvers.serial_match(c.select(F.col("c_custkey").alias("cert"), tag.alias("tag"), F.col("c_name").alias("serial")), e)


@query("""WITH r AS (SELECT l_partkey, l_suppkey, l_orderkey, l_linenumber, l_quantity, l_quantity > 10 AS inferred FROM lineitem), k AS (SELECT *, bool_or(NOT inferred) OVER (PARTITION BY l_partkey) AS direct FROM r)
SELECT l_partkey, l_quantity, inferred FROM k WHERE NOT (direct AND inferred) QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY l_quantity) = 1""")
def direct_beats_inferred(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_partkey", "l_quantity", (F.col("l_quantity") > 10).alias("inferred"))
    return resolvers.direct_first(rows, ["l_partkey"], F.col("l_quantity"), "inferred")


@query("""WITH q(q) AS (VALUES ('00000001'), ('000000009'), ('0001')), i AS (SELECT q, 0 AS source, c_name AS key, row_number() OVER (PARTITION BY q ORDER BY c_name) AS position FROM customer, q WHERE contains(c_name, q) UNION ALL SELECT q, 1, s_name, row_number() OVER (PARTITION BY q ORDER BY s_name) FROM supplier, q WHERE contains(s_name, q)
UNION ALL SELECT q, 2, 'P' || lpad(p_partkey::VARCHAR, 9, '0'), row_number() OVER (PARTITION BY q ORDER BY p_partkey) FROM part, q WHERE contains('P' || lpad(p_partkey::VARCHAR, 9, '0'), q)), k AS (SELECT * FROM i WHERE position <= 12),
n AS (SELECT q, count(*) FILTER (source = 0) AS na, count(*) FILTER (source = 1) AS nb, count(*) FILTER (source = 2) AS nc, 12 - least(na, 8) AS room, least(nb, 6, room - least(nc, room // 2)) AS v, least(nc, room - v) AS g FROM k GROUP BY q)
SELECT q, source, key, row_number() OVER (PARTITION BY q ORDER BY source, position) AS slot FROM k JOIN n USING (q) WHERE position <= CASE source WHEN 0 THEN 12 - v - g WHEN 1 THEN v ELSE g END""")
def blended_suggestions(spark, sf_dir):
    from functools import reduce

    from pyspark.sql.window import Window as W

    q = spark.createDataFrame([("00000001",), ("000000009",), ("0001",)], "q string")
    names = [
        table(spark, sf_dir, "customer").select(F.col("c_name").alias("key")),
        table(spark, sf_dir, "supplier").select(F.col("s_name").alias("key")),
        table(spark, sf_dir, "part").select(F.concat(F.lit("P"), F.lpad(F.col("p_partkey").cast("string"), 9, "0")).alias("key")),
    ]
    top = F.row_number().over(W.partitionBy("q").orderBy("key"))
    parts = [entities.containing(q, d).select("q", "key").withColumn("position", top).where("position <= 12").withColumn("source", F.lit(i)) for i, d in enumerate(names)]
    return selection.blend(reduce(lambda a, b: a.unionByName(b), parts))


@query("""WITH h AS (SELECT o_custkey, o_orderkey, o_totalprice, o_orderpriority, o_orderstatus = 'F' AS direct, o_orderkey % 3 > 0 AS located FROM orders), a AS (SELECT *, bool_or(direct) OVER w AS d FROM h WINDOW w AS (PARTITION BY o_custkey)),
b AS (SELECT *, bool_or(located) OVER (PARTITION BY o_custkey) AS l FROM a WHERE direct OR NOT d), c AS (SELECT * FROM b WHERE located OR NOT l QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) = 1)
SELECT o_custkey, o_orderkey FROM c QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) <= 2""")
def screen_hits(spark, sf_dir):
    h = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderpriority", (F.col("o_orderstatus") == "F").alias("direct"), (F.col("o_orderkey") % 3 > 0).alias("located"))
    return selection.best_hits(h, "o_custkey", ["o_orderpriority"], "direct", "located", [F.desc("o_totalprice"), F.col("o_orderkey")], 2).select("o_custkey", "o_orderkey")


@query("""WITH b AS (SELECT s_name AS key, s_suppkey AS alias, 'tag' AS kind FROM supplier WHERE s_suppkey % 2 = 0), a AS (SELECT upper(replace(s_name, '#', '-')) AS key, s_suppkey AS alias FROM supplier WHERE s_suppkey % 3 = 0 UNION ALL SELECT 'NEW-' || p_brand, p_partkey FROM part)
SELECT key, alias, kind, 1 AS n_aliases FROM b UNION ALL SELECT key, min(alias), 'oem', count(DISTINCT alias) FROM a WHERE regexp_replace(upper(key), '[^A-Z0-9]', '', 'g') NOT IN (SELECT regexp_replace(upper(key), '[^A-Z0-9]', '', 'g') FROM b) GROUP BY key""")
def index_merge(spark, sf_dir):
    s = table(spark, sf_dir, "supplier")
    base = s.where("s_suppkey % 2 = 0").select(F.col("s_name").alias("key"), F.col("s_suppkey").alias("alias"), F.lit("tag").alias("kind"))
    left_before = s.where("s_suppkey % 5 = 0").select(F.concat(F.lit("OLD"), "s_name").alias("key"), F.col("s_suppkey").alias("alias"), F.lit("oem").alias("kind"))
    added = s.where("s_suppkey % 3 = 0").select(F.upper(F.replace("s_name", F.lit("#"), F.lit("-"))).alias("key"), F.col("s_suppkey").alias("alias")).unionByName(table(spark, sf_dir, "part").select(F.concat(F.lit("NEW-"), "p_brand").alias("key"), F.col("p_partkey").alias("alias")))
    return selection.merge_index(base.unionByName(left_before), added, "oem")


@query()
def ordered_cells(spark, sf_dir):
    """Each customer's orders above 200,000 matched in order to the orders below, by price in thousands."""
    o = table(spark, sf_dir, "orders").select("o_custkey", (F.col("o_totalprice") / 1000).alias("y"))
    return selection.ordered_assignment(o.where("y >= 200"), o.where("y < 200"), "o_custkey", "y", 60.0)


@query("""WITH z AS (SELECT n_nationkey AS zone, n_nationkey % 5 * 10.0 AS x0, n_nationkey % 5 * 10.0 + 9 AS x1, 900 + n_nationkey // 5 * 20.0 AS y0, 900 + n_nationkey // 5 * 20.0 + 15 + n_nationkey % 3 * 5 AS y1 FROM nation)
SELECT p_partkey AS id, zone FROM part JOIN z ON p_size BETWEEN x0 - 0.5 AND x1 + 0.5 AND p_retailprice BETWEEN y0 - 0.5 AND y1 + 0.5 QUALIFY row_number() OVER (PARTITION BY p_partkey ORDER BY (x1 - x0) * (y1 - y0), zone) = 1""")
def zone_lookup(spark, sf_dir):
    k, row = F.col("n_nationkey"), F.floor(F.col("n_nationkey") / 5)
    z = table(spark, sf_dir, "nation").select(k.alias("zone"), (k % 5 * 10.0).alias("x0"), (k % 5 * 10.0 + 9).alias("x1"), (900 + row * 20.0).alias("y0"), (900 + row * 20.0 + 15 + k % 3 * 5).alias("y1"))
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_size").alias("x"), F.col("p_retailprice").alias("y"))
    return selection.zones_of(p, z, 10.0, 0.5)


@query("""WITH r AS (SELECT l_returnflag, l_linestatus, l_linenumber, min(l_orderkey) AS pin FROM lineitem WHERE l_quantity < 3 AND l_returnflag <> 'R' AND NOT (l_returnflag = 'A' AND l_linestatus = 'F') AND l_linenumber < 5 GROUP BY 1, 2, 3)
SELECT l_orderkey, l_partkey, pin, CASE WHEN pin IS NOT NULL THEN NULL WHEN l_returnflag NOT IN (SELECT l_returnflag FROM r) THEN 'l_returnflag' WHEN (l_returnflag || l_linestatus) NOT IN (SELECT l_returnflag || l_linestatus FROM r) THEN 'l_linestatus' ELSE 'l_linenumber' END AS missing
FROM lineitem LEFT JOIN r USING (l_returnflag, l_linestatus, l_linenumber)""")
def terminal_lookup(spark, sf_dir):
    li, keys = table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus", "l_linenumber"]
    r = li.where("l_quantity < 3 AND l_returnflag <> 'R' AND NOT (l_returnflag = 'A' AND l_linestatus = 'F') AND l_linenumber < 5").groupBy(*keys).agg(F.min("l_orderkey").alias("pin"))
    return selection.lookup_with_reason(li.select("l_orderkey", "l_partkey", *keys), r, keys, "pin").select("l_orderkey", "l_partkey", "pin", "missing")


@query("""SELECT 'c' || c_custkey AS node, 'c' || c_custkey || '>n' || n_nationkey || CASE WHEN n_nationkey % 2 = 0 THEN '>r' || n_regionkey ELSE '' END AS path, 'end' AS ends, CASE WHEN n_nationkey % 2 = 0 THEN 'cable>panel' ELSE 'cable' END AS kinds FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def wiring_paths(spark, sf_dir):
    c, n = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    tag = lambda p, k: F.concat(F.lit(p), F.col(k).cast("string"))
    links = c.select(tag("c", "c_custkey").alias("a"), tag("n", "c_nationkey").alias("b"), F.lit("cable").alias("kind")).unionByName(n.where("n_nationkey % 2 = 0").select(tag("n", "n_nationkey"), tag("r", "n_regionkey"), F.lit("panel")).toDF("a", "b", "kind"))
    found = selection.chains(c.select(tag("c", "c_custkey").alias("node")), links, 4)
    return found.select("node", F.array_join("path", ">").alias("path"), "ends", F.array_join("kinds", ">").alias("kinds"))


@query("""SELECT s_suppkey, CASE WHEN s_acctbal < 0 THEN 'sink' WHEN s_nationkey < 5 THEN 'source' WHEN s_suppkey % 2 = 0 THEN 'loop' ELSE 'unknown' END AS signal FROM supplier""")
def signal_rules(spark, sf_dir):
    rules = [(F.col("s_acctbal") < 0, "sink"), (F.col("s_nationkey") < 5, "source"), (F.col("s_suppkey") % 2 == 0, "loop")]
    return table(spark, sf_dir, "supplier").select("s_suppkey", selection.first_rule(rules, "unknown").alias("signal"))


@query("""SELECT l_orderkey, l_linenumber, count(DISTINCT l_partkey) AS entities, count(DISTINCT l_suppkey) AS claims FROM lineitem GROUP BY 1, 2 HAVING count(DISTINCT l_partkey) >= 2 AND count(DISTINCT l_suppkey) >= 2 AND NOT bool_or(l_shipdate >= DATE '2000-01-01')""")
def shared_key_groups(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").withColumn("label", F.when(F.col("l_shipdate") >= F.lit("2000-01-01").cast("date"), "A/2").otherwise("A"))
    return selection.shared_boxes(li, ["l_orderkey", "l_linenumber"], "l_partkey", "l_suppkey", "label")


@query("""SELECT 'o_orderstatus' AS column""")
def header_facets(spark, sf_dir):
    return selection.header_column(table(spark, sf_dir, "orders"), ["F", "O", "P"], ["o_orderstatus", "o_orderpriority"])


@query("""WITH i AS (SELECT c_custkey, c_custkey * 3 AS s FROM customer), w AS (SELECT c_custkey, s + k AS row FROM i, (VALUES (0), (1), (2)) AS t(k)) SELECT c_custkey, count(*) AS rows, bool_and(o_custkey = c_custkey OR o_totalprice > 100000) AS all_own FROM w JOIN orders ON row = o_orderkey GROUP BY 1""")
def owner_check(spark, sf_dir):
    i = table(spark, sf_dir, "customer").select("c_custkey", (F.col("c_custkey") * 3).alias("start"), F.lit(3).alias("n"))
    owner = F.when(F.col("o_totalprice") > 100000, F.floor(F.col("o_orderkey") / 3)).otherwise(F.col("o_custkey"))
    return selection.owner_check(i, table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("row"), owner.alias("owner")), "c_custkey", "start", "n", "row", "owner")


@query("""WITH f AS (SELECT c_custkey, 'name' AS field, c_name AS value, 1 AS level, 'customer' AS source FROM customer UNION ALL SELECT c_custkey, 'segment', nullif(c_mktsegment, 'MACHINERY'), 2, 'customer' FROM customer UNION ALL SELECT c_custkey, 'nation', n_name, 1, 'nation' FROM customer JOIN nation ON c_nationkey = n_nationkey)
SELECT c_custkey, field, coalesce(value, '—') AS value, CASE WHEN value IS NULL THEN 0 ELSE level END AS level, source FROM f""")
def evidence_card(spark, sf_dir):
    """Facts of an entity as rows: field, value, level of evidence (0 where there is none) and source."""
    j = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    fact = lambda f, v, n, s: F.struct(F.lit(f).alias("field"), F.coalesce(v, F.lit("—")).alias("value"), F.when(v.isNull(), 0).otherwise(n).alias("level"), F.lit(s).alias("source"))
    facts = [fact("name", F.col("c_name"), 1, "customer"), fact("segment", F.nullif("c_mktsegment", F.lit("MACHINERY")), 2, "customer"), fact("nation", F.col("n_name"), 1, "nation")]
    return j.select("c_custkey", F.inline(F.array(*facts)))
