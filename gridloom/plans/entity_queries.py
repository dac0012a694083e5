"""Queries that join: entity resolution, dimension chains, coverage, hierarchy, selection."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from gridloom.operators import entities
from gridloom.plans.registry import query, table


@query("""SELECT r_name, n_name, count(DISTINCT o_orderkey) AS orders, sum(l_extendedprice * (1 - l_discount)) AS revenue FROM region JOIN nation ON n_regionkey = r_regionkey JOIN customer ON c_nationkey = n_nationkey
JOIN orders ON o_custkey = c_custkey JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1, 2""")
def assignment_chain(spark, sf_dir):
    t = lambda n: table(spark, sf_dir, n)
    per_order = t("lineitem").groupBy("l_orderkey").agg(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revenue"))
    nation = t("nation").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "n_name", "r_name")
    return t("orders").join(per_order, F.col("o_orderkey") == F.col("l_orderkey")).join(t("customer"), F.col("o_custkey") == F.col("c_custkey")).join(nation, F.col("c_nationkey") == F.col("n_nationkey")).groupBy("r_name", "n_name").agg(F.count(F.lit(1)).alias("orders"), F.sum("revenue").alias("revenue"))


@query("""SELECT p_partkey, coalesce(nullif(s_name, 'Supplier#000000001'), n_name, 'none') AS unit FROM part LEFT JOIN supplier ON s_suppkey = p_partkey LEFT JOIN nation ON n_nationkey = s_nationkey""")
def fallback_join(spark, sf_dir):
    t = lambda n: table(spark, sf_dir, n)
    j = t("part").join(t("supplier"), F.col("s_suppkey") == F.col("p_partkey"), "left").join(t("nation"), F.col("n_nationkey") == F.col("s_nationkey"), "left")
    return j.select("p_partkey", F.coalesce(F.nullif("s_name", F.lit("Supplier#000000001")), "n_name", F.lit("none")).alias("unit"))


_NAMES = [("Customer#000000007",), ("customer 000000008",), ("see Supplier#000000003 below",), ("no such thing",), ("Customer#000000011 and Supplier#000000004",)]


@query("""WITH q(q) AS (VALUES ('Customer#000000007'), ('customer 000000008'), ('see Supplier#000000003 below'), ('no such thing'), ('Customer#000000011 and Supplier#000000004')),
i AS (SELECT c_name AS key, 'C' || c_custkey AS alias FROM customer UNION ALL SELECT s_name, 'S' || s_suppkey FROM supplier), x AS (SELECT key, alias, regexp_replace(upper(key), '[^A-Z0-9]', '', 'g') AS kc FROM i),
c AS (SELECT q.q, alias, CASE WHEN upper(q.q) = upper(key) THEN 1 WHEN regexp_replace(upper(q.q), '[^A-Z0-9]', '', 'g') = kc THEN 2 WHEN length(kc) >= 6 AND contains(regexp_replace(upper(q.q), '[^A-Z0-9]', '', 'g'), kc) THEN 3 END AS rank, length(kc) AS len FROM q, x)
SELECT q, alias, CASE rank WHEN 1 THEN 'exact' WHEN 2 THEN 'compact' ELSE 'contains' END AS rule FROM c WHERE rank IS NOT NULL QUALIFY row_number() OVER (PARTITION BY q ORDER BY rank, len DESC, alias) = 1""")
def resolve_cascade(spark, sf_dir):
    c, s = table(spark, sf_dir, "customer"), table(spark, sf_dir, "supplier")
    index = c.select(F.col("c_name").alias("key"), F.concat(F.lit("C"), "c_custkey").alias("alias")).unionByName(s.select(F.col("s_name").alias("key"), F.concat(F.lit("S"), "s_suppkey").alias("alias")))
    return entities.resolve(spark.createDataFrame(_NAMES, "q string"), index)


@query("""WITH q(q) AS (VALUES ('brand#1'), ('BRAND#22'), ('#3')), k AS (SELECT DISTINCT p_brand AS key FROM part), h AS (SELECT q, key, CASE WHEN lower(key) = lower(q) THEN 0 WHEN starts_with(lower(key), lower(q)) THEN 1 ELSE 2 END AS kind FROM q, k WHERE contains(lower(key), lower(q)))
SELECT q, key, kind, row_number() OVER (PARTITION BY q ORDER BY kind, key) AS position FROM h QUALIFY position <= 4""")
def suggestions(spark, sf_dir):
    index = table(spark, sf_dir, "part").select(F.col("p_brand").alias("key")).distinct()
    return entities.suggest(spark.createDataFrame([("brand#1",), ("BRAND#22",), ("#3",)], "q string"), index, 4)


@query("""WITH f AS (SELECT c_mktsegment AS key, n_name, min(c_custkey) AS first FROM customer JOIN nation ON n_nationkey = c_nationkey GROUP BY 1, 2) SELECT key, list(n_name ORDER BY first) AS aliases, count(*) AS n FROM f GROUP BY 1""")
def alias_fanout(spark, sf_dir):
    """All aliases of a key, in order of appearance."""
    j = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("n_nationkey") == F.col("c_nationkey"))
    first = j.groupBy(F.col("c_mktsegment").alias("key"), "n_name").agg(F.min("c_custkey").alias("first"))
    return first.groupBy("key").agg(F.transform(F.array_sort(F.collect_list(F.struct("first", "n_name"))), lambda x: x["n_name"]).alias("aliases"), F.count(F.lit(1)).alias("n"))


@query("""WITH l AS (SELECT p_partkey, 'Supplier#' || lpad(p_partkey::VARCHAR, 9, '0') AS code, p_partkey % 100 AS family FROM part), r AS (SELECT s_suppkey AS id, s_name AS code, s_suppkey % 100 AS family FROM supplier),
a AS (SELECT p_partkey, id AS match, 1 AS tier FROM l JOIN r USING (code)) SELECT * FROM a UNION ALL SELECT p_partkey, id, 2 FROM l JOIN r USING (family) WHERE l.code NOT IN (SELECT code FROM r)""")
def two_tier_match(spark, sf_dir):
    """All parts against all suppliers, by the whole code or else by its last two digits."""
    code = F.concat(F.lit("Supplier#"), F.lpad(F.col("p_partkey").cast("string"), 9, "0"))
    left = table(spark, sf_dir, "part").select("p_partkey", code.alias("code"), (F.col("p_partkey") % 100).alias("family"))
    right = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("code"), (F.col("s_suppkey") % 100).alias("family"))
    return entities.two_tier(left, right, "code", "family").select("p_partkey", "match", "tier")


@query("""SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'O')""")
def superseded_only(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.where("o_orderstatus = 'F'").select("o_custkey").distinct().join(o.where("o_orderstatus = 'O'").select("o_custkey"), "o_custkey", "left_anti")


@query("""SELECT p_partkey FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity = 50)""")
def in_list(spark, sf_dir):
    return table(spark, sf_dir, "part").join(table(spark, sf_dir, "lineitem").where("l_quantity = 50").select(F.col("l_partkey").alias("p_partkey")), "p_partkey", "left_semi").select("p_partkey")


@query("""SELECT l_partkey, l_suppkey, votes FROM (SELECT l_partkey, l_suppkey, count(*) AS votes, row_number() OVER (PARTITION BY l_partkey ORDER BY count(*) DESC, l_suppkey) AS rn FROM lineitem GROUP BY 1, 2) WHERE rn = 1""")
def majority_supplier(spark, sf_dir):
    return entities.majority(table(spark, sf_dir, "lineitem"), ["l_partkey"], "l_suppkey")


@query("""WITH s AS (SELECT o_custkey, o_orderkey, bool_or(l_returnflag = 'R') AS drawn FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1, 2)
SELECT o_custkey, count(*) AS signals, count(*) FILTER (coalesce(drawn, false)) AS drawn, CASE WHEN count(*) = count(*) FILTER (coalesce(drawn, false)) THEN 'all' WHEN count(*) FILTER (coalesce(drawn, false)) > 0 THEN 'some' ELSE 'none' END AS cover FROM s GROUP BY 1""")
def coverage_rollup(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.bool_or(F.col("l_returnflag") == "R").alias("drawn"))
    s = table(spark, sf_dir, "orders").join(li, "o_orderkey", "left").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("signals"), F.count_if(F.coalesce("drawn", F.lit(False))).alias("drawn"))
    return s.withColumn("cover", F.when(F.col("signals") == F.col("drawn"), "all").when(F.col("drawn") > 0, "some").otherwise("none"))


@query("""WITH b AS (SELECT *, min(o_orderpriority) OVER (PARTITION BY o_custkey) AS best FROM orders), k AS (SELECT o_custkey, o_orderkey, dense_rank() OVER (PARTITION BY o_custkey ORDER BY o_orderstatus) AS g, row_number() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_totalprice DESC, o_orderkey) AS r FROM b WHERE o_orderpriority = best)
SELECT o_custkey, o_orderkey FROM k WHERE g <= 2 AND r <= 3""")
def best_class_cap(spark, sf_dir):
    return entities.best_class(table(spark, sf_dir, "orders"), "o_custkey", "o_orderpriority", "o_orderstatus", [F.desc("o_totalprice"), F.col("o_orderkey")], 2, 3).select("o_custkey", "o_orderkey")


@query("""WITH b AS (SELECT *, min(o_orderpriority) OVER (PARTITION BY o_custkey) AS best FROM orders), k AS (SELECT o_custkey, o_orderkey, dense_rank() OVER (PARTITION BY o_custkey ORDER BY o_orderstatus) AS g, row_number() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_totalprice DESC, o_orderkey) AS r FROM b WHERE o_orderpriority = best OR o_orderkey % 6 = 0)
SELECT o_custkey, o_orderkey FROM k WHERE g <= 2 AND r <= 3""")
def best_class_beside_exact(spark, sf_dir):
    """Every sixth order counts whatever its class."""
    return entities.best_class(table(spark, sf_dir, "orders"), "o_custkey", "o_orderpriority", "o_orderstatus", [F.desc("o_totalprice"), F.col("o_orderkey")], 2, 3, F.col("o_orderkey") % 6 == 0).select("o_custkey", "o_orderkey")


@query("""WITH v AS (SELECT p_name, p_partkey, p_retailprice, coalesce(p_size % 3 = 0 AND p_name <> 'blue ring', false) AS u FROM part), b AS (SELECT *, coalesce(max(p_partkey) FILTER (u) OVER (PARTITION BY p_name), max(p_partkey) OVER (PARTITION BY p_name)) AS best FROM v)
SELECT p_name, p_partkey, p_partkey = best AS chosen, CASE WHEN p_partkey = best THEN CASE WHEN u THEN 'newest' ELSE 'none usable' END WHEN u THEN 'older' WHEN p_partkey > best THEN 'newer, unusable' ELSE 'unusable' END AS why FROM b""")
def usable_versions(spark, sf_dir):
    """Of each name the newest part that can be used, and why the others are not taken."""
    p = table(spark, sf_dir, "part").select("p_name", "p_partkey", "p_size")
    return entities.usable_version(p, "p_name", ["p_partkey"], (F.col("p_size") % 3 == 0) & (F.col("p_name") != "blue ring")).drop("p_size")


@query("""WITH r AS (SELECT p_name, p_partkey, CASE p_partkey % 4 WHEN 0 THEN p_size::VARCHAR WHEN 1 THEN p_size || 'A' WHEN 2 THEN chr(65 + p_size % 26) ELSE '' END AS rev, p_size FROM part),
k AS (SELECT *, CASE p_partkey % 4 WHEN 0 THEN 2 WHEN 1 THEN 2 WHEN 2 THEN 1 ELSE 0 END AS c, CASE WHEN p_partkey % 4 <= 1 THEN p_size WHEN p_partkey % 4 = 2 THEN 1 ELSE 0 END AS n, CASE p_partkey % 4 WHEN 1 THEN 'A' WHEN 2 THEN rev ELSE '' END AS s FROM r)
SELECT p_name, p_partkey, rev FROM k QUALIFY row_number() OVER (PARTITION BY p_name ORDER BY c DESC, n DESC, s DESC, p_partkey) = 1""")
def newest_revision(spark, sf_dir):
    m = F.col("p_partkey") % 4
    p = table(spark, sf_dir, "part").withColumn("rev", F.when(m == 0, F.col("p_size").cast("string")).when(m == 1, F.concat(F.col("p_size").cast("string"), F.lit("A"))).when(m == 2, F.chr((F.lit(65) + F.col("p_size") % 26).cast("long"))).otherwise(""))
    best = F.row_number().over(W.partitionBy("p_name").orderBy(entities.revision_key(F.col("rev")).desc(), "p_partkey"))
    return p.withColumn("rn", best).where("rn = 1").select("p_name", "p_partkey", "rev")


@query("""SELECT 'r' || r_regionkey AS node, r_name AS path, 0 AS depth FROM region UNION ALL SELECT 'n' || n_nationkey, r_name || '/' || n_name, 1 FROM nation JOIN region ON n_regionkey = r_regionkey
UNION ALL SELECT 'c' || c_custkey, r_name || '/' || n_name || '/' || c_name, 2 FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def hierarchy_paths(spark, sf_dir):
    r, n, c = (table(spark, sf_dir, x) for x in ("region", "nation", "customer"))
    tag = lambda p, k: F.concat(F.lit(p), F.col(k).cast("string"))
    edges = n.select(tag("n", "n_nationkey").alias("child"), tag("r", "n_regionkey").alias("parent"), F.col("n_name").alias("name")).unionByName(c.select(tag("c", "c_custkey").alias("child"), tag("n", "c_nationkey").alias("parent"), F.col("c_name").alias("name")))
    return entities.paths(edges, r.select(tag("r", "r_regionkey").alias("node"), F.col("r_name").alias("name")), most=2)


@query("""WITH e AS (SELECT DISTINCT n_nationkey AS a, (n_nationkey * 2 + 1) % 25 AS b FROM nation), h1 AS (SELECT a AS node, b AS target, 1 AS hops FROM e), h2 AS (SELECT h1.node, e.b, 2 FROM h1 JOIN e ON h1.target = e.a), h3 AS (SELECT h2.node, e.b, 3 FROM h2 JOIN e ON h2.b = e.a)
SELECT node, target, min(hops) AS hops FROM (SELECT * FROM h1 UNION ALL SELECT * FROM h2 UNION ALL SELECT * FROM h3) WHERE node <> target GROUP BY 1, 2""")
def signal_hops(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    edges = n.select(F.col("n_nationkey").alias("a"), ((F.col("n_nationkey") * 2 + 1) % 25).alias("b"))
    return entities.hops(edges, n.select(F.col("n_nationkey").alias("node")), 3).where("node <> target")


@query("""WITH w AS (SELECT DISTINCT p_name AS name FROM part), q(q) AS (VALUES ('blue blot'), ('bleu anvil'))
SELECT q, name, damerau_levenshtein(q, name)::INT AS d FROM q, w WHERE abs(length(q) - length(name)) <= 2 AND damerau_levenshtein(q, name) <= 2""")
def fuzzy_names(spark, sf_dir):
    from gridloom.session import ship

    ship(spark)
    words = table(spark, sf_dir, "part").select(F.col("p_name").alias("name")).distinct()
    q = spark.createDataFrame([("blue blot",), ("bleu anvil",)], "q string")
    # by length, so that it is an equi-join
    near = words.withColumn("_n", F.explode(F.sequence(F.length("name") - 2, F.length("name") + 2))).join(q.withColumn("_n", F.length("q")), "_n").drop("_n")
    return near.withColumn("d", entities.osa_distance(F.col("q"), F.col("name"), 2)).where("d <= 2")


@query("""WITH a AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS i FROM orders), b AS (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) AS i FROM customer)
SELECT i, o_orderkey, c_custkey, CASE WHEN o_orderkey IS NULL THEN 'left missing' WHEN c_custkey IS NULL THEN 'right missing' WHEN o_orderkey <> c_custkey THEN 'differs' ELSE 'same' END AS reason FROM a FULL JOIN b USING (i)""")
def positional_audit(spark, sf_dir):
    return entities.positional(table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer"), "o_orderkey", "c_custkey")


@query("""WITH x AS (SELECT s_suppkey, u FROM supplier, (VALUES ('G11'), ('G12')) AS t(u)), d AS (SELECT * FROM x WHERE NOT (s_suppkey % 10 = 0 AND u = 'G12') UNION ALL SELECT 0, 'C10')
SELECT s_suppkey, u AS unit, CASE WHEN s_suppkey = 5 THEN 'checked' END AS note FROM d""")
def crosswalk_overrides(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").select("s_suppkey", F.explode(F.array(F.lit("G11"), F.lit("G12"))).alias("unit"))
    drop = table(spark, sf_dir, "supplier").where("s_suppkey % 10 = 0").select("s_suppkey", F.lit("G12").alias("unit"))
    add = spark.createDataFrame([(0, "C10")], "s_suppkey long, unit string")
    notes = spark.createDataFrame([(5, "checked")], "s_suppkey long, note string")
    return s.join(drop, ["s_suppkey", "unit"], "left_anti").unionByName(add).join(notes, "s_suppkey", "left")


@query("""WITH a AS (SELECT c_nationkey, list(DISTINCT c_mktsegment) AS x FROM customer WHERE c_acctbal > 5000 GROUP BY 1), b AS (SELECT c_nationkey, list(DISTINCT c_mktsegment) AS y FROM customer WHERE c_acctbal <= 0 GROUP BY 1)
SELECT c_nationkey, len(list_intersect(x, y)) / len(list_distinct(list_concat(x, y)))::DOUBLE AS jaccard FROM a JOIN b USING (c_nationkey)""")
def family_overlap(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    a = c.where("c_acctbal > 5000").groupBy("c_nationkey").agg(F.collect_set("c_mktsegment").alias("x"))
    b = c.where("c_acctbal <= 0").groupBy("c_nationkey").agg(F.collect_set("c_mktsegment").alias("y"))
    return a.join(b, "c_nationkey").select("c_nationkey", (F.size(F.array_intersect("x", "y")) / F.size(F.array_union("x", "y"))).alias("jaccard"))


@query("""SELECT l_orderkey, l_partkey, 'no part' AS problem FROM lineitem WHERE l_partkey % 1000 NOT IN (SELECT p_partkey FROM part WHERE p_size > 3)""")
def link_audit(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").withColumn("to", F.col("l_partkey") % 1000).join(table(spark, sf_dir, "part").where("p_size > 3").select(F.col("p_partkey").alias("to")), "to", "left_anti").select("l_orderkey", "l_partkey", F.lit("no part").alias("problem"))


@query("""SELECT p_name, min(p_partkey) AS first_key, count(*) AS merged FROM part GROUP BY regexp_replace(upper(p_name), '[^A-Z0-9]', '', 'g'), p_name""")
def ordered_dedupe(spark, sf_dir):
    from gridloom.functions.text import compact

    p = table(spark, sf_dir, "part")
    return p.groupBy(compact(F.col("p_name")).alias("k")).agg(F.min_by("p_name", "p_partkey").alias("p_name"), F.min("p_partkey").alias("first_key"), F.count(F.lit(1)).alias("merged")).select("p_name", "first_key", "merged")


@query()
def turn_alignment(spark, sf_dir):
    """Longest common subsequence of the roles of each conversation and of the conversation after it."""
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role")
    return entities.lcs_pairs(c, c.select((F.col("conv_id") - 1).alias("conv_id"), "turn", "role"), "conv_id", "turn", "role")
