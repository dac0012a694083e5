"""Queries over one table: filters, searches, facets, sorting, functions, formats, rules."""

from __future__ import annotations


from pyspark.sql import functions as F

from gridloom.functions import sheet, text, units
from gridloom.functions.predicates import card_rule, compile_filter, compile_filters, criterion, row_search, term_search, two_pass_search
from gridloom.operators import documents, facets, matching, rules, sorting
from gridloom.plans.registry import query, table


@query("""
WITH d AS (SELECT o_orderstatus, o_orderpriority, o_orderstatus = 'F' AS p1, starts_with(lower(o_orderpriority), '1') AS p2, o_totalprice >= 100000 AS p3 FROM orders)
SELECT 'o_orderstatus' AS facet, o_orderstatus AS value, count(*) AS n FROM d WHERE p2 AND p3 GROUP BY 2
UNION ALL SELECT 'o_orderpriority', o_orderpriority, count(*) FROM d WHERE p1 AND p3 GROUP BY 2""")
def table_live_facets(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    filters = compile_filters(orders, {"o_orderstatus": "=f", "o_orderpriority": "^1", "o_totalprice": ">= 100000", "no_such": "x"})
    return facets.live_facets(orders, filters, ["o_orderstatus", "o_orderpriority"])


_SPECS = [(">= 1500", "p_retailprice"), ("==5", "p_size"), ("=5", "p_size"), ("< 10.5", "p_size"), ("^brand#1", "p_brand"), ("!brand#1", "p_brand"), ('"brand#2"', "p_brand"), ("STEEL", "p_type"), ("∅", "p_name"), ("!∅", "p_name"), ('"brand', "p_brand"), ("(非空白)", "p_name"), (">1e3", "p_retailprice"), ("= brand#11", "p_brand"), ("<=-5", "p_size")]


@query("""
SELECT * FROM (
SELECT '>= 1500' AS spec, count(*) FILTER (p_retailprice >= 1500) AS n FROM part UNION ALL SELECT '==5', count(*) FILTER (p_size = 5) FROM part UNION ALL SELECT '=5', count(*) FILTER (p_size = 5) FROM part
UNION ALL SELECT '< 10.5', count(*) FILTER (p_size < 10.5) FROM part UNION ALL SELECT '^brand#1', count(*) FILTER (lower(p_brand) LIKE 'brand#1%') FROM part UNION ALL SELECT '!brand#1', count(*) FILTER (lower(p_brand) NOT LIKE '%brand#1%') FROM part
UNION ALL SELECT '"brand#2"', count(*) FILTER (lower(p_brand) LIKE '%brand#2%') FROM part UNION ALL SELECT 'STEEL', count(*) FILTER (lower(p_type) LIKE '%steel%') FROM part
UNION ALL SELECT '∅', count(*) FILTER (p_name IS NULL OR p_name = '') FROM part UNION ALL SELECT '!∅', count(*) FILTER (p_name IS NOT NULL AND p_name <> '') FROM part UNION ALL SELECT '"brand', count(*) FILTER (contains(lower(p_brand), '"brand')) FROM part UNION ALL SELECT '(非空白)', count(*) FILTER (p_name <> '') FROM part
UNION ALL SELECT '>1e3', count(*) FILTER (contains(p_retailprice::VARCHAR, '>1e3')) FROM part UNION ALL SELECT '= brand#11', count(*) FILTER (lower(p_brand) = ' brand#11') FROM part UNION ALL SELECT '<=-5', count(*) FILTER (p_size <= -5) FROM part)""")
def filter_language(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    one = part.agg(*(F.count_if(compile_filter(s, part[c])).alias(f"n{i}") for i, (s, c) in enumerate(_SPECS)))
    return one.select(F.explode(F.array(*(F.struct(F.lit(s).alias("spec"), F.col(f"n{i}").alias("n")) for i, (s, _) in enumerate(_SPECS)))).alias("x")).select("x.*")


@query("SELECT c_custkey, c_name FROM customer WHERE contains(lower(c_name || chr(1) || c_mktsegment), '01')")
def row_text_search(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    return c.where(row_search([c.c_name, c.c_mktsegment], "01")).select("c_custkey", "c_name")


@query("SELECT s_suppkey, s_name FROM supplier WHERE contains(replace(replace(lower(s_name), '-', ''), '_', ''), 'supplier#00000001') AND NOT EXISTS (SELECT 1 FROM supplier WHERE contains(lower(s_name), 'supplier-#00000001'))")
def compact_search(spark, sf_dir):
    s = table(spark, sf_dir, "supplier")
    return two_pass_search(s.withColumn("tag", F.replace("s_name", F.lit("#"), F.lit("-"))), [F.col("tag")], "supplier_00000001").select("s_suppkey", "s_name")


@query("SELECT p_partkey FROM part WHERE (contains(lower(p_type), 'steel') AND contains(lower(p_type), 'large')) OR contains(lower(p_type), 'tin')")
def term_groups(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return p.where(term_search(p.p_type, "steel large, tin")).select("p_partkey")


@query("""SELECT count(*) FILTER (p_size >= 25) AS big, count(*) FILTER (lower(p_brand) LIKE 'brand#_2') AS wild, count(*) FILTER (NOT lower(p_brand) LIKE 'brand#1%') AS unlike,
count(*) FILTER (p_size >= 10 AND p_size < 20) AS both, count(DISTINCT lower(p_brand)) AS brands, count(p_name) AS filled FROM part""")
def countif_criteria(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return p.agg(F.count_if(criterion(">=25", p.p_size)).alias("big"), F.count_if(criterion("brand#?2", p.p_brand)).alias("wild"), F.count_if(criterion("<>brand#1*", p.p_brand)).alias("unlike"), F.count_if(criterion(">=10", p.p_size) & criterion("<20", p.p_size)).alias("both"), sheet.distinct_text(p.p_brand).alias("brands"), F.count("p_name").alias("filled"))


@query("""SELECT c_custkey, array_to_string(list_transform(regexp_extract_all(lower(c_name), '([0-9]+|[^0-9]+)'), lambda x: CASE WHEN regexp_matches(x, '^[0-9]') THEN lpad(regexp_replace(x, '^0+', ''), 14, '0') ELSE x END), '') AS natkey FROM customer""")
def natural_keys(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", text.natural_key(F.col("c_name")).alias("natkey"))


@query("""SELECT p_partkey, p_size, p_brand FROM part ORDER BY p_size DESC, regexp_extract(p_brand, '[0-9]+')::INT, p_partkey LIMIT 50""")
def natural_sort_top(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    size = text.number_of(p.p_size)
    return p.orderBy(text.is_blank(p.p_size), size.desc(), text.natural_key(p.p_brand), "p_partkey").limit(50).select("p_partkey", "p_size", "p_brand")


@query("SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderkey < 1000 ORDER BY o_orderkey DESC LIMIT 300")
def keyset_page(spark, sf_dir):
    return table(spark, sf_dir, "orders").where("o_orderkey < 1000").orderBy(F.desc("o_orderkey")).limit(300).select("o_orderkey", "o_orderdate")


@query("""WITH v AS (SELECT coalesce(nullif(CASE WHEN p_partkey % 10 = 0 THEN '' ELSE p_brand END, ''), '∅') AS value, count(*) AS n FROM part GROUP BY 1), l(value, f, o) AS (VALUES ('Brand#7', 0, 0), ('Brand#77', 1, 1), ('Brand#99', NULL, 2), ('Brand#3', NULL, 3))
SELECT value, coalesce(n, 0)::BIGINT AS n, row_number() OVER (ORDER BY CASE WHEN value = '∅' THEN 3 WHEN f IS NOT NULL THEN 0 WHEN n IS NOT NULL THEN 1 ELSE 2 END, coalesce(f, CASE WHEN n IS NULL THEN o END) NULLS FIRST, value) AS place FROM v FULL JOIN l USING (value)""")
def facet_with_options(spark, sf_dir):
    """Two values in a declared order, two options of which one occurs, and blanks."""
    p = table(spark, sf_dir, "part").withColumn("brand", F.when(F.col("p_partkey") % 10 == 0, "").otherwise(F.col("p_brand")))
    return facets.facet_counts(p, "brand", ["Brand#99", "Brand#3"], ["Brand#7", "Brand#77"])


@query("""SELECT * FROM (SELECT 'p_name' AS "column", count(DISTINCT p_name) AS n_unique FROM part UNION ALL SELECT 'p_brand', count(DISTINCT p_brand) FROM part UNION ALL SELECT 'p_type', count(DISTINCT p_type) FROM part) WHERE n_unique BETWEEN 2 AND 40""")
def auto_facets(spark, sf_dir):
    return facets.auto_facets(table(spark, sf_dir, "part"))


@query("""SELECT 'o_orderkey' AS "column", count(*) AS n_rows, 0::BIGINT AS n_blank, count(*) AS n_numeric, 0::BIGINT AS n_text, max(length(o_orderkey::VARCHAR)) AS max_len FROM orders
UNION ALL SELECT 'o_orderstatus', count(*), 0, 0, count(*), max(length(o_orderstatus)) FROM orders""")
def column_profile(spark, sf_dir):
    return facets.profile(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"))


@query(r"""SELECT c_custkey, upper(replace(c_name, '=', '')) AS normed, regexp_replace(upper(c_name), '[^A-Z0-9]', '', 'g') AS compacted, translate(upper(c_name), 'SOQILBZ', '5001182') AS folded,
CASE WHEN c_custkey = -1 THEN NULL ELSE concat_ws('.', (c_custkey >> 24) & 255, (c_custkey >> 16) & 255, (c_custkey >> 8) & 255, c_custkey & 255) END AS ip, regexp_replace('00' || c_custkey, '^0+([0-9])', '\1') AS id0,
greatest(1, ceil(c_nationkey / 4.0))::INT AS safety FROM customer""")
def tag_functions(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    return c.select("c_custkey", text.norm(c.c_name).alias("normed"), text.compact(c.c_name).alias("compacted"), text.confusable(F.upper("c_name")).alias("folded"), text.ipv4(c.c_custkey).alias("ip"), text.canonical_id(F.concat(F.lit("00"), c.c_custkey.cast("string"))).alias("id0"), text.safety_stock(c.c_nationkey).alias("safety"))


@query(r"""SELECT p_partkey, p_size > 20 AS big, round(p_retailprice, 1) AS r1, floor(p_retailprice)::BIGINT AS i, left(p_name, 3) AS l3, right(p_name, 3) AS r3, substr(p_name, 2, 4) AS m, nullif(strpos(lower(p_type), 'steel'), 0)::INT AS s,
replace(p_type, 'STEEL', 'IRON') AS sub, p_retailprice / nullif(p_size - 1, 0) AS per, length(p_type)::INT AS n, (DATE '2020-01-01' + to_months(p_size - 1))::DATE AS d FROM part""")
def sheet_functions(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return p.select(
        "p_partkey", (p.p_size > 20).alias("big"), sheet.round_(p.p_retailprice, 1).alias("r1"), sheet.int_(p.p_retailprice).alias("i"), sheet.left(p.p_name, 3).alias("l3"), sheet.right(p.p_name, 3).alias("r3"), sheet.mid(p.p_name, 2, 4).alias("m"),
        sheet.search("STEEL", p.p_type).alias("s"), sheet.substitute(p.p_type, "STEEL", "IRON").alias("sub"), sheet.divide(p.p_retailprice, p.p_size - 1).alias("per"), F.length("p_type").alias("n"), sheet.date(F.lit(2020), p.p_size, F.lit(1)).alias("d"),
    )


@query("""SELECT p_brand, avg(p_retailprice) AS mean, min(p_retailprice) AS lo, max(p_retailprice) AS hi, sum(p_retailprice * p_size) AS product, 0::DOUBLE AS none FROM part GROUP BY 1""")
def sheet_aggregates(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return p.groupBy("p_brand").agg(sheet.average(p.p_retailprice).alias("mean"), sheet.min_(p.p_retailprice).alias("lo"), sheet.max_(p.p_retailprice).alias("hi"), sheet.sumproduct(p.p_retailprice, p.p_size).alias("product"), sheet.min_(p.p_name).alias("none"))


@query(r"""SELECT event_id, CASE WHEN contains(props, '"') THEN '"' || replace(props, '"', '""') || '"' ELSE props END AS field, CASE WHEN event_type = 'error' THEN '''=' || event_type ELSE event_type END AS guarded FROM events""")
def csv_fields(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.select("event_id", text.csv_safe(e.props).alias("field"), text.csv_safe(F.when(e.event_type == "error", F.concat(F.lit("="), e.event_type)).otherwise(e.event_type)).alias("guarded"))


@query("""SELECT o_orderkey, nullif(o_orderstatus, 'P') AS status, CASE WHEN year(o_orderdate) < 1993 THEN NULL ELSE o_orderdate END AS day, CASE WHEN o_totalprice > 200000 THEN '是' ELSE '否' END AS large FROM orders""")
def clean_values(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.select("o_orderkey", F.nullif(o.o_orderstatus, F.lit("P")).alias("status"), F.when(F.year("o_orderdate") >= 1993, o.o_orderdate).alias("day"), F.when(o.o_totalprice > 200000, "是").otherwise("否").alias("large"))


@query("""SELECT c_custkey, 'name' AS field, c_name AS value, 'raw' AS lvl FROM customer UNION ALL SELECT c_custkey, 'segment', c_mktsegment, 'decoded' FROM customer""")
def unpivot_facts(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    return c.unpivot("c_custkey", ["name", "segment"], "field", "value").withColumn("lvl", F.when(F.col("field") == "name", "raw").otherwise("decoded"))


@query("""SELECT n_name, coalesce(n_name, '—') || ' / ' || coalesce(nullif(r_name, 'ASIA'), '—') AS shown, row_number() OVER (ORDER BY n_nationkey) - 1 AS row_index FROM nation JOIN region ON n_regionkey = r_regionkey""")
def joined_fields(spark, sf_dir):
    n = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    n = sorting.reindexed(n.select("n_nationkey", "n_name", "r_name"), ["n_nationkey"])
    return n.select("n_name", F.concat_ws(" / ", F.coalesce("n_name", F.lit("—")), F.coalesce(F.nullif("r_name", F.lit("ASIA")), F.lit("—"))).alias("shown"), "row_index")


@query("""WITH r AS (SELECT *, lower(p_brand) LIKE 'brand#1%' AS a, p_size > 40 AS b, p_retailprice < 1000 AS c FROM part)
SELECT p_partkey, CASE WHEN a THEN 'red' WHEN b THEN 'blue' END AS fill, CASE WHEN b AND NOT a THEN 'bold' WHEN c AND NOT a THEN 'italic' END AS font FROM r""")
def conditional_formats(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    made = rules.first_setters([{"when": compile_filter("^brand#1", p.p_brand), "set": {"fill": "red"}, "stop": True}, {"when": p.p_size > 40, "set": {"fill": "blue", "font": "bold"}}, {"when": p.p_retailprice < 1000, "set": {"font": "italic"}}], ["fill", "font"])
    return p.select("p_partkey", *(c.alias(k) for k, c in made.items()))


@query("""SELECT p_partkey, round((p_size - lo) / (hi - lo)::DOUBLE, 4) AS bar FROM part, (SELECT min(p_size) AS lo, max(p_size) AS hi FROM part)""")
def data_bars(spark, sf_dir):
    return rules.data_bar(table(spark, sf_dir, "part").select("p_partkey", "p_size"), "p_size").select("p_partkey", "bar")


@query("""SELECT p_partkey, ((p_retailprice >= a)::INT + (p_retailprice >= b)::INT + (p_retailprice >= c)::INT) AS stop FROM part, (SELECT quantile_cont(p_retailprice, 0.1) AS a, quantile_cont(p_retailprice, 0.5) AS b, quantile_cont(p_retailprice, 0.9) AS c FROM part)""")
def colour_scales(spark, sf_dir):
    return rules.colour_scale(table(spark, sf_dir, "part").select("p_partkey", "p_retailprice"), "p_retailprice", [0.1, 0.5, 0.9]).select("p_partkey", "stop")


@query("SELECT p_partkey, count(*) OVER (PARTITION BY lower(p_name)) > 1 AS is_duplicate FROM part")
def duplicate_marks(spark, sf_dir):
    return rules.duplicates(table(spark, sf_dir, "part").select("p_partkey", "p_name"), "p_name").select("p_partkey", "is_duplicate")


@query("""SELECT c_custkey, c_mktsegment = 'BUILDING' AND c_acctbal > 0 OR c_nationkey < 5 AS marked FROM customer""")
def card_rules(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    rule = {"any": [{"all": [{"eq": ["seg", "BUILDING"]}, {"gt": ["bal", 0]}]}, {"lt": ["nation", 5]}]}
    return c.select("c_custkey", card_rule(rule, {"seg": c.c_mktsegment, "bal": c.c_acctbal, "nation": c.c_nationkey}).alias("marked"))


#: Units of a baseline and of the range compared with it, and how many of the second make one of the first.
_RANGES = [("kPa", "kPa", 1.0), ("bar", "kPa", 100.0), ("kPa", "bar", 0.01), ("psi", "kPa", 6.894757), ("kPag", "kPa", 1.0), ("bara", "bar(g)", 1.0), ("bara", "bar", 1.0), ("m³/hr", "m3/h", 1.0), ("m3/h", "t/h", 1.0), ("°C", "degF", 1.8), ("kPa", "m", 1.0), ("kPa", "", 1.0), ("mm", "in", 0.03937007874)]


@query("""WITH w(i, d1, c1, q1, f1, d2, c2, q2, f2, m) AS (VALUES (0, 'P', 'kpa', '', 1.0, 'P', 'kpa', '', 1.0, 1.0), (1, 'P', 'bar', '', 100.0, 'P', 'kpa', '', 1.0, 100.0), (2, 'P', 'kpa', '', 1.0, 'P', 'bar', '', 100.0, 0.01),
(3, 'P', 'psi', '', 6.894757, 'P', 'kpa', '', 1.0, 6.894757), (4, 'P', 'kpa', 'g', 1.0, 'P', 'kpa', '', 1.0, 1.0), (5, 'P', 'bar', 'a', 100.0, 'P', 'bar', 'g', 100.0, 1.0), (6, 'P', 'bar', 'a', 100.0, 'P', 'bar', '', 100.0, 1.0),
(7, 'other', 'm3/h', '', 1.0, 'other', 'm3/h', '', 1.0, 1.0), (8, 'other', 'm3/h', '', 1.0, 'other', 't/h', '', 1.0, 1.0), (9, 'T', 'c', '', 1.0, 'T', 'f', '', 1.0, 1.8), (10, 'P', 'kpa', '', 1.0, 'L', 'm', '', 1.0, 1.0),
(11, 'P', 'kpa', '', 1.0, NULL, NULL, NULL, NULL, 1.0), (12, 'L', 'mm', '', 0.001, 'L', 'in', '', 0.0254, 0.03937007874)),
x AS (SELECT p_partkey, w.* REPLACE (f1::DOUBLE AS f1, f2::DOUBLE AS f2, m::DOUBLE AS m), CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE 0.0 END::DOUBLE AS lo1, p_size::DOUBLE AS hi1, (CASE WHEN i = 9 THEN 32 ELSE 0 END + CASE WHEN i = 6 AND p_partkey % 2 = 0 THEN -1.01325 ELSE 0 END)::DOUBLE AS lo2,
 p_size::DOUBLE * m * (1 + (p_partkey % 5) * 0.0017::DOUBLE) + CASE WHEN i = 9 THEN 32 ELSE 0 END + CASE WHEN i = 6 AND p_partkey % 2 = 0 THEN -1.01325::DOUBLE ELSE 0 END AS hi2, p_partkey % 11 <> 0 AS high FROM part JOIN w ON i = p_partkey % 13),
y AS (SELECT *, d1 = d2 AND c1 = c2 AS same, CASE WHEN d1 = d2 AND c1 = c2 THEN lo2 WHEN d1 = 'T' THEN (lo2 - 32) * 5 / 9 ELSE lo2 * f2 / f1 END AS lo, CASE WHEN d1 = d2 AND c1 = c2 THEN hi2 WHEN d1 = 'T' THEN (hi2 - 32) * 5 / 9 ELSE hi2 * f2 / f1 END AS hi, greatest(abs(hi1 - coalesce(lo1, 0)) * 0.005::DOUBLE, 1e-9) AS tol FROM x),
z AS (SELECT *, coalesce(abs(lo - lo1) > tol, false) OR (high AND abs(hi - hi1) > tol) AS bad, d1 = 'P' AND 'a' IN (q1, q2) AND '' IN (q1, q2) AS unsaid, 101.325::DOUBLE / f1 * CASE WHEN q2 = 'a' THEN -1 ELSE 1 END AS shift, greatest(abs(hi1 - coalesce(lo1, 0)) * 0.02::DOUBLE, 2.0::DOUBLE / f1) AS wide FROM y)
SELECT p_partkey, CASE WHEN d2 IS NULL THEN 'unit_unknown' WHEN d1 <> d2 OR (d1 = 'other' AND c1 <> c2) OR ('a' IN (q1, q2) AND ('g' IN (q1, q2) OR 'd' IN (q1, q2))) THEN 'unit_mismatch'
WHEN bad AND unsaid AND NOT (coalesce(abs(lo + shift - lo1) > wide, false) OR (high AND abs(hi + shift - hi1) > wide)) THEN 'unit_mismatch' WHEN bad THEN 'mismatch'
WHEN same AND (coalesce(format('{:.7g}', lo) <> format('{:.7g}', lo1), false) OR (high AND format('{:.7g}', hi) <> format('{:.7g}', hi1))) THEN 'near' ELSE 'ok' END AS status FROM z""")
def range_comparison(spark, sf_dir):
    """Thirteen pairs of units, ranges apart by up to 0.7 %, some without a lower end or with an upper end that is not compared, some shifted by an atmosphere."""
    p = table(spark, sf_dir, "part")
    key, i = F.col("p_partkey"), (F.col("p_partkey") % 13).cast("int")
    pick = lambda k: F.get(F.array(*(F.lit(r[k]) for r in _RANGES)), i)
    lift = F.when(i == 9, 32.0).otherwise(0.0) + F.when((i == 6) & (key % 2 == 0), -1.01325).otherwise(0.0)
    hi = p.p_size.cast("double") * pick(2) * (1 + (key % 5) * 0.0017) + lift
    return p.select("p_partkey", units.compare_range(F.when(key % 7 != 0, 0.0), p.p_size.cast("double"), pick(0), lift, hi, pick(1), high=key % 11 != 0).alias("status"))


@query("""SELECT o_orderkey, format('{:.7g}', o_totalprice / 7) AS small, format('{:.7g}', o_totalprice * 1000 / 7) AS large, format('{:.7g}', -7 / (o_totalprice * 1000)) AS tiny, format('{:.7g}', o_orderkey::DOUBLE) AS whole FROM orders""")
def seven_digits(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    shown = lambda c, n: text.significant7(c).alias(n)
    return o.select("o_orderkey", shown(o.o_totalprice / 7, "small"), shown(o.o_totalprice * 1000 / 7, "large"), shown(F.lit(-7) / (o.o_totalprice * 1000), "tiny"), shown(o.o_orderkey, "whole"))


@query("""SELECT o_orderstatus AS status, o_orderpriority AS priority, count(*) AS n, sum(o_totalprice) AS total FROM orders GROUP BY ROLLUP (1, 2)""")
def subtotal_rows(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"), "o_totalprice")
    return o.rollup("status", "priority").agg(F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("total"))


@query("""SELECT l_returnflag, count(*) FILTER (l_linestatus = 'F') AS f, count(*) FILTER (l_linestatus = 'O') AS o FROM lineitem GROUP BY 1""")
def chart_series(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag").pivot("l_linestatus", ["F", "O"]).agg(F.count(F.lit(1))).select("l_returnflag", F.coalesce("F", F.lit(0)).alias("f"), F.coalesce("O", F.lit(0)).alias("o"))


@query("""SELECT p_name AS value, count(*) AS n FROM part GROUP BY 1 HAVING count(*) > 1""")
def uniqueness_check(spark, sf_dir):
    return table(spark, sf_dir, "part").groupBy(F.col("p_name").alias("value")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


@query("""SELECT p_partkey, CASE WHEN p_size - 3 <= 0 THEN 'out' WHEN p_partkey % 4 > 0 AND p_size - 3 <= p_partkey % 20 THEN 'low' ELSE 'ok' END AS status FROM part""")
def stock_status(spark, sf_dir):
    """Quantities against each item's own minimum; a quarter of the items have none."""
    key = F.col("p_partkey")
    return table(spark, sf_dir, "part").select("p_partkey", matching.stock_status(F.col("p_size") - 3, F.when(key % 4 > 0, key % 20)).alias("status"))


@query("""SELECT event_id, concat_ws(',', CASE WHEN event_id & 1 = 1 THEN 'man' END, CASE WHEN event_id & 2 = 2 THEN 'auto' END, CASE WHEN event_id & 4 = 4 THEN 'cas' END) AS modes FROM events""")
def mode_flags(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", text.flags(F.col("event_id"), ["man", "auto", "cas"]).alias("modes"))


@query("""WITH p AS (SELECT text AS phrase FROM benchmark UNION ALL SELECT regexp_extract(text, '^[^ ]+ [^ ]+') FROM benchmark UNION ALL SELECT substr(text, 3, 40) FROM benchmark UNION ALL SELECT right(text, 25) FROM benchmark)
SELECT doc_id, count(*) AS hits FROM documents, p WHERE contains(documents.text, p.phrase) GROUP BY 1""")
def phrase_hits(spark, sf_dir):
    """Documents that hold a listed phrase: whole benchmark passages, their first two words, and stretches that begin or end inside a word."""
    b = table(spark, sf_dir, "benchmark").select("text")
    listed = [F.col("text"), F.regexp_extract("text", "^[^ ]+ [^ ]+", 0), F.substring("text", 3, 40), F.right(F.col("text"), F.lit(25))]
    phrases = b.select(F.explode(F.array(*listed)).alias("phrase"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return documents.phrase_hits(docs, phrases).groupBy("doc_id").agg(F.sum("n").alias("hits"))
