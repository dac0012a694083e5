"""Queries of sorting, suggestions, styles and published columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridloom.functions.formula import with_formula
from gridloom.operators import matching, rules, search, shaping, sorting
from gridloom.plans.registry import query, table

#: Cells of every kind: numbers, numbers as text, texts with digits, blanks.
_CELL = "CASE WHEN p_partkey % 9 = 0 THEN NULL WHEN p_partkey % 9 = 1 THEN '' WHEN p_partkey % 9 < 5 THEN (p_size - 25)::VARCHAR WHEN p_partkey % 9 = 5 THEN ' ' || p_size || '.50 ' ELSE p_brand || '-' || p_size END"
_NATURAL = "array_to_string(list_transform(regexp_extract_all(lower({0}), '([0-9]+|[^0-9]+)'), lambda x: CASE WHEN regexp_matches(x, '^[0-9]') THEN lpad(regexp_replace(x, '^0+', ''), 14, '0') ELSE x END), '')"


def _cells(spark, sf_dir):
    p, k = table(spark, sf_dir, "part"), F.col("p_partkey") % 9
    size = F.col("p_size").cast("string")
    cell = F.when(k == 0, None).when(k == 1, "").when(k < 5, (F.col("p_size") - 25).cast("string")).when(k == 5, F.concat(F.lit(" "), size, F.lit(".50 "))).otherwise(F.concat("p_brand", F.lit("-"), size))
    return p.withColumn("cell", cell)


_KIND = f"""d AS (SELECT p_partkey, p_brand, p_size, {_CELL} AS cell FROM part),
k AS (SELECT *, CASE WHEN coalesce(cell, '') = '' THEN NULL WHEN regexp_matches(cell, '^\\s*-?[0-9]+(\\.[0-9]+)?\\s*$') THEN 0 ELSE 1 END AS kind, CASE WHEN regexp_matches(cell, '^\\s*-?[0-9]+(\\.[0-9]+)?\\s*$') THEN trim(cell)::DOUBLE END AS num, CASE WHEN NOT regexp_matches(cell, '^\\s*-?[0-9]+(\\.[0-9]+)?\\s*$') THEN {_NATURAL.format('cell')} END AS txt FROM d)"""


@query(f"WITH {_KIND}, s AS (SELECT p_partkey, row_number() OVER (ORDER BY kind NULLS LAST, num NULLS LAST, txt NULLS LAST, p_partkey) AS position FROM k) SELECT p_partkey, position FROM s WHERE position <= 150")
def typed_sort(spark, sf_dir):
    """The first 150 rows of a column of mixed cells."""
    d = _cells(spark, sf_dir)
    return sorting.page(d, sorting.order_by(d, "cell", ["p_partkey"]), 0, 150).select("p_partkey", "position")


@query(f"WITH {_KIND}, s AS (SELECT p_partkey, row_number() OVER (ORDER BY kind DESC NULLS LAST, num DESC NULLS LAST, txt DESC NULLS LAST, p_partkey) AS position FROM k) SELECT p_partkey, position FROM s WHERE position > 40 AND position <= 140")
def typed_sort_down(spark, sf_dir):
    """Downwards, rows 41 to 140: texts before numbers, blanks still last, ties still in their order."""
    d = _cells(spark, sf_dir)
    return sorting.page(d, sorting.order_by(d, "cell", ["p_partkey"], descending=True), 40, 100).select("p_partkey", "position")


@query(f"""WITH s AS (SELECT o_orderkey, row_number() OVER (ORDER BY CASE o_orderpriority WHEN '5-LOW' THEN 1 WHEN '1-URGENT' THEN 2 ELSE 9 END, CASE WHEN o_orderpriority NOT IN ('5-LOW', '1-URGENT') THEN {_NATURAL.format('o_orderpriority')} END, o_orderkey) AS position FROM orders) SELECT * FROM s WHERE position <= 800""")
def custom_order_rank(spark, sf_dir):
    """Listed values first, in their own order, others after them."""
    o = table(spark, sf_dir, "orders")
    return sorting.page(o, sorting.order_by(o, "o_orderpriority", ["o_orderkey"], values=["5-LOW", "1-URGENT"]), 0, 800).select("o_orderkey", "position")


@query("""SELECT o_orderkey, position FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS position FROM orders) WHERE position <= 100""")
def proxy_sort(spark, sf_dir):
    """A shown text sorts by the number it was made from."""
    o = table(spark, sf_dir, "orders").withColumn("shown", F.concat(F.lit("$"), F.format_number("o_totalprice", 2)))
    return sorting.page(o, sorting.order_by(o, "shown", ["o_orderkey"], descending=True, proxy="o_totalprice"), 0, 100).select("o_orderkey", "position")


@query("""WITH g AS (SELECT o_orderstatus AS status, o_orderpriority AS priority, count(*) AS n, grouping(o_orderpriority) AS sub FROM orders GROUP BY GROUPING SETS ((1, 2), (1)))
SELECT status, priority, n, row_number() OVER (ORDER BY sub, CASE WHEN sub = 0 THEN n END DESC NULLS LAST, status, priority) AS position FROM g""")
def pinned_rows(spark, sf_dir):
    """Counts downwards; subtotals stay at the end in their own order."""
    g = table(spark, sf_dir, "orders").groupingSets([("o_orderstatus", "o_orderpriority"), ("o_orderstatus",)], "o_orderstatus", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"), F.grouping("o_orderpriority").alias("sub"))
    g = g.select(F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"), "n", "sub")
    return sorting.page(g, sorting.order_by(g, "n", ["status", "priority"], descending=True, pinned=F.col("sub") == 1), 0, 1000).select("status", "priority", "n", "position")


@query("""SELECT coalesce(nullif(CASE WHEN p_partkey % 3 = 0 THEN '' ELSE p_brand END, ''), '∅') AS value, count(*) AS n FROM part WHERE p_size <> 1 GROUP BY 1""")
def facets_without_subtotals(spark, sf_dir):
    p = table(spark, sf_dir, "part").withColumn("brand", F.when(F.col("p_partkey") % 3 == 0, "").otherwise(F.col("p_brand")))
    return sorting.unpinned_facets(p, "brand", F.col("p_size") == 1)


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate, row_number() OVER (ORDER BY l_suppkey, l_partkey, l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_shipdate) - 1 AS row_index FROM lineitem""")
def reindexed_rows(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate")
    return sorting.reindexed(li, ["l_suppkey", "l_partkey", "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate"])


@query("""SELECT p_partkey, p_size FROM part ORDER BY p_size DESC, p_partkey LIMIT 60""")
def quantity_order(spark, sf_dir):
    return table(spark, sf_dir, "part").orderBy(F.desc("p_size"), "p_partkey").limit(60).select("p_partkey", "p_size")


@query("""SELECT doc_id AS doc, 1 AS page, doc_id % 4 AS trust FROM documents WHERE contains(text, 'the') ORDER BY doc_id % 4 DESC, doc_id LIMIT 4000""")
def trusted_hits(spark, sf_dir):
    hits = table(spark, sf_dir, "documents").where(F.contains("text", F.lit("the"))).select(F.col("doc_id").alias("doc"), F.lit(1).alias("page"), (F.col("doc_id") % 4).alias("trust"))
    return search.most_trusted(hits)


_ASKED = ["blue large", "RING", "anvil red promo", "no such", "x"]


@query("""WITH q(q) AS (VALUES ('blue large'), ('RING'), ('anvil red promo'), ('no such'), ('x')), i AS (SELECT DISTINCT p_brand AS key, p_name || ' ' || p_type AS name FROM part), h AS (SELECT q, key, name FROM q, i WHERE list_max(list_transform(string_split(q, ' '), lambda w: length(w))) >= 3
 AND len(list_filter(string_split(upper(q), ' '), lambda w: NOT contains(upper(name), w))) = 0) SELECT q, key, name, row_number() OVER (PARTITION BY q ORDER BY key, name) AS position FROM h QUALIFY position <= 6""")
def name_suggest(spark, sf_dir):
    index = table(spark, sf_dir, "part").select(F.col("p_brand").alias("key"), F.concat_ws(" ", "p_name", "p_type").alias("name"))
    return search.name_suggest(spark.createDataFrame([(q,) for q in _ASKED], "q string"), index, 6)


@query("""WITH i AS (SELECT p_type AS q, CASE p_partkey % 3 WHEN 0 THEN p_brand WHEN 1 THEN upper(p_brand) ELSE replace(p_brand, '#', '-') END AS key, 's' || p_size % 3 AS scope, p_partkey AS position FROM part), c AS (SELECT *, regexp_replace(upper(key), '[^A-Z0-9]', '', 'g') AS c FROM i),
s AS (SELECT q, c, scope, min(position) AS place FROM c GROUP BY 1, 2, 3), g AS (SELECT q, c, arg_min(key, position) AS key, min(position) AS place, count(*) AS n FROM c GROUP BY 1, 2), l AS (SELECT q, c, string_agg(scope, '／' ORDER BY place) AS scopes FROM s GROUP BY 1, 2)
SELECT q, key, scopes, n, row_number() OVER (PARTITION BY q ORDER BY place) AS slot FROM g JOIN l USING (q, c) QUALIFY slot <= 4""")
def merged_suggestions(spark, sf_dir):
    k = F.col("p_partkey") % 3
    key = F.when(k == 0, F.col("p_brand")).when(k == 1, F.upper("p_brand")).otherwise(F.replace("p_brand", F.lit("#"), F.lit("-")))
    items = table(spark, sf_dir, "part").select(F.col("p_type").alias("q"), key.alias("key"), F.concat(F.lit("s"), (F.col("p_size") % 3).cast("string")).alias("scope"), F.col("p_partkey").alias("position"))
    return search.merged(items, 4)


_TYPOS = ["Customer#00000O0O7", "Customer#00000012", "Cusotmer#000000031", "Supplier#O000000lB", "Brand#1", "Customer#000000005", "nothing like it"]


@query("""WITH q(q) AS (VALUES ('Customer#00000O0O7'), ('Customer#00000012'), ('Cusotmer#000000031'), ('Supplier#O000000lB'), ('Brand#1'), ('Customer#000000005'), ('nothing like it')), i AS (SELECT c_name AS key FROM customer UNION SELECT s_name FROM supplier UNION SELECT p_brand FROM part),
n AS (SELECT q, key, regexp_replace(upper(q), '[^A-Z0-9]', '', 'g') AS a, regexp_replace(upper(key), '[^A-Z0-9]', '', 'g') AS b FROM q, i), w AS (SELECT *, CASE WHEN length(a) >= 9 THEN 2 ELSE 1 END AS wide FROM n WHERE a <> b AND length(a) >= 4),
d AS (SELECT q, key, damerau_levenshtein(translate(a, 'SOQILBZ', '5001182'), translate(b, 'SOQILBZ', '5001182'))::INT AS dc, least(6, damerau_levenshtein(a, b))::INT AS d, wide FROM w WHERE abs(length(a) - length(b)) <= wide)
SELECT q, key, dc, d, row_number() OVER (PARTITION BY q ORDER BY d, key) AS slot FROM (SELECT * FROM d WHERE dc <= wide QUALIFY dc = min(dc) OVER (PARTITION BY q)) QUALIFY slot <= 6""")
def fuzzy_tier(spark, sf_dir):
    """Keys closest to mistyped ones, of which only the nearest tier is shown."""
    keys = [table(spark, sf_dir, t).select(F.col(c).alias("key")) for t, c in (("customer", "c_name"), ("supplier", "s_name"), ("part", "p_brand"))]
    return search.fuzzy(spark.createDataFrame([(q,) for q in _TYPOS], "q string"), keys[0].unionByName(keys[1]).unionByName(keys[2]), 6)


@query("""SELECT p_partkey, p_size > 40 OR p_retailprice > 1200 AS bold, coalesce(CASE WHEN p_size > 40 THEN 'red' END, CASE WHEN p_partkey % 2 = 0 THEN 'blue' END) AS fill, coalesce(p_partkey % 5 = 0, false) AS italic FROM part""")
def layered_styles(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    made = rules.layered([{"bold": p.p_size > 40, "fill": F.when(p.p_size > 40, "red")}, {"bold": p.p_retailprice > 1200, "fill": F.when(p.p_partkey % 2 == 0, "blue"), "italic": p.p_partkey % 5 == 0}])
    return p.select("p_partkey", *(c.alias(n) for n, c in made.items()))


@query("""SELECT p_partkey, p_size BETWEEN 10 AND 20 AS inside, NOT p_size BETWEEN 10 AND 20 AS outside, p_brand <> 'Brand#13' AS other, ends_with(lower(p_type), 'tin') AS tin, NOT contains(lower(p_type), 'steel') AS no_steel, nullif(p_name, 'blue bolt') IS NULL AS blank,
'#' || lower(lpad(to_hex((CASE WHEN p_size <= a THEN 255 WHEN p_size <= m THEN floor(255 + (0 - 255) * ((p_size - a) / (m - a)) + 0.5) ELSE 0 END)::BIGINT), 2, '0')) || lower(lpad(to_hex((CASE WHEN p_size <= a THEN 0 WHEN p_size <= m THEN floor(255 * ((p_size - a) / (m - a)) + 0.5) WHEN p_size <= b THEN floor(255 - 255 * ((p_size - m) / (b - m)) + 0.5) ELSE 0 END)::BIGINT), 2, '0'))
 || lower(lpad(to_hex((CASE WHEN p_size <= m THEN 0 WHEN p_size <= b THEN floor(255 * ((p_size - m) / (b - m)) + 0.5) ELSE 255 END)::BIGINT), 2, '0')) AS colour FROM part, (SELECT min(p_size)::DOUBLE AS a, quantile_cont(p_size::DOUBLE, 0.5) AS m, (min(p_size) + (max(p_size) - min(p_size)) * 0.9)::DOUBLE AS b FROM part)""")
def format_rules(spark, sf_dir):
    """Rules on cells and texts, and colours of a scale of three stops: the least value, the median, nine tenths of the way up."""
    p = table(spark, sf_dir, "part")
    tests = {"inside": rules.cell_is(p.p_size, "between", 20, 10), "outside": rules.cell_is(p.p_size, "notBetween", 10, 20), "other": rules.cell_is(p.p_brand, "notEqual", "Brand#13"), "tin": rules.text_is(p.p_type, "endsWith", "Tin"), "no_steel": rules.text_is(p.p_type, "notContainsText", "steel"), "blank": rules.text_is(F.nullif(p.p_name, F.lit("blue bolt")), "containsBlanks")}
    made = p.select("p_partkey", "p_size", *(c.alias(n) for n, c in tests.items()))
    return rules.scale_colours(made, "p_size", [("min", 0, "#ff0000"), ("percentile", 50, "#00ff00"), ("percent", 90, "#0000ff")]).drop("p_size")


@query("""SELECT * FROM (VALUES ('key (id)', 'num', 'right', 80, 'id', false), ('kind', 'text', 'left', (SELECT least(420, greatest(60, greatest(4, max(least(60, length(p_type)))) * 8 + 16)) FROM part)::INT, NULL, false), ('Identifier', 'text', 'left', (SELECT least(420, greatest(60, greatest(10, max(length(p_brand))) * 8 + 16)) FROM part)::INT, NULL, true), ('size', 'num', 'right', 80, NULL, false), ('large', 'text', 'center', 60, NULL, false))
AS t("column", "type", align, width, note, mono)""")
def column_metadata(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    p = shaping.renamed(p, [("^p_", ""), ("partkey", "key (id)"), ("brand", "Identifier"), ("type", "kind")], ["key", "kind"])
    p = shaping.inserted(shaping.published(p, "05", {"05": ["name"]}), "size", "large", F.col("size") > 25)
    return shaping.column_meta(p)


@query("""SELECT p_partkey, (SELECT count(*) FROM part q WHERE q.p_size > p.p_size)::DOUBLE AS larger, (SELECT count(*) FROM part q WHERE q.p_retailprice <= p.p_size * 30.0)::DOUBLE AS cheaper, (p_size + p_retailprice + 2) AS total, greatest(p_size, 25)::DOUBLE AS most, (p_size + p_partkey) / 2.0::DOUBLE AS mean, NOT (p_size > 25) AS small,
CASE p_size % 3 WHEN 0 THEN round(p_retailprice::DECIMAL(18, 6), 0) WHEN 1 THEN round(p_retailprice::DECIMAL(18, 6), -1) ELSE round(p_retailprice::DECIMAL(18, 6), -2) END::DOUBLE AS rounded, nullif(strpos(substr(p_type, 3), 'E'), 0) + 2.0::DOUBLE AS second_e FROM part p""")
def formula_comparisons(spark, sf_dir):
    """Criteria that compare with the row's own cell, functions of single cells, digits that are computed."""
    df = table(spark, sf_dir, "part")
    for name, formula in {
        "larger": '=COUNTIF(E:E,">"&E2)+0',
        "cheaper": '=COUNTIF(F:F,"<="&E2*30)+0',
        "total": "=SUM(E2,F2,B2,2)",
        "most": "=MAX(E2,25)",
        "mean": "=AVERAGE(E2,A2,B2)",
        "small": "=NOT(AND(B2,E2>25))",
        "rounded": "=ROUND(F2,0-(E2-3*INT(E2/3)))",
        "second_e": '=FIND("E",D2,3)',
    }.items():
        df = with_formula(df, name, formula, ["p_partkey"])
    return df.drop("p_name", "p_brand", "p_type", "p_size", "p_retailprice")


@query("""WITH r AS (SELECT *, row_number() OVER (ORDER BY p_partkey) AS rn FROM part), f AS (SELECT p_brand, min(rn) AS rn FROM r GROUP BY 1) SELECT p.p_partkey, f.rn::DOUBLE AS first_row, coalesce(i.p_name, 'none') AS by_number FROM r p JOIN f USING (p_brand) LEFT JOIN r i ON i.rn = p.p_size * 7""")
def formula_rows(spark, sf_dir):
    """MATCH by itself gives the number of a row, INDEX reads one; a number beyond the table is an error."""
    df = table(spark, sf_dir, "part")
    df = with_formula(df, "first_row", "=MATCH(C2,C:C,0)", ["p_partkey"]).withColumn("first_row", F.col("first_row").cast("double"))
    df = with_formula(df, "by_number", '=IFERROR(INDEX(B:B,E2*7),"none")', ["p_partkey"])
    return df.select("p_partkey", "first_row", "by_number")


@query("""WITH r AS (SELECT *, row_number() OVER (ORDER BY p_partkey) AS rn FROM part), u AS (SELECT rn, p_partkey * 1.5::DOUBLE + CASE WHEN p_partkey % 50 = 49 THEN 40 ELSE 0 END AS v FROM r), w AS (SELECT p_partkey, p_size * 9.0::DOUBLE AS want FROM r),
b AS (SELECT p_partkey, (SELECT min(rn) FROM u WHERE v > want) AS up, (SELECT min(rn) FROM u WHERE -v < want - 400) AS down FROM w) SELECT p_partkey, CASE WHEN up IS NULL THEN (SELECT max(rn) FROM r) WHEN up > 1 THEN up - 1 END::DOUBLE AS rising, CASE WHEN down IS NULL THEN (SELECT max(rn) FROM r) WHEN down > 1 THEN down - 1 END::DOUBLE AS falling FROM b""")
def formula_sorted_match(spark, sf_dir):
    """MATCH in a rising column that is not quite sorted, and in a falling one: the last row before the first that lies beyond."""
    k = F.col("p_partkey")
    v = k * 1.5 + F.when(k % 50 == 49, 40).otherwise(0)
    df = table(spark, sf_dir, "part").select("p_partkey", v.alias("v"), (-v).alias("w"), "p_size")
    df = with_formula(df, "rising", "=MATCH(D2*9,B:B)", ["p_partkey"])
    df = with_formula(df, "falling", "=MATCH(D2*9-400,C:C,-1)", ["p_partkey"])
    return df.select("p_partkey", "rising", "falling")


@query("""SELECT 'p_brand' AS counter, p_brand AS value, count(*) AS n FROM part GROUP BY 2 UNION ALL SELECT 'p_type', p_type, count(*) FROM part GROUP BY 2""")
def status_counters(spark, sf_dir):
    return matching.status_counts(table(spark, sf_dir, "part"), ["p_brand", "p_type"])


@query("""SELECT count(*) AS items, max(o_orderdate) AS updated, count(*) FILTER (o_orderkey % 50 > 0 AND o_orderkey % 97 <= o_orderkey % 50) AS low FROM orders""")
def inventory_summary(spark, sf_dir):
    k = F.col("o_orderkey")
    return matching.inventory_summary(table(spark, sf_dir, "orders").select((k % 97).alias("qty"), F.when(k % 50 > 0, k % 50).alias("min"), F.col("o_orderdate").alias("updated_at")))
