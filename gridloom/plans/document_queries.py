"""Queries of document search, drawing labels, lookups in whole columns and audits of dumps."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridloom.functions.formula import with_formula
from gridloom.operators import documents, drawing
from gridloom.plans.registry import query, table
from gridloom.sources import relational

_KEEP = {"en": 3, "de": 1}


@query("""WITH t AS (SELECT DISTINCT item_id % 10 AS entity, upper(regexp_extract(text, '^[A-Za-z]+ [A-Za-z]+')) AS term, CASE WHEN item_id % 3 = 0 THEN 'tag' ELSE 'serial' END AS kind FROM benchmark WHERE regexp_matches(text, '^[A-Za-z]+ [A-Za-z]')),
d AS (SELECT doc_id AS doc, upper(text) AS text, 1 + doc_id % 3 AS trust, lang AS category, source || doc_id % 40 AS number, doc_id // 40 AS revision, source || doc_id % 20 AS family FROM documents),
h AS (SELECT *, regexp_matches(text, '(^|[^A-Z0-9])' || regexp_escape(term) || '([^A-Z0-9_-]|$)') AS exact FROM d JOIN t ON contains(text, term) AND regexp_matches(text, '(^|[^A-Z0-9])' || regexp_escape(term) || CASE WHEN kind = 'tag' THEN '([^0-9]|$)' ELSE '([^A-Z0-9]|$)' END)
 WHERE kind <> 'tag' OR trust >= 2),
one AS (SELECT * FROM h QUALIFY row_number() OVER (PARTITION BY entity, doc ORDER BY exact DESC, term, kind) = 1), newest AS (SELECT * FROM one QUALIFY row_number() OVER (PARTITION BY entity, number ORDER BY revision DESC, doc) = 1),
fam AS (SELECT *, row_number() OVER w AS m, count(*) OVER (PARTITION BY entity, category, family) AS members FROM newest WINDOW w AS (PARTITION BY entity, category, family ORDER BY NOT exact, trust DESC, doc)),
placed AS (SELECT *, row_number() OVER (PARTITION BY entity, category ORDER BY NOT exact, trust DESC, doc) AS place FROM fam WHERE m = 1), kept AS (SELECT *, place <= CASE category WHEN 'en' THEN 3 WHEN 'de' THEN 1 ELSE 2 END AS k FROM placed)
SELECT entity, category, place, doc, term, exact, k AND sum(k::INT) OVER (PARTITION BY entity ORDER BY category, place) <= 4 AS shown, members - 1 AS others FROM kept""")
def entity_documents(spark, sf_dir):
    """Documents of ten entities by the first words of their phrases: newest number, families, at most 3, 1 or 2 a language and 4 an entity shown."""
    b = table(spark, sf_dir, "benchmark").where(F.col("text").rlike("^[A-Za-z]+ [A-Za-z]"))
    term = F.upper(F.regexp_extract("text", "^[A-Za-z]+ [A-Za-z]+", 0))
    terms = b.select((F.col("item_id") % 10).alias("entity"), term.alias("term"), F.when(F.col("item_id") % 3 == 0, "tag").otherwise("serial").alias("kind")).distinct()
    d = table(spark, sf_dir, "documents")
    pages = d.select(F.col("doc_id").alias("doc"), F.lit(1).alias("page"), (F.col("doc_id") % 3 + 1).alias("trust"), "text")
    docs = d.select(F.col("doc_id").alias("doc"), F.concat("source", (F.col("doc_id") % 40).cast("string")).alias("number"), F.floor(F.col("doc_id") / 40).alias("revision"), F.col("lang").alias("category"), F.concat("source", (F.col("doc_id") % 20).cast("string")).alias("family"))
    out = documents.entity_documents(documents.page_hits(pages, terms), docs, [F.desc("trust")], _KEEP, most=4)
    return out.select("entity", "category", "place", "doc", "term", "exact", "shown", F.size("alternates").alias("others"))


@query("""WITH w AS (SELECT p_partkey // 50 AS page, p_partkey AS id, (p_partkey * 37 % 100) * 2.0::DOUBLE AS x0, (p_partkey * 17 % 40) * 4.0::DOUBLE AS y0, 12.0::DOUBLE + p_size AS width, p_brand AS text FROM part),
e AS (SELECT *, x0 + width / 2 AS cx, y0 + 4 AS cy FROM w),
n AS (SELECT e.page, e.id, s.id AS first_id, s.text || e.text AS label, (s.cx - e.cx) / 8 AS da, (s.cy - e.cy) / 8 AS dc, (-((s.cx - e.cx) / 8) * 8 - s.width / 2 - e.width / 2) / 8 AS gap, least(e.x0, s.x0) AS x0, least(e.y0, s.y0) AS y0, greatest(e.x0 + e.width, s.x0 + s.width) AS x1, greatest(e.y0, s.y0) + 8 AS y1
 FROM e JOIN e s ON e.page = s.page AND e.id % 2 = 1 AND s.id % 2 = 0),
f AS (SELECT *, CASE WHEN dc BETWEEN -1.7 AND -0.6 AND abs(da) <= 1.2 THEN 'stacked' WHEN abs(dc) <= 0.35 AND da < 0 AND gap BETWEEN -0.3 AND 1.6 THEN 'inline' END AS form FROM n)
SELECT page, id, first_id, label, form, x0, y0, x1, y1 FROM f WHERE form IS NOT NULL QUALIFY row_number() OVER (PARTITION BY page, id ORDER BY CASE form WHEN 'stacked' THEN abs(da) + abs(dc + 1.1::DOUBLE) ELSE gap + 2 END, first_id) = 1""")
def drawing_labels(spark, sf_dir):
    k = F.col("p_partkey")
    x0, y0 = k * 37 % 100 * 2.0, k * 17 % 40 * 4.0
    words = table(spark, sf_dir, "part").select(F.floor(k / 50).alias("page"), k.alias("id"), F.lit(0).alias("dir"), x0.alias("x0"), y0.alias("y0"), (x0 + 12 + F.col("p_size")).alias("x1"), (y0 + 8).alias("y1"), F.col("p_brand").alias("text"))
    return drawing.merged_labels(words, F.col("id") % 2 == 0, F.col("id") % 2 == 1)


@query("""WITH w AS (SELECT p_partkey // 200 AS page, p_partkey AS id, p_size % 4 AS edge, (p_partkey * 17 % 200) * 3 AS y FROM part), b AS (SELECT *, coalesce(y - lag(y) OVER o > 20.8, true)::INT AS new FROM w WINDOW o AS (PARTITION BY page, edge ORDER BY y, id)),
r AS (SELECT *, sum(new) OVER (PARTITION BY page, edge ORDER BY y, id) AS run FROM b) SELECT page, id FROM r QUALIFY count(*) OVER (PARTITION BY page, edge, run) >= 5""")
def drawing_tables(spark, sf_dir):
    k = F.col("p_partkey")
    x0, y0 = F.col("p_size") % 4 * 2.0, k * 17 % 200 * 3.0
    words = table(spark, sf_dir, "part").select(F.floor(k / 200).alias("page"), k.alias("id"), F.lit(0).alias("dir"), x0.alias("x0"), y0.alias("y0"), (x0 + 40).alias("x1"), (y0 + 8).alias("y1"))
    return drawing.table_rows(words)


@query("""WITH f AS (SELECT p_brand, min_by(p_name, p_partkey) AS first_name FROM part GROUP BY 1), c AS (SELECT p_brand, p_size, count(*) AS n FROM part WHERE p_retailprice > 950 GROUP BY 1, 2)
SELECT p_partkey, f.first_name, coalesce(h.first_name, 'none') AS next_brand, coalesce(c.n, 0)::DOUBLE AS dearer_alike, (SELECT count(*) FROM part WHERE p_brand = 'Brand#13' AND p_size > 25)::DOUBLE AS large_13, (SELECT sum(p_partkey * p_size) FROM part)::DOUBLE AS weighted, (SELECT count(p_size) FROM part)::DOUBLE AS sized
FROM part p JOIN f USING (p_brand) LEFT JOIN f h ON h.p_brand = 'Brand#' || p.p_size LEFT JOIN c ON c.p_brand = p.p_brand AND c.p_size = p.p_size""")
def formula_lookups(spark, sf_dir):
    df = table(spark, sf_dir, "part")
    for name, formula in {
        "first_name": "=INDEX(B:B,MATCH(C2,C:C,0))",
        "next_brand": '=IFERROR(INDEX(B:B,MATCH("brand#"&E2,C:C,0)),"none")',
        "dearer_alike": '=COUNTIFS(C:C,C2,E:E,E2,F:F,">950")+0',
        "large_13": '=COUNTIFS(C:C,"Brand#13",E:E,">25")+0',
        "weighted": "=SUMPRODUCT(A:A,E:E)+0",
        "sized": "=COUNT(E:E)+0",
    }.items():
        df = with_formula(df, name, formula, ["p_partkey"])
    return df.drop("p_name", "p_brand", "p_type", "p_size", "p_retailprice")


@query("""WITH e("table", expected) AS (VALUES ('region', 5), ('nation', 24), ('ghost', 1)), g AS (SELECT 'region' AS "table", count(*) AS exported FROM region UNION ALL SELECT 'nation', count(*) FROM nation UNION ALL SELECT 'customer', count(*) FROM customer)
SELECT "table", expected::BIGINT AS expected, exported, CASE WHEN exported IS NULL THEN 'missing' WHEN expected IS NULL THEN 'unlisted' WHEN expected = exported THEN 'ok' ELSE 'mismatch' END AS status FROM e FULL JOIN g USING ("table")""")
def dump_audit(spark, sf_dir):
    expected = spark.createDataFrame([("region", 5), ("nation", 24), ("ghost", 1)], "table string, expected long")
    return relational.audit_counts({n: table(spark, sf_dir, n) for n in ("region", "nation", "customer")}, expected)


@query("""WITH m AS (SELECT l_orderkey * 10 + l_linenumber AS id, l_returnflag AS panel, l_partkey % 50 AS rack, l_suppkey % 10 AS slot, l_orderkey % 4 AS ch,
CASE WHEN l_linenumber = 1 AND l_orderkey % 16 = 0 THEN 'in' WHEN l_linenumber < 4 THEN 'relay' WHEN l_linenumber < 6 THEN 'rec' ELSE 'other' END AS kind FROM lineitem),
s AS (SELECT panel, rack, slot, count(*) - 1 AS siblings FROM m WHERE kind = 'in' GROUP BY ALL),
c AS (SELECT *, row_number() OVER (PARTITION BY panel, rack, slot, ch ORDER BY CASE kind WHEN 'in' THEN 0 WHEN 'relay' THEN 1 WHEN 'rec' THEN 2 ELSE 3 END, id) - 1 AS position FROM m QUALIFY count(*) FILTER (kind = 'in') OVER (PARTITION BY panel, rack, slot, ch) = 1)
SELECT id, kind, panel, rack, slot, ch, position, siblings FROM c JOIN s USING (panel, rack, slot)""")
def channel_chains(spark, sf_dir):
    """Line items as legs of monitor channels; legs other than sensors sit a rack further and name the channel that they follow."""
    kind = F.when((F.col("l_linenumber") == 1) & (F.col("l_orderkey") % 16 == 0), "in").when(F.col("l_linenumber") < 4, "relay").when(F.col("l_linenumber") < 6, "rec").otherwise("other")
    m = table(spark, sf_dir, "lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), kind.alias("kind"), F.col("l_returnflag").alias("panel"), (F.col("l_partkey") % 50).alias("at_rack"), (F.col("l_suppkey") % 10).alias("at_slot"), (F.col("l_orderkey") % 4).alias("at_ch"))
    sensor = F.col("kind") == "in"
    m = m.withColumns({"rack": F.col("at_rack") + F.when(sensor, 0).otherwise(1), "slot": F.col("at_slot"), "ch": F.col("at_ch")})
    m = m.withColumns({c: F.when(~sensor, F.col(c)) for c in ("at_rack", "at_slot", "at_ch")})
    return drawing.channel_legs(m, ["panel", "rack", "slot", "ch"], ["at_rack", "at_slot", "at_ch"])
