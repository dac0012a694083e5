"""Line dedup over overlapping windows of three lines.

A text is cut at newlines; every three lines that follow one another are hashed (two independent 64-bit
hashes, so equal hashes mean equal lines at any corpus size met in practice). Of a window that occurs more than
once anywhere, the occurrence with the smallest (doc_id, text hash, line) stays and the lines of all later
ones go; covered lines of overlapping windows are merged. Blank lines are lines. Lines are compared as they are.

Texts of fewer than three lines and null texts stay as they are. A null id comes first. Rows that repeat an id
and its text are one document and each gets the same answer. A text all of whose lines go becomes ''. An empty
table gives an empty result; extra columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 3


def _windows(docs: DataFrame) -> DataFrame:
    lines = docs.select("doc_id", F.xxhash64("text").alias("tie"), F.split("text", "\n").alias("ls")).where(F.size("ls") >= WINDOW)
    lines = lines.select("doc_id", "tie", F.transform("ls", lambda x: F.xxhash64(x)).alias("a"), F.transform("ls", lambda x: F.xxhash64(F.lit(7), x)).alias("b"))
    at = F.posexplode(F.transform(F.sequence(F.lit(0), F.size("a") - WINDOW), lambda i: F.struct(F.xxhash64(*(F.get("a", i + j) for j in range(WINDOW))).alias("h1"), F.xxhash64(*(F.get("b", i + j) for j in range(WINDOW))).alias("h2"))))
    return lines.select("doc_id", "tie", at.alias("pos", "w")).select("doc_id", "tie", "pos", "w.h1", "w.h2")


def line_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, text (what stays), n_lines, n_removed; a row for each row of docs (doc_id, text)."""
    docs = docs.select("doc_id", "text")
    win = _windows(docs)
    first = win.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("doc_id", "tie", "pos")).alias("first")).where("n > 1").drop("n")
    later = win.join(first, ["h1", "h2"]).where(F.struct("doc_id", "tie", "pos") > F.col("first"))
    # sorted starts of the windows that go; what lies between their covered runs stays
    gone = later.groupBy(F.col("doc_id").alias("_d"), F.col("tie").alias("_t")).agg(F.array_sort(F.collect_set("pos")).alias("gone"))
    rows = docs.withColumn("tie", F.xxhash64("text"))
    out = rows.join(gone, rows["doc_id"].eqNullSafe(F.col("_d")) & (F.col("tie") == F.col("_t")), "left").withColumn("ls", F.split("text", "\n"))
    runs = F.filter(
        F.transform(F.concat(F.array(F.lit(-WINDOW)), F.col("gone")), lambda p, i: F.struct((p + WINDOW).alias("s"), F.coalesce(F.get("gone", i), F.size("ls")).alias("e"))),
        lambda r: r["e"] > r["s"],
    )
    out = out.withColumn("runs", runs)
    kept = F.flatten(F.transform("runs", lambda r: F.slice("ls", r["s"] + 1, r["e"] - r["s"])))
    return out.select(
        "doc_id",
        F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")).alias("text"),
        F.when(F.col("text").isNull(), 0).otherwise(F.size("ls")).cast("long").alias("n_lines"),
        F.when(F.col("gone").isNull(), 0).otherwise(F.size("ls") - F.aggregate("runs", F.lit(0), lambda n, r: n + r["e"] - r["s"])).cast("long").alias("n_removed"),
    )


LINE_SQL = r"""
WITH l AS (SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM documents),
w AS (SELECT doc_id, pos, ls[pos] || chr(10) || ls[pos + 1] || chr(10) || ls[pos + 2] AS win FROM (SELECT doc_id, ls, unnest(range(1, len(ls) - 1)) AS pos FROM l WHERE len(ls) >= 3)),
g AS (SELECT doc_id, pos, row_number() OVER (PARTITION BY win ORDER BY doc_id, pos) AS k FROM w),
c AS (SELECT DISTINCT doc_id, pos + j AS pos FROM g, (VALUES (0), (1), (2)) AS o(j) WHERE k > 1),
a AS (SELECT doc_id, pos, ls[pos] AS line FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS pos FROM l)),
s AS (SELECT a.doc_id, string_agg(a.line, chr(10) ORDER BY a.pos) AS kept, count(*) AS n FROM a ANTI JOIN c USING (doc_id, pos) GROUP BY a.doc_id)
SELECT l.doc_id, CASE WHEN l.text IS NULL THEN NULL ELSE coalesce(s.kept, '') END AS text, coalesce(len(l.ls), 0)::BIGINT AS n_lines,
    (coalesce(len(l.ls), 0) - coalesce(s.n, 0))::BIGINT AS n_removed FROM l LEFT JOIN s USING (doc_id)
"""
