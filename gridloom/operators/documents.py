"""Documents per entity: pages that hold an entity's terms, the newest version of each document, and a bounded choice for every category."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from gridloom.functions.units import let

#: Rows shown for an entity, and pages named for a document.
MOST, PAGES = 16, 6
#: Terms that are sent to all tasks; more are shuffled.
SENT = 100_000
#: Phrases of one or two words that are sent to all tasks.
SHORT = 5_000

_WORD = r"[A-Za-z0-9]+"


def page_hits(pages: DataFrame, terms: DataFrame) -> DataFrame:
    """doc, page, entity, term, kind, exact: pages (doc, page, trust, text) that hold a term (entity, term, kind), whatever its case.

    A term must not follow a letter or digit. A tag must not be followed by a digit, other kinds not by a letter or digit; it is exact if no letter,
    digit, _ or - follows; letters and digits are those of ASCII. Tags count in documents of trust 2 or more only. Terms meet pages by their longest word,
    as a prefix of a word there; only such candidates are compared with texts. Null and empty terms and texts hit nothing.
    """
    terms = terms.where(F.col("term").rlike(r"[A-Za-z0-9]")).withColumn("_t", F.upper("term"))
    # the longest word, as the rarest; the first of those
    runs = F.regexp_extract_all("term", F.lit(f"({_WORD})"), 1)
    terms = terms.withColumn("_head", F.upper(F.aggregate(runs, F.lit(""), lambda a, w: F.when(F.length(w) > F.length(a), w).otherwise(a)))).distinct()
    distinct = terms.select("_head").distinct()
    # a tag's last word may run on into letters, so heads are met by every prefix of a page's words that is as long as some head
    sizes = sorted(r[0] for r in distinct.select(F.length("_head")).distinct().collect())  # at most as many as lengths of words
    if not sizes:
        sizes = [0]
    words = F.transform(F.regexp_extract_all("text", F.lit(f"({_WORD})"), 1), F.upper)
    cut = lambda w: F.transform(F.filter(F.array(*map(F.lit, sizes)), lambda n: n <= F.length(w)), lambda n: F.substring(w, F.lit(1), n))
    # distinct within a page before rows multiply, so nothing is shuffled ahead of the join
    heads = pages.select("doc", "page", F.explode(F.array_distinct(F.flatten(F.transform(F.array_distinct(words), cut)))).alias("_head"))
    few = terms.limit(SENT + 1).count() <= SENT
    near = heads.join(F.broadcast(terms) if few else terms, "_head").select("doc", "page", F.struct("entity", "term", "kind", "_t").alias("t"))
    # a text is met once, by all its candidates, and most of them are gone before rows multiply
    listed = near.groupBy("doc", "page").agg(F.collect_list("t").alias("_all"))
    held = F.filter("_all", lambda t: F.contains(F.upper(F.col("text")), t["_t"]) & ((t["kind"] != "tag") | (F.col("trust") >= 2)))
    met = pages.select("doc", "page", "trust", "text").join(listed, ["doc", "page"]).select("doc", "page", "trust", "text", F.explode(held).alias("t")).select("doc", "page", "trust", "text", "t.*")
    quoted = F.concat(F.lit(r"(?iu)(?<![A-Z0-9])\Q"), F.replace("term", F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))
    loose = F.when(F.col("kind") == "tag", F.lit("(?![0-9])")).otherwise(F.lit("(?![A-Z0-9])"))
    met = met.where(F.regexp_like("text", F.concat(quoted, loose)))
    return met.select("doc", "page", "trust", "entity", "term", "kind", F.regexp_like("text", F.concat(quoted, F.lit(r"(?![A-Z0-9_\-])"))).alias("exact"))


def entity_documents(hits: DataFrame, docs: DataFrame, order: list[Column], keep: dict[str, int], other: int = 2, most: int = MOST) -> DataFrame:
    """entity, category, place, doc, term, exact, hits, pages, shown, alternates: what is shown of the documents (doc, number, revision, category, family) hit.

    Of documents of one number the highest revision stays (then the smallest doc), of one document the best hit (exact first, then more pages, then the term).
    Families stand in `order` of their best document; its best document stands for a family, the others are its alternates. A category shows at most
    keep[category] families (`other` unless listed) and an entity `most`, by category and place; what is beyond is returned with shown false, so nothing is lost.
    """
    per = hits.groupBy("entity", "term", "kind", "doc").agg(F.max("exact").alias("exact"), F.max("trust").alias("trust"), F.count(F.lit(1)).alias("hits"), F.slice(F.array_sort(F.collect_set("page")), 1, PAGES).alias("pages"))
    per = per.withColumn("_r", F.row_number().over(W.partitionBy("entity", "doc").orderBy(F.desc("exact"), F.desc("hits"), "term", "kind"))).where("_r = 1").drop("_r")
    per = per.join(docs, "doc")
    number = F.coalesce("number", F.concat(F.lit("doc|"), F.col("doc").cast("string")))
    per = per.withColumn("_n", number).withColumn("_r", F.row_number().over(W.partitionBy("entity", "_n").orderBy(F.desc_nulls_last("revision"), "doc"))).where("_r = 1").drop("_r", "_n")
    rank = [F.when(F.col("exact"), 0).otherwise(1), *order, F.col("doc")]
    fam = W.partitionBy("entity", "category", "family").orderBy(*rank)
    per = per.withColumn("_m", F.row_number().over(fam)).withColumn("alternates", F.collect_list("doc").over(fam.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)))
    best = per.where("_m = 1").withColumn("alternates", F.slice("alternates", F.lit(2), F.greatest(F.size("alternates") - 1, F.lit(0))))
    best = best.withColumn("place", F.row_number().over(W.partitionBy("entity", "category").orderBy(*rank)))
    limit = F.lit(other)
    for name, n in keep.items():
        limit = F.when(F.col("category") == name, n).otherwise(limit)
    best = best.withColumn("_in", F.col("place") <= limit)
    best = best.withColumn("_at", F.sum(F.col("_in").cast("int")).over(W.partitionBy("entity").orderBy("category", "place")))
    return best.select("entity", "category", "place", "doc", "term", "exact", "hits", "pages", (F.col("_in") & (F.col("_at") <= most)).alias("shown"), "alternates")


#: Words in a row by which phrases and texts meet.
RUN = 4


def _runs(words: Column) -> Column:
    """The hash of each RUN words in a row; each word is hashed once."""

    def joined(h: Column) -> Column:
        some = F.transform(F.sequence(F.lit(0), F.size(h) - RUN), lambda i: F.xxhash64(*(F.get(h, i + k) for k in range(RUN))))
        return F.when(F.size(h) >= RUN, some).otherwise(F.array().cast("array<bigint>"))

    return let(F.transform(words, lambda w: F.xxhash64(w)), joined)


def phrase_hits(docs: DataFrame, phrases: DataFrame) -> DataFrame:
    """docs (doc_id, text), phrases (phrase) -> doc_id, phrase, n: texts that hold a phrase as it stands, wherever it begins or ends; n: how often the phrase is listed.

    A phrase's inner words stand whole in any text that holds it, so phrases and texts meet by a hash of their first RUN inner words in a row, or of the longest one
    where they have fewer, and only candidates meet texts again. Phrases of fewer than three words have none: they are looked for in every text, in one list that
    is sent while it is small.
    """
    words = lambda c: F.filter(F.split(c, r"\s+"), lambda w: w != "")
    p = phrases.where("phrase IS NOT NULL").groupBy("phrase").agg(F.count(F.lit(1)).alias("n")).withColumn("_w", words(F.col("phrase")))
    p = p.withColumn("_in", F.slice("_w", 2, F.greatest(F.size("_w") - 2, F.lit(0)))).withColumn("_size", F.when(F.size("_in") >= RUN, RUN).otherwise(F.least(F.size("_in"), F.lit(1))))
    longest = F.aggregate("_in", F.lit(""), lambda x, w: F.when(F.length(w) > F.length(x), w).otherwise(x))
    p = p.withColumn("_head", F.when(F.col("_size") == RUN, F.get(_runs(F.slice("_in", 1, RUN)), F.lit(0))).when(F.col("_size") == 1, F.xxhash64(longest)))
    sizes = [r[0] for r in p.select("_size").distinct().collect()]  # three at most
    texts = docs.where("text IS NOT NULL").select("doc_id", "text")
    out = None
    if any(sizes):
        heads = p.where("_size > 0").select("_head", "phrase", "n")
        split = texts.select("doc_id", words(F.col("text")).alias("_w"))
        made = ([_runs(F.col("_w"))] if RUN in sizes else []) + ([F.transform(F.array_distinct("_w"), lambda w: F.xxhash64(w))] if 1 in sizes else [])
        grams = split.select("doc_id", F.explode(F.array_distinct(F.concat(*made))).alias("_head"))
        few = heads.limit(SENT + 1).count() <= SENT
        near = grams.join(F.broadcast(heads) if few else heads, "_head").select("doc_id", "phrase", "n")
        out = texts.join(near, "doc_id").where(F.contains("text", "phrase")).select("doc_id", "phrase", "n").distinct()
    if 0 in sizes:
        short = p.where("_size = 0").select("phrase", "n")
        if short.limit(SHORT + 1).count() <= SHORT:
            one = F.broadcast(short.agg(F.collect_list(F.struct("phrase", "n")).alias("_all")))  # one row of SHORT phrases at most
            found = texts.crossJoin(one).select("doc_id", F.explode(F.filter("_all", lambda x: F.contains(F.col("text"), x["phrase"]))).alias("x")).select("doc_id", "x.phrase", "x.n")
        else:
            found = texts.join(short, F.contains("text", "phrase")).select("doc_id", "phrase", "n")
        out = found.distinct() if out is None else out.unionByName(found.distinct())
    return out if out is not None else texts.select("doc_id", F.lit("").alias("phrase"), F.lit(0).cast("long").alias("n")).limit(0)
