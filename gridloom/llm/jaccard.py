"""N-gram Jaccard join by grouped prefixes.

A document's set holds the distinct hashes of its K-word shingles. Two sets of similarity t or more share
one of the first n - ceil(t n) + 1 elements in any common order; here rare hashes come before the HOT frequent ones
(any order is right, this one keeps what everybody shares out of the prefixes).

1. Documents with the same set are one class; classes with the same prefix and size are one group.
2. Groups meet by prefix element. Elements of one group only go at once. Frequent elements are salted.
3. Groups are expanded to classes. Within an element's bucket, first each class meets the leader of its size band and
   of the band below (a star, linear in the bucket); pairs pass length, position and bitmap filters, then the
   sets are compared whole.
4. Buckets that still hold more than one component meet again: their classes are compared by bitmap in blocks of bounded size; of
   the pairs that pass, each class first tries its nearest of another component, then all that remain. So a large group of near
   copies costs a few comparisons a document, and yet no pair that might join two components is left out.

A row's component is the smallest id reachable over links. Null and empty texts and texts without words have an empty set and
link with nothing; rows without an id do not either, and have no component. Rows that repeat an id are one document. An empty table gives an
empty result. Shingles are compared by 64-bit hashes. Extra columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from gridloom.llm.common import groups, keep, runs, shingle_set, small_batches, splitmix, word_hashes, unused
from gridloom.llm.components import components

K, SIMILARITY = 5, (80, 100)
#: Frequent shingles that are put last in the order: at most HOT, each in HOT_LEAST documents of some task and in this share of them.
HOT, HOT_LEAST, HOT_SHARE = 65_536, 6, 2e-4
#: Counters in which a task counts shingles by hash.
COUNTERS = 1 << 23
#: Fewest bits of a parity bitmap; else the next power of two from the size of the set, so that unlike sets differ in far more bits than a link allows.
BITS = 256
#: Classes of a bucket that are compared with one another in one block.
BLOCK = 512
#: Ids that are broadcast rather than shuffled to pick out texts.
BROADCAST_IDS = 1_000_000


def _sets(texts: list[bytes], k: int) -> Iterator[np.ndarray]:
    h, _, _, first = word_hashes(texts)
    s = runs(h, k)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        yield np.unique(s[a : b - k + 1]) if b - a >= k else shingle_set(h[a:b], k)


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[int, list[bytes]]]:
    return groups(batch.column("text").cast(pa.binary()).to_pylist())


def frequent(docs: DataFrame, k: int) -> np.ndarray:
    """The HOT most frequent shingles among those frequent in some task, ascending."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, found, docs_seen, shingles = np.zeros(COUNTERS, np.uint32), [], 0, 0
        for batch in batches:
            for _, texts in _texts(batch):
                docs_seen += len(texts)
                s = np.concatenate([np.zeros(0, np.uint64), *_sets(texts, k)])
                shingles += len(s)
                at = (s >> np.uint64(41)).astype(np.int64)
                np.add.at(n, at, 1)
                # a frequent shingle is still met when its counter has come so far
                found.append(np.unique(s[n[at] >= HOT_LEAST]))
        if found:
            s = np.unique(np.concatenate(found))
            count = n[(s >> np.uint64(41)).astype(np.int64)].astype(np.int64)
            load = shingles / COUNTERS
            some = count >= max(HOT_LEAST, HOT_SHARE * docs_seen, load + 6 * load**0.5)
            yield pa.RecordBatch.from_arrays([pa.array(s[some].view(np.int64)), pa.array(count[some])], names=["token", "n"])

    top = docs.select("text").mapInArrow(counted, "token long, n long").groupBy("token").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "token").limit(HOT)
    return np.sort(np.array([r[0] for r in top.collect()], np.int64).view(np.uint64))


def _features(docs: DataFrame, k: int, t: tuple[int, int], hot: np.ndarray) -> DataFrame:
    num, den = t

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, cold, digest, group, prefix, bitmap = [], [], [], [], [], []
            for _, texts in _texts(batch):
                for s in _sets(texts, k):
                    m = len(s)
                    n.append(m)
                    at = np.searchsorted(hot, s)
                    is_hot = (hot[np.minimum(at, len(hot) - 1)] == s) if len(hot) else np.zeros(m, bool)
                    p = np.concatenate([s[~is_hot], s[is_hot]])[: m - (num * m + den - 1) // den + 1 if m else 0]
                    cold.append(min(m - int(is_hot.sum()), len(p)))
                    prefix.append(p)
                    digest.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                    group.append(hashlib.blake2b(p.tobytes() + m.to_bytes(8, "little"), digest_size=16).digest())
                    bits = 1 << max(BITS.bit_length() - 1, (m - 1).bit_length() if m else 0)
                    bitmap.append(np.packbits((np.bincount((splitmix(s) & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1).astype(np.uint8)).tobytes())
            flat = np.concatenate([np.zeros(0, np.uint64), *prefix]).view(np.int64)
            offsets = np.concatenate([[0], np.cumsum([len(p) for p in prefix])]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int32()), pa.array(cold, pa.int32()), pa.array(digest, pa.binary()), pa.array(group, pa.binary()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)), pa.array(bitmap, pa.binary())],
                names=["doc_id", "n", "cold", "digest", "gkey", "prefix", "bitmap"],
            )

    return docs.mapInArrow(made, "doc_id long, n int, cold int, digest binary, gkey binary, prefix array<long>, bitmap binary")


def _folded(x: np.ndarray) -> np.ndarray:
    """The parity bitmaps of half as many bits: both halves together."""
    half = x.shape[-1] // 2
    return x[..., :half] ^ x[..., half:]


def differing(x: bytes, y: bytes) -> int:
    """Bits in which two parity bitmaps differ, at the smaller one's size: at most the elements that are in one set only."""
    u, v = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
    while len(u) > len(v):
        u = _folded(u)
    while len(v) > len(u):
        v = _folded(v)
    return int(np.bitwise_count(u ^ v).sum(dtype=np.int64))


def _apart(na, nb, t: tuple[int, int]):
    """The most elements that may be in one of two sets only: na + nb - 2 * least overlap."""
    num, den = t
    return na + nb - 2 * -((-num * (na + nb)) // (num + den))


def verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame, k: int, t: tuple[int, int]) -> tuple[DataFrame, DataFrame]:
    """Of candidate pairs (a, b) those that are similar enough, and those that passed the bitmap; both kept."""
    num, den = t

    def near(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in batches:
            if len(df):
                d = np.array([differing(x, y) for x, y in zip(df["bitmap_a"], df["bitmap_b"], strict=True)])
                yield df.loc[d <= _apart(df["n_a"].to_numpy(np.int64), df["n_b"].to_numpy(np.int64), t), ["a", "b"]]

    side = lambda x: classes.select(F.col("cid").alias(x), F.col("n").alias(f"n_{x}"), F.col("bitmap").alias(f"bitmap_{x}"))
    passed = keep(pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "n_a", "n_b", "bitmap_a", "bitmap_b").mapInPandas(near, "a long, b long").distinct())
    ids = keep(passed.select(F.col("a").alias("cid")).unionByName(passed.select(F.col("b").alias("cid"))).distinct())
    picked = docs.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, docs["doc_id"] == ids["cid"]).select("cid", "text")

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [s.tobytes() for _, texts in _texts(batch) for s in _sets(texts, k)]
            yield pa.RecordBatch.from_arrays([batch.column("cid"), pa.array(sets, pa.binary())], names=["cid", "set"])

    sets = keep(picked.mapInArrow(whole, "cid long, set binary"))

    def similar(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in batches:
            ok = []
            for x, y in zip(df["set_a"], df["set_b"], strict=True):
                u, v = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(u, v, assume_unique=True))
                ok.append(both > 0 and den * both >= num * (len(u) + len(v) - both))
            yield df.loc[np.array(ok, bool), ["a", "b"]]

    full = passed.join(sets.select(F.col("cid").alias("a"), F.col("set").alias("set_a")), "a").join(sets.select(F.col("cid").alias("b"), F.col("set").alias("set_b")), "b")
    return keep(full.mapInPandas(similar, "a long, b long").distinct()), passed


def _in_blocks(t: tuple[int, int], every: bool):
    """For rows sorted by block: pairs of different components whose bitmaps allow a link; each class's nearest, or all."""

    num, den = t

    def pairs_of(token: pd.DataFrame) -> list[tuple[int, int]]:
        n, pos, comp, cid, here = (token[c].to_numpy() for c in ("n", "pos", "component", "cid", "here"))
        if len(n) < 2 or (comp == comp[0]).all():
            return []
        one, first = token["bi"].iat[0] == token["bj"].iat[0], token["bi"].iat[0]
        n, left, at = n.astype(np.int64), n - pos - 1, np.arange(len(n))
        raw = [np.frombuffer(x, np.uint64) for x in token["bitmap"]]
        size = np.array([len(x) for x in raw])
        # the bitmaps of each size, and those twice as large folded to it: sets that may link are no further apart
        level = {b: (np.flatnonzero((size == b) | (size == 2 * b)), np.stack([raw[i] if size[i] == b else _folded(raw[i]) for i in np.flatnonzero((size == b) | (size == 2 * b))])) for b in np.unique(size)}
        found = []
        for i in range(len(n)):
            if not one and here[i] != first:
                continue
            apart = _apart(n, n[i], t)
            # of equal sets sizes, positions and components decide first; positions hold where the shared element is the first
            ok = (comp != comp[i]) & (np.minimum(n, n[i]) * den >= np.maximum(n, n[i]) * num) & (2 * (1 + np.minimum(left, left[i])) >= n + n[i] - apart)
            ok &= at > i if one else here != first
            if not ok.any():
                continue
            d = np.full(len(n), 1 << 60)
            for b in (size[i], size[i] // 2):
                if b in level:
                    js, bits = level[b]
                    mine = raw[i] if size[i] == b else _folded(raw[i])
                    some = ok[js] & (np.minimum(size[js], size[i]) == b)
                    d[js[some]] = np.bitwise_count(bits[some] ^ mine).sum(1, dtype=np.int64)
            j = np.flatnonzero(d <= apart)
            if len(j):
                found += [(cid[i], cid[x]) for x in (j if every else j[[int(np.argmin(d[j]))]])]
        return found

    def told(rows: pd.DataFrame) -> list[tuple[int, int, int]]:
        token = rows["token"].iat[0]
        return [(token, a, b) for a, b in pairs_of(rows)]

    def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for df in batches:
            df = df if rest is None else pd.concat([rest, df], ignore_index=True)
            if not len(df):
                continue
            key = df[["token", "bi", "bj"]].to_numpy(np.int64)
            cut = np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1
            found = [p for a, b in zip([0, *cut[:-1]], cut, strict=False) for p in told(df.iloc[a:b])]
            rest = df.iloc[cut[-1] if len(cut) else 0 :]
            if found:
                yield pd.DataFrame(found, columns=["token", "a", "b"])
        if rest is not None and len(rest) and (found := told(rest)):
            yield pd.DataFrame(found, columns=["token", "a", "b"])

    return blocks


def near_groups(docs: DataFrame, k: int = K, t: tuple[int, int] = SIMILARITY) -> DataFrame:
    """doc_id, n_shingles, component_id; a row for each row of docs (doc_id, text). t: similarity as a fraction (num, den)."""
    spark = docs.sparkSession
    small_batches(spark)
    num, den = t
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    made = keep(_features(docs, k, t, frequent(docs, k)))
    some = made.where("n > 0 AND doc_id IS NOT NULL")
    classes = keep(some.groupBy("digest").agg(F.min("doc_id").alias("cid"), F.first("n").alias("n"), F.first("gkey").alias("gkey"), F.first("bitmap").alias("bitmap")))
    group = some.groupBy("gkey").agg(F.min("doc_id").alias("gid"), F.first("n").alias("n"), F.first("cold").alias("cold"), F.first("prefix").alias("prefix"))
    salts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tokens = group.select("gid", "cold", F.posexplode("prefix").alias("pos", "token")).withColumn("salt", F.when(F.col("pos") >= F.col("cold"), F.pmod(F.xxhash64("gid"), F.lit(salts)) + 1).otherwise(0))
    shared = keep(tokens.withColumn("c", F.count(F.lit(1)).over(W.partitionBy("token", "salt"))).where("c > 1 OR salt > 0").select("token", "gid", "pos"))
    # groups to classes; classes of one group also share a bucket of their own
    gids = classes.groupBy("gkey").agg(F.min("cid").alias("gid"), F.count(F.lit(1)).alias("size"))
    member = keep(classes.select("cid", "n", "gkey").join(gids, "gkey"))
    rows = shared.join(member.select("gid", "cid", "n"), "gid").select("token", "cid", "n", "pos")
    rows = rows.unionByName(member.where("size > 1").select(F.xxhash64("gkey").alias("token"), "cid", "n", F.lit(0).alias("pos")))
    rows = keep(rows.withColumn("band", F.floor(F.log(F.col("n") + 0.5) / F.log(F.lit(den / num))).cast("int")))
    leads = rows.groupBy("token", "band").agg(F.min(F.struct("cid", "n", "pos")).alias("lead"))
    leads = leads.withColumn("band", F.explode(F.array(F.col("band"), F.col("band") + 1)))
    star = rows.join(leads, ["token", "band"]).where(F.col("cid") != F.col("lead.cid"))
    least = F.ceil(F.lit(num) * (F.col("n") + F.col("lead.n")) / F.lit(num + den) - 1e-9)
    star = star.where((F.least("n", "lead.n") * den >= F.greatest("n", "lead.n") * num) & (1 + F.least(F.col("n") - F.col("pos") - 1, F.col("lead.n") - F.col("lead.pos") - 1) >= least))
    tried = star.select(F.least("cid", "lead.cid").alias("a"), F.greatest("cid", "lead.cid").alias("b")).distinct()
    links, passed = verified(tried, classes, docs, k, t)
    for every in (False, True):
        label = components(links)
        now = keep(rows.join(label, rows["cid"] == label["node"], "left").select("token", "cid", "n", "pos", F.coalesce("component", "cid").alias("component")))
        open_ = now.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count(F.lit(1)).alias("m")).where("lo <> hi AND m > 2").select("token", F.ceil(F.col("m") / BLOCK).cast("int").alias("parts"))
        left = keep(now.join(open_, "token").join(classes.select("cid", "bitmap"), "cid"))
        if left.isEmpty():
            break
        left = left.withColumn("here", F.pmod(F.xxhash64("cid"), F.col("parts")).cast("int"))
        left = left.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select("token", F.least("here", "with").alias("bi"), F.greatest("here", "with").alias("bj"), "here", "cid", "n", "pos", "component", "bitmap")
        met = keep(left.repartition("token", "bi", "bj").sortWithinPartitions("token", "bi", "bj").mapInPandas(_in_blocks(t, every), "token long, a long, b long"))
        pairs = keep(met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct().join(passed, ["a", "b"], "left_anti"))
        # components only grow: a bucket without such a pair now has none later
        rows = rows.join(met.select("token").distinct(), "token", "left_semi")
        if pairs.isEmpty():
            continue  # the nearest may all be refused already and others not tried
        more, more_passed = verified(pairs, classes, docs, k, t)
        links, passed = links.unionByName(more), passed.unionByName(more_passed)
    label = keep(components(links))
    out = made.select("doc_id", "n", F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("digest")).alias("digest"))
    out = out.join(classes.select("digest", "cid"), "digest", "left").join(label, F.col("cid") == label["node"], "left")
    return out.select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.coalesce("component", "cid", "doc_id").alias("component_id"))


def near_dedup(docs: DataFrame, k: int = K, t: tuple[int, int] = SIMILARITY) -> DataFrame:
    """The rows of docs that stay, all columns as they are: of each component the row with the smallest id, and rows without an id."""
    id_ = unused(docs, "_id")
    gone = near_groups(docs, k, t).where("doc_id <> component_id").select(F.col("doc_id").alias(id_)).distinct()
    return docs.join(gone, F.col("doc_id") == F.col(id_), "left_anti")


#: Every pair of documents that share a shingle: for small tables only, as an oracle (three words, ninety hundredths).
PAIRS_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
g AS (SELECT DISTINCT doc_id, s FROM (SELECT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, chr(10))] ELSE list_transform(range(1, len(ws) - 1), lambda i: ws[i] || chr(10) || ws[i + 1] || chr(10) || ws[i + 2]) END) AS s FROM w)),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY 1), i AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM g a JOIN g b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM i JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 90 * (x.n + y.n - shared)), r(a, b) AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a), c AS (SELECT a, least(a, min(b)) AS component_id FROM r GROUP BY a)
SELECT w.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(component_id, w.doc_id) AS component_id FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN c ON c.a = w.doc_id
"""
