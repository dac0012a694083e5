"""Repeated passages by sparse suffix arrays.

Of all suffixes (at words) only those at minimisers are kept: the least hash of GRAM words in every WINDOW neighbours, so equal
text keeps equal suffixes. Kept suffixes that share their first SEED words make a bucket. In a bucket of at most NEIGHBOURS + 1 all are compared. In a larger
one, a suffix whose SIDE words on both sides read as an earlier one's too is compared with that one; of the first of each such kind every
passage of MIN_WORDS words about the seed is hashed, and compared with an earlier one that reads the same. Matches of two documents on one diagonal chain up (seeds are longer than the distance between kept suffixes,
so chained seeds leave no gap) and chains are extended word by word to the left and to the right, at most a WINDOW each way, beyond
which another kept suffix would lie. Chains of at least MIN_WORDS words stay; each passage is reported at every occurrence but the first.

Every passage of MIN_WORDS words has a kept suffix among its first WINDOW words with at least SEED words of the passage after
it, so it is in one bucket with its copies, and meets one of them however many the bucket holds. Large buckets are salted by document; the firsts of the salts meet once more.
Ties between equal hashes go to the first place in the window, so that copies of a passage keep the same suffixes wherever they stand. A run that repeats
PERIOD words or fewer over and over would keep one at every repetition: in its middle none is kept, as whatever stands there stands at its
beginning too, and the run is reported as a match with itself, one repetition further on.

Hot seeds are those of more suffixes than a HOT-th of all; so there are no more than HOT of them, they are broadcast, and their
suffixes are dealt by salt and surroundings and never by seed alone. Texts that are looked up again are picked out first by hash buckets of their ids, LOOKUP at most,
so that few others are shuffled.

Words are runs without space and 0x09-0x0D and are compared by 64-bit hashes of their bytes, case included. Null and empty texts have no words. Rows
without an id are left out. Rows that repeat id and text are one document; two texts of one id are taken as one document's. An
empty table gives an empty result. Offsets count words, end exclusive; extra columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from gridloom.llm.common import groups, keep, runs, small_batches, splitmix, word_hashes

MIN_WORDS, GRAM, WINDOW = 50, 8, 20
SEED = MIN_WORDS - WINDOW + 1
#: Words beside the seed that a passage of MIN_WORDS words can have on one side.
SIDE = MIN_WORDS - SEED
#: A bucket of one more than this is small: each of its suffixes is compared with all before it.
NEIGHBOURS = 3
#: Suffixes of a bucket that one salt gets.
SALTED = 2000
#: A seed is hot that has more than this share of all suffixes.
HOT = 10_000
#: Hash buckets of ids, those in use being broadcast, that tell which texts a lookup may want.
LOOKUP = 1 << 20
#: Runs that repeat this many words or fewer keep suffixes at their ends only.
PERIOD = 8


def _least(g: np.ndarray) -> np.ndarray:
    """Of every WINDOW neighbours the position of the least, the first one if several are."""
    if len(g) < WINDOW:
        return np.zeros(0, np.int64)
    return np.lib.stride_tricks.sliding_window_view(g, WINDOW).argmin(1) + np.arange(len(g) - WINDOW + 1)


def periodic(g: np.ndarray) -> list[tuple[int, int, int]]:
    """(period, start, end) of the stretches of words, longer than MIN_WORDS and a period, in which every word is the one `period` words before
    (from start + period on); the least period of each. g: the hash of each GRAM words."""
    out: list[tuple[int, int, int]] = []
    for p in range(1, PERIOD + 1):
        if len(g) <= p:
            break
        same = np.concatenate([[False], g[p:] == g[:-p], [False]])
        edge = np.flatnonzero(same[1:] != same[:-1])
        for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
            a, b = a, b + GRAM - 1 + p
            if b - a >= MIN_WORDS + p and not any(p % q == 0 and s <= a and b <= e for q, s, e in out):
                out.append((p, a, b))
    return out


def maybe_periodic(g: np.ndarray, first: np.ndarray) -> set[int]:
    """Which texts may hold a periodic run: g of all texts one after another shows as long a stretch of equal hashes there."""
    out: set[int] = set()
    for p in range(1, PERIOD + 1):
        at = np.flatnonzero(g[p:] == g[:-p]) if len(g) > p else g[:0]
        need = MIN_WORDS - GRAM
        if len(at) > need:
            # equal hashes in a row: as many places on as there are words between
            ends = at[need:][at[need:] - at[:-need] == need]
            out.update((np.searchsorted(first, ends, "right") - 1).tolist())
            out.update((np.searchsorted(first, ends - need, "right") - 1).tolist())
    return out


def kept_suffixes(g: np.ndarray, look: bool = True) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """Positions of the least of every WINDOW neighbours, without those amid periodic runs; and these runs."""
    at, runs_ = np.unique(_least(g)), periodic(g) if look else []
    for _, a, b in runs_:
        at = at[(at < a + 2 * WINDOW) | (at >= b - MIN_WORDS)]
    return at, runs_


def _long_runs(h: np.ndarray, k: int, n: int) -> np.ndarray:
    """Hash of each k * n words that follow one another, from those of k."""
    part = runs(h, k)
    size = len(h) - k * n + 1
    if size <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(size, np.uint64)
    for j in range(n):
        out = splitmix(out * np.uint64(0xD6E8FEB86659FD93) + part[j * k : j * k + size])
    return out


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Kept suffixes (period 0); and of periodic runs places, a seed's length apart, that match those a period before (period > 0)."""
    gap = np.zeros(SIDE, np.uint64)  # stands for the words that a text lacks beside a seed
    for batch in batches:
        ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
        for at, texts in groups(batch.column("text").cast(pa.binary()).to_pylist()):
            h, _, _, first = word_hashes(texts, lower=False)
            seed, gram = runs(h, SEED), runs(h, GRAM)
            look = maybe_periodic(gram, first)
            doc, pos, bucket, around, period = [], [], [], [], []
            for j, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist(), strict=True)):
                if b - a < MIN_WORDS:
                    continue
                p, repeats = kept_suffixes(gram[a : b - GRAM + 1], j in look)
                p = p[p <= b - a - SEED]
                pos.append(p)
                bucket.append(seed[a + p])
                around.append(_long_runs(np.concatenate([gap, h[a:b], gap]), (SEED + 2 * SIDE) // 3, 3)[p])
                period.append(np.zeros(len(p), np.int32))
                for of, start, end in repeats:
                    p = np.append(np.arange(start + of, end - SEED, SEED), end - SEED)
                    pos.append(p)
                    bucket.append(np.zeros(len(p), np.uint64))
                    around.append(np.zeros(len(p), np.uint64))
                    period.append(np.full(len(p), of, np.int32))
                doc.append(np.full(sum(map(len, pos)) - sum(map(len, doc)), ids[at + j]))
            if doc:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(bucket).view(np.int64)), pa.array(np.concatenate(doc).astype(np.int64)), pa.array(np.concatenate(pos).astype(np.int32)), pa.array(np.concatenate(around).view(np.int64)), pa.array(np.concatenate(period))], names=["seed", "doc", "pos", "around", "period"])


def _passages(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The passages of MIN_WORDS words whose kept suffix is among the places, each with the salt of that suffix."""
    for df in batches:
        for i, texts in groups(df["text"]):
            h, _, _, first = word_hashes(texts, lower=False)
            key, salt, doc, pos = [], [], [], []
            for j, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist(), strict=True)):
                if b - a < MIN_WORDS:
                    continue
                r = df.iloc[i + j]
                of = np.full(b - a, -1, np.int64)
                at, salts = np.asarray(r["at"]), np.asarray(r["salts"])
                of[at[at < b - a]] = salts[at < b - a]
                of = of[_least(runs(h[a:b], GRAM))[: b - a - MIN_WORDS + 1]]
                p = np.flatnonzero(of >= 0)
                key.append(_long_runs(h[a:b], MIN_WORDS // 5, 5)[p].view(np.int64))
                salt.append(of[p])
                doc.append(np.full(len(p), r["doc_id"]))
                pos.append(p)
            if key:
                yield pd.DataFrame({"key": np.concatenate(key), "salt": np.concatenate(salt), "doc": np.concatenate(doc), "pos": np.concatenate(pos)})


def _chains(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for df in batches:
        out = []
        for b, a, diag, at in df[["doc", "other", "diag", "at"]].itertuples(index=False):
            p = np.sort(np.asarray(at))
            cut = np.flatnonzero(np.diff(p) > SEED) + 1
            out += [(b, a, diag, int(q[0]), int(q[-1]) + SEED) for q in np.split(p, cut)]
        yield pd.DataFrame(out, columns=["doc", "other", "diag", "start", "end"])


def _contexts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The hashes of up to WINDOW words before each place in lefts (nearest first) and after each in rights."""
    for df in batches:
        out = []
        for i, texts in groups(df["text"]):
            h, _, _, first = word_hashes(texts, lower=False)
            for j in range(len(texts)):
                w = h[first[j] : first[j + 1]]
                r = df.iloc[i + j]
                out += [(r["doc_id"], int(p), 0, w[max(0, p - WINDOW) : p][::-1].tobytes()) for p in r["lefts"]]
                out += [(r["doc_id"], int(p), 1, w[p : p + WINDOW].tobytes()) for p in r["rights"]]
        yield pd.DataFrame(out, columns=["doc", "at", "side", "words"])


def _extended(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for df in batches:
        n = []
        for x, y in zip(df["words_b"], df["words_a"], strict=True):
            u, v = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            m = min(len(u), len(v))
            n.append(int(np.argmin(np.concatenate([u[:m] == v[:m], [False]]))))
        yield df[["doc", "other", "diag", "start", "end", "side"]].assign(n=n)


def _looked_up(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """docs joined with wanted by its id. Texts of other buckets than those of wanted ids are not shuffled."""
    bucket = lambda c: F.pmod(F.xxhash64(c), F.lit(LOOKUP))
    some = docs.join(F.broadcast(wanted.select(bucket("id").alias("bucket")).distinct()), bucket("doc_id") == F.col("bucket"), "left_semi")  # LOOKUP rows at most
    return some.join(wanted, F.col("doc_id") == F.col("id"))


def repeated_passages(docs: DataFrame) -> DataFrame:
    """doc_id, start_word, end_word, n_words, match_doc_ids: stretches of documents that repeat passages found earlier
    (in a document with a smaller id, or further up in the same), merged where they touch, with the documents they were matched with."""
    small_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id IS NOT NULL AND text IS NOT NULL")
    every = keep(docs.mapInArrow(_anchors, "seed long, doc long, pos int, around long, period int"))
    suffixes, repeats = every.where("period = 0").drop("period"), every.where("period > 0")
    many = keep(suffixes.groupBy("seed").agg(F.count(F.lit(1)).alias("c")).where("c > 1"))
    hot = many.where(F.col("c") > max(SALTED, suffixes.count() // HOT))  # no more than HOT rows
    # of a small bucket -1; 0 where one salt holds the bucket
    salt = F.when(F.col("c") <= NEIGHBOURS + 1, -1).when(F.col("c") <= SALTED, 0).otherwise(F.pmod(F.xxhash64("doc"), F.ceil(F.col("c") / SALTED)) + 1).cast("int")
    told = suffixes.join(F.broadcast(hot.withColumnRenamed("c", "c_hot")), "seed", "left")
    told = told.where("c_hot IS NULL").drop("c_hot").join(many, "seed").unionByName(told.where("c_hot IS NOT NULL").withColumnRenamed("c_hot", "c"))
    kept = keep(told.select("seed", "doc", "pos", "around", salt.alias("salt")))
    before = F.struct("doc", "pos")
    neighbours = lambda df, w, n=1: df.select("doc", "pos", F.array(*(F.lag(before, k).over(w.orderBy("doc", "pos")) for k in range(1, n + 1))).alias("prevs")).select("doc", "pos", F.explode("prevs").alias("prev"))

    def alike(df: DataFrame, *by: str) -> DataFrame:
        """Each row with the one before it of those that are alike in by; the first of each salt meets those of the other salts."""
        firsts = df.where("salt > 0").groupBy(*by, "salt").agg(F.min(before).alias("f")).select(*by, "f.doc", "f.pos")
        return neighbours(df, W.partitionBy(*by, "salt")).unionByName(neighbours(firsts, W.partitionBy(*by)))

    large = kept.where("salt >= 0")
    kinds = large.groupBy("seed", "around").agg(F.min(F.struct("doc", "pos", "salt")).alias("f")).select("f.doc", "f.pos", "f.salt")
    kinds = keep(kinds.groupBy(F.col("doc").alias("id")).agg(F.collect_list(F.struct("pos", "salt")).alias("x")).select("id", F.col("x.pos").alias("at"), F.col("x.salt").alias("salts")))
    passages = keep(_looked_up(docs, kinds).select("doc_id", "text", "at", "salts").mapInPandas(_passages, "key long, salt int, doc long, pos int"))
    near = neighbours(kept.where("salt < 0"), W.partitionBy("seed"), NEIGHBOURS)
    pairs = near.unionByName(alike(large, "seed", "around")).unionByName(alike(passages, "key")).where("prev IS NOT NULL")
    lo, hi = F.least(before, F.col("prev")), F.greatest(before, F.col("prev"))
    pairs = pairs.select(lo.alias("a"), hi.alias("b")).where("a <> b").select(F.col("b.doc").alias("doc"), F.col("a.doc").alias("other"), (F.col("b.pos") - F.col("a.pos")).alias("diag"), F.col("b.pos").alias("at"))
    pairs = pairs.unionByName(repeats.select("doc", F.col("doc").alias("other"), F.col("period").alias("diag"), F.col("pos").alias("at")))
    chains = keep(pairs.groupBy("doc", "other", "diag").agg(F.collect_set("at").alias("at")).mapInPandas(_chains, "doc long, other long, diag int, start int, end int"))
    ends = chains.withColumn("side", F.explode(F.array(F.lit(0), F.lit(1)))).withColumn("at_b", F.when(F.col("side") == 0, F.col("start")).otherwise(F.col("end"))).withColumn("at_a", F.col("at_b") - F.col("diag"))
    places = ends.select("doc", F.col("at_b").alias("at"), "side").unionByName(ends.select(F.col("other").alias("doc"), F.col("at_a").alias("at"), "side"))
    places = keep(places.groupBy(F.col("doc").alias("id")).agg(F.collect_set(F.when(F.col("side") == 0, F.col("at"))).alias("lefts"), F.collect_set(F.when(F.col("side") == 1, F.col("at"))).alias("rights")))
    words = _looked_up(docs, places).select("doc_id", "text", "lefts", "rights")
    words = keep(words.mapInPandas(_contexts, "doc long, at int, side int, words binary").dropDuplicates(["doc", "at", "side"]))
    sides = ends.join(words.select("doc", F.col("at").alias("at_b"), "side", F.col("words").alias("words_b")), ["doc", "at_b", "side"])
    sides = sides.join(words.select(F.col("doc").alias("other"), F.col("at").alias("at_a"), "side", F.col("words").alias("words_a")), ["other", "at_a", "side"])
    grown = sides.mapInPandas(_extended, "doc long, other long, diag int, start int, end int, side int, n int")
    grown = grown.groupBy("doc", "other", "diag", "start", "end").agg(F.sum(F.when(F.col("side") == 0, F.col("n"))).alias("l"), F.sum(F.when(F.col("side") == 1, F.col("n"))).alias("r"))
    found = grown.select("doc", "other", (F.col("start") - F.col("l")).alias("start"), (F.col("end") + F.col("r")).alias("end")).where(F.col("end") - F.col("start") >= MIN_WORDS)
    by = W.partitionBy("doc").orderBy("start", "end", "other")
    found = found.withColumn("new", (F.col("start") > F.coalesce(F.max("end").over(by.rowsBetween(W.unboundedPreceding, -1)), F.lit(-1))).cast("int"))
    found = found.withColumn("run", F.sum("new").over(by.rowsBetween(W.unboundedPreceding, W.currentRow)))
    merged = found.groupBy("doc", "run").agg(F.min("start").alias("start_word"), F.max("end").alias("end_word"), F.array_sort(F.collect_set("other")).alias("match_doc_ids"))
    return merged.select(F.col("doc").alias("doc_id"), F.col("start_word").cast("long"), F.col("end_word").cast("long"), (F.col("end_word") - F.col("start_word")).cast("long").alias("n_words"), "match_doc_ids")
