"""Quality classifier by importance resampling.

Two generative models over hashed n-grams, one of target text (rows labelled good) and one of the raw text
(all documents), give each document an importance weight; documents are then resampled without
replacement by Gumbel top-k. N-grams are byte trigrams and, so that repetition and shouting show whatever the word, pairs of word
shapes (class of first and last byte, length, same as the word before or the one before that). A document's weight is the mean log
ratio over its n-grams (and FEW of weight 0), so long texts are not favoured.

What a weight is worth is learned from the labelled rows: a logistic curve gives the log odds that a document is target text. The sample's
size k follows from it: the target text that all documents are expected to hold, which is the sum of these probabilities. The
key of a document is its log odds plus standard Gumbel noise (temperature 1), and the k greatest keys are accepted: what is surely
junk or surely clean lies further from the k-th key than noise reaches, what lies between is sampled in proportion to its odds.

The raw model counts every n-gram of every document. The target model and the curve are fitted on at most MAX_LABELLED
labelled rows (those with the smallest id hashes). Noise is a hash of the id: reruns agree.

Null and empty texts have no n-grams and weight 0 like text of unknown quality. Null ids are hashed as null.
Rows that repeat get the same weight and noise, and rows that tie with the k-th key are accepted with it. Without usable labels (none, or of one
kind only) everything is accepted. An empty table gives an empty result. Extra columns are not looked at, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import groups, keep, small_batches, splitmix, unused, word_hashes

BUCKETS = 1 << 15
MAX_LABELLED = 20_000
#: Ridge of the logistic curve, in labelled rows: labels that part cleanly would make it infinitely steep.
RIDGE = 0.01
#: N-grams that each text is taken to have besides its own, of weight 0: a few words say little.
FEW = 150

_CLASS = np.zeros(256, np.int64)
_CLASS[ord("a") : ord("z") + 1] = 1
_CLASS[ord("A") : ord("Z") + 1] = 2
_CLASS[ord("0") : ord("9") + 1] = 3
_CLASS[[ord(c) for c in ".,;:?"]] = 4
_CLASS[128:] = 1
_CLASS[[ord(c) for c in "#$%&*|!@^~<>{}[]_=+\\/"]] = [5 + i for i in range(21)]


def ngrams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams of the texts in order, and where each text's begin, with the end."""
    h, start, end, first = word_hashes(texts)
    buf = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    at = np.concatenate([[0], np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts)))])
    x = buf.astype(np.uint64)
    tri = x[:-2] | (x[1:-1] << np.uint64(8)) | (x[2:] << np.uint64(16)) if len(x) > 2 else x[:0]
    # none of them reaches over the end of its text, nor does any pair of words
    inside = np.ones(len(x), bool)
    for back in (1, 2, 3):
        ends = at[1:] - back
        inside[ends[ends >= 0]] = False
    tri = tri[inside[: len(tri)]]
    tri_first = np.concatenate([[0], np.cumsum(np.maximum(0, np.diff(at) - 3))])
    base = np.repeat(at[:-1], np.diff(first))
    n = len(h)
    starts = np.unique(first[:-1][np.diff(first) > 0])
    same1, same2 = np.zeros(n, np.int64), np.zeros(n, np.int64)
    same1[1:] = h[1:] == h[:-1]
    same2[2:] = h[2:] == h[:-2]
    same1[starts] = same2[starts] = same2[np.minimum(starts + 1, n - 1)] = 0
    shape = ((_CLASS[buf[base + start]] * 32 + _CLASS[buf[base + end - 1]]) * 8 + np.minimum(7, np.log2(np.maximum(1, end - start)).astype(np.int64))) * 4 + same1 * 2 + same2
    shape = shape.astype(np.uint64) | np.uint64(1 << 40)
    pair = shape.copy()
    pair[1:] = shape[1:] * np.uint64(1 << 20) + shape[:-1]
    pair[starts] = shape[starts]
    # trigrams and shape pairs of one text together: order is free, so both streams are cut per text
    both = np.concatenate([splitmix(tri), splitmix(pair)]) & np.uint64(BUCKETS - 1)
    order = np.argsort(np.concatenate([np.repeat(np.arange(len(texts)), np.diff(tri_first)), np.repeat(np.arange(len(texts)), np.diff(first))]), kind="stable")
    return both[order].astype(np.int64), tri_first + first


def _counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    raw, good, bad = (np.zeros(BUCKETS, np.int64) for _ in range(3))
    for df in batches:
        for i, texts in groups(df["text"]):
            b, at = ngrams(texts)
            raw += np.bincount(b, minlength=BUCKETS)
            q = df["quality"].to_numpy()[i : i + len(texts)]
            for side, of in ((good, q == 1), (bad, q == 0)):
                if of.any():
                    side += np.bincount(b[np.repeat(of, np.diff(at))], minlength=BUCKETS)
    some = np.flatnonzero(raw)
    yield pd.DataFrame({"bucket": some, "raw": raw[some], "good": good[some], "bad": bad[some]})


def _weigher(ratio: np.ndarray):
    def weighed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in batches:
            out = np.zeros(len(df))
            for i, texts in groups(df["text"]):
                b, at = ngrams(texts)
                total = np.concatenate([[0.0], np.cumsum(ratio[b])])
                out[i : i + len(texts)] = (total[at[1:]] - total[at[:-1]]) / (FEW + np.diff(at))
            yield pd.DataFrame({"doc_id": df["doc_id"].astype("Int64"), "weight": out, "quality": df["quality"]})

    return weighed


def curve(weight: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Intercept and slope of the log odds of good by weight, by Newton steps. The weights are scaled first, so RIDGE means the same for any."""
    mean, spread = weight.mean(), max(weight.std(), 1e-12)
    x = np.stack([np.ones_like(weight), (weight - mean) / spread], 1)
    b = np.zeros(2)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + RIDGE * np.eye(2), x.T @ (good - p) - RIDGE * b)
        b = b + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return float(b[0] - b[1] * mean / spread), float(b[1] / spread)


def kth_key(rows: DataFrame, k: int, bins: int = 4096) -> float:
    """The k-th greatest of the column key; histograms narrow it down, so no task sees more than its share."""
    lo, hi = rows.agg(F.min("key"), F.max("key")).first()
    for _ in range(6):
        if not hi > lo:
            break
        step = (hi - lo) / bins
        bin_ = F.least(F.lit(bins - 1), F.floor((F.col("key") - lo) / step)).cast("int")
        above = rows.where(F.col("key") > hi).count()
        counts = {r[0]: r[1] for r in rows.where(F.col("key").between(lo, hi)).groupBy(bin_).count().collect()}
        for b in range(bins - 1, -1, -1):
            above += counts.get(b, 0)
            if above >= k:
                break
        inside = rows.where(F.col("key").between(lo, hi) & (bin_ == b))
        lo, hi = inside.agg(F.min("key"), F.max("key")).first()
    return lo


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, weight, log_odds, key, accepted; a row for each row of docs. labels: (doc_id, quality 0 or 1)."""
    small_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    some = labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").groupBy("doc_id").agg(F.max("quality").cast("int").alias("quality"))
    some = keep(some.orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_LABELLED))  # bounded, so it may be broadcast
    with_label = docs.join(F.broadcast(some), "doc_id", "left").select("doc_id", "text", F.coalesce("quality", F.lit(-1)).alias("quality"))
    sums = with_label.mapInPandas(_counted, "bucket int, raw long, good long, bad long").groupBy("bucket").agg(F.sum("raw"), F.sum("good"), F.sum("bad")).collect()
    raw, good, bad = (np.zeros(BUCKETS) for _ in range(3))
    for b, r, g, x in sums:  # at most BUCKETS rows
        raw[b], good[b], bad[b] = r, g, x
    usable = good.sum() > 0 and bad.sum() > 0
    # add-one smoothing in proportion to the raw model, so n-grams the target never showed are judged mildly
    prior = (raw + 1) / (raw.sum() + BUCKETS)
    ratio = np.log((good + 50 * BUCKETS * prior / 10) / (good.sum() + 5 * BUCKETS)) - np.log(prior) if usable else np.zeros(BUCKETS)
    weigh = _weigher(ratio)
    noise = -F.log(-F.log((F.pmod(F.xxhash64(F.lit(11), "doc_id"), F.lit(1 << 40)) + 0.5) / float(1 << 40)))
    rows = keep(with_label.mapInPandas(weigh, "doc_id long, weight double, quality int"))
    if not usable:
        return rows.select("doc_id", "weight", F.lit(0.0).alias("log_odds"), noise.alias("key"), F.lit(True).alias("accepted"))
    # one row an id, so no more than MAX_LABELLED
    told = rows.where("quality >= 0").groupBy("doc_id").agg(F.avg("weight").alias("weight"), F.max("quality").alias("quality")).orderBy("doc_id").toPandas()
    b0, b1 = curve(told["weight"].to_numpy(), told["quality"].to_numpy().astype(float))
    rows = rows.withColumn("log_odds", F.lit(b0) + F.lit(b1) * F.col("weight")).withColumn("key", F.col("log_odds") + noise)
    k = round(rows.agg(F.sum(1 / (1 + F.exp(-F.col("log_odds"))))).first()[0] or 0)
    at = kth_key(rows, k) if k else float("inf")
    return rows.select("doc_id", "weight", "log_odds", "key", (F.col("key") >= at).alias("accepted"))


def accepted_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs that the classifier accepts, all columns as they are; rows that repeat share their fate."""
    id_ = unused(docs, "_id")
    gone = classify(docs, labels).where("NOT accepted").select(F.col("doc_id").alias(id_)).distinct()
    return docs.join(gone, F.col("doc_id").cast("long").eqNullSafe(F.col(id_)), "left_anti")
