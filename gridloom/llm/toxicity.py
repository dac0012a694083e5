"""Toxicity by maximum-scoring segments.

Words (runs of letters, digits and bytes above 0x7F, lower-cased) score by the log-odds of toxic against other labelled text under
an informative Dirichlet prior, the word counts of the whole corpus. A linear scan finds all maximal scoring segments of
a document (Ruzzo and Tompa); a segment is significant by the extreme-value law of such scores (Karlin and Altschul:
E = K n exp(-lambda S), p = 1 - exp(-E)), lambda solving sum p(s) exp(lambda s) = 1 on text labelled other. A document's evidence is the
sum of -ln(p) over its segments, turned into a probability by a logistic fit. Labelled text counts a word once a document.

Labels are learnt only from rows with crc32(doc_id) mod 5 other than 0, at most MAX_LABELLED of each kind
(smallest id hashes); lang, source and ids never enter a score. The prior counts every word of every document.

Null and empty texts have no segments and get the score of no evidence. Null ids are held out (no remainder). Rows that repeat
get the same score. Without labels of both kinds all scores are 0. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import groups, keep, small_batches, word_hashes

BUCKETS = 1 << 16
MAX_LABELLED = 20_000
#: Weight of the prior, in words, besides one word each; log-odds are shrunk to 0 by their standard error this many times.
PRIOR, SHRINK = 5_000.0, 1.0
#: What each word costs, so that scores are negative on average.
DRIFT = 0.05

_BREAK = np.ones(256, bool)
_BREAK[128:] = False
for _lo, _hi in (("a", "z"), ("A", "Z"), ("0", "9")):
    _BREAK[ord(_lo) : ord(_hi) + 1] = False


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def _words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    h, _, _, first = word_hashes(texts, space=_BREAK)
    return (h >> np.uint64(48)).astype(np.int64), first


def _counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    every, toxic, other = (np.zeros(BUCKETS, np.int64) for _ in range(3))
    for df in batches:
        label = df["toxic"].to_numpy()
        for i, texts in groups(df["text"]):
            w, first = _words(texts)
            once = _once(w, first)
            every += np.bincount(w, minlength=BUCKETS)
            for side, of in ((toxic, label[i : i + len(texts)] == 1), (other, label[i : i + len(texts)] == 0)):
                if of.any():
                    side += np.bincount(w[np.repeat(of, np.diff(first)) & once], minlength=BUCKETS)
    some = np.flatnonzero(every)
    yield pd.DataFrame({"bucket": some, "n": every[some], "toxic": toxic[some], "other": other[some]})


def log_odds(every: np.ndarray, toxic: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Log-odds under the Dirichlet prior, its mass split as the two sides' words are, less SHRINK standard errors (towards 0)."""
    a = 1 + PRIOR * every / max(1.0, every.sum())
    share = toxic.sum() / (toxic.sum() + other.sum())
    t, o = toxic + a * share, other + a * (1 - share)
    d = np.log(t / (toxic.sum() + a.sum() * share - t)) - np.log(o / (other.sum() + a.sum() * (1 - share) - o))
    return np.sign(d) * np.maximum(0, np.abs(d) - SHRINK * np.sqrt(1 / t + 1 / o))


def extreme_value(score: np.ndarray, p: np.ndarray) -> tuple[float, float]:
    """lambda, and K by its usual lower estimate, of scores s with frequencies p (mean negative)."""
    if not (p[score > 0].sum() > 0):
        return 1.0, 0.1
    lo, hi = 1e-6, 1.0
    while (p * np.exp(np.minimum(700, hi * score))).sum() < 1:
        hi *= 2
    for _ in range(80):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if (p * np.exp(np.minimum(700, mid * score))).sum() < 1 else (lo, mid)
    return lo, max(1e-4, min(0.5, -(p * score).sum() * lo))


def segments(s: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score) of a sequence, left to right, in linear time.

    Only positive scores can begin a segment, so the scan steps from one to the next and takes what lies between by its sum.
    """
    total = np.concatenate([[0.0], np.cumsum(s)])
    stack: list[list[float]] = []  # start, end, sum before, sum through the end
    for i in np.flatnonzero(s > 0).tolist():
        cur = [i, i + 1, total[i], total[i + 1]]
        while stack:
            # the nearest candidate to the left with a smaller sum before it
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= cur[2]:
                j = stack[j][4]
            if j < 0 or stack[j][3] >= cur[3]:
                break
            cur = [stack[j][0], cur[1], stack[j][2], cur[3]]
            del stack[j:]
        j = len(stack) - 1
        while j >= 0 and stack[j][2] >= cur[2]:
            j = stack[j][4]
        stack.append([*cur, j])
    return [(int(a), int(b), float(y - x)) for a, b, x, y, _ in stack]


def evidence(s: np.ndarray, lam: float, k: float) -> float:
    """Sum over segments of -ln(p), p their chance among n words of other text, while p < 0.5."""
    base = math.log(k * max(1, len(s)))
    found = [lam * x - base for _, _, x in segments(s)] if len(s) else []
    return sum(-math.log(-math.expm1(-math.exp(-x))) if x < 30 else x for x in found if x > -0.3)


def passages(s: np.ndarray, lam: float, k: float) -> list[tuple[int, int]]:
    """The significant segments: those of which fewer than one is expected in as much other text."""
    base = math.log(k * max(1, len(s)))
    return [(a, b) for a, b, x in segments(s) if lam * x > base] if len(s) else []


def _once(w: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Which words are the first of their kind in their text: repeating a word adds no evidence."""
    key = np.repeat(np.arange(len(first) - 1) << 16, np.diff(first)) | w
    out = np.zeros(len(w), bool)
    out[np.unique(key, return_index=True)[1]] = True
    return out


def _scorer(score: np.ndarray, lam: float, k: float):
    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in batches:
            x, found = np.zeros(len(df)), [[]] * len(df)
            for i, texts in groups(df["text"]):
                w, first = _words(texts)
                s = np.where(_once(w, first), score[w], np.minimum(0, score[w]))
                for j in range(len(texts)):
                    x[i + j] = evidence(s[first[j] : first[j + 1]], lam, k)
                    found[i + j] = passages(score[w[first[j] : first[j + 1]]], lam, k)
            yield pd.DataFrame({"doc_id": df["doc_id"].astype("Int64"), "toxic": df["toxic"], "evidence": x, "passages": [len(f) for f in found], "spans": [",".join(f"{a}:{b}" for a, b in f) for f in found]})

    return scored


def logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Intercept and slope, by Newton steps with a slight ridge."""
    a = np.stack([np.ones_like(x), x], 1)
    b = np.zeros(2)
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(a @ b, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + 1e-3 * np.eye(2), a.T @ (y - p) - 1e-3 * b)
        b = b + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return float(b[0]), float(b[1])


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, passages, spans; a row for each row of docs. labels: (doc_id, toxic 0 or 1).

    spans: the significant passages as start:end, counted in words, end exclusive. They are found in the text as it stands, repetitions included; for the
    score a word counts for toxic at its first occurrence only."""
    small_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    train = labels.where("doc_id IS NOT NULL AND toxic IN (0, 1)").where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    pick = lambda t: train.where(F.col("toxic") == t).orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_LABELLED)
    train = keep(pick(1).unionByName(pick(0)))  # bounded, so it may be broadcast
    rows = docs.join(F.broadcast(train), "doc_id", "left").select("doc_id", "text", F.coalesce("toxic", F.lit(-1)).alias("toxic"))
    every, toxic, other = (np.zeros(BUCKETS) for _ in range(3))
    for b, n, t, o in rows.mapInPandas(_counted, "bucket int, n long, toxic long, other long").groupBy("bucket").agg(F.sum("n"), F.sum("toxic"), F.sum("other")).collect():
        every[b], toxic[b], other[b] = n, t, o  # at most BUCKETS rows
    out = "doc_id long, toxic int, evidence double, passages long, spans string"
    if toxic.sum() == 0 or other.sum() == 0:
        return docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.lit(0.0).alias("score"), F.lit(0).alias("predicted"), F.lit(0).cast("long").alias("passages"), F.lit("").alias("spans"))
    score = log_odds(every, toxic, other)
    p = other / other.sum()
    score = score - DRIFT - max(0.0, (p * score).sum())
    lam, k = extreme_value(score, p)
    scored = _scorer(score, lam, k)
    # an id may stand for several rows: the mean of them, so no more than 2 * MAX_LABELLED
    told = rows.where("toxic >= 0").mapInPandas(scored, out).groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.avg("evidence").alias("evidence")).toPandas()
    b0, b1 = logistic(np.log1p(told["evidence"].to_numpy()), told["toxic"].to_numpy().astype(float))
    final = rows.withColumn("toxic", F.lit(-1)).mapInPandas(scored, out)
    prob = 1 / (1 + F.exp(-(F.lit(b0) + F.lit(b1) * F.log1p("evidence"))))
    return final.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), prob.alias("score"), "passages", "spans").select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "passages", "spans")
