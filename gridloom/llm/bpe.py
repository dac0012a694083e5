"""Byte-level BPE encoding and decoding over overlapping chunks.

A text longer than CHUNK code points is cut into chunks that overlap by OVERLAP. Each chunk is pre-tokenised by itself, in parallel, from wherever it
happens to start. Two neighbours resynchronise in what they share at the first boundary from which on AGREE boundaries are
the same for both: the earlier chunk's boundaries are those of the whole text there, and a scan that stands on one goes on like the whole
text's. The chunks are stitched at these places and the pieces between, each a run of whole pre-tokens, are encoded in parallel. From an overlap without
agreement on (a run of thousands of characters of one kind) nothing is known of later scans, so the rest of the text is one piece.
Decoding concatenates the raw bytes of the ids.

AGREE covers what the end of a chunk can do to the scan before it: a match must not depend on text more than AGREE - 1 matches ahead
(one, for the published patterns).

Null text counts as empty (no ids). Ill-formed text can't occur in a string column. A null id is kept as it is.
Rows that repeat are encoded each by itself. An empty table gives an empty result. Extra columns are not looked at.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import keep, small_batches

#: Code points of a chunk, and how many more it shares with the next one.
CHUNK, OVERLAP = 1 << 15, 1 << 11
#: Boundaries in a row that neighbours must have in common.
AGREE = 4
#: Bytes a vocabulary file may have: it is read once and sent to every worker.
MAX_VOCABULARY = 64 << 20
_encoders: dict[str, object] = {}


def load_ranks(spark, path: str) -> bytes:
    """The rank file's bytes, by Spark's readers where the path has a scheme, else from this machine."""
    if "://" in path:
        data = bytes(spark.read.format("binaryFile").load(path).select("content").first()[0])
    else:
        with open(path, "rb") as f:
            data = f.read(MAX_VOCABULARY + 1)
    if len(data) > MAX_VOCABULARY:
        raise ValueError(f"{path} has more than {MAX_VOCABULARY} bytes")
    return data


def encoder(data: bytes, pattern: str):
    """A tiktoken encoder of these ranks; kept while the Python worker lives."""
    import tiktoken

    key = hashlib.sha256(data + pattern.encode()).hexdigest()
    if key not in _encoders:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines()) if a}
        _encoders[key] = tiktoken.Encoding(key, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _encoders[key]


def boundaries(text: str, pattern: str) -> np.ndarray:
    """Where matches of the pattern begin or end, but for the end of the text: more of it might move that."""
    import regex

    at = np.fromiter((p for m in regex.finditer(pattern, text) for p in m.span()), np.int64)
    at = np.unique(at)
    return at[at < len(text)]


def agreement(before: np.ndarray, after: np.ndarray) -> int | None:
    """The first boundary of both scans of a stretch from which on AGREE boundaries are the same."""
    for p in np.intersect1d(before, after, assume_unique=True).tolist():
        x, y = before[before >= p][:AGREE], after[after >= p][:AGREE]
        if len(x) == AGREE and np.array_equal(x, y):
            return p
    return None


def _digests(ids: list[np.ndarray], decoded: list[bytes]) -> tuple[int, str, str]:
    a, b = hashlib.sha256(), hashlib.sha256()
    for x in ids:
        a.update(x.tobytes())
    for x in decoded:
        b.update(x)
    return sum(map(len, ids)), a.hexdigest(), b.hexdigest()


def encode(docs: DataFrame, path: str, pattern: str, with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 (and ids, little-endian unsigned 32 bits each, if asked for)."""
    spark = docs.sparkSession
    small_batches(spark)
    ranks = spark.sparkContext.broadcast(load_ranks(spark, path))
    out = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids binary" * with_ids

    def whole(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        e = encoder(ranks.value, pattern)
        for df in batches:
            rows = []
            for i, text in zip(df["doc_id"], df["text"], strict=True):
                x = np.array(e.encode_ordinary(text or ""), "<u4")
                rows.append((i, *_digests([x], [e.decode_bytes(x.tolist())]), *[x.tobytes()] * with_ids))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in out.split(", ")]).astype({"doc_id": "Int64"})

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in batches:
            for row, i, text in zip(df["row"], df["doc_id"], df["text"], strict=True):
                for k in range(-(-len(text) // CHUNK)):
                    yield pd.DataFrame({"row": [row], "doc_id": pd.array([i], "Int64"), "k": [k], "text": [text[k * CHUNK : (k + 1) * CHUNK + OVERLAP]]})

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """For each seam what the chunk before it and the chunk after it say of the stretch they share, in places of the whole text."""
        for df in batches:
            out = []
            for row, k, text in zip(df["row"], df["k"], df["text"], strict=True):
                at = boundaries(text, pattern)
                if k:
                    out.append((row, k, None, at[at < OVERLAP] + k * CHUNK))
                if len(text) > CHUNK:
                    out.append((row, k + 1, at[at >= CHUNK] + k * CHUNK, None))
            yield pd.DataFrame(out, columns=["row", "seam", "before", "after"])

    def stitch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in batches:
            at = [agreement(np.asarray(x), np.asarray(y)) if x is not None and y is not None else None for x, y in zip(df["before"], df["after"], strict=True)]
            yield df[["row", "seam"]].assign(at=pd.array(at, "Int64"))

    def lay_out(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Which part of each chunk belongs to which piece. A piece of one chunk reaches into the overlap, one of many is cut at the chunks' own ends."""
        for df in batches:
            out = []
            for row, seams in zip(df["row"], df["seams"], strict=True):
                cuts = [0, *(s["at"] for s in sorted(seams, key=lambda s: s["seam"]))]
                known = next((k for k, at in enumerate(cuts) if at is None), len(cuts))
                out += [(row, k, k, cuts[k] - k * CHUNK, cuts[k + 1] - k * CHUNK, True) for k in range(known - 1)]
                last = known - 1
                many = known < len(cuts)
                out += [(row, k, last, cuts[last] - k * CHUNK if k == last else 0, CHUNK if many and k + 1 < len(cuts) else None, not many) for k in range(last, len(cuts))]
            yield pd.DataFrame(out, columns=["row", "k", "piece", "a", "b", "alone"]).astype({"b": "Int64"})

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        e = encoder(ranks.value, pattern)
        for df in batches:
            ids = [np.array(e.encode_ordinary(t), "<u4").tobytes() for t in df["text"]]
            yield df[["row", "doc_id", "piece"]].assign(doc_id=df["doc_id"].astype("Int64"), ids=ids)

    def join(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        e = encoder(ranks.value, pattern)
        for df in batches:
            rows = []
            for i, parts in zip(df["doc_id"], df["parts"], strict=True):
                ids = [np.frombuffer(p["ids"], "<u4") for p in parts]
                rows.append((i, *_digests(ids, [e.decode_bytes(x.tolist()) for x in ids]), *[b"".join(x.tobytes() for x in ids)] * with_ids))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in out.split(", ")]).astype({"doc_id": "Int64"})

    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    long = F.coalesce(F.length("text") > CHUNK, F.lit(False))
    # the row number is written with the chunks, so repeated rows stay apart whatever is computed again
    chunks = docs.where(long).withColumn("row", F.monotonically_increasing_id()).mapInPandas(cut, "row long, doc_id long, k int, text string")
    chunks = keep(chunks.repartition("row", "k"))
    seams = chunks.mapInPandas(scan, "row long, seam int, before array<long>, after array<long>")
    seams = seams.groupBy("row", "seam").agg(F.max("before").alias("before"), F.max("after").alias("after")).mapInPandas(stitch, "row long, seam int, at long")
    layout = seams.groupBy("row").agg(F.collect_list(F.struct("seam", "at")).alias("seams")).mapInPandas(lay_out, "row long, k int, piece int, a long, b long, alone boolean")
    part = F.expr("substring(text, CAST(a AS int) + 1, CAST(coalesce(b, length(text)) - a AS int))")
    parts = keep(chunks.join(layout, ["row", "k"]).select("row", "doc_id", "k", "piece", "alone", part.alias("text")))
    whole_again = parts.where("NOT alone").groupBy("row", "doc_id", "piece").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "text"))), lambda x: x["text"]), "").alias("text"))
    done = parts.where("alone").select("row", "doc_id", "piece", "text").unionByName(whole_again).mapInPandas(pieces, "row long, doc_id long, piece int, ids binary")
    joined = done.groupBy("row", "doc_id").agg(F.array_sort(F.collect_list(F.struct("piece", "ids"))).alias("parts")).mapInPandas(join, out)
    return docs.where(~long).mapInPandas(whole, out).unionByName(joined)
