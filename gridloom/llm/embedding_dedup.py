"""Embedding near-dedup by a subspace pigeonhole join.

Unit vectors with cosine >= t are at squared distance 2 - 2 t at most. After a fixed random rotation they are split into BLOCKS
runs of coordinates; a block's budget is its share of that distance, so every linked pair is within the budget of one block at least.

Each block is range-joined under its budget, by its own coordinates alone (single precision, with slack). Its axis is the direction of greatest
spread in the block; vectors lie in slabs along it, SLAB radii wide, and those less than a radius below the upper border visit the next
slab too. A slab of any size is split into chunks of CHUNK vectors and pairs of chunks are compared in axis order, so only
stretches within a radius of one another meet, by matrix products. What comes out is no list of pairs but the vectors that have a candidate, each
with the group that candidates chain it to; groups are bundled to BUNDLE vectors or more.

Then the vectors themselves are fetched, once for each bundle they are in, and the candidates verified by cosine in double precision. A pair that
several blocks find counts for the first of them, so the union needs no shuffle of pairs: a bundle puts out one row for each vector with its
number of links and one link towards the least vector it is connected with.

Equal vectors are one class with a multiplicity. Vectors that are null, empty, zero or hold null or non-finite components link with nothing,
and vectors of different length do not link. Null ids: no links, no component. Rows that repeat an id are different vectors of one name and count
as such. An empty table gives an empty result; extra columns are not looked at. Isotropic vectors all lie within a few radii of one another on any
axis: the work is then near half of all pairs (in matrix products), with nothing held but two chunks. The axes are fitted on SAMPLE vectors;
they bear on speed alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import keep, small_batches
from gridloom.llm.components import components

BLOCKS, SEED = 4, 64
#: Vectors of a chunk of a slab, slab width in radii, least vectors of a bundle, vectors the axes are fitted on.
CHUNK, SLAB, BUNDLE, SAMPLE = 65_536, 4, 2_048, 4_096
#: Entries of a matrix product held at a time.
ENTRIES = 8_000_000
#: Rows of slab figures that are broadcast; beyond it they are shuffled.
BROADCAST_SLABS = 100_000
_rotations: dict[int, np.ndarray] = {}


def rotation(d: int) -> np.ndarray:
    if d not in _rotations:
        q, r = np.linalg.qr(np.random.default_rng(SEED).standard_normal((d, d)))
        _rotations[d] = q * np.sign(np.diag(r))
    return _rotations[d]


def blocks(d: int) -> list[slice]:
    cut = np.linspace(0, d, min(BLOCKS, d) + 1).astype(int)
    return [slice(a, b) for a, b in zip(cut[:-1], cut[1:], strict=True)]


def _rotated(x: np.ndarray) -> np.ndarray:
    # the root of the mean square first, so that neither tiny nor huge components over- or underflow
    x = x / np.abs(x).max(1, keepdims=True)
    return (x / np.sqrt((x * x).sum(1, keepdims=True))) @ rotation(x.shape[1])


def axes(sample: np.ndarray) -> list[np.ndarray]:
    """For each block the direction of greatest spread of rotated vectors."""
    return [np.linalg.eigh(np.cov(sample[:, p].T).reshape(p.stop - p.start, -1))[1][:, -1] if len(sample) > 1 else np.eye(p.stop - p.start)[0] for p in blocks(sample.shape[1])]


def _stacked(vectors: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, float) for v in vectors])


def _budget(t: float, d: int, p: slice) -> float:
    return (2 - 2 * t) * (p.stop - p.start) / d * (1 + 1e-9)


def _slabs(t: float, axis: dict[int, list[np.ndarray]]):
    def placed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in batches:
            size = df["vector"].map(len)
            for d, rows in df.groupby(size):
                r, cid = _rotated(_stacked(rows["vector"])), rows["cid"].to_numpy()
                for b, part in enumerate(blocks(d)):
                    z = np.ascontiguousarray(r[:, part], np.float32)
                    radius = np.sqrt(_budget(t, d, part)) * (1 + 1e-5) + 1e-5
                    at = (r[:, part] @ _axis(axis, d, b)) / (radius * SLAB) + 0.5
                    slab = np.floor(at).astype(int)
                    packed = np.array([x.tobytes() for x in z], object)
                    yield pd.DataFrame({"dim": d, "block": b, "slab": slab, "home": True, "cid": cid, "z": packed})
                    up = at + 1 / SLAB >= slab + 1
                    if up.any():
                        yield pd.DataFrame({"dim": d, "block": b, "slab": slab[up] + 1, "home": False, "cid": cid[up], "z": packed[up]})

    return placed


def _axis(axis: dict[int, list[np.ndarray]], d: int, b: int) -> np.ndarray:
    part = blocks(d)[b]
    return axis[d][b] if d in axis else np.eye(part.stop - part.start)[0]


def _joined(root: np.ndarray, u: np.ndarray, v: np.ndarray) -> None:
    """Joins the groups of all u with those of v in place; root holds for each the least of its group."""
    while len(u):
        a, b = root[u], root[v]
        open_ = a != b
        u, v, a, b = u[open_], v[open_], a[open_], b[open_]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = root[root]
            if np.array_equal(up, root):
                break
            root[:] = up


def _sides(home: np.ndarray, here: np.ndarray, bi: int, bj: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows to compare: all with all after them where a chunk meets itself, else the chunks' own with each other."""
    both = np.arange(len(home))
    return (both, both) if bi == bj else (np.flatnonzero(here == bi), np.flatnonzero(here == bj))


def _near(t: float, axis: dict[int, list[np.ndarray]]):
    def compared(df: pd.DataFrame) -> pd.DataFrame:
        d, b, bi, bj = (int(df[c].iat[0]) for c in ("dim", "block", "bi", "bj"))
        part = blocks(d)[b]
        limit = _budget(t, d, part)
        z = np.frombuffer(b"".join(df["z"]), np.float32).reshape(len(df), -1)
        s = z.astype(float) @ _axis(axis, d, b)
        order = np.argsort(s, kind="stable")
        df, z, s = df.iloc[order], z[order], s[order]
        home, here = df["home"].to_numpy(), df["here"].to_numpy()
        left, right = _sides(home, here, bi, bj)
        # one product gives squared distances: |x|^2 + |y|^2 - 2 xy
        q, ones = (z * z).sum(1, keepdims=True), np.ones((len(z), 1), np.float32)
        p, w = np.hstack([z, q, ones])[left], np.ascontiguousarray(np.hstack([-2 * z, ones, q])[right].T)
        radius, root, some = np.sqrt(limit) + 1e-4, np.arange(len(z)), np.zeros(len(z), bool)
        step = max(16, min(256, ENTRIES // max(1, len(right))))
        for at in range(0, len(left), step):
            i_ = left[at : at + step]
            lo = at if bi == bj else int(np.searchsorted(s[right], s[i_[0]] - radius))
            hi = int(np.searchsorted(s[right], s[i_[-1]] + radius, "right"))
            if lo >= hi:
                continue
            a, c = np.divmod(np.flatnonzero(p[at : at + step] @ w[:, lo:hi] <= limit + 1e-5), hi - lo)
            i, j = i_[a], right[c + lo]
            ok = home[i] | home[j]
            if bi == bj:
                ok &= i < j
            i, j = i[ok], j[ok]
            some[i] = some[j] = True
            _joined(root, i, j)
        at = np.flatnonzero(some)
        at = at[np.argsort(root[at], kind="stable")]
        # whole groups, one after another, until a bundle is full
        sizes = np.unique(root[at], return_counts=True)[1]
        bundle = np.repeat((np.cumsum(sizes) - sizes) // BUNDLE, sizes)
        return pd.DataFrame({"dim": d, "block": b, "slab": df["slab"].iat[0] if len(df) else 0, "bi": bi, "bj": bj, "bundle": bundle, "cid": df["cid"].to_numpy()[at], "home": home[at], "here": here[at]})

    return compared


def _verified(t: float):
    def compared(df: pd.DataFrame) -> pd.DataFrame:
        d, b, bi, bj = (int(df[c].iat[0]) for c in ("dim", "block", "bi", "bj"))
        parts = blocks(d)
        df = df.sort_values("cid", kind="stable")
        x = _stacked(df["vector"])
        r = _rotated(x)
        scaled = x / np.abs(x).max(1, keepdims=True)
        norm = np.sqrt((scaled * scaled).sum(1))
        unit = scaled / norm[:, None]
        home, here, mult, cid = (df[c].to_numpy() for c in ("home", "here", "mult", "cid"))
        left, right = _sides(home, here, bi, bj)
        n, root = np.zeros(len(df), np.int64), np.arange(len(df))
        step = max(16, min(256, ENTRIES // max(1, len(right))))
        for at in range(0, len(left), step):
            i_ = left[at : at + step]
            a, c = np.divmod(np.flatnonzero(unit[i_] @ unit[right].T >= t - 1e-9), len(right))
            for k in range(0, len(a), 1 << 18):
                u, v = i_[a[k : k + (1 << 18)]], right[c[k : k + (1 << 18)]]
                ok = (home[u] | home[v]) & (cid[u] != cid[v])
                if bi == bj:
                    ok &= u < v
                u, v = u[ok], v[ok]
                # the first block within whose budget the pair is counts it
                mine = np.ones(len(u), bool)
                for q, p in enumerate(parts[: b + 1]):
                    gap = ((r[u, p] - r[v, p]) ** 2).sum(1) <= _budget(t, d, p)
                    mine &= gap if q == b else ~gap
                u, v = u[mine], v[mine]
                hit = np.einsum("ij,ij->i", scaled[u], scaled[v]) / (norm[u] * norm[v]) >= t
                u, v = u[hit], v[hit]
                n += np.bincount(u, mult[v], len(n)).astype(np.int64) + np.bincount(v, mult[u], len(n)).astype(np.int64)
                _joined(root, u, v)
        some = np.flatnonzero(n)
        return pd.DataFrame({"a": cid[some], "b": cid[root[some]], "n": n[some]})

    return compared


def vector_groups(table: DataFrame, t: float = 0.8, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, n_links, component_id, kept; a row for each row of table."""
    small_batches(table.sparkSession)
    v = F.col(vector_col).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists(v, lambda x: x != 0)
    # single precision stays as it is: half the bytes, and no digit lost
    short = dict(table.dtypes)[vector_col] == "array<float>"
    rows = table.select(F.col(id_col).cast("long").alias("vec_id"), F.when(F.coalesce(fine, F.lit(False)), F.col(vector_col) if short else v).alias("vector"))
    rows = rows.withColumn("k1", F.xxhash64("vector")).withColumn("k2", F.xxhash64(F.lit(5), "vector"))
    classes = keep(rows.where("vector IS NOT NULL AND vec_id IS NOT NULL").groupBy("k1", "k2").agg(F.min("vec_id").alias("cid"), F.count(F.lit(1)).alias("mult"), F.first("vector").alias("vector")))
    sample: dict[int, list] = {}
    for r in classes.select("vector").limit(SAMPLE).collect():
        sample.setdefault(len(r.vector), []).append(r.vector)
    axis = {d: axes(_rotated(np.asarray(x, float))) for d, x in sample.items()}
    place, tile = ["dim", "block", "slab"], ["dim", "block", "slab", "bi", "bj"]
    placed = keep(classes.select("cid", "vector").mapInPandas(_slabs(t, axis), "dim int, block int, slab int, home boolean, cid long, z binary"))
    sizes = keep(placed.groupBy(*place).agg(F.ceil(F.count(F.lit(1)) / CHUNK).cast("int").alias("parts")))
    tiles = placed.join(F.broadcast(sizes) if sizes.count() <= BROADCAST_SLABS else sizes, place).withColumn("here", F.pmod(F.xxhash64("cid"), F.col("parts")).cast("int"))
    tiles = tiles.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).withColumn("bi", F.least("here", "with")).withColumn("bj", F.greatest("here", "with"))
    near = keep(tiles.select(*tile, "home", "here", "cid", "z").groupBy(*tile).applyInPandas(_near(t, axis), "dim int, block int, slab int, bi int, bj int, bundle int, cid long, home boolean, here int"))
    found = near.join(classes.select("cid", "mult", "vector"), "cid").groupBy(*tile, "bundle").applyInPandas(_verified(t), "a long, b long, n long")
    found = keep(found)
    label = components(found.where("a <> b").select("a", "b"))
    links = found.groupBy("a").agg(F.sum("n").alias("n"))
    known = classes.select("k1", "k2", "cid", "mult").join(links, F.col("cid") == F.col("a"), "left").join(label, F.col("cid") == F.col("node"), "left")
    known = known.select("k1", "k2", (F.coalesce("n", F.lit(0)) + F.col("mult") - 1).alias("n_links"), F.coalesce("component", "cid").alias("component_id"))
    alone = F.col("vector").isNull() | F.col("vec_id").isNull()
    out = rows.where(~alone).select("vec_id", "k1", "k2").join(known, ["k1", "k2"]).select("vec_id", "n_links", "component_id")
    out = out.unionByName(rows.where(alone).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")))
    return out.withColumn("kept", F.col("vec_id") == F.col("component_id"))


#: All pairs: for small tables only, as an oracle.
PAIRS_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0 AND len(list_filter(embedding, lambda e: e <> 0)) > 0),
e AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x) AND list_cosine_similarity(a.x, b.x) >= 0.9),
r(a, b) AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a), c AS (SELECT a, least(a, min(b)) AS component_id FROM r GROUP BY a), n AS (SELECT a, count(*) AS n_links FROM e GROUP BY a)
SELECT vec_id, coalesce(n_links, 0)::BIGINT AS n_links, coalesce(component_id, vec_id) AS component_id, coalesce(component_id, vec_id) = vec_id AS kept FROM embeddings LEFT JOIN c ON c.a = vec_id LEFT JOIN n ON n.a = vec_id
"""
