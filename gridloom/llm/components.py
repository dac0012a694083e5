"""Connected components by alternating large and small stars.

Every step is a minimum by key and a join, so a node with any number of links costs no task more than its share
(minima are combined before the shuffle, skewed joins are split by adaptive execution), and nothing is collected.

After each step every task joins up the edges it holds, EDGES at a time, into stars about the smallest nodes they reach. That changes no
component, and where one run held all edges they are found: few edges need one table and no join, more need fewer steps.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import keep, release
from gridloom.session import ship

#: Edges that a task joins up at a time.
EDGES = 1 << 18


def smallest(hi: np.ndarray, lo: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of the edges that aren't the smallest they reach, ascending, and those that are, beside them."""
    nodes, at = np.unique(np.concatenate([hi, lo]), return_inverse=True)
    u, v = at[: len(hi)], at[len(hi) :]
    root = np.arange(len(nodes))
    while True:
        a, b = root[u], root[v]
        if (a == b).all():
            break
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while ((up := root[root]) != root).any():
            root = up
    some = root != np.arange(len(nodes))
    return nodes[some], nodes[root[some]]


def _joined_up(most: int):
    """Edges (hi, lo) as stars, `most` edges or a batch more at a time; part: which run of edges they come from."""

    def stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, size = TaskContext.get().partitionId() << 32, [], 0

        def star() -> pa.RecordBatch:
            hi, lo = smallest(*(np.concatenate([b.column(c).to_numpy(zero_copy_only=False) for b in held]) for c in ("hi", "lo")))
            return pa.RecordBatch.from_arrays([pa.array(hi), pa.array(lo), pa.array(np.full(len(hi), part))], names=["hi", "lo", "part"])

        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= most:
                yield star()
                part, held, size = part + 1, [], 0
        if size:
            yield star()

    return stars


def components(edges: DataFrame) -> DataFrame:
    """edges (a, b), longs -> (node, component), component being the smallest node reachable; a row for each node of an edge."""
    ship(edges.sparkSession)
    edges = edges.where("a <> b")
    e, old, seen = edges.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct(), None, None
    while True:
        e = keep(e.mapInArrow(_joined_up(EDGES), "hi long, lo long, part long"))
        if old is not None:
            release(old)
        *now, first, last = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("hi", "lo").cast("decimal(30,0)")), F.min("part"), F.max("part")).first()
        if now == seen or first == last:
            break
        old, seen = e, now
        both = e.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(e.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(least, "hi")
        e = small.where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo")).unionByName(small.select("hi", F.col("m").alias("lo"))).distinct()
    return e.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionByName(e.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct())
