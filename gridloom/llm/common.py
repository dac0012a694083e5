"""What the operators share: reading, scratch tables, and hashing of words over whole Arrow batches.

Words are runs of bytes other than space and 0x09-0x0D; in UTF-8 no other character holds those bytes, so
bytes may be scanned without decoding. A word's hash is a polynomial over a random 64-bit value per byte,
read off a running sum, so no word costs a Python step.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from gridloom.session import safe_unions, ship

#: Bytes of text hashed at a time; a longer text is taken alone.
CHUNK = 1 << 20
#: Rows in an Arrow batch; texts may be long, so fewer than Spark's 10,000.
BATCH_ROWS = 400


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return safe_unions(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of few rows from here on: what a Python worker holds is bounded by BATCH_ROWS texts."""
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


#: Kept tables that are still there, with the Hadoop settings that open them.
_kept: dict[str, object] = {}


def scratch_dir(spark: SparkSession) -> str:
    """A new path in the shared folder the cluster names. Only where driver and executors are one process (local mode, as in tests) may there be none."""
    top = spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        top = tempfile.mkdtemp(prefix="gridloom-")
        spark.conf.set("spark.checkpoint.dir", top)
    return f"{top.rstrip('/')}/gridloom-{uuid.uuid4().hex}"


def keep(df: DataFrame) -> DataFrame:
    """df as a Parquet table in the shared folder: lineage ends there and every executor can read it. It lasts until release() or the program's end,
    as results read it when they are asked for."""
    path = scratch_dir(df.sparkSession)
    _kept[path] = df.sparkSession.sparkContext._jsc.hadoopConfiguration()
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._kept_at = path
    return out


def settled(make) -> DataFrame:
    """keep() of what make() returns; the tables that were kept on the way to it are removed, as nothing reads them any more."""
    before = set(_kept)
    out = keep(make())
    for path in set(_kept) - before - {out._kept_at}:
        _remove(path, _kept.pop(path))
    return out


def release(df: DataFrame) -> None:
    """Removes a kept table that nothing reads any more."""
    _remove(df._kept_at, _kept.pop(df._kept_at, None))


def _remove(path: str, conf: object) -> None:
    from pyspark import SparkContext

    if conf is not None:
        to = SparkContext._jvm.org.apache.hadoop.fs.Path(path)
        to.getFileSystem(conf).delete(to, True)


@atexit.register
def _remove_all() -> None:
    from py4j.protocol import Py4JError
    from pyspark import SparkContext

    if SparkContext._gateway is not None:
        try:
            for path, conf in list(_kept.items()):
                _remove(path, conf)
        except (Py4JError, OSError):
            pass  # the JVM has gone before: the tables stay where they are


def unused(df: DataFrame, name: str) -> str:
    """name, made longer until df has no such column."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name += "_"
    return name


def splitmix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = splitmix(np.arange(256, dtype=np.uint64) + np.uint64(1 << 40))
_LOWER = np.arange(256)
_LOWER[65:91] += 32
_BYTE_LOWER = _BYTE[_LOWER]
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_P = np.uint64(0x9FB21C651E98DF25)
_P_INV = np.uint64(pow(0x9FB21C651E98DF25, -1, 1 << 64))
_pow = np.ones(1, np.uint64)
_inv = np.ones(1, np.uint64)


def _powers(n: int) -> None:
    global _pow, _inv
    if len(_pow) < n:
        for name, base in (("_pow", _P), ("_inv", _P_INV)):
            x = np.full(max(n, CHUNK + 4096), base, np.uint64)
            x[0] = 1
            globals()[name] = np.multiply.accumulate(x)


def word_hashes(texts: list[bytes], lower: bool = True, space: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of the words of all texts in order: 64-bit hash, first byte and end in their text; then each text's first word, and the end.
    space: which bytes stand between words, the newline among them."""
    buf = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    size = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    at = np.concatenate([[0], np.cumsum(size)])
    word = ~space[buf]
    edge = np.flatnonzero(word[1:] != word[:-1]) + 1
    if len(word) and word[0]:
        edge = np.concatenate([[0], edge])
    start, end = edge[::2], edge[1::2]
    _powers(len(buf) + 1)
    total = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum((_BYTE_LOWER if lower else _BYTE)[buf] * _pow[: len(buf)], out=total[1:])
    h = splitmix((total[end] - total[start]) * _inv[start] + (end - start).astype(np.uint64))
    first = np.searchsorted(start, at)
    base = np.repeat(at[:-1], np.diff(first))
    return h, start - base, end - base, first


def groups(texts: Iterable[str | bytes | None]) -> Iterator[tuple[int, list[bytes]]]:
    """The texts as UTF-8 in runs of about CHUNK bytes, each with the index of its first."""
    run: list[bytes] = []
    size = first = 0
    for i, t in enumerate(texts):
        b = b"" if t is None or t != t else t if isinstance(t, bytes) else t.encode("utf-8", "surrogatepass")
        if run and size + len(b) > CHUNK:
            yield first, run
            run, size, first = [], 0, i
        run.append(b)
        size += len(b) + 1
    if run:
        yield first, run


def runs(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each k words that follow one another (k - 1 fewer than words)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out = splitmix(out * np.uint64(0xD6E8FEB86659FD93) + h[j : j + n])
    return out


def shingle_set(h: np.ndarray, k: int) -> np.ndarray:
    """Distinct hashes of k words, ascending; of fewer words the whole sequence as one; of none nothing."""
    if len(h) == 0:
        return np.zeros(0, np.uint64)
    return np.unique(runs(h, k)) if len(h) >= k else runs(h, len(h)) ^ np.uint64(len(h))


def sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of the values between each two of the positions in first."""
    total = np.concatenate([[0.0], np.cumsum(values)])
    return total[first[1:]] - total[first[:-1]]
