"""Relational databases: catalogs, whole dumps in ranges of keys, and a count of what was read against what is there."""

from __future__ import annotations

import sqlite3
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.session import ship

#: Rows in one range of a SQLite table, and in one batch.
RANGE, BATCH = 500_000, 5_000
_TYPES = {"INTEGER": "long", "INT": "long", "BIGINT": "long", "REAL": "double", "DOUBLE": "double", "FLOAT": "double", "BLOB": "binary"}


def _open(path: str) -> sqlite3.Connection:
    """Read-only: a missing file is an error, never a new database."""
    return sqlite3.connect(f"file:{path}?mode=ro", uri=True)


def _quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def sqlite_catalog(spark: SparkSession, path: str) -> DataFrame:
    """table, column, type, position, key: the tables of a SQLite file and their columns (metadata, so small)."""
    con = _open(path)
    try:
        rows = [(t, c[1], c[2], c[0], c[5] > 0) for (t,) in con.execute("SELECT name FROM sqlite_master WHERE type = 'table' AND name NOT LIKE 'sqlite_%' ORDER BY name") for c in con.execute(f"PRAGMA table_info({_quoted(t)})")]
    finally:
        con.close()
    return spark.createDataFrame(rows, "table string, column string, type string, position int, key boolean")


def read_sqlite(spark: SparkSession, path: str, table: str) -> DataFrame:
    """A table of a SQLite file that all executors can open, one range of row ids a task and read in batches. Values keep the declared type; texts in
    columns of numbers become NULL. Tables without row ids are read by one task."""
    con = _open(path)
    try:
        info = con.execute(f"PRAGMA table_info({_quoted(table)})").fetchall()
        if not info:
            raise ValueError(f"no table {table}")
        try:
            lo, hi = con.execute(f"SELECT min(rowid), max(rowid) FROM {_quoted(table)}").fetchone()
            ranges = [] if lo is None else [(a, min(a + RANGE - 1, hi)) for a in range(lo, hi + 1, RANGE)]
        except sqlite3.OperationalError:
            ranges = [(None, None)]
    finally:
        con.close()
    names = [c[1] for c in info]
    types = [_TYPES.get(c[2].split("(")[0].strip().upper(), "string") for c in info]
    schema = ", ".join(f"`{n.replace('`', '``')}` {t}" for n, t in zip(names, types, strict=True))
    sql = f"SELECT {', '.join(map(_quoted, names))} FROM {_quoted(table)}"
    takes = {"long": lambda v: v if isinstance(v, int) else None, "double": lambda v: float(v) if isinstance(v, (int, float)) else None, "binary": lambda v: v.encode() if isinstance(v, str) else v if isinstance(v, bytes) else None, "string": lambda v: None if v is None else v.decode("utf-8", "replace") if isinstance(v, bytes) else str(v)}

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in batches:
            for lo, hi in zip(df["lo"], df["hi"], strict=True):
                con = _open(path)
                try:
                    cur = con.execute(sql) if pd.isna(lo) else con.execute(f"{sql} WHERE rowid BETWEEN ? AND ?", (int(lo), int(hi)))
                    while rows := cur.fetchmany(BATCH):
                        yield pd.DataFrame({n: pd.Series([takes[t](r[i]) for r in rows], dtype=object) for i, (n, t) in enumerate(zip(names, types, strict=True))})
                finally:
                    con.close()

    ship(spark)
    parts = spark.createDataFrame(ranges, "lo long, hi long").repartition(max(len(ranges), 1))
    return parts.mapInPandas(scan, schema)


def read_jdbc(spark: SparkSession, url: str, table: str, key: str | None = None, parts: int = 8, **options: str) -> DataFrame:
    """A table over JDBC, in ranges of a whole-number key between its bounds; without a key by one task."""
    plain = spark.read.format("jdbc").options(url=url, fetchsize=str(BATCH), **options)
    if key is None:
        return plain.option("dbtable", table).load()
    lo, hi = plain.option("query", f"SELECT min({key}) AS lo, max({key}) AS hi FROM {table}").load().first()
    plain = spark.read.format("jdbc").options(url=url, fetchsize=str(BATCH), **options).option("dbtable", table)
    if lo is None:
        return plain.load()
    return plain.options(partitionColumn=key, lowerBound=str(lo), upperBound=str(hi), numPartitions=str(parts)).load()


def audit_counts(read: dict[str, DataFrame], expected: DataFrame) -> DataFrame:
    """table, expected, exported, status (ok, mismatch, missing, unlisted) of tables read against a catalog (table, expected)."""
    got = None
    for name, df in read.items():
        one = df.agg(F.count(F.lit(1)).alias("exported")).select(F.lit(name).alias("table"), "exported")
        got = one if got is None else got.unionByName(one)
    if got is None:
        got = expected.sparkSession.createDataFrame([], "table string, exported long")
    status = F.when(F.col("exported").isNull(), "missing").when(F.col("expected").isNull(), "unlisted").when(F.col("expected") == F.col("exported"), "ok").otherwise("mismatch")
    return expected.join(got, "table", "full").select("table", "expected", "exported", status.alias("status"))


def insert_script(df: DataFrame, table: str) -> DataFrame:
    """sql: one INSERT a row; texts are quoted, nulls are NULL."""
    quoted = lambda c: F.concat(F.lit("'"), F.replace(F.col(f"`{c}`").cast("string"), F.lit("'"), F.lit("''")), F.lit("'"))
    plain = ("int", "bigint", "smallint", "tinyint", "double", "float")
    lit = lambda c, t: F.coalesce(F.col(f"`{c}`").cast("string") if t in plain or t.startswith("decimal") else F.when(F.col(f"`{c}`"), "1").otherwise("0") if t == "boolean" else quoted(c), F.lit("NULL"))
    values = F.concat_ws(", ", *(lit(c, t) for c, t in df.dtypes))
    return df.select(F.concat(F.lit(f"INSERT INTO {table} ({', '.join(df.columns)}) VALUES ("), values, F.lit(");")).alias("sql"))


def fill_script(df: DataFrame, table: str, key: str, column: str) -> DataFrame:
    """sql: one UPDATE a row that fills the column only where it is NULL; texts are quoted, rows without key or value give none."""
    typed = dict(df.dtypes)
    lit = lambda c: F.concat(F.lit("'"), F.replace(F.col(f"`{c}`").cast("string"), F.lit("'"), F.lit("''")), F.lit("'")) if typed[c] == "string" else F.col(f"`{c}`").cast("string")
    text = F.concat(F.lit(f"UPDATE {table} SET {column} = "), lit(column), F.lit(f" WHERE {key} = "), lit(key), F.lit(f" AND {column} IS NULL;"))
    return df.select(text.alias("sql")).where("sql IS NOT NULL")
