"""Files in and out: workbooks as cells, folders as listings, CSV and JSON as the workbench writes them."""

from __future__ import annotations

import hashlib
import io
import re
import uuid
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions.text import any_of, csv_row
from gridloom.operators.entities import numbered
from gridloom.session import kept, ship

_NS = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"


def _column(ref: str) -> int:
    n = 0
    for ch in re.match("[A-Z]+", ref).group():
        n = n * 26 + ord(ch) - 64
    return n


def workbook_cells(content: bytes) -> Iterator[tuple[str, int, int, str | None, str | None]]:
    """(sheet, row, column, value, formula), counted from 1. Only an f element makes a formula."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        names = set(z.namelist())
        shared = []
        if "xl/sharedStrings.xml" in names:
            shared = ["".join(t.text or "" for t in si.iter(f"{_NS}t")) for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).iter(f"{_NS}si")]
        targets = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        for s in ElementTree.fromstring(z.read("xl/workbook.xml")).iter(f"{_NS}sheet"):
            target = targets[s.get(_REL)].lstrip("/")
            for c in ElementTree.fromstring(z.read(target if target.startswith("xl/") else f"xl/{target}")).iter(f"{_NS}c"):
                ref, kind, v, f = c.get("r"), c.get("t"), c.find(f"{_NS}v"), c.find(f"{_NS}f")
                text = "".join(t.text or "" for t in c.iter(f"{_NS}t")) if kind == "inlineStr" else None if v is None else shared[int(v.text)] if kind == "s" else v.text
                yield s.get("name"), int(re.search(r"\d+", ref).group()), _column(ref), text, None if f is None else f.text


def read_workbooks(spark: SparkSession, path: str) -> DataFrame:
    """path, sheet, r, c, value, formula of every workbook under path; one task a file or more."""

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in batches:
            for p, content in zip(df["path"], df["content"], strict=True):
                yield pd.DataFrame([(p, *c) for c in workbook_cells(content)], columns=["path", "sheet", "r", "c", "value", "formula"])

    ship(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.xlsx").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "content").mapInPandas(parse, "path string, sheet string, r int, c int, value string, formula string")


def walk(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """path, size, mtime of the files under a folder; contents are not read."""
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path).select("path", F.col("length").alias("size"), F.col("modificationTime").alias("mtime"))


def read_csv(spark: SparkSession, path: str, fallback: str = "iso-8859-1", **options: str) -> DataFrame:
    """CSV files with a header, all columns text: UTF-8 with or without a byte order mark where every file is valid UTF-8, else the fallback. Fields that were
    written as ="..." come back without it; empty ones are NULL."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").option("recursiveFileLookup", "true").load(path)
    utf8 = files.agg(F.bool_and(F.is_valid_utf8("content"))).first()[0]
    how = {"header": "true", "multiLine": "true", "escape": '"', "lineSep": "\n", "pathGlobFilter": "*.csv", "recursiveFileLookup": "true", "encoding": "UTF-8" if utf8 else fallback}
    df = spark.read.options(**{**how, **options}).csv(path)
    return df.select(*(F.nullif(F.regexp_replace(F.regexp_replace(F.col(f"`{c}`"), "\r$", ""), r'^="(.*)"$', "$1"), F.lit("")).alias(c.strip("\ufeff\r")) for c in df.columns))


def write_csv(df: DataFrame, path: str, mark: bool = True) -> None:
    """Fields guarded against formulas and quoted where needed, joined here, so no writer's quoting is applied twice. Every part file begins with a byte
    order mark (if asked for) and the header, as readers take the first line of each file for it."""
    csv = lambda s: '"' + s.replace('"', '""') + '"' if re.search('[",\r\n]', s) else s
    header = ("\ufeff" if mark else "") + ",".join(map(csv, df.columns))
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0  # the first row of its partition
    lines = df.select(csv_row(df).alias("line")).select(F.when(first, F.concat(F.lit(header + "\r\n"), "line")).otherwise(F.col("line")).alias("value"))
    if df.isEmpty():
        lines = df.sparkSession.createDataFrame([(header,)], "value string").coalesce(1)
    to = tempname(path)
    lines.write.option("lineSep", "\r\n").text(to)
    _renamed(df.sparkSession, to, path, ".csv")


def tempname(path: str) -> str:
    return f"{path.rstrip('/')}.part-{uuid.uuid4().hex}"


def _renamed(spark: SparkSession, written: str, path: str, ending: str) -> None:
    """Moves written part files to path, with another ending."""
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    src, dst = jvm.org.apache.hadoop.fs.Path(written), jvm.org.apache.hadoop.fs.Path(path)
    fs = src.getFileSystem(conf)
    if fs.exists(dst):
        raise FileExistsError(path)
    fs.mkdirs(dst)
    for f in fs.listStatus(src):
        name = f.getPath().getName()
        if name.startswith("part-") and f.getLen() > 0:
            fs.rename(f.getPath(), jvm.org.apache.hadoop.fs.Path(dst, name.removesuffix(".txt") + ending))
    fs.delete(src, True)


def read_json(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """JSON documents, one a file, whatever their line breaks; an array gives a row for each element."""
    r = spark.read.option("multiLine", "true").option("pathGlobFilter", "*.json").option("recursiveFileLookup", "true")
    return (r.schema(schema) if schema else r).json(path)


def read_sheet_json(spark: SparkSession, path: str) -> DataFrame:
    """Sheets written as {"columns": [...], "rows": [[...], ...]}: row_index and the columns as text. All files must have the same columns."""
    sheets = read_json(spark, path, "columns array<string>, rows array<array<string>>")
    names = sheets.select("columns").distinct().limit(2).collect()
    if len(names) != 1:
        raise ValueError(f"{len(names)} sets of columns below {path}")
    rows = sheets.select(F.posexplode("rows").alias("row_index", "r"))
    return rows.select("row_index", *(F.get("r", F.lit(i)).alias(c) for i, c in enumerate(names[0][0])))


def json_lines(df: DataFrame) -> DataFrame:
    """value: each row as compact JSON, keys in order, nulls shown. A number that JSON has no form for (NaN, infinity) is an error, not a text."""
    floats = [c for c, t in df.dtypes if t in ("double", "float")]
    bad = any_of([F.isnan(F.col(f"`{c}`")) | (F.abs(F.col(f"`{c}`")) == float("inf")) for c in floats])
    row = F.to_json(F.struct(*(F.col(f"`{c}`") for c in sorted(df.columns))), {"ignoreNullFields": "false"})
    return df.select(F.when(F.coalesce(bad, F.lit(False)), F.raise_error(F.lit("a number is not finite"))).otherwise(row).alias("value"))


def write_json(df: DataFrame, path: str) -> None:
    """One JSON object a line; equal rows in equal order give equal bytes."""
    json_lines(df).write.text(path)


def write_or_stub(df: DataFrame, path: str, detail: str, threshold: int) -> DataFrame:
    """A table of threshold rows or more goes to the detail path, and a row that says so to path; a smaller one to path itself. Returns what path holds."""
    n = df.count()
    if n >= threshold:
        df.write.parquet(detail)
        df = df.sparkSession.createDataFrame([(n, detail)], "rows long, detail string")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def write_sharded(df: DataFrame, key: str, shards: int, path: str) -> None:
    """A folder for each shard of the key's hash, each written by one task."""
    df.withColumn("shard", F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(shards)).cast("int")).repartition(shards, "shard").write.partitionBy("shard").parquet(path)


def lookup_sharded(spark: SparkSession, path: str, key: str, keys: list[str], shards: int) -> DataFrame:
    """The rows of some keys; only their shards' folders are read."""
    want = spark.createDataFrame([(str(k),) for k in keys], "k string")
    at = [r[0] for r in want.select(F.pmod(F.xxhash64("k"), F.lit(shards)).cast("int")).distinct().collect()]
    return spark.read.parquet(path).where(F.col("shard").isin(at) & F.col(key).cast("string").isin([str(k) for k in keys])).drop("shard")


def write_chunks(df: DataFrame, chunk: str, path: str) -> None:
    df.repartition(chunk).write.partitionBy(chunk).parquet(path)


def load_chunks(spark: SparkSession, path: str, chunk: str, first: int, last: int | None = None) -> DataFrame:
    """The chunks from first to last (the first alone unless given); others are not listed."""
    return spark.read.parquet(path).where(F.col(chunk).between(first, first if last is None else last))


def content_hash(df: DataFrame) -> str:
    """A hash of a table's rows, whatever their order: a sum of row hashes, so nothing is gathered."""
    row = F.xxhash64(F.to_json(F.struct(*sorted(df.columns)))).cast("decimal(38,0)")
    n, s = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(row), F.lit(0))).first()
    return f"{n}:{s}"


def ordered_hash(df: DataFrame, key: str, fan: int = 1000) -> str:
    """SHA-256 of the rows in the order of a number key that no two share: digests of `fan` rows make one, and so on, whatever the partitions."""
    level = numbered(df.select(key, F.sha2(F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"}), 256).alias("h")), key, "i").select((F.col("i") - 1).alias("i"), "h")
    while level.count() > 1:
        level = kept(level.groupBy(F.floor(F.col("i") / fan).alias("i")).agg(F.array_sort(F.collect_list(F.struct("i", "h"))).alias("x")).select("i", F.sha2(F.array_join(F.transform("x", lambda x: x["h"]), ""), 256).alias("h")))
    row = level.first()
    return row.h if row else hashlib.sha256(b"").hexdigest()


def stream_workbook(content: bytes) -> Iterator[tuple[str, int, list[str | None]]]:
    """(sheet, row, values) of a workbook, row by row: a second reader beside workbook_cells, which shares nothing with it and holds one row at a time."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        shared: list[str] = []
        if "xl/sharedStrings.xml" in z.namelist():
            for _, e in ElementTree.iterparse(z.open("xl/sharedStrings.xml")):
                if e.tag.endswith("}si"):
                    shared.append("".join(t.text or "" for t in e.iter() if t.tag.endswith("}t")))
                    e.clear()
        where = {e.get("Id"): e.get("Target") for _, e in ElementTree.iterparse(z.open("xl/_rels/workbook.xml.rels")) if e.tag.endswith("}Relationship")}
        for _, sheet in ElementTree.iterparse(z.open("xl/workbook.xml")):
            if not sheet.tag.endswith("}sheet"):
                continue
            target = where[sheet.get(_REL)]
            for _, row in ElementTree.iterparse(z.open(target[1:] if target.startswith("/") else f"xl/{target}")):
                if not row.tag.endswith("}row"):
                    continue
                values: list[str | None] = []
                for cell in row:
                    at = _column(cell.get("r")) if cell.get("r") else len(values) + 1
                    values += [None] * (at - 1 - len(values))
                    texts = [e.text or "" for e in cell.iter() if e.tag.endswith("}v") or e.tag.endswith("}t")]
                    values.append(shared[int(texts[0])] if texts and cell.get("t") == "s" else "".join(texts) if texts else None)
                yield sheet.get("name"), int(row.get("r")), values
                row.clear()


def sheet_rows(cells: DataFrame, header: int = 1) -> DataFrame:
    """path, sheet, r, values: the rows below the header of each sheet's cells as maps from the header's names; cells below no name are left out."""
    heads = cells.where(F.col("r") == header).select("path", "sheet", "c", F.col("value").alias("name"))
    body = cells.where(F.col("r") > header).join(heads, ["path", "sheet", "c"]).where("name IS NOT NULL")
    return body.groupBy("path", "sheet", "r").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("name", "value")))).alias("values"))


def document_lines(content: bytes) -> list[str]:
    """Paragraphs of a DOCX file and, tab by tab, rows of its tables, in order."""
    w = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        body = ElementTree.fromstring(z.read("word/document.xml")).find(f"{w}body")
    said = lambda e: "".join(t.text or "" for t in e.iter(f"{w}t"))
    out = []
    for e in body:
        if e.tag == f"{w}p":
            out.append(said(e))
        elif e.tag == f"{w}tbl":
            out += ["\t".join(said(c) for c in row.iter(f"{w}tc")) for row in e.iter(f"{w}tr")]
    return out


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """path, line, text of the DOCX files under path."""

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in batches:
            for p, content in zip(df["path"], df["content"], strict=True):
                yield pd.DataFrame([(p, i, t) for i, t in enumerate(document_lines(content))], columns=["path", "line", "text"])

    ship(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.docx").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "content").mapInPandas(parse, "path string, line int, text string")


def changed_since(listing: DataFrame, cache: DataFrame) -> DataFrame:
    """listing (path, size, mtime) rows that a cache of earlier results (same columns) does not hold as they are now: only these need to be scanned again."""
    return listing.join(cache.select("path", "size", "mtime"), ["path", "size", "mtime"], "left_anti")
