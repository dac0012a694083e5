"""Workbooks out, and the charts that workbooks hold."""

from __future__ import annotations

import datetime
import io
import os
import re
import tempfile
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.session import ship

#: What a sheet holds at most, dates that stand for none, texts that stand for none, the longest text, words of a flag, the date format.
MAX_ROWS = 1_048_576
NO_DATES = {(1899, 12, 30), (1900, 1, 1), (1970, 1, 1), (1, 1, 1), (2036, 2, 5), (2036, 2, 7)}
NO_TEXTS = {"nan", "None", "NaT", "<NA>", "NULL"}
LONGEST = 32_000
FLAGS = ("否", "是")
DATE_FORMAT = "yyyy-mm-dd hh:mm:ss"
CONTROL = re.compile(r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\x9f]")
HEADER = 3

_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_DOCUMENT = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PACKAGE = "http://schemas.openxmlformats.org/package/2006"
_CHART = "{http://schemas.openxmlformats.org/drawingml/2006/chart}"
_DRAWING = "{http://schemas.openxmlformats.org/drawingml/2006/main}"


def column_name(n: int) -> str:
    out = ""
    while n:
        n, rest = divmod(n - 1, 26)
        out = chr(65 + rest) + out
    return out


def _text(ref: str, v: str) -> str:
    return f'<c r="{ref}" t="inlineStr"><is><t xml:space="preserve">{escape(v)}</t></is></c>'


def cell_xml(ref: str, v: object) -> str:
    """A cell, '' where it stays blank: no date, no text, nothing. Texts stay texts, whatever sign they begin with."""
    if v is None or isinstance(v, float) and v != v:
        return ""
    if isinstance(v, bool):
        return _text(ref, FLAGS[v])
    if isinstance(v, (datetime.datetime, datetime.date)):
        if v.year < 1900 or (v.year, v.month, v.day) in NO_DATES:
            return ""
        at = v.replace(tzinfo=None) if isinstance(v, datetime.datetime) else datetime.datetime(v.year, v.month, v.day)
        return f'<c r="{ref}" s="1"><v>{(at - datetime.datetime(1899, 12, 30)) / datetime.timedelta(days=1)!r}</v></c>'
    if isinstance(v, (bytes, bytearray)):
        return _text(ref, bytes(v).hex())
    if isinstance(v, (int, float)) or type(v).__name__ == "Decimal":
        return f'<c r="{ref}"><v>{v}</v></c>' if abs(v) != float("inf") else _text(ref, str(v))
    v = str(v)
    if v in NO_TEXTS:
        return ""
    v = CONTROL.sub("", v)
    return _text(ref, v if len(v) <= LONGEST else v[:LONGEST] + "…")


def _sheet(title: str, note: str, columns: list[str], rows: Iterator, n: int, widths: list[float]) -> Iterator[str]:
    last = column_name(max(len(columns), 1))
    yield f'<?xml version="1.0" encoding="UTF-8" standalone="yes"?><worksheet xmlns="{_MAIN}"><sheetViews><sheetView workbookViewId="0"><pane ySplit="{HEADER}" topLeftCell="A{HEADER + 1}" state="frozen"/></sheetView></sheetViews>'
    yield "<cols>" + "".join(f'<col min="{i}" max="{i}" width="{w:.2f}" customWidth="1"/>' for i, w in enumerate(widths, 1)) + "</cols>" if widths else ""
    yield f'<sheetData><row r="1">{_text("A1", title)}</row><row r="2">{_text("A2", note)}</row>'
    yield f'<row r="{HEADER}">' + "".join(_text(f"{column_name(i)}{HEADER}", c) for i, c in enumerate(columns, 1)) + "</row>"
    names = [column_name(i) for i in range(1, len(columns) + 1)]
    for r, row in enumerate(rows, HEADER + 1):
        yield f'<row r="{r}">' + "".join(cell_xml(f"{c}{r}", v) for c, v in zip(names, row, strict=True)) + "</row>"
    yield "</sheetData>" + (f'<autoFilter ref="A{HEADER}:{last}{HEADER + n}"/>' if n else "") + "</worksheet>"


def write_workbook(sheets: dict[str, DataFrame], path: str, notes: dict[str, str] | None = None) -> None:
    """One workbook with a sheet for each table: title, note, header in the third row, frozen and filtered, widths by the first 400 rows (8 to 60).

    Rows come partition by partition and go straight into the file; a table beyond what a sheet holds raises before anything is written (write_or_stub leaves such a table outside).
    """
    sizes = {name: df.count() for name, df in sheets.items()}
    over = [name for name, n in sizes.items() if n > MAX_ROWS - HEADER]
    if over:
        raise ValueError(f"more rows than a sheet holds: {', '.join(over)}")
    titles = {name: re.sub(r"[\[\]:*?/\\]", "_", name)[:31] for name in sheets}
    if len({t.lower() for t in titles.values()}) < len(titles):
        raise ValueError("sheets whose first 31 characters are the same")
    spark = next(iter(sheets.values())).sparkSession
    handle, local = tempfile.mkstemp(suffix=".xlsx")  # on the driver alone, which copies it to where path lies
    os.close(handle)
    try:
        with zipfile.ZipFile(local, "w", zipfile.ZIP_DEFLATED, allowZip64=True) as z:
            numbers = range(1, len(sheets) + 1)
            listed = "".join(f'<sheet name="{escape(titles[name], {chr(34): "&quot;"})}" sheetId="{i}" r:id="r{i}"/>' for i, name in zip(numbers, sheets, strict=True))
            z.writestr("xl/workbook.xml", f'<workbook xmlns="{_MAIN}" xmlns:r="{_DOCUMENT}"><sheets>{listed}</sheets></workbook>')
            links = "".join(f'<Relationship Id="r{i}" Type="{_DOCUMENT}/worksheet" Target="worksheets/sheet{i}.xml"/>' for i in numbers)
            z.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="{_PACKAGE}/relationships">{links}<Relationship Id="s" Type="{_DOCUMENT}/styles" Target="styles.xml"/></Relationships>')
            z.writestr("_rels/.rels", f'<Relationships xmlns="{_PACKAGE}/relationships"><Relationship Id="w" Type="{_DOCUMENT}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
            kind = "application/vnd.openxmlformats-officedocument.spreadsheetml"
            parts = "".join(f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="{kind}.worksheet+xml"/>' for i in numbers)
            z.writestr("[Content_Types].xml", f'<Types xmlns="{_PACKAGE}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Override PartName="/xl/workbook.xml" ContentType="{kind}.sheet.main+xml"/><Override PartName="/xl/styles.xml" ContentType="{kind}.styles+xml"/>{parts}</Types>')
            plain = '<font><sz val="11"/><name val="Calibri"/></font>'
            z.writestr("xl/styles.xml", f'<styleSheet xmlns="{_MAIN}"><numFmts count="1"><numFmt numFmtId="164" formatCode="{DATE_FORMAT}"/></numFmts><fonts count="1">{plain}</fonts><fills count="1"><fill><patternFill patternType="none"/></fill></fills><borders count="1"><border/></borders><cellStyleXfs count="1"><xf/></cellStyleXfs><cellXfs count="2"><xf xfId="0"/><xf numFmtId="164" xfId="0" applyNumberFormat="1"/></cellXfs></styleSheet>')
            for i, (name, df) in zip(numbers, sheets.items(), strict=True):
                head = df.limit(400).collect()
                widths = [min(max(8.0, max([len(c), *(min(len(str(r[j])), 60) for r in head if r[j] is not None)]) * 1.15 + 2), 60.0) for j, c in enumerate(df.columns)]
                with z.open(f"xl/worksheets/sheet{i}.xml", "w", force_zip64=True) as out:
                    for piece in _sheet(name, (notes or {}).get(name, ""), df.columns, df.toLocalIterator(), sizes[name], widths):
                        out.write(piece.encode())
        jvm = spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).copyFromLocalFile(True, True, jvm.org.apache.hadoop.fs.Path("file://" + local), target)
    finally:
        if os.path.exists(local):
            os.remove(local)


def _val(at: ElementTree.Element | None, path: str) -> str | None:
    found = None if at is None else at.find("/".join(_CHART + p for p in path.split("/")))
    return None if found is None else found.get("val")


def _words(at: ElementTree.Element | None) -> str | None:
    words = "" if at is None else "".join(t.text or "" for t in at.iter(f"{_DRAWING}t"))
    return words or None


def chart_series_of(content: bytes) -> Iterator[tuple]:
    """A row for each series of each chart part of a workbook, by the DrawingML chart schema: where names, categories and values lie, its kind, and the axis it is drawn against."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        for part in sorted(n for n in z.namelist() if re.fullmatch(r"xl/charts/chart\d+\.xml", n)):
            chart = ElementTree.fromstring(z.read(part)).find(f"{_CHART}chart")
            plot = chart.find(f"{_CHART}plotArea")
            groups = [g for g in plot if g.tag.endswith("Chart")]
            values = {a.find(f"{_CHART}axId").get("val") for a in plot.iter(f"{_CHART}valAx")}
            of = lambda g: next((a.get("val") for a in reversed(g.findall(f"{_CHART}axId")) if a.get("val") in values), None)
            main = next((of(g) for g in groups if of(g)), None)
            for g in groups:
                kind = re.sub("(3D)?Chart$", "", g.tag.removeprefix(_CHART))
                grouping = _val(g, "grouping")
                for s in g.iter(f"{_CHART}ser"):
                    refs = {k: next((f.text for f in s.findall(f"{_CHART}{k}//{_CHART}f")), None) for k in ("tx", "cat", "xVal", "val", "yVal")}
                    rgb = s.find(f"{_CHART}spPr//{_DRAWING}srgbClr")
                    yield (part, _words(chart.find(f"{_CHART}title")), kind, len(groups) > 1 and len({x.tag for x in groups}) > 1, _val(g, "barDir") == "bar", grouping in ("stacked", "percentStacked"), grouping == "percentStacked",
                           int(_val(s, "order") or _val(s, "idx") or 0), refs["tx"], refs["cat"] or refs["xVal"], refs["val"] or refs["yVal"], "y2" if of(g) and of(g) != main else "y", None if rgb is None else rgb.get("val"))


_SERIES = "path string, part string, title string, kind string, combined boolean, horizontal boolean, stacked boolean, percent boolean, series int, name_ref string, category_ref string, value_ref string, axis string, colour string"


def read_charts(spark: SparkSession, path: str) -> DataFrame:
    """Every series of every chart in the workbooks under path; one task a file or more."""

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in _SERIES.split(", ")]
        for df in batches:
            for p, content in zip(df["path"], df["content"], strict=True):
                yield pd.DataFrame([(p, *s) for s in chart_series_of(content)], columns=names)

    ship(spark)
    books = spark.read.format("binaryFile").option("pathGlobFilter", "*.xlsx").option("recursiveFileLookup", "true").load(path)
    return books.select("path", "content").mapInPandas(parse, _SERIES)


def _number(letters: Column) -> Column:
    return F.aggregate(F.split(letters, ""), F.lit(0), lambda n, ch: F.when(ch == "", n).otherwise(n * 26 + F.ascii(ch) - 64))


def range_of(ref: Column) -> Column:
    """sheet, r0, c0, r1, c1 of a reference such as 'My sheet'!$A$1:$B$9 or S!$A$1; NULL of anything else."""
    shape = r"^(?:'((?:[^']|'')+)'|([^'!]+))!\$?([A-Z]{1,3})\$?(\d+)(?::\$?([A-Z]{1,3})\$?(\d+))?$"
    g = [F.regexp_extract(ref, shape, i) for i in range(7)]
    c1, r1 = F.when(g[5] == "", g[3]).otherwise(g[5]), F.when(g[6] == "", g[4]).otherwise(g[6])
    sheet = F.when(g[1] != "", F.replace(g[1], F.lit("''"), F.lit("'"))).otherwise(g[2])
    return F.when(g[0] != "", F.struct(sheet.alias("sheet"), g[4].cast("int").alias("r0"), _number(g[3]).alias("c0"), r1.cast("int").alias("r1"), _number(c1).alias("c1")))


def chart_points(series: DataFrame, cells: DataFrame) -> DataFrame:
    """series of read_charts, cells of read_workbooks -> path, part, series, role (name, category, value), at (from 0, along the range), value. Cells meet ranges by their
    columns in an equi-join, rows within it; a blank cell has no row."""
    roles = F.array(*(F.struct(F.lit(r).alias("role"), range_of(F.col(f"{r}_ref")).alias("g")) for r in ("name", "category", "value")))
    asked = series.select("path", "part", "series", F.inline(roles)).where("g IS NOT NULL").select("path", "part", "series", "role", "g.*")
    asked = asked.withColumn("c", F.explode(F.sequence("c0", "c1")))
    met = asked.join(cells.select("path", "sheet", "r", "c", "value"), ["path", "sheet", "c"]).where("r BETWEEN r0 AND r1 AND value IS NOT NULL")
    return met.select("path", "part", "series", "role", ((F.col("r") - F.col("r0")) * (F.col("c1") - F.col("c0") + 1) + F.col("c") - F.col("c0")).alias("at"), "value")
