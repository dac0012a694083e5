import datetime
import decimal
import zipfile

import pytest
from pyspark.sql import functions as F

from gridloom.sources import files, workbooks

_C = 'xmlns:c="http://schemas.openxmlformats.org/drawingml/2006/chart" xmlns:a="http://schemas.openxmlformats.org/drawingml/2006/main"'


def test_workbook_is_read_back(spark, tmp_path):
    rows = [("=1+1", 1, 2.5, True, datetime.datetime(2024, 1, 2, 12), datetime.date(1970, 1, 1), bytearray(b"\x01\xff"), decimal.Decimal("3.10")),
            ("a<b&\x07c", None, float("nan"), False, datetime.datetime(1899, 12, 30), None, None, None), ("NULL", 3, None, None, None, None, None, None), ("x" * 32001, 4, None, None, None, None, None, None)]
    df = spark.createDataFrame(rows, "t string, n long, x double, b boolean, ts timestamp, d date, raw binary, m decimal(9,2)").coalesce(1)
    workbooks.write_workbook({"one/of": df, "empty": df.limit(0)}, str(tmp_path / "w.xlsx"), {"one/of": "a note"})
    got = {(r.sheet, r.r, r.c): r.value for r in files.read_workbooks(spark, str(tmp_path)).collect()}
    assert got["one_of", 1, 1] == "one/of" and got["one_of", 2, 1] == "a note"
    assert [got["one_of", 3, c] for c in range(1, 9)] == df.columns == [got["empty", 3, c] for c in range(1, 9)]
    body = {(r, c): v for (s, r, c), v in got.items() if s == "one_of" and r > 3}
    assert body == {(4, 1): "=1+1", (4, 2): "1", (4, 3): "2.5", (4, 4): "是", (4, 5): "45293.5", (4, 7): "01ff", (4, 8): "3.10", (5, 1): "a<b&c", (5, 4): "否", (6, 2): "3", (7, 1): "x" * 32000 + "…", (7, 2): "4"}
    assert not [k for k in got if k[0] == "empty" and k[1] > 3]


def test_workbook_refuses_what_a_sheet_cannot_hold(spark, tmp_path):
    with pytest.raises(ValueError, match="big"):
        workbooks.write_workbook({"big": spark.range(workbooks.MAX_ROWS)}, str(tmp_path / "w.xlsx"))
    with pytest.raises(ValueError, match="31"):
        workbooks.write_workbook({"a" * 31 + "b": spark.range(1), "A" * 31 + "c": spark.range(1)}, str(tmp_path / "w.xlsx"))
    assert not list(tmp_path.iterdir())


def test_column_names_and_ranges(spark):
    names = [workbooks.column_name(n) for n in (1, 26, 27, 52, 53, 702, 703)]
    assert names == ["A", "Z", "AA", "AZ", "BA", "ZZ", "AAA"]
    refs = spark.createDataFrame([("'My ''sheet'!$B$2:$AA$9",), ("S!C7",), ("S",), (None,)], "ref string").select(workbooks.range_of(F.col("ref")).alias("g")).collect()
    assert [r.g and tuple(r.g) for r in refs] == [("My 'sheet", 2, 2, 9, 27), ("S", 7, 3, 7, 3), None, None]


def test_charts_and_their_points(spark, tmp_path):
    df = spark.createDataFrame([("p", 1.0, 10.0), ("q", 2.0, None), ("r", 3.0, 30.0)], "k string, x double, y double").coalesce(1)
    workbooks.write_workbook({"data": df}, str(tmp_path / "w.xlsx"))
    ser = lambda i, col: f'<c:ser><c:idx val="{i}"/><c:order val="{i}"/><c:tx><c:strRef><c:f>data!${col}$3</c:f></c:strRef></c:tx><c:spPr><a:solidFill><a:srgbClr val="FF000{i}"/></a:solidFill></c:spPr><c:cat><c:strRef><c:f>data!$A$4:$A$6</c:f></c:strRef></c:cat><c:val><c:numRef><c:f>data!${col}$4:${col}$6</c:f></c:numRef></c:val></c:ser>'
    axes = "".join(f'<c:{k}><c:axId val="{n}"/></c:{k}>' for k, n in [("catAx", 1), ("valAx", 2), ("catAx", 3), ("valAx", 4)])
    plot = f'<c:barChart><c:barDir val="bar"/><c:grouping val="percentStacked"/>{ser(0, "B")}<c:axId val="1"/><c:axId val="2"/></c:barChart><c:lineChart>{ser(1, "C")}<c:axId val="3"/><c:axId val="4"/></c:lineChart>{axes}'
    with zipfile.ZipFile(tmp_path / "w.xlsx", "a") as z:
        z.writestr("xl/charts/chart1.xml", f"<c:chartSpace {_C}><c:chart><c:title><c:tx><c:rich><a:p><a:r><a:t>Two </a:t></a:r><a:r><a:t>axes</a:t></a:r></a:p></c:rich></c:tx></c:title><c:plotArea>{plot}</c:plotArea></c:chart></c:chartSpace>")
    series = workbooks.read_charts(spark, str(tmp_path))
    got = sorted(tuple(r)[2:9] + tuple(r)[-2:] for r in series.collect())
    assert got == [("Two axes", "bar", True, True, True, True, 0, "y", "FF0000"), ("Two axes", "line", True, False, False, False, 1, "y2", "FF0001")]
    points = sorted(tuple(r)[2:] for r in workbooks.chart_points(series, files.read_workbooks(spark, str(tmp_path))).collect())
    cats = lambda i: [(i, "category", j, c) for j, c in enumerate("pqr")]
    assert points == sorted([*cats(0), (0, "name", 0, "x"), (0, "value", 0, "1.0"), (0, "value", 1, "2.0"), (0, "value", 2, "3.0"), *cats(1), (1, "name", 0, "y"), (1, "value", 0, "10.0"), (1, "value", 2, "30.0")])
