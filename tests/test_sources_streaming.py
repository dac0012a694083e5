import datetime
import sqlite3
import zipfile

import pytest

from gridloom.sources import files, relational
from gridloom.streaming import ledger

_M = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"


def test_workbook_cells(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.xlsx", "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{_M}" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="S" sheetId="1" r:id="r1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="r1" Target="worksheets/sheet1.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f'<sst xmlns="{_M}"><si><t>tag</t></si></sst>')
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet xmlns="{_M}"><sheetData><row r="1"><c r="A1" t="s"><v>0</v></c><c r="AB1"><f>1+1</f><v>2</v></c></row></sheetData></worksheet>')
    got = sorted(tuple(r)[1:] for r in files.read_workbooks(spark, str(tmp_path)).collect())
    assert got == [("S", 1, 1, "tag", None), ("S", 1, 28, "2", "1+1")]
    assert files.walk(spark, str(tmp_path), "*.xlsx").count() == 1


def test_csv_guard_and_hash(spark, tmp_path):
    df = spark.createDataFrame([("=1+1", 'a"b'), ("-5", None)], "x string, y string")
    files.write_csv(df, str(tmp_path / "out"))
    lines = [r.value for r in spark.read.text(str(tmp_path / "out")).collect()]
    assert sorted(set(lines)) == ["'-5,", "'=1+1,\"a\"\"b\"", "x,y"]
    assert sorted(tuple(r) for r in files.read_csv(spark, str(tmp_path / "out")).collect()) == [("'-5", None), ("'=1+1", 'a"b')]
    assert files.content_hash(df) == files.content_hash(df.orderBy("y"))


def test_stream_drops_repeats(spark, tmp_path):
    t = datetime.datetime(2024, 1, 1)
    spark.createDataFrame([("a", t), ("a", t + datetime.timedelta(seconds=5)), ("b", t)], "txn string, ts timestamp").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("txn string, ts timestamp").parquet(str(tmp_path / "in"))
    q = ledger.once(stream, "txn", "ts").writeStream.format("memory").queryName("once").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert sorted(r.txn for r in spark.table("once").collect()) == ["a", "b"]
    q = ledger.too_many(stream, "txn", "ts", 1).writeStream.outputMode("update").format("memory").queryName("many").option("checkpointLocation", str(tmp_path / "cp2")).trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert {r.txn for r in spark.table("many").collect()} == {"a"}


def test_sqlite_dump_and_audit(spark, tmp_path):
    path = str(tmp_path / "a.db")
    con = sqlite3.connect(path)
    con.execute('CREATE TABLE "odd name" (id INTEGER PRIMARY KEY, "x""y" TEXT, v REAL, b BLOB)')
    con.executemany('INSERT INTO "odd name" VALUES (?, ?, ?, ?)', [(1, "a", 1.5, b"\x00"), (2, None, 2, None), (9, "c", "text", b"")])
    con.execute("CREATE TABLE empty (k VARCHAR(5))")
    con.commit()
    con.close()
    cat = relational.sqlite_catalog(spark, path)
    assert [(r.table, r.column, r.key) for r in cat.orderBy("table", "position").collect()] == [("empty", "k", False), ("odd name", "id", True), ("odd name", 'x"y', False), ("odd name", "v", False), ("odd name", "b", False)]
    t = relational.read_sqlite(spark, path, "odd name")
    assert [tuple(r) for r in t.orderBy("id").collect()] == [(1, "a", 1.5, bytearray(b"\x00")), (2, None, 2.0, None), (9, "c", None, bytearray())]
    e = relational.read_sqlite(spark, path, "empty")
    assert e.count() == 0 and e.columns == ["k"]
    with pytest.raises(sqlite3.OperationalError):
        relational.sqlite_catalog(spark, str(tmp_path / "none.db"))
    got = relational.audit_counts({"odd name": t, "empty": e}, spark.createDataFrame([("odd name", 3), ("empty", 1)], "table string, expected long"))
    assert {r.table: r.status for r in got.collect()} == {"odd name": "ok", "empty": "mismatch"}


def test_fill_script_quotes(spark):
    df = spark.createDataFrame([("p'1", 3), (None, 4), ("p2", None)], "pn string, n int")
    assert [r.sql for r in relational.fill_script(df, "items", "pn", "n").collect()] == ["UPDATE items SET n = 3 WHERE pn = 'p''1' AND n IS NULL;"]
