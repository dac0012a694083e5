"""Shaping tables for publication: names, order and metadata of columns, and the state of a view as text."""

from __future__ import annotations

import re
from urllib.parse import parse_qsl, urlencode

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Headers whose columns are shown in a fixed-width face, widths of columns in pixels.
_CODES = r"位號|GUID|UID|路徑|Path|Identifier|ID\b|十六進位|參數 \("
_WIDTHS = {"date": 150, "flag": 60, "num": 80}


def renamed(df: DataFrame, rules: list[tuple[str, str]], order: list[str] = ()) -> DataFrame:
    """Headers by a list of patterns and replacements, one after another; columns that match a pattern of order come first, in its order."""
    names = list(df.columns)
    for pattern, to in rules:
        names = [re.sub(pattern, to, n) for n in names]
    if len(set(names)) != len(names):
        raise ValueError(f"two columns of one name: {names}")
    out = df.toDF(*names)
    rank = lambda n: next((i for i, p in enumerate(order) if re.search(p, n)), len(order))
    return out.select(*(F.col(f"`{n}`") for n in sorted(names, key=rank)))


def published(df: DataFrame, sheet: str, drop: dict[str, list[str]], hidden: list[str] = ()) -> DataFrame | None:
    """A sheet without the columns that are not published; None of a sheet that is not."""
    return None if sheet in hidden else df.drop(*drop.get(sheet, []))


def inserted(df: DataFrame, after: str, name: str, value: Column) -> DataFrame:
    """df with a column put right behind another."""
    out = []
    for c in df.columns:
        out.append(F.col(f"`{c}`"))
        if c == after:
            out.append(value.alias(name))
    return df.select(*out)


def column_meta(df: DataFrame) -> DataFrame:
    """column, type, align, width, note, mono: how a column is shown, by its type, its header and, of texts, its longest value (sixty characters at most), in one scan."""
    kinds = {c: "date" if t in ("date", "timestamp", "timestamp_ntz") else "flag" if t == "boolean" else "text" if t == "string" or t.startswith(("array", "map", "struct", "binary")) else "num" for c, t in df.dtypes}
    texts = [c for c, t in df.dtypes if t == "string"]
    longest = df.agg(F.lit(0).alias("_"), *(F.coalesce(F.max(F.least(F.length(f"`{c}`"), F.lit(60))), F.lit(0)).alias(f"m{i}") for i, c in enumerate(texts))).first()
    rows = []
    for c, kind in kinds.items():
        most = max(len(c), longest[f"m{texts.index(c)}"] if c in texts else 0)
        note = re.search(r"\(([^()]*)\)\s*$", c)
        width = _WIDTHS.get(kind) or min(420, max(60, most * 8 + 16))
        rows.append((c, "text" if kind == "flag" else kind, {"text": "left", "flag": "center"}.get(kind, "right"), width, note.group(1) if note else None, bool(re.search(_CODES, c))))
    return df.sparkSession.createDataFrame(rows, "column string, type string, align string, width int, note string, mono boolean")


def state_text(query: str = "", filters: dict[str, str] | None = None, sort: tuple[str, bool] | None = None) -> str:
    """The state of a view (search, filters by column, sorting) as the query part of an address."""
    parts = [("q", query)] if query else []
    parts += [(f"f.{c}", f) for c, f in sorted((filters or {}).items()) if f]
    if sort:
        parts.append(("sort", ("-" if sort[1] else "") + sort[0]))
    return urlencode(parts)


def state_of(text: str, columns: list[str]) -> tuple[str, dict[str, str], tuple[str, bool] | None]:
    """What an address says of a view; columns that the table lacks are left out."""
    query, filters, sort = "", {}, None
    for k, v in parse_qsl(text, keep_blank_values=False):
        if k == "q":
            query = v
        elif k.startswith("f.") and k[2:] in columns:
            filters[k[2:]] = v
        elif k == "sort" and v.lstrip("-") in columns:
            sort = (v.lstrip("-"), v.startswith("-"))
    return query, filters, sort


def options_of(validations: DataFrame, cells: DataFrame) -> DataFrame:
    """validations (column, formula), cells (ref, value) -> column, option, position: a literal list in quotes, or the cells of a range (cells' ref names the range)."""
    quoted = F.col("formula").startswith('"')
    literal = validations.where(quoted).select("column", F.posexplode(F.transform(F.split(F.regexp_replace("formula", '^"|"$', ""), ","), lambda x: F.trim(x))).alias("position", "option"))
    ranged = validations.where(~quoted).join(cells, F.regexp_replace("formula", r"[$=]", "") == F.col("ref")).select("column", F.col("at").alias("position"), F.col("value").alias("option"))
    return literal.unionByName(ranged.select("column", "position", "option")).where("option <> ''")


def outside_block(cells: DataFrame, last_row: int, last_column: int) -> DataFrame:
    """sheet, r1, c1, r2, c2, position: the box around what stands below or beside a sheet's table."""
    out = cells.where((F.col("r") > last_row) | (F.col("c") > last_column)).where("value IS NOT NULL AND value <> ''")
    box = out.groupBy("sheet").agg(F.min("r").alias("r1"), F.min("c").alias("c1"), F.max("r").alias("r2"), F.max("c").alias("c2"))
    return box.withColumn("position", F.when(F.col("r1") > last_row, "below").otherwise("beside"))


def catalog_links(cells: DataFrame, sheets: DataFrame) -> DataFrame:
    """sheet, r, target: HYPERLINK cells whose label is the name of a sheet."""
    label = F.regexp_extract("formula", r'HYPERLINK\(\s*"[^"]*"\s*[,;]\s*"([^"]*)"\s*\)', 1)
    return cells.withColumn("target", label).where("target <> ''").join(sheets.select(F.col("name").alias("target")).distinct(), "target", "left_semi").select("sheet", "r", "target")


def sections(cells: DataFrame, most_column: int, size: float = 12.0, colour: str | None = None) -> DataFrame:
    """sheet, r, title: headings in the first column of a sheet below its first row: a bold, filled banner merged over nearly all columns, or bold text of a heading's size and colour.
    cells (sheet, r, c, value, span, bold, filled, size, colour)."""
    banner = (F.col("span") >= most_column - 1) & F.col("filled") & F.col("bold")
    heading = F.col("bold") & (F.col("size") >= size) & (F.lit(True) if colour is None else F.col("colour") == colour)
    return cells.where((F.col("c") == 1) & (F.col("r") > 1) & (F.trim("value") != "") & F.coalesce(banner | heading, F.lit(False))).select("sheet", "r", F.trim("value").alias("title"))
