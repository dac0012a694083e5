"""The text layer of PDF files as words in boxes.

Read as far as words and their places need it: objects (also those packed in object streams), page contents with FlateDecode, text matrices, and literal and hexadecimal strings in the
fonts' own single-byte code, Latin where a font tells nothing. Widths are taken as half the font size a character; encrypted files give nothing.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from gridloom.session import ship

_TOKEN = re.compile(rb"\((?:\\.|[^\\()]|\((?:\\.|[^\\()])*\))*\)|<[0-9A-Fa-f\s]*>|\[|\]|/[^\s/<>\[\]()]+|[-+]?\d*\.?\d+|[A-Za-z'\"*]+", re.S)
_ESCAPES = {b"n": b"\n", b"r": b"\r", b"t": b"\t", b"b": b"\b", b"f": b"\f"}


def _stream(body: bytes) -> bytes:
    """The decoded stream of an object, empty where it has none or an unknown filter."""
    m = re.search(rb"stream\r?\n(.*?)\r?\n?endstream", body, re.S)
    if not m:
        return b""
    head = body[: m.start()]
    if b"/Filter" not in head:
        return m[1]
    try:
        return zlib.decompressobj().decompress(m[1]) if b"/FlateDecode" in head else b""
    except zlib.error:
        return b""


def _objects(content: bytes) -> dict[int, bytes]:
    out = {int(n): body for n, body in re.findall(rb"(\d+)\s+\d+\s+obj\b(.*?)\bendobj", content, re.S)}
    for body in list(out.values()):
        if re.search(rb"/Type\s*/ObjStm", body):
            first, data = int(re.search(rb"/First\s+(\d+)", body)[1]), _stream(body)
            index = [int(x) for x in data[:first].split()]
            ends = [*index[3::2], len(data) - first]
            for n, a, b in zip(index[::2], index[1::2], ends, strict=True):
                out.setdefault(n, data[first + a : first + b])
    return out


def _text(token: bytes) -> str:
    if token[:1] == b"<":
        digits = re.sub(rb"\s", b"", token[1:-1])
        return bytes.fromhex((digits + b"0" * (len(digits) % 2)).decode()).decode("latin-1")
    plain = re.sub(rb"\\([0-7]{1,3}|.)", lambda m: bytes([int(m[1], 8) & 255]) if m[1][:1].isdigit() else _ESCAPES.get(m[1], m[1]), token[1:-1], flags=re.S)
    return plain.decode("latin-1")


def page_words(content: bytes) -> Iterator[tuple[int, float, float, float, float, str]]:
    """(page, x0, y0, x1, y1, word), pages from 1, places in points from the lower left corner."""
    objects = _objects(content)
    if re.search(rb"/Encrypt\s+\d+", content):
        return
    pages = sorted(n for n, body in objects.items() if re.search(rb"/Type\s*/Page\b", body))
    for page, n in enumerate(pages, 1):
        m = re.search(rb"/Contents\s*(\[[^\]]*\]|\d+\s+\d+\s+R)", objects[n])
        refs = [int(x) for x in re.findall(rb"(\d+)\s+\d+\s+R", m[1])] if m else []
        yield from ((page, *w) for w in _placed(b"\n".join(_stream(objects.get(r, b"")) for r in refs)))


def _placed(source: bytes) -> Iterator[tuple[float, float, float, float, str]]:
    size, lead, line, at, scale = 1.0, 0.0, (0.0, 0.0), (0.0, 0.0), 1.0
    stack: list[bytes] = []

    def shown(s: str) -> Iterator[tuple[float, float, float, float, str]]:
        nonlocal at
        wide = size * scale / 2
        for m in re.finditer(r"\S+", s):
            yield at[0] + m.start() * wide, at[1], at[0] + m.end() * wide, at[1] + size * scale, m.group()
        at = (at[0] + len(s) * wide, at[1])

    numbers = lambda k: [float(x) for x in stack[-k:]]
    for token in _TOKEN.findall(source):
        if token[:1] in b"(<[]/+-.0123456789":
            stack.append(token)
            continue
        if token == b"BT":
            line = at = (0.0, 0.0)
            scale = 1.0
        elif token == b"Tf":
            size = numbers(1)[0]
        elif token == b"TL":
            lead = numbers(1)[0]
        elif token in (b"Td", b"TD"):
            x, y = numbers(2)
            lead = -y if token == b"TD" else lead
            line = at = (line[0] + x * scale, line[1] + y * scale)
        elif token == b"Tm":
            a, _, _, d, x, y = numbers(6)
            scale, line, at = abs(d) or abs(a), (x, y), (x, y)
        elif token in (b"T*", b"'", b'"'):
            line = at = (line[0], line[1] - lead * scale)
        if token in (b"Tj", b"'", b'"'):
            yield from shown(_text(stack[-1]))
        elif token == b"TJ":
            # far steps back between pieces are blanks
            pieces = [_text(x) if x[:1] in b"(<" else " " if x[:1] in b"-" and float(x) < -200 else "" for x in stack if x not in (b"[", b"]")]
            yield from shown("".join(pieces))
        stack = []


def read_pdf_words(spark: SparkSession, path: str) -> DataFrame:
    """path, page, word (its number), x0, y0, x1, y1, text of the PDF files under path; files.changed_since() tells which need to be read again."""

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in batches:
            for p, content in zip(df["path"], df["content"], strict=True):
                yield pd.DataFrame([(p, w[0], i, *w[1:]) for i, w in enumerate(page_words(content))], columns=["path", "page", "word", "x0", "y0", "x1", "y1", "text"])

    ship(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.pdf").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "content").mapInPandas(parse, "path string, page int, word int, x0 double, y0 double, x1 double, y1 double, text string")
