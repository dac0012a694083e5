"""Personal data, plain and disguised, with spans in the source text.

Base spans are those of four plain patterns (email, ip, card, phone), leftmost and non-overlapping per kind; matches
that fail a kind's test are dropped without another try. For disguised identifiers a text is then rewritten by two
transducers that keep, for every character they put out, the source characters it came from: the first, character by character, folds full-width
forms, foreign digits, homoglyphs, dashes and dots and deletes characters without width; the second, over words, turns spelled digits
into digits and bracketed or spelled at, dot, plus and dash into signs where their neighbours make them part of
an identifier. Identifiers of the rewritten text whose source reads otherwise are mapped back to the source
and added, unless they lie within a base span of their kind. Base spans always stay.

n_email, n_ip, n_card and n_phone count base spans; n_added the others. Offsets are code points, end exclusive.
Null and empty texts hold nothing (base_sha256 of the empty string). Null ids stay null. Rows that repeat are each
scanned. An empty table gives an empty result. Text of any length is scanned whole, in linear time.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import small_batches

KINDS = ("email", "ip", "card", "phone")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a match never begins within a run of digits: if one did, it would have begun at the run's first
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """What [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+ finds, from each @ outwards."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        end = at + 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            done = end = m.end()
            yield start, end
        else:
            done = max(done, at + 1)
        at = text.find("@", end)


def luhn(digits: str) -> bool:
    double = (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)
    return sum(double[int(c)] if i % 2 else int(c) for i, c in enumerate(reversed(digits))) % 10 == 0


def plain(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the base spans, by start, then kind as listed."""
    out = [(s, 0, e) for s, e in emails(text)]
    if "." in text:
        out += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split("."))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = m.group().replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
    if "+" in text:
        out += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 9 <= sum(c.isdigit() for c in m.group()) <= 15]
    return [(s, KINDS[k], e) for s, k, e in sorted(out)]


# Letters of other scripts that look like Latin ones.
_LOOKALIKES = dict(zip("аеорсухіјѕԁһԛԝкмтвнАВЕЅІЈКМНОРСТУХοαενρτικυχΑΒΕΖΗΙΚΜΝΟΡΤΥΧıɡⅼ", "aeopcyxijsdhqwkmtbhABESIJKMHOPCTYXoaevptikuxABEZHIKMNOPTYXigl", strict=True))
_SIGNS = {**dict.fromkeys("‐‑‒–—―−﹣－", "-"), **dict.fromkeys("。．｡․﹒·∙•", "."), **dict.fromkeys("＠﹫", "@"), **dict.fromkeys("＋﹢", "+"), **dict.fromkeys("       　", " ")}
_NOTHING = frozenset("­​‌‍‎‏⁠﻿᠎")


@lru_cache(1 << 16)
def _fold(c: str) -> str:
    if c in _NOTHING:
        return ""
    if c in _SIGNS:
        return _SIGNS[c]
    if c in _LOOKALIKES:
        return _LOOKALIKES[c]
    if c.isdecimal():
        return str(unicodedata.decimal(c))
    n = unicodedata.normalize("NFKC", c)
    return n if n != c and n.isascii() and len(n) == 1 else c


# Digits in words; English, German, French, Spanish.
_DIGITS = [
    ("zero", "oh", "null", "zéro", "cero"),
    ("one", "eins", "un", "uno"),
    ("two", "zwei", "zwo", "deux", "dos"),
    ("three", "drei", "trois", "tres"),
    ("four", "vier", "quatre", "cuatro"),
    ("five", "fünf", "cinq", "cinco"),
    ("six", "sechs", "seis"),
    ("seven", "sieben", "sept", "siete"),
    ("eight", "acht", "huit", "ocho"),
    ("nine", "neun", "neuf", "nueve"),
]
_DIGIT = {w: str(d) for d, words in enumerate(_DIGITS) for w in words}
_AT, _DOT = "at|arobase|arroba", "dot|punkt|point|punto"
_WORD = "|".join(sorted(_DIGIT, key=len, reverse=True))
_RUN = re.compile(rf"(?i)(?<![^\W_])(?:{_WORD})(?:[\x20,.()-]{{1,3}}(?:{_WORD}|plus|dash|hyphen|minus|{_DOT}|[0-9]+))+(?![^\W_])|(?<![^\W_])plus[\x20]+(?=[0-9]|(?:{_WORD})\b)")
_PIECE = re.compile(rf"(?i)({_WORD})(?![^\W_])|(plus)(?![^\W_])|(dash|hyphen|minus)(?![^\W_])|({_DOT})(?![^\W_])")
_BRACKET = re.compile(rf"(?i)[\x20]?[(\[{{<][\x20]?(?:({_AT}|@)|({_DOT}|\.))[\x20]?[)\]}}>][\x20]?")
_LABEL = r"[A-Za-z0-9-]{1,63}"
_SAID = re.compile(rf"(?i)(?<![A-Za-z0-9._%+-])([A-Za-z0-9._%+-]{{1,64}})([\x20]{{1,3}}(?:{_AT})[\x20]{{1,3}}|[\x20]{{0,3}}@[\x20]{{0,3}})({_LABEL}(?:(?:[\x20]{{1,3}}(?:{_DOT})[\x20]{{1,3}}|[\x20]\.[\x20]|\.){_LABEL})+)")
_JOINED = re.compile(rf"(?i)[\x20]{{1,3}}(?:{_DOT})[\x20]{{1,3}}|[\x20]\.[\x20]")
_SAID_DOT = re.compile(rf"(?i)(?<=[0-9])[\x20]{{1,3}}(?:{_DOT})[\x20]{{1,3}}(?=[0-9])")
# what every match of _SAID holds
_SAID_AT = re.compile(rf"(?i)@|[\x20](?:{_AT})[\x20]")


class _Tape:
    """Rewritten text and, for each of its characters, the source characters [start, end) it stands for."""

    def __init__(self, text: str):
        self.text, self.start, self.end = text, range(len(text)), range(1, len(text) + 1)

    def rewrite(self, edits: list[tuple[int, int, str]]) -> None:
        """Replaces [a, b) by at most one character each; edits in order."""
        if not edits:
            return
        out, start, end, done = [], [], [], 0
        for a, b, to in edits:
            out.append(self.text[done:a])
            start += self.start[done:a]
            end += self.end[done:a]
            if to:
                out.append(to)
                start.append(self.start[a])
                end.append(self.end[b - 1])
            done = b
        out.append(self.text[done:])
        self.start, self.end, self.text = [*start, *self.start[done:]], [*end, *self.end[done:]], "".join(out)


def _digit_edits(text: str) -> list[tuple[int, int, str]]:
    """Spelled digits and signs of each run of them; runs of fewer than three different digits, and none in figures beside them, are prose."""
    edits = []
    for m in _RUN.finditer(text):
        if m.group().lower().startswith("plus"):
            edits.append((m.start(), m.end(), "+"))
            continue
        words = {p.group(1).lower() for p in _PIECE.finditer(text, m.start(), m.end()) if p.group(1)}
        beside = re.search("[0-9]", m.group()) or re.search(r"[0-9+][\x20().-]{0,2}$", text[max(0, m.start() - 3) : m.start()])
        if len({_DIGIT[w] for w in words}) < 3 and not beside:
            continue
        at, last = m.start(), ""
        for p in _PIECE.finditer(text, m.start(), m.end()):
            if p.start() > at and not text[at : p.start()].strip(" ,"):
                edits.append((at, p.start(), ""))
            to = _DIGIT[p.group(1).lower()] if p.group(1) else "+" if p.group(2) else "-" if p.group(3) else "."
            edits.append((p.start(), p.end(), to))
            at, last = p.end(), to
        if last == "." and at == m.end():
            edits.pop()
    return edits


def disguised(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) in the source of identifiers that only the rewritten text shows."""
    tape = _Tape(text)
    if not text.isascii() and any(c > "\x7f" and _fold(c) != c for c in set(text)):
        tape.rewrite([(m.start(), m.end(), f) for m in re.finditer(r"[^\x00-\x7f]", text) if (f := _fold(m.group())) != m.group()])
    tape.rewrite([(m.start(), m.end(), "@" if m.group(1) else ".") for m in _BRACKET.finditer(tape.text)])
    if edits := _digit_edits(tape.text):
        # a plus said before a run of digits touches it
        merged = [e for i, e in enumerate(edits) if i == 0 or e[0] >= edits[i - 1][1]]
        tape.rewrite(merged)
        tape.rewrite([(m.end() - 1, m.end(), "") for m in re.finditer(r"\+ (?=[0-9])", tape.text)])
    tape.rewrite([(m.start(), m.end(), ".") for m in _SAID_DOT.finditer(tape.text)])
    edits = []
    for m in _SAID.finditer(tape.text) if _SAID_AT.search(tape.text) else ():
        sure = "@" in m.group(2) or _JOINED.search(m.group(3)) or re.search(r"[0-9._%+-]", m.group(1))
        if sure and m.group(2) + m.group(3) and (m.group(2) != "@" or _JOINED.search(m.group(3))):
            # what follows a plain @ and a full stop with spaces is the next sentence, not a label
            if m.group(2) == "@" and " . " not in m.group(3) and not re.search(rf"(?i)[\x20](?:{_DOT})[\x20]", m.group(3)):
                continue
            edits.append((*m.span(2), "@"))
            edits += [(j.start() + m.start(3), j.end() + m.start(3), ".") for j in _JOINED.finditer(m.group(3))]
    tape.rewrite(edits)
    if tape.text is text:
        return []
    found = []
    for s, kind, e in plain(tape.text):
        a, b = tape.start[s], tape.end[e - 1]
        if text[a:b] != tape.text[s:e]:
            found.append((a, kind, b))
    return found


def spans(text: str | None) -> tuple[list[tuple[int, str, int]], list[tuple[int, str, int]]]:
    """Base spans, and those that the method adds."""
    if not text:
        return [], []
    base = plain(text)
    more = []
    for a, kind, b in disguised(text):
        if not any(k == kind and s <= a and b <= e for s, k, e in [*base, *more]):
            more.append((a, kind, b))
    return base, more


def _shown(found: list[tuple[int, str, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, k, e in sorted(found, key=lambda x: (x[0], KINDS.index(x[1]))))


def _scanned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for df in batches:
        rows = []
        for i, text in zip(df["doc_id"], df["text"], strict=True):
            base, more = spans(text)
            n = [sum(k == kind for _, k, _ in base) for kind in KINDS]
            added = [sum(k == kind for _, k, _ in more) for kind in KINDS]
            rows.append((i, *n, hashlib.sha256(_shown(base).encode()).hexdigest(), _shown(base + more), len(more), len(base) + len(more), *added))
        yield pd.DataFrame(rows, columns=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added", "n_spans", *(f"added_{k}" for k in KINDS)]).astype({"doc_id": "Int64"})


def find_pii(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans (all), n_added, n_spans, and added_email to added_phone (spans that the
    method adds); a row for each row of docs (doc_id, text)."""
    small_batches(docs.sparkSession)
    out = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long, n_spans long, added_email long, added_ip long, added_card long, added_phone long"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(_scanned, out)
