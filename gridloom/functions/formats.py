"""Number and date formats of spreadsheets as Columns. A format is known when the plan is made, so nothing is parsed per row.

A format is read into tokens once: literals (quoted, escaped, or any character without a meaning), digit places, and runs of date letters.
What only concerns layout (fills, widths, colours and conditions in brackets) is dropped there.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Weekday signs from Sunday, and the sign after a month's number.
_WEEKDAYS = "日一二三四五六"
_MONTH = "月"


@dataclass
class Token:
    """kind: text, code (a run of one character with a meaning, as lower case) or cut (a semicolon)."""

    kind: str
    text: str


def tokens(fmt: str) -> list[Token]:
    out: list[Token] = []
    chars = iter(fmt)
    for ch in chars:
        if ch == '"':
            out.append(Token("text", "".join(_until(chars, '"'))))
        elif ch == "[":
            "".join(_until(chars, "]"))
        elif ch == "\\":
            out.append(Token("text", next(chars, "")))
        elif ch in "_*":
            next(chars, "")
        elif ch == ";":
            out.append(Token("cut", ch))
        else:
            out.append(Token("code", ch.lower()) if ch.lower() in "0#?.,%ymdhsap/:" else Token("text", ch))
            out[-1].raw = ch
    return out


def _until(chars: Iterator[str], end: str) -> Iterator[str]:
    for ch in chars:
        if ch == end:
            return
        yield ch


def sections(fmt: str) -> list[list[Token]]:
    """The parts between semicolons."""
    out: list[list[Token]] = [[]]
    for t in tokens(fmt):
        if t.kind == "cut":
            out.append([])
        else:
            out[-1].append(t)
    return out


def _said(ts: list[Token]) -> str:
    """What tokens without a part in the number say."""
    return "".join(t.text if t.kind == "text" else getattr(t, "raw", t.text) for t in ts)


def is_date_format(section: list[Token]) -> bool:
    """Years, days or hours make a date format, seconds beside a colon, or months alone."""
    codes = [t.text for t in section if t.kind == "code"]
    if not set(codes).isdisjoint("ydh") or {"s", ":"} <= set(codes):
        return True
    return bool(codes) and set(codes) == {"m"} and not _said([t for t in section if t.kind == "text"]).strip()


def general(x: Column) -> Column:
    """A number as cells without a format show it: whole numbers plain, else ten significant digits without trailing zeros."""
    x = x.cast("double")
    places = F.greatest(F.lit(0), F.lit(9) - F.floor(F.log10(F.abs(x))).cast("int"))
    digits = F.round(x.cast("decimal(38,18)") * F.pow(F.lit(10.0), places).cast("decimal(19,0)"), 0) / F.pow(F.lit(10.0), places).cast("decimal(19,0)")
    shown = F.regexp_replace(F.regexp_replace(digits.cast("string"), r"(\.\d*?)0+$", "$1"), r"\.$", "")
    return F.when((x == F.floor(x)) & (F.abs(x) < 1e11), x.cast("long").cast("string")).when((F.abs(x) < 1e9) & (F.abs(x) >= 1e-9), shown).otherwise(x.cast("string"))


@dataclass
class _Layout:
    """How a section lays a number out: texts around it, least digits of the whole part, grouping, least and most decimals, and the power of ten before it is shown."""

    before: str
    after: str
    whole: int
    grouped: bool
    least: int
    most: int
    power: int


def _layout(section: list[Token]) -> _Layout | None:
    """None of a section without digit places."""
    place = lambda t: t.kind == "code" and t.text in "0#?"
    start = next((i for i, t in enumerate(section) if place(t)), None)
    if start is None:
        return None
    if start and section[start - 1].kind == "code" and section[start - 1].text == ".":
        start -= 1
    end = start
    while end < len(section) and section[end].kind == "code" and section[end].text in "0#?.,":
        end += 1
    body = "".join(t.text for t in section[start:end])
    whole, _, decimals = body.partition(".")
    digits = whole.rstrip(",")
    around = section[:start] + section[end:]
    thousands = len(whole) - len(digits) + decimals.count(",")
    decimals = decimals.replace(",", "")
    percents = sum(t.kind == "code" and t.text == "%" for t in around)
    return _Layout(_said(section[:start]), _said(section[end:]), digits.count("0"), "," in digits, decimals.count("0"), len(decimals), 2 * percents - 3 * thousands)


def _number(x: Column, section: list[Token]) -> Column:
    """A number by one section, its sign before it. Rounds half away from zero."""
    at = _layout(section)
    if at is None:
        return F.lit(_said(section))
    shown = F.round(F.abs(x).cast("decimal(38,12)") * F.lit(10.0**at.power).cast("decimal(18,9)"), at.most)
    whole, decimals = F.split_part(shown.cast("string"), F.lit("."), F.lit(1)), F.rpad(F.split_part(shown.cast("string"), F.lit("."), F.lit(2)), at.most, "0")
    bare = whole
    if at.grouped:
        whole = F.format_number(F.floor(shown), 0)
    whole = F.lpad(whole, F.greatest(F.length(whole), F.lit(at.whole)), F.lit("0"))
    # zeros that need not be shown go from the end of the decimals
    forced, free = F.substring(decimals, 1, at.least), F.rtrim(F.substring(decimals, at.least + 1, at.most), F.lit("0"))
    decimals = F.concat(forced, free)
    if at.most and not at.whole:
        whole = F.when((bare == "0") & (decimals != ""), "").otherwise(whole)
    point = F.when(decimals != "", ".").otherwise("")
    return F.concat(F.when((x < 0) & (shown != 0), "-").otherwise(""), F.lit(at.before), whole, point, decimals, F.lit(at.after))


def number_format(x: Column, fmt: str) -> Column:
    """Sections: positive; negative; zero. A section for negatives shows them without a sign. NULL shows as ''."""
    x = x.cast("double")
    if fmt.strip().lower() in ("", "general", "@"):
        return F.coalesce(general(x), F.lit(""))
    parts = sections(fmt.strip())
    out = F.when(x.isNull(), "")
    if len(parts) > 2:
        out = out.when(x == 0, _number(x, parts[2]))
    if len(parts) > 1:
        out = out.when(x < 0, _number(F.abs(x), parts[1]))
    return out.otherwise(_number(x, parts[0]))


@dataclass
class _Part:
    """A run of one date letter, what stands between, or a fraction of a second."""

    kind: str
    size: int
    text: str = ""


def _date_parts(section: list[Token]) -> list[_Part]:
    runs: list[tuple[str, list[Token]]] = []
    for _, group in groupby(enumerate(section), key=lambda it: (it[1].kind, it[1].text if it[1].kind == "code" and it[1].text in "ymdhs0" else it[0])):
        ts = [t for _, t in group]
        runs.append((ts[0].text if ts[0].kind == "code" else "", ts))
    out: list[_Part] = []
    i = 0
    while i < len(runs):
        code, ts = runs[i]
        ahead = "".join(c * len(t) for c, t in runs[i : i + 5])
        half = next((h for h in ("am/pm", "a/p") if ahead.startswith(h)), None)
        if half:
            out.append(_Part("half", len(half), half))
            i += len([c for c in half if c])
        elif code == "." and i + 1 < len(runs) and runs[i + 1][0] == "0":
            out.append(_Part("fraction", len(runs[i + 1][1])))
            i += 2
        else:
            out.append(_Part(code, len(ts)) if code and code in "ymdhs" else _Part("text", 0, _said(ts)))
            i += 1
    # m is minutes behind hours (or minutes' own seconds) and before seconds
    letters = [p for p in out if p.kind in ("y", "m", "d", "h", "s")]
    for i, p in enumerate(letters):
        before = [q.kind for q in letters[:i] if q.kind != "s"][-1:]
        after = [q.kind for q in letters[i + 1 : i + 2]]
        if p.kind == "m" and p.size <= 2 and (before == ["h"] or after == ["s"]):
            p.text = "minute"
    return out


def date_format(t: Column, fmt: str) -> Column:
    """A timestamp by a date format. Seconds round where the format shows whole ones. NULL shows as ''."""
    parts = _date_parts(sections(fmt)[0])
    fraction = next((p.size for p in parts if p.kind == "fraction"), 0)
    if any(p.kind == "s" for p in parts):
        unit = 10 ** (6 - min(fraction, 6))
        t = F.timestamp_micros((F.floor(F.unix_micros(t.cast("timestamp")) / unit + 0.5) * unit).cast("long"))
    half = any(p.kind == "half" for p in parts)
    numbers = {"y": F.year(t) % 100, "m": F.month(t), "d": F.dayofmonth(t), "h": (F.hour(t) + 11) % 12 + 1 if half else F.hour(t), "s": F.second(t)}

    def shown(p: _Part) -> Column:
        if p.kind == "text":
            return F.lit(p.text)
        if p.kind == "half":
            am, pm = p.text.upper().split("/")
            return F.when(F.hour(t) < 12, am).otherwise(pm)
        if p.kind == "fraction":
            return F.concat(F.lit("."), F.substring(F.date_format(t, "SSSSSS"), 1, p.size))
        if p.kind == "y" and p.size > 2:
            return F.year(t).cast("string")
        if p.kind == "m" and p.size > 2:
            return F.concat(F.month(t).cast("string"), F.lit(_MONTH))
        if p.kind == "d" and p.size > 2:
            return F.substring(F.lit(_WEEKDAYS), F.dayofweek(t), F.lit(1))
        n = F.minute(t) if p.text == "minute" else numbers[p.kind]
        return F.lpad(n.cast("string"), 2, "0") if p.size == 2 or p.kind == "y" else n.cast("string")

    return F.coalesce(F.concat(*map(shown, parts)), F.lit(""))


def from_serial(x: Column) -> Column:
    """A spreadsheet's day number as a timestamp, to the millisecond."""
    return F.timestamp_micros((F.round((x - 25569) * 86_400_000) * 1000).cast("long"))


def display(x: Column, fmt: str, kind: str) -> Column:
    """What a cell shows: kind 'date' for timestamps, 'number' for numbers (day numbers under a date format), else text."""
    if kind == "date":
        return date_format(x, fmt)
    if kind == "number":
        return date_format(from_serial(x), fmt) if is_date_format(sections(fmt)[0]) else number_format(x, fmt)
    return F.coalesce(x.cast("string"), F.lit(""))
