"""Scalar text functions of the asset workbench as Column builders; nothing here leaves the JVM."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Full-width forms and their ASCII counterparts.
_WIDE = "".join(chr(c) for c in range(0xFF01, 0xFF5F)) + "　"
_NARROW = "".join(chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)) + " "
NUMERIC = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def is_blank(c: Column) -> Column:
    return c.isNull() | (c.cast("string") == "")


def norm(c: Column) -> Column:
    """Full width to half width, no '=', white space collapsed, trimmed, upper case."""
    return F.upper(F.trim(F.regexp_replace(F.replace(F.translate(c, _WIDE, _NARROW), F.lit("="), F.lit("")), r"\s+", " ")))


def compact(c: Column) -> Column:
    return F.regexp_replace(norm(c), "[^A-Z0-9]", "")


def confusable(c: Column) -> Column:
    """Letters that readers take for digits, as those digits."""
    return F.translate(c, "SOQILBZ", "5001182")


def natural_key(c: Column) -> Column:
    """Lower case; runs of digits lose leading zeros and are padded to 14 (longer ones stay)."""
    parts = F.regexp_extract_all(F.lower(c), F.lit(r"([0-9]+|[^0-9]+)"), 1)

    def part(p: Column) -> Column:
        bare = F.regexp_replace(p, "^0+", "")
        return F.when(p.rlike("^[0-9]"), F.when(F.length(bare) >= 14, bare).otherwise(F.lpad(bare, 14, "0"))).otherwise(p)

    return F.array_join(F.transform(parts, part), "")


def number_of(c: Column) -> Column:
    """A number or strictly numeric text as a double, else NULL ('1d' and 'NaN' are not numbers)."""
    s = c.cast("string")
    return F.when(s.rlike(NUMERIC), F.trim(s).try_cast("double"))


#: Texts that a spreadsheet would turn into other numbers or dates when it opens a CSV file.
_SPOILED = [r"^0\d+$", r"^\d+[eE][+-]?\d+$", r"^\d{16,}$", r"^\d{1,4}([-/])\d{1,2}(?:\1\d{1,4})?(?:[ T]\d{1,2}:\d{2}(?::\d{2}(?:\.\d+)?)?)?$", r"^\d{1,4}\.\d{1,2}\.\d{1,4}$", r"^\d{1,2}:\d{2}(?::\d{2}(?:\.\d+)?)?$"]


def csv_safe(c: Column, is_text: bool = True) -> Column:
    """A CSV field. Text that a spreadsheet would run as a formula gets a quote before it, text that it would turn into another number or a date is
    written as ="..."; quoted where it holds quotes, commas or line ends or has white space at an end. Numbers and logical values go as they are."""
    if not is_text:
        return F.coalesce(F.upper(c.cast("string")) if is_text is None else c.cast("string"), F.lit(""))
    s = F.when(c.rlike(r"^[=+\-@]"), F.concat(F.lit("'"), c)).otherwise(c)
    quoted = F.concat(F.lit('"'), F.replace(s, F.lit('"'), F.lit('""')), F.lit('"'))
    spoiled = any_of([c.rlike(p) for p in _SPOILED])
    return F.when(spoiled, F.concat(F.lit('"=""'), c, F.lit('"""'))).when(s.rlike('[",\r\n]') | s.rlike(r"^\s|\s$"), quoted).otherwise(F.coalesce(s, F.lit("")))


def csv_row(df: DataFrame) -> Column:
    """The columns of a row as one CSV line, each by its type."""
    return F.concat_ws(",", *(csv_safe(F.col(f"`{n}`") if t == "string" else F.col(f"`{n}`").cast("string"), True if t in ("string", "date") or t.startswith("timestamp") else None if t == "boolean" else False) for n, t in df.dtypes))


def ipv4(c: Column) -> Column:
    """Signed 32-bit integer to a dotted quad; -1 and NULL to NULL."""
    x = c.cast("long")
    return F.when(x != -1, F.concat_ws(".", *(F.shiftright(x, s).bitwiseAND(F.lit(255).cast("long")).cast("string") for s in (24, 16, 8, 0))))


def flags(c: Column, names: list[str]) -> Column:
    """Names of the bits that are set, lowest first."""
    return F.array_join(F.array_compact(F.array(*(F.when(F.shiftright(c.cast("long"), i).bitwiseAND(F.lit(1).cast("long")) == 1, F.lit(n)) for i, n in enumerate(names)))), ",")


#: Fixed value: a unit's prefix, repeated or not.
UNIT_PREFIX = r"^(?:[GCS](?:XX|X0|\d\d))+"


def core_of(c: Column) -> Column:
    """A tag without its unit prefixes."""
    return F.regexp_replace(c, UNIT_PREFIX, "")


def canonical_id(c: Column) -> Column:
    """No white space, no leading zeros before a digit."""
    return F.regexp_replace(F.regexp_replace(c, r"\s+", ""), r"^0+(?=\d)", "")


def scrub_paths(c: Column) -> Column:
    """Local paths cut to their last part."""
    return F.regexp_replace(c, r"(?:[A-Za-z]:\\|\\\\)(?:[^\\\s]+\\)*", "")


def safety_stock(quantity: Column) -> Column:
    return F.when(quantity.isNotNull(), F.greatest(F.lit(1), F.ceil(quantity / 4).cast("int")))


def first_match(c: Column, patterns: list[str]) -> Column:
    """The first of an ordered list of patterns that matches."""
    return F.coalesce(*(F.nullif(F.regexp_extract(c, p, 0), F.lit("")) for p in patterns))


def whole_word(c: Column, term: str) -> Column:
    """Case-insensitive, not next to letters or digits."""
    import re

    return c.rlike(rf"(?i)(?<![A-Za-z0-9]){re.escape(term)}(?![A-Za-z0-9_-])")


def excerpt(c: Column, term: str, width: int = 150) -> Column:
    """The line that holds the term, white space collapsed, cut to width around it."""
    import re

    line = F.regexp_replace(F.regexp_extract(c, rf"(?i)[^\n]*{re.escape(term)}[^\n]*", 0), r"\s+", " ")
    at = F.locate(term.lower(), F.lower(line))
    start = F.greatest(F.lit(1), at - (width - len(term)) // 2)
    return F.substring(line, start, F.lit(width))


def significant7(c: Column) -> Column:
    """Seven significant digits as text, without trailing zeros; with an exponent from 1e7 on and below 1e-4. The value as stored is rounded, halves to even: a pattern does so, for whole numbers only as long, and %e doesn't. Below 1e-316 the digits are the fewest that name the value."""
    shown = lambda x: F.call_function("format_number", x, F.lit("0.000000E0"))
    whole = lambda x: x.try_cast("long")
    return F.transform(F.array(c.cast("double")), lambda x: F.transform(F.array(F.when(whole(x).cast("double") == x, shown(whole(x))).otherwise(shown(x))), lambda s: _seven(x, s))[0])[0]


def _seven(x: Column, shown: Column) -> Column:
    power = F.regexp_extract(shown, r"E(-?\d+)$", 1).try_cast("int")
    bare = lambda s: F.regexp_replace(F.regexp_replace(s, r"(\.\d*?)0+$", "$1"), r"\.$", "")
    mantissa = bare(F.regexp_extract(shown, r"^(-?[\d.]+)E", 1))
    with_power = F.concat(mantissa, F.lit("e"), F.when(power < 0, "-").otherwise("+"), F.lpad(F.abs(power).cast("string"), 2, "0"))
    short = F.abs(power).cast("string")
    with_power = F.when(F.length(short) > 2, F.concat(mantissa, F.lit("e"), F.when(power < 0, "-").otherwise("+"), short)).otherwise(with_power)
    return F.when(x == 0, "0").when((power < -4) | (power >= 7), with_power).when(x.isNotNull(), bare(shown.try_cast("decimal(38,18)").cast("string")))


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))
