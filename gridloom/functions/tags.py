"""Tags, document numbers, ranges and vendors in prose, as Column builders. Only compatibility normalisation leaves the JVM, and only for texts that are not plain ASCII."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from gridloom.functions.text import all_of, any_of
from gridloom.functions.units import dimension

#: Dashes that word processors write, control pictures, and the shapes of plant codes (unit, core, an item's own suffix, further numbers).
DASHES = "‐‑‒–—―−"
KKS = r"^=?(?:([A-Z])([0-9XY]{2})|([0-9XY]{2}))?([A-Z]{3}[0-9]{2}[A-Z]{2}[0-9]{3})(?:([A-Z]{1,2}|[A-Z][0-9]{1,2})(?![A-Z0-9])|(-[A-Z]{2}[0-9]{2,3})(?![A-Z0-9])|((?:/[0-9]{1,3})+))?$"
UNITS = r"([GCS])(XX|X0)(.*)"
#: Vendors of one group count as one another.
VENDOR_GROUPS = [
    ["rosemount", "emerson", "fisher", "micro motion", "daniel", "topworx", "metso", "neles"],
    ["endress+hauser", "endress hauser", "e+h"],
    ["ge", "bently nevada", "masoneilan", "druck", "baker hughes", "panametrics"],
    ["abb"], ["yokogawa"], ["siemens"], ["vega", "vega grieshaber kg"], ["honeywell", "honeywell analytics"], ["wika"], ["krohne"],
    ["foxboro"], ["flowserve"], ["ytc"], ["pr electronics"], ["magnetrol"], ["samson"], ["azbil"], ["fuji"], ["swan"], ["hach"], ["mettler"],
]


def folded(c: Column) -> Column:
    """Compatibility forms as their plain ones, dashes of any kind as '-'."""

    @F.pandas_udf(StringType())
    def nfkc(s: pd.Series) -> pd.Series:
        return s.map(lambda x: None if x is None else unicodedata.normalize("NFKC", x))

    odd = c.rlike(r"[^\x00-\x7F]")
    plain = F.when(odd, nfkc(F.when(odd, c))).otherwise(c)
    return F.translate(plain, DASHES, "-" * len(DASHES))


def parse_kks(c: Column) -> Column:
    """struct(letter, unit, core, suffix, sequence) of a plant code, NULL of anything else. XX and the like stand for any unit."""
    s = F.regexp_replace(F.upper(folded(c)), r"\s+", "")
    part = lambda i: F.regexp_extract(s, KKS, i)
    made = F.struct(part(1).alias("letter"), F.concat(part(2), part(3)).alias("unit"), part(4).alias("core"), F.concat(part(5), part(6)).alias("suffix"), (part(7) != "").alias("sequence"))
    return F.when(s.rlike(KKS), made)


def expand_units(tag: Column, coverage: Column) -> Column:
    """array of struct(unit, tag): a tag for any unit becomes one for each unit of its letter that the coverage lists, a list of units one for each."""
    t = F.upper(F.trim(tag))
    letter, rest = F.regexp_extract(t, f"^{UNITS}$", 1), F.regexp_extract(t, f"^{UNITS}$", 3)
    listed = F.filter(F.regexp_extract_all(F.upper(F.coalesce(coverage, F.lit(""))), F.lit(r"([GCS][0-9]{2})"), 1), lambda u: F.substring(u, 1, 1) == letter)
    many = r"^((?:[GCS][0-9]{2}/)+[GCS][0-9]{2})(.+)$"
    each = lambda units, tail: F.transform(units, lambda u: F.struct(u.alias("unit"), F.concat(u, tail).alias("tag")))
    own = F.array(F.struct(F.substring(t, 1, 3).alias("unit"), t.alias("tag")))
    return F.when(t.rlike(f"^{UNITS}$"), each(listed, rest)).when(t.rlike(many), each(F.split(F.regexp_extract(t, many, 1), "/"), F.regexp_extract(t, many, 2))).otherwise(own)


def classified(c: Column, families: list[tuple[str, str]]) -> Column:
    """array of struct(token, family): every match of each family's pattern, families in order, a token once for each family."""


    def of(name: str, pattern: str) -> Column:
        return F.transform(F.array_distinct(F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(f"({pattern})"), 1)), lambda t: F.struct(t.alias("token"), F.lit(name).alias("family")))

    return F.flatten(F.array(*(of(*f) for f in families)))


def shorthand(c: Column) -> Column:
    """Tags of one token that names several: LS-3461/3462A/B is LS-3461A, LS-3461B, LS-3462A, LS-3462B, and each number without a letter."""
    shape = r"^([A-Z]{1,4})-([0-9]{2,})((?:/[0-9]{2,})*)([A-Z](?:/[A-Z])*)?$"
    part = lambda i: F.regexp_extract(c, shape, i)
    pieces = lambda s: F.filter(F.split(s, "/"), lambda x: x != "")
    numbers = F.concat(F.array(part(2)), pieces(part(3)))
    letters = F.concat(pieces(part(4)), F.array(F.lit("")))
    made = F.flatten(F.transform(numbers, lambda n: F.transform(letters, lambda x: F.concat(part(1), F.lit("-"), n, x))))
    return F.when(c.rlike(shape), made).otherwise(F.array(c))


def document_numbers(c: Column, pattern: str) -> Column:
    """array of struct(number, revision): the pattern's first and second group at each match, case aside."""
    s = F.upper(F.coalesce(c, F.lit("")))
    return F.transform(F.regexp_extract_all(s, F.lit(f"({pattern})"), 1), lambda m: F.struct(F.regexp_extract(m, pattern, 1).alias("number"), F.regexp_extract(m, pattern, 2).alias("revision")))


_NUMBER = r"[-+]?[0-9][0-9,]*(?:\.[0-9]+)?"
_RANGE = rf"({_NUMBER})\s*(?:~|～|to|…|\.\.\.?)\s*({_NUMBER})\s*([^\s,;:()]*)"


def parse_range(c: Column) -> Column:
    """struct(lo, hi, unit) of 'lo ~ hi unit' in the first part of a list (before ' / ' or '['), NULL where there is none at its beginning."""
    first = F.element_at(F.split(c, r"\s/\s|\["), 1)
    number = lambda i: F.replace(F.regexp_extract(first, rf"^\s*{_RANGE}", i), F.lit(","), F.lit("")).try_cast("double")
    unit = F.regexp_replace(F.regexp_extract(first, rf"^\s*{_RANGE}", 3), r"±.*$", "")
    return F.when(first.rlike(rf"^\s*{_RANGE}"), F.struct(number(1).alias("lo"), number(2).alias("hi"), unit.alias("unit")))


def find_ranges(c: Column, unit: Column, most: int = 3) -> Column:
    """Up to `most` different ranges of a line, as text; those whose unit is of another dimension than the wanted one are left out."""
    found = F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(f"({_RANGE})"), 1)
    parts = F.transform(found, lambda m: F.struct(F.regexp_extract(m, _RANGE, 1).alias("lo"), F.regexp_extract(m, _RANGE, 2).alias("hi"), F.regexp_extract(m, _RANGE, 3).alias("unit")))
    want = dimension(unit)
    fits = F.filter(parts, lambda p: want.isNull() | dimension(p["unit"]).isNull() | (dimension(p["unit"]) == want))
    return F.slice(F.array_distinct(F.transform(fits, lambda p: F.rtrim(F.concat(p["lo"], F.lit(" ~ "), p["hi"], F.lit(" "), p["unit"])))), 1, most)


def visible(c: Column, keep_lines: bool = False) -> Column:
    """Control characters as signs a reader can see; line ends and tabs as they are if asked for."""
    pictures = "".join(chr(i) for i in range(32) if i not in (9, 10, 13)), "".join(chr(0x2400 + i) for i in range(32) if i not in (9, 10, 13))
    s = F.replace(F.translate(c, pictures[0] + "\x7f", pictures[1] + "␡"), F.lit("\r"), F.lit(""))
    return s if keep_lines else F.replace(F.replace(s, F.lit("\n"), F.lit(" ↵ ")), F.lit("\t"), F.lit("⇥"))


def without_controls(c: Column) -> Column:
    """Control characters but line ends and tabs removed."""
    return F.regexp_replace(c, r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]", "")


def vendor(c: Column) -> Column:
    """A vendor's name for comparison: lower case, single blanks, none around a plus."""
    return F.regexp_replace(F.regexp_replace(F.trim(F.lower(F.coalesce(c, F.lit("")))), r"\s*\+\s*", "+"), r"\s+", " ")


def same_vendor(found: Column, master: Column) -> Column:
    """A blank master takes any vendor; otherwise the names are equal, one holds the other, or both begin with members of one group."""
    f, m = vendor(found), vendor(master)
    of = lambda c, group: any_of([c.startswith(g) for g in group])
    return (m == "") | (f == m) | F.contains(f, m) | F.contains(m, f) | any_of([of(f, g) & of(m, g) for g in VENDOR_GROUPS])


def filled(c: Column, pattern: str, value) -> Column:
    """A text with each match of the pattern (one group) replaced by value of that group."""
    between, names = F.split(c, re.sub(r"\((?!\?)", "(?:", pattern), -1), F.regexp_extract_all(c, F.lit(pattern), 1)
    return F.array_join(F.transform(between, lambda b, i: F.concat(b, F.coalesce(F.get(F.transform(F.filter(F.array(F.get(names, i)), lambda n: n.isNotNull()), value), F.lit(0)), F.lit("")))), "")


def expand_variables(c: Column, own: Column, outer: Column, rounds: int = 8) -> Column:
    """{NAME} by an object's own variables, then by those around it (maps with lower-case keys), over and over; names that neither has stay as they are."""
    step = lambda s: filled(s, r"\{([^{}]*)\}", lambda n: F.coalesce(F.try_element_at(own, F.lower(n)), F.try_element_at(outer, F.lower(n)), F.concat(F.lit("{"), n, F.lit("}"))))
    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), c, lambda s, _: F.when(F.contains(s, F.lit("{")), step(s)).otherwise(s))


def expand_points(c: Column) -> Column:
    r"""Points in short: 'AB001\002\3' is 'AB001 AB002 AB003', each number in place of as many last characters."""
    base, more = F.regexp_extract(c, r"^([^\\\s]+)((?:\\[0-9]+)+)$", 1), F.regexp_extract(c, r"^([^\\\s]+)((?:\\[0-9]+)+)$", 2)
    tails = F.filter(F.split(more, r"\\"), lambda t: (t != "") & (F.length(t) < F.length(base)))
    each = F.transform(tails, lambda t: F.concat(F.substring(base, F.lit(1), F.length(base) - F.length(t)), t))
    return F.when(base != "", F.concat_ws(" ", F.concat(F.array(base), each))).otherwise(c)


def placeholders(c: Column, terms: dict[str, str]) -> Column:
    """⟦KEY⟧ by a list of terms; a key that is not in it is an error."""
    table = F.create_map(*(F.lit(x) for kv in terms.items() for x in kv)) if terms else F.create_map().cast("map<string,string>")
    return filled(c, "⟦([^⟧]*)⟧", lambda n: F.coalesce(F.try_element_at(table, n), F.raise_error(F.concat(F.lit("no term "), n)).cast("string")))


def link_row(mode: Column, sheet_row: Column, first: Column) -> Column:
    """Where a link to a sheet's row leads: in a grid the row itself, in a table the data row from 0 (NULL above the data), in a card nowhere."""
    return F.when(mode == "grid", sheet_row).when((mode == "table") & (sheet_row >= first), sheet_row - first)


def link_problem(mode: Column, row: Column, rows: Column) -> Column:
    """What is wrong with a resolved link: 'no sheet', 'row in a card', 'out of range', or NULL. rows: the target's number of rows."""
    outside = F.when(mode == "grid", row.isNull() | (row < 1) | (row > rows)).otherwise((row < 0) | (row >= rows))
    return F.when(mode.isNull(), "no sheet").when((mode == "card") & row.isNotNull(), "row in a card").when((mode != "card") & F.coalesce(outside, F.lit(False)), "out of range")


def relation(tag_letter: Column, tag_unit: Column, letter: Column, unit: Column) -> Column:
    """How a drawing's unit prefix stands to a tag's: exact, neutral (none written, or a placeholder that fits), typical (the twin gas turbine of a block), or NULL: never the same."""
    place = unit.rlike("[XY]")
    fits = all_of([F.substring(unit, i, 1).isin("X", "Y") | (F.substring(unit, i, 1) == F.substring(tag_unit, i, 1)) for i in (1, 2)])
    twin = (tag_letter == "G") & (F.substring(unit, 1, 1) == F.substring(tag_unit, 1, 1)) & all_of([F.substring(u, 2, 1).isin("1", "2") for u in (unit, tag_unit)])
    return F.when((letter != "") & (letter != tag_letter), None).when(unit == "", "neutral").when(place, F.when(fits, "neutral")).when(unit == tag_unit, "exact").when(twin, "typical")


#: How well a relation counts.
RELATION_RANK = {"exact": 0, "neutral": 1, "typical": 2, "loop": 3, "train": 4}


def relation_rank(c: Column) -> Column:
    return F.try_element_at(F.create_map(*(F.lit(x) for kv in RELATION_RANK.items() for x in kv)), c)
