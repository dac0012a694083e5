"""Physical units: parsing, conversion and comparison of ranges, as expressions over small tables of units."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Kilopascals and metres that a unit stands for, other names of units, reference conditions that are left out, one atmosphere.
PRESSURE = {"pa": 0.001, "kpa": 1.0, "mpa": 1000.0, "mbar": 0.1, "bar": 100.0, "psi": 6.894757, "mmh2o": 0.00980665, "inh2o": 0.24884, "inhg": 3.38639, "mmhg": 0.133322, "kg/cm2": 98.0665}
LENGTH = {"mm": 0.001, "cm": 0.01, "m": 1.0, "in": 0.0254, "ft": 0.3048}
TEMPERATURE = {"degc": "c", "c": "c", "deg.c": "c", "degreec": "c", "degc.": "c", "degf": "f", "f": "f", "k": "k", "degk": "k", "kelvin": "k"}
PERCENT = ("%", "percent", "pct")
CONDITIONS = r"\((?:68degf|20degc|4degc|0degc|60degf)\)|@\d+degc"
NONE = ("", "未使用", "—", "-")
NO_GAUGE = ("inhg", "mmhg")
NO_ABSOLUTE = ("mmh2o", "inh2o", "inhg", "mmhg", "kg/cm2")
ATMOSPHERE = 101.325


def let(c: Column, f) -> Column:
    """f of a column that is computed once, however often f names it."""
    return F.transform(F.array(c), f)[0]


def _table(rows: dict[str, tuple[str, str, str, float]], key: Column) -> Column:
    return F.try_element_at(F.create_map(*(F.lit(x) if isinstance(x, str) else F.struct(F.lit(x[0]).alias("dim"), F.lit(x[1]).alias("core"), F.lit(x[2]).alias("qual"), F.lit(x[3]).alias("factor")) for kv in rows.items() for x in kv)), key)


def _known() -> dict[str, tuple[str, str, str, float]]:
    """Every spelling of a known unit: gauge, absolute and differential pressure may be written behind it."""
    out = {name: ("T", core, "", 1.0) for name, core in TEMPERATURE.items()} | {name: ("%", "%", "", 1.0) for name in PERCENT} | {name: ("L", name, "", x) for name, x in LENGTH.items()}
    for name, x in PRESSURE.items():
        for qual, barred in (("g", NO_GAUGE), ("a", NO_ABSOLUTE), ("d", ())):
            if name not in barred:
                out[name + qual] = ("P", name, qual, x)
    return out | {name: ("P", name, "", x) for name, x in PRESSURE.items()}


def parse(unit: Column) -> Column:
    """struct(dim T/P/L/%/other, core, qual '', g, a or d, factor to the base); NULL of a blank. Unknown units are their own dimension."""
    s = F.trim(unit)
    chinese = s.rlike("[一-鿿]")
    s = F.when(chinese & s.contains(" "), F.element_at(F.split(s, r"\s+"), -1)).when(chinese, F.regexp_replace(s, "[一-鿿/]+", "")).otherwise(s)
    low = F.regexp_replace(F.lower(F.translate(F.regexp_replace(s, "[°º]", "deg"), "³²₂", "322")), " ", "")
    made = let(F.regexp_replace(low, CONDITIONS, ""), lambda x: let(_parted(x), _named))
    return F.when(unit.isNull() | F.trim(unit).isin(*NONE), None).otherwise(made)


def _parted(low: Column) -> Column:
    """struct(bare, qual) of a unit with a letter in brackets or behind a dash."""
    behind = r"^(.*?)(?:\(([gad])\)|-([gad]))$"
    part = lambda i: F.regexp_extract(low, behind, i)
    return F.when(low.rlike(behind), F.struct(part(1).alias("bare"), F.concat(part(2), part(3)).alias("qual"))).otherwise(F.struct(low.alias("bare"), F.lit("").alias("qual")))


def _named(x: Column) -> Column:
    bare, qual = x["bare"], x["qual"]
    # a pressure without a letter behind takes the one in brackets
    known = let(_table(_known(), bare), lambda k: F.when(k.isNull(), None).otherwise(F.struct(k["dim"].alias("dim"), k["core"].alias("core"), F.when((k["dim"] == "P") & (k["qual"] == ""), qual).otherwise(k["qual"]).alias("qual"), k["factor"].alias("factor"))))
    other = F.struct(F.lit("other").alias("dim"), F.replace(bare, F.lit("hr"), F.lit("h")).alias("core"), F.when(bare == "%lel", "").otherwise(qual).alias("qual"), F.lit(1.0).alias("factor"))
    return F.coalesce(known, other)


def dimension(unit: Column) -> Column:
    return parse(unit)["dim"]


def to_base(x: Column, u: Column) -> Column:
    """A value of a parsed unit in kPa, metres, degrees Celsius, or as it is."""
    return F.when(u["dim"] != "T", x * u["factor"]).when(u["core"] == "f", (x - 32.0) * 5.0 / 9.0).when(u["core"] == "k", x - 273.15).otherwise(x)


def from_base(x: Column, u: Column) -> Column:
    return F.when(u["dim"] != "T", x / u["factor"]).when(u["core"] == "f", x * 9.0 / 5.0 + 32.0).when(u["core"] == "k", x + 273.15).otherwise(x)


def convert(x: Column, unit: Column, to: Column) -> Column:
    """NULL where the units are of different dimensions, or different and unknown."""

    def converted(u: Column) -> Column:
        a, b = u["a"], u["b"]
        return F.when((a["dim"] == b["dim"]) & (a["core"] == b["core"]), u["x"]).when((a["dim"] == b["dim"]) & (a["dim"] != "other"), from_base(to_base(u["x"], a), b))

    return let(F.struct(parse(unit).alias("a"), parse(to).alias("b"), x.cast("double").alias("x")), converted)


def compare_range(lo1: Column, hi1: Column, u1: Column, lo2: Column, hi2: Column, u2: Column, presumed: Column | None = None, low: Column | None = None, high: Column | None = None) -> Column:
    """ok, near, mismatch, unit_mismatch or unit_unknown of a range against a baseline (the first three columns).

    The tolerance is half a percent of the baseline's span. Equal units are ok only where seven digits agree, near within the tolerance; converted
    values are ok within it. An end that either side lacks, or that low or high rule out, is not compared. Absolute against gauge or
    differential pressure is a unit_mismatch, as is a difference of one atmosphere where one side says absolute and the other nothing. A presumed unit is unknown.
    """
    low, high = (F.lit(True) if c is None else F.coalesce(c, F.lit(True)) for c in (low, high))
    ends = lambda *cs: F.struct(*(F.coalesce(c, F.lit(None)).cast("double").alias(n) for n, c in zip(("lo1", "hi1", "lo2", "hi2"), cs, strict=True)), low.alias("low"), high.alias("high"))
    given = F.struct(parse(u1).alias("a"), parse(u2).alias("b"), ends(lo1, hi1, lo2, hi2).alias("x"), (F.lit(False) if presumed is None else F.coalesce(presumed, F.lit(False))).alias("presumed"))
    return let(given, lambda g: let(F.struct(g.alias("g"), _converted(g).alias("y")), _judged))


def _converted(g: Column) -> Column:
    """struct(same, lo, hi) of the second range in the first's unit, with its tolerance."""
    a, b, x = g["a"], g["b"], g["x"]
    same = (a["dim"] == b["dim"]) & (a["core"] == b["core"])
    to = lambda v: F.when(same, v).otherwise(from_base(to_base(v, b), a))
    span = F.abs(F.coalesce(x["hi1"], F.lit(0.0)) - F.coalesce(x["lo1"], F.lit(0.0)))
    return F.struct(same.alias("same"), to(x["lo2"]).alias("lo"), to(x["hi2"]).alias("hi"), span.alias("span"))


def _judged(s: Column) -> Column:
    from gridloom.functions.text import significant7

    g, y = s["g"], s["y"]
    a, b, x = g["a"], g["b"], g["x"]
    has = lambda q: (a["qual"] == q) | (b["qual"] == q)
    off = lambda v, w, by: F.coalesce(F.abs(v - w) > by, F.lit(False))
    bad = lambda lo, hi, by: (x["low"] & off(lo, x["lo1"], by)) | (x["high"] & off(hi, x["hi1"], by))
    other = (a["dim"] != b["dim"]) | ((a["dim"] == "other") & (a["core"] != b["core"]))
    unsaid = (a["dim"] == "P") & has("a") & has("")
    shift = F.lit(ATMOSPHERE) / a["factor"] * F.when(b["qual"] == "a", -1.0).otherwise(1.0)
    shifted = ~bad(y["lo"] + shift, y["hi"] + shift, F.greatest(y["span"] * 0.02, F.lit(2.0) / a["factor"]))
    apart = lambda v, w: F.coalesce(significant7(v) != significant7(w), F.lit(False))
    digits = (x["low"] & apart(y["lo"], x["lo1"])) | (x["high"] & apart(y["hi"], x["hi1"]))
    out = F.when(a.isNull() | b.isNull() | g["presumed"], "unit_unknown").when(other | (has("a") & (has("g") | has("d"))), "unit_mismatch")
    wrong = bad(y["lo"], y["hi"], F.greatest(y["span"] * 0.005, F.lit(1e-9)))
    return out.when(wrong, F.when(unsaid & shifted, "unit_mismatch").otherwise("mismatch")).when(y["same"] & digits, "near").otherwise("ok")
