"""Spreadsheet formulas as Columns: a formula for a row of a table becomes one expression, and what it asks of whole columns one aggregation.

A1-style references name the table's columns by position, on the row itself; A:A is the whole column. [name] names a column.
Types are known from the schema, so coercion is settled when the plan is made. A blank is 0 among numbers and '' among texts; errors
are NULL, and IFERROR and ISERROR see them. Comparison puts numbers before texts before logical values, texts case aside.
"""

from __future__ import annotations

import re
from functools import reduce
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from gridloom.functions import sheet
from gridloom.functions.formats import general
from gridloom.functions.predicates import criterion
from gridloom.functions.text import number_of
from gridloom.operators.entities import numbered, running
from gridloom.session import kept

_LEXEME = re.compile(r"""\s*(?:(?P<text>"(?:[^"]|"")*")|(?P<call>[A-Za-z][\w.]*)\(|(?P<whole>\$?[A-Z]{1,3}:\$?[A-Z]{1,3})|(?P<cell>\$?[A-Z]{1,3}\$?\d+)
|\[(?P<name>[^\]]+)\]|(?P<number>(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?)|(?P<logical>TRUE|FALSE)\b|(?P<sign><>|<=|>=|[-+*/^&=<>%(),]))""", re.X)
_BINDING = {"=": 1, "<>": 1, "<": 1, ">": 1, "<=": 1, ">=": 1, "&": 2, "+": 3, "-": 3, "*": 4, "/": 4, "^": 5}


@dataclass
class Value:
    """An expression, its kind (number, text, logical, date, blank) and whether NULL means blank (a reference) or an error."""

    c: Column
    kind: str
    blank: bool = False
    literal: object = None
    #: Of an operator joined with a value, such as ">"&A1: both.
    compare: tuple | None = None

    def number(self) -> Column:
        if self.kind == "text":
            n = number_of(self.c)
            return F.when(self.c.isNull(), 0.0).otherwise(n) if self.blank else n
        n = sheet.serial(self.c).cast("double") if self.kind == "date" else self.c.cast("double")
        return F.coalesce(n, F.lit(0.0)) if self.blank else n

    def text(self) -> Column:
        s = general(self.number()) if self.kind in ("number", "date") else F.upper(self.c.cast("string")) if self.kind == "logical" else self.c
        return F.when(self.c.isNull(), "").otherwise(s) if self.blank else s

    def logical(self) -> Column:
        if self.kind == "text":
            return F.when(F.upper(self.c) == "TRUE", True).when(F.upper(self.c) == "FALSE", False)
        return self.c if self.kind == "logical" else self.number() != 0


@dataclass
class _Plan:
    """What the formula asks of whole columns: aggregates by name, counts by keys among rows of a kind, and values at the first equal row."""

    df: DataFrame
    totals: dict[str, Column] = field(default_factory=dict)
    counts: list[tuple[str, list[tuple[str, Column]], Column | None]] = field(default_factory=list)
    lookups: list[tuple[str, str, str, Column]] = field(default_factory=list)
    compares: list[tuple[str, str, str, Column]] = field(default_factory=list)
    numbers: list[tuple[str, Column, str]] = field(default_factory=list)
    sorted: list[tuple[str, str, Column, int]] = field(default_factory=list)
    rows: bool = False

    def column(self, name: str) -> Value:
        t = dict(self.df.dtypes)[name]
        kind = "logical" if t == "boolean" else "text" if t == "string" else "date" if t in ("date", "timestamp") else "number"
        return Value(F.col(f"`{name}`"), kind, blank=True)

    def at(self, letters: str) -> str:
        n = 0
        for ch in letters.replace("$", ""):
            n = n * 26 + ord(ch) - 64
        if n > len(self.df.columns):
            raise ValueError(f"no column {letters}")
        return self.df.columns[n - 1]

    def total(self, agg: Column, kind: str = "number") -> Value:
        name = f"_total{len(self.totals)}"
        self.totals[name] = agg
        return Value(F.col(name), kind)


@dataclass
class _Found:
    """The first row whose column equals a value; INDEX reads it."""

    name: str
    key: Column


class _Reader:
    def __init__(self, source: str, plan: _Plan):
        self.plan, self.tokens = plan, []
        at, source = 0, source.strip().removeprefix("=").rstrip()
        while at < len(source):
            m = _LEXEME.match(source, at)
            if not m:
                raise SyntaxError(f"cannot read {source[at:]!r}")
            self.tokens.append((m.lastgroup, m.group(m.lastgroup)))
            at = m.end()
        self.tokens.append(("end", ""))
        self.i = 0

    def take(self, sign: str | None = None) -> tuple[str, str]:
        kind, s = self.tokens[self.i]
        if sign and s != sign:
            raise SyntaxError(f"expected {sign}, found {s!r}")
        self.i += 1
        return kind, s

    def next_is(self, *signs: str) -> bool:
        kind, s = self.tokens[self.i]
        return kind == "sign" and s in signs

    def expression(self, least: int = 1) -> Value:
        v = self.operand()
        while True:
            kind, s = self.tokens[self.i]
            if self.next_is("%"):
                self.take()
                v = Value(v.number() / 100, "number")
            elif kind == "sign" and _BINDING.get(s, 0) >= least:
                self.take()
                v = _binary(s, v, self.expression(_BINDING[s] + 1))
            else:
                return v

    def operand(self) -> Value:
        if self.next_is("-", "+"):
            _, s = self.take()
            v = self.operand()
            return Value(-v.number(), "number", literal=-v.literal if isinstance(v.literal, float) else None) if s == "-" else v
        kind, s = self.take()
        if kind == "number":
            return Value(F.lit(float(s)), "number", literal=float(s))
        if kind == "text":
            s = s[1:-1].replace('""', '"')
            return Value(F.lit(s), "text", literal=s)
        if kind == "logical":
            return Value(F.lit(s == "TRUE"), "logical", literal=s == "TRUE")
        if kind == "cell":
            return self.plan.column(self.plan.at(re.match(r"\$?[A-Z]+", s).group()))
        if kind == "name":
            return self.plan.column(s)
        if kind == "call":
            return self.call(s.upper())
        if s == "(":
            v = self.expression()
            self.take(")")
            return v
        raise SyntaxError(f"unexpected {s!r}")

    def call(self, name: str) -> Value:
        args: list = []
        while not self.next_is(")"):
            if self.next_is(","):
                args.append(Value(F.lit(None), "blank"))
            elif self.tokens[self.i][0] == "whole":
                args.append(self.plan.at(self.take()[1].split(":")[0]))
            else:
                args.append(self.expression())
            if not self.next_is(")"):
                self.take(",")
        self.take(")")
        if name == "MATCH":
            return _match(self.plan, *args)
        if name in _CELLS:
            return _cells(self.plan, name, args)
        if name in _WHOLE and args and isinstance(args[0], str):
            return _WHOLE[name](self.plan, *args)
        if name not in _CALLS:
            raise NotImplementedError(name)
        return _CALLS[name](*args)


def _binary(s: str, a: Value, b: Value) -> Value:
    if s == "&":
        sign = a.literal if a.literal in _COMPARE else None
        return Value(F.concat(a.text(), b.text()), "text", compare=(sign, b.number()) if sign else None)
    if s in _ARITHMETIC:
        return Value(_ARITHMETIC[s](a.number(), b.number()), "number")
    # a blank takes the other side's kind
    rank = {"number": 0, "date": 0, "blank": 0, "text": 1, "logical": 2}
    if rank[a.kind] != rank[b.kind]:
        fixed = F.lit(_COMPARE[s](rank[a.kind], rank[b.kind]))
        for one, other in ((a, b), (b, a)):
            if one.blank:
                empty = Value(F.lit(""), "text") if other.kind == "text" else Value(F.lit(False), "logical") if other.kind == "logical" else Value(F.lit(0.0), "number")
                fixed = F.when(one.c.isNull(), _binary(s, empty, other).c if one is a else _binary(s, other, empty).c).otherwise(fixed)
        return Value(fixed, "logical")
    how = {0: Value.number, 1: lambda v: F.lower(v.text()), 2: Value.logical}[rank[a.kind]]
    return Value(_COMPARE[s](how(a), how(b)), "logical")


_ARITHMETIC = {"+": lambda x, y: x + y, "-": lambda x, y: x - y, "*": lambda x, y: x * y, "/": F.try_divide, "^": F.pow}
_COMPARE = {"=": lambda x, y: x == y, "<>": lambda x, y: x != y, "<": lambda x, y: x < y, ">": lambda x, y: x > y, "<=": lambda x, y: x <= y, ">=": lambda x, y: x >= y}


def _if(test: Value, then: Value, other: Value | None = None) -> Value:
    other = other or Value(F.lit(False), "logical", literal=False)
    t = test.logical()
    if then.kind == other.kind:
        return Value(F.when(t.isNull(), None).when(t, then.c).otherwise(other.c), then.kind, then.blank or other.blank)
    # branches of two kinds meet as text
    return Value(F.when(t.isNull(), None).when(t, then.text()).otherwise(other.text()), "text")


def _iferror(v: Value, other: Value) -> Value:
    if v.blank:
        return v
    return Value(F.coalesce(v.c, other.c), v.kind) if v.kind == other.kind else Value(F.coalesce(v.text(), other.text()), "text")


def _number(f):
    return lambda *a: Value(f(*(v.number() for v in a)).cast("double"), "number")


def _part(f):
    """A function of a text and whole numbers that may be computed."""
    return lambda s, *n: Value(f(s.text(), *(F.floor(v.number()).cast("int") for v in n)), "text")


def _left(s: Column, n: Column | None = None) -> Column:
    n = F.lit(1) if n is None else n
    return F.when(n >= 0, F.substring(s, F.lit(1), n))


def _right(s: Column, n: Column | None = None) -> Column:
    n = F.lit(1) if n is None else n
    return F.when(n == 0, "").when(n > 0, F.right(s, n))


def _substitute(s: Value, old: Value, new: Value, nth: Value | None = None) -> Value:
    if nth is None:
        return Value(F.replace(s.text(), old.text(), new.text()), "text")
    return Value(sheet.substitute(s.text(), old.literal, new.literal, int(nth.literal)), "text")


def _year(part):
    return lambda v: Value(part(v.c if v.kind == "date" else F.date_add(F.lit("1899-12-30").cast("date"), F.floor(v.number()).cast("int"))).cast("double"), "number")


def _is(test) -> object:
    return lambda v: Value(test(v), "logical")


_CALLS = {
    "IF": _if,
    "IFERROR": _iferror,
    "AND": lambda *a: _logicals(a, True),
    "OR": lambda *a: _logicals(a, False),
    "NOT": lambda v: Value(~v.logical(), "logical"),
    "ISNUMBER": _is(lambda v: v.c.isNotNull() if v.kind in ("number", "date") else F.lit(False)),
    "ISTEXT": _is(lambda v: v.c.isNotNull() if v.kind == "text" else F.lit(False)),
    "ISBLANK": _is(lambda v: v.c.isNull() if v.blank else F.lit(False)),
    "ISERROR": _is(lambda v: F.lit(False) if v.blank else v.c.isNull()),
    "ROUND": lambda v, n: _round(v, n),
    "INT": _number(F.floor),
    "ABS": _number(F.abs),
    "TRIM": lambda v: Value(sheet.trim(v.text()), "text"),
    "UPPER": lambda v: Value(F.upper(v.text()), "text"),
    "LOWER": lambda v: Value(F.lower(v.text()), "text"),
    "LEN": lambda v: Value(F.length(v.text()).cast("double"), "number"),
    "LEFT": _part(_left),
    "RIGHT": _part(_right),
    "MID": _part(lambda s, i, n: F.when((i >= 1) & (n >= 0), F.substring(s, i, n))),
    "SUBSTITUTE": _substitute,
    "SEARCH": lambda n, s, at=None: _position(lambda rest: F.regexp_instr(rest, F.lit("(?is)" + _loose(n.literal))), s, at),
    "FIND": lambda n, s, at=None: _position(lambda rest: F.instr(rest, n.text()), s, at),
    "YEAR": _year(F.year),
    "MONTH": _year(F.month),
    "DAY": _year(F.dayofmonth),
    "DATE": lambda y, m, d: Value(sheet.date(y.number().cast("int"), m.number().cast("int"), d.number().cast("int")), "date"),
    "VALUE": lambda v: Value(v.number(), "number"),
    "CONCATENATE": lambda *a: Value(F.concat(*(v.text() for v in a)), "text"),
    "TRUE": lambda: Value(F.lit(True), "logical"),
    "FALSE": lambda: Value(F.lit(False), "logical"),
    "HYPERLINK": lambda to, label=None: label or to,
}


def _logicals(args: tuple, every: bool) -> Value:
    """AND (every) or OR: texts and blanks in references are left out; with nothing left it is an error."""
    parts = [v.c if v.kind == "logical" else v.c.cast("double") != 0 if v.blank and v.kind == "number" else v.logical() for v in args if not (v.blank and v.kind == "text")]
    if not parts:
        return Value(F.lit(None).cast("boolean"), "logical")
    literal = [v for v in args if not v.blank]
    said = F.coalesce(*parts).isNotNull()
    failed = [v.logical().isNull() for v in literal]  # an error of a computed argument is the result's
    out = F.lit(every)
    for c in parts:
        out = out & F.coalesce(c, F.lit(True)) if every else out | F.coalesce(c, F.lit(False))
    bad = F.lit(False)
    for c in failed:
        bad = bad | c
    return Value(F.when(said & ~bad, out), "logical")


def _round(v: Value, n: Value) -> Value:
    """Half away from zero; the digits may be computed (whole numbers from -9 to 12)."""
    x = v.number().cast("decimal(38,15)")
    if n.literal is not None:
        return Value(F.round(x, int(n.literal)).cast("double"), "number")
    digits = n.number()
    digits = F.when(digits < 0, F.ceil(digits)).otherwise(F.floor(digits))
    out = F
    for k in range(-9, 13):
        out = out.when(digits == k, F.round(x, k).cast("double"))
    return Value(out, "number")


def _position(find, s: Value, at: Value | None) -> Value:
    """Where something is found in a text from a place on; an error where it is not, or the place lies outside."""
    if at is None:
        return Value(F.nullif(find(s.text()), F.lit(0)).cast("double"), "number")
    start = F.floor(at.number()).cast("int")
    found = find(F.substring(s.text(), start, F.length(s.text())))
    return Value(F.when((start >= 1) & (start <= F.length(s.text()) + 1) & (found > 0), found + start - 1).cast("double"), "number")


def _loose(pattern: str) -> str:
    """A pattern with * ? ~ as a regex, not anchored."""
    from gridloom.functions.predicates import wildcard

    return wildcard(pattern).removeprefix("(?is)^").removesuffix("$")


def _fixed(name: str, want: Value) -> Column:
    c = want.literal
    return criterion(f"{c:g}" if isinstance(c, float) else str(c), F.col(f"`{name}`"))


def _countif(plan: _Plan, *pairs) -> Value:
    """COUNTIF and COUNTIFS: rows that meet every criterion. Literal criteria hold for all rows; computed ones are equality with this row's value, or, one alone
    and written as an operator & a value, comparison with it. A computed criterion that turns out to hold an operator or wildcards is an error, not a count of 0."""
    pairs = list(zip(pairs[::2], pairs[1::2], strict=True))
    fixed = [_fixed(n, v) for n, v in pairs if v.literal is not None]
    where = None
    for c in fixed:
        where = c if where is None else where & c
    compared = [(n, v) for n, v in pairs if v.compare]
    if compared:
        if len(pairs) > 1:
            raise NotImplementedError("a computed comparison beside other criteria")
        (n, v), = compared
        out = f"_count{len(plan.counts) + len(plan.compares)}"
        plan.compares.append((out, n, *v.compare))
        return Value(F.coalesce(F.col(out), F.lit(0)), "number")
    plain = lambda v: v.text() if v.kind != "text" else F.when(v.text().rlike(r"^(<>|>=|<=|=|>|<)|[*?~]"), F.raise_error(F.concat(F.lit("computed criterion: "), v.text()))).otherwise(v.text())
    keys = [(n, F.lower(plain(v))) for n, v in pairs if v.literal is None]
    if not keys:
        return plan.total(F.count_if(where))
    out = f"_count{len(plan.counts)}"
    plan.counts.append((out, keys, where))
    return Value(F.coalesce(F.col(out), F.lit(0)), "number")


def _sumproduct(plan: _Plan, *names: str) -> Value:
    """Products of the columns' numbers row by row, added up; what is no number counts as 0. Decimals, so the order of rows does not matter."""
    parts = []
    for n in names:
        v = plan.column(n)
        parts.append(F.coalesce(v.c.try_cast("decimal(18,6)"), F.lit(0).cast("decimal(18,6)")) if v.kind == "number" else F.lit(0).cast("decimal(18,6)"))
    out = parts[0]
    for c in parts[1:]:
        out = (out * c).cast("decimal(28,6)")
    return plan.total(F.coalesce(F.sum(out), F.lit(0)))


def _index(plan: _Plan, name: str, found: _Found) -> Value:
    if isinstance(found, Value):
        # a row by its number; outside of the table it is an error
        out = f"_number{len(plan.numbers)}"
        plan.rows = True
        at = F.floor(found.number()).cast("long")
        plan.numbers.append((out, at, name))
        return Value(F.col(out), plan.column(name).kind)
    out = f"_found{len(plan.lookups)}"
    plan.lookups.append((out, name, found.name, found.key))
    # no such row is an error; a blank cell there reads as blank, which IFERROR takes for an error too
    return Value(F.col(out), plan.column(name).kind)


def _match(plan: _Plan, want: Value, name: str, how: Value | None = None) -> _Found | Value:
    if how is not None and how.literal == 0.0:
        return _Found(name, F.lower(want.text()))
    if plan.column(name).kind not in ("number", "date") or (how is not None and how.literal is None):
        raise NotImplementedError("MATCH in sorted columns of texts, or of a computed kind")
    at = f"_sorted{len(plan.sorted)}"
    plan.rows = True
    plan.sorted.append((at, name, want.number(), -1 if how is not None and how.literal < 0 else 1))
    return Value(F.col(at), "number")


_WHOLE = {
    "COUNTIF": _countif,
    "COUNTIFS": _countif,
    "COUNT": lambda p, n: p.total(F.count(F.col(f"`{n}`")) if p.column(n).kind in ("number", "date") else F.lit(0)),
    "SUMPRODUCT": _sumproduct,
    "INDEX": _index,
    "COUNTA": lambda p, n: p.total(F.count(F.col(f"`{n}`"))),
}


#: Functions of cells and whole columns together.
_CELLS = ("SUM", "AVERAGE", "MIN", "MAX")


def _cells(plan: _Plan, name: str, args: list) -> Value:
    """SUM, AVERAGE, MIN or MAX of whole columns, cells and values. Texts and blanks in cells and columns are left out."""
    sums, counts, ends = [], [], []
    pick = F.min if name == "MIN" else F.max
    for a in args:
        if isinstance(a, str):
            c = plan.column(a)
            n = c.c.try_cast("decimal(30,6)") if c.kind == "number" else F.lit(None).cast("decimal(30,6)")
            if name in _CELLS[:2]:
                sums.append(plan.total(F.coalesce(F.sum(n), F.lit(0))).c.cast("double"))
                counts.append(plan.total(F.count(n)).c)
            else:
                ends.append(plan.total(pick(number_of(F.col(f"`{a}`")) if c.kind == "number" else F.lit(None).cast("double"))).c)
        else:
            n = F.lit(None).cast("double") if a.blank and a.kind in ("text", "logical") else (sheet.serial(a.c) if a.kind == "date" else a.c).cast("double") if a.blank else a.number()
            sums.append(F.coalesce(n, F.lit(0.0)))
            counts.append(n.isNotNull().cast("int"))
            ends.append(n)
    add = lambda cs: reduce(lambda x, y: x + y, cs)
    failed = add([F.lit(0), *((a.number().isNull()).cast("int") for a in args if not isinstance(a, str) and not a.blank)]) > 0
    if name == "SUM":
        out = add(sums)
    elif name == "AVERAGE":
        out = F.try_divide(add(sums), add(counts))
    else:
        both = ends if len(ends) > 1 else ends * 2
        out = F.coalesce(F.least(*both) if name == "MIN" else F.greatest(*both), F.lit(0.0))
    return Value(F.when(~failed, out), "number")


def with_formula(df: DataFrame, name: str, formula: str, order: list[str] | None = None) -> DataFrame:
    """df with a column computed by the formula. Totals of whole columns come as one broadcast row; COUNTIF and COUNTIFS by cells and INDEX with MATCH
    join a table of one row a key. order: the columns that tell which row is first for MATCH (all columns unless given)."""
    plan = _Plan(df)
    reader = _Reader(formula, plan)
    value = reader.expression()
    reader.take("")
    if reader.i != len(reader.tokens):
        raise SyntaxError(f"unread: {reader.tokens[reader.i - 1:]}")
    if isinstance(value, _Found):
        # MATCH by itself gives the number of the row
        at = f"_found{len(plan.lookups)}"
        plan.rows = True
        plan.lookups.append((at, _ROW, value.name, value.key))
        value = Value(F.col(at), "number")
    if plan.rows:
        if not order or len(order) != 1:
            raise ValueError("rows are numbered by one number column that no two of them share: give it as order")
        plan.df = df = kept(numbered(df, order[0], _ROW))
    out = df
    for at, column, sign, want in plan.compares:
        out = _compared(out, df, at, plan.column(column), sign, want)
    for at, column, want, sign in plan.sorted:
        v = plan.column(column)
        out = _last_before(out, df, at, (sheet.serial(v.c) if v.kind == "date" else v.c).cast("double"), want, sign)
    for at, row, column in plan.numbers:
        out = out.withColumn("_want", row).join(df.select(F.col(_ROW).alias("_at"), F.col(f"`{column}`").alias(at)), F.col("_want") == F.col("_at"), "left").drop("_want", "_at")
    for at, pairs, where in plan.counts:
        keys = [f"_key{i}" for i in range(len(pairs))]
        n = (df if where is None else df.where(where)).groupBy(*(F.lower(plan.column(c).text()).alias(k) for (c, _), k in zip(pairs, keys, strict=True))).agg(F.count(F.lit(1)).alias(at))
        out = _joined(out, n, keys, [w for _, w in pairs])
    for at, column, where, key in plan.lookups:
        first = F.struct(*(F.col(f"`{c}`") for c in order or df.columns))
        # blank cells match nothing
        n = df.where(F.col(f"`{where}`").isNotNull()).groupBy(F.lower(plan.column(where).text()).alias("_key0")).agg(F.min_by(F.col(f"`{column}`"), first).alias(at))
        out = _joined(out, n, ["_key0"], [key])
    if plan.totals:
        out = out.crossJoin(F.broadcast(df.agg(*(c.alias(n) for n, c in plan.totals.items()))))  # one row
    return out.select(*(F.col(f"`{c}`") for c in df.columns if c != _ROW), value.c.alias(name))


#: The number of a row where a formula asks for one.
_ROW = "_row"


def _compared(out: DataFrame, df: DataFrame, at: str, column: Value, sign: str, want: Column) -> DataFrame:
    """out with the number of rows whose number in the column compares so with this row's. Values and wants are put in one order and counted up range by range, so that a
    row meets its count by equality."""
    out = out.withColumn("_want", want.cast("double"))
    n = number_of(column.c).cast("double") if column.kind in ("number", "text") else F.lit(None).cast("double")
    values = df.select(n.alias("_v")).where("_v IS NOT NULL").groupBy("_v").agg(F.count(F.lit(1)).alias("_n"))
    wants = out.select(F.col("_want").alias("_v")).where("_v IS NOT NULL").distinct().withColumn("_n", F.lit(0).cast("long"))
    each = values.unionByName(wants).groupBy("_v").agg(F.sum("_n").alias("_n"))
    each = running(kept(each), "_v", "_n", "_below")
    all_ = df.agg(F.count(n).alias("_all"), F.count(F.lit(1)).alias("_rows"))
    up = {"<": F.col("_below"), "<=": F.col("_below") + F.col("_n"), ">": F.col("_all") - F.col("_below") - F.col("_n"), ">=": F.col("_all") - F.col("_below"), "=": F.col("_n"), "<>": F.col("_rows") - F.col("_n")}
    counted = each.crossJoin(F.broadcast(all_)).select(F.col("_v"), up[sign].alias(at))  # one row
    return out.join(counted, F.col("_want") == F.col("_v"), "left").drop("_v", "_want")


def _last_before(out: DataFrame, df: DataFrame, at: str, value: Column, want: Column, sign: int) -> DataFrame:
    """out with the last row before the first one whose value lies beyond the wanted one (above for sign 1, below for -1), blanks left out; an error where that is the first row.

    Only rows that exceed all before them can be the first beyond anything, and these rise with their values: so the wanted one is told by how many of them
    it reaches. Maxima and counts are taken in ranges of rows and of values, each with what those before it come to.
    """
    filled = df.select(F.col(_ROW), (value * sign).alias("_v")).where(F.col("_v").isNotNull())
    rows = kept(filled.repartitionByRange(_ROW).withColumn("_range", F.spark_partition_id()))
    ends = sorted((tuple(r) for r in rows.groupBy("_range").agg(F.max("_v"), F.max(_ROW)).collect()))  # as many as ranges
    before, top, last = [], None, None
    for r, v, n in ends:
        before += [F.lit(r), F.struct(F.lit(top).cast("double").alias("top"), F.lit(last).cast("long").alias("last"))]
        top, last = v if top is None else max(top, v), n
    if not ends:
        return out.withColumn(at, F.lit(None).cast("double"))
    carried = F.try_element_at(F.create_map(*before), F.col("_range"))
    w = W.partitionBy("_range").orderBy(_ROW)
    so_far = F.greatest(F.max("_v").over(w.rowsBetween(W.unboundedPreceding, -1)), carried["top"])
    rows = rows.withColumn("_top", so_far).withColumn("_prev", F.coalesce(F.lag(_ROW).over(w), carried["last"]))
    records = kept(rows.where("_top IS NULL OR _v > _top").select("_v", "_prev"))
    ranked = kept(running(records.withColumn("_n", F.lit(1)), "_v", "_n", "_rank").select(F.col("_rank").alias("_reached"), "_prev"))
    out = out.withColumn("_want", want.cast("double") * sign)
    wants = out.select(F.col("_want").alias("_v")).where("_v IS NOT NULL").distinct().withColumn("_n", F.lit(0))
    each = running(kept(records.select("_v", F.lit(1).alias("_n")).unionByName(wants).groupBy("_v").agg(F.sum("_n").alias("_n"))), "_v", "_n", "_below")
    reached = each.select("_v", (F.col("_below") + F.col("_n")).alias("_reached")).join(ranked, "_reached", "left")
    found = reached.select(F.col("_v"), F.when(F.col("_reached") == 0, None).otherwise(F.coalesce("_prev", F.when(F.col("_reached") >= records.count(), F.lit(last)))).cast("double").alias(at))
    return out.join(found, F.col("_want") == F.col("_v"), "left").drop("_v", "_want")


def _joined(out: DataFrame, n: DataFrame, keys: list[str], wants: list[Column]) -> DataFrame:
    for k, w in zip(keys, wants, strict=True):
        out = out.withColumn(f"_want{k}", w)
    on = [F.col(f"_want{k}") == F.col(k) for k in keys]
    return out.join(n, on, "left").drop(*keys, *(f"_want{k}" for k in keys))
