"""Spreadsheet functions as Columns. Errors are NULL; IFERROR is coalesce."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridloom.functions.text import number_of


def round_(x: Column, digits: int) -> Column:
    """Half away from zero."""
    return F.round(x, digits)


def int_(x: Column) -> Column:
    return F.floor(x)


def trim(s: Column) -> Column:
    return F.regexp_replace(F.trim(s), " +", " ")


def left(s: Column, n: int) -> Column:
    return F.substring(s, 1, n) if n >= 0 else F.lit(None).cast("string")


def right(s: Column, n: int) -> Column:
    return F.lit(None).cast("string") if n < 0 else F.lit("") if n == 0 else F.right(s, F.lit(n))


def mid(s: Column, start: int, n: int) -> Column:
    return F.substring(s, start, n) if start >= 1 and n >= 0 else F.lit(None).cast("string")


def substitute(s: Column, old: str, new: str, nth: int | None = None) -> Column:
    if nth is None:
        return F.replace(s, F.lit(old), F.lit(new))
    head = F.substring_index(s, old, nth)
    return F.when(F.length(head) == F.length(s), s).otherwise(F.concat(head, F.lit(new), F.substring(s, F.length(head) + len(old) + 1, F.length(s))))


def search(needle: str, s: Column, start: int = 1) -> Column:
    """Position without regard to case; NULL where there is none."""
    return F.nullif(F.locate(needle.lower(), F.lower(s), start), F.lit(0))


def date(y: Column, m: Column, d: Column) -> Column:
    """Months and days beyond their range carry over."""
    return F.date_add(F.add_months(F.make_date(y, F.lit(1), F.lit(1)), (m - 1).cast("int")), (d - 1).cast("int"))


def serial(d: Column) -> Column:
    return F.datediff(d, F.lit("1899-12-30").cast("date"))


def value(s: Column) -> Column:
    return number_of(s)


def divide(a: Column, b: Column) -> Column:
    return F.try_divide(a, b)


def average(c: Column) -> Column:
    """NULL (an error value) of no numbers."""
    return F.avg(number_of(c))


def min_(c: Column) -> Column:
    """0 of no numbers, as spreadsheets have it."""
    return F.coalesce(F.min(number_of(c)), F.lit(0.0))


def max_(c: Column) -> Column:
    return F.coalesce(F.max(number_of(c)), F.lit(0.0))


def sumproduct(a: Column, b: Column) -> Column:
    return F.sum(F.coalesce(number_of(a), F.lit(0.0)) * F.coalesce(number_of(b), F.lit(0.0)))


def distinct_text(c: Column) -> Column:
    """SUMPRODUCT(1/COUNTIF(P,P)): distinct values, case aside."""
    return F.count_distinct(F.lower(c.cast("string")))
