"""Quantity grammars, months and number formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import vocabulary as voc

QUANTITY = "decimal(38,6)"
_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def parse_decimal(c: Column) -> Column:
    """Exact quantity.  Of comma and dot, the one whose first place is later is
    the decimal mark; a lone one is a decimal mark.  Anything else is 0."""
    s = F.translate(F.coalesce(c.cast("string"), F.lit("")), "$ ", "")
    comma, dot = F.instr(s, ","), F.instr(s, ".")
    plain = (
        F.when((comma > 0) & (dot > 0) & (comma > dot), F.translate(F.translate(s, ".", ""), ",", "."))
        .when((comma > 0) & (dot > 0), F.translate(s, ",", ""))
        .when(comma > 0, F.translate(s, ",", "."))
        .otherwise(s)
    )
    return F.coalesce(F.when(plain.rlike(_NUMBER), plain.try_cast(QUANTITY)), F.lit(0).cast(QUANTITY))


def parse_colombian(c: Column) -> Column:
    """Approximate quantity: dots group thousands, the comma is the decimal mark; anything else is 0."""
    s = F.trim(F.translate(F.translate(c.cast("string"), ".", ""), ",", "."))
    return F.coalesce(F.when(s.rlike(_NUMBER), s.try_cast("double")), F.lit(0.0))


def decimal_comma(c: Column) -> Column:
    """A decimal as text with a comma, without trailing zeros."""
    s = F.regexp_replace(c.cast("string"), r"(\.\d*?)0+$", "$1")
    return F.translate(F.regexp_replace(s, r"\.$", ""), ".", ",")


def shown_quantity(c: Column) -> Column:
    """As decimal_comma; nothing or less is shown as 0."""
    return F.when(c > 0, decimal_comma(c)).otherwise(F.lit("0"))


def share(part: Column, whole: Column) -> Column:
    """Percent, 0 of nothing."""
    return F.when(whole > 0, part / whole * 100).otherwise(F.lit(0.0))


def month_order(c: Column) -> Column:
    """The number a month's file name begins with; 99 without one."""
    digits = F.regexp_extract(F.coalesce(c, F.lit("")), r"^(\d+)", 1)
    return F.coalesce(digits.try_cast("int"), F.lit(voc.NO_MONTH))


def month_name(c: Column) -> Column:
    """Its name, MES_n for numbers that are no month, or the text itself."""
    n = F.regexp_extract(F.coalesce(c, F.lit("")), r"^(\d+)", 1)
    names = F.array(*map(F.lit, voc.MONTHS))
    return F.when(n == "", c).otherwise(F.coalesce(F.when(month_order(c).between(1, 12), F.try_element_at(names, month_order(c))), F.concat(F.lit("MES_"), n.cast("int").cast("string"))))
