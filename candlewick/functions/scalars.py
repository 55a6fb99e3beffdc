"""Column expressions shared by the models."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(top: Column, bottom: Column) -> Column:
    """``top / bottom``, NULL for a zero or NULL divisor."""
    return top / F.nullif(bottom, F.lit(0.0))


def pct(part: Column, base: Column, digits: int) -> Column:
    return F.round(ratio(part, base) * 100, digits)


def null_double() -> Column:
    return F.lit(None).cast("double")


def day_from_millis(ms: Column) -> Column:
    """Epoch milliseconds -> UTC date, independent of the session zone."""
    return F.date_add(F.lit("1970-01-01").cast("date"), F.floor(ms / 86400000).cast("int"))


def date_key(date: Column) -> Column:
    return F.date_format(date, "yyyyMMdd").cast("int")


def fixed(x: Column, digits: int) -> Column:
    """A number as text with exactly ``digits`` decimals."""
    return F.round(x, digits).cast(f"decimal(38,{digits})").cast("string")


def capitalise(s: Column) -> Column:
    """Upper-case the first character and leave the rest alone."""
    return F.concat(F.upper(F.substring(s, 1, 1)), F.substr(s, F.lit(2)))


def money(price: Column) -> Column:
    """$1,234.56 from one dollar up, $0.1234 below, n/a for NULL."""
    big = F.concat(F.lit("$"), F.format_number(F.round(price, 2).cast("decimal(38,2)"), 2))
    small = F.concat(F.lit("$"), F.format_number(F.round(price, 4).cast("decimal(38,4)"), 4))
    return F.when(price.isNull(), F.lit("n/a")).when(price >= 1, big).otherwise(small)


def signed_pct(x: Column) -> Column:
    """+2.34%, -1.00%, n/a for NULL."""
    sign = F.when(x < 0, F.lit("-")).otherwise(F.lit("+"))
    return F.when(x.isNull(), F.lit("n/a")).otherwise(F.concat(sign, fixed(F.abs(x), 2), F.lit("%")))
