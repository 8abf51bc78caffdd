"""Invoice dates written as ``MM/dd/yy HH:mm`` text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# POSIX %y: 69-99 are 19yy, 00-68 are 20yy.  Spark's yy is always 20yy.
FIRST_YEAR_OF_LAST_CENTURY = 2069
MONTHS_PER_CENTURY = 1200


def day_text(invoice_date: Column) -> Column:
    """The date part of an invoice date, still as text."""
    return F.substring_index(F.trim(invoice_date), " ", 1)


def parse_day(text: Column, strict: bool = True) -> Column:
    """Date of ``MM/dd/yy`` text; unreadable text raises, or is NULL if not strict."""
    day = (F.to_date if strict else F.try_to_date)(text, "M/d/yy")
    return F.when(
        F.year(day) >= FIRST_YEAR_OF_LAST_CENTURY, F.add_months(day, -MONTHS_PER_CENTURY)
    ).otherwise(day)


def parse_moment(text: Column, strict: bool = True) -> Column:
    """Timestamp without zone of ``MM/dd/yy HH:mm`` text, same century rule."""
    fmt = F.lit("M/d/yy H:mm")
    if strict:
        moment = F.to_timestamp_ntz(text, fmt)
    else:
        moment = F.try_to_timestamp(text, fmt).cast("timestamp_ntz")
    century = F.make_ym_interval(F.lit(100))
    return F.when(F.year(moment) >= FIRST_YEAR_OF_LAST_CENTURY, moment - century).otherwise(moment)
