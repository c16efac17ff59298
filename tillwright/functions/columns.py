"""Cleansing, calendar and ratio expressions.

Every function takes a column (or its name) and returns a Column made of built-in expressions, so that the
work stays inside whole-stage code generation. Invalid input gives NULL, never an error.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Times a quantity it gives decimal(38,9): amounts are exact to nine decimals.
PRICE_TYPE = "decimal(18,9)"
QTY_TYPE = "decimal(19,0)"

# The date formats tried in turn. An ambiguous 03/04/2021 is read as 4 March.
DATE_FORMATS = ("%Y-%m-%d", "%m/%d/%Y", "%d/%m/%Y")

# The accepted shape of an email address, and the part of a raw email before any link tail.
EMAIL_PATTERN = r"^[^@\s]+@[^@\s]+\.[^@\s]+$"
EMAIL_HEAD_PATTERN = r"^[^#\s]+"

# The characters that count as white space.
WHITE_SPACE = (
    " \t\n\x0b\x0c\r\x85\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

_DATE_PARTS = {"%Y": r"\d{4}", "%m": r"\d{1,2}", "%d": r"\d{1,2}"}


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---- text ---------------------------------------------------------------------------------------------------


def trim_all(c: Column | str) -> Column:
    """Strip every kind of white space at both ends (``F.trim`` strips blanks only)."""
    return F.btrim(col(c).cast("string"), F.lit(WHITE_SPACE))


def is_blank(c: Column | str) -> Column:
    """True for NULL, empty and white-space-only text."""
    return col(c).isNull() | (trim_all(c) == "")


def digits_only(c: Column | str) -> Column:
    return F.regexp_replace(col(c).cast("string"), r"\D", "")


def full_name(first: Column | str, last: Column | str) -> Column:
    """First and last name joined by a blank; a missing part leaves no stray blank and no NULL."""
    empty = F.lit("")
    return trim_all(F.concat(F.coalesce(col(first), empty), F.lit(" "), F.coalesce(col(last), empty)))


def clean_email(c: Column | str) -> Column:
    """Address before any ``#mailto:…#`` tail, without a ``mailto:`` prefix, in lower case.

    The prefix is matched as written, before lower-casing, and text that starts with white space has no head: it
    becomes NULL.
    """
    head = F.regexp_substr(col(c).cast("string"), F.lit(EMAIL_HEAD_PATTERN))
    return F.lower(F.regexp_replace(head, "^mailto:", ""))


def is_email(c: Column | str) -> Column:
    return F.lower(col(c)).rlike(EMAIL_PATTERN)


# ---- casts --------------------------------------------------------------------------------------------------


def safe_int(c: Column | str) -> Column:
    """Whole number or NULL: ``'2.5'``, ``'abc'`` and ``''`` are NULL, blanks around a number are allowed."""
    return col(c).try_cast("bigint")


def safe_decimal(c: Column | str, data_type: str = PRICE_TYPE) -> Column:
    return col(c).try_cast(data_type)


def safe_date(c: Column | str, formats: Sequence[str] = DATE_FORMATS, trimmed: bool = False) -> Column:
    """First of ``formats`` that yields a valid date, else NULL.

    A format is ``%Y``, ``%m`` and ``%d`` in any order around one separator. The text is checked against the shape of
    the format, split, and put in ISO order, because casting an ISO text is cheap and silent on bad input, while a
    date formatter raises (and catches) an exception for every miss.
    """
    text = col(c) if trimmed else trim_all(c)
    by_shape: dict[str, list[Column]] = {}
    for fmt in formats:
        order, separator = re.findall("%[Ymd]", fmt), fmt[2:3]
        if sorted(order) != ["%Y", "%d", "%m"] or separator.join(order) != fmt:
            raise ValueError(f"not a date format with one separator: {fmt}")
        shape = "^" + re.escape(separator).join(_DATE_PARTS[part] for part in order) + "$"
        # The shape has two separators; cutting at them needs no regular expression, which would run for every piece.
        rest = F.substring_index(text, separator, -2)
        pieces = [F.substring_index(text, separator, 1), F.substring_index(rest, separator, 1), F.substring_index(text, separator, -1)]
        ordered = [pieces[order.index(part)] for part in ("%Y", "%m", "%d")]
        iso = text if fmt == "%Y-%m-%d" else F.concat_ws("-", *ordered)
        by_shape.setdefault(shape, []).append(iso.try_cast("date"))
    return F.coalesce(*[F.when(text.rlike(shape), F.coalesce(*dates)) for shape, dates in by_shape.items()])


# ---- calendar -----------------------------------------------------------------------------------------------


def year_month(d: Column | str) -> Column:
    """``YYYY-MM``: the head of the ISO text of a DATE."""
    return F.substring(col(d).cast("string"), 1, 7)


def month_start(ym: Column | str) -> Column:
    """First day of a ``YYYY-MM`` month."""
    return F.concat(col(ym), F.lit("-01")).cast("date")


def year(d: Column | str) -> Column:
    return F.year(col(d)).cast("bigint")


def quarter(d: Column | str) -> Column:
    return F.quarter(col(d)).cast("bigint")


def month(d: Column | str) -> Column:
    return F.month(col(d)).cast("bigint")


def day_of_week(d: Column | str) -> Column:
    """1 = Sunday … 7 = Saturday."""
    return F.dayofweek(col(d)).cast("bigint")


def day_name(d: Column | str) -> Column:
    return F.date_format(col(d), "E")


def week_sunday(d: Column | str) -> Column:
    """Week of the year, weeks start on Sunday; the days before the first Sunday are week 0."""
    day = col(d)
    return F.floor((F.dayofyear(day) + 7 - F.dayofweek(day)) / 7).cast("bigint")


def date_key(d: Column | str) -> Column:
    """``YYYYMMDD`` as a number."""
    day = col(d)
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("bigint")


def days_between(later: Column | str, earlier: Column | str) -> Column:
    return F.datediff(col(later), col(earlier)).cast("bigint")


def month_diff(later: Column | str, earlier: Column | str) -> Column:
    """Month boundaries crossed: 31 January to 1 February is 1."""
    a, b = col(later), col(earlier)
    return ((F.year(a) - F.year(b)) * 12 + F.month(a) - F.month(b)).cast("bigint")


# ---- numbers and keys ---------------------------------------------------------------------------------------


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Double ratio, NULL when the denominator is zero or missing."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def growth(now: Column, before: Column) -> Column:
    return safe_ratio(now - before, before)


def surrogate_key(text: Column) -> Column:
    """Non-negative 60-bit key of a text: the first 15 hexadecimal digits of its MD5."""
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def customer_key(email: Column | str) -> Column:
    return surrogate_key(F.lower(trim_all(email)))


def product_key(name: Column | str, category: Column | str) -> Column:
    return surrogate_key(F.concat(F.upper(trim_all(name)), F.lit("|"), F.upper(trim_all(category))))
