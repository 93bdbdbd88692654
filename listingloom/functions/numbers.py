"""Numbers out of shop text, and exact two-decimal averages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What a price text may carry around its digits.
PRICE_NOISE = r"[.,đ₫\s]|true|false|null"
DECIMAL_TEXT = r"^-?\d+\.?\d*$"


def _whole_match(text: Column, pattern: str) -> Column:
    """``text`` where the anchored pattern matches it, NULL elsewhere."""
    return F.nullif(F.regexp_extract(text, pattern, 0), F.lit(""))


def parse_long(
    column: Column, dtype: T.DataType | None = None, signed: bool = False
) -> Column:
    """Whole number from a feed value.

    Numbers and flags are cast as they are; only text is cleaned, since
    cleaning would drop the decimal point of a printed double. Text that is
    not all digits once cleaned, or too long for a long, gives NULL. With
    ``signed`` a leading minus is kept, so that negative prices stay visible
    to validation.
    """
    if isinstance(dtype, T.BooleanType):
        return column.cast("int").cast("long")
    if isinstance(dtype, T.NumericType):
        return column.try_cast("long")
    digits = r"^-?[0-9]+$" if signed else r"^[0-9]+$"
    cleaned = F.regexp_replace(column.cast("string"), PRICE_NOISE, "")
    return _whole_match(cleaned, digits).try_cast("long")


def parse_double(column: Column, dtype: T.DataType | None = None) -> Column:
    """Plain decimal text as a double; exponents and bare fractions give NULL."""
    if isinstance(dtype, T.NumericType):
        return column.try_cast("double")
    return _whole_match(column.cast("string"), DECIMAL_TEXT).try_cast("double")


# A number as JSON prints it, and whole thousands grouped by dots.
NUMBER_TEXT = r"^-?[0-9]+(\.[0-9]+)?([eE][+-]?[0-9]+)?$"
GROUPED_TEXT = r"^-?[0-9]{1,3}(\.[0-9]{3})+$"


def _as_number(text: Column, target: str) -> Column:
    """A plain number's value; fractions are cut off whole numbers."""
    return F.coalesce(text.try_cast(target), text.try_cast("double").try_cast(target))


def long_by_form(column: Column) -> Column:
    """Whole number from feed text, read by the form of the text.

    Flags are 1 and 0, numbers with a fraction or an exponent are numbers, all
    else is shop text. Dots that part groups of three digits are grouping, so
    ``89000.0`` and ``89.000`` are both 89000; a JSON number with just three
    decimals cannot be told from that and is taken as grouped.
    """
    text = F.trim(column.cast("string"))
    flag = F.when(F.lower(text) == "true", 1).when(F.lower(text) == "false", 0)
    plain = text.rlike(NUMBER_TEXT) & ~text.rlike(GROUPED_TEXT)
    return F.coalesce(
        flag.cast("long"), F.when(plain, _as_number(text, "long")).otherwise(parse_long(text, signed=True))
    )


def double_by_form(column: Column) -> Column:
    """Plain or exponent number text as a double."""
    text = F.trim(column.cast("string"))
    return F.when(text.rlike(NUMBER_TEXT), text.try_cast("double")).otherwise(parse_double(text))


def digits_price(text: Column) -> Column:
    """All digits of a scraped price, whatever stands between them."""
    return F.nullif(F.regexp_replace(text, r"[^0-9]", ""), F.lit("")).try_cast("long")


def first_number(text: Column) -> Column:
    """The first run of digits, as in ``-25%``."""
    return F.nullif(F.regexp_extract(text, r"([0-9]+)", 1), F.lit("")).try_cast("int")


def mean_2dp(total: Column, rows: Column) -> Column:
    """``total / rows`` to two decimals, halves away from zero; NULL for no rows.

    The operands are widened so that the quotient keeps at least ten decimals
    before it is rounded.
    """
    quotient = F.try_divide(total.cast("decimal(28,6)"), rows.cast("decimal(20,0)"))
    return F.round(quotient.cast("decimal(38,10)"), 2).cast("decimal(18,2)")


def percent_2dp(part: Column, whole: Column) -> Column:
    """``part`` in percent of ``whole``, NULL where there is nothing to divide by."""
    quotient = F.try_divide(
        (part * 100).cast("decimal(22,0)"), F.nullif(whole, F.lit(0)).cast("decimal(20,0)")
    )
    return F.round(quotient.cast("decimal(38,10)"), 2).cast("decimal(18,2)")
