"""Strict text-to-number parsing, safe ratios and fixed-point display."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from prosestat.functions.text import strip

_INT = r"^[+-]?[0-9]+(?:_[0-9]+)*\z"
_FLOAT = (r"^[+-]?(?:[0-9]+(?:_[0-9]+)*\.?(?:[0-9]+(?:_[0-9]+)*)?|\.[0-9]+(?:_[0-9]+)*)"
          r"(?:[eE][+-]?[0-9]+(?:_[0-9]+)*)?\z")
_SPECIAL = r"(?i)^[+-]?(?:inf|infinity|nan)\z"


# What the cast to a whole number can take: it drops control characters at the ends.
_CASTABLE = r"^[\x00-\x20\x7F-\x9F]*[+-]?[0-9]+[\x00-\x20\x7F-\x9F]*\z"


def _odd(text: Column) -> Column:
    """Whether a text has signs that the casts do not know: an underscore, or white space outside ASCII."""
    return F.contains(text, F.lit("_")) | (F.octet_length(text) != F.length(text))


def as_int(text: Column | str) -> Column:
    """The whole number a text spells, else null (``5.0`` is not one)."""
    plain = F.col(text) if isinstance(text, str) else text
    # A cast that fails throws, which costs far more than a pattern that doesn't match.
    cast = F.when(F.rlike(plain, F.lit(_CASTABLE)), plain).try_cast("bigint")
    odd = F.when(_odd(plain) & F.rlike(strip(plain), F.lit(_INT)), F.replace(strip(plain), F.lit("_"), F.lit("")))
    return F.coalesce(cast, odd.try_cast("bigint"))


def as_float(text: Column | str) -> Column:
    """The number a text spells, else null; type suffixes and hex are refused."""
    raw, t = F.col(text) if isinstance(text, str) else text, strip(text)
    plain = F.when(F.rlike(t, F.lit(_FLOAT)), F.replace(t, F.lit("_"), F.lit("")))
    special = F.when(F.rlike(t, F.lit(_SPECIAL)), F.regexp_replace(t, "(?i)^[+-](?=nan)", ""))
    # Texts of digits, points and minus signs alone are left to the cast; expressions are for the rest.
    bare = F.translate(raw, "0123456789.-", "") == ""
    return F.when(bare, raw).otherwise(F.coalesce(plain, special)).try_cast("double")


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Quotient of two counts, 0.0 over a zero or missing denominator."""
    return F.coalesce(F.try_divide(numerator, denominator), F.lit(0.0))


def fixed4(value: Column | str) -> Column:
    """Text with four decimals, null for null."""
    return F.when(F.isnotnull(value), F.format_string("%.4f", F.round(value, 4)))


def display(value: Column | str) -> Column:
    """Four decimals, ``NA`` for a missing value."""
    return F.coalesce(fixed4(value), F.lit("NA"))
