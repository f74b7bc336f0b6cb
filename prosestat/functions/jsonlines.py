"""Fields of ``book_id TAB json`` lines.

JSON is parsed once per line into a variant; types are those of the JSON text,
so a number written as a string is not a number.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from prosestat.constants import COHORTS, DROP_REASONS
from prosestat.functions.text import is_blank, strip

#: The setting by which an object with a repeated key isn't malformed but has the last value.
REPEATED_KEYS = "spark.sql.variant.allowDuplicateKeys"
_NOT_FINITE = r"-?(?:NaN|Infinity)"
# Stand-ins for escapes, two code points that are no characters.
_BACKSLASH, _QUOTE = "\ufdd0", "\ufdd1"


def line_key(line: Column | str) -> Column:
    return strip(F.substring_index(line, "\t", 1))


def line_json(line: Column | str) -> Column:
    """What follows the first tab, null without a tab."""
    return F.get(F.split(line, "\t", 2), F.lit(1))


def finite(json: Column | str) -> Column:
    """JSON text with null for the non-finite numbers outside its strings.

    Without escapes, every second part between quotes lies outside strings.
    """
    hidden = F.replace(F.replace(json, F.lit("\\\\"), F.lit(_BACKSLASH)), F.lit('\\"'), F.lit(_QUOTE))
    parts = F.transform(F.split(hidden, '"', -1), lambda part, i: F.when(
        i % 2 == 0, F.regexp_replace(part, _NOT_FINITE, "null")).otherwise(part))
    shown = F.replace(F.replace(F.array_join(parts, '"'), F.lit(_QUOTE), F.lit('\\"')), F.lit(_BACKSLASH), F.lit("\\\\"))
    return F.when(F.contains(json, F.lit("NaN")) | F.contains(json, F.lit("Infinity")), shown).otherwise(
        F.col(json) if isinstance(json, str) else json)


def parse(json: Column | str) -> Column:
    """The JSON value as a variant, null if malformed; non-finite numbers read as null.

    The text is wrapped in an array, as the parser ignores what follows a value.
    """
    whole = F.try_parse_json(F.concat(F.lit("["), finite(json), F.lit("]")))
    return F.try_variant_get(whole, "$[0]", "variant")


def type_name(value: Column) -> Column:
    """BIGINT, DECIMAL, DOUBLE, STRING, BOOLEAN, OBJECT, ARRAY, VOID."""
    return F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)


def number(value: Column) -> Column:
    """A JSON number, or boolean as 0 / 1, as double; null for other types."""
    kind = type_name(value)
    return (F.when(kind.isin("BIGINT", "DECIMAL", "DOUBLE", "FLOAT"),
                   F.try_variant_get(value, "$", "double"))
            .when(kind == "BOOLEAN", F.try_variant_get(value, "$", "boolean").cast("double")))


def member(value: Column | str, path: str) -> Column:
    return F.try_variant_get(value, path, "variant")


def whole_number(value: Column) -> Column:
    """A JSON number without a fraction; exact over all 64 bits."""
    n = number(value)
    return F.when(type_name(value) == "BIGINT", F.try_variant_get(value, "$", "bigint")).when(
        (n == F.floor(n)) & (F.abs(n) < 2.0 ** 63), n.cast("bigint"))


def number_map(value: Column | str, path: str) -> Column:
    """The numeric members of an object as ``map<string,double>``."""
    members = F.try_variant_get(value, path, "map<string,variant>")
    return F.map_filter(F.transform_values(members, lambda _, v: number(v)),
                        lambda _, v: v.isNotNull())


def flag(value: Column) -> Column:
    """The text of a flag, a string or a number without decimals; null for other types (1.0 is not 1)."""
    return F.when(type_name(value).isin("BIGINT", "STRING"), F.try_variant_get(value, "$", "string"))


def cohort(flag: Column | str) -> Column:
    """Cohort of a flag text: ``1`` and ``0`` only."""
    text = strip(flag)
    found = [F.when(text == code, name) for code, name in COHORTS.items()]
    return F.coalesce(*found)


def record_id(value: Column | str, key: Column | str) -> Column:
    """``book_id`` of the record, a whole number without decimals; else the line key."""
    raw = member(value, "$.book_id")
    text = F.try_variant_get(raw, "$", "string")
    return F.coalesce(F.when(text != "", strip(text)), key)


def drop_reason(line: Column, value: Column, flag: Column) -> Column:
    """Why a line is left out, tested in a fixed order; null for a usable line."""
    tests = (is_blank(line), ~F.contains(line, F.lit("\t")), value.isNull(),
             type_name(value) != "OBJECT", cohort(flag).isNull())
    reason = F.lit(None).cast("string")
    for name, failed in reversed(list(zip(DROP_REASONS, tests))):
        reason = F.when(failed, name).otherwise(reason)
    return reason
