"""Defensive reads: untyped JSON values and text to typed columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from feedmetrics.functions.text import strip


# --- text ------------------------------------------------------------------

def int_from_text(text: Column) -> Column:
    """Whole-number text -> bigint, else null.

    Takes a sign, surrounding whitespace and single underscores between digits.
    """
    value = strip(text)
    return F.when(value.rlike(r"^[+-]?\d+(_\d+)*$"),
                  F.replace(value, F.lit("_"), F.lit("")).try_cast("bigint"))


def bool_from_text(text: Column) -> Column:
    value = F.lower(strip(text))
    return F.when(value.isin("true", "1", "yes"), True).when(value.isin("false", "0", "no"), False)


def int_from_number(number: Column) -> Column:
    """Truncates; null for NaN and out-of-range values."""
    return number.try_cast("bigint")


# --- VARIANT ---------------------------------------------------------------
#
# Each takes a VARIANT and the path of a field in it. An absent field, and one
# on a path that leads through something other than an object, reads as null.

def field(value: Column, path: str) -> Column:
    return F.try_variant_get(value, path, "variant")


def kind(value: Column, path: str = "$") -> Column:
    """STRING, BIGINT, DECIMAL(..), DOUBLE, BOOLEAN, VOID, ... of a scalar.

    Containers are described in full, at the cost of walking all of them.
    """
    return F.schema_of_variant(value if path == "$" else field(value, path))


def _string(value: Column, path: str) -> Column:
    return F.try_variant_get(value, path, "string")


def is_object(value: Column, path: str = "$") -> Column:
    """Casts to a struct of one field, which only an object allows; cheaper than its schema."""
    return F.try_variant_get(value, path, "struct<_:variant>").isNotNull()


def string_of(value: Column, path: str = "$") -> Column:
    """The field if it is a JSON string, else null."""
    return F.when(kind(value, path) == "STRING", _string(value, path))


def text_of(value: Column, path: str = "$") -> Column:
    """Any scalar as text, JSON null as null, objects and arrays as JSON text."""
    text = _string(value, path)
    return F.when(kind(value, path) == "BOOLEAN", F.initcap(text)).otherwise(text)


def open_objects(df: DataFrame, column: str, layout: str) -> DataFrame:
    """Replaces a VARIANT column by the fields of a struct type; rows that are no object go.

    All fields come out of one pass over the value; one that does not fit its
    type is null. The generator keeps the optimizer from copying that pass
    into every later use of a field.
    """
    others = [name for name in df.columns if name != column]
    opened = F.try_variant_get(F.col(column), "$", f"struct<{layout}>")
    return df.select(*others, F.inline(F.array_compact(F.array(opened))))


def elements_of(value: Column, path: str = "$") -> Column:
    """array<variant> of a JSON array, else null."""
    return F.try_variant_get(value, path, "array<variant>")


def id_text(value: Column, path: str = "$") -> Column:
    """Id as text, so that 42 and "42" are one id; null and "" give null."""
    return F.nullif(text_of(value, path), F.lit(""))


def truthy_text(value: Column, path: str = "$") -> Column:
    """As id_text, but zero, false and empty containers also give null."""
    text = _string(value, path)
    nothing = text.isin("false", "[]", "{}") | (text.try_cast("double") == 0)
    return (F.when(kind(value, path) == "STRING", F.nullif(text, F.lit("")))
            .when(~F.coalesce(nothing, F.lit(False)), F.regexp_replace(text, "^true$", "True")))


def _seldom(value: Column, read: Callable[[Column], Column]) -> Column:
    """``read`` of a value as a lambda: rare cases stay out of the code that all rows run through."""
    return F.get(F.transform(F.array(value), read), 0)


def truthy_of_text(text: Column, value: Column, path: str) -> Column:
    """truthy_text of a field that was read as ``text``; the value is looked at only where its kind tells."""
    unclear = text.isin("true", "false", "[]", "{}") | text.startswith("0") | text.startswith("-0")
    return F.when(unclear, _seldom(value, lambda whole: truthy_text(whole, path))).otherwise(F.nullif(text, F.lit("")))


def text_of_text(text: Column, value: Column, path: str) -> Column:
    """text_of a field that was read as ``text``: only true and false may be spelled in another way."""
    return F.when(text.isin("true", "false"), _seldom(value, lambda whole: text_of(whole, path))).otherwise(text)


def int_of(value: Column, path: str = "$") -> Column:
    """Number (truncated), whole-number text or boolean -> bigint, else null."""
    return (F.when(kind(value, path) == "STRING", int_from_text(_string(value, path)))
            .otherwise(F.try_variant_get(value, path, "bigint")))


def bool_of(value: Column, path: str = "$") -> Column:
    """Boolean, the numbers 1 and 0, or the usual words -> boolean, else null."""
    number = F.try_variant_get(value, path, "double")
    return (F.when(kind(value, path) == "STRING", bool_from_text(_string(value, path)))
            .when(number == 1, True).when(number == 0, False))
