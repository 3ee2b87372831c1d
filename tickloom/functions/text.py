"""Text, identifiers, enumerations, JSON and error texts."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickloom.schemas import ENUMS


def as_id(value: Column, strict: bool = False) -> Column:
    """Identifier text to BIGINT; null and "" give null. ``strict`` fails on other text."""
    text = F.nullif(value.cast("string"), F.lit(""))
    return text.cast("bigint") if strict else text.try_cast("bigint")


def to_number(value: Column) -> Column:
    return value.try_cast("double")


def strip_usd(pair: Column) -> Column:
    """``SOL/USD`` → ``SOL``."""
    return F.replace(pair, F.lit("/USD"), F.lit(""))


def _enum_map(mapping: dict) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])


def enum_number(enum: str, name: Column, any_case: bool = False) -> Column:
    """Number of an enumeration name; an unknown name fails the query, as a typo would be lost otherwise."""
    key = F.upper(name) if any_case else name
    number = F.try_element_at(_enum_map(ENUMS[enum]), key)
    unknown = F.raise_error(F.concat(F.lit(f"unknown {enum}: "), key)).cast("int")
    return F.when(key.isNull(), F.lit(None).cast("int")).otherwise(F.coalesce(number, unknown))


def enum_name(enum: str, number: Column) -> Column:
    return F.try_element_at(_enum_map({n: name for name, n in ENUMS[enum].items()}), number.cast("int"))


def name_or_id(name: Column, identifier: Column) -> Column:
    return F.coalesce(name, identifier.cast("string"))


def error_text(code: Column, description: Column) -> Column:
    """``code: description`` without dangling separators when a part is missing."""
    joined = F.concat(F.coalesce(code, F.lit("")), F.lit(": "), F.coalesce(description, F.lit("")))
    return F.regexp_replace(joined, "^[: ]+|[: ]+$", "")


def json_record(*columns: str | Column) -> Column:
    return F.to_json(F.struct(*columns))


def json_result(value: Column) -> Column:
    """A plain string wrapped as ``{"result": ...}``."""
    return F.to_json(F.struct(value.alias("result")))


def has_payload(raw: Column) -> Column:
    """False for null and for JSON values that count as empty."""
    return raw.isNotNull() & ~F.trim(raw).isin("", "{}", "[]", "null", '""', "0", "false")
