"""Expressions over JSON text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

PARSE_ERROR = "PARSE_ERROR"

_PARSED = "__parsed_exception"
_ERROR_SCHEMA = "errorCode string, _bad string"
_ERROR_OPTIONS = {"columnNameOfCorruptRecord": "_bad", "allowSingleQuotes": "false"}


def _parsed_exception(text: Column) -> Column:
    return F.from_json(text, _ERROR_SCHEMA, _ERROR_OPTIONS)


def _code(text: Column, parsed: Column) -> Column:
    not_an_object = parsed.isNull() | parsed["_bad"].isNotNull()
    return (
        F.when(text.isNull() | (text == ""), F.lit(None).cast("string"))
        .when(not_an_object & F.try_parse_json(text).isNull(), F.lit(PARSE_ERROR))
        .otherwise(parsed["errorCode"])
    )


def error_code(text: Column) -> Column:
    """``errorCode`` of a JSON object; null for no text or no key, ``PARSE_ERROR`` for bad JSON.

    Text that is JSON but not an object (a list, a number, ``null``) has no code: null.
    """
    return _code(text, _parsed_exception(text))


def with_error_code(rows: DataFrame, text: str, out: str = "error_code") -> DataFrame:
    """Attach ``error_code`` of a column. The parsed form is a column of its own, so each text is
    parsed once; the single expression parses it for every mention."""
    return (
        rows.withColumn(_PARSED, _parsed_exception(F.col(text)))
        .withColumn(out, _code(F.col(text), F.col(_PARSED)))
        .drop(_PARSED)
    )


def attempt_count(attempts: Column) -> Column:
    """Length of a JSON list; 0 if absent, null or not a list."""
    return F.coalesce(F.json_array_length(attempts), F.lit(0))


def attempts_json(attempts: Column) -> Column:
    """The list as text, null when it is absent or empty."""
    return F.when(attempt_count(attempts) > 0, attempts)


def payload_row_count(payload: Column) -> Column:
    """Rows of the first table of the first result; 0 if absent or malformed."""
    rows = F.get_json_object(payload, "$.results[0].tables[0].rows")
    return F.coalesce(F.json_array_length(rows), F.lit(0))


def event_fields(text: Column) -> Column:
    """A flat JSON object as a map. Keys keep their case, so variants stay apart."""
    return F.from_json(text, "map<string,string>")


def first_of(fields: Column, *names: str) -> Column:
    """First non-null value among several spellings of a field."""
    return F.coalesce(*[fields[name] for name in names])
