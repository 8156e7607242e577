"""Strict JSON tests and canonical JSON text, as native column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Spark accepts single-quoted JSON by default; the contract does not.
#: Its limits on the length of numbers and texts would make valid lines invalid.
_NO_LIMIT = str(2**31 - 1)
STRICT_OPTIONS = {"allowSingleQuotes": "false", "maxNumLen": _NO_LIMIT, "maxStringLen": _NO_LIMIT}

#: For schemas that skip what is nested; building deep values would exhaust the stack.
ANY_DEPTH = {**STRICT_OPTIONS, "maxNestingDepth": _NO_LIMIT}
_SKIPPED = "array<struct<other int>>"
#: Nesting that Spark's JSON functions read without more.
READER_DEPTH = 1_000

#: Number-like tokens that Spark reads as infinities but that are not JSON constants here.
_FOREIGN_INFINITY = r"[+-]INF|\+Infinity"

#: Whitespace as Unicode defines it, plus the four ASCII separator controls.
UNICODE_SPACE = r"[\s\x1c-\x1f]"


def is_blank(text: Column) -> Column:
    """Empty, or nothing but Unicode whitespace."""
    return text.rlike(rf"(?U)\A{UNICODE_SPACE}*\z")


def strip_space(text: Column) -> Column:
    """Drop leading and trailing Unicode whitespace (``trim`` only knows the plain blank)."""
    stripped = F.regexp_replace(text, rf"(?U)\A{UNICODE_SPACE}+|{UNICODE_SPACE}+\z", "")
    # Most lines are tight objects; two byte comparisons are far cheaper than the expression.
    return F.when(text.startswith("{") & text.endswith("}"), text).otherwise(stripped)


def has_foreign_infinity(text: Column) -> Column:
    """An infinity token outside all string literals (escapes go first, then the literals)."""
    bare = F.regexp_replace(F.regexp_replace(text, r"(?s)\\.", ""), '"[^"]*"', '""')
    suspect = text.contains("INF") | text.contains("+Infinity")
    return suspect & bare.rlike(_FOREIGN_INFINITY)


def in_brackets(text: Column) -> Column:
    return F.concat(F.lit("["), text, F.lit("]"))


def in_object(text: Column) -> Column:
    return F.concat(F.lit('{"r":'), text, F.lit("}"))


def is_strict_json(text: Column) -> Column:
    """The whole string is exactly one JSON value.

    ``from_json`` ignores anything after the first value. Wrapping closes that hole: trailing
    text breaks at least one of the two wrappers, because no suffix can close both.
    """
    # Fields that no schema names are skipped, not built, so any depth of nesting is read.
    listed = F.from_json(F.concat(F.lit('[{"r":['), text, F.lit("]}]")), _SKIPPED, ANY_DEPTH)
    keyed = F.from_json(F.concat(F.lit('[{"r":'), text, F.lit("}]")), _SKIPPED, ANY_DEPTH)
    return listed.isNotNull() & keyed.isNotNull() & ~has_foreign_infinity(text)


def may_be_deep(text: Column) -> Column:
    """More opening brackets than the reader's depth, in or out of literals."""
    return F.length(F.regexp_replace(text, r"[^\[{]", "")) > READER_DEPTH


def deep_string(text: Column, key: str) -> Column:
    """The string under a key of a valid JSON object of any depth; null for any other kind of value.

    A reader of strings also takes numbers, constants, arrays and objects as their text. A value that
    a reader of one of those kinds accepts is therefore not a string.
    """

    def read(kind: str) -> Column:
        schema = T.StructType([T.StructField(key, T.DataType.fromDDL(kind))])
        return F.from_json(text, schema, ANY_DEPTH).getField(key)

    others = [read(kind) for kind in ("double", "boolean", "array<struct<other int>>", "struct<other int>")]
    return F.when(reduce(lambda a, b: a & b, [value.isNull() for value in others]), read("string"))


def json_string(text: Column) -> Column:
    """``text`` as an ASCII-only JSON string literal, quotes included."""
    escaped = text
    # The short escapes of JSON, backslash first.
    for char, escape in (
        ("\\", "\\\\"),
        ('"', '\\"'),
        ("\b", "\\b"),
        ("\f", "\\f"),
        ("\n", "\\n"),
        ("\r", "\\r"),
        ("\t", "\\t"),
    ):
        escaped = F.replace(escaped, F.lit(char), F.lit(escape))

    def ascii_only(char: Column) -> Column:
        utf16 = F.lower(F.hex(F.encode(char, "UTF-16BE")))
        return F.when(char.between(" ", "~"), char).otherwise(
            F.regexp_replace(utf16, "(.{4})", r"\\u$1")
        )

    # Splitting into characters is only paid for by texts that need it.
    per_char = F.array_join(F.transform(F.split(escaped, ""), ascii_only), "")
    body = F.when(escaped.rlike("[^ -~]"), per_char).otherwise(escaped)
    return F.concat(F.lit('"'), body, F.lit('"'))


def canonical_json(fields: dict[str, Column]) -> Column:
    """A flat JSON object with sorted keys, ``", "`` and ``": "`` separators and ASCII text."""
    parts: list[Column] = []
    for position, name in enumerate(sorted(fields)):
        lead = "{" if position == 0 else ", "
        parts.append(F.lit(f'{lead}"{name}": '))
        parts.append(F.coalesce(json_string(fields[name]), F.lit("null")))
    return F.concat(*parts, F.lit("}"))
