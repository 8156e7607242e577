"""Prompt templates: ``{text}`` is the only placeholder, ``{{`` and ``}}`` are braces."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_TOKENS = r"\{\{|\}\}|\{text\}|[^{}]+|[{}]"


def _tokens(template: Column) -> Column:
    return F.regexp_extract_all(template, F.lit(_TOKENS), F.lit(0))


def template_is_supported(template: Column) -> Column:
    """No stray brace and no placeholder other than a plain ``{text}``."""
    return ~F.exists(_tokens(template), lambda token: token.isin("{", "}"))


def template_parts(template: Column) -> Column:
    """The literal stretches around each ``{text}``, with doubled braces undone.

    Cut once per prompt; ``array_join(parts, text)`` then renders a row, and the inserted text
    is never looked at again, whatever braces it holds.
    """

    def extend(parts: Column, token: Column) -> Column:
        literal = F.when(token == "{{", "{").when(token == "}}", "}").otherwise(token)
        head = F.slice(parts, F.lit(1), F.size(parts) - 1)
        grown = F.concat(head, F.array(F.concat(F.element_at(parts, -1), literal)))
        return F.when(token == "{text}", F.concat(parts, F.array(F.lit("")))).otherwise(grown)

    return F.aggregate(_tokens(template), F.array(F.lit("")), extend)


def render(parts: Column, text: Column) -> Column:
    return F.call_function("array_join", parts, text)
