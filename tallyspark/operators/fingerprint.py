"""Content hashes of examples, datasets and prompts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.functions.json_text import canonical_json
from tallyspark.functions.templates import template_parts
from tallyspark.operators.validate import PROMPT_FIELDS, check_prompts

#: Everything that identifies an example, the human note included.
IDENTITY_FIELDS = ("id", "text", "label", "difficulty", "note")

#: Hex digits that the children of a node share, level by level below the root.
_PREFIXES = (6, 3)


def row_digest(fields: Sequence[str] = IDENTITY_FIELDS) -> Column:
    """SHA-256 of one row. Length prefixes keep fields apart; a null differs from ''."""
    marked = [
        F.coalesce(
            F.concat(F.length(name).cast("string"), F.lit(":"), F.col(name)), F.lit("-")
        )
        for name in fields
    ]
    return F.sha2(F.concat(*marked), 256)


def dataset_fingerprint(
    examples: DataFrame, by: Sequence[str] = (), fields: Sequence[str] = IDENTITY_FIELDS
) -> DataFrame:
    """Order-free content hash: 12 lowercase hex digits per dataset (or per ``by`` group).

    A hash tree over the row digests. Equal rows are counted first, combined on the map side, so a
    block of copies costs nothing extra and each distinct digest is a leaf with its count. Leaves that
    share their first hex digits hash, in order, into a node; nodes of shorter prefixes into the next,
    up to the root. No node has more than a few thousand children up to some 10^11 rows.
    """
    level = (
        examples.select(*by, row_digest(fields).alias("_key"))
        .groupBy(*by, "_key")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .withColumn("_leaf", F.concat_ws(":", "_key", F.col("_rows").cast("string")))
    )
    node = F.sha2(F.array_join(F.array_sort(F.collect_list("_leaf")), ","), 256)
    for width in _PREFIXES:
        prefix = F.substring("_key", 1, width).alias("_key")
        level = level.groupBy(*by, prefix).agg(F.sum("_rows").alias("_rows"), node.alias("_leaf"))
    root = level.groupBy(*by).agg(
        F.coalesce(F.sum("_rows"), F.lit(0).cast("long")).alias("n_examples"), node.alias("_leaf")
    )
    total = F.concat_ws(",", F.col("n_examples").cast("string"), "_leaf")
    return root.select(*by, "n_examples", F.substring(F.sha2(total, 256), 1, 12).alias("fingerprint"))


def prompt_fingerprint() -> Column:
    """First 12 hex digits of the SHA-256 of the prompt's canonical JSON."""
    text = canonical_json({name: F.col(name) for name in PROMPT_FIELDS})
    return F.substring(F.sha2(text, 256), 1, 12)


def prompt_registry(prompts: DataFrame) -> DataFrame:
    """The usable prompts with fingerprint and template parts."""
    return (
        check_prompts(prompts)
        .where(F.col("violation").isNull())
        .select(
            *PROMPT_FIELDS,
            prompt_fingerprint().alias("fingerprint"),
            template_parts(F.col("user_template")).alias("parts"),
        )
    )
