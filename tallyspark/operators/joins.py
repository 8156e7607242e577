"""N:1 lookups that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A table is broadcast only after a count shows that it stays within both bounds.
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 * 1024 * 1024
#: Keys with at least this many fact rows are joined apart. There are at most
#: ``facts / HOT_ROWS`` of them, so their lookup rows fit a broadcast (10^12 facts: 200,000).
HOT_ROWS = 5_000_000


def fits_broadcast(
    table: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> bool:
    """Measure a stored table (one small aggregate job) against the broadcast bounds."""
    def width(field: T.StructField) -> Column:
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            value = F.to_json(F.struct(value))
        elif not isinstance(field.dataType, T.StringType):
            return F.lit(16).cast("long")
        return F.coalesce(F.octet_length(value), F.lit(0)).cast("long") + 16

    width_of_row = reduce(lambda a, b: a + b, map(width, table.schema))
    rows, size = table.agg(F.count(F.lit(1)), F.sum(width_of_row)).first()
    return rows <= max_rows and (size or 0) <= max_bytes


def lookup(
    facts: DataFrame,
    dim: DataFrame,
    key: str,
    spread: Sequence[str],
    *,
    hot_dim: DataFrame | None = None,
    hot_rows: int = HOT_ROWS,
    measure: bool = True,
    rows_per_key: int | None = None,
) -> DataFrame:
    """Left-join ``dim`` (unique on ``key``) to ``facts``.

    A dim within the broadcast bounds is broadcast. Beyond them the hot keys are counted
    (map-side combined) and only their dim rows are broadcast; all other rows meet in a shuffle.
    A row already served by the broadcast, or without a key, is shuffled by ``spread``, columns
    that tell the rows of one key apart, so no key gathers in one task.

    ``hot_dim`` passes in the dim rows of hot keys if they are known already. ``measure=False``
    skips the counting job for a dim that is itself an expensive query. ``rows_per_key`` is the most
    fact rows that a key (or its absence) can have, if the caller knows: below ``hot_rows`` no key is
    hot, so nothing is counted, and the key alone deals the rows out, which facts may be dealt by already.
    """
    names = [name for name in dim.columns if name != key]
    if measure and fits_broadcast(dim):
        joined = facts.join(F.broadcast(dim), key, "left")
        return joined.select(*facts.columns, *names)

    payload = F.struct(*names)
    # Always 0, but not a literal: the optimizer would drop a literal from the join keys, and the
    # shuffle would go by the key alone.
    zero = F.pmod(F.xxhash64(key), F.lit(1))
    if rows_per_key is not None and rows_per_key < hot_rows:
        joined = facts.join(dim.select(key, payload.alias("_cold")), key, "left")
        # With the plain column, a filter on what was found would make this an inner join and take the
        # facts without a key away before any check that their own query makes.
        found = F.when(zero == 0, F.col("_cold"))
        return joined.select(*facts.columns, *[found.getField(name).alias(name) for name in names])

    if hot_dim is None:
        per_key = facts.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
        hot_keys = per_key.where(F.col("_rows") >= hot_rows).select(key)
        hot_dim = dim.join(F.broadcast(hot_keys), key, "left_semi")

    served = facts.join(
        F.broadcast(hot_dim.select(key, payload.alias("_hot"))), key, "left"
    )
    pending = F.col("_hot").isNull() & F.col(key).isNotNull()
    bucket = F.when(pending, F.lit(0).cast("long")).otherwise(
        F.lit(1) + F.pmod(F.xxhash64(*spread), F.lit(1 << 20))
    )
    cold_dim = dim.select(key, zero.alias("_bucket"), payload.alias("_cold"))
    joined = served.withColumn("_bucket", bucket).join(cold_dim, [key, "_bucket"], "left")
    found = F.coalesce("_hot", "_cold")
    return joined.select(*facts.columns, *[found.getField(name).alias(name) for name in names])
