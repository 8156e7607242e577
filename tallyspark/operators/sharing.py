"""Computing a result once for several readers, without storing it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The rows that may be brought to the driver as a bounded local table.
LOCAL_ROWS = 200_000


def one_pass(rows: DataFrame) -> DataFrame:
    """The same rows, in a form that all readers within one query compute together.

    Spark reuses a shuffle that occurs twice in a plan, but each reader's column pruning makes its
    copy of the plan a different one, and then the source is read once per reader. Grouping by all
    columns stops the pruning; over unique rows it changes nothing, and it needs no shuffle of its own
    where an aggregate below has dealt the rows out by some of the columns. The count is there because
    a plain `distinct` over unique rows is optimised away. Nothing is persisted or written, so nothing
    has to be released.

    The rows must be unique, and their columns of types that can be compared.
    """
    counted = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("_same"))
    return counted.where("_same > 0").drop("_same")


def local_copy(rows: DataFrame, at_most: int = LOCAL_ROWS) -> DataFrame | None:
    """The rows as a local table if they are at most ``at_most``, else None; one job either way.

    A local table has a known size: joined with larger ones it is broadcast without being computed
    again.
    """
    found = rows.limit(at_most + 1).toArrow()
    if found.num_rows > at_most:
        return None
    return rows.sparkSession.createDataFrame(found, rows.schema)
