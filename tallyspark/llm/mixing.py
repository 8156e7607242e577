"""Mixing sources to target weights by weighted fair queueing, with DataFrame functions.

Every source queues its documents in a shuffled order, twice if its target exceeds its size. A queued
copy finishes at virtual time (words queued up to and with it) / target, the copies of all sources are
ordered by finish time, and the order is cut where the words reach the total budget.

Sizes are words. Sources by code point, null last, weigh 5, 2, 1 in turn and share 1.5 times all
words; a target stops at twice its source's size and the excess goes to the others by weight.
The shuffle is the order of md5(seed:doc_id); ties and repeated ids are ordered by a digest of
the text, and equal rows are interchangeable. Null texts have size 0 and are taken with 0 words.

No source and no total is summed in one task: documents fall into hash buckets, only bucket sums
(about one per `BUCKET_ROWS` rows) go through a window, and the cut looks at a histogram of finish
times before it orders the one bin that holds the cut.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.llm.shared import stored

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST_COPIES = 2
BUCKET_ROWS = 4_096
SEED = 17


def word_count(text: Column) -> Column:
    """Runs of anything but ASCII white space."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame) -> DataFrame:
    """source, source_size -> also weight and target. One row per source, the only table seen whole."""
    order = Window.orderBy(F.col("source").isNull(), "source")
    rank = (F.row_number().over(order) - 1) % len(WEIGHTS) + 1
    weighed = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), rank.cast("int")))
    # Sources fill in the order in which a common level per weight reaches their limits.
    limit = F.col("source_size") * float(MOST_COPIES)
    by_limit = Window.orderBy(limit / F.col("weight"), F.col("source").isNull(), "source")
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    total = Window.partitionBy()
    filled = (
        weighed.withColumn("budget", F.sum("source_size").over(total) * SHARE)
        .withColumn("spent", F.coalesce(F.sum(limit).over(before), F.lit(0.0)))
        .withColumn("open", F.sum("weight").over(total) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        .withColumn("level", (F.col("budget") - F.col("spent")) / F.col("open"))
        .withColumn("full", limit / F.col("weight") <= F.col("level"))
    )
    # The level of the first source that is not full holds for all that follow.
    level = F.min(F.when(~F.col("full"), F.struct((limit / F.col("weight")).alias("at"), "level"))).over(total)["level"]
    target = F.when(F.col("full"), limit).otherwise(level * F.col("weight"))
    return filled.select("source", "source_size", "weight", target.alias("target"))


def _running(frame: DataFrame, parts: list[str], bins: str, order: list[Column], amount: str, out: str) -> DataFrame:
    """Adds the sum of `amount` up to and with each row, by bins: sums of bins first, rows inside after."""
    keys = [*parts, bins]
    sums = frame.groupBy(*keys).agg(F.sum(amount).alias("__sum"))
    before = Window.partitionBy(*parts).orderBy(bins).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("__before", F.coalesce(F.sum("__sum").over(before), F.lit(0))).drop("__sum")
    sums = sums.select(*[F.col(k).alias(f"__{k}") for k in keys], "__before")
    same = None
    for k in keys:
        one = F.col(k).eqNullSafe(F.col(f"__{k}"))
        same = one if same is None else same & one
    within = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    summed = frame.withColumn("__within", F.sum(amount).over(within))
    return summed.join(sums, same).withColumn(out, F.col("__before") + F.col("__within")).drop(
        "__before", "__within", *[f"__{k}" for k in keys]
    )


def mix(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """doc_id, source, size, source_size, target, copies, taken for every document."""
    rows = docs.select(
        "doc_id",
        "source",
        word_count(F.col("text")).alias("size"),
        F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))).alias("draw"),
        F.md5(F.coalesce("text", F.lit(""))).alias("tie"),
    )
    rows = stored(rows, "mix-rows")  # small columns only; texts are read once
    count = rows.count()
    buckets = 1
    while buckets * BUCKET_ROWS < count:
        buckets *= 2
    goal = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")))
    goal = stored(goal, "mix-targets").withColumnRenamed("source", "__source")
    bucket = F.pmod(F.conv(F.substring("draw", 1, 12), 16, 10).cast("long"), F.lit(buckets))
    queued = _running(
        rows.withColumn("bucket", bucket), ["source"], "bucket", [F.col("draw"), F.col("tie"), F.col("doc_id")], "size", "queued"
    )
    # One row per source: a few for corpora, and the join is on a hash table of names and numbers.
    queued = queued.join(goal, F.col("source").eqNullSafe(F.col("__source"))).drop("__source")
    copies = queued.withColumn("copy", F.explode(F.array(*[F.lit(k) for k in range(MOST_COPIES)])))
    finish = (F.col("queued") + F.col("copy") * F.col("source_size")) / F.when(F.col("target") > 0, F.col("target")).otherwise(1.0)
    # All sources reach their targets at time 1, so the cut is near it and what ends after 2 shares a bin.
    copies = copies.withColumn("finish", finish)
    copies = stored(copies.withColumn("bin", F.floor(F.least("finish", F.lit(2.0)) * buckets).cast("long")), "mix-queue")
    total = goal.agg(F.sum("target").alias("budget"))
    # Bin sums: at most 2 * buckets + 1 rows.
    bins = copies.groupBy("bin").agg(F.sum("size").alias("words"))
    bins = bins.withColumn("end", F.sum("words").over(Window.orderBy("bin"))).crossJoin(F.broadcast(total))  # one row
    bins = bins.select(F.col("bin").alias("__bin"), (F.col("end") - F.col("words")).alias("begin"), "end", "budget")
    placed = copies.join(bins, F.col("bin") == F.col("__bin")).drop("__bin")
    whole = placed.where(F.col("end") <= F.col("budget")).select("doc_id", "source", "draw", "tie", "size")
    cut = placed.where((F.col("begin") < F.col("budget")) & (F.col("end") > F.col("budget")))
    order = Window.orderBy("finish", F.col("source").isNull(), "source", "draw", "tie", "doc_id", "copy")
    reached = F.col("begin") + F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0))
    cut = cut.withColumn("reached", reached).where(F.col("reached") <= F.col("budget"))
    taken = whole.unionAll(cut.select("doc_id", "source", "draw", "tie", "size"))
    keys = ["doc_id", "source", "draw", "tie", "size"]
    # Repeated rows share their copies evenly enough: all rows of a key are counted together.
    every = rows.select(*keys, F.lit(0).alias("got"), F.lit(1).alias("rows"))
    every = every.unionAll(taken.select(*keys, F.lit(1).alias("got"), F.lit(0).alias("rows")))
    grouped = every.groupBy(*keys).agg(F.sum("got").alias("got"), F.sum("rows").alias("rows"))
    spread = grouped.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("rows"))))
    each = F.floor(F.col("got") / F.col("rows")) + (F.col("k") <= F.col("got") % F.col("rows")).cast("int")
    return (
        spread.withColumn("copies", each.cast("int"))
        .join(goal, F.col("source").eqNullSafe(F.col("__source")))
        .select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))
    )
