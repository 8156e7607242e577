"""Numbers as text, rounded by their exact binary value."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Splits a double into two halves of 26 bits whose products are exact.
_SPLIT = 134_217_729.0


def fixed(value: Column, digits: int, sign: bool = False) -> Column:
    """A double with a fixed number of decimals; half-way values go to the even digit.

    Format functions of the JVM round the shortest decimal text of a number, half up: 0.125 becomes
    0.13, and 1.015, which is a little less in binary, 1.02. Here the scaled value is an exact sum of
    a product and its error, and only a true half is a tie. ``sign`` also writes a plus. Exact below
    2**52 after scaling; null stays null.
    """
    scale = 10.0**digits
    high = _SPLIT * scale - (_SPLIT * scale - scale)
    low = scale - high

    def halves(v: Column) -> Column:
        spread = F.lit(_SPLIT) * F.abs(v)
        upper = spread - (spread - F.abs(v))
        return F.struct(v.alias("v"), F.abs(v).alias("size"), upper.alias("upper"), (F.abs(v) - upper).alias("lower"))

    def product(h: Column) -> Column:
        whole = h["size"] * F.lit(scale)
        error = (h["upper"] * F.lit(high) - whole) + h["upper"] * F.lit(low) + h["lower"] * F.lit(high)
        return F.struct(h["v"].alias("v"), whole.alias("product"), (error + h["lower"] * F.lit(low)).alias("error"))

    def parted(p: Column) -> Column:
        whole = F.floor(p["product"])
        return F.struct(
            p["v"].alias("v"), whole.alias("whole"), (p["product"] - whole.cast("double")).alias("rest"), p["error"].alias("error")
        )

    def digits_of(p: Column) -> Column:
        is_odd = F.pmod(p["whole"], F.lit(2).cast("long")) == 1
        up = (p["rest"] > 0.5) | ((p["rest"] == 0.5) & ((p["error"] > 0) | ((p["error"] == 0) & is_odd)))
        text = (p["whole"] + F.when(up, 1).otherwise(0)).cast("string")
        # Zeros in front keep at least one digit before the point.
        padded = F.when(F.length(text) <= digits, F.lpad(text, digits + 1, "0")).otherwise(text)
        head = F.when(p["v"].cast("string").startswith("-"), "-").otherwise("+" if sign else "")
        return F.struct(head.alias("head"), padded.alias("text"))

    def joined(t: Column) -> Column:
        if not digits:
            return F.concat(t["head"], t["text"])
        before = F.substring(t["text"], F.lit(1), F.length(t["text"]) - digits)
        return F.concat(t["head"], before, F.lit("."), F.right(t["text"], F.lit(digits)))

    # Each step is a function of one element, so it is computed once and not again wherever it is used.
    steps = F.array(value)
    for step in (halves, product, parted, digits_of, joined):
        steps = F.transform(steps, step)
    return F.when(value.isNotNull(), F.element_at(steps, 1))
