"""Run identifiers: a UTC millisecond stamp and the prompt version."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_DAY_MICROS = 86_400_000_000


def utc_stamp(ts: Column) -> Column:
    """``yyyyMMddTHHmmssSSSZ`` of an instant.

    Counted from the epoch: formatting functions use the session's time zone, and shifting into
    UTC before formatting is off by an hour around clock changes.
    """
    micros = F.unix_micros(ts)
    rest = F.pmod(micros, F.lit(_DAY_MICROS))
    day = F.date_from_unix_date(((micros - rest) / F.lit(_DAY_MICROS)).cast("int"))
    millis = F.floor(rest / F.lit(1000))

    def part(unit: int, size: int, digits: int) -> Column:
        value = F.pmod(F.floor(millis / F.lit(unit)), F.lit(size))
        return F.lpad(value.cast("string"), digits, "0")

    return F.concat(
        F.replace(day.cast("string"), F.lit("-"), F.lit("")),
        F.lit("T"),
        part(3_600_000, 24, 2),
        part(60_000, 60, 2),
        part(1_000, 60, 2),
        part(1, 1000, 3),
        F.lit("Z"),
    )


def run_id(ts: Column, version: Column) -> Column:
    return F.concat_ws("_", utc_stamp(ts), version)
