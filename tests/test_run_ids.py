import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tallyspark.functions.run_ids import run_id, utc_stamp

UTC = dt.timezone.utc


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kathmandu"])
def test_stamp_is_utc_in_every_session(spark, zone):
    rng = random.Random(4)
    # Clock changes of 2024 in New York, the epoch, the end of a day, and random instants.
    anchors = [dt.datetime(2024, 3, 10, 7), dt.datetime(2024, 11, 3, 6), dt.datetime(1970, 1, 1),
               dt.datetime(2024, 2, 29, 23, 59, 59, 999999), dt.datetime(1969, 12, 31, 23, 59, 59)]
    instants = [a + dt.timedelta(minutes=m) for a in anchors for m in (-90, -30, 0, 30, 90)]
    instants += [dt.datetime(2000, 1, 1) + dt.timedelta(seconds=rng.uniform(0, 1e9))
                 for _ in range(200)]
    epoch = dt.datetime(1970, 1, 1)
    micros = [((i - epoch) // dt.timedelta(microseconds=1), i) for i in instants]
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        frame = spark.createDataFrame([(m,) for m, _ in micros], "m long")
        ts = F.timestamp_micros("m")
        out = frame.select("m", utc_stamp(ts).alias("s"), run_id(ts, F.lit("v1")).alias("r"))
        got = {row["m"]: (row["s"], row["r"]) for row in out.collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    for m, instant in micros:
        stamp = instant.strftime("%Y%m%dT%H%M%S") + f"{instant.microsecond // 1000:03d}Z"
        assert got[m] == (stamp, stamp + "_v1")
