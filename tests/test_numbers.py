import random

import pytest
from pyspark.sql import functions as F

from tallyspark.functions.numbers import fixed

TIES = [0.125, 0.375, 1.005, 1.015, 2.5, 3.5, 0.5, 1.5, -0.125, 0.00005, 0.00015, 0.00025, -0.0, 0.0, -1e-9, 1e-9, 0.99995, 9.995, 0.9999999, 1e9 + 0.5, 123456.789, 0.045, 0.285]


@pytest.mark.parametrize("digits,sign", [(0, False), (2, False), (3, False), (4, True), (4, False), (6, False)])
def test_text_equals_exact_rounding(spark, digits, sign):
    rng = random.Random(digits)
    values = TIES + [rng.uniform(-3, 3) for _ in range(3000)] + [rng.randint(-9999, 9999) / 2 ** rng.randint(1, 9) for _ in range(3000)]
    values += [rng.randint(-99999, 99999) / 10**rng.randint(1, 7) for _ in range(6000)] + [rng.uniform(0, 1e8) for _ in range(500)]
    frame = spark.createDataFrame([(v,) for v in [*values, None]], "v double")
    got = frame.select("v", fixed(F.col("v"), digits, sign).alias("t")).collect()
    spec = f"{'+' if sign else ''}.{digits}f"
    assert all(r.t == (None if r.v is None else format(r.v, spec)) for r in got), [
        (r.v, r.t) for r in got if r.v is not None and r.t != format(r.v, spec)
    ][:5]
