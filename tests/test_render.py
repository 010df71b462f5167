"""float_text reproduces Python's number printing inside Spark."""

import numpy as np
from pyspark.sql import functions as F

from sacctlens.functions import render

FIXED = [0.0, 0.8, 0.35, 1.0, 116148.0675, 22844.77666666667, 39.87555555555556,
         0.0002777777777777778, 0.00027, 1e-4, 1.5e-5, 9.999e-5, 12345678.5, 1e7, 10000000.0,
         123456789012345.6, 1e15, 1e16, 2.5e16, 1.2345e22, -3.5, -1234567890.25, 3600.0 / 3600,
         1 / 3, 2 / 3, 7.0e-3, 0.001]


def _spark_render(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    return [r[0] for r in render.with_float_text(df, "v", "t").select("t").collect()]


def test_fixed_values(spark):
    assert _spark_render(spark, FIXED) == [repr(float(v)) for v in FIXED]


def test_random_values(spark):
    """One job over 5000 doubles spread over 1e-300 .. 1e300 (both signs)."""
    rng = np.random.default_rng(7)
    mags = 10.0 ** rng.uniform(-300, 300, 2500)
    near = rng.uniform(-1e6, 1e6, 2500) / rng.choice([1, 3, 7, 3600, 1048576], 2500)
    values = np.concatenate([mags * rng.choice([-1, 1], 2500), near]).tolist()
    got = _spark_render(spark, values)
    bad = [(v, g) for v, g in zip(values, got) if g != repr(v)]
    assert not bad, bad[:5]


def test_fixed_text_rounds_like_printf(spark):
    """%.2f / %.1f as Python prints them, ties included (0.125 -> 0.12, 1.005 -> 1.00)."""
    rng = np.random.default_rng(3)
    values = [0.125, 1.005, 2.675, 0.375, -0.0, 0.0, 1234567.125, 3936.7291666666665]
    values += np.round(rng.uniform(0, 100, 2000), 3).tolist() + (rng.integers(0, 100000, 1000) / 8).tolist()
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    rows = df.select(render.fixed_text(F.col("v"), 2).alias("a"), render.fixed_text(F.col("v"), 1).alias("b")).collect()
    assert [r.a for r in rows] == [f"{v:.2f}" for v in values]
    assert [r.b for r in rows] == [f"{v:.1f}" for v in values]
