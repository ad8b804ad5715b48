"""Property tests (hypothesis): bounds that must hold for any input."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cropscope.functions import (ndvi_guarded, ndvi_masked, profit_floored, roi_guarded,
                                 water_stress_climate)
from cropscope.operators import models, scenario

finite = st.floats(-1e6, 1e6, allow_nan=False, allow_infinity=False)
small = st.floats(-500, 500, allow_nan=False, allow_infinity=False)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(finite, finite), min_size=1, max_size=60))
def test_ndvi_in_range(spark, pairs):
    df = spark.createDataFrame([(float(a), float(b)) for a, b in pairs], "red double, nir double")
    out = df.select(ndvi_guarded("red", "nir").alias("g"), ndvi_masked("red", "nir").alias("m"))
    bad = out.where(~F.col("g").between(-1, 1) | ~F.col("m").between(-1, 1)).count()
    assert bad == 0


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.floats(-1, 1), small, st.floats(0, 1000)), min_size=1, max_size=60))
def test_climate_stress_in_range(spark, rows):
    df = spark.createDataFrame([tuple(float(v) for v in r) for r in rows],
                               "n double, t double, r double")
    s = df.select(water_stress_climate("n", "t", "r").alias("s"))
    assert s.where(~F.col("s").between(0, 10)).count() == 0


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(small, small, st.floats(0, 500), st.floats(1, 400)), min_size=1,
                max_size=60))
def test_profit_and_roi_floors(spark, rows):
    df = spark.createDataFrame([tuple(float(v) for v in r) for r in rows],
                               "y double, f double, l double, p double")
    out = df.select("f", "l", profit_floored("y", "f", "l", "p").alias("profit"),
                    roi_guarded("y", "f", "p").alias("roi"))
    assert out.where(F.col("roi") < -100).count() == 0
    assert out.where(F.col("profit") < -(F.col("f") + F.col("l")) - 1e-9).count() == 0


@settings(max_examples=2, deadline=None)
@given(st.integers(1, 20), st.integers(1, 9))
def test_every_scenario_request_is_scored(spark, n_fields, n_scen):
    """One row out per request, also for a field nobody knows and with a NULL feature."""
    fields = spark.range(n_fields).select(F.col("id").alias("field_id"),
                                          F.lit(60.0).alias("humidity"),
                                          F.lit(5.0).alias("leaf_wetness"))
    asked = spark.range((n_fields + 1) * n_scen).select(
        (F.col("id") % (n_fields + 1)).alias("field_id"), F.col("id").alias("scenario_id"),
        F.lit(10.0).alias("rainfall"), F.lit(20.0).alias("temperature"),
        F.lit(50.0).alias("fertilizer"),
        F.when(F.col("id") > 0, F.lit(0.1)).alias("ndvi"))
    frame = spark.range(10).select((F.col("id") / 10.0).alias("ndvi"),
                                   (F.col("id") / 5.0 + 1.0).alias("yield"))
    model = models.fit(models.linear_yield_pipeline(["ndvi"]), frame)
    out = scenario.scenario_report(asked, fields, model)
    assert out.count() == (n_fields + 1) * n_scen
    missing = out.where("scenario_id = 0").first()
    assert missing.predicted_yield is None
    assert out.where("scenario_id <> 0 and abs(predicted_yield - 1.2) > 1e-6").count() == 0
