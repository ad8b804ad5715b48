"""Hand-made cases for the scalar rules (thresholds, NULL, NaN, zero denominators)."""

import math

import pytest
from pyspark.sql import functions as F

from cropscope.functions import (disease_advice, disease_risk_class, disease_risk_score,
                                 domain_violations, health_class, health_index, ndvi_guarded,
                                 ndvi_is_masked, ndvi_masked, profit_floored, profit_plain,
                                 risk_code_label, roi_class_a, roi_class_b, roi_guarded,
                                 roi_plain, scenario_advice, stress_class, trend_colour,
                                 trend_direction, water_stress_basic, water_stress_climate,
                                 yield_class)
from cropscope.functions.guards import clip

NAN = float("nan")


def one_col(spark, values, expr, schema="x double"):
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [r[0] for r in df.select(expr).collect()]


def close(a, b, tol=1e-12):
    if a is None or b is None:
        return a is b
    if isinstance(a, float) and math.isnan(a):
        return isinstance(b, float) and math.isnan(b)
    return abs(a - b) <= tol


def test_ndvi_hand_cases(spark):
    pairs = [(0.0, 0.0), (0.0, 3.0), (5.0, -5.0), (5.0, 0.0), (7.0, 9.0)]
    df = spark.createDataFrame(pairs, "red double, nir double")
    out = df.select(ndvi_guarded("red", "nir").alias("g"), ndvi_masked("red", "nir").alias("m"),
                    ndvi_is_masked("red", "nir").alias("f")).collect()
    assert [r.g for r in out] == pytest.approx([0.0, 1.0, -1.0, -1.0, 0.125])
    assert [r.m for r in out] == pytest.approx([-1.0, -1.0, -1.0, -1.0, 0.125])
    assert [r.f for r in out] == [True, True, True, True, False]


def test_ndvi_missing_inputs(spark):
    df = spark.createDataFrame([(None, 1.0), (NAN, 1.0), (1.0, NAN)], "red double, nir double")
    out = df.select(ndvi_guarded("red", "nir").alias("g"), ndvi_masked("red", "nir").alias("m")).collect()
    assert out[0].g is None and out[0].m == -1.0           # NULL band: masked form fills -1
    assert math.isnan(out[1].g) and out[1].m == -1.0       # NaN band: numpy fills -1 as well
    assert math.isnan(out[2].g) and out[2].m == -1.0


def test_clip_keeps_nan_and_null(spark):
    got = one_col(spark, [NAN, None, -3.0, 0.5, 3.0], clip(F.col("x"), -1, 1))
    assert math.isnan(got[0]) and got[1] is None and got[2:] == [-1.0, 0.5, 1.0]


def test_health_class_thresholds(spark):
    vals = [0.71, 0.7, 0.69, 0.51, 0.5, 0.49, 0.31, 0.3, 0.29, None, NAN]
    got = one_col(spark, vals, health_class(F.col("x")))
    assert got == ["Excellent", "Good", "Good", "Good", "Moderate", "Moderate", "Moderate",
                   "Poor", "Poor", None, "Poor"]
    assert one_col(spark, [-1.0, 0.0, 1.0], health_index(F.col("x"))) == [0.0, 0.5, 1.0]


def test_stress_basic(spark):
    df = spark.createDataFrame([(-1.0, 25.0), (0.0, 40.0), (0.0, 5.0), (-0.99, 25.0), (None, 1.0)],
                               "n double, t double")
    got = [r[0] for r in df.select(water_stress_basic("n", "t")).collect()]
    assert got[0] == 10.0                                    # normalised ndvi 0 < 0.01
    assert got[1] == pytest.approx(0.5 * 1.0 * 10)
    assert got[2] == pytest.approx(0.5 * (1 / 6) ** 2 * 10)   # 5 C is not clipped
    assert got[3] == 10.0                                    # normalised 0.005 < 0.01
    assert got[4] is None


def test_stress_climate_bounds_and_classes(spark):
    df = spark.createDataFrame([(-1.0, 40.0, 0.0), (1.0, 10.0, 300.0), (0.0, 25.0, 150.0)],
                               "n double, t double, r double")
    got = [r[0] for r in df.select(water_stress_climate("n", "t", "r")).collect()]
    assert got == pytest.approx([10.0, 0.0, 0.5 * 0.5 / 0.5])
    cls = one_col(spark, [7.01, 7.0, 6.99, 4.01, 4.0, 3.99, None],
                  stress_class(F.col("x")))
    assert cls == ["severe", "moderate", "moderate", "moderate", "normal", "normal", None]


def test_disease_risk(spark):
    df = spark.createDataFrame([(0.0, 100.0, 10.0, 22.0), (0.0, 100.0, 10.0, 28.0),
                                (0.0, 100.0, 10.0, 21.9), (0.0, 100.0, 10.0, 30.0),
                                (0.0, 100.0, 10.0, 30.1), (0.0, 100.0, 10.0, NAN)],
                               "n double, h double, w double, t double")
    got = [r[0] for r in df.select(disease_risk_score("n", "h", "w", "t")).collect()]
    assert got == pytest.approx([1.5, 1.5, 1.0, 1.0, 0.7, 1.0])
    cls = one_col(spark, [0.14, 0.15, 0.16, 0.29, 0.3, 0.31, None], disease_risk_class(F.col("x")))
    assert cls == ["Low risk", "Moderate risk", "Moderate risk", "Moderate risk", "High risk",
                   "High risk", None]
    adv = one_col(spark, ["High risk", "Moderate risk", "Low risk"], disease_advice(F.col("x")),
                  "x string")
    assert adv == ["Apply fungicide treatment", "Monitor closely and improve airflow", None]


def test_economics(spark):
    df = spark.createDataFrame([(2.0, 100.0), (2.0, 0.0), (2.0, -10.0), (-1.0, 100.0),
                                (None, 1.0)], "y double, f double")
    out = df.select(profit_plain("y", "f").alias("pp"), profit_floored("y", "f").alias("pf"),
                    roi_plain("y", "f").alias("rp"), roi_guarded("y", "f").alias("rg")).collect()
    assert out[0].pp == pytest.approx(360 - 250) and out[0].rp == pytest.approx(260.0)
    assert out[1].rp is None and out[1].rg == 0.0           # zero cost: NULL plain, 0 guarded
    assert out[2].rg == 0.0                                  # negative cost: 0 guarded
    assert out[3].pp == pytest.approx(-180 - 250) and out[3].pf == pytest.approx(-250.0)
    assert out[3].rg == -100.0                               # floor at -100 %
    assert out[4].pp is None and out[4].pf is None and out[4].rg is None


def test_roi_and_yield_classes(spark):
    a = one_col(spark, [49.9, 50.0, 99.9, 100.0], roi_class_a(F.col("x")))
    assert a == ["low", "moderate", "moderate", "excellent"]
    b = one_col(spark, [200.1, 200.0, 100.1, 100.0], roi_class_b(F.col("x")))
    assert b == ["excellent", "good", "good", "low"]
    y = one_col(spark, [2.51, 2.5, None, NAN], yield_class(F.col("x")))
    assert y == ["Optimal", "Below Average", None, "Below Average"]


def test_trend_labels(spark):
    assert one_col(spark, [0.1, 0.0, -0.1], trend_direction(F.col("x"))) == \
        ["improving", "declining", "declining"]
    assert one_col(spark, [0.1, 0.0], trend_colour(F.col("x"))) == ["green", "red"]


def test_scenario_advice_order(spark):
    df = spark.createDataFrame([(1.9, 7.0, "High risk"), (2.0, 6.1, "High risk"),
                                (2.0, 6.0, "High risk"), (2.0, 6.0, "Low risk")],
                               "y double, s double, r string")
    got = [r[0] for r in df.select(scenario_advice("y", "s", "r")).collect()]
    assert got[0].startswith("Low yield") and got[1].startswith("High water")
    assert got[2].startswith("Disease risk") and got[3] is None


def test_risk_code_label(spark):
    got = one_col(spark, [0.0, 1.0, 2.0, 3.0, 4.0, None], risk_code_label(F.col("x")))
    assert got == ["No risk", "Low risk", "Medium risk", "High risk", "Unknown", "Unknown"]


def test_domain_violations(spark):
    df = spark.createDataFrame([(100.0, 25.0), (301.0, 9.0), (None, 40.0)],
                               "rainfall double, temperature double")
    got = [r[0] for r in df.select(domain_violations(
        {"rainfall": "rainfall", "temperature": "temperature"})).collect()]
    assert got == [[], ["rainfall", "temperature"], ["rainfall"]]


def test_formatting(spark):
    from cropscope.functions import formatting as fmt
    df = spark.createDataFrame([(0.625, 110.0, 0.12344)], "s double, m double, v double")
    r = df.select(fmt.percent("s").alias("p"), fmt.money("m").alias("d"), fmt.fixed("v").alias("f")).first()
    assert (r.p, r.d, r.f) == ("62.5%", "$110.00", "0.1234")
    ties = [0.0625, 0.1875, 0.0635, 0.0645, 0.0, 1.0, -0.0625, 0.12345, 0.9995]
    frame = spark.createDataFrame([(x,) for x in ties], "s double")
    assert [r.p for r in frame.select(fmt.percent("s").alias("p")).collect()] == \
        [f"{x:.1%}" for x in ties]


def test_number_text_rounds_the_binary_value(spark):
    import random

    from cropscope.functions import formatting as fmt
    rng = random.Random(3)
    xs = [1.005, 0.00015, 2.675, 0.125, 0.375, -0.125, 0.5, 2.5, -0.001, -0.0, 0.0, 1e15, 123456789.125,
          NAN, float("inf"), float("-inf"), 0.99995, 9.9999999, 1e-300]
    xs += [rng.uniform(-10, 10) for _ in range(300)]
    xs += [rng.randrange(-10**6, 10**6) / 10 ** rng.randrange(1, 7) for _ in range(500)]
    xs += [(2 * rng.randrange(10**5) + 1) / 2 ** rng.randrange(1, 12) for _ in range(200)]
    frame = spark.createDataFrame([(float(x),) for x in xs], "x double")
    got = frame.select("x", fmt.fixed("x").alias("f"), fmt.money("x").alias("m"),
                       fmt.percent("x").alias("p")).collect()
    assert [(r.f, r.m, r.p) for r in got] == [(f"{x:.4f}", f"${x:.2f}", f"{x:.1%}") for x in xs]
    none = spark.createDataFrame([(None,)], "x double").select(fmt.money("x").alias("m")).first()
    assert none.m is None


@pytest.mark.parametrize("bad", [None, NAN])
def test_null_and_nan_in_every_numeric_input(spark, bad):
    """Each input of each rule set to NULL or NaN in turn: no error; NULL in gives
    NULL out for the numeric rules; NaN never lands in a top class."""
    base = {"n": 0.2, "t": 25.0, "r": 100.0, "h": 65.0, "w": 5.0, "y": 2.0, "f": 100.0}
    exprs = {
        "basic": lambda: water_stress_basic("n", "t"),
        "climate": lambda: water_stress_climate("n", "t", "r"),
        "risk": lambda: disease_risk_score("n", "h", "w", "t"),
        "profit_plain": lambda: profit_plain("y", "f"),
        "profit_floored": lambda: profit_floored("y", "f"),
        "roi_plain": lambda: roi_plain("y", "f"),
        "roi_guarded": lambda: roi_guarded("y", "f"),
        "ndvi_g": lambda: ndvi_guarded("r", "n"),
    }
    uses = {"basic": "nt", "climate": "ntr", "risk": "nhwt", "profit_plain": "yf",
            "profit_floored": "yf", "roi_plain": "yf", "roi_guarded": "yf", "ndvi_g": "rn"}
    schema = ", ".join(f"{k} double" for k in base)
    for name, make in exprs.items():
        for col_name in uses[name]:
            row = dict(base)
            row[col_name] = bad
            df = spark.createDataFrame([tuple(row[k] for k in base)], schema)
            v = df.select(make().alias("v")).first().v
            if bad is None:
                assert v is None, (name, col_name, v)
            elif (name, col_name) == ("risk", "t"):
                # NaN temperature: no temperature factor applies (Python semantics)
                assert v == pytest.approx((1 - 0.2) * 0.65 * 0.5)
            else:
                assert v is None or math.isnan(v), (name, col_name, v)
    # classes: NULL -> NULL, NaN -> the last else branch
    df = spark.createDataFrame([(bad,)], "x double")
    got = df.select(health_class("x").alias("h"), stress_class("x").alias("s"),
                    disease_risk_class("x").alias("d"), roi_class_a("x").alias("a"),
                    roi_class_b("x").alias("b"), yield_class("x").alias("y"),
                    trend_direction("x").alias("t")).first()
    if bad is None:
        assert all(v is None for v in got)
    else:
        assert tuple(got) == ("Poor", "normal", "High risk", "excellent", "low",
                              "Below Average", "declining")
