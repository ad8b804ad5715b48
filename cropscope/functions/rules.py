"""Agronomy and economics rules as Column expressions.

Two versions of several rules exist in the original application and both are
kept apart by name: the batch-job form ("basic"/"plain") and the page form
("climate"/"floored"/"guarded").
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import constants as K
from .guards import classify, clip, col


def _d(c) -> Column:
    return col(c).cast("double")


def _p(x) -> Column:
    """Parameter as a double Column: a column name, a Column or a number."""
    if isinstance(x, (int, float)):
        return F.lit(float(x))
    return _d(x)


# --- water stress ------------------------------------------------------------

def water_stress_basic(ndvi, temperature) -> Column:
    """n = (ndvi+1)/2, t = (temp-10)/30 (not clipped); n < 0.01 -> 10;
    else (1-n) * t^2 * 10. Not clipped."""
    n = (_d(ndvi) + 1.0) / 2.0
    t = (_d(temperature) - K.TEMP_BASE) / K.TEMP_SPAN
    return (F.when(n.isNull() | t.isNull(), F.lit(None).cast("double"))
            .when(n < K.STRESS_NDVI_FLOOR, F.lit(K.STRESS_MAX))
            .otherwise((F.lit(1.0) - n) * t * t * F.lit(10.0)))


def water_stress_climate(ndvi, temperature, rainfall) -> Column:
    """clip(t * r / n, 0, 10) with n = clip((ndvi+1)/2, 0.01, 1),
    t = clip((temp-10)/30, 0, 1), r = clip(1 - rain/300, 0, 1)."""
    n = clip((_d(ndvi) + 1.0) / 2.0, K.STRESS_NDVI_FLOOR, 1.0)
    t = clip((_d(temperature) - K.TEMP_BASE) / K.TEMP_SPAN, 0.0, 1.0)
    r = clip(F.lit(1.0) - _d(rainfall) / K.RAIN_SPAN, 0.0, 1.0)
    return clip(t * r / n, 0.0, K.STRESS_MAX)


def stress_class(stress) -> Column:
    """> 7 severe, > 4 moderate, else normal."""
    s = col(stress)
    severe, moderate, normal = K.STRESS_LABELS
    return classify(s, [(s > K.STRESS_SEVERE, severe), (s > K.STRESS_MODERATE, moderate)],
                    normal)


def stress_advice(stress) -> Column:
    s = col(stress)
    severe, moderate, normal = K.STRESS_ADVICE
    return classify(s, [(s > K.STRESS_SEVERE, severe), (s > K.STRESS_MODERATE, moderate)],
                    normal)


# --- disease risk (rules) ----------------------------------------------------

def disease_risk_score(ndvi, humidity, leaf_wetness, temperature) -> Column:
    """(1-ndvi) * (h/100) * (w/10), x1.5 when 22 <= T <= 28, x0.7 when T > 30."""
    t = _p(temperature)
    base = (F.lit(1.0) - _d(ndvi)) * (_p(humidity) / 100.0) * (_p(leaf_wetness) / 10.0)
    # NaN temperature: every Python comparison is false, so no factor applies
    factor = (F.when(t.isNull(), F.lit(None).cast("double"))
              .when(F.isnan(t), F.lit(1.0))
              .when(t.between(K.DISEASE_TEMP_LOW, K.DISEASE_TEMP_HIGH),
                    F.lit(K.DISEASE_IDEAL_FACTOR))
              .when(t > K.DISEASE_HOT_TEMP, F.lit(K.DISEASE_HOT_FACTOR))
              .otherwise(F.lit(1.0)))
    return base * factor


def disease_risk_class(score) -> Column:
    """< 0.15 Low risk, < 0.3 Moderate risk, else High risk."""
    s = col(score)
    low, moderate, high = K.RISK_LABELS
    return classify(s, [(s < K.RISK_LOW, low), (s < K.RISK_MODERATE, moderate)], high)


def disease_advice(risk_class) -> Column:
    """Substring test on the class text, as the page does."""
    r = col(risk_class)
    high_advice, moderate_advice = K.DISEASE_ADVICE
    return (F.when(r.contains("High"), F.lit(high_advice))
            .when(r.contains("Moderate"), F.lit(moderate_advice)))


def risk_code_label(code) -> Column:
    """Classifier code -> text; anything else (NULL included) -> Unknown."""
    pairs = []
    for k, v in sorted(K.RISK_CODE_LABELS.items()):
        pairs += [F.lit(float(k)), F.lit(v)]
    m = F.create_map(*pairs)
    c = _d(code)
    return F.coalesce(F.when(c.isNotNull() & ~F.isnan(c), F.try_element_at(m, c)),
                      F.lit(K.RISK_CODE_UNKNOWN))


# --- economics -----------------------------------------------------------------

def profit_plain(yield_value, fertilizer_cost, labor_cost=K.DEFAULT_LABOR_COST,
                 crop_price=K.DEFAULT_CROP_PRICE) -> Column:
    """yield * price - (fertilizer + labor)."""
    return _d(yield_value) * _p(crop_price) - (_d(fertilizer_cost) + _p(labor_cost))


def profit_floored(yield_value, fertilizer_cost, labor_cost=K.DEFAULT_LABOR_COST,
                   crop_price=K.DEFAULT_CROP_PRICE) -> Column:
    """max(plain profit, -(fertilizer + labor)); NULL in gives NULL."""
    plain = profit_plain(yield_value, fertilizer_cost, labor_cost, crop_price)
    cost = _d(fertilizer_cost) + _p(labor_cost)
    return F.when(plain.isNull() | cost.isNull(), F.lit(None).cast("double")) \
        .otherwise(F.greatest(plain, -cost))


def roi_plain(yield_value, fertilizer_cost, crop_price=K.DEFAULT_CROP_PRICE) -> Column:
    """(yield*price - fert) / fert * 100; zero cost gives NULL (not a failure)."""
    fert = _d(fertilizer_cost)
    return F.try_divide(_d(yield_value) * _p(crop_price) - fert, fert) * 100.0


def roi_guarded(yield_value, fertilizer_cost, crop_price=K.DEFAULT_CROP_PRICE) -> Column:
    """fert <= 0 -> 0.0; else max(plain ROI, -100)."""
    fert = _d(fertilizer_cost)
    plain = (_d(yield_value) * _p(crop_price) - fert) / F.when(fert > 0, fert) * 100.0
    return (F.when(fert.isNull() | _d(yield_value).isNull(), F.lit(None).cast("double"))
            .when(fert <= 0, F.lit(0.0))
            .otherwise(F.greatest(plain, F.lit(K.ROI_FLOOR))))


def roi_class_a(roi) -> Column:
    """< 50 low, < 100 moderate, else excellent."""
    r = col(roi)
    low, moderate, excellent = K.ROI_A_LABELS
    return classify(r, [(r < K.ROI_A_LOW, low), (r < K.ROI_A_MODERATE, moderate)], excellent)


def roi_class_b(roi) -> Column:
    """> 200 excellent, > 100 good, else low."""
    r = col(roi)
    excellent, good, low = K.ROI_B_LABELS
    return classify(r, [(r > K.ROI_B_EXCELLENT, excellent), (r > K.ROI_B_GOOD, good)], low)


def yield_class(yield_value) -> Column:
    """> 2.5 Optimal, else Below Average."""
    y = col(yield_value)
    optimal, below = K.YIELD_LABELS
    return classify(y, [(y > K.YIELD_OPTIMAL, optimal)], below)


def scenario_advice(predicted_yield, stress, risk_class) -> Column:
    """First match wins: low yield, then high stress, then "High" risk; else NULL."""
    y, s, r = _d(predicted_yield), _d(stress), col(risk_class)
    low_yield, high_stress, high_risk = K.SCENARIO_ADVICE
    return (F.when(y < K.SCENARIO_LOW_YIELD, F.lit(low_yield))
            .when((s > K.SCENARIO_HIGH_STRESS) & ~F.isnan(s), F.lit(high_stress))
            .when(r.contains("High"), F.lit(high_risk)))


def trend_direction(trend) -> Column:
    """> 0 improving, else declining (zero counts as declining)."""
    t = col(trend)
    improving, declining = K.TREND_LABELS
    return classify(t, [(t > 0, improving)], declining)


def trend_colour(trend) -> Column:
    t = col(trend)
    green, red = K.TREND_COLOURS
    return classify(t, [(t > 0, green)], red)


def domain_violations(columns: dict[str, str] | None = None) -> Column:
    """Array of the names of the parameters outside their slider range.

    ``columns`` maps a domain name (see ``constants.DOMAINS``) to the column
    holding it; NULL values are reported as violations too.
    """
    columns = columns or {k: k for k in K.DOMAINS}
    checks = []
    for name, c in columns.items():
        lo, hi = K.DOMAINS[name]
        v = _d(c)
        ok = F.coalesce(v.between(lo, hi) & ~F.isnan(v), F.lit(False))
        checks.append(F.when(~ok, F.lit(name)))
    return F.filter(F.array(*checks), lambda x: x.isNotNull())
