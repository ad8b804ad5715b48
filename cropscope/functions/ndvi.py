"""Vegetation index and crop-health scalar rules (Column -> Column)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import constants as K
from .guards import classify, clip, col, is_missing


def ndvi_masked(red, nir) -> Column:
    """NDVI of the batch job: a band value <= 0 (or missing) masks the pixel;
    (nir - red) / (nir + red), clipped to [-1, 1]; masked pixels become -1."""
    r = col(red).cast("double")
    n = col(nir).cast("double")
    r_ok = F.when(~is_missing(r) & (r > 0), r)
    n_ok = F.when(~is_missing(n) & (n > 0), n)
    den = n_ok + r_ok
    raw = F.try_divide(n_ok - r_ok, F.when(den != 0, den))
    return F.coalesce(clip(raw, K.NDVI_MIN, K.NDVI_MAX), F.lit(K.NDVI_MASKED_FILL))


def ndvi_is_masked(red, nir) -> Column:
    """True where ``ndvi_masked`` filled the pixel instead of computing it."""
    r = col(red).cast("double")
    n = col(nir).cast("double")
    return ~((~is_missing(r) & (r > 0)) & (~is_missing(n) & (n > 0)))


def ndvi_guarded(red, nir) -> Column:
    """NDVI of the raw-image page: no mask; a zero denominator becomes 0.01;
    clipped to [-1, 1]. A 0/0 pixel gives 0; NULL in gives NULL."""
    r = col(red).cast("double")
    n = col(nir).cast("double")
    den = n + r
    safe = F.when(den == 0, F.lit(K.NDVI_ZERO_DENOMINATOR)).otherwise(den)
    return clip((n - r) / safe, K.NDVI_MIN, K.NDVI_MAX)


def health_index(ndvi) -> Column:
    """Crop health index (ndvi + 1) / 2."""
    return (col(ndvi).cast("double") + F.lit(1.0)) / F.lit(2.0)


def health_class(health) -> Column:
    """> 0.7 Excellent, > 0.5 Good, > 0.3 Moderate, else Poor."""
    h = col(health)
    ex, good, mod, poor = K.HEALTH_LABELS
    return classify(h, [(h > K.HEALTH_EXCELLENT, ex), (h > K.HEALTH_GOOD, good),
                        (h > K.HEALTH_MODERATE, mod)], poor)


def valid_ndvi(ndvi) -> Column:
    """Strictly inside (-1, 1); NaN and NULL are not valid."""
    v = col(ndvi)
    return F.coalesce((v > K.NDVI_MIN) & (v < K.NDVI_MAX) & ~F.isnan(v), F.lit(False))


def band_pair(has: Callable[[int], Column]) -> Column:
    """Band pair (red, nir): the first of (4, 8), (3, 4), (1, 2) whose bands the
    image both holds; NULL without one. ``has(k)`` tells whether band k is there."""
    pairs = [F.when(has(red) & has(nir), F.struct(F.lit(red).alias("red_band"),
                                                  F.lit(nir).alias("nir_band")))
             for red, nir in K.BAND_PAIRS]
    return F.coalesce(*pairs)
