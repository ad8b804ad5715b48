"""Per-scene and per-band aggregates over pixel tables.

All aggregates here are algebraic (count/sum/min/max/moments), so Spark runs
them as partial + final HashAggregate: each task folds its own rows before
the shuffle and a scene holding a third of all pixels still ships one small
buffer per task. The only holistic statistic, the median, goes through
``operators.quantile.exact_median`` which never gathers a group in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.guards import clip, nan_to_null
from ..functions.ndvi import (band_pair, health_class, health_index, ndvi_guarded,
                              ndvi_is_masked, ndvi_masked, valid_ndvi)
from . import quantile


def with_ndvi_guarded(pixels: DataFrame, red: str = "red", nir: str = "nir",
                      out: str = "ndvi") -> DataFrame:
    """P2 applied to every pixel."""
    return pixels.withColumn(out, ndvi_guarded(red, nir))


def with_ndvi_masked(pixels: DataFrame, red: str = "red", nir: str = "nir",
                     out: str = "ndvi") -> DataFrame:
    """P1 applied to every pixel, plus the ``is_masked`` flag."""
    return (pixels.withColumn("is_masked", ndvi_is_masked(red, nir))
            .withColumn(out, ndvi_masked(red, nir)))


def _nan_skipping_aggs(v: Column, prefix: str = "") -> list[Column]:
    """NaN-skipping mean/min/max/population std (numpy nan* functions)."""
    x = nan_to_null(v)
    return [F.avg(x).alias(f"{prefix}mean_ndvi"), F.min(x).alias(f"{prefix}min_ndvi"),
            F.max(x).alias(f"{prefix}max_ndvi"), F.stddev_pop(x).alias(f"{prefix}std_ndvi")]


def scene_ndvi_stats(pixels: DataFrame, key="scene_id", ndvi: str = "ndvi") -> DataFrame:
    """A1 + A2: NaN-skipping mean/min/max/std, valid pixels strictly inside
    (-1, 1), total pixels and the valid share."""
    keys = [key] if isinstance(key, str) else list(key)
    v = F.col(ndvi)
    return pixels.groupBy(*keys).agg(
        *_nan_skipping_aggs(v),
        F.count_if(valid_ndvi(v)).alias("valid_pixels"),
        F.count(F.lit(1)).alias("total_pixels"),
    ).withColumn("healthy_share", F.col("valid_pixels") / F.col("total_pixels"))


def scene_health_report(band_samples: DataFrame, key: str = "scene_id") -> DataFrame:
    """Flagship (G7 core): guarded NDVI per pixel -> per-scene statistics ->
    crop-health index and class."""
    stats = scene_ndvi_stats(with_ndvi_guarded(band_samples), key)
    return (stats.withColumn("health_index", health_index("mean_ndvi"))
            .withColumn("health_class", health_class("health_index")))


def scene_ndvi_stats_with_median(pixels: DataFrame, key: str = "scene_id",
                                 ndvi: str = "ndvi", skip_masked: bool = False,
                                 approximate: bool = False) -> DataFrame:
    """A3: after clipping to [-1, 1]: min, max, mean, exact median and
    population std. NaN is not skipped (a NaN pixel makes mean/std NaN).

    ``skip_masked`` drops pixels flagged ``is_masked`` first (D8; default keeps
    them, as the original does). ``approximate`` swaps the exact median for
    ``percentile_approx``.
    """
    px = pixels
    if skip_masked:
        px = px.filter(~F.col("is_masked"))
    px = px.select(key, clip(F.col(ndvi), K.NDVI_MIN, K.NDVI_MAX).alias("_v"))
    if approximate:
        return px.groupBy(key).agg(
            F.min("_v").alias("min_ndvi"), F.max("_v").alias("max_ndvi"),
            F.avg("_v").alias("mean_ndvi"), F.stddev_pop("_v").alias("std_ndvi"),
            F.count("_v").alias("pixels"),
            F.percentile_approx("_v", 0.5, 10000).cast("double").alias("median_ndvi"))
    # one scan: moments and the exact median come from the same bucket histogram
    s = quantile.group_summary(px, key, "_v", bounds=(K.NDVI_MIN, K.NDVI_MAX))
    return s.select(key, F.col("min").alias("min_ndvi"), F.col("max").alias("max_ndvi"),
                    F.col("mean").alias("mean_ndvi"), F.col("std").alias("std_ndvi"),
                    F.col("n").alias("pixels"), F.col("median").alias("median_ndvi"))


def masked_pixel_summary(pixels_with_flag: DataFrame, key: str = "scene_id",
                         ndvi: str = "ndvi") -> DataFrame:
    """P1 + F2 + A2 with the D8 flag: per scene total, masked and valid pixels,
    the valid share and the mean with and without masked pixels."""
    v = F.col(ndvi)
    m = F.col("is_masked")
    return pixels_with_flag.groupBy(key).agg(
        F.count(F.lit(1)).alias("total_pixels"),
        F.count_if(m).alias("masked_pixels"),
        F.count_if(valid_ndvi(v)).alias("valid_pixels"),
        F.avg(v).alias("mean_ndvi"),
        F.avg(F.when(~m, v)).alias("mean_ndvi_unmasked"),
    ).withColumn("valid_share", F.col("valid_pixels") / F.col("total_pixels"))


STAT_METRICS = ("mean_ndvi", "min_ndvi", "max_ndvi", "std_ndvi", "healthy_share")


def stats_long(stats: DataFrame, key: str = "scene_id",
               metrics=STAT_METRICS) -> DataFrame:
    """A4: a statistics row as (metric, value) rows (no shuffle: Expand)."""
    return stats.select(key, *[F.col(m).cast("double").alias(m) for m in metrics]) \
        .unpivot(key, list(metrics), "metric", "value")


# FIXED VALUES: metric names and order of the two pages' statistics tables.
PAGE_A_METRICS = (("Mean NDVI", "mean_ndvi"), ("Min NDVI", "min_ndvi"),
                  ("Max NDVI", "max_ndvi"), ("Std Dev", "std_ndvi"),
                  ("Healthy Pixels", "healthy_share"))
PAGE_B_METRICS = (("Minimum", "min_ndvi"), ("Maximum", "max_ndvi"), ("Mean", "mean_ndvi"),
                  ("Median", "median_ndvi"), ("Std Dev", "std_ndvi"))


def metric_table(stats: DataFrame, metrics=PAGE_B_METRICS, key: str = "scene_id",
                 percent=("healthy_share",), decimals: int = 4) -> DataFrame:
    """A4 as the pages show it: (key, position, Metric, Value text) rows; shares
    as percent with one decimal, other values with ``decimals`` decimals.
    A presentation step: the numeric columns stay available in ``stats``."""
    from ..functions.formatting import fixed
    from ..functions.formatting import percent as pct
    rows = [F.struct(F.lit(i).alias("position"), F.lit(label).alias("Metric"),
                     (pct(col) if col in percent else fixed(col, decimals)).alias("Value"))
            for i, (label, col) in enumerate(metrics, start=1)]
    return stats.select(key, F.inline(F.array(*rows)))


def band_stats(band_long: DataFrame, key: str = "scene_id") -> DataFrame:
    """A5: NaN-skipping min, max, mean per (scene, band)."""
    x = nan_to_null(F.col("value").cast("double"))
    return band_long.groupBy(key, "band").agg(
        F.min(x).alias("min_value"), F.max(x).alias("max_value"), F.avg(x).alias("mean_value"))


def band_stats_wide(pixels: DataFrame, bands: dict[int, str], key: str = "scene_id",
                    header: tuple[str, str] | None = None) -> DataFrame:
    """A5 on a pixel table with a column per band: one aggregate over the pixels, one row
    per (scene, band) afterwards, so no pixel is multiplied by its bands. A band without a
    value in a scene is not one of its bands (NaN counts as a value). ``header`` names the
    (row, column) position columns and adds band_count, width and height (G12)."""
    aggs = []
    for b, c in bands.items():
        x = nan_to_null(F.col(c).cast("double"))
        aggs += [F.min(x).alias(f"_lo{b}"), F.max(x).alias(f"_hi{b}"), F.avg(x).alias(f"_avg{b}"),
                 F.count(c).alias(f"_n{b}")]
    extra = []
    if header:
        for name, c in zip(("height", "width"), header):
            aggs.append((F.max(c).cast("long") - F.min(c) + 1).alias(name))
        count = sum(((F.col(f"_n{b}") > 0).cast("long") for b in bands), F.lit(0).cast("long"))
        extra = [count.alias("band_count"), "width", "height"]
    per_scene = pixels.groupBy(key).agg(*aggs)
    held = F.filter(F.array(*[
        F.struct(F.lit(b).alias("band"), F.col(f"_lo{b}").alias("min_value"),
                 F.col(f"_hi{b}").alias("max_value"), F.col(f"_avg{b}").alias("mean_value"),
                 (F.col(f"_n{b}") > 0).alias("_held")) for b in bands]), lambda x: x["_held"])
    return per_scene.select(key, *extra, F.inline(held)).drop("_held")


def band_pair_choice(image_bands: DataFrame, key: str = "scene_id") -> DataFrame:
    """P4 + A13: number of bands per image and the (red, nir) pair it gets: the
    first pair whose bands are both there.

    Counting distinct bands goes through a (scene, band) pre-aggregation, so a
    huge image ships one row per band instead of one per pixel.
    """
    per_band = image_bands.groupBy(key, "band").agg(F.count(F.lit(1)).alias("_px"))
    needed = sorted({b for pair in K.BAND_PAIRS for b in pair})
    counts = per_band.groupBy(key).agg(
        F.count(F.lit(1)).alias("band_count"), F.sum("_px").alias("pixels"),
        *[F.coalesce(F.max(F.col("band") == b), F.lit(False)).alias(f"_has{b}") for b in needed])
    pair = band_pair(lambda b: F.col(f"_has{b}"))
    return counts.select(key, "band_count", "pixels",
                         pair.getField("red_band").alias("red_band"),
                         pair.getField("nir_band").alias("nir_band"))


def scene_metadata(pixels: DataFrame, key: str = "scene_id", row: str = "pixel_row",
                   col: str = "pixel_col", crs: str | Column = "EPSG:4326",
                   path: str | Column | None = None) -> DataFrame:
    """Scene header from the pixel table: path, width, height, CRS and
    bounds (pixel-edge coordinates, nested). ``crs`` is a text for all scenes or a
    column of the pixels, ``path`` likewise (default: the scene's key as text).

    A text never enters the pixel aggregate as ``min``, which would sort every pixel: one
    for all scenes is added afterwards, a column is gathered as the set of a scene's texts
    (one, or the few that differ; the first in order is taken)."""
    gathered = {n: v for n, v in (("_path", path), ("_crs", crs)) if isinstance(v, Column)}
    agg = pixels.groupBy(key).agg(
        *[F.array_min(F.collect_set(v)).alias(n) for n, v in gathered.items()],
        F.min(col).alias("_c0"), F.max(col).alias("_c1"),
        F.min(row).alias("_r0"), F.max(row).alias("_r1"))
    if "_path" not in gathered:
        agg = agg.withColumn("_path", F.col(key).cast("string") if path is None else F.lit(path))
    if "_crs" not in gathered:
        agg = agg.withColumn("_crs", F.lit(crs))
    return agg.select(
        F.col(key).alias(key),
        F.col("_path").alias("path"),
        (F.col("_c1").cast("long") - F.col("_c0") + 1).alias("width"),
        (F.col("_r1").cast("long") - F.col("_r0") + 1).alias("height"),
        F.col("_crs").alias("crs"),
        F.struct(F.col("_c0").cast("double").alias("left"),
                 F.col("_r0").cast("double").alias("bottom"),
                 (F.col("_c1") + 1).cast("double").alias("right"),
                 (F.col("_r1") + 1).cast("double").alias("top")).alias("bounds"),
    )


def scene_date_series(pixels: DataFrame, key: str = "scene_id",
                      date: str = "capture_date") -> DataFrame:
    """Sorted list of capture dates per scene/field.

    The list is built from distinct (scene, date) pairs, so its length is
    bounded by the number of calendar days, never by the pixel count.
    """
    days = pixels.groupBy(key, date).agg(F.count(F.lit(1)).alias("_px"))
    return days.groupBy(key).agg(
        F.sort_array(F.collect_list(F.col(date))).alias("dates"),
        F.count(F.col(date)).alias("n_dates"),
        F.sum("_px").alias("pixels"))
