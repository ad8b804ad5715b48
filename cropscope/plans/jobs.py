"""Composite jobs (G1-G12): thin compositions of the operators.

Each job takes DataFrames (or a session plus paths) and returns DataFrames;
writing is explicit and goes to caller-given paths (on a cluster: shared
storage). Only single-row results (histogram bounds, open-rank counts) reach the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.guards import clip
from ..functions.ndvi import health_class, health_index, ndvi_is_masked, ndvi_masked
from ..functions.rules import (disease_advice, disease_risk_class, disease_risk_score,
                               profit_floored, roi_class_a, roi_class_b, roi_guarded,
                               stress_advice, stress_class, trend_colour, water_stress_basic,
                               water_stress_climate, yield_class)
from ..operators import economics, models, scene, status, tiles, trend
from ..session import materialize
from ..sources import files
from ..streaming import field_state

def select_bands(image_bands: DataFrame, pixel_cols: Sequence[str] = ("pixel_row", "pixel_col"),
                 key: str = "scene_id") -> tuple[DataFrame, DataFrame]:
    """P4 + S5: choose (red, nir) per image by the bands it holds and return the
    wide pixel table ``(key, *pixel_cols, red, nir)`` plus the per-image status.

    The status is written once, as the join, the summary and the failures all read
    it. The band pivot groups by pixel (at most two rows per group), so no image
    is ever gathered in one task.
    """
    st = materialize(status.image_status(image_bands, key), "image_status")
    pairs = st.where(F.col("red_band").isNotNull()).select(key, "red_band", "nir_band")
    chosen = (image_bands.join(pairs, key, "inner")
              .where((F.col("band") == F.col("red_band")) | (F.col("band") == F.col("nir_band"))))
    wide = chosen.groupBy(key, *pixel_cols).agg(
        F.max(F.when(F.col("band") == F.col("red_band"), F.col("value"))).alias("red"),
        F.max(F.when(F.col("band") == F.col("nir_band"), F.col("value"))).alias("nir"))
    return wide, st


def ndvi_batch_job(image_bands: DataFrame, out_path: str,
                   pixel_cols: Sequence[str] = ("pixel_row", "pixel_col"),
                   key: str = "scene_id", observed: Observation | None = None
                   ) -> tuple[DataFrame, DataFrame]:
    """G1: band choice -> masked NDVI -> Parquet (bounded scene buckets) ->
    run summary (count per status) and the failed images. ``observed`` receives the
    written ``pixels`` and ``masked_pixels`` (K7)."""
    wide, st = select_bands(image_bands, pixel_cols, key)
    out = wide.select(key, *pixel_cols, ndvi_masked("red", "nir").alias("ndvi"),
                      ndvi_is_masked("red", "nir").alias("is_masked"))
    files.write_ndvi(out, out_path, scene=key, observed=observed)
    return status.run_summary(st), status.failed_images(st, key)


def ndvi_tile_job(image_bands: DataFrame, out_path: str, key: str = "scene_id",
                  observed: Observation | None = None) -> DataFrame:
    """G1 on tiles: the same pixels written, with the bands meeting as arrays of a tile.
    Returns the statistics per scene, taken from the tiles."""
    st = status.image_status(image_bands, key)
    made = materialize(tiles.tile_ndvi(tiles.tile_pairs(tiles.make_tiles(image_bands, key), st, key)),
                       "ndvi_tiles")
    files.write_ndvi(tiles.pixels(made, key), out_path, scene=key, observed=observed)
    return tiles.scene_stats(made, key)


def run_metrics(summary: DataFrame, observed: Observation) -> DataFrame:
    """K7, A12, F1 as one row: images done and failed, and the pixels and masked pixels that
    the write itself counted. ``observed`` holds four numbers; nothing else is on the driver."""
    got = observed.get
    n = lambda s: F.coalesce(F.sum(F.when(F.col("status") == s, F.col("n_images"))),
                             F.lit(0).cast("long"))
    return summary.agg(n("done").alias("done"), n("failed").alias("failed")).select(
        "done", "failed", *[F.lit(got[c]).cast("long").alias(c) for c in ("pixels", "masked_pixels")])


def metadata_ingest(pixels: DataFrame, key: str = "scene_id") -> DataFrame:
    """Scene header table (nested bounds struct)."""
    return scene.scene_metadata(pixels, key)


def field_trend_job(ndvi_pixels: DataFrame, field: str = "scene_id",
                    date: str = "capture_date", image: Sequence[str] = ()) -> DataFrame:
    """Mean NDVI per image -> slope per 1000 days -> bar colour. ``image`` names
    what tells images of one field and day apart."""
    return trend.field_trend_per_1000_days(ndvi_pixels, field, date, image=image)


def series_trend_job(listing: DataFrame, ndvi_pixels: DataFrame, path: str = "path"
                     ) -> tuple[DataFrame, DataFrame]:
    """S3 -> G3: a folder tree's listing joined to the pixels of its images on the path, and
    the trend of every field from them. Also what did not take part: ``(path, field_id,
    reason)`` of images without pixels, images whose name holds no date, and pixel rows of
    a path that is not listed. Pixels are folded to one row per image before they meet
    the listing."""
    images = files.series_images(listing.select(path).distinct(), path)
    means = ndvi_pixels.groupBy(path).agg(
        F.avg(clip(F.col("ndvi"), K.NDVI_MIN, K.NDVI_MAX)).alias("mean_ndvi"),
        F.count(F.lit(1)).alias("pixels"))
    met = images.join(means, path, "full_outer")
    dated = met.where(F.col("capture_date").isNotNull() & F.col("pixels").isNotNull())
    out = trend.slope_per(dated, "field_id", "capture_date", "mean_ndvi", K.TREND_DAYS_FIELD,
                          "ndvi_trend").withColumn("colour", trend_colour("ndvi_trend"))
    reason = (F.when(F.col("field_id").isNull(), "pixels of no listed image")
              .when(F.col("pixels").isNull(), "image without pixels")
              .when(F.col("capture_date").isNull(), "name without a date"))
    return out, met.select(path, "field_id", reason.alias("reason")).where("reason is not null")


def water_stress_job(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """CSV field table -> basic stress per field."""
    df = files.read_table_csv(spark, path, schema)
    return df.select("field_id", "mean_ndvi", "temperature",
                     water_stress_basic("mean_ndvi", "temperature").alias("water_stress"))


def economics_job(spark: SparkSession, path: str, schema=None) -> tuple[DataFrame, DataFrame]:
    """CSV yield table -> profit and ROI per field, ROI histogram + mean."""
    df = files.read_table_csv(spark, path, schema)
    econ = economics.economics_plain(df)
    return econ, economics.histogram(econ, "roi")


def training_job(features: DataFrame, labels: DataFrame, model_path: str,
                 key: str = "scene_id") -> PipelineModel:
    """Join features with labels, fit the yield forest, save it."""
    model = models.fit(models.yield_forest_pipeline(), features.join(labels, key, "inner"))
    models.save(model, model_path)
    return model


def field_report_raw(stats: DataFrame, env: DataFrame, model: PipelineModel,
                     key: str = "scene_id", params: dict | None = None) -> DataFrame:
    """Raw image page as one row per scene.

    Guarded NDVI statistics and healthy share (A1, A2), health index (P6),
    yield from the 5-feature model (M9, P20), climate stress with class and
    advice (P9, P10), rule disease risk with advice (P11-P13), floored profit
    and guarded ROI with class (P15, P17, P18) and the cost items (P21).
    ``stats`` is the scene health report of the band samples; ``env`` holds per-scene rainfall, temperature, soil_ph and fertilizer;
    ``params`` the shared humidity, leaf wetness, price and labor cost, and
    ``unit_cost`` (default 1.0) turns the fertilizer amount into a cost (D11).
    """
    p = dict(K.DEFAULTS, unit_cost=1.0)
    p.update(params or {})
    feats = stats.join(env, key, "left").withColumn("ndvi", F.col("mean_ndvi"))
    scored = models.predict(model, feats, "predicted_yield")
    stress = water_stress_climate("mean_ndvi", "temperature", "rainfall")
    risk = disease_risk_score("mean_ndvi", p["humidity"], p["leaf_wetness"], "temperature")
    out = scored.select(
        key, "mean_ndvi", "min_ndvi", "max_ndvi", "std_ndvi", "healthy_share",
        "health_index", "predicted_yield", yield_class("predicted_yield").alias("yield_class"),
        stress.alias("water_stress"), risk.alias("risk_score"),
        (F.col("fertilizer") * F.lit(float(p["unit_cost"]))).alias("fertilizer_cost"))
    out = (out.withColumn("stress_class", stress_class("water_stress"))
           .withColumn("stress_advice", stress_advice("water_stress"))
           .withColumn("risk_class", disease_risk_class("risk_score"))
           .withColumn("risk_advice", disease_advice("risk_class"))
           .withColumn("profit", profit_floored("predicted_yield", "fertilizer_cost",
                                                p["labor_cost"], p["crop_price"]))
           .withColumn("roi", roi_guarded("predicted_yield", "fertilizer_cost", p["crop_price"]))
           .withColumn("roi_class", roi_class_a("roi"))
           .withColumn("revenue", F.col("predicted_yield") * F.lit(float(p["crop_price"])))
           .withColumn("labor_cost", F.lit(float(p["labor_cost"]))))
    return out


def field_report_ndvi(ndvi_pixels: DataFrame, model: PipelineModel, env: DataFrame,
                      key: str = "scene_id", params: dict | None = None) -> DataFrame:
    """NDVI image page as one row per scene: clipped statistics with the
    exact median (A3), health and class (P6, P7), yield from the one-feature
    model (M9), basic stress (P8, the two-argument form the page calls) with
    class, rule risk (P11, P12), floored profit, guarded ROI and class B;
    fertilizer cost = amount x ``unit_cost`` (default 1.0, D11)."""
    p = dict(K.DEFAULTS, unit_cost=1.0)
    p.update(params or {})
    stats = scene.scene_ndvi_stats_with_median(ndvi_pixels, key)
    scored = models.predict(model, stats, "predicted_yield")
    h = health_index("mean_ndvi")
    out = (scored.join(env, key, "left").select(
        key, "min_ndvi", "max_ndvi", "mean_ndvi", "median_ndvi", "std_ndvi",
        h.alias("health_index"), "predicted_yield",
        water_stress_basic("mean_ndvi", "temperature").alias("water_stress"),
        disease_risk_score("mean_ndvi", p["humidity"], p["leaf_wetness"], "temperature")
        .alias("risk_score"),
        (F.col("fertilizer") * F.lit(float(p["unit_cost"]))).alias("fertilizer_cost")))
    out = (out.withColumn("health_class", health_class("health_index"))
           .withColumn("stress_class", stress_class("water_stress"))
           .withColumn("risk_class", disease_risk_class("risk_score"))
           .withColumn("profit", profit_floored("predicted_yield", "fertilizer_cost",
                                                p["labor_cost"], p["crop_price"]))
           .withColumn("roi", roi_guarded("predicted_yield", "fertilizer_cost", p["crop_price"]))
           .withColumn("roi_class", roi_class_b("roi")))
    return out.drop("fertilizer_cost")


def history_report(obs: DataFrame, model: PipelineModel | None = None,
                   field: str = "field_id") -> DataFrame:
    """Per field with at least two observations: latest observation (W1),
    count, yearly trend over all points (A8, P23) and over the first ten (W2); with a
    model also the yield it predicts for the latest observation (C4). One aggregate over
    the observations gives all but the first ten, which a limited window gives before any
    shuffle of rows (``streaming.field_state.fold``)."""
    state = field_state.fold(obs, field).where(F.col("n_obs") >= 2)
    out = field_state.trends(state, field, keep=("latest",)).select(
        field, "n_obs", "latest.ts", "latest.event_id", "latest.ndvi", "trend_per_year",
        "direction", F.abs("trend_per_year").alias("abs_trend"), "trend_first_ten")
    return out if model is None else models.predict(model, out, "predicted_yield")


def band_diagnostic(pixels: DataFrame, bands: dict[int, str], key: str = "scene_id") -> DataFrame:
    """Per scene and band min / max / mean, with the scene's band count and
    header (width, height), in one aggregate over the pixels. ``bands`` maps band numbers
    to columns. A bad band never stops the other scenes."""
    return scene.band_stats_wide(pixels, bands, key, header=("pixel_row", "pixel_col"))
