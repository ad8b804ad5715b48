"""Per-image processing status and the run summary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scene import band_pair_choice


def image_status(image_bands: DataFrame, key: str = "scene_id") -> DataFrame:
    """An image succeeds when a (red, nir) band pair exists; the failure
    is recorded per image instead of stopping the job."""
    pairs = band_pair_choice(image_bands, key)
    return pairs.withColumn("status", F.when(F.col("red_band").isNotNull(), F.lit("done"))
                            .otherwise(F.lit("failed")))


def run_summary(status: DataFrame) -> DataFrame:
    """A12 + K7: number of images per status (partially aggregated)."""
    return status.groupBy("status").agg(F.count(F.lit(1)).alias("n_images"))


def failed_images(status: DataFrame, key: str = "scene_id") -> DataFrame:
    """F1 + K7: the images that failed (a DataFrame, never collected)."""
    return status.where(F.col("status") == "failed").select(key, "band_count")
