"""Economics views: plain and guarded profit/ROI, ROI histogram, cost breakdown
(P14-P19, P21, A9, A10, C1)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.rules import (profit_floored, profit_plain, roi_class_a, roi_class_b,
                               roi_guarded, roi_plain)


def economics_plain(yields: DataFrame, labor_cost=K.DEFAULT_LABOR_COST,
                    crop_price=K.DEFAULT_CROP_PRICE) -> DataFrame:
    """C1 (batch job): profit and ROI; zero cost gives NULL ROI, not a failure."""
    return yields.select(
        "field_id", "yield", "fertilizer_cost",
        profit_plain("yield", "fertilizer_cost", labor_cost, crop_price).alias("profit"),
        roi_plain("yield", "fertilizer_cost", crop_price).alias("roi"))


def economics_guarded(yields: DataFrame, labor_cost=K.DEFAULT_LABOR_COST,
                      crop_price=K.DEFAULT_CROP_PRICE) -> DataFrame:
    """Page form: floored profit, guarded ROI, and both pages' ROI classes."""
    out = yields.select(
        "field_id", "yield", "fertilizer_cost",
        profit_floored("yield", "fertilizer_cost", labor_cost, crop_price).alias("profit"),
        roi_guarded("yield", "fertilizer_cost", crop_price).alias("roi"))
    return (out.withColumn("roi_class_a", roi_class_a("roi"))
            .withColumn("roi_class_b", roi_class_b("roi")))


def histogram(values: DataFrame, value: str, bins: int = K.HISTOGRAM_BINS) -> DataFrame:
    """A9 + A10: ``bins`` equal-width bins between min and max (last bin
    closed, like numpy), every bin listed even when empty, plus the mean.

    One small global aggregate finds min, max and mean (three scalars); the
    bin counts are then a partially aggregated ``groupBy(bin)``.
    """
    x = F.col(value).cast("double")
    present = values.select(x.alias("_x")).where(F.col("_x").isNotNull() & ~F.isnan("_x"))
    row = present.agg(F.min("_x").alias("lo"), F.max("_x").alias("hi"),
                      F.avg("_x").alias("mean")).first()
    spark = values.sparkSession
    schema = "bin int, bin_lo double, bin_hi double, n bigint, mean_value double"
    if row is None or row["lo"] is None:
        return spark.createDataFrame([], schema)
    lo, hi, mean = float(row["lo"]), float(row["hi"]), float(row["mean"])
    if hi == lo:  # numpy widens an empty range by 0.5 on each side
        lo, hi = lo - 0.5, hi + 0.5
    width = (hi - lo)
    b = F.least(F.lit(bins), F.floor((F.col("_x") - F.lit(lo)) / F.lit(width) * F.lit(bins)) + 1)
    counts = present.groupBy(b.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    edges = spark.range(1, bins + 1).select(
        F.col("id").cast("int").alias("bin"),
        (F.lit(lo) + (F.col("id") - 1) * F.lit(width / bins)).alias("bin_lo"),
        (F.lit(lo) + F.col("id") * F.lit(width / bins)).alias("bin_hi"))
    return (edges.join(F.broadcast(counts), "bin", "left")
            .select("bin", "bin_lo", "bin_hi", F.coalesce("n", F.lit(0)).alias("n"),
                    F.lit(mean).alias("mean_value")))


def roi_histogram(yields: DataFrame, crop_price=K.DEFAULT_CROP_PRICE) -> DataFrame:
    """A9 + A10 over the batch-job ROI (NULL ROI of zero-cost fields skipped)."""
    return histogram(economics_plain(yields, crop_price=crop_price), "roi")


def cost_breakdown(yields: DataFrame, labor_cost=K.DEFAULT_LABOR_COST,
                   crop_price=K.DEFAULT_CROP_PRICE) -> DataFrame:
    """(field, item, amount) rows for Revenue, Fertilizer Cost, Labor Cost
    (an Expand, no shuffle)."""
    revenue, fert, labor = K.COST_ITEMS
    wide = yields.select(
        "field_id",
        (F.col("yield").cast("double") * F.lit(float(crop_price))).alias("r"),
        F.col("fertilizer_cost").cast("double").alias("f"),
        F.lit(float(labor_cost)).alias("l"))
    return wide.select("field_id", F.inline(F.array(
        F.struct(F.lit(revenue).alias("item"), F.col("r").alias("amount")),
        F.struct(F.lit(fert).alias("item"), F.col("f").alias("amount")),
        F.struct(F.lit(labor).alias("item"), F.col("l").alias("amount")))))
