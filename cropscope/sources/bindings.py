"""Bindings: the application's input tables expressed over the shared test tables.

Each function takes ``(spark, data_dir)`` and returns a lazily planned
DataFrame; nothing is read until an action runs, and Catalyst prunes every
column the caller does not use down to the Parquet scan.

| binding        | test table(s)                  | meaning                              |
| -------------- | ------------------------------ | ------------------------------------ |
| band_samples   | lineitem                       | one row per pixel: scene, date, red, nir |
| band_long      | lineitem                       | pixel value per band (4 bands)       |
| image_bands    | lineitem                       | order = image, line number = band    |
| fields         | part                           | per-field NDVI, temperature, ...     |
| yields         | lineitem                       | per-field yield and fertilizer cost  |
| observations   | events                         | NDVI observations over time          |
| scene_labels   | supplier, nation, region       | yield label and region per scene     |
| climate        | nation                         | environment parameters per nation    |
| scenarios      | lineitem                       | what-if requests per field           |
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, data_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{data_dir.rstrip('/')}/{name}.parquet")


def band_samples(spark: SparkSession, data_dir: str) -> DataFrame:
    """Pixel table: scene = supplier, capture date = ship date, red = discount,
    nir = tax; pixel position row = order key, col = line number."""
    li = table(spark, data_dir, "lineitem")
    return li.select(
        F.col("l_suppkey").alias("scene_id"),
        F.col("l_shipdate").cast("date").alias("capture_date"),
        F.col("l_orderkey").alias("pixel_row"),
        F.col("l_linenumber").alias("pixel_col"),
        F.col("l_discount").alias("red"),
        F.col("l_tax").alias("nir"),
    )


BAND_COLUMNS = (("l_discount", 1), ("l_tax", 2), ("l_quantity", 3), ("l_extendedprice", 4))


def band_long(spark: SparkSession, data_dir: str) -> DataFrame:
    """Long per-band pixel table (scene_id, band, value): four bands per pixel."""
    li = table(spark, data_dir, "lineitem")
    wide = li.select(F.col("l_suppkey").alias("scene_id"),
                     *[F.col(c).alias(f"b{b}") for c, b in BAND_COLUMNS])
    return (wide.unpivot("scene_id", [f"b{b}" for _, b in BAND_COLUMNS], "band_name", "value")
            .select("scene_id",
                    F.substring("band_name", 2, 8).cast("int").alias("band"),
                    "value"))


def band_columns(spark: SparkSession, data_dir: str) -> tuple[DataFrame, dict[int, str]]:
    """The same pixels with a column per band and their positions, and band -> column."""
    li = table(spark, data_dir, "lineitem")
    wide = li.select(F.col("l_suppkey").alias("scene_id"), F.col("l_orderkey").alias("pixel_row"),
                     F.col("l_linenumber").alias("pixel_col"),
                     *[F.col(c).alias(f"b{b}") for c, b in BAND_COLUMNS])
    return wide, {b: f"b{b}" for _, b in BAND_COLUMNS}


def image_bands(spark: SparkSession, data_dir: str) -> DataFrame:
    """Images with a varying number of bands: order = image, line number = band,
    extended price = value. Orders hold 1 to 7 lines, so band counts vary."""
    li = table(spark, data_dir, "lineitem")
    return li.select(F.col("l_orderkey").alias("scene_id"),
                     F.col("l_linenumber").alias("band"),
                     F.col("l_extendedprice").alias("value"))


def fields(spark: SparkSession, data_dir: str) -> DataFrame:
    """Per-field table: NDVI from retail price, temperature from size; rain,
    humidity and leaf wetness derived from the key."""
    p = table(spark, data_dir, "part")
    return p.select(
        F.col("p_partkey").alias("field_id"),
        ((F.col("p_retailprice") - 950.0) / 50.0).alias("mean_ndvi"),
        F.col("p_size").cast("double").alias("temperature"),
        (F.col("p_partkey") % 400).cast("double").alias("rainfall"),
        (F.col("p_partkey") % 101).cast("double").alias("humidity"),
        (F.col("p_partkey") % 25).cast("double").alias("leaf_wetness"),
    )


def yields(spark: SparkSession, data_dir: str) -> DataFrame:
    """Yield table: field = order, yield from quantity (some negative),
    fertilizer cost from tax (some zero)."""
    li = table(spark, data_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("field_id"),
        ((F.col("l_quantity") - 5.0) / 10.0).alias("yield"),
        (F.col("l_tax") * 3000.0).alias("fertilizer_cost"),
    )


def observations(spark: SparkSession, data_dir: str) -> DataFrame:
    """Observation history: field = user, NDVI = min(value / 100, 1)."""
    ev = table(spark, data_dir, "events")
    return ev.select(
        F.col("user_id").alias("field_id"),
        "event_id",
        "ts",
        F.least(F.col("value") / 100.0, F.lit(1.0)).alias("ndvi"),
    )


def scene_labels(spark: SparkSession, data_dir: str) -> DataFrame:
    """Yield label per scene (supplier) with its region and nation."""
    s = table(spark, data_dir, "supplier")
    n = table(spark, data_dir, "nation")
    r = table(spark, data_dir, "region")
    return (s.join(n, s.s_nationkey == n.n_nationkey)
            .join(r, n.n_regionkey == r.r_regionkey)
            .select(F.col("s_suppkey").alias("scene_id"),
                    (F.col("s_acctbal") / 3000.0).alias("yield"),
                    F.col("r_name").alias("region"),
                    F.col("s_nationkey").alias("nation_id")))


def climate(spark: SparkSession, data_dir: str) -> DataFrame:
    """Environment parameters per nation (a per-field parameter table); the three
    weather and soil columns are linearly independent over the nations."""
    n = table(spark, data_dir, "nation")
    k = F.col("n_nationkey").cast("double")
    return n.select(
        F.col("n_nationkey").alias("nation_id"),
        (F.lit(50.0) + k * 10.0).alias("rainfall"),
        (F.lit(12.0) + (k * 7.0) % 25.0).alias("temperature"),
        (F.lit(5.0) + (k * k) % 19.0 / 10.0).alias("soil_ph"),
        (F.lit(80.0) + F.col("n_regionkey").cast("double") * 5.0).alias("fertilizer"),
    )


def scenarios(spark: SparkSession, data_dir: str) -> DataFrame:
    """What-if requests: every line item asks for one scenario of its part (= field)."""
    li = table(spark, data_dir, "lineitem")
    q = F.col("l_quantity")
    return li.select(
        F.col("l_partkey").alias("field_id"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("scenario_id"),
        (q * 6.0).alias("rainfall"),
        (F.lit(10.0) + q % 30.0).alias("temperature"),
        (F.col("l_discount") * 3000.0).alias("fertilizer"),
        (F.col("l_tax") * 20.0 - 0.6).alias("ndvi"),
    )
