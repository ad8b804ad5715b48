"""File sources and sinks.

Listings use Spark's ``binaryFile`` source with only ``path``/``length``
selected, so file contents are never read; the path rules of
``functions.paths`` then run as column expressions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.paths import (base_name, date_text, is_ndvi_output, is_raster,
                               is_series_raster, ndvi_output_path, parent_name, parse_date_text)
from . import commits
from .checked import fullest_rows


def _listing(spark: SparkSession, root: str, recursive: bool) -> DataFrame:
    reader = spark.read.format("binaryFile")
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    return reader.load(root).select("path", "length", "modificationTime")


def list_rasters(spark: SparkSession, root: str) -> DataFrame:
    """Raster files directly in ``root``, suffix .tif/.tiff in any case. Spark's file
    sources hide names that start with ``_`` or ``.``; name rasters otherwise."""
    df = _listing(spark, root, recursive=False)
    return rasters(df)


def rasters(listing: DataFrame, path: str = "path") -> DataFrame:
    """S1 on an existing listing of paths."""
    return listing.where(is_raster(path)).withColumn("filename", base_name(path))


def ndvi_inputs(listing: DataFrame, path: str = "path") -> DataFrame:
    """S2 + K2: rasters that are not NDVI outputs, with their output path."""
    return (rasters(listing, path).where(~is_ndvi_output(path))
            .withColumn("output_path", ndvi_output_path(path)))


def series_images(listing: DataFrame, path: str = "path") -> DataFrame:
    """S3: ``<field>/<yyyymmdd>_*.tif`` files: field = parent folder, date =
    text before the first '_', parsed (bad text -> NULL date, kept and
    flagged); fields without files never appear."""
    return (listing.where(is_series_raster(path))
            .withColumn("field_id", parent_name(path))
            .withColumn("date_text", date_text(path))
            .withColumn("capture_date", parse_date_text("date_text"))
            .withColumn("date_ok", F.col("capture_date").isNotNull()))


def list_series(spark: SparkSession, root: str) -> DataFrame:
    """S3 over a directory tree: ``root/<field>/<file>``, exactly one level deep. A tree
    without such a file, or none at all, has no row."""
    return series_images(_tree(spark, root.rstrip("/") + "/*/*.tif"))


def _tree(spark: SparkSession, pattern: str) -> DataFrame:
    if not commits.matches(spark, pattern):
        return spark.createDataFrame([], "path string, length long, modificationTime timestamp")
    return _listing(spark, pattern, recursive=False)


def read_table_csv(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """CSV with a header; explicit schema when given, inference only on request."""
    reader = spark.read.option("header", True)
    if schema is None:
        reader = reader.option("inferSchema", True)
    else:
        reader = reader.schema(schema)
    return reader.csv(path)


def read_label_sections(spark: SparkSession, path: str) -> DataFrame:
    """Labels stored as stacked CSV sections with different headers.

    Read with the widest (7-column) schema and no header: short rows are
    padded with NULL, header lines are dropped by their text. Repeated file
    names keep their fullest row. A bad number is NULL here; ``checked`` reports it.
    """
    raw = (spark.read.schema(schemas.LABELS).option("header", False)
           .option("mode", "PERMISSIVE").csv(path))
    rows = raw.where(F.col("filename").isNotNull() & (F.col("filename") != "filename"))
    return fullest_rows(rows)


def write_label_sections(short: DataFrame, wide: DataFrame, path: str) -> str:
    """Write the two-section layout: a (filename, yield) section and a
    7-column section, each with its own header line, into one folder."""
    short.write.mode("overwrite").option("header", True).csv(path)
    wide.write.mode("append").option("header", True).csv(path)
    return path


NDVI_BUCKETS = 256


def scene_bucket(scene, buckets: int = NDVI_BUCKETS):
    """Directory bucket of a scene: a bounded number of partitions however many
    scenes there are."""
    return F.pmod(F.xxhash64(F.col(scene) if isinstance(scene, str) else scene),
                  F.lit(buckets)).cast("int")


def write_ndvi(pixels: DataFrame, path: str, scene: str = "scene_id",
               buckets: int = NDVI_BUCKETS, observed: Observation | None = None) -> str:
    """K1: NDVI pixels as Parquet, partitioned by a hash bucket of the scene. ``observed``
    receives ``pixels`` and ``masked_pixels`` from the write itself (K7). A run without a
    pixel leaves a table without rows.

    Partitioning by the scene itself would create one directory per scene
    (millions at scale). Rows are rebalanced by bucket first, so the number of
    files follows the data and the buckets, not the number of input tasks, and a
    large bucket is split over several tasks. Choose ``buckets`` by the size of the
    table (a few hundred files each). Rows are sorted by scene within a file, so
    Parquet statistics let a single-scene read skip the rest.
    """
    observed = observed or Observation()
    masked = F.count_if("is_masked") if "is_masked" in pixels.columns else F.lit(0).cast("long")
    (pixels.withColumn("scene_bucket", scene_bucket(scene, buckets))
     .hint("rebalance", "scene_bucket").sortWithinPartitions("scene_bucket", scene)
     .observe(observed, F.count(F.lit(1)).alias("pixels"), masked.alias("masked_pixels"))
     .write.mode("overwrite").partitionBy("scene_bucket").parquet(path))
    if not observed.get["pixels"]:  # a file without rows tells readers the columns
        (pixels.sparkSession.createDataFrame([], pixels.schema).coalesce(1)
         .write.mode("overwrite").parquet(f"{path}/scene_bucket=0"))
    return path


def read_ndvi(spark: SparkSession, path: str, scene_ids=None, scene: str = "scene_id",
              buckets: int = NDVI_BUCKETS) -> DataFrame:
    """Read NDVI written by ``write_ndvi``. A short list of ``scene_ids`` prunes to their
    bucket directories and is pushed into the scan; any number of scenes may be given
    as a DataFrame, which is semi-joined on bucket and scene."""
    df = spark.read.parquet(path)
    if isinstance(scene_ids, DataFrame):
        wanted = scene_ids.select(F.col(scene).cast(df.schema[scene].dataType).alias(scene))
        wanted = wanted.withColumn("scene_bucket", scene_bucket(scene, buckets))
        df = df.join(wanted, ["scene_bucket", scene], "left_semi")
    elif scene_ids is not None:
        ids = list(scene_ids)
        # hash with the stored type: int and long ids hash differently
        typ = df.schema[scene].dataType.simpleString()
        bucket_ids = [r[0] for r in spark.createDataFrame([(i,) for i in ids], f"{scene} {typ}")
                      .select(scene_bucket(scene, buckets)).distinct().collect()]
        df = df.where(F.col("scene_bucket").isin(bucket_ids) & F.col(scene).isin(ids))
    return df.drop("scene_bucket")


def append_observations(obs: DataFrame, path: str) -> str:
    """K6: append scored observations to the history table."""
    obs.write.mode("append").parquet(path)
    return path
