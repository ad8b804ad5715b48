"""Readers that record what failed and why.

Every reader returns the good rows and a table of failures ``(source, key, stage, name,
value, reason)``: where the record came from, what identifies it, at which step it failed
(``read``, ``parse`` or ``bands``), the column or band, its text, and the reason. One bad
record never stops the others, and no bad value becomes a silent NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions import constants as K
from ..functions.ndvi import band_pair
from ..functions.paths import base_name

FAILURES = "source string, key string, stage string, name string, value string, reason string"
_PARTS = ("key", "stage", "name", "value", "reason")


def _failure(key: Column, stage: str, name: Column | str, value: Column | None, reason) -> Column:
    lit = lambda x: x if isinstance(x, Column) else F.lit(x)
    value = F.lit(None).cast("string") if value is None else value
    return F.struct(*[lit(x).cast("string").alias(n) for n, x in zip(
        _PARTS, (key, stage, name, value, reason))])


def _text_table(spark: SparkSession, path: str, schema: T.StructType, header: bool) -> DataFrame:
    """A CSV with every column as text, its line where the columns do not fit the schema
    (``_bad_line``) and its file (``_file``)."""
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields]
                        + [T.StructField("_bad_line", T.StringType())])
    return (spark.read.schema(text).option("header", header).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", "_bad_line")
            .option("columnPruning", False)  # else a line is measured by the columns in use
            .csv(path)
            .withColumn("_file", F.col("_metadata.file_path")))


def _parsed(raw: DataFrame, schema: T.StructType, key: str, whole_line: bool) -> DataFrame:
    """Typed columns, ``_file`` and ``_failures``, one per value that is no ``type``."""
    found = []
    for f in schema.fields:
        kind = f.dataType.simpleString()
        if kind != "string":
            text = F.col(f"`{f.name}`")
            found.append(F.when(text.isNotNull() & text.try_cast(f.dataType).isNull(), _failure(
                F.col(key), "parse", f.name, text, f"not a {kind}")))
    bad = F.filter(F.array(*found), lambda x: x.isNotNull()) if found else F.array().cast(
        T.ArrayType(T.StructType([T.StructField(n, T.StringType()) for n in _PARTS])))
    if whole_line:  # one reason for a line that does not fit, not one for each shifted value
        line = F.array(_failure(F.col(key), "read", F.lit(None), F.col("_bad_line"),
                                "wrong number of columns"))
        bad = F.when(F.col("_bad_line").isNotNull(), line).otherwise(bad)
    return raw.select(*[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name)
                        for f in schema.fields], "_file", bad.alias("_failures"))


def _split(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    good = parsed.where(F.size("_failures") == 0).drop("_failures")
    bad = parsed.select(F.col("_file").alias("source"), F.inline("_failures"))
    return good, bad


def read_table_csv(spark: SparkSession, path: str, schema: T.StructType, key: str,
                   header: bool = True) -> tuple[DataFrame, DataFrame]:
    """The rows of a CSV whose every value has its column's type, and the failures of the
    others. Empty values are NULL, as before, and no failure."""
    good, bad = _split(_parsed(_text_table(spark, path, schema, header), schema, key, True))
    return good.drop("_file"), bad


def read_label_sections(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """As ``files.read_label_sections`` over the rows without a bad number, and the
    failures. A line may be short (the narrow section); one with more columns is a failure."""
    raw = _text_table(spark, path, schemas.LABELS, False).where(
        F.col("filename").isNull() | (F.col("filename") != "filename"))
    width = len(schemas.LABELS.fields)
    too_wide = F.size(F.split("_bad_line", ",", -1)) > width
    raw = raw.withColumn("_bad_line", F.when(too_wide, F.col("_bad_line")))
    good, bad = _split(_parsed(raw, schemas.LABELS, "filename", True))
    return fullest_rows(good.where(F.col("filename").isNotNull()).drop("_file")), bad


def fullest_rows(rows: DataFrame) -> DataFrame:
    """One row per file name: the one with most values. A partially aggregated ``max`` over
    (non-null count, values), so a name repeated many times never gathers its copies."""
    cols = [f.name for f in schemas.LABELS.fields if f.name != "filename"]
    filled = sum((F.col(c).isNotNull().cast("int") for c in cols), F.lit(0))
    best = F.max(F.struct(filled.alias("_filled"), *cols)).alias("_b")
    return rows.groupBy("filename").agg(best).select(
        "filename", *[F.col(f"_b.{c}").alias(c) for c in cols])


def read_files(spark: SparkSession, path: str, schema) -> tuple[DataFrame, DataFrame]:
    """Rows of a folder of Parquet files, with ``source_file``; files that cannot be read, or
    hold no row, are failures with their name as key. The listing reads no content. Files of
    0 bytes are passed over by every file source of Spark, so they are in neither."""
    rows = (spark.read.schema(schema).option("ignoreCorruptFiles", True).parquet(path)
            .withColumn("source_file", F.col("_metadata.file_path")))
    listed = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
              .select(F.col("path").alias("source")))
    # both name the same file, one as a URI of its own spelling
    name = lambda c: F.regexp_replace(F.url_decode(c), "^file:/+", "/")
    seen = rows.select(name(F.col("source_file")).alias("_n")).distinct()
    lost = listed.join(seen, name(F.col("source")) == F.col("_n"), "left_anti")
    return rows, lost.select("source", F.inline(F.array(_failure(
        base_name("source"), "read", F.lit(None), None, "no readable row"))))


def image_failures(image_bands: DataFrame, key: str = "scene_id",
                   source: str = "image_bands") -> DataFrame:
    """The images that give no NDVI and why: no (red, nir) pair, or a band of the
    pair without a single number. A (scene, band) aggregate comes first, so an image ships
    one row per band."""
    number = F.col("value").isNotNull() & ~F.isnan(F.col("value").cast("double"))
    per_band = image_bands.groupBy(key, "band").agg(F.count_if(number).alias("_ok"))
    needed = sorted({b for pair in K.BAND_PAIRS for b in pair})
    image = per_band.groupBy(key).agg(
        F.count(F.lit(1)).alias("band_count"),
        *[F.max(F.when(F.col("band") == b, F.col("_ok"))).alias(f"_ok{b}") for b in needed])
    pair = band_pair(lambda b: F.col(f"_ok{b}").isNotNull())
    image = image.withColumn("_pair", pair)
    ok = F.create_map(*[x for b in needed for x in (F.lit(b), F.col(f"_ok{b}"))])
    k = F.col(key)

    def blank(band: Column) -> Column:
        return F.when(F.element_at(ok, band) == 0,
                      _failure(k, "bands", "band", band, "band without a number"))

    no_pair = _failure(k, "bands", "band_count", F.col("band_count"), "no red and near-infrared band")
    why = F.when(F.col("_pair").isNull(), F.array(no_pair)).otherwise(F.filter(F.array(
        blank(F.col("_pair.red_band")), blank(F.col("_pair.nir_band"))), lambda x: x.isNotNull()))
    return image.select(F.lit(source).alias("source"), F.inline(why))
