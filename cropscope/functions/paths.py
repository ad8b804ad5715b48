"""Path-text rules for raster file listings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import constants as K
from .guards import col


def base_name(path) -> Column:
    """Text after the last '/'; NULL stays NULL."""
    return F.element_at(F.split(col(path), "/"), -1)


def parent_name(path) -> Column:
    """Name of the directory holding the file (the field of a series tree)."""
    return F.element_at(F.split(col(path), "/"), -2)


def is_raster(path) -> Column:
    """Suffix .tif or .tiff in any letter case."""
    return F.lower(col(path)).rlike(r"\.tiff?$")


def is_ndvi_output(path) -> Column:
    """Already an NDVI output: base name contains _NDVI."""
    return base_name(path).contains(K.NDVI_OUTPUT_MARKER)


def is_series_raster(path) -> Column:
    """Series tree test: case-sensitive '.tif' suffix only."""
    return col(path).endswith(".tif")


def ndvi_output_path(path) -> Column:
    """x.tif -> x_NDVI.tif, suffix kept as written, any letter case."""
    return F.regexp_replace(col(path), r"(?i)\.(tiff?)$", K.NDVI_OUTPUT_MARKER + ".$1")


def date_text(path) -> Column:
    """Text before the first '_' of the base name (the capture date)."""
    return F.split(base_name(path), "_").getItem(0)


def parse_date_text(text) -> Column:
    """yyyyMMdd text -> DATE; bad text gives NULL instead of failing the job."""
    return F.try_to_date(col(text), K.DATE_TEXT_FORMAT)


def day_number(date) -> Column:
    """Days since 1970-01-01 (any fixed origin cancels in a slope)."""
    return F.datediff(col(date), F.lit("1970-01-01").cast("date"))
