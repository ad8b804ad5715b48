"""Tile rows (S5, P4, P1 on arrays): a band of a tile is one row that holds its cells.

An image is cut into tiles of a fixed number of rows and columns. A row ``(scene, tile_row,
tile_col, band, cells)`` holds the tile's pixels of one band as ``(pos, value)`` in position
order, at most ``rows * cols`` of them. The two bands of a pixel meet as arrays of one
tile, so what is shuffled afterwards is tiles: the pixels move once, when tiles are
built, or never, when they are stored so.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ndvi import ndvi_is_masked, ndvi_masked, valid_ndvi

ROWS, COLS = 64, 64
TASK_ROWS = 1 << 19  # band rows of one task
CELL = "struct<pos: int, value: double>"
_TILE = ("tile_row", "tile_col")


def make_tiles(image_bands: DataFrame, key: str = "scene_id", row: str = "pixel_row",
               col: str = "pixel_col", rows: int = ROWS, cols: int = COLS) -> DataFrame:
    """Tiles of long band rows ``(key, band, row, col, value)``. A tile is a bounded group,
    so a scene of any size is spread over many tasks. A band that holds a pixel twice
    keeps the greater value. More than ``TASK_ROWS`` are dealt by tile first, in as many
    parts as they fill: lists do not shrink what a task of the scan holds, and a fixed number of
    parts would hold more the more pixels come."""
    at = lambda c, n: F.floor(F.col(c) / n).cast("long")
    pos = (F.pmod(F.col(row), F.lit(rows)) * cols + F.pmod(F.col(col), F.lit(cols))).cast("int")
    cells = F.sort_array(F.collect_list(F.struct(F.col("pos"), F.col("value").cast("double")
                                                 .alias("value"))))
    last = F.filter("cells", lambda c, i: F.coalesce(
        F.get("cells", i + 1)["pos"] != c["pos"], F.lit(True)))
    placed = image_bands.select(key, at(row, rows).alias("tile_row"), at(col, cols).alias("tile_col"),
                                "band", pos.alias("pos"), "value")
    n = image_bands.count()
    if n > TASK_ROWS:
        placed = placed.repartition(-(-n // TASK_ROWS), key, *_TILE)
    return placed.groupBy(key, *_TILE, "band").agg(cells.alias("cells")).withColumn("cells", last)


def tile_pairs(tiles: DataFrame, pairs: DataFrame, key: str = "scene_id") -> DataFrame:
    """Per tile the cells ``(pos, red, nir)`` of the scene's band pair (``pairs``: key,
    red_band, nir_band); a value that one of the bands lacks is NULL."""
    chosen = (tiles.join(pairs.where(F.col("red_band").isNotNull())
                         .select(key, "red_band", "nir_band"), key)
              .where((F.col("band") == F.col("red_band")) | (F.col("band") == F.col("nir_band"))))
    none = F.array().cast(f"array<{CELL}>")
    of = lambda b: F.coalesce(F.max(F.when(F.col("band") == F.col(b), F.col("cells"))), none)
    both = chosen.groupBy(key, *_TILE).agg(of("red_band").alias("_r"), of("nir_band").alias("_n"))
    return both.select(key, *_TILE, _meet("_r", "_n").alias("cells"))


def _cell(pos: Column, red: Column, nir: Column) -> Column:
    return F.struct(pos.alias("pos"), red.alias("red"), nir.alias("nir"))


def _meet(red: str, nir: str) -> Column:
    """Cells of both arrays by position. Where the positions are the same, as in whole tiles,
    the arrays are zipped; otherwise both are put in one order and neighbours meet."""
    place = lambda c: F.transform(c, lambda x: x["pos"])
    zipped = F.zip_with(red, nir, lambda r, n: _cell(r["pos"], r["value"], n["value"]))
    tag = lambda c, k: F.transform(c, lambda x: F.struct(
        x["pos"].alias("pos"), F.lit(k).alias("k"), x["value"].alias("v")))
    line = F.sort_array(F.concat(tag(red, 0), tag(nir, 1)))
    nothing = F.array(F.lit(None).cast("struct<pos: int, k: int, v: double>"))
    three = F.arrays_zip(line.alias("x"), F.concat(nothing, line).alias("p"),
                         F.concat(F.slice(line, 2, F.greatest(F.size(line), F.lit(1))), nothing)
                         .alias("n"))
    first = F.filter(three, lambda t: t["x"].isNotNull() & F.coalesce(
        t["p"]["pos"] != t["x"]["pos"], F.lit(True)))
    met = F.transform(first, lambda t: _cell(
        t["x"]["pos"], F.when(t["x"]["k"] == 0, t["x"]["v"]),
        F.when(t["x"]["k"] == 1, t["x"]["v"]).when(t["n"]["pos"] == t["x"]["pos"], t["n"]["v"])))
    return F.when(place(red) == place(nir), zipped).otherwise(met)


def tile_ndvi(pairs: DataFrame) -> DataFrame:
    """P1 on every tile: ``ndvi`` as an array of ``(pos, ndvi, is_masked)``."""
    value = F.transform("cells", lambda c: F.struct(
        c["pos"].alias("pos"), ndvi_masked(c["red"], c["nir"]).alias("ndvi"),
        ndvi_is_masked(c["red"], c["nir"]).alias("is_masked")))
    return pairs.withColumn("ndvi", value).drop("cells")


def scene_stats(tiles: DataFrame, key: str = "scene_id") -> DataFrame:
    """Statistics per scene from NDVI tiles: each tile folds its array, so the shuffle moves
    a few numbers per tile."""
    v = F.transform("ndvi", lambda c: c["ndvi"])
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x)
    folded = tiles.select(
        key, F.size("ndvi").cast("long").alias("_n"), total(v).alias("_sum"),
        F.array_min(v).alias("_lo"), F.array_max(v).alias("_hi"),
        F.size(F.filter("ndvi", lambda c: c["is_masked"])).cast("long").alias("_masked"),
        F.size(F.filter(v, valid_ndvi)).cast("long").alias("_valid"))
    return folded.groupBy(key).agg(
        F.sum("_n").alias("total_pixels"), F.sum("_masked").alias("masked_pixels"),
        F.sum("_valid").alias("valid_pixels"), F.min("_lo").alias("min_ndvi"),
        F.max("_hi").alias("max_ndvi"),
        F.try_divide(F.sum("_sum"), F.sum("_n")).alias("mean_ndvi"))


def pixels(tiles: DataFrame, key: str = "scene_id", rows: int = ROWS, cols: int = COLS) -> DataFrame:
    """NDVI tiles as pixel rows ``(key, pixel_row, pixel_col, ndvi, is_masked)``."""
    return tiles.select(key, *_TILE, F.inline("ndvi")).select(
        key, (F.col("tile_row") * rows + F.floor(F.col("pos") / cols)).cast("long").alias("pixel_row"),
        (F.col("tile_col") * cols + F.col("pos") % cols).cast("long").alias("pixel_col"),
        "ndvi", "is_masked")
