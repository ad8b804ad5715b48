"""Composite jobs on hand-made images."""

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from cropscope.plans import jobs
from cropscope.session import shared_path


def test_ndvi_batch_job(spark):
    # image 1: 8 bands -> (4, 8); image 2: 4 bands -> (3, 4); image 3: 1 band -> failed
    rows = []
    for r in range(2):
        for c in range(2):
            rows += [(1, r, c, b, float(b)) for b in range(1, 9)]
            rows += [(2, r, c, b, float(10 * b)) for b in range(1, 5)]
            rows += [(3, r, c, 1, 1.0)]
    rows += [(2, 9, 9, 3, 0.0), (2, 9, 9, 4, 5.0)]          # red 0 -> masked
    df = spark.createDataFrame(rows, "scene_id long, pixel_row int, pixel_col int, band int, value double")
    path = shared_path(spark, "test_g1")
    summary, failed = jobs.ndvi_batch_job(df, path)
    assert {r.status: r.n_images for r in summary.collect()} == {"done": 2, "failed": 1}
    assert [r.scene_id for r in failed.collect()] == [3]
    out = spark.read.parquet(path)
    got = {r.scene_id: r for r in out.groupBy("scene_id").agg(
        F.count(F.lit(1)).alias("n"), F.min("ndvi").alias("lo"), F.max("ndvi").alias("hi"),
        F.sum(F.col("is_masked").cast("int")).alias("masked")).collect()}
    assert got[1].n == 4 and got[1].lo == pytest.approx((8 - 4) / 12)
    assert got[2].n == 5 and got[2].masked == 1 and got[2].lo == -1.0
    assert got[2].hi == pytest.approx((40 - 30) / 70)
    assert 3 not in got


def test_history_report_needs_two_points(spark):
    import datetime as dt
    base = dt.datetime(2024, 1, 1)
    obs = [(1, 1, base, 0.2), (2, 2, base, 0.1), (2, 3, base + dt.timedelta(days=2), 0.3)]
    df = spark.createDataFrame(obs, "field_id long, event_id long, ts timestamp, ndvi double")
    got = jobs.history_report(df).collect()
    assert [r.field_id for r in got] == [2]
    assert got[0].trend_per_year == pytest.approx(0.1 * 365) and got[0].direction == "improving"


BANDS = "scene_id long, pixel_row int, pixel_col int, band int, value double"


def test_all_failed_run_reads_as_an_empty_table(spark):
    from cropscope.sources import files
    df = spark.createDataFrame([(1, 0, 0, 1, 1.0), (2, 0, 0, 3, 1.0)], BANDS)
    seen = Observation()
    path = shared_path(spark, "all_failed")
    summary, failed = jobs.ndvi_batch_job(df, path, observed=seen)
    assert files.read_ndvi(spark, path).count() == 0
    assert "ndvi" in files.read_ndvi(spark, path, scene_ids=[1]).columns
    assert failed.count() == 2
    assert tuple(jobs.run_metrics(summary, seen).first()) == (0, 2, 0, 0)


def test_run_metrics_are_those_of_the_write(spark):
    rows = [(s, r, 0, b, float(b * (r > 0))) for s in (1, 2) for r in range(4) for b in (3, 4)]
    seen = Observation()
    path = shared_path(spark, "metrics")
    summary, _ = jobs.ndvi_batch_job(spark.createDataFrame(rows + [(9, 0, 0, 1, 1.0)], BANDS), path,
                                     observed=seen)
    assert tuple(jobs.run_metrics(summary, seen).first()) == (2, 1, 8, 2)
    assert spark.read.parquet(path).count() == 8


def test_tiles_equal_pixels(spark):
    """Whole and partial tiles, a band with missing pixels, repeated pixels, negative positions."""
    import random

    from cropscope.operators import tiles
    rng = random.Random(4)
    rows = []
    for s, bands in ((1, range(1, 9)), (2, (3, 4)), (3, (1,)), (4, (1, 2))):
        for r in range(-3, 9):
            for c in range(7):
                for b in bands:
                    if rng.random() < .8 or s == 2:
                        rows.append((s, r, c, b, None if rng.random() < .05 else rng.uniform(-.1, 1)))
    rows += rows[:40]
    df = spark.createDataFrame(rows, BANDS)
    wide, _ = jobs.select_bands(df)
    want = {(r.scene_id, r.pixel_row, r.pixel_col): (r.ndvi, r.is_masked) for r in wide.select(
        "scene_id", "pixel_row", "pixel_col", jobs.ndvi_masked("red", "nir").alias("ndvi"),
        jobs.ndvi_is_masked("red", "nir").alias("is_masked")).collect()}
    made = tiles.make_tiles(df, rows=4, cols=5)
    pairs = jobs.status.image_status(df)
    out = tiles.tile_ndvi(tiles.tile_pairs(made, pairs))
    got = {(r.scene_id, r.pixel_row, r.pixel_col): (r.ndvi, r.is_masked)
           for r in tiles.pixels(out, rows=4, cols=5).collect()}
    assert got == want and len({k[0] for k in got}) == 3
    stats = {r.scene_id: r for r in tiles.scene_stats(out).collect()}
    for s in (1, 2, 4):
        mine = [v for k, v in want.items() if k[0] == s]
        assert stats[s].total_pixels == len(mine)
        assert stats[s].masked_pixels == sum(m for _, m in mine)
        assert stats[s].mean_ndvi == pytest.approx(sum(v for v, _ in mine) / len(mine))


def test_stored_tiles_shuffle_tiles_only(spark):
    """From stored tiles to scene statistics no exchange sits below a row per pixel."""
    from cropscope.operators import tiles
    rows = [(s, r, c, b, 0.1 * b) for s in range(3) for r in range(64) for c in range(64) for b in (3, 4)]
    df = spark.createDataFrame(rows, BANDS)
    path = shared_path(spark, "tiles")
    tiles.make_tiles(df).write.parquet(path)
    made = spark.read.parquet(path)
    assert made.count() == 6
    pairs = spark.createDataFrame([(s, 3, 4) for s in range(3)], "scene_id long, red_band int, nir_band int")
    stats = tiles.scene_stats(tiles.tile_ndvi(tiles.tile_pairs(made, pairs)))
    assert [r.total_pixels for r in stats.collect()] == [4096] * 3
    p = stats._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in p and "pixel_row" not in p


def test_series_joined_to_pixels(spark):
    listing = spark.createDataFrame([(p,) for p in (
        "/s/f1/20240101_a.tif", "/s/f1/20240111_b.tif", "/s/f1/20240111_b.tif", "/s/f1/20240121_c.tif",
        "/s/f2/bad_d.tif", "/s/f2/20240101_e.TIF")], "path string")
    pixels = spark.createDataFrame([
        ("/s/f1/20240101_a.tif", 0.1), ("/s/f1/20240101_a.tif", 0.3), ("/s/f1/20240111_b.tif", 0.4),
        ("/s/f2/bad_d.tif", 0.5), ("/s/other.tif", 0.5)], "path string, ndvi double")
    trend, lost = jobs.series_trend_job(listing, pixels)
    got = trend.collect()
    assert [(r.field_id, r.n_points, r.colour) for r in got] == [("f1", 2, "green")]
    assert got[0].ndvi_trend == pytest.approx(0.02 * 1000)
    assert sorted((r.path, r.reason) for r in lost.collect()) == [
        ("/s/f1/20240121_c.tif", "image without pixels"), ("/s/f2/bad_d.tif", "name without a date"),
        ("/s/other.tif", "pixels of no listed image")]
    none = spark.createDataFrame([], "path string")
    assert jobs.series_trend_job(none, pixels.limit(0))[0].count() == 0


def test_history_report_reads_twice_and_shuffles_no_sorted_rows(spark):
    from cropscope.plans import QUERIES
    from conftest import SF_SMALL
    df = QUERIES["history_report"](spark, SF_SMALL)
    p = df._jdf.queryExecution().executedPlan().toString()
    assert p.count("events.parquet") == 2 and "SortAggregate" not in p


def test_tiles_are_dealt_by_their_rows(spark, monkeypatch):
    from cropscope.operators import tiles
    px = spark.range(300).selectExpr("id % 3 scene_id", "id pixel_row", "0L pixel_col", "3 band", "double(id) value")
    plain = sorted(map(str, tiles.make_tiles(px).collect()))
    monkeypatch.setattr(tiles, "TASK_ROWS", 30)
    dealt = tiles.make_tiles(px)
    assert "REPARTITION_BY_NUM" in dealt._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(str, dealt.collect())) == plain
