"""Aggregates against brute force: exact median (with a hot group), moments,
histogram, trends, band pairs, date series."""

import datetime as dt
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cropscope.operators import economics, quantile, scene, trend


def _median_check(spark, data):
    df = spark.createDataFrame(data, "k long, v double")
    got = {r.k: r for r in quantile.group_summary(df, "k", "v").collect()}
    groups = {}
    for k, v in data:
        if v is not None:
            groups.setdefault(k, []).append(v)
    assert set(got) == {k for k, _ in data}
    assert all(got[k].n == 0 and got[k].median is None for k in set(got) - set(groups))
    for k, vals in groups.items():
        a = np.array(vals)
        r = got[k]
        assert r.median == pytest.approx(float(np.median(a)), abs=1e-12)
        assert r.n == len(vals)
        assert r.min == a.min() and r.max == a.max()
        assert r.mean == pytest.approx(a.mean(), abs=1e-9)
        assert r.std == pytest.approx(a.std(), abs=1e-9)


def test_median_hot_group_and_refinement(spark, monkeypatch):
    # one key holds a third of the rows; small sort limit forces refinement rounds
    monkeypatch.setattr(quantile, "FINAL_SORT_ROWS", 8)
    rnd = random.Random(7)
    data = [(0, rnd.uniform(-1, 1)) for _ in range(3000)]
    data += [(k, rnd.gauss(0.3, 0.01)) for k in range(1, 101) for _ in range(60)]
    data += [(200, 0.5)] * 11 + [(201, 0.25), (201, 0.75)] + [(202, None)] + [(203, -0.0)]
    _median_check(spark, data)


def test_median_clustered_values(spark, monkeypatch):
    # many distinct values inside one coarse bucket, plus a far outlier
    monkeypatch.setattr(quantile, "FINAL_SORT_ROWS", 4)
    data = [(1, 0.5 + i * 1e-9) for i in range(200)] + [(1, 1e6), (1, -1e6)]
    data += [(2, float(i)) for i in range(101)]
    _median_check(spark, data)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.floats(-1e3, 1e3, allow_nan=False)),
                min_size=1, max_size=80))
def test_median_property(spark, data):
    _median_check(spark, [(k, float(v)) for k, v in data])


def test_scene_stats_with_median_matches_numpy(spark):
    rnd = random.Random(3)
    pix = [(s, rnd.uniform(-0.1, 0.3), rnd.uniform(-0.1, 0.3)) for s in range(5) for _ in range(50)]
    df = scene.with_ndvi_masked(spark.createDataFrame(pix, "scene_id long, red double, nir double"))
    got = {r.scene_id: r for r in scene.scene_ndvi_stats_with_median(df).collect()}
    for s in range(5):
        red = np.array([p[1] for p in pix if p[0] == s])
        nir = np.array([p[2] for p in pix if p[0] == s])
        with np.errstate(invalid="ignore", divide="ignore"):
            r = np.where(red > 0, red, np.nan)
            n = np.where(nir > 0, nir, np.nan)
            v = np.nan_to_num(np.clip((n - r) / (n + r), -1, 1), nan=-1)
        assert got[s].median_ndvi == pytest.approx(np.median(v), abs=1e-12)
        assert got[s].std_ndvi == pytest.approx(v.std(), abs=1e-9)
        assert got[s].mean_ndvi == pytest.approx(v.mean(), abs=1e-12)


def test_health_report_nan_skipping(spark):
    df = spark.createDataFrame([(1, 0.0, 0.0), (1, 1.0, 3.0), (1, float("nan"), 1.0)],
                               "scene_id long, red double, nir double")
    r = scene.scene_health_report(df).collect()[0]
    # ndvi: 0 (0/0.01), 0.5, NaN -> NaN skipped in mean/min/max/std, not valid
    assert r.mean_ndvi == pytest.approx(0.25) and r.min_ndvi == 0.0 and r.max_ndvi == 0.5
    assert r.valid_pixels == 2 and r.total_pixels == 3
    assert r.health_index == pytest.approx(0.625) and r.health_class == "Good"


def test_histogram_numpy_semantics(spark):
    vals = [0.0, 1.0, 2.0, 2.5, 10.0, 10.0, 7.3, None]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = sorted(economics.histogram(df, "x").collect(), key=lambda r: r.bin)
    counts, edges = np.histogram([v for v in vals if v is not None], bins=20)
    assert [r.n for r in got] == list(counts)
    assert [r.bin_lo for r in got] == pytest.approx(list(edges[:-1]))
    assert sum(r.n for r in got) == 7


def test_histogram_all_equal(spark):
    df = spark.createDataFrame([(3.0,)] * 4, "x double")
    got = sorted(economics.histogram(df, "x").collect(), key=lambda r: r.bin)
    counts, _ = np.histogram([3.0] * 4, bins=20)
    assert [r.n for r in got] == list(counts)


def test_trend_cases(spark):
    d = dt.date(2024, 1, 1)
    rows = [
        # field 1: no usable point (NULL value)
        ("f1", d, None),
        # field 2: one point
        ("f2", d, 0.5),
        # field 3: two images on one day -> rank deficient -> 0.0
        ("f3", d, 0.2), ("f3", d, 0.4),
        # field 4: two days, +0.1 per day
        ("f4", d, 0.1), ("f4", d + dt.timedelta(days=1), 0.2),
        # field 5: bad date (NULL after parse) is skipped
        ("f5", None, 0.9), ("f5", d, 0.1), ("f5", d + dt.timedelta(days=2), 0.3),
    ]
    df = spark.createDataFrame(rows, "field string, day date, v double")
    got = {r.field: r.t for r in trend.slope_per(df, "field", "day", "v", 1000.0, "t").collect()}
    assert got == pytest.approx({"f1": 0.0, "f2": 0.0, "f3": 0.0, "f4": 100.0, "f5": 100.0})


@settings(max_examples=5, deadline=None)
@given(st.integers(-2000, 2000))
def test_slope_offset_invariant(spark, offset):
    base = dt.date(2020, 6, 1)
    pts = [("a", base + dt.timedelta(days=i * 3), 0.1 * i + (0.05 if i % 2 else 0.0)) for i in range(6)]
    shifted = [(f, d + dt.timedelta(days=offset), v) for f, d, v in pts]
    a = trend.slope_per(spark.createDataFrame(pts, "f string, d date, v double"), "f", "d", "v", 365.0, "t")
    b = trend.slope_per(spark.createDataFrame(shifted, "f string, d date, v double"), "f", "d", "v", 365.0, "t")
    assert a.collect()[0].t == pytest.approx(b.collect()[0].t, rel=1e-9)


def test_first_n_and_latest(spark):
    base = dt.datetime(2024, 1, 1)
    obs = [(1, i, base + dt.timedelta(hours=i), float(i)) for i in range(15)]
    obs += [(2, 100, base, 0.3), (2, 101, base, 0.7)]      # tie on ts: later id wins
    df = spark.createDataFrame(obs, "field_id long, event_id long, ts timestamp, ndvi double")
    firsts = trend.first_n(df, 10)
    assert firsts.where("field_id = 1").count() == 10
    assert firsts.where("field_id = 1").agg(F.max("event_id")).first()[0] == 9
    latest = {r.field_id: r for r in trend.latest_observation(df).collect()}
    assert latest[1].event_id == 14 and latest[1].n_obs == 15
    assert latest[2].event_id == 101 and latest[2].ndvi == 0.7


def test_band_pair_choice(spark):
    bands = [(s, b, 1.0) for s, n in ((1, 1), (2, 2), (3, 3), (4, 4), (5, 7), (6, 8), (7, 12))
             for b in range(1, n + 1) for _ in range(2)]
    df = spark.createDataFrame(bands, "scene_id long, band int, value double")
    got = {r.scene_id: (r.band_count, r.red_band, r.nir_band) for r in scene.band_pair_choice(df).collect()}
    assert got == {1: (1, None, None), 2: (2, 1, 2), 3: (3, 1, 2), 4: (4, 3, 4), 5: (7, 3, 4),
                   6: (8, 4, 8), 7: (12, 4, 8)}


def test_band_pair_needs_the_bands_themselves(spark):
    """Presence decides, not the count: five bands without 4 fall back to (1, 2)."""
    bands = [(1, b) for b in (1, 2, 3, 5, 6)] + [(2, b) for b in (2, 3, 5)] + [(3, b) for b in (4, 8)]
    df = spark.createDataFrame([(s, b, 1.0) for s, b in bands], "scene_id long, band int, value double")
    got = {r.scene_id: (r.red_band, r.nir_band) for r in scene.band_pair_choice(df).collect()}
    assert got == {1: (1, 2), 2: (None, None), 3: (4, 8)}


def test_two_images_of_one_day_are_two_points(spark):
    """A large and a small image of one day weigh the same in the trend (slope 5.0)."""
    d0, d1 = dt.date(2024, 1, 1), dt.date(2024, 1, 11)
    rows = ([(1, d0, "a", 0.0)] * 9 + [(1, d0, "b", 0.1)] + [(1, d1, "c", 0.1)] * 3)
    df = spark.createDataFrame(rows, "scene_id long, capture_date date, image string, ndvi double")
    got = trend.field_trend_per_1000_days(df, image=("image",)).first()
    assert got.n_points == 3 and abs(got.ndvi_trend - 5.0) < 1e-9


def test_scene_metadata_on_large_keys(spark):
    df = spark.createDataFrame([(1, 5, 0), (1, 6_000_000_000, 3)],
                               "scene_id long, pixel_row long, pixel_col int")
    got = scene.scene_metadata(df).first()
    assert got.height == 5_999_999_996 and got.width == 4 and got.path == "1"


def test_null_date_is_neither_listed_nor_counted(spark):
    df = spark.createDataFrame([(1, dt.date(2024, 3, 1)), (1, None)],
                               "scene_id long, capture_date date")
    got = scene.scene_date_series(df).first()
    assert len(got.dates) == got.n_dates == 1


def test_median_histogram_is_bounded(spark):
    """Continuous values: at most LINEAR_BINS histogram rows per scene, and the median exact."""
    import statistics

    from cropscope.operators import quantile
    df = spark.range(20_000).select((F.col("id") % 2).alias("scene_id"),
                                    (F.rand(3) * 2 - 1).alias("ndvi")).cache()
    bins = df.groupBy("scene_id").agg(F.countDistinct(
        quantile.linear_bucket(F.col("ndvi"), -1.0, 1.0)).alias("n"))
    assert bins.agg(F.max("n")).first()[0] <= quantile.LINEAR_BINS
    got = {r.scene_id: r.median_ndvi for r in scene.scene_ndvi_stats_with_median(df).collect()}
    for k in (0, 1):
        values = [r.ndvi for r in df.where(f"scene_id = {k}").collect()]
        assert got[k] == statistics.median(values)


def test_scene_date_series_sorted_distinct(spark):
    d = dt.date(2024, 3, 1)
    df = spark.createDataFrame([(1, d + dt.timedelta(days=k % 3)) for k in range(9)],
                               "scene_id long, capture_date date")
    r = scene.scene_date_series(df).collect()[0]
    assert r.dates == [d, d + dt.timedelta(days=1), d + dt.timedelta(days=2)]
    assert r.n_dates == 3 and r.pixels == 9


def test_hot_field_trend_and_latest(spark):
    # one field holds a third of all observations; results equal brute force
    rnd = random.Random(11)
    base = dt.datetime(2024, 1, 1)
    obs, eid = [], 0
    for field, n in [(0, 1500)] + [(k, 30) for k in range(1, 101)]:
        for _ in range(n):
            eid += 1
            obs.append((field, eid, base + dt.timedelta(minutes=rnd.randrange(0, 60 * 24 * 40)),
                        rnd.uniform(0, 1)))
    df = spark.createDataFrame(obs, "field_id long, event_id long, ts timestamp, ndvi double")
    got = {r.field_id: r for r in trend.trend_per_year(df).collect()}
    latest = {r.field_id: r for r in trend.latest_observation(df).collect()}
    for field in (0, 1, 50):
        rows = [o for o in obs if o[0] == field]
        x = np.array([(o[2].date() - dt.date(1970, 1, 1)).days for o in rows], dtype=float)
        y = np.array([o[3] for o in rows])
        assert got[field].trend_per_year == pytest.approx(np.polyfit(x, y, 1)[0] * 365, rel=1e-9)
        last = max(rows, key=lambda o: (o[2], o[1]))
        assert latest[field].event_id == last[1] and latest[field].n_obs == len(rows)


def test_approximate_median_option_close_to_exact(spark):
    rnd = random.Random(5)
    pix = [(s, rnd.uniform(0.01, 0.3), rnd.uniform(0.01, 0.3)) for s in range(3) for _ in range(400)]
    df = scene.with_ndvi_masked(spark.createDataFrame(pix, "scene_id long, red double, nir double"))
    exact = {r.scene_id: r.median_ndvi for r in scene.scene_ndvi_stats_with_median(df).collect()}
    approx = {r.scene_id: r.median_ndvi
              for r in scene.scene_ndvi_stats_with_median(df, approximate=True).collect()}
    for s in exact:
        assert abs(exact[s] - approx[s]) < 0.02


def test_metric_tables(spark):
    stats = spark.createDataFrame([(1, 0.25, 0.0, 0.5, 0.2, 0.625, 0.3)],
                                  "scene_id long, mean_ndvi double, min_ndvi double, max_ndvi double, "
                                  "std_ndvi double, healthy_share double, median_ndvi double")
    a = [(r.Metric, r.Value) for r in scene.metric_table(stats, scene.PAGE_A_METRICS)
         .orderBy("position").collect()]
    assert a == [("Mean NDVI", "0.2500"), ("Min NDVI", "0.0000"), ("Max NDVI", "0.5000"),
                 ("Std Dev", "0.2000"), ("Healthy Pixels", "62.5%")]
    b = [r.Metric for r in scene.metric_table(stats).orderBy("position").collect()]
    assert b == ["Minimum", "Maximum", "Mean", "Median", "Std Dev"]


def test_scene_of_null_pixels_is_kept(spark):
    """A3: a scene without a value has 0 pixels and NULL statistics on both paths."""
    df = spark.createDataFrame([(1, 0.5), (1, None), (1, 0.1), (2, None), (2, None)],
                               "scene_id long, ndvi double")
    for approximate in (False, True):
        got = {r.scene_id: r for r in scene.scene_ndvi_stats_with_median(
            df, approximate=approximate).collect()}
        assert (got[2].pixels, got[2].mean_ndvi, got[2].median_ndvi, got[2].std_ndvi) == (0, None, None, None)
        assert got[1].pixels == 2 and got[1].mean_ndvi == pytest.approx(0.3)
    exact = {r.scene_id: r.median_ndvi for r in scene.scene_ndvi_stats_with_median(df).collect()}
    assert exact == {1: pytest.approx(0.3), 2: None}


def test_band_count_is_that_of_the_scene(spark):
    rows = [(1, 0, 0, 1.0, 2.0, 3.0), (1, 0, 1, 2.0, None, 4.0), (2, 0, 0, 1.0, None, float("nan")),
            (3, 0, 0, None, None, None)]
    df = spark.createDataFrame(rows, "scene_id long, pixel_row int, pixel_col int, a double, b double, c double")
    got = scene.band_stats_wide(df, {1: "a", 2: "b", 3: "c"}, header=("pixel_row", "pixel_col")).collect()
    assert {(r.scene_id, r.band): r.band_count for r in got} == {
        (1, 1): 3, (1, 2): 3, (1, 3): 3, (2, 1): 2, (2, 3): 2}
