"""Trends and observation history.

Least-squares slopes are ``regr_slope`` aggregates over centred moments, so a field
with a third of all observations still folds its points in every task before the
shuffle, and day numbers near 20,000 do not cancel the significant digits. "Latest"
uses ``max_by`` (also algebraic); "first N" uses ``row_number() <= N``, which Spark plans with a
partial WindowGroupLimit before the shuffle, so at most N rows per field and
task ever cross the network.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import constants as K
from ..functions.guards import clip
from ..functions.ndvi import health_index, ndvi_masked
from ..functions.paths import day_number
from ..functions.rules import trend_colour, trend_direction


def image_means(pixels: DataFrame, field: str = "scene_id", image=("capture_date",),
                ndvi: str = "ndvi") -> DataFrame:
    """Mean of the clipped NDVI per image of a field. Two images of one
    date stay two points when ``image`` holds an image id besides the date."""
    v = clip(F.col(ndvi), K.NDVI_MIN, K.NDVI_MAX)
    return pixels.groupBy(field, *image).agg(F.avg(v).alias("mean_ndvi"),
                                             F.count(F.lit(1)).alias("pixels"))


def slope_per(points: DataFrame, field: str, date: str, value: str,
              days: float, out: str) -> DataFrame:
    """Least-squares slope of ``value`` over the day number of ``date``, scaled
    to ``days``; fewer than two usable points, or all on one day -> 0.0.

    ``regr_slope`` merges centred moments, so a hot field ships one row per task, and
    day numbers near 20,000 cost no digits. ``n_points`` counts every row of the field,
    usable or not.
    """
    slope = F.regr_slope(F.col(value).cast("double"), day_number(date).cast("double"))
    return points.groupBy(field).agg(
        F.count(F.lit(1)).alias("n_points"),
        (F.coalesce(slope, F.lit(0.0)) * days).alias(out))


def field_trend_per_1000_days(pixels: DataFrame, field: str = "scene_id",
                              date: str = "capture_date", ndvi: str = "ndvi",
                              image=()) -> DataFrame:
    """A6 -> A7 -> C3/P24: per-field NDVI trend per 1000 days and its bar colour. Every
    image is one point: ``image`` names the columns that tell images of one day apart."""
    pts = image_means(pixels, field, (date, *image), ndvi)
    return (slope_per(pts, field, date, "mean_ndvi", K.TREND_DAYS_FIELD, "ndvi_trend")
            .withColumn("colour", trend_colour("ndvi_trend")))


def trend_per_year(obs: DataFrame, field: str = "field_id", ts: str = "ts",
                   value: str = "ndvi") -> DataFrame:
    """A8 + P23 + F4: yearly NDVI trend per field from its observations, with
    direction, magnitude and whether the page would show it (>= 2 points)."""
    day = F.col(ts).cast("date")
    return (slope_per(obs.withColumn("_day", day), field, "_day", value,
                      K.TREND_DAYS_YEAR, "trend_per_year")
            .withColumn("direction", trend_direction("trend_per_year"))
            .withColumn("abs_trend", F.abs("trend_per_year"))
            .withColumn("shown", F.col("n_points") >= 2))


def first_n(obs: DataFrame, n: int = K.TREND_FIRST_N, field: str = "field_id",
            order=("ts", "event_id")) -> DataFrame:
    """The first ``n`` observations of each field in time order."""
    w = Window.partitionBy(field).orderBy(*[F.col(c).asc() for c in order])
    return obs.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def trend_first_ten(obs: DataFrame, field: str = "field_id") -> DataFrame:
    """W2 + A8: page-B trend over the first ten observations (slope x 365)."""
    return trend_per_year(first_n(obs, K.TREND_FIRST_N, field), field)


def time_order(obs: DataFrame, ts: str = "ts", event_id: str = "event_id") -> Column:
    """(time, id) as one number that orders alike: microseconds times 10^19 plus the id, NULL
    first. A buffer of fixed width, so aggregates over it hash instead of sorting rows."""
    t = F.col(ts)
    if isinstance(obs.schema[ts].dataType, T.TimestampNTZType):
        # by its own fields: no time zone comes in
        seconds = ((day_number(t.cast("date")).cast("long") * 24 + F.hour(t)) * 60 + F.minute(t)) * 60
        part = (F.date_part(F.lit("SECOND"), t) * 1_000_000).cast("long")
        micros = seconds * 1_000_000 + part
    else:
        micros = F.unix_micros(t.cast("timestamp"))
    wide = lambda c: c.cast("decimal(38,0)")
    return (wide(F.coalesce(micros, F.lit(-(10 ** 18)))) * F.lit(Decimal(10 ** 19))
            + wide(F.coalesce(F.col(event_id).cast("long"), F.lit(-(1 << 63)))))


def latest_observation(obs: DataFrame, field: str = "field_id",
                       values=("ndvi",)) -> DataFrame:
    """W1 + F5: latest observation per field (ties broken by the later id) and
    the number of observations; fields without history do not appear."""
    key = F.col("_order")
    out = obs.withColumn("_order", time_order(obs)).groupBy(field).agg(
        F.count(F.lit(1)).alias("n_obs"),
        *[F.max_by(c, key).alias(c) for c in ("ts", "event_id", *values)])
    return out.select(field, "n_obs", "ts", "event_id", *values)


def history_series(obs: DataFrame, field: str = "field_id", ts: str = "ts") -> DataFrame:
    """C4: NDVI, health and, where ``obs`` has it, predicted yield over time, ordered
    for plotting (range-partitioned global sort on (field, ts), so one hot field still
    spreads over tasks)."""
    extra = [c for c in ("predicted_yield",) if c in obs.columns]
    return (obs.select(field, ts, "event_id", "ndvi",
                       health_index("ndvi").alias("health_index"), *extra)
            .orderBy(field, ts, "event_id"))


def with_masked_ndvi(pixels: DataFrame, red: str = "red", nir: str = "nir") -> DataFrame:
    return pixels.withColumn("ndvi", ndvi_masked(red, nir))
