"""Running state per field (T2, A8, W1, W2) that merges: count, latest observation, the
moments of the trend line and the first ten observations.

Each micro-batch is folded to one row per field that it touches and written as an epoch;
an epoch counts once it is committed. Rows of several epochs merge in any order: counts
add up, the latest is the greatest, the first ten are the first ten of all, and the
centred moments merge pairwise. So nothing is kept in a state store, an epoch that is
written again replaces itself, and a reader merges one snapshot and the epochs since.
Every ``compact_every`` epochs a new snapshot is written beside the old one and committed.

    <table>/epochs/epoch=N      rows of epoch N        <table>/_epochs/N      its record
    <table>/snapshots/upto=N    merged rows up to N    <table>/_snapshots/N   its record
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.paths import day_number
from ..functions.rules import trend_direction
from ..operators.trend import first_n, time_order
from ..sources.commits import commit, committed, remove

_SEEN = "struct<ts: timestamp_ntz, event_id: bigint, ndvi: double>"
_LINE = "struct<n: double, x: double, y: double, xx: double, xy: double>"


def schema(key: str = "field_id bigint") -> str:
    return f"{key}, n_obs bigint, latest {_SEEN}, line {_LINE}, first array<{_SEEN}>"


def fold(obs: DataFrame, field: str = "field_id") -> DataFrame:
    """State rows of a batch of observations (``field, event_id, ts, ndvi``). Rows without a
    time or value count as observations but not as points of the line."""
    seen = F.struct(F.col("ts").cast("timestamp_ntz").alias("ts"),
                    F.col("event_id").cast("long").alias("event_id"),
                    F.col("ndvi").cast("double").alias("ndvi"))
    day = day_number(F.col("ts").cast("date")).cast("double")
    ok = F.col("ndvi").isNotNull() & F.col("ts").isNotNull()
    x, y = F.when(ok, day), F.when(ok, F.col("ndvi").cast("double"))
    n = F.count(x).cast("double")
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    line = F.struct(n.alias("n"), zero(F.avg(x)).alias("x"), zero(F.avg(y)).alias("y"),
                    zero(F.var_pop(x) * n).alias("xx"), zero(F.covar_pop(x, y) * n).alias("xy"))
    last = F.struct(*[F.max_by(seen[c], F.col("_order")).alias(c) for c in ("ts", "event_id", "ndvi")])
    sums = obs.withColumn("_order", time_order(obs)).groupBy(field).agg(
        F.count(F.lit(1)).alias("n_obs"), last.alias("latest"), line.alias("line"))
    early = first_n(obs, K.TREND_FIRST_N, field).groupBy(field).agg(
        F.sort_array(F.collect_list(seen)).alias("first"))
    same = sums[field].eqNullSafe(early[field])
    # both sides grow with the fields: a merge join, or every epoch is gathered on the driver
    return sums.join(early.hint("merge"), same).select(sums[field], "n_obs", "latest", "line", "first")


def _joined_line(a: Column, b: Column) -> Column:
    n = a["n"] + b["n"]
    share = F.when(n > 0, b["n"] / F.greatest(n, F.lit(1.0))).otherwise(F.lit(0.0))
    dx, dy = b["x"] - a["x"], b["y"] - a["y"]
    return F.struct(n.alias("n"), (a["x"] + dx * share).alias("x"), (a["y"] + dy * share).alias("y"),
                    (a["xx"] + b["xx"] + dx * dx * a["n"] * share).alias("xx"),
                    (a["xy"] + b["xy"] + dx * dy * a["n"] * share).alias("xy"))


def merge(rows: DataFrame, field: str = "field_id") -> DataFrame:
    """State rows merged to one per field. A field has at most a row per epoch since the
    snapshot, so its list is short however many observations it stands for."""
    one = rows.groupBy(field).agg(F.collect_list(F.struct(
        "n_obs", "latest", "line", "first")).alias("s"))
    none = F.struct(*[F.lit(0.0).alias(c) for c in ("n", "x", "y", "xx", "xy")])
    return one.select(
        field,
        F.aggregate("s", F.lit(0).cast("long"), lambda a, r: a + r["n_obs"]).alias("n_obs"),
        F.array_max(F.transform("s", lambda r: r["latest"])).alias("latest"),
        F.aggregate("s", none, lambda a, r: _joined_line(a, r["line"])).alias("line"),
        F.slice(F.sort_array(F.flatten(F.transform("s", lambda r: r["first"]))), 1,
                K.TREND_FIRST_N).alias("first"))


def write_epoch(batch: DataFrame, epoch: int, path: str, compact_every: int = 10) -> None:
    """Fold and write one micro-batch, commit it, and compact when it is due."""
    spark = batch.sparkSession
    fold(batch).write.mode("overwrite").parquet(f"{path}/epochs/epoch={epoch}")
    commit(spark, f"{path}/_epochs", epoch)
    done = committed(spark, f"{path}/_snapshots")
    if epoch - (done[-1] if done else -1) >= compact_every:
        compact(spark, path)


def parts(spark: SparkSession, path: str) -> list[str]:
    """Folders that make up the state: the last committed snapshot and the epochs after it."""
    done = committed(spark, f"{path}/_snapshots")
    base = done[-1] if done else -1
    return [f"{path}/snapshots/upto={base}"][:len(done)] + [
        f"{path}/epochs/epoch={e}" for e in committed(spark, f"{path}/_epochs") if e > base]


def read(spark: SparkSession, path: str) -> DataFrame:
    """The merged state; empty before the first commit."""
    found = parts(spark, path)
    if not found:
        return spark.createDataFrame([], schema())
    return merge(spark.read.schema(schema()).parquet(*found))


def compact(spark: SparkSession, path: str) -> int | None:
    """Write and commit a snapshot of everything committed; its number."""
    epochs = committed(spark, f"{path}/_epochs")
    if not epochs:
        return None
    read(spark, path).write.mode("overwrite").parquet(f"{path}/snapshots/upto={epochs[-1]}")
    commit(spark, f"{path}/_snapshots", epochs[-1])
    return epochs[-1]


def expire(spark: SparkSession, path: str) -> None:
    """Remove what only readers of older snapshots than the last two would need: a reader
    that has listed its parts keeps them through one compaction."""
    done = committed(spark, f"{path}/_snapshots")
    if len(done) < 2:
        return
    for old in done[:-2]:
        remove(spark, f"{path}/_snapshots/{old:012d}")
        remove(spark, f"{path}/snapshots/upto={old}")
    for e in committed(spark, f"{path}/_epochs"):
        if e <= done[-2]:
            remove(spark, f"{path}/_epochs/{e:012d}")
            remove(spark, f"{path}/epochs/epoch={e}")


def latest(state: DataFrame, field: str = "field_id") -> DataFrame:
    """Observations and latest NDVI per field."""
    return state.select(field, "n_obs", *[F.col(f"latest.{c}").alias(c)
                                          for c in ("ts", "event_id", "ndvi")])


def _slope(line: Column) -> Column:
    return F.when(line["xx"] > 0, line["xy"] / line["xx"]).otherwise(F.lit(0.0))


def trends(state: DataFrame, field: str = "field_id", keep=()) -> DataFrame:
    """The yearly trend over all observations and over the first ten; ``keep``
    names state columns to keep."""
    none = F.struct(*[F.lit(0.0).alias(c) for c in ("n", "x", "y", "xx", "xy")])
    zero = F.lit(0.0)
    points = F.filter("first", lambda r: r["ts"].isNotNull() & r["ndvi"].isNotNull())
    ten = F.aggregate(points, none, lambda a, r: _joined_line(a, F.struct(
        F.lit(1.0).alias("n"), day_number(r["ts"].cast("date")).cast("double").alias("x"),
        r["ndvi"].alias("y"), zero.alias("xx"), zero.alias("xy"))))
    year = _slope(F.col("line")) * K.TREND_DAYS_YEAR
    return (state.withColumn("_ten", ten)
            .select(field, "n_obs", *keep, year.alias("trend_per_year"),
                    (_slope(F.col("_ten")) * K.TREND_DAYS_YEAR).alias("trend_first_ten"))
            .withColumn("direction", trend_direction("trend_per_year")))
