"""Exact per-group median (plus moments) without gathering a group in one task.

Spark's exact ``median``/``percentile`` keep every distinct value of a group in
one aggregation buffer, so a scene holding a third of all pixels would end up
in a single task. This operator finds the middle value(s) by counting instead:

1. One scan assigns every value a coarse bucket computed from the value alone
   (sign, binary exponent and the top mantissa bits: monotone in the value,
   2**11 buckets per power of two) and aggregates ``(group, bucket)`` to
   count / sum / min / max / M2. The aggregation is partial before the shuffle,
   so a hot group ships one small row per bucket and task. A group has a
   bounded number of buckets, whatever its size.
2. One window over each group's buckets gives the group size, mean and the
   running count; the buckets holding the middle rank(s) are picked directly.
   Min, max, mean and the population standard deviation are merged from the
   bucket rows (parallel-variance formula), so no second scan is needed.
   A bucket whose min equals its max, or a rank at its first or last row, is
   answered from the bucket's min/max.
3. Still-open ranks are refined on the rows of their bucket only (value range
   filter; the side of open ranks holds at most two rows per group), splitting the range
   into equal-width sub-buckets, until a bucket is small enough to sort.

The bounded bucket histogram, and the rows kept for a further round, are
written once to the shared checkpoint folder and read back
(``session.materialize``), which cuts lineage and keeps a lost executor from
redoing earlier rounds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, materialize

MANTISSA_BITS = 11          # coarse buckets per power of two: 2**11
REFINE_BINS = 2048          # equal-width sub-buckets per refinement round
FINAL_SORT_ROWS = 4096      # a bucket this small is sorted to pick the rank
LINEAR_BINS = 1024          # bins of a known value range


def coarse_bucket(v: Column) -> Column:
    """Order-preserving bucket id of a double, computed from the value alone."""
    a = F.abs(v)
    e0 = F.floor(F.log2(a))
    e = (F.when(F.pow(F.lit(2.0), e0) > a, e0 - 1)
         .when(F.pow(F.lit(2.0), e0 + 1) <= a, e0 + 1)
         .otherwise(e0))
    scale = 1 << MANTISSA_BITS
    m = F.floor((a / F.pow(F.lit(2.0), e) - 1.0) * scale)
    m = F.least(F.greatest(m, F.lit(0)), F.lit(scale - 1))
    code = (e + 1100) * scale + m + 1
    top = 2200 * scale + 2
    return (F.when(F.isnan(v), F.lit(top + 1))
            .when(v == 0, F.lit(0))
            .when(F.isnull(e0) | (a == float("inf")), F.signum(v) * top)
            .otherwise(F.signum(v) * code)).cast("long")


def linear_bucket(v: Column, lo: float, hi: float, bins: int = LINEAR_BINS) -> Column:
    """Equal-width bin of a value known to lie in [lo, hi]; NaN comes last. A group has
    at most ``bins`` of them, however many pixels and distinct values it holds."""
    b = F.floor((v - F.lit(lo)) / F.lit(hi - lo) * F.lit(bins - 1))
    return (F.when(F.isnan(v), F.lit(bins - 1))
            .otherwise(F.least(F.greatest(b, F.lit(0)), F.lit(bins - 2)))).cast("long")


def _bucket_stats(rows: DataFrame, keys: list[str], bucket: Column) -> DataFrame:
    return (rows.withColumn("_b", bucket).groupBy(*keys, "_b")
            .agg(F.count("_v").alias("_c"), F.sum("_v").alias("_s"),
                 F.min("_v").alias("_lo"), F.max("_v").alias("_hi"),
                 (F.var_pop("_v") * F.count("_v")).alias("_m2")))


def _resolve(state: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split located ranks into answered ones (_k, _rank, _val) and open ones."""
    lo, hi, within, c = F.col("_lo"), F.col("_hi"), F.col("_within"), F.col("_c")
    resolved = (lo == hi) | (within == 0) | (within == c - 1)
    val = F.when((lo == hi) | (within == 0), lo).otherwise(hi)
    done = state.where(resolved).select("_k", "_rank", val.alias("_val"))
    open_ = state.where(~resolved).select("_k", "_rank", "_within", "_c", "_lo", "_hi")
    return done, open_


def _open_info(open_: DataFrame) -> tuple[int, int]:
    row = open_.agg(F.count(F.lit(1)).alias("n"), F.max("_c").alias("c")).first()
    return int(row["n"]), int(row["c"] or 0)


def _refine(rows: DataFrame, open_: DataFrame) -> list[DataFrame]:
    """Answer every open rank by narrowing its bucket until it can be sorted.

    One small job per round reads the number of open ranks and their largest
    bucket. When every open bucket is small enough to sort, the ranks are
    picked inside the caller's final plan (no extra job); otherwise the rows of
    the big buckets are written once to shared storage and split again.
    """
    results = []
    current, keys = rows, ["_k"]
    n_open, max_c = _open_info(open_)
    while n_open:
        members = (current.join(open_, keys, "inner")
                   .where((F.col("_v") >= F.col("_lo")) & (F.col("_v") <= F.col("_hi")))
                   .select("_k", "_rank", "_v", "_within", "_c", "_lo", "_hi"))
        picked = (members.where(F.col("_c") <= FINAL_SORT_ROWS)
                  .groupBy("_k", "_rank", "_within")
                  .agg(F.sort_array(F.collect_list("_v")).alias("_vals"))
                  .select("_k", "_rank",
                          F.element_at("_vals", (F.col("_within") + 1).cast("int")).alias("_val")))
        if max_c <= FINAL_SORT_ROWS:
            results.append(picked)
            break
        results.append(materialize(picked, "median_picked"))
        span = F.col("_hi") / 2.0 - F.col("_lo") / 2.0
        sub = F.least(F.lit(REFINE_BINS - 1),
                      F.floor((F.col("_v") / 2.0 - F.col("_lo") / 2.0) / span * REFINE_BINS))
        big = materialize(members.where(F.col("_c") > FINAL_SORT_ROWS)
                          .select("_k", "_rank", "_within", "_v", sub.cast("long").alias("_sb")),
                          "median_rows")
        hist = (big.groupBy("_k", "_rank", "_within", "_sb")
                .agg(F.count(F.lit(1)).alias("_c"), F.min("_v").alias("_lo"),
                     F.max("_v").alias("_hi")))
        w = Window.partitionBy("_k", "_rank").orderBy("_sb").rowsBetween(
            Window.unboundedPreceding, Window.currentRow)
        located = (hist.withColumn("_end", F.sum("_c").over(w))
                   .withColumn("_start", F.col("_end") - F.col("_c"))
                   .where((F.col("_within") >= F.col("_start"))
                          & (F.col("_within") < F.col("_end")))
                   .select("_k", "_rank", (F.col("_within") - F.col("_start")).alias("_within"),
                           "_c", "_lo", "_hi"))
        done, open_ = _resolve(materialize(located, "median_state"))
        results.append(done)
        current, keys = big.select("_k", "_rank", "_v"), ["_k", "_rank"]
        n_open, max_c = _open_info(open_)
    return results


def group_summary(df: DataFrame, key: str, value: str,
                  bounds: tuple[float, float] | None = None) -> DataFrame:
    """Per group, over the non-NULL values: ``n``, ``min``, ``max``, ``mean``,
    population ``std`` and the exact ``median`` (average of the two middle
    values for an even count). NaN is not skipped (it makes mean/std NaN). A group
    without values is kept: ``n`` 0, the rest NULL.
    ``bounds`` names a range that holds every value: the histogram then has
    ``LINEAR_BINS`` rows per group at most instead of 2**11 per power of two.

    The bucket histogram (bounded rows per group) is written once to the
    shared checkpoint folder: it feeds the moments, the rank search and the
    answer without a second scan, survives a lost executor and holds no cache.
    """
    ensure_checkpoint_dir(df.sparkSession)
    rows = df.select(F.col(key).alias("_k"), F.col(value).cast("double").alias("_v"))
    bucket = linear_bucket(F.col("_v"), *bounds) if bounds else coarse_bucket(F.col("_v"))
    # NULL values are a bucket of their own that counts none
    hist = _bucket_stats(rows, ["_k"], F.when(F.col("_v").isNotNull(), bucket))
    rows = rows.where(F.col("_v").isNotNull())
    whole = Window.partitionBy("_k")
    running = whole.orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    h = (hist.withColumn("_n", F.sum("_c").over(whole))
         .withColumn("_mean", F.try_divide(F.sum("_s").over(whole), F.col("_n")))
         .withColumn("_end", F.sum("_c").over(running))
         .withColumn("_start", F.col("_end") - F.col("_c")))
    h = materialize(h, "median_hist")

    dev = F.try_divide("_s", "_c") - F.col("_mean")
    stats = h.groupBy("_k").agg(
        F.first("_n").alias("n"), F.min("_lo").alias("min"), F.max("_hi").alias("max"),
        F.first("_mean").alias("mean"),
        F.sqrt(F.try_divide(F.sum(F.col("_m2") + F.col("_c") * dev * dev), F.first("_n")))
        .alias("std"))

    lo_rank = F.floor((F.col("_n") - 1) / 2)
    hi_rank = F.floor(F.col("_n") / 2)
    ranks = F.array_distinct(F.array(lo_rank, hi_rank))
    state = (h.select("_k", "_c", "_lo", "_hi", "_start", "_end",
                      F.explode(ranks).alias("_rank"))
             .where((F.col("_rank") >= F.col("_start")) & (F.col("_rank") < F.col("_end")))
             .select("_k", "_rank", (F.col("_rank") - F.col("_start")).alias("_within"),
                     "_c", "_lo", "_hi"))
    done, open_ = _resolve(state)
    answered = [done] + _refine(rows, open_)
    vals = answered[0]
    for r in answered[1:]:
        vals = vals.unionByName(r)
    med = vals.groupBy("_k").agg(F.avg("_val").alias("median"))
    return stats.join(med, "_k", "left").withColumnRenamed("_k", key)


def exact_median(df: DataFrame, key: str, value: str, out: str = "median") -> DataFrame:
    """Exact median per group: ``(key, out)``."""
    return group_summary(df, key, value).select(key, F.col("median").alias(out))
