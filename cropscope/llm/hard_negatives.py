"""Hard-negative mining (operator 11): slot-decomposed selection.

An anchor's positives are its best rows of the same label. A negative for positive i has a
score in the window [low * P_i, P_i]. The upper limits P_1 >= P_2 >= ... split the scores
into disjoint slots (P_(j+1), P_j]; each task keeps, per anchor and slot, only the best k of
the rows it has read (the combiner), and these are merged per slot. Windows overlap, slots
do not: the rows at or below P_i are the slots from i on, so the best k of a window are the
first k of that suffix, taken in descending order, as far as they reach the lower limit.
No pair of anchor and row outside these lists is ever written.

Anchors are a stated query set and are compared with all rows. They are sent to the tasks
in blocks of a fixed number of bytes, one pass over the rows for each block, so what is
broadcast does not grow; rows are not shuffled. Scores are exact integers: products that
fit 53 bits are taken as doubles, others as 64-bit or Python integers.

Defined cases: rows with a null id, label or vector, or with a null or non-finite component
take no part; a component that a vector lacks counts as 0; repeated rows are rows of their
own, each an anchor of its own where its id says so, and a row with the anchor's id is never
its positive; components and scores beyond 64 bits count as the nearest long; an anchor
without a positive, and a window without rows, give no row, and so does an empty table; ties
go to the smaller id; the window of a negative upper limit is empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import importable, stored

#: Bytes of anchor vectors (as doubles) in a block, and scores held at a time in a task.
BLOCK_BYTES, SCORES = 8 << 20, 1 << 21


def usable_rows(table: DataFrame, id_col: str, label_col: str, vector_col: str,
                label: Column | None, scale: float, anchor: Column) -> DataFrame:
    """``_row`` (its own number), ``_id``, ``_y``, ``_v`` (whole numbers) and ``_anchor``,
    of the rows that take part."""
    v = F.col(vector_col)
    good = (F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & v.isNotNull()
            & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x)
                       & (F.abs(x.cast("double")) < F.lit(float("inf")))))
    return table.where(good).select(
        F.monotonically_increasing_id().alias("_row"), F.col(id_col).cast("long").alias("_id"),
        (label if label is not None else F.col(label_col)).cast("long").alias("_y"),
        F.transform(v, lambda x: F.floor(x.cast("double") * F.lit(float(scale)))).alias("_v"),
        anchor.alias("_anchor"))


class Vectors:
    """Rows of a block: numbers, ids, labels and a matrix of whole numbers."""

    def __init__(self, batch: pa.RecordBatch, width: int):
        self.row, self.id, self.label = (
            batch.column(c).to_numpy(zero_copy_only=False) for c in ("_row", "_id", "_y"))
        vectors = batch.column("_v")
        at = vectors.offsets.to_numpy().astype(np.int64)
        flat = vectors.values.to_numpy(zero_copy_only=False)
        sizes = np.diff(at)
        self.v = np.zeros((len(sizes), width), np.int64)
        if (sizes == width).all():
            self.v[:] = flat[at[0]:at[-1]].reshape(-1, width)
        else:
            for k in range(len(sizes)):
                self.v[k, :min(sizes[k], width)] = flat[at[k]:at[k + 1]][:width]
        self.most = float(np.abs(self.v.astype(float)).max(initial=0))
        if self.most < 2.0 ** 53:
            self.real = self.v.astype(float)


def scores(rows: Vectors, r, anchors: Vectors, a) -> np.ndarray:
    """Inner products of rows ``r`` by anchors ``a``: exact doubles or, beyond those, longs."""
    most = rows.most * anchors.most * max(1, rows.v.shape[1])
    if most < 2.0 ** 53:
        return rows.real[r] @ anchors.real[a].T
    if most < 2.0 ** 62:
        return rows.v[r] @ anchors.v[a].T
    exact = rows.v[r].astype(object) @ anchors.v[a].astype(object).T
    top = (1 << 63) - 1
    return np.clip(exact, -top, top).astype(np.int64)


def best(group: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the first ``k`` of each group by descending score, then id."""
    order = np.lexsort((ids, -score, group))
    g = group[order]
    head = np.concatenate(([True], g[1:] != g[:-1])) if len(g) else np.empty(0, bool)
    start = np.maximum.accumulate(np.where(head, np.arange(len(g)), 0))
    return order[np.arange(len(g)) - start < k]


class Kept:
    """The best ``k`` (score, id) of every group seen so far. What comes is set aside if it
    reaches its group's k-th score, and merged in when there is much of it."""

    def __init__(self, groups: int, k: int):
        self.k = k
        none = np.empty(0, np.int64)
        self.group, self.score, self.id = none, none, none
        self.floor = np.full(groups, -(1 << 63), np.int64)  # the k-th score of a full group
        self.aside: list[tuple] = []
        self.waiting = 0

    def add(self, group: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        ok = score >= self.floor[group]
        self.aside.append((group[ok], score[ok].astype(np.int64), ids[ok]))
        self.waiting += len(self.aside[-1][0])
        if self.waiting > max(1 << 18, 2 * len(self.group)):
            self.merge()

    def merge(self) -> None:
        g, s, i = (np.concatenate(x) for x in zip((self.group, self.score, self.id), *self.aside))
        top = best(g, s, i, self.k)
        self.group, self.score, self.id = g[top], s[top], i[top]
        n = np.bincount(self.group, minlength=len(self.floor))
        full = n >= self.k
        self.floor[full] = self.score[(np.cumsum(n) - 1)[full]]
        self.aside, self.waiting = [], 0


_LISTS = "_row long, _slot int, _score long, _other long"


def _pass(rows: DataFrame, block, k: int, visit) -> DataFrame:
    """One pass over ``rows`` against a broadcast block of anchors. ``visit`` adds scores to
    the kept lists; a task returns its lists when its rows end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = block.value
        kept = Kept(anchors.slots * len(anchors.row), k)
        step = max(1, SCORES // max(1, len(anchors.row)))
        for b in batches:
            got = Vectors(b, anchors.v.shape[1])
            for lo in range(0, len(got.row), step):
                visit(got, np.arange(lo, min(lo + step, len(got.row))), anchors, kept)
        kept.merge()
        yield pa.RecordBatch.from_arrays([
            pa.array(anchors.row[kept.group // anchors.slots]),
            pa.array((kept.group % anchors.slots).astype(np.int32)),
            pa.array(kept.score), pa.array(kept.id)], ["_row", "_slot", "_score", "_other"])

    return rows.select("_row", "_id", "_y", "_v").mapInArrow(run, _LISTS)


def _same_label(rows: Vectors, part: np.ndarray, anchors, kept: Kept) -> None:
    for y in np.unique(rows.label[part]):
        a = np.nonzero(anchors.label == y)[0]
        if len(a):
            r = part[rows.label[part] == y]
            s = scores(rows, r, anchors, a)
            x, z = np.nonzero((rows.id[r][:, None] != anchors.id[a]) & (s >= kept.floor[a]))
            kept.add(a[z], s[x, z], rows.id[r][x])


def _other_label(rows: Vectors, part: np.ndarray, anchors, kept: Kept) -> None:
    """Scores inside some window, by slot. Open slots have no room: their ``least`` is above
    every limit."""
    s = scores(rows, part, anchors, slice(None))
    x, z = np.nonzero((rows.label[part][:, None] != anchors.label)
                      & (s <= anchors.limits[:, 0]) & (s >= anchors.lowest))
    got = s[x, z]
    slot = np.zeros(len(z), np.int64)
    for j in range(1, anchors.slots):
        slot += got <= anchors.limits[z, j]
    ok = got >= anchors.least[z, slot]
    kept.add((z * anchors.slots + slot)[ok], got[ok], rows.id[part][x[ok]])


def _ranked(lists: DataFrame, k: int) -> DataFrame:
    """The best ``k`` of every (anchor row, slot) over all tasks, with rank ``_n``."""
    w = Window.partitionBy("_row", "_slot").orderBy(F.desc("_score"), "_other")
    return lists.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= k)


def mine(table: DataFrame, id_col: str = "vec_id", label_col: str = "label",
         vector_col: str = "embedding", *, anchor: Column, label: Column | None = None,
         scale: float = 256.0, positives: int = 5, k: int = 5, low_percent: int = 80,
         block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``_anchor, _positive, _rank, _negative, _positive_score, _negative_score``: for every
    anchor (rows for which ``anchor`` holds) and each of its best ``positives`` rows of the
    same label, the best ``k`` rows of other labels with
    ``low_percent * positive <= 100 * negative <= 100 * positive``."""
    spark = table.sparkSession
    importable(spark)
    send = spark.sparkContext.broadcast
    rows = stored(usable_rows(table, id_col, label_col, vector_col, label, scale, anchor),
                  "negative_rows")
    queries = rows.where("_anchor")
    size = queries.agg(F.count("*").alias("n"), F.max(F.size("_v")).alias("width")).first()
    width = size["width"] or 0
    blocks = -(-size["n"] // max(1, block_bytes // (8 * max(1, width))))
    block_of = F.pmod(F.xxhash64("_row"), F.lit(max(1, blocks)))
    found, slots = [], []
    for b in range(blocks):
        got = (queries.where(block_of == b).select("_row", "_id", "_y", "_v").toArrow()
               .combine_chunks().to_batches())
        if not got:
            continue
        anchors = Vectors(got[0], width)
        anchors.slots = 1
        first = stored(_ranked(_pass(rows, send(anchors), positives, _same_label), positives)
                       .select("_row", F.col("_n").cast("int").alias("_n"), "_score", "_other"),
                       "positives")
        anchors = Vectors(got[0], width)
        _set_limits(anchors, first, positives, low_percent)
        found.append(first)
        slots.append(stored(_ranked(_pass(rows, send(anchors), k, _other_label), k)
                            .select("_row", "_slot", "_score", "_other"), "slots"))
    if not found:
        none = spark.createDataFrame([], "_row long, _n int, _score long, _other long")
        found, slots = [none], [none.withColumnRenamed("_n", "_slot")]
    return _merged(queries, reduce(DataFrame.unionByName, found),
                   reduce(DataFrame.unionByName, slots), k, low_percent)


def _set_limits(anchors, positives: DataFrame, most: int, low_percent: int) -> None:
    """Distinct upper limits of a block's anchors, descending, and the least score that is of
    use in each slot: ``low_percent`` of its limit, rounded up."""
    place = {r: i for i, r in enumerate(anchors.row.tolist())}
    anchors.slots = most
    anchors.limits = np.full((len(place), most), -(1 << 63), np.int64)
    anchors.least = np.full((len(place), most), (1 << 63) - 1, np.int64)
    filled = [0] * len(place)
    for r in positives.orderBy("_row", "_n").toLocalIterator():
        i, p = place[r["_row"]], r["_score"]
        j = filled[i]
        if p >= 0 and (j == 0 or anchors.limits[i, j - 1] != p):
            anchors.limits[i, j], anchors.least[i, j] = p, -(-low_percent * p // 100)
            filled[i] += 1
    anchors.lowest = anchors.least.min(axis=1, initial=(1 << 63) - 1)


def _merged(queries: DataFrame, positives: DataFrame, slots: DataFrame, k: int,
            low_percent: int) -> DataFrame:
    """Answers of all windows: an anchor's slots, each already in descending order, make one
    descending list of at most slots * k rows; a window's answer is the start of its suffix."""
    down = slots.groupBy("_row").agg(F.array_sort(F.collect_list(F.struct(
        (-F.col("_score")).alias("down"), F.col("_other").alias("id"),
        F.col("_slot").alias("slot")))).alias("_down"))
    rank = F.dense_rank().over(Window.partitionBy("_row").orderBy(F.desc("_score")))
    pos = positives.select("_row", F.col("_other").alias("_positive"),
                           F.col("_score").alias("_positive_score"), (rank - 1).alias("_from"))
    named = queries.select("_row", F.col("_id").alias("_anchor"))
    wide = lambda c: c.cast("decimal(24,0)")
    hits = F.filter(F.slice(F.filter("_down", lambda x: x["slot"] >= F.col("_from")), 1, k),
                    lambda x: wide(-x["down"]) * 100 >= wide(F.col("_positive_score")) * low_percent)
    return (pos.join(down, "_row").join(named, "_row").where("_positive_score >= 0")
            .select("_anchor", "_positive", "_positive_score", F.posexplode(hits).alias("_at", "_x"))
            .select("_anchor", "_positive", (F.col("_at") + 1).cast("int").alias("_rank"),
                    F.col("_x")["id"].alias("_negative"), "_positive_score",
                    (-F.col("_x")["down"]).alias("_negative_score")))
