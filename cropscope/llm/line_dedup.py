"""Line dedup (operator 4): native DataFrame operations only.

Line hashes are range-partitioned and sorted by (hash, document, position), so a
line held by many documents spreads over many ranges. Streaming over the sorted
rows leaves one row per (line, document); their counts and the last holder decide.
What is returned per document is a run-length keep bitmap, never text: the runs
``(first, len)`` of kept line numbers, as small as the document's changes.

Defined cases: a null or empty text is one empty line; lines shorter than
``min_chars`` code points after stripping never drop; a line repeated inside one
document counts as one document; in the keeping document all its copies stay; a
document that loses every line keeps ``''``; an empty table gives an empty
result; rows with a null id are ignored as holders and keep every line; rows
that share an id count as one document for the counting, and each has its own
line numbers (bitmaps are told apart by a hash of the text); a very long text is split
whole, and a line of any length is one line. Columns whose names clash with those added are
kept if other ``names`` are given.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, ascii_lower, fresh, shuffle_partitions, stored

NAMES = ("_n_lines", "_n_dropped", "_kept")


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(SPACE)))


def _holders(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """One row (h1, h2, doc, positions) per long line and document."""
    lines = (docs.where(F.col(id_col).isNotNull() & (F.char_length(text_col) >= min_chars))
             .select(F.col(id_col).alias("_doc"), F.xxhash64(text_col).alias("_tag"),
                     F.posexplode(lines_of(F.col(text_col))).alias("_pos", "_line"))
             .select("_doc", "_tag", "_pos", line_key(F.col("_line")).alias("_key"))
             .where(F.char_length("_key") >= min_chars)
             .select(F.xxhash64("_key").alias("_h1"),
                     F.xxhash64(F.lit(7), "_key").alias("_h2"), "_doc", "_tag", "_pos"))
    parts = shuffle_partitions(docs.sparkSession)
    return (lines.repartitionByRange(parts, "_h1", "_h2", "_doc")
            .sortWithinPartitions("_h1", "_h2", "_doc", "_pos")
            .groupBy("_h1", "_h2", "_doc").agg(F.collect_list(F.struct("_tag", "_pos")).alias("_at")))


def _runs(kept: Column) -> Column:
    """Ascending numbers -> array of (first, len) of consecutive runs."""
    prev = F.concat(F.array(F.lit(-2)), kept)
    nxt = F.concat(F.slice(kept, 2, F.greatest(F.size(kept), F.lit(1))), F.array(F.lit(-2)))
    starts = F.filter(F.zip_with(kept, prev, lambda x, p: F.when(x != p + 1, x)),
                      lambda x: x.isNotNull())
    ends = F.filter(F.zip_with(kept, nxt, lambda x, n: F.when(n != x + 1, x)),
                    lambda x: x.isNotNull())
    return F.zip_with(starts, ends, lambda a, b: F.struct(a.alias("first"),
                                                          (b - a + 1).alias("len")))


def keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """(id, tag, dropped) for each document that loses lines: the ascending line numbers
    to drop as runs ``array<struct<first:int,len:int>>`` (0-based), whose complement is
    the keep bitmap; ``tag`` is the text's xxhash64. See :func:`apply_bitmaps`."""
    held = stored(_holders(docs, id_col, text_col, min_chars), "line_holders")
    frequent = stored(held.groupBy("_h1", "_h2")
                      .agg(F.count("*").alias("_n"), F.max("_doc").alias("_keeper"))
                      .where(F.col("_n") >= min_docs).drop("_n"), "frequent_lines")
    drops = (held.join(frequent, ["_h1", "_h2"]).where(F.col("_doc") != F.col("_keeper"))
             .select("_doc", F.inline("_at"))
             .groupBy("_doc", "_tag").agg(F.array_sort(F.collect_set("_pos")).alias("_at")))
    return drops.select(F.col("_doc").alias(id_col), F.col("_tag").alias("tag"),
                        _runs(F.col("_at")).alias("dropped"))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text", names=NAMES) -> DataFrame:
    """``docs`` with three columns more, ``names``: lines, dropped lines and the text that
    stays. They may be any that ``docs`` has not; its own columns are left as they are."""
    lines = lines_of(F.col(text_col))
    b_id, b_tag, dropped = (fresh([*docs.columns, *names], c) for c in ("_b_id", "_b_tag", "_dropped"))
    b = bitmaps.select(F.col(id_col).alias(b_id), F.col("tag").alias(b_tag),
                       F.col("dropped").alias(dropped))
    joined = docs.join(b, (F.col(id_col) == F.col(b_id))
                       & (F.xxhash64(text_col) == F.col(b_tag)), "left").drop(b_id, b_tag)
    n_lines = F.size(lines).cast("long")
    # kept stretches lie between the dropped runs; slices keep this linear
    bounds = F.concat(F.col(dropped), F.array(F.struct(F.size(lines).alias("first"),
                                                       F.lit(0).alias("len"))))
    before = F.concat(F.array(F.lit(0)), F.transform(dropped, lambda r: r["first"] + r["len"]))
    gaps = F.zip_with(before, bounds, lambda s, r: F.struct(s.alias("s"),
                                                            (r["first"] - s).alias("n")))
    staged = joined.withColumn(names[0], n_lines).withColumn(
        names[1], F.coalesce(F.aggregate(dropped, F.lit(0).cast("long"),
                                         lambda a, r: a + r["len"]), F.lit(0).cast("long")))
    # text between two line numbers: cut the array once per gap
    return staged.withColumn(names[2], F.when(
        F.col(dropped).isNull(), F.coalesce(F.col(text_col), F.lit(""))).otherwise(
        F.array_join(F.flatten(F.zip_with(
            F.array_repeat(lines, 1), F.array(gaps), lambda ls, gs: F.flatten(F.transform(
                F.filter(gs, lambda g: g["n"] > 0),
                lambda g: F.slice(ls, g["s"] + 1, g["n"]))))), "\n"))).drop(dropped)


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                min_chars: int = 20, min_docs: int = 3, names=NAMES) -> DataFrame:
    """``docs`` plus ``_n_lines``, ``_n_dropped`` and ``_kept``, or other ``names``."""
    narrow = docs.select(id_col, text_col)
    return apply_bitmaps(docs, keep_bitmaps(narrow, id_col, text_col, min_chars, min_docs),
                         id_col, text_col, names)
