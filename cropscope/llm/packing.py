"""Packing (operator 1): harmonic packing of token sequences.

Lengths fall into reciprocal-capacity classes: class k holds lengths in
(C/(k+1), C/k], and a bin of class k takes exactly k pieces, whatever else is in the
corpus. Because documents may be cut, each is cut into as few pieces as possible that
lie at the top of their class (length C//k), so k of them fill a bin to within k
tokens. Every worker fills its own bins; what its last bins leave open is numbered
across workers by prefix sums over (worker, class) counts and filled the same way.
The one open bin per class that then remains (a fixed number of bins) is placed
first-fit by decreasing length.

Defined cases: null and empty texts are their end token alone; rows that share an id
are packed as separate documents, a null id is kept; an empty table packs nothing; a very
long text is encoded whole and cut into as many pieces as it needs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import shared_path
from .common import importable, pieces
from .tokens import encode, vocabulary_paths

_SCHEMA = ("_id long, _start long, _length long, _doc_tokens long, _tokens binary, "
           "_class int, _part long, _slot long, _sequence long, _full boolean")


@lru_cache(maxsize=4)
def cuts(capacity: int) -> list[list[int]]:
    """For each length below ``capacity`` the class-top lengths to cut it into: fewest
    pieces first, then the longest shortest piece; longest piece first in the text."""
    tops = sorted({capacity // k for k in range(2, capacity + 1)}, reverse=True)
    best: list[list[int]] = [[]]
    for r in range(1, capacity):
        best.append(min(([s] + best[r - s] for s in tops if s <= r),
                        key=lambda c: (len(c), -min(c))))
    return [sorted(c, reverse=True) for c in best]


def cut(n: int, capacity: int) -> list[int]:
    return [capacity] * (n // capacity) + cuts(capacity)[n % capacity]


def _fill(batches: Iterator[pa.RecordBatch], capacity: int, end_id: int,
          paths: tuple[str, str]) -> Iterator[pa.RecordBatch]:
    """Cut and fill bins; an open bin per class is all that is held between batches."""
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    open_bins: dict[int, list[tuple]] = {}
    bins = 0
    fields = pa.schema([("_id", pa.int64()), ("_start", pa.int64()), ("_length", pa.int64()),
                        ("_doc_tokens", pa.int64()), ("_tokens", pa.binary()),
                        ("_class", pa.int32()), ("_part", pa.int64()), ("_slot", pa.int64()),
                        ("_sequence", pa.int64()), ("_full", pa.bool_())])

    def emit(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(zip(*rows), fields)], schema=fields)

    for whole in batches:
        for b in pieces(whole, 2 << 20):
            out: list[tuple] = []
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                ids = np.append(encode(text, paths), np.uint32(end_id)).astype("<u4")
                at = 0
                for n in cut(len(ids), capacity):
                    k = capacity // n
                    slots = open_bins.setdefault(k, [])
                    slots.append((doc, at, n, len(ids), ids[at:at + n].tobytes(), k, part))
                    at += n
                    if len(slots) == k:
                        out += [(*r, i, (part << 32) | bins, True) for i, r in enumerate(slots)]
                        bins += 1
                        slots.clear()
            if out:
                yield emit(out)
    rest = [(*r, i, None, False) for k in sorted(open_bins) for i, r in enumerate(open_bins[k])]
    if rest:
        yield emit(rest)


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         capacity: int = 2048, end_id: int = 1,
         paths: tuple[str, str] | None = None) -> DataFrame:
    """One row per piece: ``_id, _start, _length, _doc_tokens, _tokens`` (little-endian
    uint32 ids), ``_sequence, _offset``. Sequences hold at most ``capacity`` tokens."""
    spark = docs.sparkSession
    importable(spark)
    paths = paths or vocabulary_paths()
    path = shared_path(spark, "llm", "packed")
    (docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
     .mapInArrow(lambda it: _fill(it, capacity, end_id, paths), _SCHEMA)
     .write.option("compression", "zstd").partitionBy("_full").parquet(path))
    cut_up = spark.read.schema(_SCHEMA).parquet(path)
    full = cut_up.where("_full").withColumn(
        "_offset", F.col("_slot") * F.col("_length"))
    rest = cut_up.where(~F.col("_full"))
    counts = rest.groupBy("_class", "_part").agg(F.count("*").alias("_n"))
    before = counts.withColumn("_before", F.coalesce(F.sum("_n").over(
        Window.partitionBy("_class").orderBy("_part").rowsBetween(
            Window.unboundedPreceding, -1)), F.lit(0)))
    # at most one count per class length comes to the driver
    totals = {r["_class"]: r["n"] for r in
              counts.groupBy("_class").agg(F.sum("_n").alias("n")).collect()}
    last = place_last(totals, capacity)
    ranked = rest.join(before.select("_class", "_part", "_before"), ["_class", "_part"])
    rank = F.col("_before") + F.col("_slot")
    first = (1 << 62)
    numbered = ranked.withColumn("_bin", F.floor(rank / F.col("_class")).cast("long")).withColumn(
        "_sequence", F.lit(first) + F.shiftleft(F.col("_class").cast("long"), 44) + F.col("_bin")
    ).withColumn("_offset", F.pmod(rank, F.col("_class")) * F.col("_length"))
    if last:
        plan = F.create_map(*[x for k, (bin_, seq, off) in last.items() for x in (
            F.lit(k), F.struct(F.lit(bin_).cast("long").alias("bin"),
                               F.lit(seq).cast("long").alias("seq"),
                               F.lit(off).cast("long").alias("off")))])
        moved = F.element_at(plan, F.col("_class"))
        numbered = numbered.withColumn("_to", F.when(
            moved["bin"] == F.col("_bin"), moved)).withColumn(
            "_sequence", F.coalesce(F.lit(first) + F.col("_to")["seq"], F.col("_sequence"))
        ).withColumn("_offset", F.col("_offset") + F.coalesce(F.col("_to")["off"], F.lit(0)))
    cols = ["_id", "_start", "_length", "_doc_tokens", "_tokens", "_sequence", "_offset"]
    return full.select(*cols).unionByName(numbered.select(*cols))


def place_last(totals: dict[int, int], capacity: int) -> dict[int, tuple[int, int, int]]:
    """class -> (its open bin, new sequence, offset there) for the classes whose last bin
    is not full; first fit by decreasing length over these few blocks."""
    blocks = sorted(((n % k) * (capacity // k), k, n // k) for k, n in totals.items() if n % k)
    rooms: list[int] = []
    out = {}
    for size, k, bin_ in reversed(blocks):
        at = next((i for i, used in enumerate(rooms) if used + size <= capacity), len(rooms))
        if at == len(rooms):
            rooms.append(0)
        out[k] = (bin_, at, rooms[at])
        rooms[at] += size
    return out
