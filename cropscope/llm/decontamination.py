"""Benchmark decontamination (operator 3): size-partitioned MinHash containment search.

Items are partitioned by the size of their shingle set (classes [2^(c-1), 2^c)), and an
item's sketch is the minimum of its shingles under each of ``PERMS`` permutations. A
long document hides a short item's minima among its own, so for each size class the
document is cut into blocks of half the class's smallest size and every block's minima
are looked up: an item shingle that is a minimum of the item is also its block's minimum
unless one of few unrelated neighbours is smaller. One of 16 minima has to match, so
an item present to 80 % is missed with a chance far below one in a million when its
passage is contiguous. Candidates are verified by exact shingle containment.

Sketch values and item shingles also make two 1 MB bit tables; a task drops what
misses them before the shuffle. If the benchmark outgrows the tables they only let more
rows through.

Shingles are ``width`` words, A-Z lower-cased. Defined cases: an item or document of
fewer words is one shingle, its whole sequence, so a short item is found only as such a
whole text; null and empty texts have none and never match; rows sharing a document id
are searched as one document; rows sharing an item id are separate items reported by
their best match; null ids are left out; equal items all match; an empty table on either
side gives no row; a very long text is cut into blocks and searched whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (
    HashCache,
    hash_filter,
    importable,
    maybe_in,
    mix64,
    pieces,
    shingles,
    shingles_of,
    stored,
    words_of,
)

PERMS = 16
_RNG = np.random.default_rng(20)
_MULT = _RNG.integers(1, 1 << 63, PERMS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SALT = _RNG.integers(1, 1 << 63, PERMS, dtype=np.uint64)


def size_class(n: int) -> int:
    return int(n).bit_length()


def permuted(h: np.ndarray, i: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (h ^ _SALT[i]) * _MULT[i]


def sketch_key(minima: np.ndarray, cls: int, i: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix64(minima + np.uint64((cls * PERMS + i + 1) * 0x9E3779B97F4A7C15 % (1 << 64)))


def item_keys(h: np.ndarray) -> np.ndarray:
    c = size_class(len(h))
    return np.concatenate([sketch_key(permuted(h, i).min(keepdims=True), c, i)
                           for i in range(PERMS)])


def document_keys(h: np.ndarray, classes: list[int], keep) -> np.ndarray:
    """Keys of all block minima that pass ``keep``; ``h`` in text order."""
    out = []
    for i in range(PERMS):
        p = permuted(h, i)
        for c in classes:
            block = max(1, (1 << (c - 1)) // 2)
            key = sketch_key(np.minimum.reduceat(p, np.arange(0, len(p), block)), c, i)
            key = key[keep(key)]
            if len(key):
                out.append(key)
    return np.unique(np.concatenate(out)) if out else np.empty(0, np.uint64)


def _item_rows(items: DataFrame, item_col: str, text_col: str, width: int) -> DataFrame:
    """(item, row, cls, n, kind, key): kind 0 sketch keys, kind 1 shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = HashCache()
        for b in batches:
            for item, row, text in zip(*[c.to_pylist() for c in b.columns]):
                h = np.unique(shingles(cache.of(words_of(text)), width))
                if len(h) == 0:
                    continue
                key = np.concatenate([item_keys(h), h]).view(np.int64)
                n = len(key)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(n, item), pa.int64()), pa.array(np.full(n, row), pa.int64()),
                    pa.array(np.full(n, size_class(len(h))), pa.int32()),
                    pa.array(np.full(n, len(h)), pa.int64()),
                    pa.array((np.arange(n) >= PERMS).astype(np.int32), pa.int32()),
                    pa.array(key, pa.int64())], ["_item", "_row", "_cls", "_n", "_kind", "_key"])

    src = (items.select(F.col(item_col).cast("long").alias("_item"), F.col(text_col).alias("_t"))
           .where("_item is not null and _t is not null").distinct()
           .select("_item", F.xxhash64("_item", "_t").alias("_row"), "_t"))
    return src.mapInArrow(run, "_item long, _row long, _cls int, _n long, _kind int, _key long")


def _document_rows(docs: DataFrame, id_col: str, text_col: str, width: int,
                   classes: list[int], sketches, grams) -> DataFrame:
    """(doc, kind, key) of block minima and shingles that pass the bit tables."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = HashCache()
        for whole in batches:
            for b in pieces(whole):
                ids, kinds, keys = [], [], []
                made = shingles_of(b.column(1).to_pylist(), width, cache)
                hit = maybe_in(grams.value, np.concatenate(made))
                at = 0
                for doc, h in zip(b.column(0).to_pylist(), made):
                    own = np.unique(h[hit[at:at + len(h)]])
                    at += len(h)
                    if len(own) == 0:  # no item shingle, so no item minimum either
                        continue
                    key = document_keys(h, classes, lambda k: maybe_in(sketches.value, k))
                    if len(key) == 0:
                        continue
                    keys += [key, own]
                    kinds += [np.zeros(len(key), np.int32), np.ones(len(own), np.int32)]
                    ids.append(np.full(len(key) + len(own), doc))
                if ids:
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.concatenate(ids), pa.int64()),
                        pa.array(np.concatenate(kinds), pa.int32()),
                        pa.array(np.concatenate(keys).view(np.int64), pa.int64())],
                        ["_doc", "_kind", "_key"])

    return (docs.select(F.col(id_col).cast("long").alias("_doc"), F.col(text_col).alias("_t"))
            .where("_doc is not null and _t is not null")
            .mapInArrow(run, "_doc long, _kind int, _key long"))


def contained_items(docs: DataFrame, items: DataFrame, id_col: str = "doc_id",
                    text_col: str = "text", item_col: str = "item_id",
                    item_text_col: str = "text", width: int = 5,
                    percent: int = 80) -> DataFrame:
    """(_doc, _item, _n, _shared, _containment) for every item of whose shingles at least
    ``percent`` % lie in the document."""
    spark = docs.sparkSession
    importable(spark)
    item_rows = stored(_item_rows(items, item_col, item_text_col, width), "items")
    classes = sorted(r["_cls"] for r in item_rows.select("_cls").distinct().collect())
    sketches = item_rows.where("_kind = 0").select("_row", "_key")
    grams = item_rows.where("_kind = 1").select("_item", "_row", "_n", "_key")
    rows = stored(_document_rows(
        docs, id_col, text_col, width, classes,
        spark.sparkContext.broadcast(hash_filter(sketches, "_key")),
        spark.sparkContext.broadcast(hash_filter(grams, "_key"))), "document_hits")
    candidates = (rows.where("_kind = 0").select("_doc", "_key").join(sketches, "_key")
                  .select("_doc", "_row").distinct())
    candidates = stored(candidates, "containment_candidates")
    hits = rows.where("_kind = 1").select("_doc", "_key").distinct()
    shared = (candidates.join(grams, "_row").join(hits, ["_doc", "_key"])
              .groupBy("_doc", "_item", "_row", "_n").agg(F.count("*").alias("_shared"))
              .where(F.col("_shared") * 100 >= F.col("_n") * percent))
    best = F.max(F.struct((F.col("_shared") / F.col("_n")).alias("_containment"),
                          F.col("_n"), F.col("_shared")))
    return (shared.groupBy("_doc", "_item").agg(best.alias("_b"))
            .select("_doc", "_item", "_b._n", "_b._shared", "_b._containment"))
