"""Helpers shared by the training-data operators.

Column convention: every operator names its id and text columns by parameter,
projects just those, and prefixes the columns it adds on the way with ``_``, so
extra columns of the input (``n_words``, ``score``, ...) never clash.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import shared_path

#: White space of the word and line contracts: space and \t \n \v \f \r.
SPACE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def importable(spark: SparkSession) -> None:
    """Let the session's Python workers import this package from where the driver found
    it, also when they start in another folder."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once below the shared checkpoint folder and read back: the
    plan is cut, and a lost executor costs no recomputation of what is done."""
    path = shared_path(df.sparkSession, "llm", name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(taken: list[str], name: str) -> str:
    """``name``, with underscores before it until no column of ``taken`` has it (in any case)."""
    used = {c.lower() for c in taken}
    while name.lower() in used:
        name = "_" + name
    return name


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def part_labels(spark: SparkSession, parts: int) -> list[int]:
    """For each of ``parts`` shuffle partitions a number that Spark's hash sends there, so
    that groups and partitions match one to one."""
    got: dict[int, int] = {}
    at = 0
    while len(got) < parts:
        step = 16 * parts
        for r in (spark.range(at, at + step).select("id", F.pmod(F.hash("id"), F.lit(parts))
                                                    .alias("p"))
                  .groupBy("p").agg(F.min("id").alias("id")).collect()):
            got.setdefault(r["p"], r["id"])
        at += step
    return [got[p] for p in range(parts)]


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only; the plain ``lower`` serves pure ASCII text."""
    return (F.when(F.octet_length(c) == F.char_length(c), F.lower(c))
            .otherwise(F.translate(c, UPPER, LOWER)))


def fold_of(doc_id: Column, folds: int) -> Column:
    """crc32 of the id written as decimal text, modulo ``folds``."""
    return F.crc32(doc_id.cast("string")) % F.lit(folds)


# --- numpy helpers that run inside tasks -------------------------------------------

MASK = (1 << 64) - 1


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64 on uint64 arrays (fixed constants of that method)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class HashCache(dict):
    """word -> 64-bit hash, forgotten as a whole beyond ``limit`` entries."""

    limit = 500_000

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= self.limit:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def words_of(text: str | None) -> list[bytes]:
    """A-Z lowered UTF-8 words; ``bytes.split`` splits on exactly SPACE."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def shingles(word_hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of every ``width``-word window in text order; a shorter, non-empty
    sequence is one shingle of its own; no words, no shingles."""
    return window_hashes(word_hashes, min(width, len(word_hashes)))


#: Odd multipliers, one per place in a window (any distinct odd numbers do).
PLACES = np.random.default_rng(31).integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) \
    + np.uint64(1)


def window_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every window of ``k`` word hashes: a weighted sum, mixed once."""
    m = len(h) - k + 1
    if k == 0 or m <= 0:
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        acc = np.full(m, k, np.uint64)
        for i in range(k):
            acc += h[i:m + i] * PLACES[i]
        return mix64(acc)


def shingles_of(texts: list[str | None], width: int, cache: "HashCache") -> list[np.ndarray]:
    """:func:`shingles` of many texts, with the hashing done once for all of them."""
    parts = [words_of(t) for t in texts]
    sizes = [len(p) for p in parts]
    h = cache.of([w for p in parts for w in p])
    whole = window_hashes(h, width)
    out, at = [], 0
    for n in sizes:
        out.append(whole[at:at + n - width + 1] if n >= width
                   else window_hashes(h[at:at + n], n))
        at += n
    return out


def pieces(batch: pa.RecordBatch, most_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """A batch in slices of about ``most_bytes``, so very long texts do not pile up."""
    n = batch.num_rows
    step = max(1, int(n * most_bytes / max(1, batch.nbytes)))
    for at in range(0, n, step):
        yield batch.slice(at, step)


def crc_fold(doc_id: int, folds: int) -> int:
    return zlib.crc32(str(doc_id).encode()) % folds


# --- bounded training samples -------------------------------------------------------

def labelled_rows(docs: DataFrame, labels: DataFrame | None, label_col: str, *,
                  id_col: str, text_col: str, folds: int, held_fold: int,
                  per_class: int | dict, most_bytes: int) -> tuple[DataFrame | None, dict]:
    """At most ``per_class`` rows per label value (a number, or one for each value), the ones
    with the smallest id hash, outside ``held_fold``; together at most ``most_bytes`` of text.
    A written table (_y, _at, _text), ``_at`` counting from 1 in each value; None without
    labels. Also the count of labelled rows per value over all of them.

    Each value has an equal part of ``most_bytes`` (its room, in characters). Texts longer
    than a sixteenth of the room come after all others, shortest first, so a long text
    never takes the place of shorter rows; a value none of whose texts fits is taught by
    the shortest of them alone, whole.

    ``labels`` None reads the label from ``docs`` itself. The counts are taken on
    all rows; they turn the bound into a hash threshold per value, so no class is
    ever gathered whole, and one scan of the texts serves all values. Only values that it
    leaves short are looked for again.
    """
    src = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"),
                      *([F.col(label_col).alias("_y")] if labels is None else []))
    src = src.where(F.col("_id").isNotNull() & (fold_of(F.col("_id"), folds) != held_fold))
    if labels is None:
        src = src.where(F.col("_y").isNotNull())
        keyed = src
    else:
        keyed = (labels.select(F.col(id_col).alias("_id"), F.col(label_col).alias("_y"))
                 .where(F.col("_y").isNotNull() & (fold_of(F.col("_id"), folds) != held_fold))
                 .distinct())
    count = {r["_y"]: r["n"] for r in keyed.groupBy("_y").agg(F.count("*").alias("n")).collect()}
    if not count:
        return None, {}
    unit = F.pmod(F.xxhash64(F.lit(11), "_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    most = {y: per_class[y] if isinstance(per_class, dict) else per_class for y in count}
    room = most_bytes // len(count)
    size = F.char_length("_text")
    late = F.when(size > room // 16, size).otherwise(0)

    def per_value(values: dict) -> Column:
        return F.element_at(F.create_map(*[F.lit(x) for kv in values.items() for x in kv]),
                            F.col("_y"))

    def rows(share: dict) -> DataFrame:
        mine = keyed.where(F.col("_y").isin(list(share)) & (unit < per_value(share)))
        if labels is not None:
            if all(share[y] * count[y] <= 1.25 * most[y] for y in share):
                # some 1.2 times the stated bounds, whatever the tables' size: texts stay put
                mine = F.broadcast(stored(mine, "sample_ids"))
            mine = mine.join(src, "_id")
        return mine.withColumn("_text", F.coalesce("_text", F.lit("")))

    def chosen(share: dict) -> DataFrame:
        best = Window.partitionBy("_y").orderBy("_late", "_unit", "_id")
        ranked = (rows(share).where(size <= room)
                  .select("_id", "_y", "_text", late.alias("_late"), unit.alias("_unit"))
                  .withColumn("_at", F.row_number().over(best)))
        bounds = F.lit(False)
        for y in share:  # a plain bound on the rank lets tasks drop rows before the shuffle
            bounds = bounds | ((F.col("_y") == F.lit(y)) & (F.col("_at") <= most[y]))
        return stored(ranked.where((F.col("_at") <= max(most.values())) & bounds)
                      .withColumn("_sum", F.sum(size).over(best.rowsBetween(
                          Window.unboundedPreceding, 0)))
                      .where(F.col("_sum") <= room).select("_y", "_at", "_text"), "sample")

    def found(df: DataFrame) -> dict:
        return {r["_y"]: r for r in df.groupBy("_y").agg(
            F.count("*").alias("n"), F.sum(size).alias("chars"),
            F.max(F.col("_text").rlike(r"\S")).alias("some")).collect()}

    share = {y: min(1.0, 1.2 * most[y] / count[y]) for y in count}
    out = chosen(share)
    have = found(out)
    n, chars = (lambda y: have[y]["n"] if y in have else 0), (lambda y: have[y]["chars"] if y in have else 0)
    again = {y: 1.0 for y in count if share[y] < 1 and n(y) < most[y] and 2 * chars(y) < room}
    if again:  # rows set aside for their length left both bounds open
        more = chosen(again)
        out = out.where(~F.col("_y").isin(list(again))).unionByName(more)
        have = {**{y: h for y, h in have.items() if y not in again}, **found(more)}
    blank = {y: 1.0 for y in count if not (y in have and have[y]["some"])}
    if blank:
        shortest = Window.partitionBy("_y").orderBy(size, unit, "_id")
        more = (rows(blank).where(F.col("_text").rlike(r"\S"))
                .withColumn("_first", F.row_number().over(shortest)).where(F.col("_first") == 1)
                .select("_y", F.lit(max(most.values()) + 1).alias("_at"), "_text"))
        out = out.unionByName(stored(more, "sample"))
    return out, count


def labelled_sample(docs: DataFrame, labels: DataFrame | None, label_col: str, **bounds
                    ) -> tuple[list[tuple], dict]:
    """The (label, text) pairs of :func:`labelled_rows` on the driver, in order."""
    rows, count = labelled_rows(docs, labels, label_col, **bounds)
    if rows is None:
        return [], count
    return [(r["_y"], r["_text"]) for r in rows.orderBy("_y", "_at").collect()], count


# --- fixed-size filter over 64-bit hashes -------------------------------------------

FILTER_BITS = 23  # 2**23 bits are 1 MB, whatever the data's size


def hash_filter(hashes: DataFrame, col: str) -> np.ndarray:
    """Packed bit table of all values of a long column; 1 MB at any size of input, so
    it may be broadcast. A set bit says "perhaps": whoever uses it checks exactly later.
    Only the at most 2**(FILTER_BITS-6) words of the table reach the driver."""
    bit = F.col(col).bitwiseAND(F.lit((1 << FILTER_BITS) - 1))
    words = (hashes.select(F.shiftright(bit, 6).alias("w"),
                           F.expr(f"shiftleft(1L, cast({col} & 63 as int))").alias("m"))
             .groupBy("w").agg(F.bit_or("m").alias("m")))
    table = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    got = words.toPandas()
    table[got["w"].to_numpy(np.int64)] = got["m"].to_numpy(np.int64)
    return table.view(np.uint64)


def maybe_in(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Mask of the uint64 ``keys`` whose bit is set."""
    bit = keys & np.uint64((1 << FILTER_BITS) - 1)
    word = table[(bit >> np.uint64(6)).astype(np.int64)]
    return (word >> (bit & np.uint64(63))) & np.uint64(1) == 1
