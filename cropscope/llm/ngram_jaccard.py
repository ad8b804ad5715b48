"""N-gram Jaccard join (operator 2): prefix-filter join with set-relation skipping.

A document is the set of its distinct word shingles; two documents link when
100 * |intersection| >= percent * |union|. Equal sets are one class from the start.
Sets are ordered rarest shingle first (by counts over all documents, in a table of fixed
size), and only a prefix of each is indexed.

*Answers from similar sets.* In every index list the set with the smallest position is
the leader; a set is first verified against the leader most of its lists name. Whatever
a linked set would find in a list whose sets all carry one label is already known from
the leader, so such lists are skipped whole.

*Skipping inside lists.* Lists with several labels are cut into blocks by size class and
position. Two sets whose first common shingle stands at positions p and q differ in at
least p + q shingles, so a set joins only the blocks that leave enough overlap. A pair
that remains is dropped only on proof: the parity sketches of two sets (about one bit
per shingle) differ in no more bits than the sets differ in shingles. What survives is
verified exactly, first one pair for each two labels, then all pairs whose labels are
still apart; no cap is set anywhere.

Defined cases: null, empty and blank texts have an empty set and link with nothing; a
shorter text is one shingle; rows that share an id are linked if their sets are (the
result has one row per input row); null ids form no component id of their own unless
alone (``component_id`` is then null); an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import (
    HashCache,
    hash_filter,
    importable,
    maybe_in,
    mix64,
    pieces,
    shingles_of,
    shuffle_partitions,
    stored,
)
from .components import components

COUNT_BITS, CHUNK = 20, 1 << 12


def shingle_sets(texts: list[str | None], width: int, cache: HashCache) -> list[np.ndarray]:
    """The set of each text, ascending."""
    return [np.unique(h) for h in shingles_of(texts, width, cache)]


def parity_sketch(h: np.ndarray) -> bytes:
    """Bit k: whether an odd number of shingles falls to k; a power of two of bits, one to
    two per shingle."""
    bits = 1 << max(6, int(len(h) - 1).bit_length())
    odd = np.bincount((h >> np.uint64(24)).astype(np.int64) & (bits - 1), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def short_sketch(h: np.ndarray) -> list[int]:
    """A parity sketch of 256 bits as four signed 64-bit numbers."""
    odd = np.bincount((h >> np.uint64(24)).astype(np.int64) & 255, minlength=256) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64).tolist()


def sketch_difference(x: bytes, y: bytes) -> int:
    """At most the number of shingles the two sets differ in. Sketches of different length
    are compared at the shorter one's, to which the longer folds."""
    u, v = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
    if len(u) > len(v):
        u, v = v, u
    if len(v) > len(u):
        v = np.bitwise_xor.reduce(v.reshape(-1, len(u)), axis=0)
    return int(np.bitwise_count(u ^ v).sum())


def fingerprint(h: np.ndarray) -> int:
    """64-bit id of a set, of its shingles and their number."""
    with np.errstate(over="ignore"):
        a = mix64(h).sum(dtype=np.uint64) + np.uint64(len(h))
        b = np.bitwise_xor.reduce(mix64(h + np.uint64(0x632BE59BD9B4E019)))
        return int(mix64(np.array([a ^ (b * np.uint64(0x9E3779B97F4A7C15))]))[0])


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def can_have_partner(n: int, percent: int) -> bool:
    """Whether a different set can link with one of size ``n``: one shingle more, or less."""
    return 100 * n >= percent * (n + 1) or 100 * (n - 1) >= percent * n


def _sets_and_counts(docs: DataFrame, width: int) -> DataFrame:
    """One row (kind 0) per document with size, set id and sketch, and (kind 1) per task
    and chunk of the fixed table of shingle counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, total = HashCache(), np.zeros(1 << COUNT_BITS, np.int64)
        names = ["_kind", "_id", "_n", "_set", "_chunk", "_data", "_short"]
        for whole in batches:
            for b in pieces(whole):
                sets = shingle_sets(b.column(1).to_pylist(), width, cache)
                if any(map(len, sets)):
                    total += np.bincount(
                        (np.concatenate(sets) & np.uint64((1 << COUNT_BITS) - 1)).astype(np.int64),
                        minlength=1 << COUNT_BITS)
                m = len(sets)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.zeros(m, np.int32)), b.column(0).cast(pa.int64()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(np.array([fingerprint(s) if len(s) else 0 for s in sets], np.uint64)
                             .view(np.int64)),
                    pa.nulls(m, pa.int32()),
                    pa.array([parity_sketch(s) if len(s) else None for s in sets],
                             pa.binary()),
                    pa.array([short_sketch(s) if len(s) else None for s in sets],
                             pa.list_(pa.int64()))], names)
        chunks = total.reshape(-1, CHUNK)
        m = len(chunks)
        yield pa.RecordBatch.from_arrays([
            pa.array(np.ones(m, np.int32)), pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64()),
            pa.nulls(m, pa.int64()), pa.array(np.arange(m), pa.int32()),
            pa.array([c.tobytes() for c in chunks], pa.binary()),
            pa.nulls(m, pa.list_(pa.int64()))], names)

    return docs.mapInArrow(run, "_kind int, _id long, _n long, _set long, _chunk int, "
                                "_data binary, _short array<bigint>")


def _count_table(rows: DataFrame) -> np.ndarray:
    """Sum of the tasks' count chunks; a fixed 2**COUNT_BITS numbers in all."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for chunk, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                c = np.frombuffer(raw, np.int64)
                sums[chunk] = sums[chunk] + c if chunk in sums else c
        if sums:
            yield pa.RecordBatch.from_arrays([
                pa.array(list(sums), pa.int32()),
                pa.array([np.minimum(c, 2 ** 31 - 1).astype("<i4").tobytes()
                          for c in sums.values()], pa.binary())], ["_chunk", "_counts"])

    parts = min((1 << COUNT_BITS) // CHUNK, shuffle_partitions(rows.sparkSession))
    summed = (rows.where("_kind = 1").select("_chunk", "_data").repartition(parts, "_chunk")
              .mapInArrow(add, "_chunk int, _counts binary"))
    table = np.zeros(((1 << COUNT_BITS) // CHUNK, CHUNK), np.int32)
    for r in summed.collect():
        table[r["_chunk"]] = np.frombuffer(r["_counts"], "<i4")
    return table.reshape(-1)


def _postings(docs: DataFrame, width: int, percent: int, counts) -> DataFrame:
    """(token, set, n, pos) of every set's prefix, once per set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, mask = HashCache(), np.uint64((1 << COUNT_BITS) - 1)
        for whole in batches:
            for b in pieces(whole):
                tok, sid, size, pos, seen = [], [], [], [], set()
                for h in shingle_sets(b.column(1).to_pylist(), width, cache):
                    n = len(h)
                    if n == 0 or not can_have_partner(n, percent):
                        continue
                    f = fingerprint(h)
                    if f in seen:
                        continue
                    seen.add(f)
                    p = prefix_length(n, percent)
                    # h ascends, so a stable sort breaks ties of the counts by hash
                    order = np.argsort(counts.value[(h & mask).astype(np.int64)],
                                       kind="stable")[:p]
                    tok.append(h[order])
                    sid.append(np.full(p, f, np.uint64))
                    size.append(np.full(p, n))
                    pos.append(np.arange(p))
                if tok:
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.concatenate(tok).view(np.int64)),
                        pa.array(np.concatenate(sid).view(np.int64)),
                        pa.array(np.concatenate(size), pa.int32()),
                        pa.array(np.concatenate(pos), pa.int32())],
                        ["_token", "_set", "_n", "_pos"])

    return (docs.mapInArrow(run, "_token long, _set long, _n int, _pos int")
            .groupBy("_token", "_set").agg(F.first("_n").alias("_n"), F.first("_pos").alias("_pos")))


def _least_overlap(nx: Column, ny: Column, percent: int) -> Column:
    return F.ceil(F.lit(percent) * (nx + ny) / F.lit(100 + percent))


def _may_link(nx: Column, px: Column, ny: Column, py: Column, percent: int) -> Column:
    return ((F.least(nx, ny) * 100 >= F.greatest(nx, ny) * percent)
            & (px + py <= nx + ny - 2 * _least_overlap(nx, ny, percent)))


def _near(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """The ``pairs`` (a, b, ...) that their sketches do not rule out, with ``_gap``."""
    extra = [c for c in pairs.columns if c not in ("a", "b")]
    kinds = dict(pairs.dtypes)

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in pieces(whole):
                n = b.num_columns - 4
                gap, at = [], []
                rows = zip(*[b.column(n + k).to_pylist() for k in range(4)])
                for k, (x, nx, y, ny) in enumerate(rows):
                    g = sketch_difference(x, y)
                    if g <= nx + ny - 2 * -(-percent * (nx + ny) // (100 + percent)):
                        gap.append(g)
                        at.append(k)
                take = pa.array(at, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [*[b.column(k).take(take) for k in range(n)], pa.array(gap, pa.int64())],
                    ["a", "b", *extra, "_gap"])

    side = lambda of, x, n: sketches.select(F.col("_set").alias(of), F.col("_odd").alias(x),
                                            F.col("_n").alias(n))
    return (pairs.join(side("a", "_x", "_nx"), "a").join(side("b", "_y", "_ny"), "b")
            .select("a", "b", *extra, "_x", "_nx", "_y", "_ny")
            .mapInArrow(check, ", ".join(f"{c} {kinds[c]}" for c in ("a", "b", *extra))
                        + ", _gap long"))


def _verified(pairs: DataFrame, docs: DataFrame, holder: DataFrame, width: int,
              percent: int) -> DataFrame:
    """The pairs (a, b) of set ids that link, by exact intersection. Set contents are
    made again from a document of each set that occurs in a pair; ids (null ones too) only
    narrow the documents down, a set is told by its own id."""
    spark = docs.sparkSession
    pairs = stored(pairs, "pairs")
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("_set")).distinct()
    ids = stored(holder.join(wanted, "_set").select("_id", "_set"), "wanted")
    bits = spark.sparkContext.broadcast(
        (hash_filter(ids.select(F.xxhash64("_id").alias("_h")), "_h"), hash_filter(ids, "_set")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, sent = HashCache(), set()
        of_id, of_set = bits.value
        for whole in batches:
            for b in pieces(whole):
                at = np.nonzero(maybe_in(of_id, b.column(2).to_numpy()
                                         .astype(np.int64).view(np.uint64)))[0]
                if len(at):
                    part = b.take(pa.array(at))
                    made = {fingerprint(x): x for x in shingle_sets(
                        part.column(1).to_pylist(), width, cache) if len(x)}
                    key = np.array([k for k in made if k not in sent], np.uint64)
                    key = key[maybe_in(of_set, key)]
                    sent.update(key.tolist())
                    yield pa.RecordBatch.from_arrays([
                        pa.array(key.view(np.int64)),
                        pa.array([made[k].tobytes() for k in key.tolist()], pa.binary())],
                        ["_set", "_items"])

    made = (docs.select("_id", "_t", F.xxhash64("_id").alias("_h"))
            .mapInArrow(run, "_set long, _items binary"))
    sets = stored(made.join(wanted, "_set").dropDuplicates(["_set"]), "sets")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in pieces(whole):
                ok = []
                for x, y in zip(b.column(2), b.column(3)):
                    u = np.frombuffer(x.as_buffer(), np.uint64)
                    v = np.frombuffer(y.as_buffer(), np.uint64)
                    both = len(u) + len(v) - len(np.union1d(u, v))
                    ok.append(100 * both >= percent * (len(u) + len(v) - both))
                at = pa.array(np.nonzero(ok)[0])
                yield pa.RecordBatch.from_arrays([b.column(0).take(at), b.column(1).take(at)],
                                                 ["a", "b"])

    return stored(
        pairs.join(sets.select(F.col("_set").alias("a"), F.col("_items").alias("_x")), "a")
        .join(sets.select(F.col("_set").alias("b"), F.col("_items").alias("_y")), "b")
        .select("a", "b", "_x", "_y").mapInArrow(check, "a long, b long"), "links")


def _star_pairs(posts: DataFrame, percent: int) -> DataFrame:
    """Each set with the leader that most of its lists name."""
    leaders = stored(posts.groupBy("_token").agg(
        F.min(F.struct("_pos", "_set", "_n")).alias("_l"), F.count("*").alias("_c"))
        .where("_c > 1").select("_token", F.col("_l._set").alias("_ls"),
                                F.col("_l._n").alias("_ln"), F.col("_l._pos").alias("_lp")),
        "leaders")
    named = (posts.join(leaders, "_token")
             .where((F.col("_set") != F.col("_ls"))
                    & _may_link(F.col("_n"), F.col("_pos"), F.col("_ln"), F.col("_lp"), percent))
             .groupBy("_set", "_ls").agg(F.count("*").alias("_c")))
    return (named.groupBy("_set").agg(F.max(F.struct("_c", "_ls")).alias("_m"))
            .select(F.col("_m._ls").alias("a"), F.col("_set").alias("b")))


def _cross_pairs(posts: DataFrame, labels: DataFrame, sketches: DataFrame,
                 percent: int) -> DataFrame:
    """Pairs (a, b, la, lb) of different labels that some index list and the 256-bit
    sketches leave possible; the join itself applies both bounds."""
    tagged = stored(posts.join(labels, "_set", "left")
                    .withColumn("_label", F.coalesce("_label", "_set")), "tagged")
    open_lists = stored(tagged.groupBy("_token").agg(
        F.min("_label").alias("_lo"), F.max("_label").alias("_hi"))
        .where("_lo <> _hi").select("_token"), "open_lists")
    bits = [F.get("_short", F.lit(i)).alias(f"_s{i}") for i in range(4)]
    rest = stored(tagged.join(open_lists, "_token").join(
        sketches.select("_set", *bits), "_set"), "open_postings")
    sketch = [f"_s{i}" for i in range(4)]
    # size classes are one similarity step wide, so a partner's is the same or the next
    step = float(np.log(100 / percent))
    cls = F.floor(F.log(F.col("_n").cast("double")) / step + 1e-9).cast("int")
    # positions differ by at most the spread of the class's largest set; four blocks to it
    most = F.ceil(F.exp((F.col("_k") + 1) * step) * 2 * (100 - percent) / (100 + percent)) + 1
    width = F.ceil(most / 4)
    index = rest.select("_token", cls.alias("_k"), "_set", "_n", "_pos", "_label", *sketch).select(
        "*", F.floor(F.col("_pos") / width).cast("int").alias("_block"))
    probe = (rest.select("_token", "_set", "_n", "_pos", "_label", *sketch,
                         F.explode(F.array(cls, cls + 1)).alias("_k"))
             .where(F.col("_pos") <= most)
             .select("*", F.explode(F.sequence(F.lit(0), F.floor(
                 (most - F.col("_pos")) / width).cast("int"))).alias("_block")))
    x = probe.select("_token", "_k", "_block", F.col("_set").alias("a"), F.col("_n").alias("na"),
                     F.col("_pos").alias("pa"), F.col("_label").alias("la"),
                     *[F.col(c).alias(f"x{c}") for c in sketch])
    y = index.select("_token", "_k", "_block", F.col("_set").alias("b"), F.col("_n").alias("nb"),
                     F.col("_pos").alias("pb"), F.col("_label").alias("lb"),
                     *[F.col(c).alias(f"y{c}") for c in sketch])
    gap = sum((F.bit_count(F.col(f"x{c}").bitwiseXOR(F.col(f"y{c}"))) for c in sketch), F.lit(0))
    na, nb = F.col("na"), F.col("nb")
    smaller = (F.col("na") < F.col("nb")) | ((F.col("na") == F.col("nb"))
                                             & (F.col("a") < F.col("b")))
    return (x.join(y, ["_token", "_k", "_block"])
            .where((F.col("la") != F.col("lb")) & smaller
                   & _may_link(na, F.col("pa"), nb, F.col("pb"), percent)
                   & (gap <= na + nb - 2 * _least_overlap(na, nb, percent)))
            .select("a", "b", "la", "lb").distinct())


def _labels(links: DataFrame) -> DataFrame:
    found = components(links)
    return found.select(F.col("node").alias("_set"), F.col("label").alias("_label"))


def linked_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     width: int = 3, percent: int = 90) -> DataFrame:
    """(_id, _n, _set, _component) per document: set size, class of equal sets and the
    smallest id reachable by links."""
    importable(docs.sparkSession)
    src = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_t"))
    rows = stored(_sets_and_counts(src, width), "sets_and_counts")
    own = rows.where("_kind = 0").select("_id", "_n", "_set")
    sketches = stored(rows.where("_kind = 0 and _n > 0").groupBy("_set").agg(
        F.min("_id").alias("_id"), F.max("_n").alias("_n"), F.max("_data").alias("_odd"),
        F.max("_short").alias("_short")),
        "sketches")
    holder = sketches.select("_set", "_id")
    counts = src.sparkSession.sparkContext.broadcast(_count_table(rows))
    posts = stored(_postings(src, width, percent, counts), "postings")
    shared = stored(posts.groupBy("_token").agg(F.count("*").alias("_c")).where("_c > 1")
                    .select("_token"), "shared_tokens")
    posts = stored(posts.join(shared, "_token"), "shared_postings")

    def verified(pairs: DataFrame) -> DataFrame:
        return _verified(pairs, src, holder, width, percent)

    star = verified(_near(_star_pairs(posts, percent), sketches, percent).select("a", "b"))
    cross = stored(_near(_cross_pairs(posts, _labels(star), sketches, percent), sketches,
                         percent), "cross")
    # one pair for each two labels, then whatever is still apart
    first = verified(cross.groupBy("la", "lb").agg(F.min(F.struct("_gap", "a", "b")).alias("_m"))
                     .select("_m.a", "_m.b"))
    links = star.unionByName(first)
    label = _labels(links)
    at = lambda c: label.select(F.col("_set").alias(c), F.col("_label").alias(f"_{c}"))
    apart = stored(cross.select("a", "b").join(at("a"), "a", "left").join(at("b"), "b", "left")
                   .where(~F.coalesce("_a", "a").eqNullSafe(F.coalesce("_b", "b")))
                   .select("a", "b"), "apart")
    if not apart.isEmpty():
        more = verified(apart)
        if not more.isEmpty():
            label = _labels(links.unionByName(more))
    label = label.select(F.col("_set").alias("node"), F.col("_label").alias("label"))
    named = label.join(holder, label["node"] == holder["_set"]).select("_set", "label", "_id")
    named = stored(named, "named")
    smallest = stored(named.groupBy("label").agg(F.min("_id").alias("_least")), "smallest")
    of_set = stored(named.join(smallest, "label").select("_set", "_least"), "set_components")
    whole = stored(holder.join(of_set, "_set", "left")
                   .select("_set", F.coalesce("_least", "_id").alias("_component")), "components")
    filled = (own.where("_n > 0").join(whole, "_set")
              .select("_id", "_n", "_set", "_component"))
    empty = own.where("_n = 0").select("_id", "_n", F.lit(None).cast("long").alias("_set"),
                                       F.col("_id").alias("_component"))
    return filled.unionByName(empty)
