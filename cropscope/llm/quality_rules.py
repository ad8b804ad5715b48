"""Quality rules (operator 8): a learned decision list, native operations only.

Text statistics are column expressions. Sequential covering learns from every
labelled row: each grow step is one grouped count of (statistic, threshold bin,
label) over the rows not yet covered, so the driver sees a few hundred counts and
never a row; each rule is pruned on rows held apart. The ordered rules become one
Spark conditional expression.

Defined cases: null text has no words; with no labelled rows of both classes the
list is empty and only the base test speaks; rows whose label or id is null do not
teach; ties between literals go to the earlier statistic, then lower threshold; rows that
share an id are judged separately; a very long text is read whole; an empty table gives an
empty result.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fold_of, stored

WORD_GAP = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _repeat_words(win: Column) -> Column:
    """Words inside 3-word windows whose hash occurs twice or more; ``win`` holds the
    window hashes in text order."""
    tagged = F.array_sort(F.transform(win, lambda h, i: F.struct(h.alias("h"), i.alias("p"))))
    dup = _let(tagged, lambda s: F.array_sort(F.transform(
        F.filter(s, lambda x, i: F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False))
                 | F.coalesce(F.get(s, i - 1)["h"] == x["h"], F.lit(False))),
        lambda x: x["p"])))
    covered = _let(dup, lambda p: F.aggregate(
        F.transform(p, lambda at, i: F.least(F.lit(3), F.coalesce(F.get(p, i + 1) - at, F.lit(3)))),
        F.lit(0).cast("long"), lambda a, x: a + x))
    return F.when(F.size(F.array_distinct(win)) < F.size(win), covered).otherwise(
        F.lit(0).cast("long"))


def text_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, _n_words, _word_chars, _n_symbols, _n_dup_lines, _n_repeat_words, ...)."""
    t = docs.select(F.col(id_col).alias("_id"), F.coalesce(text_col, F.lit("")).alias("_t"))
    t = t.select("_id", "_t",
                 F.filter(F.split("_t", WORD_GAP), lambda w: w != "").alias("_w"),
                 F.filter(F.split("_t", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
                 .alias("_ln"))
    t = t.select(
        "_id", "_t", "_w", F.transform("_w", lambda w: F.xxhash64(w)).alias("_h"),
        F.size("_w").cast("long").alias("_n_words"),
        F.char_length(F.array_join("_w", "")).cast("long").alias("_word_chars"),
        F.size("_ln").cast("long").alias("_n_lines"),
        (F.size("_ln") - F.size(F.array_distinct("_ln"))).cast("long").alias("_n_dup_lines"))
    pair = F.zip_with("_h", F.slice("_h", 2, F.greatest(F.size("_h"), F.lit(1))),
                      lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    win = F.slice(F.zip_with(pair, F.slice("_h", 3, F.greatest(F.size("_h"), F.lit(1))),
                             lambda ab, c: F.xxhash64(ab["a"], ab["b"], c)),
                  1, F.greatest(F.size("_h") - 2, F.lit(0)))
    t = t.select(
        "_id", "_n_words", "_word_chars", "_n_lines", "_n_dup_lines",
        F.regexp_count("_t", F.lit(SYMBOLS)).cast("long").alias("_n_symbols"),
        F.regexp_count("_t", F.lit("[A-Z]")).cast("long").alias("_n_upper"),
        F.regexp_count("_t", F.lit("[!?]")).cast("long").alias("_n_bangs"),
        F.regexp_count("_t", F.lit("[0-9]")).cast("long").alias("_n_digits"),
        F.size(F.array_distinct("_h")).cast("long").alias("_n_distinct"),
        win.alias("_win"))
    return t.select(*[c for c in t.columns if c != "_win"],
                    _repeat_words(F.col("_win")).alias("_n_repeat_words"))


def base_failed() -> Column:
    return (F.col("_n_words") < 50) | (F.col("_n_repeat_words") * 100 > F.col("_n_words") * 50)


#: name -> ratio over the statistics above; the order breaks ties.
FEATURES = {
    "symbols_per_word": ("_n_symbols", "_n_words"),
    "bangs_per_word": ("_n_bangs", "_n_words"),
    "repeat_share": ("_n_repeat_words", "_n_words"),
    "distinct_share": ("_n_distinct", "_n_words"),
    "dup_line_share": ("_n_dup_lines", "_n_lines"),
    "upper_share": ("_n_upper", "_word_chars"),
    "digit_share": ("_n_digits", "_word_chars"),
    "chars_per_word": ("_word_chars", "_n_words"),
    "words_per_line": ("_n_words", "_n_lines"),
}


def feature(name: str) -> Column:
    a, b = FEATURES[name]
    return F.col(a) / F.greatest(F.col(b), F.lit(1)).cast("double")


Literal = tuple[str, bool, float]  # statistic, True for ">", threshold


def condition(conj: list[Literal]) -> Column:
    out = F.lit(True)
    for name, above, t in conj:
        out = out & ((feature(name) > F.lit(t)) if above else (feature(name) <= F.lit(t)))
    return out


def _foil(p0: float, n0: float, p: float, n: float) -> float:
    if p <= 0:
        return 0.0
    return p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0)))


def learn(labelled: DataFrame, max_literals: int = 3,
          bins: int = 16, min_gain: float = 1.0) -> list[list[Literal]]:
    """Ordered rules for label ``_bad`` = 1 over a frame with the statistics, ``_bad``
    and ``_grow`` (rows that grow rules; the others prune them).

    Covering goes on until no literal gains on the uncovered rows. A rule that fails
    pruning is set aside: its first literal opens no further rule until one is added, and
    the next best is tried; one that covers no bad pruning row is not tried at all, as no
    rule from it can pass. Every rule covers a pruning row, every failure takes a literal,
    so it ends."""
    names = list(FEATURES)
    quant = [(i + 1) / (bins + 1) for i in range(bins)]
    cuts: dict[str, list[float]] = {n: [] for n in names}
    for row in labelled.groupBy("_bad").agg(
            *[F.percentile_approx(feature(n), quant, 2000).alias(n) for n in names]).collect():
        for n in names:
            cuts[n] = sorted({*cuts[n], *(float(x) for x in row[n] or [])})
    if not any(cuts.values()):
        return []

    def bin_of(name: str) -> Column:
        value = feature(name)
        return F.size(F.filter(F.array(*[F.lit(t) for t in cuts[name]]), lambda t: t < value))

    base = labelled.withColumn("_bins", F.array(*[bin_of(n) for n in names]))
    rules: list[list[Literal]] = []
    uncovered = F.lit(True)
    aside: set[Literal] = set()  # first literals whose rule failed on the rows left now
    first = None  # counts per first literal, of rows that grow and rows that prune
    while True:
        rest = base.where(uncovered)

        def counted(rows: DataFrame) -> dict:
            got = (rows.select("_grow", "_bad", F.posexplode("_bins").alias("_f", "_b"))
                   .groupBy("_grow", "_f", "_b").agg(F.sum("_bad").alias("p"),
                                                     F.count("*").alias("all")).collect())
            out: dict = {True: {}, False: {}}
            for r in got:
                out[r["_grow"]][(r["_f"], r["_b"])] = (r["p"], r["all"] - r["p"])
            return out

        first = first or counted(rest)
        hopeful = {k: p for k, (p, _) in first[False].items() if p}  # bad pruning rows by bin
        conj: list[Literal] = []
        for _ in range(max_literals):
            count = (counted(rest.where(F.col("_grow") & condition(conj))) if conj else first)[True]
            p0, n0 = (sum(v[i] for (f, _), v in count.items() if f == 0) for i in (0, 1))
            if p0 == 0 or n0 == 0:
                break
            best: tuple[float, Literal | None] = (min_gain, None)
            for f, n in enumerate(names):
                below = [0, 0]
                for b, t in enumerate(cuts[n]):
                    c = count.get((f, b), (0, 0))
                    below = [below[0] + c[0], below[1] + c[1]]
                    for above, (p, q) in ((True, (p0 - below[0], n0 - below[1])),
                                          (False, tuple(below))):
                        gain = _foil(p0, n0, p, q)
                        if gain > best[0] + 1e-9 and (
                                conj or ((n, above, t) not in aside and any(
                                    g == f and (k > b) == above for g, k in hopeful))):
                            best = (gain, (n, above, t))
            if best[1] is None:
                break
            conj.append(best[1])
        if not conj:
            break
        prefixes = [conj[:k + 1] for k in range(len(conj))]
        row = rest.where(~F.col("_grow")).agg(*[
            F.coalesce(F.sum(F.when(condition(c), F.lit(2) * F.col("_bad") - 1)), F.lit(0))
            .alias(f"d{k}") for k, c in enumerate(prefixes)], *[
            F.count(F.when(condition(c), F.lit(1))).alias(f"a{k}")
            for k, c in enumerate(prefixes)]).first()
        worth = [(row[f"d{k}"] / row[f"a{k}"]) if row[f"a{k}"] else -1.0
                 for k in range(len(conj))]
        k = max(range(len(conj)), key=lambda i: (round(worth[i], 9), -i))
        if worth[k] <= 0:  # no better than even on rows it was not grown on
            aside.add(conj[0])
            continue
        rules.append(conj[:k + 1])
        aside.clear()
        first = None
        uncovered = uncovered & ~condition(conj[:k + 1])
    return rules


def verdict(rules: list[list[Literal]]) -> Column:
    """The decision list as one ordered conditional: True keeps."""
    out = F.when(base_failed(), F.lit(False))
    for conj in rules:
        out = out.when(condition(conj), F.lit(False))
    return out.otherwise(F.lit(True))


def apply_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
                text_col: str = "text", label_col: str = "quality",
                folds: int = 3, held_fold: int = 1) -> DataFrame:
    """Statistics, ``_base_failed`` and ``_kept`` per document. Rules are learned from
    labelled documents outside ``held_fold`` that pass the base test."""
    stats = stored(text_statistics(docs, id_col, text_col), "quality_stats")
    lab = labels.where(F.col(label_col).isin(0, 1) & (fold_of(F.col(id_col), folds) != held_fold))
    lab = lab.groupBy(F.col(id_col).alias("_id")).agg(
        (F.lit(1) - F.min(F.col(label_col).cast("int"))).alias("_bad"))
    taught = stored(stats.join(lab, "_id").where(~base_failed())
                    .withColumn("_grow", F.crc32(F.concat(F.col("_id").cast("string"), F.lit("g")))
                                % 3 != 0), "quality_taught")
    rules = learn(taught)
    return stats.select("*", base_failed().alias("_base_failed"), verdict(rules).alias("_kept"))
