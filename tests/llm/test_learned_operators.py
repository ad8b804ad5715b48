"""Language model, classifiers and rules: counts by brute force, learning by held-out rows."""

import collections
import functools
import inspect
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cropscope.llm import (
    language_id,
    pitman_yor,
    quality_classifier,
    quality_rules,
    toxicity,
)
from cropscope.llm.bytegrams import Words, separators, windows
from cropscope.llm.common import labelled_sample

from .helpers import docs_frame, words

WORD = re.compile("[^\x20\x09-\x0D]+")


def fold(i, n):
    return zlib.crc32(str(i).encode()) % n


def label_frame(spark, rows, name):
    return spark.createDataFrame(rows, f"doc_id long, {name} int")


# --- training samples ----------------------------------------------------------------

def hash_first(spark, ids):
    return spark.createDataFrame([(i,) for i in ids], "i long").orderBy(
        F.pmod(F.xxhash64(F.lit(11), "i"), F.lit(1 << 30))).first().i


def test_a_text_beyond_the_budget_cuts_off_no_other_row(spark):
    ids = {y: [i for i in range(y * 100, y * 100 + 40) if fold(i, 4) != 2] for y in (0, 1)}
    rows = [(i, f"text of row {i}", y) for y in (0, 1) for i in ids[y]]
    long_ids = {hash_first(spark, ids[0]): "long " * 10_000, hash_first(spark, ids[1]): "late " * 300}
    docs = spark.createDataFrame([(i, long_ids.get(i, t), y) for i, t, y in rows],
                                 "doc_id long, text string, y int")
    for labels in (None, docs.select("doc_id", "y")):
        got, count = labelled_sample(docs if labels is None else docs.drop("y"), labels, "y",
                                     id_col="doc_id", text_col="text", folds=4, held_fold=2,
                                     per_class=100, most_bytes=5000)
        assert count == {y: len(ids[y]) for y in (0, 1)}
        want = sorted((y, t) for i, t, y in rows if i not in long_ids)
        assert sorted(r for r in got if len(r[1]) < 100) == want
        assert {t for _, t in got} - {t for _, t in want} == {"late " * 300}


def test_a_class_of_long_texts_only_is_taught_by_its_shortest(spark):
    docs = spark.createDataFrame([(i, "x " * (900 + i), 0) for i in range(20)]
                                 + [(i, "y", 1) for i in range(20, 40)],
                                 "doc_id long, text string, y int")
    got, _ = labelled_sample(docs, None, "y", id_col="doc_id", text_col="text", folds=4, held_fold=2,
                             per_class=2, most_bytes=1000)
    shortest = min(i for i in range(20) if fold(i, 4) != 2)
    assert got == [(0, "x " * (900 + shortest)), (1, "y"), (1, "y")]


# --- language model ------------------------------------------------------------------

def lm_rows():
    rng = random.Random(8)
    rows = [(i, " ".join(words(rng, rng.randrange(0, 120), 60))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "unseen-everywhere w1 W1"), (103, "the " * 4000),
             (None, "w1 w2"), (7, rows[7][1])]
    return rows


def test_language_model_counts_equal_brute_force(spark):
    rows = lm_rows()
    got = pitman_yor.score_documents(docs_frame(spark, rows)).collect()
    tok = lambda t: (t or "").encode().lower().split() + [None]
    train = collections.Counter()
    for i, t in rows:
        if i is not None and fold(i, 5) != 1:
            train.update(tok(t))
    n, v = sum(train.values()), len(train)
    want = collections.Counter()
    for i, t in rows:
        w = tok(t)
        base = sum(math.log10((train[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w)
        want[(i, None if i is None else fold(i, 5) == 1, len(w), sum(train[x] > 0 for x in w), n,
              round(base, 6))] += 1
    have = collections.Counter((r._id, r._held_out, r._n_tokens, r._n_known, r._train_tokens,
                                round(r._base_score, 6)) for r in got)
    assert have == want
    assert all(r._score <= 1e-9 and math.isfinite(r._score) for r in got)


def test_language_model_learns_order(spark):
    """Text that alternates fixed pairs is better predicted than by single words."""
    rng = random.Random(2)
    pairs = [(f"left{k}", f"right{k}") for k in range(25)]
    rows = [(i, " ".join(w for _ in range(30) for w in rng.choice(pairs))) for i in range(80)]
    got = pitman_yor.score_documents(docs_frame(spark, rows)).where("_held_out").collect()
    assert got and all(r._score > r._base_score + 5 for r in got)


def test_language_model_without_training_rows(spark):
    held = [i for i in range(200) if fold(i, 5) == 1][:3]
    got = pitman_yor.score_documents(docs_frame(spark, [(i, "a b") for i in held])).collect()
    assert [(r._n_tokens, r._n_known, r._train_tokens) for r in got] == [(3, 0, 0)] * 3
    assert all(r._score == 0 for r in got)
    assert pitman_yor.score_documents(docs_frame(spark, [])).count() == 0


def one_partition(seed=3):
    rng = np.random.default_rng(seed)
    words = np.sort(rng.integers(1, 1 << 63, 30, dtype=np.uint64))
    before = np.sort(rng.integers(1, 1 << 63, 90, dtype=np.uint64))
    keys = np.sort(rng.choice(30 * 90, 500, replace=False))
    word, ctx = keys // 90, before[keys % 90]
    held, word = np.unique(word, return_inverse=True)
    return pitman_yor.Seating({
        "_words": words[held].astype("<u8").tobytes(),
        "_sizes": np.bincount(word).astype("<u4").tobytes(), "_ctx": ctx.astype("<u8").tobytes(),
        "_val": rng.integers(1, 400, len(keys)).astype("<u4").tobytes()}, 4)


def consistent(level):
    busy = level.busy
    assert (np.bincount(level.own, minlength=len(busy))[busy] == level.t[busy]).all()
    assert (np.bincount(level.own, level.size, len(busy))[busy] == level.c[busy]).all()
    assert busy[level.own].all() and (level.c[~busy] == 1).all() and (level.t[~busy] == 1).all()
    assert (level.size >= 1).all() and (np.diff(level.own) >= 0).all() and (level.t >= 1).all()


def test_predictive_probabilities_sum_to_one():
    part = one_partition()
    rng = np.random.default_rng(1)
    tot = part.totals()
    for _ in range(3):
        tot.types, tot.tokens = len(part.words), int(part.levels[3].c.sum())
        mine = np.bincount(part.number, part.levels[3].t)[part.number]
        part.sweep(tot, mine, rng)
        group, cls, root, leaf = part.levels
        for level in part.levels:
            consistent(level)
        assert (np.bincount(part.up3, leaf.t) == group.c).all()
        assert (np.bincount(part.up2, group.t) == cls.c).all()
        assert (np.bincount(part.up1, cls.t, len(part.words)) == root.c).all()
        tot = part.totals()
    tot.types, tot.tokens = len(part.words), int(part.levels[3].c.sum())
    p0, p1, p2 = part.probabilities(tot)
    b2, b1 = tot.back_off(0), tot.back_off(1)
    unk = tot.back_off(2)[0] / (tot.types + 1)
    assert p0.sum() + unk == pytest.approx(1)
    word = part.up1[part.up2]
    seen1 = dict(zip(zip(part.up1, part.cls), p1))
    seen2 = dict(zip(zip(word, part.group), p2))
    for u in part.group[:20]:
        c = u // pitman_yor.SUBS
        total = b2[u] * b1[c] * unk
        for w in range(len(part.words)):
            total += seen2.get((w, u), b2[u] * seen1.get((w, c), b1[c] * p0[w]))
        assert total == pytest.approx(1)


def test_seating_is_carried_on():
    part = one_partition()
    rng = np.random.default_rng(1)
    tot = part.totals()
    tot.types = len(part.words)
    part.sweep(tot, np.zeros(len(part.ctx)), rng)
    leaf = part.levels[3]
    row = {"_words": part.words.tobytes(), "_sizes": part.sizes.astype("<u4").tobytes(),
           "_ctx": part.ctx.tobytes(), "_val": leaf.c.astype("<u4").tobytes()}
    again = pitman_yor.Seating(row, 4, part.state())
    for x, y in zip(part.levels, again.levels):
        assert (x.c == y.c).all() and (x.t == y.t).all()
        assert (x.size[x.c[x.own] > 1] == y.size).all()


def test_seating_follows_the_process():
    """Three customers at tables that open with weight a: partitions have the chances of
    a ** tables times the product of (1 - d) ... (n - 1 - d) over tables of n."""
    a, d, n = 0.8, 0.5, 40_000
    rng = np.random.default_rng(0)
    tables = pitman_yor.Tables(np.full(n, 3))
    tables.gibbs(np.full(n, a), d, rng, moves=30)
    consistent(tables)
    weight = np.array([a * (1 - d) * (2 - d), 3 * a * a * (1 - d), a ** 3])
    assert np.bincount(tables.t, minlength=4)[1:] / n == pytest.approx(weight / weight.sum(), abs=0.01)
    tables.follow(np.full(n, 2), np.full(n, a), d, rng)
    tables.gibbs(np.full(n, a), d, rng, moves=5)
    assert (tables.t == 2).mean() == pytest.approx(a / (a + 1 - d), abs=0.01)
    tables.follow(np.arange(n) % 5 + 1, np.full(n, a), d, rng)
    consistent(tables)


def test_word_numbers_tell_words_apart():
    rng = random.Random(2)
    some = {bytes(rng.randrange(33, 127) for _ in range(rng.randrange(1, 12))) for _ in range(30_000)}
    some |= {b"a" * n for n in range(1, 400)} | {b"x" * 64 + w for w in (b"y", b"z", b"yx")} | {b"ab", b"ba"}
    some = sorted(some)
    got = pitman_yor.word_numbers(some)
    assert len(np.unique(got)) == len(some) and (got != pitman_yor.END).all()
    assert (got == [pitman_yor.word_numbers([w])[0] for w in some[:50]] + list(got[50:])).all()
    group = (got >> np.uint64(pitman_yor.GROUP_SHIFT)).astype(int)
    assert group.min() >= pitman_yor.SUBS and group.max() < pitman_yor.CONTEXTS
    same = [k for k, w in enumerate(some) if len(w) > 3 and w.endswith(b"aaa")]
    assert len({g // pitman_yor.SUBS for g in group[same]}) == 1
    assert len(np.unique(group // pitman_yor.SUBS)) > 400


def test_auxiliary_trials():
    rng = np.random.default_rng(5)
    sizes = rng.integers(1, 60, 3000)
    want = sum((0.5 / np.arange(1, k)).sum() for k in sizes)
    assert pitman_yor.trials(sizes, lambda j: 0.5 / j, rng) == pytest.approx(want, rel=0.05)
    assert pitman_yor.trials(sizes, lambda j: 0.5 / j, rng, step=7) == pytest.approx(want, rel=0.05)
    assert pitman_yor.trials(np.empty(0, int), lambda j: j, rng) == 0


def test_scores_equal_a_brute_force_model(spark, monkeypatch):
    """Every token's probability by recursion over plain dictionaries of the same seating."""
    kept = {}
    bucketed, scorer = pitman_yor._bucketed, pitman_yor._scorer

    def keep_model(df, name, parts):
        kept[name] = bucketed(df, name, parts)
        return kept[name]

    def keep_totals(tot, parts, labels):
        kept["tot"] = tot.value
        return scorer(tot, parts, labels)

    monkeypatch.setattr(pitman_yor, "_bucketed", keep_model)
    monkeypatch.setattr(pitman_yor, "_scorer", keep_totals)
    rows = lm_rows()
    got = pitman_yor.score_documents(docs_frame(spark, rows)).collect()
    tot, root, cls, group, leaf, count, tables = kept["tot"], {}, {}, {}, {}, {}, collections.Counter()
    for r in kept["model"][0].collect():
        a = {c: np.frombuffer(r[c], k) for c, k in pitman_yor._KIND.items()}
        e = g = c = 0
        for i, w in enumerate(a["_words"].tolist()):
            root[w], count[w] = (a["_c0"][i], a["_t0"][i]), a["_count"][i]
            for _ in range(a["_sizes"][i]):
                leaf[w, int(a["_ctx"][e])] = (a["_val"][e], a["_tw"][e])
                tables[int(a["_ctx"][e])] += float(a["_tw"][e])
                e += 1
            for _ in range(a["_group_sizes"][i]):
                group[w, int(a["_group"][g])] = (a["_c2"][g], a["_t2"][g])
                g += 1
            for _ in range(a["_up_sizes"][i]):
                cls[w, int(a["_cls"][c])] = (a["_c1"][c], a["_t1"][c])
                c += 1

    def at(entry, level, c, t, parent):
        d, s = tot.discount[level], tot.strength[level]
        n, m = (float(x) for x in entry)
        return (max(0.0, n - d * m) + (s + d * t) * parent) / (s + c)

    def chance(w, u):
        k = u >> pitman_yor.GROUP_SHIFT
        p = at(root.get(w, (0, 0)), 2, tot.c[2][0], tot.t[2][0], 1 / (tot.types + 1))
        p = at(cls.get((w, k // pitman_yor.SUBS), (0, 0)), 1, tot.c[1][k // pitman_yor.SUBS],
               tot.t[1][k // pitman_yor.SUBS], p)
        p = at(group.get((w, k), (0, 0)), 0, tot.c[0][k], tot.t[0][k], p)
        return at(leaf.get((w, u), (0, 0)), 3, count.get(u, 0), tables[u], p)

    end = int(pitman_yor.END)
    number = lambda x: int(pitman_yor.word_numbers([x])[0])
    want = collections.Counter()
    for i, t in rows:
        w = [number(x) for x in (t or "").encode().lower().split()] + [end]
        want[i, round(sum(math.log10(chance(x, u)) for u, x in zip([end, *w], w)), 3)] += 1
    have = collections.Counter((r._id, round(r._score, 3)) for r in got)
    close = sum((want & have).values())
    assert close >= len(rows) - 2  # a third decimal may round either way
    assert sum(abs(r._score) for r in got) == pytest.approx(sum(-k[1] * n for k, n in want.items()), rel=1e-5)


def test_words_to_spread_keep_their_scores(spark):
    """The same scores whether or not frequent words are spread over partitions."""
    rows = lm_rows()
    a = {(r._id, r._n_tokens): r._score
         for r in pitman_yor.score_documents(docs_frame(spark, rows)).collect()}
    gather = pitman_yor._gather
    try:
        pitman_yor._gather = lambda *a, **k: (gather(*a, **k)[0], {})
        b = {(r._id, r._n_tokens): r._score
             for r in pitman_yor.score_documents(docs_frame(spark, rows)).collect()}
    finally:
        pitman_yor._gather = gather
    assert a == {k: pytest.approx(v, abs=1e-6) for k, v in b.items()}


def same_group():
    """Two words of one suffix class and hash part."""
    seen = {}
    for w in (f"n{k}ing" for k in range(100)):
        group = int(pitman_yor.word_numbers([w.encode()])[0]) >> pitman_yor.GROUP_SHIFT
        first = seen.setdefault(group, w)
        if first != w:
            return first, w


def test_each_previous_word_has_its_own_restaurant(spark):
    a, b = same_group()
    rng = random.Random(4)
    train = [i for i in range(400) if fold(i, 5) != 1][:100]
    held = iter([i for i in range(100_000) if fold(i, 5) == 1])
    rows = [(i, " ".join(rng.choice([f"{a} x", f"{b} y", "c d"]) for _ in range(20)))
            for i in train]
    names = [a, b, "x", "y", "c", "d", "unseen"]
    texts = ["", *names, *(f"{u} {w}" for u in names for w in names)]
    ids = {next(held): t for t in texts}
    got = pitman_yor.score_documents(docs_frame(spark, rows + list(ids.items()))).collect()
    score = {ids[r._id]: r._score for r in got if r._id in ids}
    # the same words but for the order: each follows its own word, not the group's
    assert score[f"{a} x"] > score[f"{a} y"] + 1 and score[f"{b} y"] > score[f"{b} x"] + 1
    # P(w | u) P(end | w) / P(end | u): its largest eigenvalue is 1 if every row of P sums to 1
    part = lambda u, w: 10 ** (score[f"{u} {w}"] - score[u])
    m = np.array([[part(u, w) for w in names] + [10 ** score[""]] for u in names]
                 + [[10 ** (score[w] - score[""]) for w in names] + [10 ** score[""]]])
    assert max(abs(np.linalg.eigvals(m))) == pytest.approx(1, abs=1e-4)


# --- classifiers ---------------------------------------------------------------------

def test_words_of_a_buffer():
    w = Words(["Ab cde!! x", "", None, " hi-1 "], separators(digits_are_letters=True))
    assert w.n == 5 and w.doc_words.tolist() == [3, 0, 0, 2]
    assert bytes(w.data) == b" ab cde x hi 1 "
    for k, per_word in ((1, [2, 3, 1, 2, 1]), (3, [2, 3, 1, 2, 1]), (4, [1, 2, 0, 1, 0])):
        assert np.bincount(w.grams(k)[1], minlength=5).tolist() == per_word
    s, e, doc = windows(np.array([3, 0, 10]), 8, 4)
    assert list(zip(s, e, doc)) == [(0, 3, 0), (3, 11, 2), (7, 13, 2)]


def test_toxicity_finds_unseen_spellings(spark):
    rng = random.Random(6)
    stems = ["grumblox", "snarkwit"]
    rows, labels = [], []
    for i in range(700):
        w = words(rng, rng.randrange(10, 80), 3000)
        bad = i % 5 == 0
        if bad:
            for _ in range(2):
                w[rng.randrange(len(w))] = rng.choice(stems) + rng.choice("abcdefghij") * rng.randrange(3)
        rows.append((i, " ".join(w)))
        labels.append((i, int(bad)))
    rows += [(900, None), (901, ""), (902, " .. "), (None, "grumblox"), (903, "x" * 50_000)]
    out = toxicity.score_documents(docs_frame(spark, rows), label_frame(
        spark, [*labels, (950, None), (951, 7)], "toxic")).collect()
    assert len(out) == len(rows) and all(0 <= r._score <= 1 for r in out)
    truth = dict(labels)
    held = [r for r in out if r._held_out and r._id in truth]
    assert held and np.mean([(r._score >= 0.3) == bool(truth[r._id]) for r in held]) > 0.93
    kept = toxicity.drop_toxic(docs_frame(spark, rows), label_frame(spark, labels, "toxic"))
    assert kept.columns == docs_frame(spark, rows).columns
    assert kept.count() == sum(r._score < 0.3 for r in out)


def plain_toxicity(model, text):
    """The score of one text by loops over its words' n-grams."""
    def hashed(gram):
        h = len(gram)
        for b in gram:
            h = ((h ^ b) * 0x9E3779B97F4A7C15) % 2 ** 64
            h ^= h >> 29
        return (h >> 24) % toxicity.BUCKETS

    found = re.findall(rb"(?:[a-z0-9]|[\x80-\xff])+", (text or "").lower().encode())
    value = []
    for w in found:
        edged = b" " + w + b" "
        grams = [edged[i:i + n] for n in toxicity.WIDTHS for i in range(len(edged) - n + 1)]
        value.append(sum(float(model.bucket[hashed(g)]) for g in grams) / len(grams))
    if not value:
        return model.prior
    at, z = 0, []
    while True:
        part = value[at:at + toxicity.WINDOW]
        z.append(sum(part) / len(part) + model.bias)
        if at + toxicity.WINDOW >= len(value):
            break
        at += toxicity.HOP
    top = max(z)
    pooled = top + math.log(sum(math.exp(model.sharp * (x - top)) for x in z) / len(z)) / model.sharp
    return 1 / (1 + math.exp(-min(30, max(-30, model.scale * pooled + model.shift))))


def toxic_sample(seed=4):
    rng = random.Random(seed)
    out = []
    for i in range(120):
        w = words(rng, rng.randrange(5, 60), 900)
        if i % 6 == 0:
            w[rng.randrange(len(w))] = "gr\u00e4umblox"
            w[rng.randrange(len(w))] = "snarkwit"
        out.append((int(i % 6 == 0), " ".join(w)))
    return out


def test_toxicity_scores_equal_plain_python():
    sample = toxic_sample()
    model = toxicity.fit(sample, {0: 100, 1: 20})
    texts = [t for _, t in sample[:30]] + [None, "", " !! ", "a", "Gr\u00c4umbloxx word", "ab cd ef gh ij",
                                           "x" * 3000, "\u65e5\u672c\u8a9e \U0001f600 ok"]
    got = model.score(texts)
    assert got == pytest.approx([plain_toxicity(model, t) for t in texts], abs=1e-5)
    assert np.mean(model.score([t for y, t in sample if y]) >= 0.3) > 0.9


def test_toxicity_parts_leave_out_every_row_once():
    sample = toxic_sample()
    label, texts = np.array([y for y, _ in sample]), [t for _, t in sample]
    held = [toxicity.fit_part(label, texts, k, toxicity.PARTS, 0.2) for k in range(toxicity.PARTS)]
    assert sum(len(z) for _, z, _ in held) == len(sample)
    assert sum(int(y.sum()) for _, _, y in held) == sum(label)
    assert all(m is None for m, _, _ in held)


def test_toxicity_words_are_encoded_once():
    """Texts as numbers of distinct words give the same windows as words one by one."""
    texts = ["idle words idle", None, "other words!", ""]
    data = toxicity.Encoded(texts)
    assert data.doc_words.tolist() == [3, 0, 2, 0] and len(data.sizes) == 3
    words_of = Words(texts, separators(digits_are_letters=True))
    h = np.concatenate([words_of.grams(n)[0] for n in toxicity.WIDTHS])
    w = np.concatenate([words_of.grams(n)[1] for n in toxicity.WIDTHS])
    for k in range(words_of.n):
        one = sorted(((h[w == k] >> np.uint64(24)) & np.uint64(toxicity.BUCKETS - 1)).tolist())
        e = data.word[k]
        assert one == sorted(data.ids[data.at[e]:data.at[e] + data.sizes[e]].tolist())


def test_toxicity_trains_on_the_documented_rows():
    for f in (toxicity.drop_toxic, toxicity.score_documents):
        bound = {k: v.default for k, v in inspect.signature(f).parameters.items()}
        assert bound["per_class"] == {1: 1500, 0: 5000} and bound["most_bytes"] == 40 << 20


def test_toxicity_without_labels(spark):
    none = label_frame(spark, [], "toxic")
    out = toxicity.score_documents(docs_frame(spark, [(1, "a"), (2, None)]), none).collect()
    assert {r._score for r in out} == {0.0}
    assert toxicity.score_documents(docs_frame(spark, []), none).count() == 0


def plain_language(model, text):
    """(language, cosine) of one text by loops over its words' n-grams."""
    def hashed(gram):
        h = len(gram)
        for b in gram:
            h = ((h ^ b) * 0x9E3779B97F4A7C15) % 2 ** 64
            h ^= h >> 29
        return (h >> 24) % language_id.DIMS

    count = collections.Counter()
    for w in re.findall(rb"(?:[a-z]|[\x80-\xff])+", text.lower().encode()):
        edged = b" " + w + b" "
        for b in w:
            count[hashed(bytes([b]))] += 1
        for n in (2, 3):
            for i in range(len(edged) - n + 1):
                count[hashed(edged[i:i + n])] += 1
    v = {k: math.log1p(c) * float(model.idf[k]) for k, c in count.items()}
    norm = math.sqrt(sum(x * x for x in v.values()))
    cos = [sum(x * float(c[k]) for k, x in v.items()) / norm for c in model.centroids]
    best = max(range(len(cos)), key=cos.__getitem__)
    return model.names[model.owner[best]], min(1.0, max(0.0, cos[best]))


def test_languages_equal_plain_python():
    rng = random.Random(5)
    made = {"aa": ["ka", "ko", "ri", "mu"], "bb": ["sch", "el", "\u00fcng", "pf"], "cc": ["oux", "eau", "vi"]}
    sample = [(y, " ".join("".join(rng.choice(s) for _ in range(rng.randrange(1, 4))) for _ in range(30)))
              for y, s in made.items() for _ in range(20)]
    model = language_id.fit(sample)
    texts = [t for _, t in sample[::7]] + ["ka", "Schel 12 \u00fcng!", "oux-eau", "zzz qqq", "mu " * 4000]
    for got, t in zip(model.predict(texts), texts):
        name, cos = plain_language(model, t)
        assert got[0] == name and got[1] == pytest.approx(cos, abs=1e-4)


def language_rows():
    rng = random.Random(5)
    syllables = {"aa": ["ka", "ko", "ri", "mu"], "bb": ["sch", "el", "ung", "pf"], "cc": ["oux", "eau", "vi"]}
    rows = []
    for i in range(240):
        lang = rng.choice(sorted(syllables))
        rows.append((i, " ".join("".join(rng.choices(syllables[lang], k=rng.randrange(1, 4)))
                                 for _ in range(rng.randrange(5, 60))), lang))
    return rows


def test_language_id(spark):
    rows = language_rows()
    extra = [(500, None, "aa"), (501, "", "aa"), (502, "123 !!", "bb"), (503, "kako riri", None),
             (None, "schung", "bb")]
    df = spark.createDataFrame([(i, t, y, 1, 2) for i, t, y in rows + extra],
                               "doc_id long, text string, lang string, score int, n int")
    out = language_id.predict_languages(df).collect()
    got = {r._id: r for r in out}
    assert len(out) == len(rows) + len(extra) and all(0 <= r._score <= 1 for r in out)
    assert [got[i]._lang_pred for i in (500, 501, 502)] == ["und"] * 3
    assert got[503]._lang_pred == "aa"
    held = [(got[i]._lang_pred, y) for i, _, y in rows if fold(i, 4) == 2]
    assert np.mean([a == b for a, b in held]) > 0.97
    empty = language_id.predict_languages(df.where("lang is null"))
    assert {r._lang_pred for r in empty.collect()} == {"und"}
    assert language_id.predict_languages(df.limit(0)).count() == 0


def quality_rows():
    rng = random.Random(12)
    rows, labels = [], []
    for i in range(420):
        w = words(rng, rng.randrange(60, 160), 900)
        good = i % 6 != 0
        if not good:
            w = [x + "###" for x in w] if i % 4 else [x.upper() + "!!" for x in w]
        rows.append((i, " ".join(w)))
        labels.append((i, int(good)))
    return rows, labels


def test_quality_from_positives_and_unlabelled(spark):
    rows, labels = quality_rows()
    odd = [(800, None), (801, ""), (802, " \n"), (None, "text of nobody")]
    out = quality_classifier.score_documents(docs_frame(spark, rows + odd),
                                             label_frame(spark, labels, "quality")).collect()
    got = {r._id: r for r in out}
    assert len(out) == len(rows) + 4 and [got[i]._score for i in (800, 801, 802)] == [0.0] * 3
    truth = dict(labels)
    held = [(r._score >= 0.5) == bool(truth[r._id]) for r in out if r._held_out and r._id in truth]
    assert np.mean(held) > 0.9
    none = label_frame(spark, [], "quality")
    assert {r._score for r in quality_classifier.score_documents(
        docs_frame(spark, rows[:5]), none).collect()} == {0.0}
    assert quality_classifier.score_documents(docs_frame(spark, []), none).count() == 0


def test_quality_scores_equal_plain_python():
    """A text's score by loops over the network's weights."""
    rng = random.Random(3)
    good = [" ".join(words(rng, 40)) for _ in range(60)]
    junk = ["### $$$ ###" * rng.randrange(1, 9) for _ in range(15)]
    m = quality_classifier.fit(good, good + junk, 0.7)
    texts = [*good[:10], *junk[:5], None, "", " \n", "\u00e9\u00e9 x", "word " * 5000]
    want = []
    for t in texts:
        if not t or t.isspace():
            want.append(0.0)
            continue
        x = [min(8.0, max(-8.0, (v - a) / s)) for v, a, s in zip(
            quality_classifier.text_features(t), m.mean, m.std)]
        z = float(m.b2[0])
        for j in range(len(m.w2)):
            z += m.w2[j] * math.tanh(m.b1[j] + sum(x[i] * m.w1[i][j] for i in range(len(x))))
        want.append(1 / (1 + math.exp(-min(30, max(-30, z)))))
    assert m.score(texts) == pytest.approx(want, abs=1e-9)


def test_quality_labels_of_zero_are_never_examples():
    """The fit sees positives and unlabelled texts; zeros enter by the prior alone."""
    good, junk = ["plain words in a line"] * 50, ["### ### $$$ ###"] * 10
    a = quality_classifier.fit(good, good + junk, 0.8)
    assert (a.score(good) > 0.5).all() and (a.score(junk) < 0.5).all()


def statistics_by_hand(t):
    w = WORD.findall(t or "")
    tri = collections.Counter(zip(w, w[1:], w[2:]))
    cov = {j for i in range(len(w) - 2) if tri[tuple(w[i:i + 3])] >= 2 for j in (i, i + 1, i + 2)}
    seen, dup = set(), 0
    for x in (t or "").split("\n"):
        if WORD.search(x):
            dup += x in seen
            seen.add(x)
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), dup, len(cov))


def test_rule_statistics_equal_brute_force(spark):
    rng = random.Random(1)
    rows = [(i, "\n".join(" ".join(words(rng, rng.randrange(0, 12), 5)) for _ in range(rng.randrange(1, 9))))
            for i in range(60)]
    rows += [(100, None), (101, ""), (102, " \n \t"), (103, "a"), (104, "a b"), (105, "é é é é #|<"),
             (106, "x y z x y z x y z"), (106, "again"), (107, "a b c d \x1c e"), (108, "w " * 3000)]
    got = quality_rules.text_statistics(docs_frame(spark, rows)).collect()
    have = collections.Counter((r._id, r._n_words, r._word_chars, r._n_symbols, r._n_dup_lines,
                                r._n_repeat_words) for r in got)
    assert have == collections.Counter((i, *statistics_by_hand(t)) for i, t in rows)


def test_kept_equals_the_rules_by_hand(spark, monkeypatch):
    """The verdict of every row by loops over the learned rules and its statistics."""
    rules = []
    learn = quality_rules.learn
    monkeypatch.setattr(quality_rules, "learn", lambda df: rules.extend(learn(df)) or rules)
    rows, labels = quality_rows()
    out = quality_rules.apply_rules(docs_frame(spark, rows), label_frame(spark, labels, "quality")).collect()
    assert rules
    kept = 0
    for r in out:
        fails = r._n_words < 50 or 100 * r._n_repeat_words > 50 * r._n_words
        for conj in rules:
            hit = True
            for name, above, t in conj:
                a, b = quality_rules.FEATURES[name]
                value = r[a] / max(r[b], 1)
                hit = hit and (value > t if above else value <= t)
            fails = fails or hit
        assert r._kept == (not fails)
        kept += r._kept
    assert 0 < kept < len(out)


def test_rules_learn_what_is_bad(spark):
    rows, labels = quality_rows()
    rows += [(900, None), (901, "short")]
    out = {r._id: r for r in quality_rules.apply_rules(
        docs_frame(spark, rows), label_frame(spark, [*labels, (990, None)], "quality")).collect()}
    assert not out[900]._kept and out[901]._base_failed and not out[901]._kept
    held = [out[i]._kept == bool(y) for i, y in labels if fold(i, 3) == 1]
    assert np.mean(held) > 0.95
    bare = quality_rules.apply_rules(docs_frame(spark, rows), label_frame(spark, [], "quality"))
    assert all(r._kept != r._base_failed for r in bare.collect())
    assert quality_rules.apply_rules(docs_frame(spark, []), label_frame(spark, [], "quality")).count() == 0


def statistics_frame(spark, rows):
    """Rows (changed statistics, bad, grow) over statistics that vary around one text's."""
    rng = random.Random(6)
    base = {"_n_symbols": 20, "_n_words": 200, "_n_bangs": 20, "_n_repeat_words": 20,
            "_n_distinct": 120, "_n_dup_lines": 10, "_n_lines": 40, "_n_upper": 50,
            "_word_chars": 1000, "_n_digits": 50}
    vary = [c for c in base if c not in ("_n_words", "_n_lines", "_word_chars")]
    made = [tuple({**{c: v + (rng.randrange(-3, 4) if c in vary else 0) for c, v in base.items()},
                   **new}.values()) + (bad, grow) for new, bad, grow in rows]
    return spark.createDataFrame(made, ", ".join(f"{c} long" for c in base)
                                 + ", _bad int, _grow boolean")


def test_rules_cover_more_kinds_than_eight(spark):
    kinds = [{"_n_symbols": 90}, {"_n_symbols": 1}, {"_n_bangs": 90}, {"_n_bangs": 1},
             {"_n_repeat_words": 90}, {"_n_repeat_words": 1}, {"_n_distinct": 180},
             {"_n_distinct": 40}, {"_n_upper": 400}, {"_n_upper": 1}, {"_n_digits": 400}]
    rows = [({}, 0, k % 3 != 0) for k in range(330)]
    rows += [(new, 1, k % 3 != 0) for new in kinds for k in range(30)]
    df = statistics_frame(spark, rows).cache()
    rules = quality_rules.learn(df)
    kept = df.where(~functools.reduce(lambda a, b: a | b, map(quality_rules.condition, rules)))
    assert len(rules) >= len(kinds)
    assert kept.where("_bad = 1").count() == 0 and kept.count() > 300


def test_a_rule_that_fails_pruning_ends_nothing(spark):
    rows = [({}, 0, k % 3 != 0) for k in range(300)]
    rows += [({"_n_bangs": 90}, int(k % 3 != 0), k % 3 != 0) for k in range(120)]
    rows += [({"_n_digits": 400}, 1, k % 3 != 0) for k in range(30)]
    rules = quality_rules.learn(statistics_frame(spark, rows).cache())
    assert any(name == "digit_share" and above for conj in rules for name, above, _ in conj)


def test_rules_run_no_python(spark):
    rows, labels = quality_rows()
    df = quality_rules.apply_rules(docs_frame(spark, rows), label_frame(spark, labels, "quality"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CASE WHEN" in plan


def test_language_model_makes_all_its_sweeps():
    import inspect
    n = {k: p.default for k, p in inspect.signature(pitman_yor.score_documents).parameters.items()}
    assert (n["rounds"] - 1) * n["sweeps"] + n["burn_in"] + n["samples"] >= 10 and n["samples"] >= 4


def test_pairs_with_and_without_the_text_in_the_key():
    texts = ["b a b a", None, "a b", "", "c c c"] * 3
    part = lambda w: pitman_yor.part_of(w, 3)
    got = pitman_yor.Pairs(texts, part, True)
    assert len(got.docs) == got.count.sum() == sum(len((t or "").split()) + 1 for t in texts)
    plain = pitman_yor.Pairs(texts, part, False)
    assert (plain.count == got.count).all() and (plain.before == got.before).all()
    for r in got.rows(3, [0, 1, 2]).to_pylist():
        some = np.frombuffer(r["_some"], "<u8")
        assert (np.unique(some) == np.sort(some)).all()
        assert pitman_yor._places(r["_some"], r["_place"]).max() == len(some) - 1


def test_rows_between_partitions_are_packed(spark):
    """What tokens send to the model is well below its plain numbers, and comes out the same."""
    from cropscope.llm.common import part_labels
    rng = np.random.default_rng(4)
    rows = [(i, " ".join(f"w{int(x)}" for x in rng.zipf(1.3, 400) % 5000)) for i in range(300)]
    part = lambda w: pitman_yor.part_of(w, 4)
    plain = pitman_yor.Pairs([t for _, t in rows], part, True).rows(4, [0, 1, 2, 3])
    names = ["_words", "_sizes", "_some", "_place", "_val", "_docs"]
    src = spark.createDataFrame(rows, "_id long, _t string").coalesce(1)
    for got in (pitman_yor._occurrences(src, spark.sparkContext.broadcast({}), 4, part_labels(spark, 4), 5, 1),
                pitman_yor._counts(src, 4, part_labels(spark, 4), 5, -1)):
        used = [c for c in names if c in got.columns]
        sent = sum(len(r[c]) for r in got.collect() for c in used if r[c] is not None)
        assert sent < 0.7 * sum(len(x) for c in used for x in plain.column(c).to_pylist())
    tight = pitman_yor.sealed(plain)
    for c in names:
        for x, y in zip(plain.column(c).to_pylist(), tight.column(c).to_pylist()):
            assert pitman_yor.unseal(y).tobytes() == x
    for width, a in ((2, []), (8, [0, (1 << 64) - 1]), (4, [7] * 1000)):
        x = np.array(a, f"<u{width}").tobytes()
        assert pitman_yor.unseal(pitman_yor.seal(x, width, True)).tobytes() == x
        assert pitman_yor.unseal(pitman_yor.seal(x, width)).tobytes() == x


def test_sweep_works_on_entries_that_move(monkeypatch):
    """Entries of one customer have no choice: no chances are worked out for them."""
    rng = np.random.default_rng(5)
    words, ctx = (np.sort(rng.integers(1, 1 << 63, n, dtype=np.uint64)) for n in (400, 8000))
    part = pitman_yor.Seating({
        "_words": words.astype("<u8").tobytes(), "_sizes": np.full(400, 20).astype("<u4").tobytes(),
        "_ctx": np.sort(ctx.reshape(400, 20)).astype("<u8").tobytes(),
        "_val": np.where(np.arange(8000) % 100, 1, 5).astype("<u4").tobytes()}, 4)
    tot, asked = part.totals(), []
    tot.types = 400
    plain = pitman_yor.Totals.predictive
    monkeypatch.setattr(pitman_yor.Totals, "predictive", lambda self, level, at, c, t, parent: (
        asked.append((level, len(c))), plain(self, level, at, c, t, parent))[1])
    part.sweep(tot, np.ones(8000), rng)
    assert 0 < sum(n for level, n in asked if level == 0) < 2000 < len(part.group)
    for level in part.levels:
        consistent(level)


def test_words_in_a_buffer_equal_words_of():
    from cropscope.llm.common import words_of
    texts = ["B a\tb", None, "", "a", "b", " \x0b\x0c\r\n ", "x" * 64 + " " + "Y" * 65 + "\x1f" + "Ä" * 300,
             "  wide \xa0", "end "]
    for some in (texts, pa.array(texts, pa.string()), pa.array(["cut", *texts], pa.string()).slice(1),
                 pa.array(texts, pa.large_string())):
        data, start, size, n = pitman_yor.words_in(some)
        got = [bytes(data[a:a + k]) for a, k in zip(start, size)]
        assert got == [w for t in texts for w in words_of(t)] and n.tolist() == [len(words_of(t)) for t in texts]
        numbers = pitman_yor._numbers(data, start, size, pitman_yor._sums(data, start, size))
        assert (numbers == [pitman_yor.word_numbers([w])[0] for w in got]).all()
    assert [x.tolist() for x in pitman_yor.words_in(["", None])] == [[], [], [], [0, 0]]
