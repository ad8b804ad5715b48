"""Packing, near duplicates, decontamination, line dedup and token counts against brute force."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cropscope.llm import decontamination, line_dedup, ngram_jaccard, packing, token_counts
from cropscope.llm.tokens import encode_spans, vocabulary_paths

from .helpers import docs_frame, words

WORD = re.compile("[^\x20\x09-\x0D]+")


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def shingle_set(text, k):
    w = WORD.findall(lowered(text))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def components(sets, percent):
    """Smallest id reachable; ``sets`` is a list of (id, set)."""
    ids = [i for i, _ in sets]
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for x in range(len(sets)):
        for y in range(x):
            s, t = sets[x][1], sets[y][1]
            if s and t and 100 * len(s & t) >= percent * len(s | t):
                root[find(x)] = find(y)
    least = {}
    for x in range(len(sets)):
        least[find(x)] = min(least.get(find(x), ids[x]), ids[x])
    return [least[find(x)] for x in range(len(sets))]


def corpus(seed=1):
    """Originals, copies, near copies at the border of similarity, short and odd texts."""
    rng = random.Random(seed)
    rows, at = [], 0
    common = " ".join(words(rng, 60))
    for g in range(6):
        base = words(rng, rng.choice((12, 30, 70, 150)))
        for _ in range(rng.choice((1, 4, 12))):
            w = list(base)
            for _ in range(rng.randrange(0, 6)):
                w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
            rows.append((at, " ".join(w) if g % 2 else common + " " + " ".join(w)))
            at += 1
    copy = " ".join(words(rng, 40))
    rows += [(at + i, copy if i % 3 else copy.upper()) for i in range(30)]
    at += 30
    for t in (None, "", "  \t\n", "one", "ONE", "one two", "a b c", "a b c d", "É b c", "é b c",
              "x" * 5000, "\x1c a b c", "tie tie tie tie", "tie tie tie"):
        rows.append((at, t))
        at += 1
    rows.append((at - 1, "tie tie tie"))  # a repeated row
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("width,percent", [(3, 90), (5, 80)])
def test_near_duplicates_equal_brute_force(spark, width, percent):
    rows = corpus(width)
    got = ngram_jaccard.linked_documents(docs_frame(spark, rows), width=width, percent=percent).collect()
    want = components([(i, shingle_set(t, width)) for i, t in rows], percent)
    have = collections.Counter((r._id, r._n, r._component) for r in got)
    assert have == collections.Counter(
        (i, len(shingle_set(t, width)), c) for (i, t), c in zip(rows, want))


def test_border_pairs_link_exactly(spark):
    """Sets of 19 that share 18 link at 90 %, sets that share 17 do not."""
    base = [f"k{i}" for i in range(21)]  # 19 shingles
    rows = [(1, " ".join(base)), (2, " ".join(base[:-1] + ["z"])), (3, " ".join(base[:-2] + ["y", "x"]))]
    got = {r._id: r._component for r in ngram_jaccard.linked_documents(docs_frame(spark, rows)).collect()}
    assert got == {1: 1, 2: 1, 3: 3}


def test_links_through_null_and_shared_ids(spark):
    """A chain runs through a set held by a null id only; an id's two texts stay apart."""
    base = [f"k{i}" for i in range(21)]
    chain = [base, base[:-1] + ["z"], ["q"] + base[1:-1] + ["z"]]
    other = [f"m{i}" for i in range(21)]
    rows = [(1, " ".join(chain[0])), (None, " ".join(chain[1])), (None, "nothing like it at all"),
            (None, " ".join(chain[1])), (3, " ".join(chain[2])), (3, " ".join(other)),
            (9, " ".join(other[:-1] + ["z"]))]
    got = collections.Counter((r._id, r._component) for r in ngram_jaccard.linked_documents(
        docs_frame(spark, rows)).collect())
    assert got == {(1, 1): 1, (None, 1): 2, (None, None): 1, (3, 1): 1, (3, 3): 1, (9, 3): 1}


def test_near_duplicates_of_nothing(spark):
    assert ngram_jaccard.linked_documents(docs_frame(spark, [])).count() == 0


def test_components_follow_long_chains(spark):
    from cropscope.llm.components import components as linked
    pairs = [(i, i + 1) for i in range(60)] + [(100, x) for x in range(101, 140)] + [(7, 7)]
    got = {r.node: r.label for r in linked(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert len({got[i] for i in range(61)}) == 1 and len({got[i] for i in range(100, 140)}) == 1
    assert got[0] != got[100]


def test_contained_items_equal_brute_force(spark):
    rng = random.Random(4)
    items = [(i, " ".join(words(rng, n, 5000))) for i, n in enumerate((6, 9, 15, 22, 40, 64, 65, 130))]
    items += [(50, "solo"), (51, None), (52, ""), (53, items[2][1]), (2, "other text for the same id here")]
    rows = []
    for d in range(60):
        body = words(rng, rng.choice((0, 30, 700)), 5000)
        for _ in range(rng.randrange(3)):
            piece = (items[rng.randrange(8)][1]).split()
            if rng.random() < 0.5:
                piece[rng.randrange(len(piece))] = "edit"
            if rng.random() < 0.3:
                piece = piece[:max(1, int(len(piece) * rng.choice((0.7, 0.85))))]
            cut = rng.randrange(len(body) + 1)
            body[cut:cut] = [p.upper() for p in piece] if rng.random() < 0.3 else piece
        rows.append((d, " ".join(body)))
    rows += [(900, None), (901, ""), (902, "SOLO"), (903, "solo and more"), (904, rows[3][1]), (904, rows[4][1])]
    item_frame = spark.createDataFrame(items, "item_id long, text string")
    got = decontamination.contained_items(docs_frame(spark, rows), item_frame).collect()
    by_doc = collections.defaultdict(set)
    for i, t in rows:
        by_doc[i] |= shingle_set(t, 5)
    want = {}
    for k, t in items:
        s = shingle_set(t, 5)
        for i, own in by_doc.items():
            if s and 100 * len(s & own) >= 80 * len(s):
                want[i, k] = max(want.get((i, k), 0), len(s & own) / len(s))
    assert {(r._doc, r._item): pytest.approx(r._containment) for r in got} == want
    assert len(want) > 20
    none = decontamination.contained_items(docs_frame(spark, []), item_frame)
    assert none.count() == 0
    assert decontamination.contained_items(docs_frame(spark, rows), item_frame.limit(0)).count() == 0


def dedup_by_hand(rows):
    """(n_lines, n_dropped, kept) of each row."""
    strip = "\x20\t\n\x0b\x0c\r"
    key = lambda x: lowered(x.strip(strip))
    holders = collections.defaultdict(set)
    for i, t in rows:
        for x in (t or "").split("\n"):
            if i is not None and len(key(x)) >= 20:
                holders[key(x)].add(i)
    out = []
    for i, t in rows:
        ls = (t or "").split("\n")
        keep = [x for x in ls if not (len(holders.get(key(x), ())) >= 3 and max(holders[key(x)]) != i
                                      and i is not None)]
        out.append((i, len(ls), len(ls) - len(keep), "\n".join(keep)))
    return out


def test_line_dedup_equals_brute_force(spark):
    rng = random.Random(9)
    pool = [f"This is shared line number {k} of the pool" for k in range(12)]
    pool += ["short", "exactly twenty chars", "nineteen characters", "ÉTÉ ÉTÉ ÉTÉ ÉTÉ ÉTÉ X", "", "  "]
    rows = []
    for d in range(40):
        ls = [rng.choice(pool) for _ in range(rng.randrange(1, 9))]
        ls = [rng.choice((x, x.upper(), "\t" + x + " \r", x)) for x in ls]
        ls.insert(rng.randrange(len(ls) + 1), f"only document {d} has this long line")
        rows.append((d, "\n".join(ls)))
    rows += [(100, None), (101, ""), (102, "\n\n"), (103, pool[0]), (103, pool[0] + "\nmine\n" + pool[1]),
             (5, rows[5][1]), (None, pool[0]), (104, "\n".join([pool[1]] * 3))]
    got = line_dedup.dedup_lines(docs_frame(spark, rows)).collect()
    have = collections.Counter((r.doc_id, r._n_lines, r._n_dropped, r._kept) for r in got)
    assert have == collections.Counter(dedup_by_hand(rows))
    assert line_dedup.dedup_lines(docs_frame(spark, [])).count() == 0


def test_line_dedup_bitmaps_hold_no_text(spark):
    rows = [(d, "a line that all of them hold\nown\n" + "a line that all of them hold") for d in range(4)]
    b = line_dedup.keep_bitmaps(docs_frame(spark, rows))
    assert b.columns == ["doc_id", "tag", "dropped"]
    assert {(r.doc_id, tuple(map(tuple, r.dropped))) for r in b.collect()} == {
        (d, ((0, 1), (2, 1))) for d in range(3)}


def exact_tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(vocabulary_paths()[1])


def packing_rows():
    rng = random.Random(3)
    rows = [(i, " ".join(words(rng, rng.randrange(0, 900)))) for i in range(40)]
    rows += [(100, None), (101, ""), (102, "x"), (102, "x"), (103, "a<|endoftext|>b"), (None, "no id"),
             (104, " \n\n\t "), (105, "日本語 ünïcode 🙂 " * 50), (106, "long " * 9000)]
    return rows


def test_packing_round_trip(spark):
    rows = packing_rows()
    tok = exact_tokenizer()
    got = packing.pack(docs_frame(spark, rows)).collect()
    ids = lambda t: tok.encode(t or "", add_special_tokens=False).ids + [1]
    rebuilt = collections.defaultdict(list)
    for r in got:
        assert zlib.crc32(r._tokens) == zlib.crc32(np.frombuffer(r._tokens, "<u4").tobytes())
        assert len(r._tokens) == 4 * r._length
        rebuilt[r._id].append((r._start, tuple(np.frombuffer(r._tokens, "<u4"))))
    want = collections.defaultdict(list)
    for i, t in rows:
        want[i].append(tuple(ids(t)))
    for i, texts in want.items():
        if len(texts) == 1:
            assert sum((list(p) for _, p in sorted(rebuilt[i])), []) == list(texts[0])
        else:
            assert sum(len(p) for _, p in rebuilt[i]) == sum(map(len, texts))
    seqs = collections.defaultdict(list)
    for r in got:
        seqs[r._sequence].append((r._offset, r._length))
    padding = total = 0
    for v in seqs.values():
        at = 0
        for o, n in sorted(v):
            assert o == at
            at += n
        assert at <= 2048
        total += at
        padding += 0 if at & (at - 1) == 0 else 2048 - at
    assert padding < 0.05 * total
    assert packing.pack(docs_frame(spark, [])).count() == 0


def test_cuts_are_class_tops():
    tops = {2048 // k for k in range(1, 2049)}
    for n in (1, 2, 3, 45, 700, 1025, 2047, 2048, 2049, 10_000):
        c = packing.cut(n, 2048)
        assert sum(c) == n and set(c) <= tops and len([x for x in c if x < 2048]) <= 4
    assert packing.place_last({2: 3, 3: 5, 1024: 7}, 2048)[2] == (1, 1, 0)


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_token_counts_equal_brute_force(spark, rule):
    rows = [(i, t) for i, t in packing_rows() if i is not None and i < 106 and i != 102]
    tok = exact_tokenizer()  # special tokens are told as such, as in the sequence a model sees
    got = token_counts.count_tokens(docs_frame(spark, rows), rule=rule).collect()
    by = collections.defaultdict(list)
    for r in got:
        by[r._id].append(r)
    for i, t in rows:
        ls = (t or "").split("\n")
        parts = ["s\n", "xx\n"] + [x + "\n" for x in ls[:-1]] + [ls[-1]]
        edges = np.concatenate(([0], np.cumsum([len(p) for p in parts])))
        counts = [0] * len(parts)
        offsets = tok.encode("".join(parts), add_special_tokens=False).offsets
        for a, b in offsets:
            over = [max(0, min(b, edges[k + 1]) - max(a, edges[k])) for k in range(len(parts))]
            hit = [k for k, x in enumerate(over) if x > 0]
            counts[hit[0] if rule == "first" else hit[-1] if rule == "last"
                   else max(hit, key=lambda k: (over[k], -k))] += 1
        mine = sorted(by[i], key=lambda r: r._section)
        assert [r._tokens for r in mine] == counts
        assert {r._doc_tokens for r in mine} == {len(offsets)}
        assert [r._kind for r in mine[:2]] == ["source", "lang"] and mine[-1]._kind == "text"
    assert token_counts.count_tokens(docs_frame(spark, [])).count() == 0


def test_spans_of_split_characters():
    ids, s, e = encode_spans("a🙂b", vocabulary_paths())
    assert s[0] == 0 and e[-1] == 3 and all(x < y for x, y in zip(s, e))
    assert {(int(x), int(y)) for x, y in zip(s, e)} == {(0, 1), (1, 2), (2, 3)}


def test_special_tokens_are_counted_as_a_model_sees_them(spark):
    from cropscope.llm.tokens import SPECIAL, encode
    texts = [f"a{SPECIAL}b", SPECIAL, f"{SPECIAL}{SPECIAL}\nx\u00e9{SPECIAL} y", "a<|endof text|>b"]
    for t in texts:
        ids, s, e = encode_spans(t, vocabulary_paths())
        assert ids.tolist() == encode(t, vocabulary_paths()).tolist()
        assert (s[1:] >= s[:-1]).all() and s[0] == 0 and e[-1] == len(t)
    got = token_counts.count_tokens(docs_frame(spark, list(enumerate(texts))), field_cols=())
    total = {r["_id"]: r["n"] for r in got.groupBy("_id").agg(F.sum("_tokens").alias("n")).collect()}
    assert total == {i: len(encode(t, vocabulary_paths())) for i, t in enumerate(texts)}
    assert total[0] == 3


def test_token_counts_of_null_and_repeated_ids(spark):
    rows = [(None, "a b"), (1, "c d"), (1, "c d"), (2, "x" * 70_000)]
    got = token_counts.count_tokens(docs_frame(spark, rows), field_cols=()).collect()
    assert sorted((r["_id"] is None, r["_id"]) for r in got) == [
        (False, 1), (False, 1), (False, 2), (True, None)]


def test_line_dedup_keeps_columns_that_clash(spark):
    """Input columns named like those the operator adds or joins on."""
    line = "a line that is long enough to be counted"
    frame = docs_frame(spark, [(i, f"{line}\nown {i}") for i in range(4)]).withColumns({
        "_dropped": F.lit("mine"), "_kept": F.lit("also mine"), "_b_id": F.lit(7)})
    names = ("_lines", "_gone", "_left")
    got = line_dedup.dedup_lines(frame, names=names).orderBy("doc_id").collect()
    assert [r["_left"] for r in got] == ["own 0", "own 1", "own 2", f"{line}\nown 3"]
    assert {(r["_dropped"], r["_kept"], r["_b_id"]) for r in got} == {("mine", "also mine", 7)}


def test_registered_queries_import_and_name_all_operators():
    from cropscope.llm.queries import QUERIES, SQL
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 11))
    assert set(SQL) <= set(QUERIES)
    assert hashlib.sha256(b"").hexdigest()  # digest of a document that lost every line


def test_fold_matches_python(spark):
    from cropscope.llm.common import crc_fold, fold_of
    got = spark.range(50).select("id", fold_of(F.col("id"), 5).alias("f")).collect()
    assert all(r.f == crc_fold(r.id, 5) for r in got)
