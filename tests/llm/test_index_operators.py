"""Hard negatives, BPE by transducer and periodic runs against brute force and the library."""

import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cropscope.llm import bpe_transducer, hard_negatives, periodic_runs
from cropscope.llm.queries import op11_hard_negatives, op12_bpe_transducer, op13_periodic_runs

from .helpers import docs_frame

# --- operator 11 -----------------------------------------------------------------------

VEC = "vec_id long, embedding array<float>, label int, score double, _row string, a int"


def vec_frame(spark, rows):
    return spark.createDataFrame([(i, v, y, 0.5, "x", 1) for i, v, y in rows], VEC)


def brute_negatives(rows, low=80):
    """(anchor, positive, rank, negative, positive score, negative score) by comparing all."""
    use = []
    for i, v, y in rows:
        if i is None or v is None or y is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        use.append((i, int(math.fmod(y + 1, 10)) if i % 7 == 0 else y,
                    [math.floor(256 * float(np.float32(x))) for x in v]))
    out = []
    for i, y, v in use:
        if i % 100:
            continue
        dot = [(sum(a * b for a, b in zip(v, w)), j, z) for j, z, w in use]
        same = sorted(((-s, j) for s, j, z in dot if z == y and j != i))[:5]
        other = sorted((-s, j) for s, j, z in dot if z != y)
        for p, j in same:
            got = [(s, n) for s, n in other if low * -p <= 100 * -s <= 100 * -p][:5]
            out += [(i, j, k + 1, n, -p, -s) for k, (s, n) in enumerate(got)]
    return sorted(out)


def mined(spark, rows, **more):
    frame = vec_frame(spark, rows)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    out = hard_negatives.mine(frame, label=label, anchor=F.col("vec_id") % 100 == 0, **more)
    return sorted(tuple(r) for r in out.collect())


def vectors(seed, n, dim=6, labels=3, step=20):
    rng = random.Random(seed)
    ids = rng.sample(range(0, 3000), n - 12) + [100 * k for k in range(12)]
    return [(i, [rng.randrange(-step, step) / step + 0.3 for _ in range(dim)], rng.randrange(labels))
            for i in dict.fromkeys(ids)]


@pytest.mark.parametrize("seed,step", [(1, 20), (2, 2), (3, 1)])
def test_negatives_equal_brute_force(spark, seed, step):
    rows = vectors(seed, 160, step=step)  # few steps: many equal scores
    assert mined(spark, rows) == brute_negatives(rows)


def test_negatives_blocks_of_anchors(spark):
    rows = vectors(4, 120)
    assert mined(spark, rows, block_bytes=8 * 6 * 3) == brute_negatives(rows)


def test_negatives_odd_rows(spark):
    rows = vectors(5, 100)
    rows += [(None, [1.0] * 6, 1), (200, None, 1), (300, [1.0] * 6, None), (5001, [1.0, None] * 3, 1),
             (5002, [float("nan")] * 6, 1), (5003, [float("inf")] * 6, 2), (5005, [0.5, 0.25], 1),
             (5006, [], 2), (5007, [0.5] * 9, 0), (-100, [0.5] * 6, 1), (-7, [0.5] * 6, -1)]
    assert mined(spark, rows) == brute_negatives([(i, None if v is None else (v + [0.0] * 9)[:9], y)
                                                  for i, v, y in rows])


def test_negatives_repeated_rows_and_one_label(spark):
    rows = vectors(6, 60)
    twice = rows + rows[:30] + rows[-12:]
    assert mined(spark, twice) == brute_negatives(twice)
    alone = [(i, v, 1) for i, v, _ in rows if i % 7]
    assert mined(spark, alone) == []


def test_negatives_empty_and_no_anchor(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(3, [1.0], 1), (4, [1.0], 2)]) == []


def test_negatives_huge_components(spark):
    """Past 53 bits products are exact; past 64 they count as the nearest long."""
    rows = [(100, [2.0 ** 22, 1.0], 1), (1, [2.0 ** 22, 1.0], 1), (2, [2.0 ** 22, 0.5], 2),
            (3, [2.0 ** 22, 2.0], 2)]
    top = 2 ** 60 + 256 * 256
    assert mined(spark, rows) == [(100, 1, 1, 2, top, 2 ** 60 + 256 * 128)]
    huge = [(100, [1e30], 1), (1, [1e30], 1), (2, [1e30], 2)]
    assert mined(spark, huge) == [(100, 1, 1, 2, 2 ** 63 - 1, 2 ** 63 - 1)]


def test_query_of_negatives(spark):
    d = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{d}/embeddings.parquet")
            .select("vec_id", "embedding", "label").collect()]
    got = sorted(tuple(r) for r in op11_hard_negatives(spark, d).collect())
    assert got == brute_negatives(rows) and got


# --- operator 12 -----------------------------------------------------------------------

@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(bpe_transducer.vocabulary_path())


def odd_texts(seed=1, n=1500):
    rng = random.Random(seed)
    some = ("abcxyzAZ'sStT  \n\t\x0b\x1c\x1f\x85\xa0éÉßµªº²½×÷ÀÿŸıİσςΣ日本́​ 　<|>"
            "KÅ1९٣𝒜😀rellveLLdM.,!?")
    whole = ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "café", "don't"]
    out = ["".join(rng.choice(whole) if rng.random() < .06 else rng.choice(some)
                   for _ in range(rng.randrange(0, 50))) for _ in range(n)]
    return out + [None, "", " \n\t", "word", "word", "x" * 30000, "ab " * 20000, "é" * 3000]


def check_encoding(spark, library, texts, **more):
    got = bpe_transducer.encode_documents(docs_frame(spark, list(enumerate(texts))), **more)
    for r in got.collect():
        want = library.encode(texts[r["_id"]] or "", add_special_tokens=False).ids
        assert np.frombuffer(r["_ids"], "<u4").tolist() == want, repr(texts[r["_id"]])[:200]
        assert r["_decoded"] == library.decode(want, skip_special_tokens=False)


@pytest.mark.parametrize("most", [0, 5, 1 << 15])
def test_encoding_equals_the_library(spark, library, most):
    """The size of the lexicon changes nothing, an empty one included."""
    check_encoding(spark, library, odd_texts(seed=most, n=500), most_words=most)


def test_encoding_of_long_texts_in_parts():
    text = "Aé<|endoftext|> b\n" * 30 + "c" * 50 + " d"
    parts = list(bpe_transducer.cut_at_space(text, 20))
    assert "".join(parts) == text and len(parts) > 10
    assert all(p[0] in " \n" for p in parts[1:])


def test_lexicon_is_minimal_and_complete():
    rng = random.Random(3)
    words = {"".join(rng.choice("abé") for _ in range(rng.randrange(1, 7))) for _ in range(400)}
    words |= {"walking", "talking", "king"}
    entries = {w: np.array([k, k + 1][:1 + k % 2], "<u4").tobytes() for k, w in enumerate(sorted(words))}
    lex = bpe_transducer.Lexicon(np.frombuffer(bpe_transducer.compile_lexicon(entries), np.uint8))
    have = sorted(w.encode() for w in entries)
    assert lex.places(have).tolist() == list(range(len(have)))
    for w, ids in entries.items():
        k = have.index(w.encode())
        assert lex.ids[lex.at[k]:lex.at[k + 1]].tobytes() == ids
    none = [b"", b"zz", b"walkin", b"walkings", "abé".encode()[:-1], b"a" * 500]
    assert (lex.places([w for w in none if w not in have]) == -1).all()
    # states of a minimal automaton are the distinct sets of possible endings
    prefixes = {w[:k] for w in have for k in range(len(w) + 1)}
    endings = {frozenset(w[len(p):] for w in have if w.startswith(p)) for p in prefixes}
    assert lex.states == len(endings)


def test_short_and_long_merges_agree():
    rng = random.Random(9)
    vocab = bpe_transducer.vocabulary(bpe_transducer.vocabulary_path())
    for _ in range(500):
        tok = [vocab.inner[rng.choice(b"abeilnorst")] for _ in range(rng.randrange(1, 60))]
        assert vocab._short(list(tok)) == vocab._long(list(tok))


def test_encoding_of_no_rows(spark):
    assert bpe_transducer.encode_documents(docs_frame(spark, [])).collect() == []


def test_encoding_null_and_repeated_ids(spark, library):
    frame = docs_frame(spark, [(None, "a b"), (1, "c"), (1, "c"), (1, "d")])
    got = bpe_transducer.encode_documents(frame).collect()
    assert sorted((r["_id"] is None, r["_id"], r["_decoded"]) for r in got) == [
        (False, 1, "c</w>"), (False, 1, "c</w>"), (False, 1, "d</w>"), (True, None, "a</w> b</w>")]
    again = bpe_transducer.decode_documents(bpe_transducer.encode_documents(frame, with_text=False))
    assert sorted(r["_decoded"] for r in again.collect()) == sorted(r["_decoded"] for r in got)


def test_query_of_encoding(spark, library):
    d = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] or "" for r in
             spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()}
    got = op12_bpe_transducer(spark, d).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = library.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        assert tuple(r) == (r["doc_id"], len(ids),
                            hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                            hashlib.sha256(back.encode()).hexdigest())


# --- operator 13 -----------------------------------------------------------------------

def brute_runs(w):
    """(start, length, period) of every run, by trying each period."""
    out = []
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            s = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            n = i + q - s
            if i > s and n >= max(6, 4 * q) and not any(
                    all(w[x] == w[x + p] for x in range(s, s + n - p)) for p in range(1, q)):
                out.append((s, n, q))
            i += i == s
    return sorted(out, key=lambda r: (r[0], r[2]))


def repetitive(rng):
    w = [f"v{rng.randrange(rng.choice((1, 2, 3, 30)))}" for _ in range(rng.choice((0, 1, 5, 6, 40, 90)))]
    if w and rng.random() < .7:
        unit = w[:rng.randrange(1, 8)]
        at = rng.randrange(len(w))
        w = w[:at] + unit * rng.randrange(2, 9) + unit[:rng.randrange(len(unit) + 1)] + w[at:]
    if rng.random() < .1:
        a, b = ["a"], ["a", "b"]
        for _ in range(7):
            a, b = b, b + a
        w = b
    return w


def test_runs_equal_brute_force():
    rng = random.Random(8)
    for _ in range(400):
        texts = [repetitive(rng) for _ in range(rng.randrange(1, 4))]
        number = {}
        flat = np.array([number.setdefault(x, len(number)) for w in texts for x in w], np.int64)
        text = np.repeat(np.arange(len(texts)), [len(w) for w in texts])
        s, e, q = periodic_runs.runs_of(flat, text)
        want, base = [], 0
        for w in texts:
            want += [(a + base, n, p) for a, n, p in brute_runs(w)]
            base += len(w)
        assert list(zip(s.tolist(), (e - s).tolist(), q.tolist())) == want


def test_suffix_and_lcp_arrays():
    rng = random.Random(2)
    w = np.array([rng.randrange(2) for _ in range(60)] + [0] * 20)
    part = np.repeat([0, 1], [50, 30])
    end = np.repeat([50, 80], [50, 30])
    sa, isa, lcp = periodic_runs.suffix_array(w, end, part)
    suffix = [(p, tuple(w[i:e])) for i, (p, e) in enumerate(zip(part.tolist(), end.tolist()))]
    assert [suffix[i] for i in sa] == sorted(suffix) and (isa[sa] == np.arange(80)).all()
    for r in range(1, 80):
        (p, x), (o, y) = suffix[sa[r - 1]], suffix[sa[r]]
        common = next((k for k, (a, b) in enumerate(zip(x, y)) if a != b), min(len(x), len(y)))
        assert lcp[r] == (common if p == o else 0)


def test_long_periodic_texts():
    for w, want in ((np.zeros(60_000, np.int64), [(0, 60_000, 1)]),
                    (np.tile(np.arange(7_000), 6), [(0, 42_000, 7_000)])):
        s, e, q = periodic_runs.runs_of(w, np.zeros(len(w), np.int64))
        assert list(zip(s.tolist(), (e - s).tolist(), q.tolist())) == want


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(words) if i not in gone)


def test_find_runs_rows(spark):
    rng = random.Random(4)
    rows = [(i, rng.choice((" ", "\n", " \t\r")).join(repetitive(rng))) for i in range(60)]
    rows += [(60, None), (61, ""), (62, " \n "), (None, "a b " * 9), (63, "é \x85 " * 4), (63, "x " * 6),
             (64, "a\x0bb\x0ca\x0bb\x0ca b a b"), (65, "w " * 40_000)]
    got = periodic_runs.find_runs(docs_frame(spark, rows)).collect()
    assert len(got) == len(rows)
    key = lambda r: (r[0] is None, r[0] or 0, str(r[1]), r[2])
    want = []
    for i, t in rows:
        w = [x.decode() for x in (t or "").encode().split()]
        runs = [(0, 40_000, 1)] if i == 65 else brute_runs(w)
        want.append((i, runs, collapsed(w, runs)))
    assert sorted(((r["_id"], [tuple(x) for x in r["_runs"]], r["_collapsed"]) for r in got),
                  key=key) == sorted(want, key=key)
    assert periodic_runs.find_runs(docs_frame(spark, [])).collect() == []


def test_query_of_runs(spark):
    d = "/root/testdata/sf0.001"
    texts = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: r for r in op13_periodic_runs(spark, d).collect()}
    assert len(got) == len(texts)
    hexed = lambda x: hashlib.sha256(x.encode()).hexdigest()
    with_runs = 0
    for r in texts:
        w = [x.decode() for x in (r["text"] or "").encode().split()]
        h, n = zlib.crc32(str(r["doc_id"]).encode()), len(w)
        if h % 10 == 0 and n:
            a = (h // 10) % n
            p = 1 + (n - a) // (3 + (h // 10) % 8)
            w = [w[a + (i - a) % p] if i >= a else w[i] for i in range(n)]
        runs = brute_runs(w) if n < 3000 else None
        if runs is None:
            continue
        with_runs += bool(runs)
        best = min(runs, key=lambda x: (-x[1] / x[2], x[0], x[2])) if runs else (None,) * 3
        assert tuple(got[r["doc_id"]]) == (
            r["doc_id"], len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            hexed("".join(f"{s},{m},{q}\n" for s, m, q in runs)), hexed(collapsed(w, runs)))
    assert with_runs > 5
