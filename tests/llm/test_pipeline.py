"""The corpus pipeline stage by stage against brute force on a small fixture."""

import os
import random

import corpus_pipeline
from cropscope.llm import toxicity
from cropscope.session import shared_path

from .helpers import words
from .test_exact_operators import components, dedup_by_hand, shingle_set


def fixture_tables(spark):
    rng = random.Random(20)
    docs = [(i, " ".join(words(rng, rng.randrange(40, 120), 2000))) for i in range(60)]
    shared = "this passage is repeated in many of the documents of the corpus"
    docs += [(100 + i, f"{docs[i][1]}\n{shared}") for i in range(8)]          # near copies
    items = [(1, " ".join(words(rng, 20, 9000))), (2, " ".join(words(rng, 12, 9000)))]
    docs += [(200 + i, f"{' '.join(words(rng, 60, 2000))} {items[i % 2][1]}") for i in range(4)]
    docs += [(300, None), (301, ""), (302, "tiny")]
    labels = []
    for i in range(400, 640):
        w = words(rng, 40, 2000)
        bad = i % 4 == 0
        if bad:
            w[5] = w[21] = "grumblox" + rng.choice(["", "x", "xx"])
        docs.append((i, " ".join(w)))
        labels.append((i, 1, int(bad)))
    root = shared_path(spark, "pipeline_fixture")
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in docs],
                          "doc_id long, text string, lang string, source string, n_chars long") \
        .write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int") \
        .write.parquet(f"{root}/labels.parquet")
    return root, items, {i for i, _, bad in labels if bad}


def test_stages_equal_brute_force(spark):
    root, items, toxic = fixture_tables(spark)
    docs = spark.read.parquet(f"{root}/documents.parquet")
    columns = docs.columns
    (_, tox), (_, lines), (_, near), (_, clean), (_, pack) = corpus_pipeline.STAGES

    def step(stage, df, name):
        out = stage(spark, df, root)
        path = os.path.join(root, f"{name}.parquet")
        out.write.parquet(path)
        return spark.read.parquet(path)

    start = [(r.doc_id, r.text) for r in docs.collect()]
    df = step(tox, docs, "a")
    left = [(r.doc_id, r.text) for r in df.collect()]
    gone = {i for i, _ in start} - {i for i, _ in left}
    scored = toxicity.score_documents(docs, spark.read.parquet(f"{root}/labels.parquet"))
    assert gone == {r._id for r in scored.where("_score >= 0.3").collect()}
    assert len(gone & toxic) >= 0.9 * len(toxic) and len(gone - toxic) <= 0.05 * len(start)
    assert df.columns == columns

    df = step(lines, df, "b")
    got = {r.doc_id: (r.text, r.n_chars) for r in df.collect()}
    assert df.columns == columns
    text = dict(left)
    for i, _, dropped, kept in dedup_by_hand(left):
        assert got[i] == ((kept, len(kept)) if dropped else (text[i], len(text[i] or "")))

    rows = [(i, t) for i, (t, _) in sorted(got.items())]
    df = step(near, df, "c")
    sets = [(i, shingle_set(t, 5)) for i, t in rows]
    want = {i for (i, _), c in zip(rows, components(sets, 80)) if i == c}
    assert {r.doc_id for r in df.collect()} == want and len(want) < len(rows)
    assert df.columns == columns

    rows = [(i, t) for i, t in rows if i in want]
    df = step(clean, df, "d")
    holds = {i for i, t in rows for _, b in items
             if 100 * len(shingle_set(b, 5) & shingle_set(t, 5)) >= 80 * len(shingle_set(b, 5))}
    assert {r.doc_id for r in df.collect()} == want - holds and len(holds) == 4

    out = pack(spark, df, root).collect()
    ends = {}
    for r in out:
        ends[r.doc_id] = ends.get(r.doc_id, 0) + r.length
        assert r.length <= 2048
    assert set(ends) == want - holds
    assert all(ends[r.doc_id] == r.doc_tokens for r in out)


def test_run_returns_the_last_stage(spark):
    root, _, _ = fixture_tables(spark)
    out = corpus_pipeline.run(spark, root)
    assert out.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id",
                           "offset"]
    assert out.count() > 200


def test_pipeline_of_nothing(spark):
    root, _, _ = fixture_tables(spark)
    docs = spark.read.parquet(f"{root}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, root)
    assert docs.count() == 0
