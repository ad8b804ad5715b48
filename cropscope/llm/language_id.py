"""Language id (operator 9): nearest of several centroids per language by cosine.

A text is a TF-IDF vector of the 1- to 3-grams (over UTF-8 bytes, edges marked) of its
words, hashed into a fixed number of dimensions and normalised. Each language's training vectors are clustered
(spherical k-means), so a language is several centroids. The nearest centroid by
cosine names the language; a text farther from it than any plausible training text of
that centroid is flagged as rejected. Training takes a bounded sample of labelled
rows; prediction reads whole texts.

Defined cases: a null text and a text without letters get ``und`` with score 0; with
no labelled rows at all every text does. Null labels and ids do not teach; ties go to
the language first in sorted order. ``rejected`` marks far texts, whose nearest
language is still reported. Rows that share an id are predicted separately; a very long text
is read whole; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .bytegrams import Words, separators
from .common import crc_fold, importable, labelled_sample, pieces

DIMS = 1 << 13
CENTROIDS = 4
_LETTER = re.compile(r"[^\W\d_]")
_KEEP = separators(digits_are_letters=False)


def term_counts(texts: list[str | None]) -> np.ndarray:
    """Counts of the hashed 1- to 3-grams of each text's words, one row per text."""
    words = Words(texts, _KEEP)
    doc = np.repeat(np.arange(len(texts)), words.doc_words)
    key = []
    for width in (1, 2, 3):
        h, w = words.grams(width)
        key.append(doc[w] * DIMS + ((h >> np.uint64(24)).astype(np.int64) & (DIMS - 1)))
    return np.bincount(np.concatenate(key), minlength=len(texts) * DIMS).reshape(-1, DIMS)


class Model:
    def __init__(self, idf, centroids, owner, names, far):
        self.idf, self.centroids, self.owner = idf, centroids, owner
        self.names, self.far = names, far

    def vectors(self, counts: np.ndarray) -> np.ndarray:
        v = np.log1p(counts.astype(np.float32)) * self.idf.astype(np.float32)
        n = np.sqrt((v * v).sum(1, keepdims=True))
        return v / np.maximum(n, 1e-12)

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, bool]]:
        out: list[tuple[str, float, bool]] = [("und", 0.0, True)] * len(texts)
        at = [i for i, t in enumerate(texts) if t and self.names and _LETTER.search(t)]
        if at:
            cos = self.vectors(term_counts([texts[i] for i in at])) @ self.centroids.T
            for i, row in zip(at, cos):
                k = int(np.argmax(row))
                out[i] = (self.names[self.owner[k]], float(np.clip(row[k], 0, 1)),
                          bool(row[k] < self.far[k]))
        return out


def cluster(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 12) -> np.ndarray:
    """Spherical k-means with spread-out seeding; at most ``len(x)`` centroids."""
    centers = [x[rng.integers(len(x))]]
    for _ in range(min(k, len(x)) - 1):
        gap = np.maximum(1 - (x @ np.stack(centers).T).max(1), 0)
        if gap.sum() <= 1e-9:
            break
        centers.append(x[rng.choice(len(x), p=gap / gap.sum())])
    c = np.stack(centers)
    for _ in range(rounds):
        near = (x @ c.T).argmax(1)
        for j in range(len(c)):
            if (near == j).any():
                m = x[near == j].mean(0)
                c[j] = m / max(1e-12, np.linalg.norm(m))
    return c


def fit(sample: list[tuple[str, str]], seed: int = 5) -> Model:
    rows = [(y, t) for y, t in sample if _LETTER.search(t)]
    names = sorted({y for y, _ in rows})
    if not names:
        return Model(None, None, None, [], None)
    counts = np.concatenate([term_counts([t for _, t in rows[i:i + 64]]).astype(np.float32)
                             for i in range(0, len(rows), 64)])
    label = np.array([names.index(y) for y, _ in rows])
    model = Model(np.log((1 + len(rows)) / (1 + (counts > 0).sum(0))) + 0.1, None, None, names,
                  None)
    rng = np.random.default_rng(seed)
    centers, owner, far = [], [], []
    for i in range(len(names)):
        x = model.vectors(counts[label == i])
        c = cluster(x, CENTROIDS, rng)
        cos = x @ c.T
        near = cos.argmax(1)
        for j in range(len(c)):
            mine = cos[near == j, j]
            far.append(0.5 * float(mine.min()) if len(mine) else 0.0)
        centers.append(c)
        owner += [i] * len(c)
    model.centroids, model.owner = np.concatenate(centers).astype(np.float32), owner
    model.far = np.array(far)
    return model


def predict_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      label_col: str = "lang", folds: int = 4, held_fold: int = 2,
                      per_class: int = 400, most_bytes: int = 16 << 20) -> DataFrame:
    """(id, held_out, lang_pred, score, rejected) for every row; the training bound is
    ``per_class`` rows per language and ``most_bytes`` of text."""
    importable(docs.sparkSession)
    sample, _ = labelled_sample(docs, None, label_col, id_col=id_col, text_col=text_col,
                                folds=folds, held_fold=held_fold, per_class=per_class,
                                most_bytes=most_bytes)
    model = docs.sparkSession.sparkContext.broadcast(fit(sample))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in pieces(whole, 512 << 10):
                ids = b.column(0).to_pylist()
                texts = b.column(1).to_pylist()
                got = [x for i in range(0, len(texts), 256)
                       for x in model.value.predict(texts[i:i + 256])]
                yield pa.RecordBatch.from_arrays([
                    pa.array(ids, pa.int64()),
                    pa.array([None if i is None else crc_fold(i, folds) == held_fold
                              for i in ids], pa.bool_()),
                    pa.array([g[0] for g in got], pa.string()),
                    pa.array([g[1] for g in got], pa.float64()),
                    pa.array([g[2] for g in got], pa.bool_()),
                ], ["_id", "_held_out", "_lang_pred", "_score", "_rejected"])

    return (docs.select(docs[id_col].cast("long").alias("_id"), docs[text_col].alias("_text"))
            .mapInArrow(run, "_id long, _held_out boolean, _lang_pred string, _score double, "
                             "_rejected boolean"))
