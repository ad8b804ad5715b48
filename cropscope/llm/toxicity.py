"""Toxicity (operator 7): subword-bag embeddings, averaged, into a linear softmax.

A word (a run of letters and digits) is the bag of its 3- to 6-grams over UTF-8 bytes,
edges marked, hashed into a fixed number of buckets.
The word vectors of a window are averaged and a linear softmax scores the window;
the log-mean-exp over all windows of the text is the document's logit, so one hostile
sentence is not diluted by a long clean text. Embeddings and softmax are trained
jointly in numpy on a bounded sample of labelled rows; a misspelt or unseen word is
scored through the n-grams it shares with seen ones. Scoring reads whole texts.

The sample never comes to the driver. Tasks train on it side by side: one the model, the
others models that each leave out a part of the rows. The logits of the rows left out,
all of them together, calibrate the model's logit, so that few labelled rows are enough.
A text is kept as numbers of its words and each distinct word's n-grams once.

Defined cases: empty or null text has no window and scores the class prior of the
training labels; with fewer than two label values every score is the prior (0 with
no labels); null labels or ids do not teach; a null id still gets a score; repeated rows
are scored alike and each teaches; a very long text is scored whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytegrams import Numbers, Words, numbered, separators, windows
from .common import (
    crc_fold,
    importable,
    labelled_rows,
    part_labels,
    pieces,
    shuffle_partitions,
)

BUCKETS, DIM = 1 << 18, 16
WIDTHS = (3, 4, 5, 6)
WINDOW, HOP = 4, 2
START = -2.0  # logit of a window whose words carry no evidence
#: Training rows at most per label value, and models that calibrate.
SAMPLE = {1: 1500, 0: 5000}
PARTS = 3
_KEEP = separators(digits_are_letters=True)


def word_bags(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(bucket numbers, number per word) of the n-grams of each word; never none."""
    each = Words.each(words)
    got = [each.grams(width) for width in WIDTHS]
    word = np.concatenate([w for _, w in got])
    order = np.argsort(word, kind="stable")
    ids = (np.concatenate([h for h, _ in got]) >> np.uint64(24)).astype(np.int64) & (BUCKETS - 1)
    return ids[order].astype(np.int32), np.bincount(word, minlength=each.n)


def pooled(logit: np.ndarray, doc: np.ndarray, docs: int, sharp: float) -> np.ndarray:
    """Log-mean-exp of the window logits of each text; minus infinity without windows."""
    top = np.full(docs, -np.inf)
    np.maximum.at(top, doc, logit)
    total = np.bincount(doc, np.exp(sharp * (logit - top[doc])), docs)
    n = np.bincount(doc, minlength=docs)
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(n > 0, top + np.log(total / n) / sharp, -np.inf)


class Model:
    """``bucket`` holds each bucket's contribution to the toxic-minus-clean logit."""

    sharp = 3.0

    def __init__(self, bucket: np.ndarray, bias: float, scale: float, shift: float, prior: float):
        self.bucket, self.bias = bucket, bias
        self.scale, self.shift, self.prior = scale, shift, prior

    def raw(self, per_word: np.ndarray, doc_words: np.ndarray) -> np.ndarray:
        s, e, doc = windows(doc_words, WINDOW, HOP)
        c = np.concatenate(([0.0], np.cumsum(per_word)))
        return pooled((c[e] - c[s]) / (e - s) + self.bias, doc, len(doc_words), self.sharp)

    def words(self, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The mean contribution of each word's n-grams."""
        if not len(sizes):
            return np.empty(0)
        return np.add.reduceat(self.bucket[ids].astype(np.float64), np.cumsum(sizes) - sizes) / sizes

    def score(self, texts: list[str | None]) -> np.ndarray:
        if self.bucket is None:
            return np.full(len(texts), self.prior)
        number = Numbers()
        doc_words, word = numbered(texts, _KEEP, number)
        z = self.raw(self.words(*word_bags(list(number)))[word], doc_words)
        p = 1 / (1 + np.exp(-np.clip(self.scale * z + self.shift, -30, 30)))
        return np.where(np.isfinite(z), p, self.prior)


def _ragged(at: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Positions at[i] .. at[i]+sizes[i]-1 of every i, one after another."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(at - (ends - sizes), sizes)


class Encoded:
    """Texts as numbers of their words; n-grams of each distinct word once."""

    def __init__(self, texts: list[str | None]):
        number = Numbers()
        made = [numbered(texts[lo:lo + 64], _KEEP, number) for lo in range(0, len(texts), 64)]
        none = np.empty(0, np.int32)
        self.doc_words = np.concatenate([np.empty(0, np.int64), *(m[0] for m in made)])
        self.word = np.concatenate([none, *(m[1] for m in made)])
        self.first = np.cumsum(self.doc_words) - self.doc_words
        words = list(number)
        bags = [word_bags(words[lo:lo + 4096]) for lo in range(0, len(words), 4096)]
        self.ids = np.concatenate([none, *(b[0] for b in bags)])
        self.sizes = np.concatenate([np.empty(0, np.int64), *(b[1] for b in bags)])
        self.at = np.cumsum(self.sizes) - self.sizes

    def part(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(words per text, distinct words, which of them each word is, n-grams of those)."""
        doc_words = self.doc_words[rows]
        distinct, which = np.unique(self.word[_ragged(self.first[rows], doc_words)],
                                    return_inverse=True)
        return doc_words, distinct, which, self.ids[_ragged(self.at[distinct], self.sizes[distinct])]


def evidence(data: Encoded, label: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Per bucket the log ratio of the shares of toxic and of clean texts that hold it, less
    1.5 standard errors: 0 for what a few texts hold by chance."""
    held = np.zeros((2, BUCKETS))
    for r in rows:
        held[label[r]][np.unique(data.part(np.array([r]))[3])] += 1
    n = np.array([[(label[rows] == y).sum()] for y in (0, 1)])
    clean, toxic = np.log((held + 0.5) / (n + 1.0))
    error = np.sqrt((1 / (held + 0.5)).sum(0))
    return np.sign(toxic - clean) * np.maximum(0, np.abs(toxic - clean) - 1.5 * error)


def train(data: Encoded, label: np.ndarray, rows: np.ndarray, prior: float, epochs: int = 5,
          batch: int = 32, rate: float = 0.2, gain: float = 10.0, seed: int = 7,
          min_steps: int = 40) -> Model:
    """Joint training of bucket vectors and softmax by Adagrad on ``rows``, which have words;
    classes are weighted evenly. Vectors start along the softmax's direction, ``gain`` times
    their evidence, so that a few labelled texts teach what recurs in them first. The logit
    is not calibrated yet."""
    rng = np.random.default_rng(seed)
    soft = rng.normal(0, 0.5, (DIM, 2)).astype(np.float32)
    diff = soft[:, 1] - soft[:, 0]
    emb = (rng.uniform(-1, 1, (BUCKETS, DIM)) / (200 * DIM)).astype(np.float32)
    emb += (gain * evidence(data, label, rows)[:, None] * diff / (diff @ diff)).astype(np.float32)
    # fixed: a window without evidence, such as one of unseen words, is clean
    bias = np.array([-START / 2, START / 2])
    seen_e, seen_w = np.full(BUCKETS, 1e-7), np.full(DIM, 1e-3)
    n1 = max(1, int(label[rows].sum()))
    weight = {1: len(rows) / (2 * n1), 0: len(rows) / (2 * max(1, len(rows) - n1))}
    for _ in range(max(epochs, -(-min_steps * batch // len(rows)))):
        rows = rng.permutation(rows)
        for lo in range(0, len(rows), batch):
            part = rows[lo:lo + batch]
            y = label[part]
            doc_words, distinct, which, ids = data.part(part)
            sizes = data.sizes[distinct]
            vec = np.add.reduceat(emb[ids], np.cumsum(sizes) - sizes,
                                  axis=0) / sizes[:, None].astype(np.float32)
            diff = soft[:, 1] - soft[:, 0]
            c = np.concatenate(([0.0], np.cumsum((vec @ diff).astype(np.float64)[which])))
            s, e, doc = windows(doc_words, WINDOW, HOP)
            logit = (c[e] - c[s]) / (e - s) + bias[1] - bias[0]
            z = pooled(logit, doc, len(part), Model.sharp)
            g = np.where(y == 1, weight[1], weight[0]) / len(part) * (
                1 / (1 + np.exp(-np.clip(z, -30, 30))) - y)
            share = np.exp(Model.sharp * (logit - z[doc]))
            share *= g[doc] / np.bincount(doc, share, len(part))[doc] / (e - s)
            occ = np.bincount(s, share, len(which) + 1) - np.bincount(e, share, len(which) + 1)
            per_word = np.bincount(which, np.cumsum(occ)[:-1], len(distinct))
            g_diff = per_word @ vec
            step = np.bincount(ids, np.repeat(per_word / sizes, sizes), BUCKETS)
            hit = np.nonzero(step)[0]
            step = step[hit]
            seen_e[hit] += step ** 2
            emb[hit] -= (rate * step / np.sqrt(seen_e[hit])).astype(np.float32)[:, None] * diff
            seen_w += g_diff ** 2
            move = 0.1 * rate * g_diff / np.sqrt(seen_w)
            soft[:, 1] -= move / 2
            soft[:, 0] += move / 2
    bucket = (emb @ (soft[:, 1] - soft[:, 0])).astype(np.float32)
    return Model(bucket, float(bias[1] - bias[0]), 1.0, 0.0, float(prior))


def logits(model: Model, data: Encoded, rows: np.ndarray) -> np.ndarray:
    doc_words, distinct, which, ids = data.part(rows)
    return model.raw(model.words(ids, data.sizes[distinct])[which], doc_words)


def fit_part(label: np.ndarray, texts: list[str | None], part: int, parts: int, prior: float
             ) -> tuple[Model | None, np.ndarray, np.ndarray]:
    """For ``part`` below ``parts`` the (logits, labels) of the rows that its model left out;
    for ``part`` = ``parts`` the model of all rows. No model if a label value is missing."""
    data = Encoded(texts)
    none = np.empty(0)
    rows = np.nonzero(data.doc_words)[0]
    out = np.zeros(len(rows), bool)
    if part < parts:
        for y in (0, 1):  # every part has its share of both labels
            mine = np.nonzero(label[rows] == y)[0]
            out[mine[part::parts]] = True
    if len(set(label[rows[~out]].tolist())) < 2:
        return None, none, none
    model = train(data, label, rows[~out], prior)
    if part == parts:
        return model, none, none
    held = rows[out]
    return None, (logits(model, data, held) if len(held) else none), label[held]


def fit(sample: list[tuple[int, str]], count: dict, parts: int = PARTS) -> Model:
    """The calibrated model of a sample, all in this process (the jobs' steps in a row)."""
    prior = count.get(1, 0) / max(1, sum(count.values()))
    label, texts = np.array([int(y) for y, _ in sample], np.int64), [t for _, t in sample]
    got = [fit_part(label, texts, k, parts, prior) for k in range(parts + 1)]
    return calibrated(got[parts][0], [(z, y) for _, z, y in got[:parts]], prior)


def calibrated(model: Model | None, held: list, prior: float) -> Model:
    if model is None:
        return Model(None, 0.0, 1.0, 0.0, float(prior))
    z, y = (np.concatenate(x) for x in zip((np.empty(0), np.empty(0)), *held))
    if len(z):
        model.scale, model.shift = platt(z, y, prior)
    return model


def platt(z: np.ndarray, y: np.ndarray, prior: float) -> tuple[float, float]:
    """Logistic scale and shift by Newton steps with a small ridge; rows are weighted so
    that the classes have the shares ``prior`` and 1 - ``prior``."""
    n1 = y.sum()
    if n1 == 0 or n1 == len(y) or z.std() == 0:
        return 1.0, 0.0
    w = np.where(y == 1, prior / n1, (1 - prior) / (len(y) - n1)) * len(y)
    m, s = z.mean(), z.std()
    x = np.stack([(z - m) / s, np.ones_like(z)], 1)
    beta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        grad = x.T @ (w * (p - y)) + 0.05 * beta * [1, 0]
        hess = (x * (w * p * (1 - p))[:, None]).T @ x + np.diag([0.05, 1e-6])
        beta -= np.clip(np.linalg.solve(hess, grad), -2, 2)
    return float(beta[0] / s), float(beta[1] - beta[0] * m / s)


def trained(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str,
            folds: int, held_fold: int, per_class: dict | int, most_bytes: int):
    """The model of a bounded sample, as a broadcast variable (a fixed 1 MB)."""
    importable(docs.sparkSession)
    sample, count = labelled_rows(
        docs, labels.where(labels[label_col].isin(0, 1)), label_col, id_col=id_col,
        text_col=text_col, folds=folds, held_fold=held_fold, per_class=per_class,
        most_bytes=most_bytes)
    prior = count.get(1, 0) / max(1, sum(count.values()))
    send = docs.sparkSession.sparkContext.broadcast
    if sample is None:
        return send(calibrated(None, [], prior))

    # a number for each part that Spark's hash sends to a task of its own
    spark = docs.sparkSession
    names = part_labels(spark, max(PARTS + 1, shuffle_partitions(spark)))[:PARTS + 1]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["_y", "_at"])
        part = names.index(pdf["_part"].iloc[0])
        model, z, y = fit_part(pdf["_y"].to_numpy(np.int64), pdf["_text"].tolist(), part, PARTS, prior)
        return pd.DataFrame({
            "_part": [part], "_bucket": [None if model is None else model.bucket.tobytes()],
            "_bias": [0.0 if model is None else model.bias],
            "_z": [np.asarray(z, float).tobytes()], "_of": [np.asarray(y, float).tobytes()]})

    got = (sample.select("*", F.explode(F.array([F.lit(n).cast("long") for n in names])).alias("_part"))
           .groupBy("_part").applyInPandas(
               run, "_part int, _bucket binary, _bias double, _z binary, _of binary").collect())
    whole = next((r for r in got if r["_part"] == PARTS and r["_bucket"] is not None), None)
    model = None if whole is None else Model(
        np.frombuffer(whole["_bucket"], np.float32), whole["_bias"], 1.0, 0.0, prior)
    return send(calibrated(model, [(np.frombuffer(r["_z"]), np.frombuffer(r["_of"]))
                                   for r in got if r["_part"] < PARTS], prior))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, id_col: str = "doc_id",
               text_col: str = "text", label_col: str = "toxic", folds: int = 4,
               held_fold: int = 2, per_class: dict | int = SAMPLE,
               most_bytes: int = 40 << 20) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, all columns as they are."""
    model = trained(docs, labels, id_col, text_col, label_col, folds, held_fold, per_class,
                    most_bytes)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in pieces(whole, 2 << 20):
                yield b.filter(pa.array(model.value.score(b.column(at).to_pylist()) < threshold))

    return docs.mapInArrow(run, docs.schema)


def score_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
                    text_col: str = "text", label_col: str = "toxic", folds: int = 4,
                    held_fold: int = 2, per_class: dict | int = SAMPLE,
                    most_bytes: int = 40 << 20) -> DataFrame:
    """(id, held_out, score) for every row of ``docs``; the training bound is
    ``per_class`` rows per label value and ``most_bytes`` of text."""
    model = trained(docs, labels, id_col, text_col, label_col, folds, held_fold, per_class,
                    most_bytes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in pieces(whole, 2 << 20):
                ids = b.column(0).to_pylist()
                yield pa.RecordBatch.from_arrays([
                    pa.array(ids, pa.int64()),
                    pa.array([None if i is None else crc_fold(i, folds) == held_fold
                              for i in ids], pa.bool_()),
                    pa.array(model.value.score(b.column(1).to_pylist()), pa.float64()),
                ], ["_id", "_held_out", "_score"])

    return (docs.select(docs[id_col].cast("long").alias("_id"), docs[text_col].alias("_text"))
            .mapInArrow(run, "_id long, _held_out boolean, _score double"))
