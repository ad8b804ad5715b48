"""Quality classifier (operator 10): positive-unlabelled learning.

Trusted positives (label 1) and unlabelled web text train a small network by the
non-negative unbiased risk: ``prior * R(P, +) + max(0, R(U, -) - prior * R(P, -))``.
No text is ever used as a negative example; labels other than 1 only enter the
estimate of the class prior, a count over all labelled rows. When the negative part
of the risk falls below zero the step ascends it instead, which stops overfitting.

The inputs of a score are character and word statistics of the whole text. Defined
cases: empty and null text score 0; without positives or without text every score is
the prior (0 with no labels); null labels or ids do not teach; rows that share an id are
scored separately; a very long text is read whole; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_fold, fold_of, importable, labelled_sample, pieces

ASCII = 128
HIDDEN = 16


def text_features(text: str) -> np.ndarray:
    """Shares of ASCII characters, and word and line statistics, of one text."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    hist = np.bincount(raw, minlength=256)
    low = hist[:ASCII].astype(np.float64)
    letters = low[65:91].sum() + low[97:123].sum() + hist[ASCII:].sum()
    low[97:123] += low[65:91]  # letters by identity, case as one share below
    upper = low[65:91].sum()
    low[65:91] = 0
    words = text.split()
    n = max(1, len(words))
    lines = [x for x in text.split("\n") if x.strip()]
    pairs = len(set(zip(words, words[1:])))
    shape = [np.log1p(len(words)), len(set(words)) / n, pairs / max(1, len(words) - 1),
             len(set(lines)) / max(1, len(lines)), upper / max(1, letters),
             letters / max(1, len(raw)), letters / n, len(lines) / n,
             sum(a == b for a, b in zip(words, words[1:])) / n]
    return np.concatenate([np.sqrt(low / max(1, len(raw))), shape])


class Model:
    def __init__(self, mean, std, w1, b1, w2, b2, prior):
        self.mean, self.std, self.w1, self.b1 = mean, std, w1, b1
        self.w2, self.b2, self.prior = w2, b2, prior

    def score(self, texts: list[str | None]) -> np.ndarray:
        out = np.zeros(len(texts))
        at = [i for i, t in enumerate(texts) if t and not t.isspace()]
        if self.w1 is None:
            out[:] = self.prior
        elif at:
            x = np.stack([text_features(texts[i]) for i in at])
            out[at] = 1 / (1 + np.exp(-np.clip(self.logit(self.scaled(x)), -30, 30)))
        return out

    def scaled(self, x):
        return np.clip((x - self.mean) / self.std, -8, 8)

    def logit(self, x):
        return np.tanh(x @ self.w1 + self.b1) @ self.w2 + self.b2


def fit(positive: list[str], unlabelled: list[str], prior: float, epochs: int = 60,
        batch: int = 128, rate: float = 0.005, decay: float = 1e-4, seed: int = 3) -> Model:
    """Minimise the non-negative risk with Adam; ``beta`` = 0, ``gamma`` = 1."""
    positive = [t for t in positive if t and not t.isspace()]
    unlabelled = [t for t in unlabelled if t and not t.isspace()]
    if not positive or not unlabelled:
        return Model(None, None, None, None, None, None, float(prior))
    xp = np.stack([text_features(t) for t in positive])
    xu = np.stack([text_features(t) for t in unlabelled])
    mean, std = xu.mean(0), xu.std(0) + 1e-3
    rng = np.random.default_rng(seed)
    d = xp.shape[1]
    m = Model(mean, std, rng.normal(0, d ** -0.5, (d, HIDDEN)), np.zeros(HIDDEN),
              rng.normal(0, HIDDEN ** -0.5, HIDDEN), np.zeros(1), float(prior))
    xp, xu = m.scaled(xp), m.scaled(xu)
    params = [m.w1, m.b1, m.w2, m.b2]
    m1, m2 = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    steps, t = max(1, len(xu) // batch), 0
    for _ in range(max(epochs, -(-1500 // steps))):
        ou, op = rng.permutation(len(xu)), rng.permutation(len(xp))
        for s in range(steps):
            u = xu[ou[s * batch:(s + 1) * batch]]
            p = xp[np.take(op, np.arange(s * batch, (s + 1) * batch), mode="wrap")]
            x = np.concatenate([p, u])
            h = np.tanh(x @ m.w1 + m.b1)
            sig = 1 / (1 + np.exp(-np.clip(h @ m.w2 + m.b2, -30, 30)))
            sp, su = sig[:len(p)], sig[len(p):]
            # logistic loss: against a wanted + it is -log sig, against a wanted - -log(1 - sig)
            neg = -np.log1p(-np.minimum(su, 1 - 1e-9)).mean() \
                + prior * np.log1p(-np.minimum(sp, 1 - 1e-9)).mean()
            g_neg = np.concatenate([-prior * sp / len(p), su / len(u)])
            g_pos = np.concatenate([prior * (sp - 1) / len(p), np.zeros(len(u))])
            g = (g_pos + g_neg) if neg >= 0 else -g_neg
            gh = np.outer(g, m.w2) * (1 - h ** 2)
            t += 1
            for i, (w, gr) in enumerate(zip(params, (x.T @ gh, gh.sum(0), h.T @ g,
                                                     np.array([g.sum()])))):
                gr = gr + decay * w * (w.ndim > 1)
                m1[i] = 0.9 * m1[i] + 0.1 * gr
                m2[i] = 0.999 * m2[i] + 0.001 * gr ** 2
                w -= rate * (m1[i] / (1 - 0.9 ** t)) / (np.sqrt(m2[i] / (1 - 0.999 ** t)) + 1e-8)
    return m


def score_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
                    text_col: str = "text", label_col: str = "quality", folds: int = 3,
                    held_fold: int = 1, per_class: int = 3000, most_bytes: int = 24 << 20,
                    default_prior: float = 0.8, caution: float = 0.96) -> DataFrame:
    """(id, held_out, score) for every row. The training bound is ``per_class`` trusted
    positives and as many unlabelled texts, ``most_bytes`` of text each. The class prior
    is the share of label 1 among labelled rows outside the held-out fold, or
    ``default_prior`` where the labels hold positives only, times ``caution``: a prior
    set too high would let the risk write negatives off as positives."""
    importable(docs.sparkSession)
    known = labels.where(F.col(label_col).isin(0, 1))
    sample, count = labelled_sample(
        docs, known.where(F.col(label_col) == 1), label_col, id_col=id_col, text_col=text_col,
        folds=folds, held_fold=held_fold, per_class=per_class, most_bytes=most_bytes)
    web, _ = labelled_sample(
        docs.select(id_col, text_col, F.lit(0).alias("_any")), None, "_any", id_col=id_col,
        text_col=text_col, folds=folds, held_fold=held_fold, per_class=per_class,
        most_bytes=most_bytes)
    zeros = known.where((F.col(label_col) == 0)
                        & (fold_of(F.col(id_col), folds) != held_fold)).select(id_col).distinct()
    n1, n0 = count.get(1, 0), zeros.count()
    prior = caution * (n1 / (n1 + n0) if n0 else (default_prior if n1 else 0.0))
    model = docs.sparkSession.sparkContext.broadcast(
        fit([t for _, t in sample], [t for _, t in web], prior))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in pieces(whole):
                ids = b.column(0).to_pylist()
                yield pa.RecordBatch.from_arrays([
                    pa.array(ids, pa.int64()),
                    pa.array([None if i is None else crc_fold(i, folds) == held_fold
                              for i in ids], pa.bool_()),
                    pa.array(model.value.score(b.column(1).to_pylist()), pa.float64()),
                ], ["_id", "_held_out", "_score"])

    return (docs.select(docs[id_col].cast("long").alias("_id"), docs[text_col].alias("_text"))
            .mapInArrow(run, "_id long, _held_out boolean, _score double"))
