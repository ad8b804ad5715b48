"""Token counts (operator 6): offset-mapped attribution to fields and sections.

A record is rendered once (its fields, then its text) and encoded whole, so counts are
those of the sequence a model would see; a special token spelt in it is one token. Token character spans are interval-joined to
the sections' spans, which tile the rendered text; a token that crosses a boundary goes
to one section by an explicit rule:

``first``  the section of its first character,
``last``   the section of its last character,
``most``   the section holding most of its characters, the earlier one on a tie.

Every token is counted exactly once, so a document's sections sum to its tokens.

Defined cases: a null field or text is empty; an empty section gets a row with 0
tokens; an empty record gives only such rows; an empty table gives none; rows that share
an id are counted separately, a null id is kept; a very long text is encoded whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import importable, pieces
from .tokens import encode_spans, vocabulary_paths

RULES = ("first", "last", "most")


def attribute(starts: np.ndarray, ends: np.ndarray, bounds: np.ndarray, rule: str
              ) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, boundary-crossing tokens) per section; section i is the characters
    ``bounds[i]`` to ``bounds[i+1]``, and every token lies within the bounds."""
    sections = len(bounds) - 1
    first = np.searchsorted(bounds, starts, side="right") - 1
    last = np.searchsorted(bounds, ends - 1, side="right") - 1
    crossing = first != last
    owner = (last if rule == "last" else first).copy()
    if rule == "most":
        for t in np.nonzero(crossing)[0]:
            cut = np.clip(bounds[first[t]:last[t] + 2], starts[t], ends[t])
            owner[t] = first[t] + int(np.argmax(np.diff(cut)))
    return (np.bincount(owner, minlength=sections),
            np.bincount(owner[crossing], minlength=sections))


def count_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 field_cols: tuple[str, ...] = ("source", "lang"), rule: str = "most",
                 paths: tuple[str, str] | None = None) -> DataFrame:
    """(id, section, kind, start, end, tokens, crossing, doc_tokens) per section.
    Sections are each field with its line end, then each line of the text with its line
    end; ``kind`` is the field's name or ``text``; offsets count code points of the
    rendered record."""
    if rule not in RULES:
        raise ValueError(f"rule is one of {RULES}")
    importable(docs.sparkSession)
    paths = paths or vocabulary_paths()
    kinds = list(field_cols)

    def one(doc, fields, text):
        lines = (text or "").split("\n")
        rendered = [f"{f or ''}\n" for f in fields]
        rendered += [x + "\n" for x in lines[:-1]] + [lines[-1]]
        bounds = np.concatenate(([0], np.cumsum([len(x) for x in rendered])))
        _, s, e = encode_spans("".join(rendered), paths)
        n, shared = attribute(s, e, bounds, rule)
        return bounds, n, shared, len(s)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in pieces(whole, 2 << 20):
                cols = [c.to_pylist() for c in b.columns]
                ids, sec, kind, st, en, tok, sh, tot = [], [], [], [], [], [], [], []
                for doc, text, *fields in zip(*cols):
                    bounds, n, shared, total = one(doc, fields, text)
                    k = len(n)
                    ids += [doc] * k
                    sec.append(np.arange(k))
                    kind += kinds + ["text"] * (k - len(kinds))
                    st.append(bounds[:-1])
                    en.append(bounds[1:])
                    tok.append(n)
                    sh.append(shared)
                    tot.append(np.full(k, total))
                if ids:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids, pa.int64()), pa.array(np.concatenate(sec), pa.int64()),
                         pa.array(kind, pa.string()),
                         *[pa.array(np.concatenate(x), pa.int64())
                           for x in (st, en, tok, sh, tot)]],
                        ["_id", "_section", "_kind", "_start", "_end", "_tokens", "_crossing",
                         "_doc_tokens"])

    return (docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"),
                        *[F.col(c).cast("string").alias(f"_f{i}") for i, c in enumerate(kinds)])
            .mapInArrow(run, "_id long, _section long, _kind string, _start long, _end long, "
                             "_tokens long, _crossing long, _doc_tokens long"))
