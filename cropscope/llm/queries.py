"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import (
    bpe_transducer,
    decontamination,
    hard_negatives,
    language_id,
    line_dedup,
    ngram_jaccard,
    packing,
    periodic_runs,
    pitman_yor,
    quality_classifier,
    quality_rules,
    token_counts,
    toxicity,
)
from .common import table


def op1_harmonic_packing(spark, d):
    out = packing.pack(table(spark, d, "documents"))
    return out.select(F.col("_id").alias("doc_id"), F.col("_start").alias("start"),
                      F.col("_length").alias("length"), F.crc32("_tokens").alias("ids_crc32"),
                      F.col("_doc_tokens").alias("doc_tokens"),
                      F.col("_sequence").alias("sequence_id"), F.col("_offset").alias("offset"))


def op2_ngram_jaccard(spark, d):
    out = ngram_jaccard.linked_documents(table(spark, d, "documents"))
    return out.select(F.col("_id").alias("doc_id"), F.col("_n").alias("n_shingles"),
                      F.col("_component").alias("component_id"))


def op3_decontamination(spark, d):
    out = decontamination.contained_items(table(spark, d, "documents"),
                                          table(spark, d, "benchmark"))
    return out.select(F.col("_doc").alias("doc_id"), F.col("_item").alias("item_id"),
                      F.col("_n").alias("n_shingles"), F.col("_shared").alias("n_shared"),
                      F.col("_containment").alias("containment"))


def op4_line_dedup(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text")
    out = line_dedup.dedup_lines(docs)
    return out.select("doc_id", F.col("_n_lines").alias("n_lines"),
                      F.col("_n_dropped").alias("n_dropped"),
                      F.sha2(F.col("_kept"), 256).alias("kept_sha256"))


def op8_quality_rules(spark, d):
    out = quality_rules.apply_rules(table(spark, d, "documents"), table(spark, d, "labels"))
    return out.select(F.col("_id").alias("doc_id"), *[
        F.col(f"_{c}").alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines",
                                          "n_repeat_words", "base_failed", "kept")])


def op5_pitman_yor(spark, d):
    out = pitman_yor.score_documents(table(spark, d, "documents"))
    return out.select(F.col("_id").alias("doc_id"), *[
        F.col(f"_{c}").alias(c) for c in ("held_out", "n_tokens", "n_known", "train_tokens",
                                          "base_score", "score")])


def op6_token_counts(spark, d):
    out = token_counts.count_tokens(table(spark, d, "documents"))
    return out.select(F.col("_id").alias("doc_id"), *[
        F.col(f"_{c}").alias(c) for c in ("section", "kind", "start", "end", "tokens",
                                          "crossing", "doc_tokens")])


def op7_toxicity(spark, d):
    out = toxicity.score_documents(table(spark, d, "documents"), table(spark, d, "labels"))
    return out.select(F.col("_id").alias("doc_id"), F.col("_held_out").alias("held_out"),
                      F.col("_score").alias("score"),
                      (F.col("_score") >= 0.3).cast("int").alias("predicted"))


def op9_language_id(spark, d):
    out = language_id.predict_languages(table(spark, d, "documents"))
    return out.select(F.col("_id").alias("doc_id"), F.col("_held_out").alias("held_out"),
                      F.col("_lang_pred").alias("lang_pred"), F.col("_score").alias("score"),
                      F.col("_rejected").alias("rejected"))


def op10_quality_classifier(spark, d):
    out = quality_classifier.score_documents(table(spark, d, "documents"),
                                             table(spark, d, "labels"))
    return out.select(F.col("_id").alias("doc_id"), F.col("_held_out").alias("held_out"),
                      F.col("_score").alias("score"),
                      (F.col("_score") >= 0.5).cast("int").alias("predicted"))


def op11_hard_negatives(spark, d):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    out = hard_negatives.mine(table(spark, d, "embeddings"), label=label,
                              anchor=F.col("vec_id") % 100 == 0)
    return out.select(*[F.col(f"_{a}").alias(b) for a, b in (
        ("anchor", "anchor_id"), ("positive", "positive_id"), ("rank", "rank"),
        ("negative", "negative_id"), ("positive_score", "positive_score"),
        ("negative_score", "negative_score"))])


def op12_bpe_transducer(spark, d):
    out = bpe_transducer.encode_documents(table(spark, d, "documents"))
    return out.select(F.col("_id").alias("doc_id"),
                      F.expr("octet_length(_ids) div 4").alias("n_tokens"),
                      F.sha2("_ids", 256).alias("ids_sha256"),
                      F.sha2(F.col("_decoded").cast("binary"), 256).alias("decoded_sha256"))


def op13_periodic_runs(spark, d):
    out = periodic_runs.find_runs(table(spark, d, "documents"),
                                  arrange=periodic_runs.periodic_from)
    best = periodic_runs.strongest(F.col("_runs"))
    lines = F.transform("_runs", lambda r: F.concat(
        F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return out.select(F.col("_id").alias("doc_id"), F.size("_runs").cast("long").alias("n_runs"),
                      "_runs", "_collapsed", best.alias("_best")).select(
        "doc_id", "n_runs", *[F.col("_best")[c].alias(c) for c in ("start", "length", "period")],
        F.expr("_best.length * 1000 div _best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("_collapsed").cast("binary"), 256).alias("collapsed_sha256"))


QUERIES = {
    "op1_harmonic_packing": op1_harmonic_packing,
    "op2_ngram_jaccard": op2_ngram_jaccard,
    "op3_decontamination": op3_decontamination,
    "op4_line_dedup": op4_line_dedup,
    "op5_pitman_yor": op5_pitman_yor,
    "op6_token_counts": op6_token_counts,
    "op7_toxicity": op7_toxicity,
    "op8_quality_rules": op8_quality_rules,
    "op9_language_id": op9_language_id,
    "op10_quality_classifier": op10_quality_classifier,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_bpe_transducer": op12_bpe_transducer,
    "op13_periodic_runs": op13_periodic_runs,
}

_A_Z = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_WS = r"' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

_SPACE = r"[ \t\n\x0B\f\r]+"


def _shingled(source: str, key: str, width: int) -> str:
    """Rows (key, g): the distinct ``width``-word shingles of a table's texts."""
    parts = ", ' ', ".join(f"w[i + {k}]" for k in range(width))
    return f"""(
  SELECT DISTINCT {key}, g FROM (
    SELECT {key}, CASE WHEN len(w) < {width} THEN array_to_string(w, ' ')
                       ELSE concat({parts}) END AS g
    FROM (SELECT {key}, w, unnest(range(1, greatest(len(w) - {width - 1}, 1) + 1)) AS i
          FROM (SELECT {key}, list_filter(regexp_split_to_array(
                  translate(text, {_A_Z}), '{_SPACE}'), lambda x: x <> '') AS w
                FROM {source} WHERE text IS NOT NULL) WHERE len(w) > 0)))"""


SQL = {
    "op2_ngram_jaccard": f"""
WITH RECURSIVE s AS {_shingled("documents", "doc_id", 3)},
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common
      FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM c JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y
      WHERE 100 * common >= 90 * (p.n + q.n - common)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r AS (SELECT doc_id AS x, doc_id AS y FROM documents
      UNION SELECT r.x, e.y FROM r JOIN e ON e.x = r.y)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.component_id
FROM documents d LEFT JOIN n USING (doc_id)
JOIN (SELECT x AS doc_id, min(y) AS component_id FROM r GROUP BY x) m USING (doc_id)""",
    "op3_decontamination": f"""
WITH s AS {_shingled("documents", "doc_id", 5)},
b AS {_shingled("benchmark", "item_id", 5)},
n AS (SELECT item_id, count(*) AS n FROM b GROUP BY item_id)
SELECT doc_id, item_id, any_value(n) AS n_shingles, count(*) AS n_shared,
       count(*) / any_value(n) AS containment
FROM s JOIN b USING (g) JOIN n USING (item_id)
GROUP BY doc_id, item_id HAVING count(*) * 100 >= any_value(n) * 80""",
    "op4_line_dedup": f"""
WITH l AS (
  SELECT doc_id, u.i AS pos, u.line AS line,
         translate(trim(u.line, {_WS}), {_A_Z}) AS k
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
       LATERAL (SELECT unnest(ls) AS line, generate_subscripts(ls, 1) AS i) u),
f AS (
  SELECT k, max(doc_id) AS keeper FROM l WHERE length(k) >= 20
  GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
m AS (
  SELECT l.doc_id, l.pos, l.line, f.k IS NOT NULL AND f.keeper <> l.doc_id AS gone
  FROM l LEFT JOIN f ON l.k = f.k)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CAST(gone AS INT)) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), ''))
         AS kept_sha256
FROM m GROUP BY doc_id""",
    "op11_hard_negatives": """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS y,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS a, b.vec_id AS b, a.y = b.y AS same,
         CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM e a JOIN e b ON a.vec_id <> b.vec_id OR a.y <> b.y WHERE a.vec_id % 100 = 0),
p AS (
  SELECT a, b, score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, b) <= 5)
SELECT p.a AS anchor_id, p.b AS positive_id,
       CAST(row_number() OVER (PARTITION BY p.a, p.b ORDER BY n.score DESC, n.b) AS INT) AS rank,
       n.b AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM p JOIN s n ON n.a = p.a AND NOT n.same
  AND 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score
QUALIFY rank <= 5""",
}
