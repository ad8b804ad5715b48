"""Corpus pipeline: documents to packed training sequences in five stages.

Each stage takes ``(spark, docs, sf_dir)``; all but the last return the columns of
``documents``. What a stage returns is written as Parquet and read again as the next
one's ``docs``. Empty tables pass through every stage; rows with a null text are kept
until packing, where they are their end token. Rows that share an id are kept or dropped
alike but for the line bitmaps, which go by text; a very long text is one row all the way;
columns beyond those of ``documents`` are kept until packing, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cropscope.llm import decontamination, line_dedup, ngram_jaccard, packing, toxicity
from cropscope.llm.common import fresh, stored, table


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.3 or more go."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of 20 or more characters held by three or more documents stay in one of them;
    ``n_chars`` follows the text."""
    names = [fresh(docs.columns, c) for c in line_dedup.NAMES]
    out = line_dedup.dedup_lines(docs, names=names)
    changed, kept = F.col(names[1]) > 0, F.col(names[2])
    return out.withColumns({
        "text": F.when(changed, kept).otherwise(F.col("text")),
        "n_chars": F.when(changed, F.char_length(kept).cast("long")).otherwise(F.col("n_chars")),
    }).select(*docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group linked by a similarity of 0.8 or more on five-word shingles, the
    document with the smallest id stays; rows that share that id all do."""
    linked = ngram_jaccard.linked_documents(docs, width=5, percent=80)
    gone = stored(linked.where("_id <> _component").select(F.col("_id").alias("doc_id")).distinct(),
                  "near_duplicates")
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold 80 % or more of a benchmark item's five-word shingles go."""
    hits = decontamination.contained_items(docs, table(spark, sf_dir, "benchmark"))
    gone = stored(hits.select(F.col("_doc").alias("doc_id")).distinct(), "contaminated")
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 2048 tokens."""
    out = packing.pack(docs)
    return out.select(F.col("_id").alias("doc_id"), F.col("_start").alias("start"),
                      F.col("_length").alias("length"), F.crc32("_tokens").alias("ids_crc32"),
                      F.col("_doc_tokens").alias("doc_tokens"),
                      F.col("_sequence").alias("sequence_id"), F.col("_offset").alias("offset"))


STAGES = [
    ("toxicity", toxicity_stage),
    ("line dedup", line_dedup_stage),
    ("n-gram Jaccard join", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("packing", packing_stage),
]

#: The first stage scores with a trained model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of the last."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), f"stage_{k}")
    return docs
