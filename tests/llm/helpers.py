"""Small corpora for the operator tests."""

import random

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "score double, n_words string, label string, a int, b int")


def docs_frame(spark, rows):
    """Documents with columns whose names clash with what operators add or join on."""
    return spark.createDataFrame(
        [(i, t, "xx", "s", None if t is None else len(t), 0.5, "w", "l", 1, 2) for i, t in rows],
        SCHEMA)


def words(rng: random.Random, n: int, vocabulary: int = 400) -> list[str]:
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]
