"""Documents with nulls, blanks, repeats, ties, long texts, and columns whose names operators use themselves."""

import random

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
rng = random.Random(7)
SYLLABLES = ["ta", "re", "mi", "so", "lu", "né", "ka", "von", "der", "est"]


def words(n: int) -> str:
    return " ".join("".join(rng.choice(SYLLABLES) for _ in range(rng.randint(2, 4))) for _ in range(n))


BASE = words(200)
PASSAGE = words(60)
EDITED = BASE.split()
EDITED[50] = "changed"
LONG = "\n".join(words(20) for _ in range(600))
ROWS = [
    (1, BASE, "en", "a", 1),
    (2, BASE, "en", "a", 1),
    (2, BASE, "en", "a", 1),
    (3, " ".join(EDITED), None, None, None),
    (4, words(80) + "\n" + PASSAGE + "\n" + words(80), "fr", "b", 2),
    (5, words(90) + " " + PASSAGE + " " + words(10), "fr", "b", 2),
    (6, None, None, None, None),
    (None, None, None, None, None),
    (None, BASE, None, "b", 3),
    (7, "", "en", "a", 0),
    (8, "!!! ??? ...", "en", "a", 3),
    (9, "Uno Dos", "es", "c", 4),
    (10, "uno   dos!", "es", "c", 4),
    (11, LONG, "de", "c", 5),
    (12, "same line\n" * 30, "de", "c", 5),
    (13, "\x00\x01 😀 " + words(30), "en", "c", 5),
    *((100 + i, f"{words(12)}\n  Shared LINE \n{words(12)}\n", "en", "hot", 6) for i in range(12)),
]
CLASHING = ("count", "chunk", "nth", "id", "content", "label", "bucket", "_h1", "_key", "_pos", "_text", "lines", "n_words", "tokens", "blob", "prints")


def documents(spark, clash: bool = False):
    df = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    return df.select("*", *(F.lit(f"own {c}").alias(c) for c in CLASHING)) if clash else df


def nothing(spark, schema: str = SCHEMA):
    return spark.createDataFrame([], schema)
