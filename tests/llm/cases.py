"""Small tables with the awkward rows that every operator must take."""

import random
import re

SCHEMA = "doc_id long, text string, source string, lang string"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    return WORD.findall(lowered(text))


def sentence(rng, n):
    return " ".join("".join(rng.choice(("ka", "lo", "mi", "tu", "ren", "sop", "é", "wu")) for _ in range(rng.randint(1, 4)))
                    for _ in range(n))


def awkward(long_words=8000):
    """Nulls in any column, empty and very long texts, ties, repeated rows."""
    rng = random.Random(5)
    plain = sentence(rng, 60)
    return [
        (1, plain, "a", "en"), (2, plain, "a", "en"), (2, plain, "a", "en"), (3, None, "a", "en"), (4, "", "b", None),
        (5, " \t\n", None, "de"), (None, sentence(rng, 30), "b", "en"), (6, sentence(rng, long_words), "b", "fr"),
        (7, "!!! ??? ...", "a", "en"), (8, "one", "c", "en"), (9, "𝒳 ñandú 東京 one", "c", "es"), (10, plain + " tail", None, "en"),
        (None, None, None, None),
    ]


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def clashing(df, *names):
    """``df`` with extra columns called like the operator's own."""
    from pyspark.sql import functions as F
    return df.select("*", *[F.lit("mine").alias(n) for n in names])
