"""Small frames for the tests of the operators on training data."""

import os
import random

FOLDER = "/root/testdata/sf0.001"
HAS_DATA = os.path.isdir(FOLDER)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Names that operators use for their own columns, or might.
CLASHES = ("row", "id", "rid", "site", "hash", "line", "copy", "n_copies", "words", "score", "bands", "key", "part", "k", "kept", "lang_pred", "Lang_Score", "_lang_pred")


def words(n, seed, vocabulary=400):
    rng = random.Random(seed)
    return " ".join(rng.choice("abcdefgh") + str(rng.randrange(vocabulary)) for _ in range(n))


def odd_rows():
    """Nulls in every column, empty and very long texts, ties, repeated rows."""
    long = "\n".join(words(40, i) for i in range(400))
    rows = [
        (1, None, "en", "s1", 0),
        (2, "", "en", "s1", 0),
        (3, "   \n\t ", None, None, None),
        (4, long, "en", "s2", len(long)),
        (5, "x" * 30_000, "de", "s3", 30_000),
        (6, words(60, 1), "en", "s1", 1),
        (6, words(60, 1), "en", "s1", 1),
        (7, words(60, 1), "fr", "s2", 1),
        (None, words(60, 1), "fr", None, 1),
        (None, words(30, 2), None, "s4", 1),
        (8, "É 日本語 😀 ▁ <|endoftext|>", "ja", "s5", 5),
        (9, "a", "en", "s1", 1),
    ]
    return rows


def odd(spark, clashes=True):
    df = spark.createDataFrame(odd_rows(), SCHEMA)
    if clashes:
        for name in CLASHES:
            df = df.withColumn(name, df["n_chars"].cast("string"))
    return df


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
