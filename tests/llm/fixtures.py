"""Small inputs with the awkward cases, and readers of the given tables."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SF = "/root/testdata/sf0.001"

AWKWARD = [
    (1, "One two three.\nFour five", "en", "a", 3),
    (2, "One  two\tthree. Four five ", "en", "a", None),
    (3, None, None, None, None),
    (4, "", "en", "b", 0),
    (5, " \t\n\x0b\x0c\r", "en", "b", 6),
    (6, "café naïve \U0001F600 日本語 á", "fr", None, 1),
    (6, "café naïve \U0001F600 日本語 á", "fr", None, 1),
    (None, "One two three. Four five", "en", "a", 1),
    (None, None, None, None, None),
    (9, "word " * 30000 + "end", "en", "long", 1),
    (10, "x" * 70000, "en", "long", 1),
    (-5, "One two three. Four five", "en", "a", 1),
    (12, "a<|endoftext|> b\n\n c \r\n", "en", "c", 1),
]


def awkward(spark, extra=""):
    df = spark.createDataFrame(AWKWARD, SCHEMA)
    return df.selectExpr("*", *extra.split(";")) if extra else df


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def prose(n, seed=0, vocabulary=300, low=1, high=80):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 6))) for _ in range(vocabulary)]
    return [" ".join(rng.choice(words) for _ in range(rng.randint(low, high))) for _ in range(n)]


def documents(spark, texts, first=1):
    return spark.createDataFrame([(first + i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)], SCHEMA)


def written(df, tmp_path):
    """A folder that a query can take as its tables' place."""
    df.write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)
