"""A table of awkward rows, and small readers."""

import random

from pyspark.sql import functions as F

WORDS = "the of and a to in is was river stone house green under over light old young day".split()


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(n))


LONG = prose(1, 30_000)
SHARED = prose(2, 60)
TEXTS = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one two three"), (5, SHARED), (5, SHARED),
    (6, "Before " + SHARED + " behind"), (None, SHARED), (None, None), (7, LONG),
    (8, "é ß  日本　x \x1c y\n\n" + prose(3, 40)), (9, SHARED.upper()),
    (-3, "mail a.b@c.example.org or +1 (555) 123-4567, 10.0.0.1; 4111 1111 1111 1111"),
]
CLASHING = [
    "key", "doc", "fp", "stratum", "size", "shard", "start", "ids", "names", "n_words", "score",
    "id", "starts", "spans", "bucket", "n_chars", "label", "quality", "component_id", "__row_",
]


def documents(spark, rows=TEXTS):
    """The rows as documents, with columns whose names the operators use themselves."""
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("lang", F.lit("en"))
    return df.withColumns({c: F.lit(None).cast("int") for c in CLASHING}).repartition(3)


def labels(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id bigint, quality int, toxic int")


def collected(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
