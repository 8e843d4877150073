"""A pipeline from raw documents to packed sequences, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read again as
the next one's documents. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finledger.llm import packing, pii, recompression, rule_ensemble, simhash
from finledger.llm.common import read_table, stored
from finledger.llm.registry import WORD_TOKENIZER, find_package


BATCH_ROWS = 1000  # rows of a batch between Spark and Python: documents are long, ids are not


def _ready(spark: SparkSession) -> None:
    find_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def _measured(docs: DataFrame) -> DataFrame:
    """n_chars as the text is now."""
    return docs.withColumn("n_chars", F.length("text").cast("bigint"))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    _ready(spark)
    return rule_ensemble.keep_good(docs, read_table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    _ready(spark)
    return simhash.keep_first(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 20 words and more that stand earlier, too, are cut out of the texts."""
    _ready(spark)
    return _measured(recompression.cut_documents(docs))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts is masked."""
    _ready(spark)
    return _measured(pii.mask_documents(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of token ids, a row per piece of a document."""
    _ready(spark)
    return packing.pack_documents(docs, WORD_TOKENIZER)


STAGES = [
    ("quality classifier", quality),
    ("near-duplicates", near_duplicates),
    ("repeated passages", repeated_passages),
    ("personal data", personal_data),
    ("packing", packed),
]

# Tokenizers, the classifier and the field of personal data have no SQL form; the tests hold
# the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
