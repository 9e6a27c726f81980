"""A corpus made ready for training: toxicity, near duplicates, benchmark leaks, personal data, packing.

Each stage takes (spark, docs, sf_dir) and gives a table; ``run`` writes it to the shared folder and reads it
again as the next stage's documents. All but the last give the columns of ``documents``. Rows without a doc_id
can be matched with no verdict, and stay. Columns beyond those of ``documents`` are carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from weirgate.llm import decontaminate, neardup, packing, pii, toxicity
from weirgate.llm.common import stage, table
from weirgate.llm.queries import SURROGATE_KEY, toxicity_model


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model, trained on the labelled ones of the corpus, does not reject."""
    return toxicity.keep_clean(docs, toxicity_model(spark, sf_dir))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the least id."""
    return neardup.keep_first(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without questions of the benchmark."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by surrogates."""
    return pii.replace(docs, SURROGATE_KEY)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("personal_data", replace_personal_data),
    ("packing", pack_sequences),
]

#: A kernel machine, sketches and keyed surrogates are beyond SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name)
    return docs
