"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again as the next one's input.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
return the columns of ``documents``, with the values that they had (but the text and n_chars
of a document with secrets). Documents with a null or empty text are scored like any other; of all that
are left one stays, as they are copies of each other. Repeated rows and null ids are scored one by
one; of a group of copies the row of the least id stays. Columns named like those that
an operator adds are put aside while it runs. Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from predlake.llm.common import materialise, table
from predlake.llm.packing import pack_documents
from predlake.llm.quality import quality_scores
from predlake.llm.secrets import redact_secrets
from predlake.llm.simhash import one_of_each_group
from predlake.llm.toxicity import toxicity_scores


ADDED = ("score", "predicted", "held_out")   # by the operators that score


def _scored(scores, docs: DataFrame, keep: str) -> DataFrame:
    """The rows of ``docs`` that ``scores`` gives the wanted prediction, as they were."""
    aside = {c: f"_aside_{c}" for c in ADDED if c in docs.columns}
    out = scores(docs.withColumnsRenamed(aside)).where(keep).drop(*ADDED)
    return out.withColumnsRenamed({v: k for k, v in aside.items()}).select(*docs.columns)


def _quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted to be of quality 1."""
    return _scored(lambda d: quality_scores(d, table(spark, sf_dir, "labels")), docs, "predicted = 1")


def _toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents not predicted to be toxic."""
    return _scored(lambda d: toxicity_scores(d, table(spark, sf_dir, "labels")), docs, "predicted = 0")


def _dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group."""
    return one_of_each_group(docs)


def _secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced; n_chars follows the text."""
    return redact_secrets(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def _packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their bins."""
    return pack_documents(docs)


STAGES = [
    ("quality classifier", _quality),
    ("toxicity", _toxicity),
    ("simhash near-dedup", _dedup),
    ("secret scans", _secrets),
    ("best-fit packing", _packing),
]

# The stages learn from labels, hash shingles and pack bins, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
