"""The corpus pipeline: from raw documents to packed training sequences.

Every stage works on all that the stage before it kept, and all but the last return documents' columns.
A stage's result is written as Parquet in the shared folder and read again as the next one's input. The last
returns the packed sequences with their texts; it stays in the shared folder until that is cleared.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.common import free_name, stage, unstage
from tickloom.llm.mixing import mix
from tickloom.llm.packing import sequences
from tickloom.llm.pii import replace_pii, session_key
from tickloom.llm.simhash import one_of_each
from tickloom.llm.toxicity import toxicity

#: A document is toxic from this score on.
TOXIC = 0.7


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weakly supervised classifier does not call toxic.

    Null and empty texts are scored like any other; repeated rows fall or stay together. Without labels of both
    classes only the fixed lexicon decides.
    """
    score = free_name(docs, "toxicity")
    scored = toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), score=score)
    return scored.where(F.col(score) < TOXIC).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints are linked, by op10's fingerprints and radius.

    The smallest id stays, null ids last, and of equal rows one; null, empty and blank texts are one group.
    """
    return one_of_each(docs)


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, entities replaced by surrogates; n_chars follows the text. Null texts stay null."""
    out = replace_pii(docs, session_key(spark), count=None)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, in its order; one that it takes twice is there twice.

    A document without words counts nothing; a null source is a source of its own.
    """
    return mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The training sequences: bin_id, n_words, doc_ids and text. Every word of the mix is in one of them, as often
    as the mix holds it. No documents, no sequences."""
    return sequences(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash near-dedup", drop_near_duplicates),
    ("pii", replace_personal_data),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: The stages learn, hash and draw: SQL cannot express them; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, apply in STAGES:
        out = stage(apply(spark, docs, sf_dir), name.replace(" ", "-"))
        if before is not None:
            unstage(before)
        docs = before = out
    return docs
