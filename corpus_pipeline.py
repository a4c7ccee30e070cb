"""The corpus pipeline: quality, near duplicates, repeated passages, benchmark passages, token ids.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it kept; `run` writes every stage's rows
as Parquet to the shared folder and reads them again. All stages but the last return the columns of ``documents``.
A text that is changed gets its new ``n_chars``.

Every stage takes nulls in any column, empty and very long texts, repeated rows, empty tables and further columns, with
the results that its docstring or its operator's module states.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt.llm.common import ready, table
from forecourt.llm.decontaminate import decontaminate
from forecourt.llm.pieces import default_model, encoded
from forecourt.llm.quality import only_good
from forecourt.llm.simhash import one_of_each
from forecourt.llm.suffixes import deduplicate
from forecourt.session import fresh_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go; without labels, all stay. A null text is judged as an empty one."""
    return only_good(docs, table(ready(spark), sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose fingerprints are linked, the one with the smallest doc_id stays, one row only if rows repeat it.

    Null and word-free texts have one fingerprint; rows without a doc_id take no part and stay.
    """
    ready(spark)
    return one_of_each(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that a document with a smaller doc_id has too are cut out; a text that is all repeats goes.

    A null text stays null, a null doc_id is larger than any other, and rows of one doc_id don't cut one another.
    """
    ready(spark)
    left = deduplicate(docs)
    n_bytes, n_removed = (F.col(c) for c in left.columns[-4:-2])
    left = left.where((n_removed == 0) | (n_removed < n_bytes))
    n_chars = F.when(n_removed > 0, F.length("text")).otherwise(F.col("n_chars")).cast("long")
    return left.withColumn("n_chars", n_chars).select(*docs.columns)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of the benchmark are cut out; documents made of them, by over half of their words, go. Clean rows, null
    texts and repeated ones included, come back as they were."""
    return decontaminate(docs, table(ready(spark), sf_dir, "benchmark"), length="n_chars")


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per row its doc_id, the ids of its pieces, their number and digest, and whether they decode to the text.

    A null or empty text has no pieces; repeated rows give repeated results; other columns end here.
    """
    ready(spark)
    return encoded(docs, default_model(), digest=True)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("decontamination", decontaminated),
    ("token_ids", token_ids),
]

# Fingerprints, trained weights and byte-wise repeats have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage over all that the one before it kept, through a written table."""
    docs = table(ready(spark), sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            path = fresh_path(spark, f"stage-{k}-{name}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
