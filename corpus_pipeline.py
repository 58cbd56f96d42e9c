"""Corpus pipeline: quality rules, near-duplicate removal, benchmark decontamination, source mixing, token file.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as Parquet and read again as the next
one's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from plumbline.llm.chosen_path import similar_documents
from plumbline.llm.common import read_table, row_and, scratch, tokenizer_path
from plumbline.llm.decontamination import decontaminated
from plumbline.llm.mixing import mixed_rows
from plumbline.llm.quality import of_quality
from plumbline.llm.token_file import read_tokens, write_tokens

END_ID = 1


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected rows go: too short, repeating themselves, or outliers of their language and source."""
    return of_quality(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of similar documents the row with the smallest ``doc_id`` stays; rows without words or ids stay."""
    stay = similar_documents(docs).filter("doc_id = class_id").select("doc_id").distinct()
    rows = row_and(docs, "doc_id", F.xxhash64("text").alias("_text"))
    # Rows that share an id are copies or different texts: of each id and text one stays.
    kept = rows.join(stay, "doc_id", "left_semi").dropDuplicates(["doc_id", "_text"])
    return kept.union(rows.filter("doc_id IS NULL").select(*kept.columns)).select("_row.*")


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of the benchmark are cut out; a document of which nothing is left goes."""
    return decontaminated(docs, read_table(spark, sf_dir, "benchmark"))


def source_mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Small sources are repeated, up to the limit; the least repeated source is taken once, so no document goes."""
    return mixed_rows(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token file of all rows, read back: start, length and checksum of each."""
    folder = scratch(spark).path("tokens")
    write_tokens(docs, folder, tokenizer_path(), END_ID)
    return read_tokens(spark, folder, digest_only=True)


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("benchmark decontamination", benchmark_passages),
    ("source mixture", source_mixture),
    ("token file", token_output),
]

#: SQL can express neither the robust estimates nor the token ids.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are written to the session's shared folder."""
    work = scratch(spark)
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = work.stage(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
