"""A corpus from raw documents to packed sequences: five stages, each written and read again before the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.llm.decontaminate import decontaminate
from marketlake.llm.language_id import keep_known_languages
from marketlake.llm.line_dedup import drop_boilerplate_lines
from marketlake.llm.near_copies import drop_near_copies
from marketlake.llm.packing import pack
from marketlake.llm.shared import drop_written, written


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents in a language that the labelled ones teach, and fills a null lang in.

    Null texts, texts without letters and texts that score under LEAST_SCORE go; if no document is labelled, all texts
    with a letter stay. Repeated rows and all columns, of any names, stay; no rows give no rows.
    """
    return keep_known_languages(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes boilerplate lines out of the texts; n_chars follows, null for a null text.

    Copies count as one page and three pages must hold a line, so that documents that others copy keep their text: which
    copy stays is the next stage's matter. Null texts and texts without a source stay as they are; repeated rows and all
    columns, of any names, stay; no rows give no rows.
    """
    cleaned = drop_boilerplate_lines(docs, min_pages=3, copies=False)
    return cleaned.withColumn("n_chars", F.length("text").cast("long"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies: 5-word shingles, similarity of 0.8 or more.

    It is the one with the smallest doc_id, null ids last, the first written of repeated rows. Null texts and those
    without words are one group. All columns, of any names, stay; no rows give no rows.
    """
    return drop_near_copies(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold an item of the benchmark.

    Null texts hold none, an empty benchmark is in no text. Repeated rows and all columns, of any names, stay; no rows
    give no rows.
    """
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into sequences of 4096 tokens; only doc_id and text are read.

    A null text is empty, repeated rows are documents of their own, null ids are kept; no rows give no rows.
    """
    return pack(docs)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: Language models, fingerprints and tokens are beyond SQL; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table documents; what each keeps goes through a Parquet table in the shared folder.

    A stage's table is deleted when the next one is written, the last when the application ends."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if before is not None:
            drop_written(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
