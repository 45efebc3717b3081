"""From ``documents`` to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
it as Parquet under the shared folder and reads it again as the next stage's
documents. All but the last stage return the columns of ``documents``.

What every stage does with odd rows: a null or empty text has no words and goes with the
first stage; a later stage given one keeps it (duplicates, decontamination), or drops
it (substring dedup, texts without words). Rows that share doc_id and text stay or
go together. A null doc_id is a document like any other, but can't be named as the
one that a group of near duplicates keeps, so it stays. Very long texts are read whole,
each in one task's memory; packing cuts their token ids into pieces. Columns beyond
those of ``documents`` are kept by all stages but the last, whatever their names. An
empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import chunk_dedup, decontaminate, packing, parity_join, quality
from tidemark.llm.store import table, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the estimated rules accept; equal texts get equal verdicts."""
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (the smallest doc_id); rows that
    share it and their text all stay."""
    return parity_join.keep_one(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Copied spans cut out of the later texts; documents left without words go."""
    from pyspark.sql import functions as F
    out = chunk_dedup.remove(docs)
    if "n_chars" in out.columns:
        out = out.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"]))
    return out.where(F.col("text").rlike(r"[^\x20\x09-\x0D]"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage, null texts among them."""
    return decontaminate.remove_documents(docs, table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents and their places in sequences; a null text is empty
    and has the end id as its one piece."""
    parts = written(packing.pieces(docs), "pieces")
    return packing.packed(parts).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontamination),
    ("best_fit_packing", best_fit_packing),
]

#: The stages hash, estimate and tokenize; SQL cannot express run()'s rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
