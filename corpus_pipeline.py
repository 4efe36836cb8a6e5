"""From raw documents to packed training sequences.

Every stage is an operator of ``facetframe.llm`` applied to all documents that the stage before it
kept. All but the last return the columns of ``documents``; the last returns the packed pieces.
Null texts, empty tables and repeated rows have the results that the operators state; a document that
loses all its lines is left out, and of rows with one id only one can stay after near-deduplication.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from facetframe.llm import decontam, langid, lines, minhash, packing
from facetframe.llm.queries import RUNS, table
from facetframe.sources.scratch import stored

# Below an even choice between two languages and some more: the text is in none of them.
LEAST_LANGUAGE_SCORE = 0.4


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; the rest (no letters, no clear language) go."""
    labelled = docs.filter(~langid.held_out(F.col("doc_id"))).select("doc_id", "text", "lang")
    names = ("__language", "__language_score")
    found = langid.predict_languages(docs, labelled, names=names)
    kept = (F.col(names[0]) != langid.UNKNOWN) & (F.col(names[1]) >= LEAST_LANGUAGE_SCORE)
    return found.filter(kept).drop(*names)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated and nearly repeated lines leave the texts; documents left without text go."""
    cleaned = lines.without_repeated_lines(docs, edits=2, min_chars=40, exact_chars=1)
    cleaned = cleaned.filter(F.col("text").isNull() | (F.trim("text") != ""))
    if "n_chars" not in docs.columns:
        return cleaned
    kind = docs.schema["n_chars"].dataType
    return cleaned.withColumn("n_chars", F.length("text").cast(kind)).select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: the one with the least id."""
    found = minhash.near_duplicates(docs, percent=80)
    kept = found.filter("kept").select(F.col("doc_id").alias("__kept")).distinct()
    kept = docs.join(kept, F.col("doc_id").eqNullSafe(F.col("__kept")), "left_semi")
    # Rows with one id: the least text stays. Without an id, equal texts are one document.
    spread = F.when(F.col("doc_id").isNull(), F.xxhash64("text"))
    first = F.row_number().over(Window.partitionBy("doc_id", spread).orderBy("text"))
    return kept.withColumn("__first", first).filter("__first = 1").drop("__first")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold ten consecutive words of a benchmark item go."""
    return decontam.without_contaminated(docs, table(spark, sf_dir, "benchmark"), n=10)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The remaining documents as pieces of sequences of 2048 tokens."""
    return packing.pack_documents(docs)


STAGES = [
    ("language", identify_language),
    ("lines", drop_repeated_lines),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

#: Language identification and packing have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's rows written and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return docs


RUNS["pipeline"] = run
