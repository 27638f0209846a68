"""A corpus from raw documents to tokens: language, lines, near copies, sources, pieces.

Each stage takes (spark, docs, sf_dir), docs with the columns of `documents`, and returns such
documents again; the last returns tokens. `run` writes each stage's result as Parquet in the shared
folder and reads it back for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stormline.llm.langid import identify_languages
from stormline.llm.linededup import dedup_lines
from stormline.llm.mixing import mix_sources
from stormline.llm.ngram_join import keep_one_of_each
from stormline.llm.pieces import encode_samples
from stormline.llm.store import stored

LEAST_SHARE = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without letters and those of which no language has half of the letters."""
    found = identify_languages(docs, "doc_id", "text", "lang", carry=docs.columns)
    return found.where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SHARE)).select("row.*")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes repeated and nearly repeated lines out of the texts; every document stays, an emptied one with an empty text."""
    new = {"text": F.col("kept"), "n_chars": F.length("kept").cast("long")}
    edited = dedup_lines(docs, "doc_id", "text")
    return edited.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document, the first by id, of each group of near copies."""
    return keep_one_of_each(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Brings the sources to their target weights: a document stays as often as the mix takes it."""
    rest = [c for c in docs.columns if c != "doc_id"]
    mixed = mix_sources(docs, "doc_id", "source", "text", carry=rest)
    return mixed.where("copies > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select(*docs.columns)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Two sampled segmentations of each document, drawn without replacement."""
    return encode_samples(docs, "doc_id", "text")


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("mixing", mixing),
    ("sentencepiece", sentencepiece),
]

#: Fitted language weights and sampled segmentations can't be said in SQL; tests hold each stage's operator against a plain version, and the stages' columns and counts.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    _, last = STAGES[-1]
    return last(spark, docs, sf_dir)
