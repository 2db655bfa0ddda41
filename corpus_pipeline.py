"""The corpus pipeline: from raw documents to a training mix.

Each stage takes the session, the documents its predecessor kept and the folder of the other tables, and calls one
operator of ``shelfflow.llm``. All stages but the last return the columns they were given; rows and texts change:

1. language ID drops the documents that the nearest-centroid model rejects (no letters, or too far from every language);
2. line dedup removes lines repeated across documents from the texts;
3. SimHash near-dedup keeps one document of each group;
4. decontamination drops the documents that contain a benchmark item;
5. mixing returns the documents it takes words of, with the size and target of their source and the words taken.

Defined cases follow the operators: NULL texts count as empty (the first stage rejects them), documents are told by id and text, NULL
ids and sources are values like any other, and columns the operators don't know are passed on, whatever
their names. After line dedup a NULL text would be empty, and ``n_chars``, where it is a column, is counted anew. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfflow.llm import decontaminate, language, lines, mixing, simhash
from shelfflow.sources.staging import stage

# Names of the operators' own columns, so that none of the documents' columns is replaced.
OWN = "__pipeline_"


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    judged = language.identify(docs, prefix=OWN)
    return judged.filter(~F.col(f"{OWN}rejected")).select(*docs.columns)


def remove_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cleaned = lines.dedup_lines(docs, prefix=OWN)
    if "n_chars" in docs.columns:
        size = F.length("text").cast(docs.schema["n_chars"].dataType)
        cleaned = cleaned.withColumn("n_chars", size)
    return cleaned.select(*docs.columns)


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each_group(docs, shingle=3, max_bits=2)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without_benchmark(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    sized = docs.withColumn(f"{OWN}size", mixing.word_count(F.col("text")))
    mixed = mixing.mix_sources(sized, f"{OWN}size", prefix=OWN)
    names = {f"{OWN}{name}": name for name in ("size", "source_size", "target", "taken")}
    taken = mixed.filter(F.col(f"{OWN}taken") > 0).drop(*names.values())
    return taken.withColumnsRenamed(names)


STAGES = [
    ("language ID", identify_language),
    ("line dedup", remove_repeated_lines),
    ("SimHash near-dedup", remove_near_duplicates),
    ("benchmark decontamination", remove_benchmark),
    ("mixing to target weights", mix),
]

# Trained centroids and hashed candidate search have no SQL form; the stages are tested against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of a folder, each result written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, apply in STAGES:
        docs = stage(apply(spark, docs, sf_dir))
    return docs
