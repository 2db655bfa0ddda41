"""Out to files and back: what is written is read by the loaders and can be compared with what it was."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfflow.operators.facts import Tables
from shelfflow.plans import catalog
from shelfflow.sources import files
from shelfflow.sources.staging import run_folder


def _path(df: DataFrame, name: str) -> str:
    return f"{run_folder(df.sparkSession)}/exchange-{uuid.uuid4().hex}/{name}"


def reloaded(df: DataFrame, name: str, encoding: str = "UTF-8") -> DataFrame:
    """The frame as base table ``name``, written as CSV in the column order of its schema and loaded again."""
    path = _path(df, f"{name}.csv")
    files.write_csv(df.select(*files.SCHEMAS[name].names), path, encoding=encoding)
    return files.load_table(df.sparkSession, name, path, encoding)


def through_tsv(df: DataFrame) -> DataFrame:
    """The frame written as TSV and read as text, cast back to its types."""
    path = _path(df, "table.tsv")
    files.write_tsv(df, path)
    return _typed(files.read_tsv(df.sparkSession, path), df)


def through_quoted_csv(df: DataFrame) -> DataFrame:
    """The frame written as CSV with every field in quotes, read as text, cast back to its types."""
    path = _path(df, "table.csv")
    files.write_csv(df, path, quote_all=True)
    return _typed(files.read_csv(df.sparkSession, path), df)


def _typed(text: DataFrame, like: DataFrame) -> DataFrame:
    return text.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in like.schema])


def rebuilt(df: DataFrame, partition_by: str) -> DataFrame:
    """A fact table written twice to one place, as a rebuild does, and read back.

    The first version has all rows thirty days later: partitions that the second replaces, and others that must go.
    """
    path = _path(df, "fact")
    files.write_fact(df.withColumn(partition_by, F.date_add(partition_by, 30)), path, [partition_by])
    return files.write_fact(df, path, [partition_by])


def published(df: DataFrame, sql: str) -> DataFrame:
    """The answer to ``sql``, in which ``{view}`` stands for the frame registered as a view."""
    view = f"published_{uuid.uuid4().hex}"
    files.register_views({view: df})
    return df.sparkSession.sql(sql.format(view=view))


def enforced(t: Tables, names: Sequence[str], name: str) -> DataFrame:
    """Table ``name``, written after its parents with all constraints enforced and read back."""
    folder = _path(t[name], "tables")
    for n in names:
        files.write_table(t[n], n, folder)
    return files.write_table(t[name], name, folder)


def sorted_out(df: DataFrame, name: str, column: str, bad: Column, key: str) -> DataFrame:
    """The frame written as CSV with text in a number column where ``bad`` holds, loaded with rejects: key and reason of every line."""
    path = _path(df, f"{name}.csv")
    columns = files.SCHEMAS[name].names
    spoilt = df.withColumn(column, F.when(bad, F.lit("n/a")).otherwise(F.col(column).cast("string")))
    files.write_csv(spoilt.select(*columns), path)
    rows, rejects = files.load_with_rejects(df.sparkSession, name, path)
    rejected = rejects.select(F.split("line", ",")[columns.index(key)].alias(key), "reason")
    return rows.select(F.col(key).cast("string").alias(key), F.lit(None).cast("string").alias("reason")).unionByName(rejected)


def through_catalog(df: DataFrame, name: str, keys: Sequence[str]) -> DataFrame:
    """The frame as a bucketed table of the catalog, read by the name that points to it."""
    spark, database = df.sparkSession, f"exchange_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{_path(df, database)}'")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    catalog.switch(spark, database, {name: catalog.write_version(df, database, name, keys, buckets)})
    return spark.table(f"{database}.{name}")
