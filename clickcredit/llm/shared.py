"""Helpers that several operators share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickcredit.session import checkpoint_root


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id long, text string) of any table; null texts become empty. Nothing else is
    kept, so extra columns can't clash with an operator's own."""
    return docs.select(docs[id_col].cast("long").alias("doc_id"),
                       F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared checkpoint folder and read it back.

    Cuts the lineage; a lost executor costs only a re-read.
    """
    spark = df.sparkSession
    path = f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Rows of an Arrow batch, where the session doesn't say: Spark's 10,000 whole texts would be
    held at once by the JVM, outside its heap, and by the Python worker."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, str(rows))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def components(edges: DataFrame) -> DataFrame:
    """Connected components of (a, b) links as (node, root), root the smallest node.

    Alternates large-star and small-star steps until no edge changes, so the number
    of rounds grows with the logarithm of a component's width. Each step groups by
    node with a plain minimum (combined before the shuffle) and joins it back, which
    adaptive execution can split, so a hub of any size is no single task's load.
    """
    edges = edges.where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = written(edges, "links")
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # Large star: each larger neighbour points to the node's smallest neighbour.
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(
            "a", F.least("a", "m").alias("m"))
        large = (both.where(F.col("b") > F.col("a")).join(least, "a")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        # Small star: each node and its smaller neighbours point to the smallest of them.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .union(least.select("a", F.col("m").alias("b")))
                 .where(F.col("a") != F.col("b")).distinct())
        after = written(small, "links")
        n, same = after.count(), after.join(edges, ["a", "b"], "left_semi").count()
        done = n == same == edges.count()
        edges = after
        if done:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
