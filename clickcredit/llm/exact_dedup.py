"""Exact dedup by content sort, in DataFrame operations only.

Normalised texts (every 0x20 and 0x09-0x0D deleted) are range-partitioned by sampled
splitters over (first characters, content hash, slot) and sorted outside memory by these
and the whole text, so equal texts are neighbours. A window over equal neighbours (its
group ends where a whole text differs from the one before) counts them and keeps the
first in rank. Splitters hold a short prefix and two integers, never a text, so what the
sampler sends is bounded.

A group of copies stays in one place, slot 0, unless it is heavy: more than
``SLOT_BYTES``, or more than a quarter of an even partition's share. A heavy group
is dealt by id to as many slots as its weight asks for, so neither a task nor a window's
buffer holds all of it, and the verdicts of its slots are joined afterwards by digest. At
most ``4 * partitions + total / SLOT_BYTES`` groups can be heavy, which bounds both
broadcast tables.

Defined results: null and empty texts, and texts of white space, are one group (digest
of the empty string). Ties in length go to the smallest id; a null id loses to any
other. Rows that repeat both id and text share one decision. An empty table gives an
empty result. Extra columns are ignored by ``exact_copies`` and kept by ``drop_copies``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickcredit.llm.shared import shuffle_partitions, written

# The white space that the comparison ignores.
WHITE_SPACE = (" ", "\t", "\n", "\x0b", "\x0c", "\r")
PREFIX_CHARS = 16
SLOT_BYTES = 32 << 20
ROW_BYTES = 64


def normalised(text: Column) -> Column:
    """The text without white space; null counts as empty."""
    out = F.coalesce(text, F.lit(""))
    for c in WHITE_SPACE:
        out = F.replace(out, F.lit(c), F.lit(""))
    return out


def _slots(keyed: DataFrame, partitions: int, slot_bytes: int) -> DataFrame:
    """(content, slots) of the heavy groups; a clash of hashes only adds to a weight."""
    weights = keyed.groupBy("content").agg(F.sum("weight").alias("weight"))
    total = keyed.agg(F.sum("weight")).first()[0] or 0
    share = max(min(slot_bytes, total // (4 * partitions)), ROW_BYTES)
    return weights.where(F.col("weight") > share).select(
        "content", F.ceil(F.col("weight") / F.lit(share)).alias("slots"))


def exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 slot_bytes: int = SLOT_BYTES) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256."""
    text = docs[text_col].cast("string")
    rank = F.struct((-F.coalesce(F.length(text), F.lit(0))).alias("shorter"),
                    docs[id_col].isNull().alias("no_id"), docs[id_col].alias("doc_id"))
    # Written, so the weights, the sampler and the exchange don't normalise again.
    keyed = written(docs.select(rank.alias("rank"), normalised(text).alias("body")).select(
        "rank", "body", F.substring("body", 1, PREFIX_CHARS).alias("prefix"),
        F.xxhash64("body").alias("content"),
        (F.octet_length("body") + F.lit(ROW_BYTES)).cast("long").alias("weight")), "normalised")
    partitions = shuffle_partitions(docs.sparkSession)
    heavy = F.broadcast(_slots(keyed, partitions, slot_bytes))
    dealt = keyed.join(heavy, "content", "left").select(
        "rank", "body", "prefix", "content", F.col("slots").isNotNull().alias("heavy"),
        F.pmod(F.xxhash64("rank.doc_id"), F.coalesce("slots", F.lit(1).cast("long"))).alias("slot"))
    place = ["prefix", "content", "slot"]
    in_order = dealt.repartitionByRange(partitions, *place).sortWithinPartitions(*place, "body")
    # Same clustering and order as the range exchange: neither shuffled nor sorted again.
    equal = Window.partitionBy(*place, "body")
    judged = in_order.select(
        "rank", "heavy", F.min("rank").over(equal).alias("best"),
        F.count(F.lit(1)).over(equal).alias("n"), F.sha2("body", 256).alias("text_sha256"))
    judged = written(judged, "judged")
    joined = F.broadcast(judged.where("heavy").groupBy("text_sha256").agg(
        F.min("best").alias("all_best"), F.count(F.lit(1)).alias("all_n")))
    best = F.coalesce("all_best", "best")
    return judged.join(joined, "text_sha256", "left").select(
        F.col("rank.doc_id").alias("doc_id"), best["doc_id"].alias("keep_id"),
        F.coalesce("all_n", "n").alias("group_size"), F.col("rank").eqNullSafe(best).alias("kept"),
        "text_sha256")


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns, one for each group."""
    decisions = exact_copies(docs, id_col, text_col)
    gone = decisions.where(~F.col("kept")).select(
        F.col("doc_id").alias("__gone_id"), F.col("text_sha256").alias("__gone_sha")).distinct()
    digest = F.sha2(normalised(docs[text_col].cast("string")), 256)
    keyed = docs.withColumn("__sha", digest)
    left = keyed.join(gone, keyed[id_col].eqNullSafe(gone["__gone_id"])
                      & (keyed["__sha"] == gone["__gone_sha"]), "left_anti")
    # Rows that repeat id and text: partitioned as the join left them.
    return left.dropDuplicates([id_col, "__sha"]).drop("__sha")
