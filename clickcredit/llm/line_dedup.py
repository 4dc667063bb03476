"""Repeated runs of lines, with content-defined chunks; DataFrame operations only.

A rolling hash over the hashes of the last two lines ends a chunk where it is 0 modulo
``divisor``. A boundary depends on those two lines alone, so lines put in before it move
it along and leave later chunks as they were. But the edges of a chunk at the edge of a
repeated passage depend on lines outside it, and a passage of two lines need not hold a
whole chunk. So chunks of two lines are taken in every phase, one from each line on: a line
goes if it and a neighbour occur together again, in the same or another document; the
occurrence with the smallest id (then the first in the text) stays. A repeated run of two
lines or more consists of such pairs, so it goes whole, and so does each repeated
content-defined chunk of two lines or more. The first occurrence of a line always stays.

Pairs meet by the hashes of their lines; the lines of repeated pairs are then compared as
bytes, by grouping. A hash under which two different lines meet removes nothing. Counts
are combined before the shuffle, so a pair that a third of all documents hold is one row
per task.

Defined results: null and empty texts have one empty line and lose nothing. Of a pair of
lines one must hold a visible character; two lines without go only if the content-defined
chunk of the first holds one and occurs again with them. A line that is alike in two
places but has no neighbour alike stays. ``n_chunks`` counts content-defined chunks,
``n_removed_chunks`` those that lose lines, whole or in part. Rows that repeat an id are
occurrences of their own if their texts differ; equal rows count as one. Null ids sort
last. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickcredit.llm.shared import id_and_text, written

DIVISOR = 3
VISIBLE = r"[^\x20\x09-\x0D]"


def _rotated(h: Column) -> Column:
    return F.shiftleft(h, 1).bitwiseOR(F.shiftrightunsigned(h, 63))


def _chunks(text: Column, divisor: int) -> Column:
    """The chunks of a text, each its lines with a space before and joined by line ends.

    Every line begins with a space, so an empty line between two lines can only be a
    boundary and one split finds the chunks. Each array is used once, never inside a
    lambda over another, so the work is linear in the text.
    """
    lines = F.split(text, "\n", -1)
    hashes = F.transform(lines, lambda x: F.xxhash64(x))
    missing = F.lit(None).cast("long")
    zipped = F.arrays_zip(lines.alias("line"),
                          F.concat(F.array(missing), F.slice(hashes, 1, F.size(lines) - 1)).alias("h"),
                          F.slice(F.concat(F.array(missing, missing), hashes), 1, F.size(lines)).alias("g"))

    def marked(x: Column) -> Column:
        rolled = _rotated(F.coalesce(x["g"], F.lit(0).cast("long"))).bitwiseXOR(x["h"])
        begins = F.coalesce(F.pmod(rolled, F.lit(divisor)) == 0, F.lit(False))
        return F.concat(F.when(begins, "\n ").otherwise(" "), x["line"])

    return F.split(F.array_join(F.transform(zipped, marked), "\n"), "\n\n", -1)


def _both(at: Column | str) -> Column:
    """The places of both lines of the pairs at ``at``."""
    return F.array_union(at, F.transform(at, lambda i: i + 1))


def _lines(text: Column, divisor: int) -> Column:
    """Array of (line, chunk, whole): each line with a space before, the number of its
    chunk and the chunk's hash, null if the chunk holds no visible character."""
    chunks = F.transform(_chunks(text, divisor), lambda c, k: F.struct(
        F.split(c, "\n", -1).alias("lines"), k.alias("chunk"),
        F.when(c.rlike(VISIBLE), F.xxhash64(c)).alias("whole")))
    return F.flatten(F.transform(chunks, lambda x: F.transform(x["lines"], lambda line: F.struct(
        line.alias("line"), x["chunk"].alias("chunk"), x["whole"].alias("whole")))))


def _pairs(texts: DataFrame, divisor: int) -> DataFrame:
    """(doc_id, row, at, a, b, c) of every two neighbouring lines that may go: the hashes of
    both, and that of the first one's chunk where neither holds a visible character."""
    hashed = texts.select("doc_id", "row", F.transform(_lines(F.col("text"), divisor), lambda x: F.struct(
        F.xxhash64(x["line"]).alias("h"), x["line"].rlike(VISIBLE).alias("seen"), x["whole"].alias("whole"))).alias("x"))
    pairs = F.zip_with("x", F.slice("x", 2, F.size("x")), lambda x, y: F.struct(
        x["h"].alias("a"), y["h"].alias("b"),
        F.when(x["seen"] | y["seen"], F.lit(0).cast("long")).otherwise(x["whole"]).alias("c")))
    return (hashed.select("doc_id", "row", F.posexplode(pairs).alias("at", "pair"))
            .select("doc_id", "row", "at", "pair.*").where("b IS NOT NULL AND c IS NOT NULL"))


def dedup_chunks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 divisor: int = DIVISOR) -> DataFrame:
    """doc_id, n_lines, n_chunks, n_removed_chunks, n_removed_lines, kept_text of each row."""
    texts = id_and_text(docs, id_col, text_col).withColumn("row", F.xxhash64("text"))
    pairs = _pairs(texts, divisor)
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row", "at")
    repeated = (pairs.groupBy("a", "b", "c").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
                .where("n > 1").drop("n"))
    # Written, so the tests of bytes below read repeated pairs only.
    hits = written(pairs.join(repeated, ["a", "b", "c"]).select(
        "doc_id", "row", "at", "a", "b", place.eqNullSafe(F.col("first")).alias("stays")), "pairs")

    def with_texts(marks: DataFrame, how: str) -> DataFrame:
        marks = marks.withColumnsRenamed({"doc_id": "mark_id", "row": "mark_row"})
        return texts.join(marks, texts["doc_id"].eqNullSafe(marks["mark_id"])
                          & (texts["row"] == marks["mark_row"]), how).drop("mark_id", "mark_row")

    # The bytes of all lines of repeated pairs, first occurrences too.
    marked = with_texts(hits.groupBy("doc_id", "row").agg(F.collect_set("at").alias("at")), "inner").select(
        "at", _lines(F.col("text"), divisor).alias("lines"))
    line = F.explode(F.transform(_both("at"), lambda i: F.get(F.col("lines"), i)["line"])).alias("line")
    clashes = (marked.select(line).distinct().groupBy(F.xxhash64("line").alias("h"))
               .agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h"))
    gone = (hits.where(~F.col("stays"))
            .join(clashes, F.col("a") == F.col("h"), "left_anti")
            .join(clashes, F.col("b") == F.col("h"), "left_anti")
            .groupBy("doc_id", "row").agg(F.collect_set("at").alias("gone")))

    cut = with_texts(gone, "left").select(
        "doc_id", _both(F.coalesce("gone", F.array().cast("array<int>"))).alias("gone"),
        _lines(F.col("text"), divisor).alias("lines"))
    # Named more than once, so ``lines`` is not computed again inside the lambdas.
    kept = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone"))
    kept_lines = F.transform(kept, lambda i: F.substr(F.get(F.col("lines"), i)["line"], F.lit(2)))
    touched = F.array_distinct(F.transform("gone", lambda i: F.get(F.col("lines"), i)["chunk"]))
    return cut.select(
        "doc_id", F.size("lines").alias("n_lines"), (F.element_at("lines", -1)["chunk"] + 1).alias("n_chunks"),
        F.size(touched).alias("n_removed_chunks"), F.size("gone").alias("n_removed_lines"),
        F.array_join(kept_lines, "\n").alias("kept_text"))
