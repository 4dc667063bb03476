"""Jaccard self-join of word 5-gram sets by vertical partitioning.

All n-grams share one global order: frequency (the count, over all documents, of the
n-gram's cell, one of a fixed number), then hash, rare first. Two sets with a similarity of 0.8 or more
share an n-gram within the first n - ceil(0.8 n) + 1 of both, so only those prefixes are
shuffled to find candidates. The order is cut into fragments; a candidate pair's overlap
is counted in each fragment on its own and the partial counts are summed per pair.

Sets, not documents, are joined: equal sets share a node (64 bits of the set's hash), so
copies add no pairs. In a group of sets that share an n-gram, each set is first compared
with a few leaders only; groups of near copies thereby fall into one component. Then all
remaining pairs of a group that lie in different components are compared, none left out.
Two lossless tests drop pairs before their sets are moved: the sizes' ratio, and parity
bitmaps, whose Hamming distance never exceeds the size of the symmetric difference. The join
that makes all remaining pairs tests the sizes, the places of the shared n-gram and a bitmap of
fixed size itself.

The result is the join's connected components, not its pairs: pairs that already lie in one
component are skipped, so neither similarities nor a document's number of links is known.

Defined results: A-Z are lower-cased; a text of one to four words is one n-gram; a null
or empty text, or one of white space, has an empty set, n_shingles 0 and its own id as
component. Rows that repeat an id each give a row, with the component of their own set;
a null id never names a component unless no other id is in it. ``drop_near`` treats rows of
equal id and text as one document. An empty table gives an empty result. Extra columns are ignored by ``link_documents`` and kept by ``drop_near``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickcredit.llm.shared import components, id_and_text, small_batches, written
from clickcredit.llm.words import Words, find_words, mix64, runs, slices

NGRAM = 5
CELL_BITS = 18  # cells of the n-gram counts; fixed, so their total is bounded
LEADERS = 3
ROUNDS = 2
CELL_WORDS = 16  # longs of the bitmap of fixed size that the last join tests
SEGMENT_BITS = 2  # fragments for each of the rare and the frequent n-grams


def _shingles(words: Words) -> Iterator[np.ndarray]:
    """The distinct n-gram hashes of each document, ascending."""
    hashes = words.hashes()
    grams = runs(hashes, NGRAM)
    for lo, hi in zip(words.bounds[:-1], words.bounds[1:], strict=True):
        n = hi - lo
        if n >= NGRAM:
            found = np.sort(grams[lo:hi - NGRAM + 1])
            first = np.empty(len(found), dtype=bool)
            first[0] = True
            np.not_equal(found[1:], found[:-1], out=first[1:])
            yield found[first]
        elif n:
            yield mix64(runs(hashes[lo:hi], int(n)) + np.uint64(n))
        else:
            yield np.zeros(0, np.uint64)


def _sets(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    for first, _, data, offsets in slices(batch["text"]):
        for i, s in enumerate(_shingles(find_words(data, offsets, lower=True))):
            yield first + i, s


def _node(s: np.ndarray) -> int:
    """Signed 64-bit name of a set."""
    total = np.array([s.sum(dtype=np.uint64), len(s)], np.uint64)
    return int(mix64(mix64(total[:1]) + total[1:] + np.bitwise_xor.reduce(mix64(s)))
               .view(np.int64)[0])


def _bitmap(s: np.ndarray) -> bytes:
    """Parity of the set's members in each of 2**k cells, at least one cell a member."""
    cells = 1 << max(6, (len(s) - 1).bit_length())
    parity = np.bincount((s & np.uint64(cells - 1)).astype(np.int64), minlength=cells) & 1
    return np.packbits(parity.astype(np.uint8)).tobytes()


def _small_bitmap(s: np.ndarray) -> list[int]:
    """Parity of the set's members in each of CELL_WORDS * 64 cells."""
    cells = CELL_WORDS * 64
    parity = np.bincount((s & np.uint64(cells - 1)).astype(np.int64), minlength=cells) & 1
    return np.packbits(parity.astype(np.uint8)).view(np.int64).tolist()


def _may_link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows whose bitmaps differ in no more cells than the sets may in members."""
    for batch in batches:
        n = batch["n_a"].to_numpy() + batch["n_b"].to_numpy()
        keep = np.empty(batch.num_rows, dtype=bool)
        for i, (a, b) in enumerate(zip(batch["bitmap_a"], batch["bitmap_b"], strict=True)):
            x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (a, b))
            size = min(len(x), len(y))  # cells of the finer one, halved, are those of the other
            differ = np.bitwise_xor.reduce(x.reshape(-1, size)) ^ np.bitwise_xor.reduce(y.reshape(-1, size))
            # overlap >= 4/9 (n_a + n_b), so the symmetric difference is at most a ninth.
            keep[i] = 9 * int(np.bitwise_count(differ).sum()) <= n[i]
        yield batch.drop_columns(["bitmap_a", "bitmap_b"]).filter(pa.array(keep))


def _prefix_size(n: int) -> int:
    return n - (4 * n + 4) // 5 + 1


class _Order:
    """The global order: count of an n-gram's cell, then hash."""

    def __init__(self, counts: np.ndarray):
        self.counts = np.minimum(counts, np.iinfo(np.uint32).max).astype(np.uint32)
        self.usual = 2 * counts.mean()

    def counts_of(self, s: np.ndarray) -> np.ndarray:
        return self.counts[s >> np.uint64(64 - CELL_BITS)]

    def prefix(self, s: np.ndarray) -> np.ndarray:
        return s[np.argsort(self.counts_of(s), kind="stable")[:_prefix_size(len(s))]]

    def fragments(self, s: np.ndarray) -> np.ndarray:
        return ((self.counts_of(s) > self.usual).astype(np.int32) << SEGMENT_BITS) + (
            s >> np.uint64(64 - SEGMENT_BITS)).astype(np.int32)


def _count_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(1 << CELL_BITS, np.int64)
    for batch in batches:
        for _, _, data, offsets in slices(batch["text"]):
            words = find_words(data, offsets, lower=True)
            grams = runs(words.hashes(), NGRAM)
            counts += np.bincount((grams >> np.uint64(64 - CELL_BITS)).astype(np.int64),
                                  minlength=len(counts))
    used = np.flatnonzero(counts)
    yield pa.record_batch({"cell": used.astype(np.int32), "n": counts[used]})


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, content, n, node, bitmap, cells) of each row."""
    for batch in batches:
        n, node, bitmap, cells = [], [], [], []
        for _, s in _sets(batch):
            n.append(len(s))
            node.append(_node(s) if len(s) else None)
            bitmap.append(_bitmap(s) if len(s) else None)
            cells.append(_small_bitmap(s) if len(s) else None)
        yield pa.record_batch({"doc_id": batch["doc_id"], "content": batch["content"],
                               "n": pa.array(n, pa.int64()),
                               "node": pa.array(node, pa.int64()),
                               "bitmap": pa.array(bitmap, pa.binary()),
                               "cells": pa.array(cells, pa.list_(pa.int64()))})


def _prefixes(order: _Order):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, nodes, counts, places, seen = [], [], [], [], set()
            for _, s in _sets(batch):
                if len(s) and (node := _node(s)) not in seen:
                    seen.add(node)
                    hashes.append(order.prefix(s))
                    nodes.append(node)
                    counts.append(len(hashes[-1]))
                    places.append(np.arange(counts[-1]))
            h = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
            yield pa.record_batch({"h": h.view(np.int64),
                                   "node": np.repeat(np.array(nodes, np.int64), counts),
                                   "place": np.concatenate([np.zeros(0, np.int64), *places])})

    return emit


def _segments(order: _Order):
    """(node, fragment, grams) of rows that hold the node's set."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = batch["node"].to_pylist()
            nodes, fragments, grams = [], [], []
            for i, s in _sets(batch):
                if not len(s) or _node(s) != wanted[i]:
                    continue
                fragment = order.fragments(s)
                for f in np.unique(fragment).tolist():
                    nodes.append(wanted[i])
                    fragments.append(f)
                    grams.append(s[fragment == f].view(np.int64))
            yield pa.record_batch({"node": pa.array(nodes, pa.int64()),
                                   "fragment": pa.array(fragments, pa.int32()),
                                   "grams": pa.array(grams, pa.list_(pa.int64()))})

    return emit


def _possible(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs (a, b) that sizes and bitmaps don't rule out, with both sizes."""
    size = lambda x: nodes.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"))
    bits = lambda x: nodes.select(F.col("node").alias(x), F.col("bitmap").alias(f"bitmap_{x}"))
    tested = (pairs.join(size("a"), "a").join(size("b"), "b")
              .where("5 * least(n_a, n_b) >= 4 * greatest(n_a, n_b)"))
    names = tested.columns
    both = tested.join(bits("a"), "a").join(bits("b"), "b").select(*names, "bitmap_a", "bitmap_b")
    return both.mapInArrow(_may_link, tested.schema)


def _nodes_of(pairs: DataFrame) -> DataFrame:
    return (pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node")))
            .distinct())


def _sets_of(wanted: DataFrame, texts: DataFrame, nodes: DataFrame, order: _Order) -> DataFrame:
    """(node, fragment, grams) of the wanted nodes, each from its first document."""
    # Written, so that its size is known: a small list is broadcast, a large one is not.
    wanted = written(wanted.join(nodes.select("node", "doc_id"), "node"), "wanted")
    rows = texts.join(wanted, "doc_id").select("text", "node")
    return written(rows.mapInArrow(_segments(order), "node long, fragment int, grams array<long>")
                   .dropDuplicates(["node", "fragment"]), "segments")


def _linked(pairs: DataFrame, segments: DataFrame) -> DataFrame:
    """The pairs whose exact similarity is 0.8 or more: overlaps counted by fragment."""
    left = segments.select(F.col("node").alias("a"), "fragment", F.col("grams").alias("grams_a"))
    right = segments.select(F.col("node").alias("b"), "fragment", F.col("grams").alias("grams_b"))
    overlap = (pairs.select("a", "b", "n_a", "n_b").join(left, "a").join(right, ["b", "fragment"])
               .select("a", "b", "n_a", "n_b",
                       F.size(F.array_intersect("grams_a", "grams_b")).alias("part"))
               .groupBy("a", "b", "n_a", "n_b").agg(F.sum("part").alias("common")))
    linked = overlap.where(
        100 * F.col("common") >= 80 * (F.col("n_a") + F.col("n_b") - F.col("common"))).select("a", "b")
    return written(linked, "linked")


def _links(texts: DataFrame) -> DataFrame:
    """doc_id, n, content, node of each row, and ``first``: its component's first row."""
    small_batches(texts.sparkSession)
    cells = texts.mapInArrow(_count_cells, "cell int, n long").groupBy("cell").agg(
        F.sum("n").alias("n")).toArrow()  # a row per cell at most
    counts = np.zeros(1 << CELL_BITS, np.int64)
    counts[cells["cell"].to_numpy()] = cells["n"].to_numpy()
    order = _Order(counts)

    described = written(texts.withColumn("content", F.xxhash64("text")).mapInArrow(
        _describe, "doc_id long, content long, n long, node long, bitmap binary, cells array<long>"), "sets")
    # First row of a node: any holds the same set.
    nodes = described.where("node IS NOT NULL").groupBy("node").agg(
        F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("bitmap").alias("bitmap"),
        F.first("cells").alias("cells"))

    prefixes = texts.mapInArrow(_prefixes(order), "h long, node long, place long")
    keys = prefixes.groupBy("h").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").select("h")
    shared = written(prefixes.join(keys, "h", "left_semi").distinct(), "prefixes")

    sized = nodes.select("node", "n")
    links, sets = None, None
    placed = shared.withColumn("root", F.col("node"))

    def settle(pairs: DataFrame) -> DataFrame:
        """Compare the pairs and name the components of all links so far."""
        nonlocal links, sets
        wanted = _nodes_of(pairs)
        if sets is not None:
            wanted = wanted.join(sets.select("node"), "node", "left_anti")
        more = _sets_of(wanted, texts, nodes, order)
        sets = more if sets is None else sets.union(more)
        found = _linked(pairs, sets)
        links = found if links is None else links.union(found)
        return components(links)

    def open_groups() -> DataFrame:
        """Rows of groups whose nodes are in several components."""
        mixed = (placed.groupBy("h").agg(F.min("root").alias("lo"), F.max("root").alias("hi"))
                 .where("lo < hi").select("h"))
        return placed.join(mixed, "h", "left_semi")

    # Leaders of a group: its first nodes in LEADERS fixed orders, others in each round. Of
    # the leaders of each order that a node shares most with, it is compared with the best
    # that sizes and bitmaps allow. This only saves work: what it leaves out, the last step
    # compares.
    for r in range(ROUNDS):
        rows = open_groups()
        leaders = rows.groupBy("h").agg(*[
            F.min(F.struct(F.xxhash64(F.lit(r * LEADERS + k), "node").alias("rank"), "node", "root")).alias(f"l{k}")
            for k in range(LEADERS)])
        each = F.explode(F.array(*[
            F.struct(F.lit(k).alias("k"), F.col(f"l{k}.node").alias("b"), F.col(f"l{k}.root").alias("root_b"))
            for k in range(LEADERS)]))
        votes = (rows.join(leaders, "h").select(F.col("node").alias("a"), "root", each.alias("x"))
                 .where("root != x.root_b").select("a", "x.b", "x.k")
                 .groupBy("a", "b", "k").agg(F.count(F.lit(1)).alias("votes")))
        most = Window.partitionBy("a", "k").orderBy(F.desc("votes"), "b")
        votes = votes.withColumn("place", F.row_number().over(most)).where(F.col("place") <= LEADERS).drop("place")
        best = _possible(votes, nodes).groupBy("a", "k").agg(F.max(F.struct("votes", "b")).alias("best"))
        chosen = (best.select(F.least("a", "best.b").alias("a"), F.greatest("a", "best.b").alias("b")).distinct()
                  .join(sized.toDF("a", "n_a"), "a").join(sized.toDF("b", "n_b"), "b"))
        roots = settle(written(chosen, "pairs"))
        placed = shared.join(roots, "node", "left").select("h", "node", "place", F.coalesce("root", "node").alias("root"))

    # All pairs of a group that are in different components by now. Sizes, places and the bitmaps of
    # fixed size are tested in the join itself, so that pairs they rule out are never rows. At a
    # pair's first shared n-gram, all that is shared lies from its place on in both sets, and that
    # must be 4/9 of both sizes; a pair is no row at a later one where too little is left.
    rows = open_groups().join(nodes.select("node", "n", "cells"), "node")
    side = lambda x: rows.select("h", F.col("node").alias(x), F.col("n").alias(f"n_{x}"),
                                 F.col("root").alias(f"root_{x}"), F.col("place").alias(f"place_{x}"),
                                 F.col("cells").alias(f"cells_{x}"))
    differ = " + ".join(f"bit_count(cells_a[{k}] ^ cells_b[{k}])" for k in range(CELL_WORDS))
    rest = (side("a").join(side("b"), "h")
            .where("a < b AND root_a != root_b AND 5 * least(n_a, n_b) >= 4 * greatest(n_a, n_b)"
                   " AND 9 * least(n_a - place_a, n_b - place_b) >= 4 * (n_a + n_b)"
                   f" AND 9 * ({differ}) <= n_a + n_b")
            .select("a", "b").distinct())
    roots = settle(written(_possible(rest, nodes), "pairs"))

    named = described.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "content")
    firsts = named.where("node IS NOT NULL").groupBy("root").agg(F.min(place).alias("first"))
    return named.join(firsts, "root", "left").select("doc_id", "n", "content", "node", "first")


def link_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id of each row."""
    return _links(id_and_text(docs, id_col, text_col)).select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("component_id"))


def drop_near(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: the first document of each
    component, and every document without words."""
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "content")
    gone = (_links(id_and_text(docs, id_col, text_col))
            .where(F.col("first").isNotNull() & ~place.eqNullSafe(F.col("first")))
            .select(F.col("doc_id").alias("__gone_id"), F.col("content").alias("__gone_content")).distinct())
    keyed = docs.withColumn("__content", F.xxhash64(F.coalesce(docs[text_col].cast("string"), F.lit(""))))
    return keyed.join(gone, keyed[id_col].eqNullSafe(gone["__gone_id"])
                      & (keyed["__content"] == gone["__gone_content"]), "left_anti").drop("__content")
