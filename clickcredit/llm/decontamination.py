"""Benchmark passages in documents: SimHash of item-sized windows, then exact similarity.

The benchmark is the stated query set. It is taken in blocks of bounded bytes; each block
becomes an index that is sent to the tasks, and one pass of the documents (no shuffle)
holds every window of every text against it. A benchmark of any size is more blocks.

For an item of n words, the windows are the n-word windows of a document (the whole
document if it is shorter). Only windows that hold one of the item's five-word shingles
can be similar, so these are fingerprinted: 64 bits, each the sign of the weighted sum of
that bit over the window's shingles. Fingerprints within radius 20 are found by
multi-index Hamming blocks: seven blocks cannot all differ in three bits or more, so some
block lies within two bits, and every such value of a block is listed in the index. What
is found is verified: sum of the smaller over sum of the larger shingle weights (their
counts) of window and item, 0.8 or more. The best window of each item is reported, the
first among equals.

Words are white-space separated, A-Z in lower case. Defined results: null and empty
texts and items never match. An item of under five words is one shingle, its whole
sequence. Rows that repeat an id give a row each, and so do repeated items. Empty tables
give an empty result. Extra columns are ignored by ``leaks`` and kept by ``drop_leaks``.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickcredit.llm.shared import id_and_text
from clickcredit.llm.words import find_words, runs, slices

NGRAM = 5
THRESHOLD = 0.8
BITS = 64
BLOCKS = 7
BLOCK_RADIUS = 2
RADIUS = BLOCKS * (BLOCK_RADIUS + 1) - 1  # 20: guaranteed by the blocks
ITEM_BLOCK_BYTES = 1 << 20
SCHEMA = "doc_id long, item_id long, start long, n_words long, distance int, similarity double"

_EDGES = [b * BITS // BLOCKS for b in range(BLOCKS + 1)]
_FILTER_BITS = 20


def _signs(grams: np.ndarray) -> np.ndarray:
    """One row per gram of 64 values +1 or -1."""
    return np.unpackbits(grams.view(np.uint8).reshape(-1, 8), axis=1).astype(np.int32) * 2 - 1


def _pack(sums: np.ndarray) -> np.ndarray:
    return np.packbits(sums > 0, axis=1).view(np.uint64).ravel()


def _block(fingerprints: np.ndarray, b: int) -> np.ndarray:
    lo, hi = _EDGES[b], _EDGES[b + 1]
    return (fingerprints >> np.uint64(lo)).astype(np.int64) & ((1 << (hi - lo)) - 1)


class ItemIndex:
    """Shingles, fingerprints and Hamming blocks of a block of items."""

    def __init__(self, items: list[tuple[int, str]]):
        self.ids, self.sizes, self.grams, prints = [], [], [], []
        texts = pa.array([t for _, t in items], pa.string())
        for first, end, data, offsets in slices(texts):
            words = find_words(data, offsets, lower=True)
            hashes = words.hashes()
            for i in range(first, end):
                own = hashes[words.bounds[i - first]:words.bounds[i - first + 1]]
                if not len(own):
                    continue
                grams = runs(own, min(NGRAM, len(own)))
                self.ids.append(items[i][0])
                self.sizes.append(len(own))
                self.grams.append(grams)
                prints.append(_pack(_signs(grams).sum(axis=0, keepdims=True))[0])
        self.prints = np.array(prints, np.uint64)
        self.counts = [Counter(g.tolist()) for g in self.grams]
        # By shingle width: sorted shingles and the sizes of the items that hold them.
        self.by_width: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for width in sorted({min(NGRAM, n) for n in self.sizes}):
            pairs = sorted({(int(g), n) for gs, n in zip(self.grams, self.sizes, strict=True)
                            if min(NGRAM, n) == width for g in gs.tolist()})
            grams = np.array([p[0] for p in pairs], np.uint64)
            near = np.zeros(1 << _FILTER_BITS, dtype=bool)
            near[(grams >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True
            self.by_width[width] = (near, grams, np.array([p[1] for p in pairs], np.int64))
        # By size and block: block value -> items within two bits of it.
        self.blocks: dict[tuple[int, int], dict[int, list[int]]] = {}
        for item, (size, f) in enumerate(zip(self.sizes, prints, strict=True)):
            for b in range(BLOCKS):
                table = self.blocks.setdefault((size, b), {})
                value = int(_block(np.array([f], np.uint64), b)[0])
                width = _EDGES[b + 1] - _EDGES[b]
                for k in range(BLOCK_RADIUS + 1):
                    for bits in combinations(range(width), k):
                        table.setdefault(value ^ sum(1 << x for x in bits), []).append(item)

    def near(self, size: int, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(window, item, distance) of all fingerprints within the radius."""
        found: set[tuple[int, int]] = set()
        for b in range(BLOCKS):
            table = self.blocks[size, b]
            for w, value in enumerate(_block(prints, b).tolist()):
                found.update((w, item) for item in table.get(value, ()))
        if not found:
            none = np.zeros(0, np.int64)
            return none, none, none
        w, item = np.array(sorted(found), np.int64).T
        distance = np.bitwise_count(prints[w] ^ self.prints[item]).astype(np.int64)
        ok = distance <= RADIUS
        return w[ok], item[ok], distance[ok]

    def matches(self, grams: dict[int, np.ndarray], lo: int, hi: int,
                hits: list[tuple[int, int]]) -> Iterator[tuple]:
        """(item, start, n_words, distance, similarity) in the document of words lo to hi.
        ``hits``: (word index, size) of shared shingles; ``grams``: shingles by width."""
        for size in sorted({s for _, s in hits}):
            width = min(NGRAM, size)
            at = np.array([p for p, s in hits if s == size])
            n = min(size, hi - lo)  # words in a window
            m = n - width + 1  # shingles in a window
            if m < 1:
                continue
            change = np.zeros(hi - lo + 2, np.int64)
            np.add.at(change, np.maximum(at - lo - m + 1, 0), 1)
            np.add.at(change, np.minimum(at - lo, hi - lo - n) + 1, -1)
            starts = np.flatnonzero(np.cumsum(change[:hi - lo - n + 1]) > 0)
            own = grams[width][lo:hi - width + 1]
            best: dict[int, tuple] = {}
            for part in np.split(starts, np.flatnonzero(np.diff(starts) > m) + 1):
                # Windows close together share one table of running sums.
                for k in range(0, len(part), 4096):
                    some = part[k:k + 4096]
                    base = some[0]
                    sums = np.zeros((some[-1] - base + m + 1, BITS), np.int32)
                    np.cumsum(_signs(np.ascontiguousarray(own[base:some[-1] + m])), axis=0, out=sums[1:])
                    prints = _pack(sums[some - base + m] - sums[some - base])
                    for w, item, distance in zip(*(x.tolist() for x in self.near(size, prints)), strict=True):
                        start = int(some[w])
                        similarity = self._similarity(own[start:start + m], item)
                        if similarity >= THRESHOLD and (item not in best or similarity > best[item][-1]):
                            best[item] = (item, start, n, distance, similarity)
            yield from best.values()

    def _similarity(self, grams: np.ndarray, item: int) -> float:
        window, counts = Counter(grams.tolist()), self.counts[item]
        common = sum(min(c, counts[g]) for g, c in window.items() if g in counts)
        return common / (len(grams) + len(self.grams[item]) - common)

    def search(self, texts: pa.Array) -> Iterator[tuple]:
        """(row, item, start, n_words, distance, similarity) over a batch of texts."""
        for first, _, data, offsets in slices(texts):
            words = find_words(data, offsets, lower=True)
            hashes = words.hashes()
            hits: dict[int, list[tuple[int, int]]] = {}
            grams: dict[int, np.ndarray] = {}
            for width, (near, known, sizes) in self.by_width.items():
                g = grams[width] = runs(hashes, width)
                at = np.flatnonzero(near[(g >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)])
                left = np.searchsorted(known, g[at], side="left")
                right = np.searchsorted(known, g[at], side="right")
                owner = np.searchsorted(words.bounds, at, side="right") - 1
                inside = (right > left) & (at + width <= words.bounds[owner + 1])
                for p, i, a, b in zip(at[inside].tolist(), owner[inside].tolist(),
                                      left[inside].tolist(), right[inside].tolist(), strict=True):
                    hits.setdefault(i, []).extend((p, int(s)) for s in sizes[a:b])
            for i, found in hits.items():
                for match in self.matches(grams, int(words.bounds[i]), int(words.bounds[i + 1]), found):
                    yield (first + i, *match)


def item_blocks(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text",
                limit: int = ITEM_BLOCK_BYTES) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of about ``limit`` bytes, read one partition at a time."""
    block, size = [], 0
    for row in benchmark.select(benchmark[id_col].cast("long").alias("item_id"),
                                benchmark[text_col].cast("string").alias("text")).toLocalIterator():
        block.append((row["item_id"], row["text"] or ""))
        size += 100 + len(block[-1][1])
        if size >= limit:
            yield block
            block, size = [], 0
    if block:
        yield block


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """One row per (document, item) that match, with the best window."""
    texts = id_and_text(docs, id_col, text_col)
    out = docs.sparkSession.createDataFrame([], SCHEMA)
    for block in item_blocks(benchmark):
        out = out.union(texts.mapInArrow(_finder(block), SCHEMA))
    return out


def _finder(block: list[tuple[int, str]]):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = ItemIndex(block)
        for batch in batches:
            rows = list(index.search(batch["text"]))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 6
            yield pa.record_batch({
                "doc_id": batch["doc_id"].take(pa.array(columns[0], pa.int64())),
                "item_id": pa.array([index.ids[i] for i in columns[1]], pa.int64()),
                "start": pa.array(columns[2], pa.int64()),
                "n_words": pa.array(columns[3], pa.int64()),
                "distance": pa.array(columns[4], pa.int32()),
                "similarity": pa.array(columns[5], pa.float64())})

    return find


def drop_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that match no item, with all their columns, in one pass for
    each block of items and without a shuffle."""
    schema, at = docs.schema, docs.columns.index(text_col)

    def keeper(block: list[tuple[int, str]]):
        def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = ItemIndex(block)
            for batch in batches:
                clean = np.ones(batch.num_rows, dtype=bool)
                clean[[m[0] for m in index.search(batch.column(at).cast(pa.string()))]] = False
                yield batch.filter(pa.array(clean))

        return keep

    for block in item_blocks(benchmark):
        docs = docs.mapInArrow(keeper(block), schema)
    return docs


def contaminated_documents(found: DataFrame) -> DataFrame:
    """One row per matched document: its items, in order, and the highest similarity."""
    return found.groupBy("doc_id").agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"),
                                       F.max("similarity").alias("similarity"))
