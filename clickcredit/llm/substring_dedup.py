"""Repeated word windows, found through difference-cover anchors.

A window is 50 consecutive words; a word goes if it lies in a window whose word sequence
also starts in a document of smaller id. Anchors are hashes of 20-word runs whose first
word's index, modulo 31, lies in a perfect difference set of six residues. For any two
alignments of a match, the set has two residues with the same difference, so some offset
below 31 puts both sides on cover positions: every match of 31 - 1 + 20 = 50 words shares
an aligned anchor. Six anchors in 31 words are shuffled, not every window.

Before that, copied stretches are set aside: window starts are cut into chunks at
content-defined places, and a chunk (with all words that its windows cover) that a smaller
document has too goes whole. Neither anchors nor windows of such chunks are shuffled; the
smallest document that has a window never has it in such a chunk, so nothing is missed.

From a shared anchor the match extends: only windows that hold one are candidates, and a
candidate is hashed over its full 50 words and takes the smallest document that has it.
The smallest document is a plain minimum (combined before the shuffle), never a list of
pairs, so copies cost their own number of rows however many there are.

Windows and chunks are compared by 96 bits (two independent hashes); anchors, of 64 bits,
only select candidates.

Defined results: null and empty texts, and texts of under 50 words, lose nothing. Of one
document's own repeats none goes. Rows that repeat an id are one document with several
texts: each is judged against smaller ids alone. Rows with a null id neither lose nor
cause a loss. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickcredit.llm.shared import id_and_text
from clickcredit.llm.words import Words, find_words, runs, slices, spans

WINDOW = 50
PERIOD = 31
COVER = (1, 5, 11, 24, 25, 27)  # every difference modulo 31 occurs
ANCHOR = WINDOW - PERIOD + 1
CHUNK_WORDS = 4
CHUNK_MEAN = 32
CHUNKS = "c1 long, c2 int, doc_id long"
WINDOWS = "w1 long, w2 int, doc_id long"

_ON_COVER = np.zeros(PERIOD, dtype=bool)
_ON_COVER[list(COVER)] = True


def _chunk_starts(words: Words, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first window, end of the windows, document) of each chunk. A chunk is a stretch of
    window starts; boundaries depend on the next words alone, so copies share them."""
    n = np.diff(words.bounds) - (WINDOW - 1)  # windows of each document
    long = np.flatnonzero(n > 0)
    if not len(long):
        none = np.zeros(0, np.int64)
        return none, none, none
    owner = words.document_of()
    marks = runs(hashes, CHUNK_WORDS)
    at = np.flatnonzero(marks % np.uint64(CHUNK_MEAN) == 0)
    at = at[at < (words.bounds[:-1] + n)[owner[at]]]
    first = np.unique(np.concatenate([words.bounds[long], at]))
    owner = owner[first]
    end = np.minimum(np.append(first[1:], len(hashes)), words.bounds[owner] + n[owner])
    return first, end, owner


def _half(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _emit_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Two hashes of all words that a chunk's windows cover."""
    for batch in batches:
        batch = batch.filter(batch["doc_id"].is_valid())
        ids = batch["doc_id"].to_numpy()
        for at, _, data, offsets in slices(batch["text"]):
            words = find_words(data, offsets)
            hashes = words.hashes()
            first, end, owner = _chunk_starts(words, hashes)
            yield pa.record_batch({
                "c1": spans(hashes, first, end + WINDOW - 1).view(np.int64),
                "c2": _half(spans(hashes, first, end + WINDOW - 1, seed=1)),
                "doc_id": ids[at + owner]})


def _cover(n: int, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Which of n places lie in some range first:end."""
    change = np.zeros(n + 1, np.int32)
    np.add.at(change, first, 1)
    np.add.at(change, end, -1)
    return np.cumsum(change[:-1]) > 0


def _own(words: Words, hashes: np.ndarray, copied: list) -> np.ndarray:
    """Which window starts lie in chunks that no smaller document has."""
    first, end, owner = _chunk_starts(words, hashes)
    content, stays = spans(hashes, first, end + WINDOW - 1).view(np.int64), np.ones(len(first), dtype=bool)
    for i in np.unique(owner):
        if copied[i] is not None:
            lo, hi = np.searchsorted(owner, (i, i + 1))
            stays[lo:hi] = ~np.isin(content[lo:hi], copied[i])
    return _cover(len(hashes), first[stays], end[stays])


def _lists(batch: pa.RecordBatch, column: str, first: int, end: int) -> list:
    return [x.values.to_numpy() if x.is_valid else None for x in batch[column][first:end]]


def _anchors(words: Words, hashes: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, word index in the slice, hash) of each anchor in an own window."""
    if len(hashes) < WINDOW:
        none = np.zeros(0, np.int64)
        return none, none, none
    starts = np.flatnonzero(own)
    owner = words.document_of()
    place = np.arange(len(hashes)) - words.bounds[owner]
    at = np.flatnonzero(_ON_COVER[place % PERIOD] & _cover(len(hashes), starts, starts + PERIOD))
    return owner[at], at, runs(hashes, ANCHOR)[at].view(np.int64)


def _emit_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(h, doc_id) of each anchor."""
    for batch in batches:
        batch = batch.filter(batch["doc_id"].is_valid())
        ids = batch["doc_id"].to_numpy()
        for first, end, data, offsets in slices(batch["text"]):
            words = find_words(data, offsets)
            hashes = words.hashes()
            own = _own(words, hashes, _lists(batch, "copied", first, end))
            owner, _, h = _anchors(words, hashes, own)
            keep = np.lexsort((h, owner))  # each anchor of a document once
            owner, h = owner[keep], h[keep]
            new = np.ones(len(h), dtype=bool)
            new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
            yield pa.record_batch({"h": pa.array(h[new]),
                                   "doc_id": pa.array(ids[first + owner[new]], pa.int64())})


def _emit_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(w1, w2, doc_id) of each own window that holds a shared anchor."""
    for batch in batches:
        batch = batch.filter(batch["doc_id"].is_valid())
        ids = batch["doc_id"].to_numpy()
        for first, end, data, offsets in slices(batch["text"]):
            words = find_words(data, offsets)
            hashes = words.hashes()
            own = _own(words, hashes, _lists(batch, "copied", first, end))
            owner, at, h = _anchors(words, hashes, own)
            hit, shared = np.zeros(len(h), dtype=bool), _lists(batch, "shared", first, end)
            for i in np.unique(owner):
                lo, hi = np.searchsorted(owner, (i, i + 1))
                if shared[i] is not None:
                    hit[lo:hi] = np.isin(h[lo:hi], shared[i])
            at = at[hit]
            near = _cover(len(hashes), np.maximum(at - (PERIOD - 1), 0), at + 1)
            starts = np.flatnonzero(own & near)
            owner = np.searchsorted(words.bounds, starts, side="right") - 1
            yield pa.record_batch({
                "w1": pa.array(runs(hashes, WINDOW)[starts].view(np.int64)),
                "w2": _half(runs(hashes, WINDOW, seed=1)[starts]),
                "doc_id": pa.array(ids[first + owner], pa.int64())})


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Remove the windows of copied chunks, and those whose w1 is in ``gone``."""
    for batch in batches:
        n = batch.num_rows
        n_words, n_removed = np.zeros(n, np.int64), np.zeros(n, np.int64)
        kept: list[bytes] = []
        for first, end, data, offsets in slices(batch["text"]):
            words = find_words(data, offsets)
            n_words[first:end] = np.diff(words.bounds)
            hashes, raw = words.hashes(), data.tobytes()
            copied = _lists(batch, "copied", first, end)
            own = _own(words, hashes, copied)
            for i, gone in enumerate(_lists(batch, "gone", first, end)):
                lo, hi = words.bounds[i], words.bounds[i + 1]
                keep = np.ones(hi - lo, dtype=bool)
                if hi - lo >= WINDOW and (gone is not None or copied[i] is not None):
                    lost = ~own[lo:hi - WINDOW + 1]
                    if gone is not None:
                        lost |= np.isin(runs(hashes[lo:hi], WINDOW).view(np.int64), gone)
                    starts = np.flatnonzero(lost)
                    keep = ~_cover(hi - lo, starts, starts + WINDOW)
                n_removed[first + i] = (~keep).sum()
                at = np.flatnonzero(keep) + lo
                kept.append(b" ".join([raw[a:b] for a, b in
                                       zip(words.start[at].tolist(), words.end[at].tolist(), strict=True)]))
        yield pa.record_batch({
            "doc_id": batch["doc_id"], "n_words": n_words, "n_removed": n_removed,
            "kept_sha256": pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()),
            "kept": pa.array(kept, pa.binary())})


def dedup_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and the kept text of each row."""
    texts = id_and_text(docs, id_col, text_col)
    chunks = texts.mapInArrow(_emit_chunks, CHUNKS)
    least = chunks.groupBy("c1", "c2").agg(F.min("doc_id").alias("lo"), F.count(F.lit(1)).alias("n")).where("n > 1")
    copied = (chunks.join(least, ["c1", "c2"]).where("doc_id > lo")
              .groupBy("doc_id").agg(F.collect_set("c1").alias("copied")))  # within a document
    # The only shuffle of the texts: all that follows joins by id too. Outer joins without a
    # filter keep the exchange the same in each place, so that Spark reuses it.
    marked = texts.join(copied, "doc_id", "left")

    anchors = marked.mapInArrow(_emit_anchors, "h long, doc_id long")
    keys = anchors.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h")
    shared = (anchors.join(keys, "h", "left_semi")
              .groupBy("doc_id").agg(F.collect_set("h").alias("shared")))  # within a document
    windows = marked.join(shared, "doc_id", "left").mapInArrow(_emit_windows, WINDOWS)
    first = (windows.groupBy("w1", "w2")
             .agg(F.min("doc_id").alias("lo"), F.count(F.lit(1)).alias("n")).where("n > 1"))
    gone = (windows.join(first, ["w1", "w2"]).where("doc_id > lo")
            .groupBy("doc_id").agg(F.collect_set("w1").alias("gone")))
    return marked.join(gone, "doc_id", "left").mapInArrow(
        _cut, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept binary")
