"""SimHash near-duplicates by a byte-position inverted index with count filtering.

A fingerprint's bit is 1 where over half of the text's shingle hashes have it; the hashes are
XXH64 of word 4-grams, repeats included. Fingerprints that differ in at most ``RADIUS`` bits
differ in at most so many of their eight bytes, so they agree at ``LEAST`` = 4 positions or
more: the guaranteed minimum of the tally of shared positional bytes.

A single posting list (position, byte) would hold a 256th of all fingerprints. The
index therefore lists each fingerprint under every choice of four positions with their four bytes, 70
entries, where lists stay short: any pair that reaches the minimum meets in one. Bytes
are put in the order of the choice, so that an entry is the upper half of a number and the
list is sorted by the lower half; range partitions split an entry of any size.

Neighbours of a list are tallied and verified first, which joins groups of near copies with
one row a posting and no pairs. Lists whose fingerprints then lie in different components are
compared exactly: each fingerprint outside its list's largest component against the list, the
tally and the distance tested in the join itself, so what they reject is never a row.

Distinct fingerprints are linked, not documents: copies add no postings. The result is the
components; pairs that already lie in one component are not verified again.

Defined results: A-Z are lower-cased; one to three words are one shingle; a null or empty
text, or one of white space, has fingerprint zero, linked like any other. Every row gives a row,
repeated ones too; a null id names a component only if no other id is in it. An empty table gives
an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickcredit.llm.shared import components, id_and_text, written
from clickcredit.llm.words import Words, find_words, slices

NGRAM = 4
SEED = 42
RADIUS = 4
BYTES = 8
LEAST = BYTES - RADIUS  # positions at which two linked fingerprints agree at least
_HASHES_AT_ONCE = 1 << 16
# Orders of a fingerprint's bytes, one a choice of positions; the chosen ones come last, which
# are the upper half of a little-endian number.
_CHOICES = np.array([[*(p for p in range(BYTES) if p not in chosen), *chosen]
                     for chosen in combinations(range(BYTES), LEAST)])


def _joined(words: Words) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The slice's words with one space after each, and each word's place in it."""
    sizes = words.end - words.start
    start = np.cumsum(sizes + 1) - (sizes + 1)
    out = np.full(int(sizes.sum()) + len(sizes), 0x20, np.uint8)
    within = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[np.repeat(start, sizes) + within] = words.data[np.repeat(words.start, sizes) + within]
    return out.tobytes(), start, start + sizes


def _slice_fingerprints(words: Words, seed: int) -> np.ndarray:
    from xxhash import xxh64_intdigest

    n = np.diff(words.bounds)
    grams = np.where(n >= NGRAM, n - NGRAM + 1, np.minimum(n, 1))  # of each document
    doc = np.repeat(np.arange(len(n)), grams)
    first = np.arange(len(doc)) - np.repeat(np.cumsum(grams) - grams, grams) + words.bounds[:-1][doc]
    last = np.minimum(first + NGRAM, words.bounds[1:][doc]) - 1
    text, start, end = _joined(words)
    ones = np.zeros((len(n), 8 * BYTES), np.int64)
    for lo in range(0, len(doc), _HASHES_AT_ONCE):
        part = slice(lo, lo + _HASHES_AT_ONCE)
        spans = zip(start[first[part]].tolist(), end[last[part]].tolist(), strict=True)
        hashes = np.fromiter((xxh64_intdigest(text[a:b], seed) for a, b in spans), "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, BYTES), axis=1, bitorder="little")
        docs, at = np.unique(doc[part], return_index=True)
        ones[docs] += np.add.reduceat(bits, at, axis=0, dtype=np.int64)
    most = (2 * ones > grams[:, None]).astype(np.uint8)
    return np.packbits(most, axis=1, bitorder="little").view("<i8").ravel()


def _fingerprints(seed: int):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [_slice_fingerprints(find_words(data, offsets, lower=True), seed)
                     for _, _, data, offsets in slices(batch["text"])]
            prints = np.concatenate(parts) if parts else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(prints)], names=["doc_id", "print"])

    return emit


def fingerprints(docs: DataFrame, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and print, the 64 bits as a signed long, of each row."""
    return id_and_text(docs, id_col, text_col).mapInArrow(_fingerprints(seed), "doc_id long, print long")


def _postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(choice, ordered): each fingerprint's bytes in the order of every choice."""
    for batch in batches:
        prints = batch["print"].to_numpy().astype("<i8").view(np.uint8).reshape(-1, BYTES)
        for choice, order in enumerate(_CHOICES):
            ordered = np.ascontiguousarray(prints[:, order]).view("<i8").ravel()
            yield pa.record_batch({"choice": np.full(len(ordered), choice, np.int32), "ordered": ordered})


def _original(choice: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    back = np.argsort(_CHOICES, axis=1)[choice]
    return np.take_along_axis(ordered.view(np.uint8).reshape(-1, BYTES), back, axis=1).view("<i8").ravel()


def _similar(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which pairs reach the minimum of shared positional bytes and lie within the radius."""
    differ = a ^ b
    tally = (differ.view(np.uint8).reshape(-1, BYTES) == 0).sum(axis=1)
    return (tally >= LEAST) & (np.bitwise_count(differ.view("<u8")) <= RADIUS)


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Postings of a sorted partition that may share their entry with another, each with
    two others of it where verified: the one before, and the entry's first in the batch.

    The last posting of a batch and the first of the partition always stay, as their entry
    may go on beyond them.
    """
    choice, ordered, carried = np.zeros(0, np.int32), np.zeros(0, np.int64), 0
    for batch in batches:
        choice = np.append(choice[-1:], batch["choice"].to_numpy())
        ordered = np.append(ordered[-1:], batch["ordered"].to_numpy())
        n = len(ordered)
        same = np.zeros(n + 1, dtype=bool)  # whether i shares its entry with i - 1
        same[1:-1] = (choice[1:] == choice[:-1]) & (ordered[1:] >> 32 == ordered[:-1] >> 32)
        give = same[:-1] | same[1:]
        give[-1:] = True
        give[:1] = not carried  # the carried posting was given with its own batch
        at = np.flatnonzero(give)
        prints = _original(choice, ordered)
        heads = np.maximum.accumulate(np.where(same[:-1], 0, np.arange(n)))
        columns = {"choice": choice[at], "entry": (ordered[at] >> 32).astype(np.int32), "print": prints[at]}
        for name, other in (("near", np.maximum(at - 1, 0)), ("head", heads[at])):
            good = same[:-1][at] & _similar(ordered[at], ordered[other])
            columns[name] = pa.array(prints[other], mask=~good)
        carried = min(n, 1)
        yield pa.record_batch(columns)


def _shared_postings(prints: DataFrame) -> DataFrame:
    """(choice, entry, print, near, head) of entries that hold several fingerprints."""
    postings = prints.mapInArrow(_postings, "choice int, ordered long")
    return (postings.repartitionByRange("choice", "ordered").sortWithinPartitions("choice", "ordered")
            .mapInArrow(_neighbours, "choice int, entry int, print long, near long, head long"))


def _rooted(postings: DataFrame, roots: DataFrame) -> DataFrame:
    return (postings.join(roots.withColumnRenamed("node", "print"), "print", "left")
            .select("choice", "entry", "print", F.coalesce("root", "print").alias("root")))


def _open_links(placed: DataFrame) -> DataFrame:
    """All links of entries whose fingerprints are in several components, but those within one."""
    entry = ["choice", "entry"]
    mixed = placed.groupBy(*entry).agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi")
    rows = written(placed.join(mixed.select(*entry), entry, "left_semi"), "open")
    largest = (rows.groupBy(*entry, "root").agg(F.count(F.lit(1)).alias("n"))
               .groupBy(*entry).agg(F.max(F.struct("n", "root"))["root"].alias("largest")))
    sided = rows.join(largest, entry)
    outside = sided.where("root != largest").select(*entry, F.col("print").alias("a"), F.col("root").alias("root_a"))
    everyone = sided.select(*entry, F.col("print").alias("b"), F.col("root").alias("root_b"), "largest")
    tally = " + ".join(f"int(((a ^ b) & {0xFF << 8 * k if k < BYTES - 1 else -1 << 8 * k}) = 0)" for k in range(BYTES))
    return (outside.join(everyone, entry)
            .where(f"root_a != root_b AND (a < b OR root_b = largest) AND {tally} >= {LEAST}"
                   f" AND bit_count(a ^ b) <= {RADIUS}")
            .select("a", "b").distinct())


def link_fingerprints(prints: DataFrame) -> DataFrame:
    """(node, root): connected components of the distinct fingerprints ``print`` that have a
    link, root the smallest of them."""
    shared = written(_shared_postings(prints), "postings")
    found = written(shared.select("print", F.explode(F.array("near", "head")).alias("other"))
                    .where("print != other").select(F.least("print", "other").alias("a"),
                                                    F.greatest("print", "other").alias("b")).distinct(), "near")
    more = _open_links(_rooted(shared, components(found)))
    return components(found.union(more))


def near_copies(docs: DataFrame, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, print and component_id of each row."""
    rows = written(fingerprints(docs, seed, id_col, text_col), "prints")
    distinct = written(rows.groupBy("print").agg(F.min("doc_id").alias("least")), "distinct")
    roots = link_fingerprints(distinct.select("print")).withColumnRenamed("node", "print")
    rooted = distinct.join(roots, "print", "left").withColumn("root", F.coalesce("root", "print"))
    named = rooted.join(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "root")
    return rows.join(named.select("print", "component_id"), "print", "left").select(
        "doc_id", "print", "component_id")
