"""Repeated 100-byte strings by a distributed suffix sort, dealt by anchors.

A byte goes if it lies in a 100-byte string that also starts earlier (smaller id, or same
document and earlier start). Suffixes are ordered by their first 100 bytes:

1. Candidates. The smallest of a 100-byte string's 69 hashes of 32 bytes is its anchor;
   equal strings have equal anchors. A string can only be repeated if its anchor is found
   in two places; other positions never enter the sort. Equal documents enter once.
2. Pieces. Neighbouring strings of one anchor travel as one piece of text, about 4 bytes a
   string, and all pieces of an anchor meet in one task.
3. Suffix array. A task sorts the suffixes of whole anchors by prefix doubling: ranks of 8
   bytes, then 16, 32, 64 and 100. Suffixes with equal first 100 bytes are adjacent, by
   place, and every one but the first is removed.
4. A piece of an anchor of very many documents is cut into parts of about 9 strings, dealt
   by the 92 bytes that all strings of a part share; of equal pieces in a batch only the first
   by place is cut, the others are repeated throughout. So a common anchor in different
   surroundings is many small keys, in the sort of step 3.
5. 92 bytes that are very common too are not bound to a task: their parts are ordered by their
   bytes and dealt by ranges, each task keeps the first of each kind of suffix that it has, and
   these are ordered by Spark's range partitioning by their 100 bytes and their place; the
   first row of each task is settled by the previous task's last one.

Defined results: null and empty texts, and texts under 100 bytes, lose nothing. Rows that
repeat id and text are one document; rows that repeat the id alone are ordered by a hash
of the text. Rows with a null id neither lose nor cause a loss. An empty table gives an
empty result. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickcredit.llm.shared import id_and_text, shuffle_partitions, small_batches, written
from clickcredit.llm.words import mix64, runs, slices

LENGTH = 100
GRAM = 32
REACH = LENGTH - GRAM + 1  # grams in a string
SPREAD = 1000  # documents of an anchor, or pieces of a core, from which it is not bound to one task
STEP = 9  # strings of a very common anchor that are dealt by one core
CORE = LENGTH - STEP + 1
SORTED_BYTES = 1 << 19  # text sorted at once, whole anchors
WINDOW_BYTES = 3 << 19  # text sorted at once, of anchors that are not bound to a task
ROWS_OUT = 20000

_BYTES = mix64(np.arange(1, 257, dtype=np.uint64))


def _sliding(a: np.ndarray, width: int, pick) -> np.ndarray:
    """Minimum or maximum (``pick``) of each ``width`` neighbours, by doubling."""
    n = 1
    while 2 * n <= width:
        a = pick(a[:-n], a[n:])
        n *= 2
    rest = width - n
    return pick(a[:len(a) - rest], a[rest:]) if rest else a


def _least(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(gram hashes, anchor of each LENGTH-byte string) of a text of at least LENGTH bytes:
    the anchor is the smallest hash of the string's grams."""
    grams = runs(_BYTES[data], GRAM)
    return grams, _sliding(grams, REACH, np.minimum)


def _anchors(data: np.ndarray) -> np.ndarray:
    """Hash of each gram that is the anchor of some string; one for each place."""
    grams, least = _least(data)
    edge = np.zeros(REACH - 1, np.uint64)
    reach = _sliding(np.concatenate([edge, least, edge]), REACH, np.maximum)
    return grams[reach == grams].view(np.int64)


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    for first, end, data, offsets in slices(batch["text"]):
        for i in range(end - first):
            if offsets[i + 1] - offsets[i] >= LENGTH:
                yield first + i, data[offsets[i]:offsets[i + 1]]


def _emit_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, content) of the distinct anchors of each text; an anchor that a text holds twice
    also comes under the inverted content, so that it counts as shared."""
    seen: set[int] = set()
    for batch in batches:
        contents, hashes, owners = batch["content"].to_numpy(), [], []
        if len(seen) > ROWS_OUT:  # equal texts far apart come again
            seen.clear()
        for i, data in _texts(batch):
            c = int(contents[i])
            if c in seen:
                continue
            seen.add(c)
            found, n = np.unique(_anchors(data), return_counts=True)
            hashes += [found, found[n > 1]]
            owners += [np.full(len(found), c), np.full(int((n > 1).sum()), ~c)]
        none = [np.zeros(0, np.int64)]
        yield pa.record_batch({"a": np.concatenate(hashes or none),
                               "content": np.concatenate(owners or none)})


PIECES = "anchor long, spread boolean, doc_id long, content long, start int, body binary, end int"


def _piece_batch(out: list[tuple], gone: list[tuple] | None = None) -> pa.RecordBatch:
    """Pieces, and with ``gone`` those (anchor, doc_id, content, start, end) that are repeated throughout."""
    rows = out + [(a, True, i, c, s, None) for a, i, c, s, _ in gone or ()]
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 6
    types = (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
    names = ("anchor", "spread", "doc_id", "content", "start", "body")
    ends = {"end": pa.array([None] * len(out) + [x[4] for x in gone], pa.int32())} if gone is not None else {}
    return pa.record_batch({n: pa.array(c, t) for n, c, t in zip(names, columns, types, strict=True)} | ends)


def _parts(anchor: int, body: bytes) -> Iterator[tuple[int, int, int]]:
    """(core, start, end) of the parts of a piece: neighbouring strings with one core, the CORE bytes
    that all strings share whose first anchor lies in the same STEP places from their start."""
    data = _BYTES[np.frombuffer(body, np.uint8)]
    places = np.arange(len(body) - LENGTH + 1)
    found = np.flatnonzero(runs(data, GRAM).view(np.int64) == anchor)
    found = found[np.searchsorted(found, places)]
    core = runs(data, CORE).view(np.int64)[found - (found - places) // STEP * STEP]
    turns = [0, *(np.flatnonzero(core[1:] != core[:-1]) + 1).tolist(), len(core)]
    for s, e in itertools.pairwise(turns):
        yield int(core[s]), s, e


def _emit_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stretches of positions with one anchor at which a repeated string can start, with their bytes.
    Those of very common anchors come in parts, with their core as anchor; of equal ones in a batch
    the first by place has parts and the others are repeated throughout."""

    def settle(out: list[tuple], far: dict[bytes, tuple[int, set]]) -> pa.RecordBatch:
        gone: list[tuple] = []
        for body, (a, found) in far.items():
            (i, c, s), *others = sorted(found)
            out += [(core, True, i, c, s + f, body[f:e + LENGTH - 1]) for core, f, e in _parts(a, body)]
            gone += [(a, i, c, s, s + len(body) - LENGTH + 1) for i, c, s in others]
        return _piece_batch(out, gone)

    for batch in batches:
        ids, contents = batch["doc_id"].to_pylist(), batch["content"].to_pylist()
        out: list[tuple] = []
        far: dict[bytes, tuple[int, set]] = {}
        n_far = 0
        for i, data in _texts(batch):
            least = _least(data)[1].view(np.int64)
            start = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
            end, anchor = np.append(start[1:], len(least)), least[start]
            hit = np.isin(anchor, batch["shared"][i].values.to_numpy())
            spread = np.isin(anchor[hit], batch["spread"][i].values.to_numpy())
            for a, is_far, s, e in zip(anchor[hit].tolist(), spread.tolist(), start[hit].tolist(), end[hit].tolist(),
                                       strict=True):
                body = data[s:e + LENGTH - 1].tobytes()
                if is_far:
                    far.setdefault(body, (a, set()))[1].add((ids[i], contents[i], s))
                    n_far += 1
                else:
                    out.append((a, False, ids[i], contents[i], s, body))
            if len(out) + n_far > ROWS_OUT:
                yield settle(out, far)
                out, far, n_far = [], {}, 0
        yield settle(out, far)


def _ranks(values: np.ndarray) -> np.ndarray:
    """Place of each value among the different ones, in four bytes."""
    order = np.argsort(values)
    ordered = values[order]
    new = ordered[1:] != ordered[:-1]
    del ordered
    rank = np.zeros(len(values), np.uint32)
    rank[order[1:]] = np.cumsum(new, dtype=np.uint32)
    return rank


def _pairs(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    out = high.astype(np.uint64)
    out <<= np.uint64(32)
    out |= low
    return out


def _sorted_suffixes(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, new): the suffixes at ``at`` sorted by their LENGTH bytes, equal ones as given, and
    whether each differs from the one before."""
    key, width = np.zeros(len(data) - 7, np.uint64), 8
    for k in range(width):
        key <<= np.uint64(8)
        key |= data[k:k + len(key)]
    rank = _ranks(key)
    while 2 * width <= LENGTH:
        key = _pairs(rank[:-width], rank[width:])
        rank = _ranks(key)
        width *= 2
    key = _pairs(rank[at], rank[at + LENGTH - width])
    order = np.argsort(key, kind="stable")
    new = np.ones(len(at), dtype=bool)
    new[1:] = key[order[1:]] != key[order[:-1]]
    return order, new


def _judged(table: pa.Table) -> Iterator[tuple[int, int, np.ndarray, bytes]]:
    """(row, start, repeated by position, bytes) of the pieces of whole anchors, which come by place;
    the same piece of a repeated row counts once."""
    places = np.stack([table[c].to_numpy() for c in ("anchor", "doc_id", "content", "start")])
    new = np.ones(len(table), dtype=bool)
    new[1:] = (places[:, 1:] != places[:, :-1]).any(axis=0)
    rows = np.flatnonzero(new)
    bodies = [x.as_py() for x in table["body"].combine_chunks().take(pa.array(rows))]
    known: dict[bytes, int] = {}  # a piece that equals one before it is repeated throughout
    fresh = [known.setdefault(x, k) == k for k, x in enumerate(bodies)]
    sizes = np.array([len(x) - LENGTH + 1 for x in known])
    first = np.cumsum(sizes) - sizes
    at = np.arange(sizes.sum()) + np.repeat(np.arange(len(sizes)) * (LENGTH - 1), sizes)
    order, different = _sorted_suffixes(np.frombuffer(b"".join(known), np.uint8), at)
    repeated = np.zeros(len(at), dtype=bool)
    repeated[order] = ~different
    spans = iter(zip(first.tolist(), sizes.tolist(), strict=True))
    for row, body, own in zip(rows.tolist(), bodies, fresh, strict=True):
        if own:
            f, n = next(spans)
            yield row, int(places[3, row]), repeated[f:f + n], body
        else:
            yield row, int(places[3, row]), np.ones(len(body) - LENGTH + 1, dtype=bool), body


def _stretches(flags: np.ndarray) -> Iterator[tuple[int, int]]:
    edge = np.concatenate([[False], flags, [False]])
    turns = np.flatnonzero(edge[1:] != edge[:-1]).tolist()
    return zip(turns[::2], turns[1::2], strict=True)


GONE = "doc_id long, content long, start int, end int"
WINDOWS = GONE + ", body binary"


def _gone_batch(out: list[tuple], bodies: bool = False) -> pa.RecordBatch:
    names = ("doc_id", "content", "start", "end", "body")[:5 if bodies else 4]
    types = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
    columns = list(zip(*out, strict=True)) if out else [[]] * len(names)
    return pa.record_batch({n: pa.array(c, t) for n, c, t in zip(names, columns, types)})


def _sort_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a partition sorted by anchor and place: the stretches of suffixes that are repeated."""

    def settle(table: pa.Table) -> Iterator[pa.RecordBatch]:
        ids, contents = table["doc_id"].to_numpy(), table["content"].to_numpy()
        yield _gone_batch([(int(ids[row]), int(contents[row]), start + s, start + e)
                           for row, start, repeated, _ in _judged(table) for s, e in _stretches(repeated)])

    held, size = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += batch["body"].nbytes
        if size < SORTED_BYTES:
            continue
        table = pa.Table.from_batches(held)
        anchors = table["anchor"].to_numpy()
        ends = np.flatnonzero(anchors[1:] != anchors[:-1]) + 1  # of the anchors that are complete
        if not len(ends):
            continue
        yield from settle(table.slice(0, int(ends[-1])))
        held = table.slice(int(ends[-1])).combine_chunks().to_batches()
        size = sum(x["body"].nbytes for x in held)
    if held:
        yield from settle(pa.Table.from_batches(held))


def _first_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of any pieces, about WINDOW_BYTES at a time: the stretches of suffixes that are repeated among
    them, without a body, and each other suffix with its LENGTH bytes."""

    def settle(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held).sort_by([(c, "ascending") for c in ("anchor", "doc_id", "content", "start")])
        ids, contents = table["doc_id"].to_numpy(), table["content"].to_numpy()
        out: list[tuple] = []
        for row, start, repeated, body in _judged(table):
            place = (int(ids[row]), int(contents[row]))
            out += [(*place, start + s, start + e, None) for s, e in _stretches(repeated)]
            out += [(*place, start + s, start + s + 1, body[s:s + LENGTH]) for s in np.flatnonzero(~repeated).tolist()]
            if len(out) > ROWS_OUT:
                yield _gone_batch(out, bodies=True)
                out = []
        yield _gone_batch(out, bodies=True)

    held, size = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += batch["body"].nbytes
        if size >= WINDOW_BYTES:
            yield from settle(held)
            held, size = [], 0
    if held:
        yield from settle(held)


PLACED = "part int, first boolean, last boolean, repeated boolean, body binary, " \
         "doc_id long, content long, start int"


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a sorted partition: the rows whose bytes equal the ones before, at another place, and the
    first and last row, which the neighbouring partitions need."""
    part, last = TaskContext.get().partitionId(), None
    columns = ("body", "doc_id", "content", "start")

    def out(batch: pa.RecordBatch, first: bool, is_last: bool, repeated: bool) -> pa.RecordBatch:
        n = batch.num_rows
        flags = {"part": pa.array([part] * n, pa.int32()), "first": pa.array([first] * n, pa.bool_()),
                 "last": pa.array([is_last] * n, pa.bool_()), "repeated": pa.array([repeated] * n, pa.bool_())}
        bodies = batch["body"] if not repeated else pa.nulls(n, pa.binary())
        return pa.record_batch({**flags, "body": bodies, **{c: batch[c] for c in columns[1:]}})

    for batch in batches:
        if not batch.num_rows:
            continue
        if last is None:
            yield out(batch.slice(0, 1), True, False, False)
        bodies = batch["body"].to_pylist()
        places = list(zip(*(batch[c].to_pylist() for c in columns[1:]), strict=True))
        before = [last["body"][0].as_py() if last is not None else None, *bodies[:-1]]
        at = [tuple(last[c][0].as_py() for c in columns[1:]) if last is not None else None, *places[:-1]]
        same = [x == y and p != q for x, y, p, q in zip(bodies, before, places, at, strict=True)]
        yield out(batch.filter(pa.array(same)), False, False, True)
        last = batch.slice(batch.num_rows - 1, 1)
    if last is not None:
        yield out(last, False, True, False)


def _repeated(windows: DataFrame) -> DataFrame:
    """The places of the suffixes that have an equal one before them."""
    order = ["body", "doc_id", "content", "start"]
    rows = written(windows.select(order).repartitionByRange(shuffle_partitions(windows.sparkSession), *order)
                   .sortWithinPartitions(*order).mapInArrow(_compare, PLACED), "adjacent")
    # Two rows per task: its first, and the last of the nearest task before it.
    lasts = rows.where("last").select(F.col("part").alias("end_part"), F.col("body").alias("end_body"))
    firsts = rows.where("first").select("part", *order)
    previous = (firsts.join(lasts, F.col("end_part") < F.col("part")).groupBy("part", *order)
                .agg(F.max(F.struct("end_part", "end_body")).alias("before")))
    place = ["doc_id", "content", "start", (F.col("start") + 1).alias("end")]
    return (rows.where("repeated").select(place)
            .union(previous.where("before.end_body = body").select(place)))


@contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """A job's shuffle files go when its result is written, not when the driver collects garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    if spark.conf.get(key, None) is not None:
        yield
        return
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n_bytes, n_removed, n_spans, digests, kept = [], [], [], [], []
        for text, copy, gone in zip(batch["text"], batch["copy"].to_pylist(), batch["gone"], strict=True):
            raw = text.as_py().encode()
            lost = np.zeros(len(raw), dtype=bool)
            if copy and len(raw) >= LENGTH:
                lost[:] = True
            elif gone.is_valid:
                change = np.zeros(len(raw) + 1, np.int32)
                np.add.at(change, gone.values.field("start").to_numpy(), 1)
                np.add.at(change, gone.values.field("end").to_numpy() + LENGTH - 1, -1)
                lost = np.cumsum(change[:-1]) > 0
            rest = np.frombuffer(raw, np.uint8)[~lost].tobytes()
            n_bytes.append(len(raw))
            n_removed.append(int(lost.sum()))
            n_spans.append(int((lost & ~np.concatenate([[False], lost])[:-1]).sum()))
            digests.append(hashlib.sha256(rest).hexdigest())
            kept.append(rest)
        yield pa.record_batch({
            "doc_id": batch["doc_id"], "n_bytes": pa.array(n_bytes, pa.int64()),
            "n_removed": pa.array(n_removed, pa.int64()), "n_spans": pa.array(n_spans, pa.int64()),
            "kept_sha256": pa.array(digests, pa.string()), "kept": pa.array(kept, pa.binary())})


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and the kept bytes of each row."""
    texts = id_and_text(docs, id_col, text_col).withColumn("content", F.xxhash64("text"))
    small_batches(docs.sparkSession)
    known = texts.where("doc_id IS NOT NULL")
    owners = known.groupBy("content").agg(F.min("doc_id").alias("owner"))

    anchors = known.select("content", "text").mapInArrow(_emit_anchors, "a long, content long")
    keys = (anchors.groupBy("a").agg(F.min("content").alias("lo"), F.max("content").alias("hi"),
                                     F.count("*").alias("n"))
            .where("lo < hi").select("a", (F.col("n") > SPREAD).alias("far")))
    shared = (anchors.join(keys, "a").groupBy("content")  # within a document
              .agg(F.collect_set("a").alias("shared"), F.collect_set(F.when(F.col("far"), F.col("a"))).alias("spread")))
    sources = owners.join(shared, "content").withColumnRenamed("content", "source")
    spark = docs.sparkSession
    with _shuffles_removed(spark):
        sources = written(sources, "shared")
        pieces = written(
            known.join(sources, (F.col("content") == F.col("source")) & (F.col("doc_id") == F.col("owner")))
            .select("doc_id", "content", "text", "shared", "spread").mapInArrow(_emit_pieces, PIECES), "pieces")
        known_gone = pieces.where("body IS NULL").select("doc_id", "content", "start", "end")
        pieces = pieces.where("body IS NOT NULL").drop("end")
        common = (pieces.where("spread").groupBy("anchor").agg(F.count("*").alias("n"))
                  .where(F.col("n") > SPREAD).select("anchor", F.lit(True).alias("common")))
        # At most a key for each SPREAD rows; one join for all pieces, which stay where they are.
        pieces = pieces.join(F.broadcast(common), "anchor", "left").withColumn(
            "common", F.col("spread") & F.col("common").isNotNull())
        order = ["anchor", "body", "doc_id", "content", "start"]
        windows = written(pieces.where("common").drop("common")
                          .repartitionByRange(shuffle_partitions(spark), *order)
                          .sortWithinPartitions(*order).mapInArrow(_first_windows, WINDOWS), "windows")
        far = (windows.where("body IS NULL").drop("body").union(known_gone)
               .union(_repeated(windows.where("body IS NOT NULL"))))
        near = (pieces.where("NOT common").drop("spread", "common").repartition(shuffle_partitions(spark), "anchor")
                .sortWithinPartitions("anchor", "doc_id", "content", "start").mapInArrow(_sort_anchors, GONE))
        gone = written(near.union(far), "gone").groupBy("content").agg(
            F.collect_list(F.struct("start", "end")).alias("gone"))  # within a document, the owner

    # All small tables first: the texts are shuffled and sorted once.
    marks = owners.join(gone, "content", "left")
    marked = texts.join(marks, "content", "left").select(
        "doc_id", "text", F.coalesce(F.col("doc_id") > F.col("owner"), F.lit(False)).alias("copy"),
        F.when(F.col("doc_id") == F.col("owner"), F.col("gone")).alias("gone"))
    return marked.mapInArrow(_cut, "doc_id long, n_bytes long, n_removed long, n_spans long, "
                                   "kept_sha256 string, kept binary")
