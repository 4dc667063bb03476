"""Alignment of two tokenizers' tokens of the same text, and counts of linked id pairs.

For each text the cumulative byte ends of tokens A and of tokens B go into dictionaries from end to
index. The intersection of their keys, sorted, are the places where both tokenizers end a
token; they slice both id lists into groups, and every A token of a group is linked with every B
token of it. How many documents hold an id pair linked is counted over the whole table.

Documents are put into blocks that hold about ``BLOCK_LINKS`` distinct links in total, each a
row of one table in the shared folder. What is shuffled by id pair is one row per block and pair, not
per document, so a pair that all documents hold is one short row a block. Counts come back
to the blocks by a join, and each block's documents are summed in one Arrow row. What a block has for
each link of each document travels as compressed bytes, so that its row is small. The most frequent
count of each A id is broadcast; it has no more rows than A's vocabulary.

Tokens of a word with the white space before it don't depend on what is around it, and both
tokenizers end a token at its end, so such stretches are tokenised and sliced once per cache. This is
checked in the tokenizer files; with others, whole texts are tokenised and sliced. When the cache has reached its bound, what was not met since the last
time goes.

Defined results: a null or empty text, and one whose tokens of A or B don't spell a space
and the text, has no tokens: zeros and ''. Every row gives a row and counts as a document, repeated
ones and null ids too. Counts that tie for an A id are all its best. An empty table gives an empty result. Extra columns are ignored. Memory
grows with one document's distinct links, never with all its links.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickcredit.llm.packing import _byte_spelling
from clickcredit.llm.shared import id_and_text, small_batches, written

BLOCK_LINKS = 1 << 18
_CACHED = 200_000  # stretches, half of them from before the last time the cache was full
_CACHED_CHARS = 64  # longer stretches are rarely met again
_SHARED = 32  # bytes of tokens per group; longer ones are rarely shared
_EXPANDED = 1 << 20  # links of a group beyond which ids are counted before they are paired
_STRETCH = re.compile(r"\s*\S+|\s+")
# Fixed value: the split of byte-level tokenizer files that state use_regex.
_BYTE_LEVEL_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_BYTE_PIECE = re.compile("<0x([0-9A-F]{2})>")
BLOCK_SCHEMA = ("block string, ids array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, "
                "n_links array<long>, groups array<string>, codes array<long>, held array<long>, "
                "sizes array<int>, at binary, weight binary")


class TokenizerA:
    """A byte-level tokenizer file of the ``tokenizers`` library."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task per core already
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = True  # their strings in a text are plain text
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        split = file.get("pre_tokenizer") or {}
        self.by_stretch = (file.get("normalizer") is None and split.get("type") == "ByteLevel"
                           and split.get("use_regex", True) and not split.get("add_prefix_space"))
        spelled = {c: b for b, c in _byte_spelling().items()}
        vocabulary = self._tokenizer.get_vocab(with_added_tokens=True)
        self.tokens = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.tokens[i] = bytes(spelled[c] for c in token) if all(c in spelled for c in token) else token.encode()
        # Where ids follow the merges, ids are the ranks that tiktoken merges by, which is faster.
        merges = file["model"].get("merges", []) if file["model"].get("type") == "BPE" else []
        own = file["model"]["vocab"]
        parts = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in merges]
        self._ranked = None
        if self.by_stretch and len(own) >= 256 + len(merges) and all(own.get(m) == 256 + k for k, m in enumerate(parts)):
            import tiktoken

            ranks = {self.tokens[i]: i for i in range(256 + len(merges))}
            if len(ranks) == 256 + len(merges):
                self._ranked = tiktoken.Encoding("own", pat_str=_BYTE_LEVEL_SPLIT, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> list[int]:
        return self._tokenizer.encode(text, add_special_tokens=False).ids

    def encode_row(self, text: str) -> list[int]:
        """Ids of short stretches in a row."""
        return self._ranked.encode_ordinary(text) if self._ranked else self.encode(text)


class TokenizerB:
    """A model file of the ``sentencepiece`` library, which puts a space before each text."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self._model = SentencePieceProcessor(model_file=path)
        pieces = [self._model.id_to_piece(i) for i in range(self._model.get_piece_size())]
        byte_of = [_BYTE_PIECE.fullmatch(p) if self._model.is_byte(i) else None for i, p in enumerate(pieces)]
        self.tokens = [bytes([int(m[1], 16)]) if m else p.replace("▁", " ").encode()
                       for p, m in zip(pieces, byte_of, strict=True)]
        self.spaces = {c for p in pieces for c in p if c.isspace()}  # in pieces, besides the space
        # No piece has a space behind another character, and texts are not normalised.
        self.by_stretch = (not any(re.search("[^▁]▁", p) for p in pieces)
                           and b"".join(map(self.tokens.__getitem__, self.encode("ﬁ  ½ "))) == " ﬁ  ½ ".encode())

    def encode(self, text: str) -> list[int]:
        return self._model.encode(text)


def common_ends(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many tokens of A and of B end up to each byte where both end."""
    index_a = dict(zip(ends_a.tolist(), range(1, len(ends_a) + 1), strict=True))
    index_b = dict(zip(ends_b.tolist(), range(1, len(ends_b) + 1), strict=True))
    common = sorted(filter(index_b.__contains__, index_a))
    return (np.fromiter(map(index_a.__getitem__, common), np.int64, len(common)),
            np.fromiter(map(index_b.__getitem__, common), np.int64, len(common)))


class GroupsText:
    """Writes groups as ``a1,a2|b1;a3|b2,b3``, the ids of each in order."""

    def __init__(self, n_a: int, n_b: int):
        self._a, self._b = ([np.array([f"{i}{mark}" for i in range(n)], dtype=object) for mark in marks]
                            for n, marks in ((n_a, ",|"), (n_b, ",;")))

    def pieces(self, ids_a: np.ndarray, ids_b: np.ndarray, cuts_a: np.ndarray, cuts_b: np.ndarray) -> list[str]:
        """One text for each token, in the order of the groups."""
        n_a, n_b = np.diff(cuts_a, prepend=0), np.diff(cuts_b, prepend=0)
        out = np.empty(len(ids_a) + len(ids_b), dtype=object)
        place_a = np.arange(len(ids_a)) + np.repeat(cuts_b - n_b, n_a)
        place_b = np.arange(len(ids_b)) + np.repeat(cuts_a, n_b)
        for (inner, closing), ids, place, cuts in ((self._a, ids_a, place_a, cuts_a), (self._b, ids_b, place_b, cuts_b)):
            out[place] = inner[ids]
            out[place[cuts - 1]] = closing[ids[cuts - 1]]
        return out.tolist()


class Pair:
    """Both tokenizers, with a cache of stretches."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = TokenizerA(path_a), TokenizerB(path_b)
        self.size_a, self.size_b = (np.array([len(t) for t in x.tokens], np.int64) for x in (self.a, self.b))
        self.by_stretch = self.a.by_stretch and self.b.by_stretch
        # Texts with white space that is in pieces, or that is white space to Python's patterns
        # alone, are tokenised whole.
        self._whole = re.compile("[" + re.escape("".join(sorted({*self.b.spaces, *"\x1c\x1d\x1e\x1f"}))) + "]")
        self._text = GroupsText(len(self.a.tokens), len(self.b.tokens))
        # Ids and tokens per group of A and of B as bytes, and the groups' text.
        self._known: dict[str, tuple[bytes, bytes, bytes, bytes, str]] = {}
        self._older = self._known  # of which what is met again moves on
        self._counts: dict[bytes, bytes] = {}  # tokens per group that many stretches share
        self._misspelled: set[str] = set()  # stretches whose tokens spell something else

    def _encode(self, text: str, row: bool = False) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of a text that begins with a space; None if A or B spells something else."""
        raw = text.encode()
        ids_a, ids_b = self.a.encode_row(text) if row else self.a.encode(text), self.b.encode(text[1:])
        if (b"".join(map(self.a.tokens.__getitem__, ids_a)) != raw
                or b"".join(map(self.b.tokens.__getitem__, ids_b)) != raw):
            return None
        return np.array(ids_a, "<i4"), np.array(ids_b, "<i4")

    def _grouped(self, ids_a: np.ndarray, ids_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return common_ends(np.cumsum(self.size_a[ids_a]), np.cumsum(self.size_b[ids_b]))

    def _store(self, stretches: list[str], sizes: list[int], ids_a: np.ndarray, ids_b: np.ndarray) -> bool:
        """Cut the tokens of stretches in a row, behind two bytes, apart; False if a token of A or B
        goes over an end."""
        cuts_a, cuts_b = self._grouped(ids_a, ids_b)
        group_ends = np.cumsum(self.size_a[ids_a])[cuts_a - 1]  # bytes
        wanted = np.cumsum([2, *sizes])
        at = np.searchsorted(group_ends, wanted)
        if not np.array_equal(group_ends[np.minimum(at, len(group_ends) - 1)], wanted):
            return False
        n_a, n_b = np.diff(cuts_a, prepend=0).astype("<i4"), np.diff(cuts_b, prepend=0).astype("<i4")
        pieces = self._text.pieces(ids_a, ids_b, cuts_a, cuts_b)
        to_a, to_b, groups = cuts_a[at].tolist(), cuts_b[at].tolist(), (at + 1).tolist()
        all_a, all_b, all_n_a, all_n_b = (x.tobytes() for x in (ids_a, ids_b, n_a, n_b))
        for k, s in enumerate(stretches):
            a, end_a, b, end_b, g, end_g = to_a[k], to_a[k + 1], to_b[k], to_b[k + 1], groups[k], groups[k + 1]
            counts = all_n_a[4 * g:4 * end_g], all_n_b[4 * g:4 * end_g]
            n_a, n_b = (self._counts.setdefault(n, n) if len(n) <= _SHARED else n for n in counts)
            self._known[s] = (all_a[4 * a:4 * end_a], all_b[4 * b:4 * end_b], n_a, n_b,
                              "".join(pieces[a + b:end_a + end_b]))
        return True

    def _learn(self, new: set[str]) -> None:
        """Short stretches that end in a word are encoded in a row and cut apart again; a long one,
        or white space that ends a text and would run on into the next, alone."""
        met = {s: self._older[s] for s in new if s in self._older}
        self._known.update(met)
        short = [s for s in new if s not in met and len(s) <= _CACHED_CHARS and not s[-1].isspace()]
        row = self._encode(" a" + "".join(short), row=True)
        stored = row is not None and self._store(short, [len(s.encode()) for s in short], *row)
        for s in new.difference(self._known) if not stored or len(short) + len(met) < len(new) else ():
            ids = self._encode(" a" + s)
            if ids is None or not self._store([s], [len(s.encode())], *ids):
                self._known[s] = (b"", b"", b"", b"", "")
                self._misspelled.add(s)

    def align(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, str] | None:
        """A's and B's ids of a space and the text, how many tokens of A and of B end up to the end of
        each group, and the groups' text; None if A or B spells something else."""
        if not text:
            return None
        if not self.by_stretch or self._whole.search(text):
            both = self._encode(" " + text)
            if both is None:
                return None
            cuts = self._grouped(*both)
            return *both, *cuts, "".join(self._text.pieces(*both, *cuts))[:-1]
        stretches = _STRETCH.findall(" " + text)
        if 2 * len(self._known) > _CACHED:
            self._known, self._older, self._counts = {}, self._known, {}
            self._misspelled.intersection_update(self._older)
        if new := set(stretches).difference(self._known):
            self._learn(new)
        ids_a, ids_b, n_a, n_b, texts = zip(*map(self._known.__getitem__, stretches), strict=True)
        for s in [s for s in new if len(s) > _CACHED_CHARS]:
            del self._known[s]
        if self._misspelled and not self._misspelled.isdisjoint(stretches):
            return None
        ids_a, ids_b, n_a, n_b = (np.frombuffer(b"".join(x), "<i4") for x in (ids_a, ids_b, n_a, n_b))
        return ids_a, ids_b, np.cumsum(n_a, dtype=np.int64), np.cumsum(n_b, dtype=np.int64), "".join(texts)[:-1]

    def ids(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        found = self.align(text)
        return found and found[:2]


def _summed(codes: np.ndarray, weight: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    if weight is None:
        return np.unique(codes, return_counts=True)
    codes, at = np.unique(codes, return_inverse=True)
    out = np.zeros(len(codes), np.int64)
    np.add.at(out, at, weight)
    return codes, out


def links(ids_a: np.ndarray, ids_b: np.ndarray, cuts_a: np.ndarray, cuts_b: np.ndarray
          ) -> tuple[np.ndarray, np.ndarray]:
    """Distinct id pairs linked in a document, a * 2**32 + b ascending, and how many links each has."""
    start_a, start_b = np.append(0, cuts_a[:-1]), np.append(0, cuts_b[:-1])
    n_a, n_b = cuts_a - start_a, cuts_b - start_b
    n = n_a * n_b
    large = n > _EXPANDED
    codes, weights = [], []
    for g in np.flatnonzero(large).tolist():
        a, of_a = np.unique(ids_a[start_a[g]:cuts_a[g]].astype(np.int64), return_counts=True)
        b, of_b = np.unique(ids_b[start_b[g]:cuts_b[g]].astype(np.int64), return_counts=True)
        codes.append(((a << 32)[:, None] | b).ravel())
        weights.append((of_a[:, None] * of_b).ravel())
    rest = np.flatnonzero(~large)
    done = np.append(0, np.cumsum(n[rest]))
    lo = 0
    while lo < len(rest):  # so many groups at a time that their links are bounded
        hi = max(int(np.searchsorted(done, done[lo] + _EXPANDED, side="right")) - 1, lo + 1)
        g = np.repeat(rest[lo:hi], n[rest[lo:hi]])
        within = np.arange(len(g)) - np.repeat(done[lo:hi] - done[lo], n[rest[lo:hi]])
        a = ids_a[start_a[g] + within // n_b[g]].astype(np.int64)
        found, times = _summed((a << 32) | ids_b[start_b[g] + within % n_b[g]])
        codes.append(found)
        weights.append(times)
        lo = hi
    if len(codes) == 1:
        return codes[0], weights[0]
    return _summed(np.concatenate(codes), np.concatenate(weights))


def _packed(values: np.ndarray) -> bytes:
    """Integers from 0 on as compressed differences, as wide as the largest integer."""
    values = values.astype(np.min_scalar_type(values.max(initial=0)).newbyteorder("<"))
    return zlib.compress(np.diff(values, prepend=values.dtype.type(0)).tobytes(), 1)  # they wrap around


def _unpacked(packed: bytes, n: int) -> np.ndarray:
    raw = zlib.decompress(packed)
    kind = f"<u{len(raw) // n if n else 1}"
    return np.cumsum(np.frombuffer(raw, kind), dtype=kind).astype(np.int64)


def _blocks(path_a: str, path_b: str, block_links: int, with_groups: bool):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = Pair(path_a, path_b)
        rows: list[tuple] = []
        found: list[tuple[np.ndarray, np.ndarray]] = []
        total = 0

        def block() -> pa.RecordBatch:
            every = np.concatenate([c for c, _ in found]) if found else np.zeros(0, np.int64)
            codes, at, held = np.unique(every, return_inverse=True, return_counts=True)
            columns = [[r[k] for r in rows] for k in range(6)]
            values = [*columns, codes, held, np.array([len(c) for c, _ in found], np.int32)]
            types = [pa.int64()] * 5 + [pa.string()] + [pa.int64()] * 2 + [pa.int32()]
            weight = np.concatenate([w for _, w in found]) if found else np.zeros(0, np.int64)
            lists = [pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), pa.array(v, t))
                     for v, t in zip(values, types, strict=True)]
            return pa.RecordBatch.from_arrays(
                [pa.array([uuid.uuid4().hex]), *lists, *(pa.array([_packed(x)]) for x in (at, weight))],
                names=["block", "ids", "n_a", "n_b", "n_groups", "n_links", "groups",
                       "codes", "held", "sizes", "at", "weight"])

        none = np.zeros(0, np.int64)
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                aligned = pair.align(text.as_py())
                if aligned is None:
                    rows.append((doc_id.as_py(), 0, 0, 0, 0, ""))
                    found.append((none, none))
                else:
                    ids_a, ids_b, *cuts, groups = aligned
                    if not with_groups:
                        groups = hashlib.sha256(groups.encode()).hexdigest()
                    found.append(links(ids_a, ids_b, *cuts))
                    rows.append((doc_id.as_py(), len(ids_a), len(ids_b), len(cuts[0]),
                                 int(found[-1][1].sum()), groups))
                total += len(found[-1][0]) + 1
                if total >= block_links:
                    yield block()
                    rows, found, total = [], [], 0
        if rows:
            yield block()

    return emit


def _scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a document again, with the counts of its links summed."""
    for batch in batches:
        for row in range(batch.num_rows):
            value = lambda name: batch[name][row].values  # noqa: E731, B023
            counts, best = (np.zeros(len(value("codes")), np.int64) for _ in range(2))
            known = batch["known"][row].values  # None for a block without links
            if known is not None and len(known):
                place = np.searchsorted(value("codes").to_numpy(), known.field("code").to_numpy())
                counts[place] = known.field("n").to_numpy()
                best[place] = known.field("best").to_numpy(zero_copy_only=False)
            bounds = np.append(0, np.cumsum(value("sizes").to_numpy()))
            at, weight = (_unpacked(batch[name][row].as_py(), int(bounds[-1])) for name in ("at", "weight"))
            sums = [np.diff(np.append(0, np.cumsum(of[at] * weight))[bounds]) for of in (best, counts)]
            yield pa.RecordBatch.from_arrays(
                [*(value(c) for c in ("ids", "n_a", "n_b", "n_groups", "n_links")), *map(pa.array, sums),
                 value("groups")],
                names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"])


def aligned_blocks(docs: DataFrame, path_a: str, path_b: str, block_links: int = BLOCK_LINKS,
                   with_groups: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The table of blocks (``BLOCK_SCHEMA``), written to the shared folder."""
    small_batches(docs.sparkSession)
    return written(id_and_text(docs, id_col, text_col).mapInArrow(
        _blocks(path_a, path_b, block_links, with_groups), BLOCK_SCHEMA), "aligned")


def _spread(blocks: DataFrame) -> DataFrame:
    return blocks.select("block", F.explode(F.arrays_zip("codes", "held")).alias("x")).select(
        "block", F.col("x.codes").alias("code"), F.col("x.held").alias("held"))


def pair_counts(blocks: DataFrame) -> DataFrame:
    """id_a, id_b, documents: how many documents hold the pair linked."""
    return _spread(blocks).groupBy("code").agg(F.sum("held").alias("documents")).select(
        F.shiftright("code", 32).cast("int").alias("id_a"),
        F.col("code").bitwiseAND(0xFFFFFFFF).cast("int").alias("id_b"), "documents")


def align(docs: DataFrame, path_a: str, path_b: str, block_links: int = BLOCK_LINKS,
          with_groups: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups of each row.

    ``groups`` is the text of ``GroupsText`` or, unless ``with_groups``, its SHA-256 in hex.
    """
    blocks = aligned_blocks(docs, path_a, path_b, block_links, with_groups, id_col, text_col)
    counts = written(_spread(blocks).groupBy("code").agg(F.sum("held").alias("n"))
                     .withColumn("a", F.shiftright("code", 32)), "pairs")
    highest = counts.groupBy("a").agg(F.max("n").alias("highest"))  # no more rows than ids of A
    marked = (counts.join(F.broadcast(highest), "a")
              .select("code", "n", (F.col("n") == F.col("highest")).alias("best")))
    known = (_spread(blocks).join(marked, "code").groupBy("block")
             .agg(F.collect_list(F.struct("code", "n", "best")).alias("known")))  # bounded as a block is
    return blocks.drop("held").join(known, "block", "left").mapInArrow(
        _scored, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, "
                 "count_sum long, groups string")
