"""Sum-of-squares online packing of token sequences.

Each document is tokenised (ids, then an end id) and its full windows of ``capacity``
ids are cut off as sequences of their own. What is left, of s ids, goes to the fill
level h that minimises the sum of squared counts of partially filled windows, kept in
an array N[h]: moving a window from h to h + s changes the sum by 2 (N[h+s] - N[h] + 1),
opening one by 2 N[s] + 1, closing one by 1 - 2 N[h]. Partitions pack on their own, so no
row is shuffled and a lost executor costs only its own partitions.

Windows still open when a partition ends (or when more than ``max_open`` are, which
bounds the memory) are closed by cutting: those nearly full stay as they are, the ids of
the others are laid end to end into full windows, and the rest of under one window is cut
at its powers of two, which need no padding.

Defined results: a null or empty text is the end id alone. Every input row is packed,
repeated rows and null ids too. An empty table gives an empty result. Extra columns are
ignored. Sequence ids depend on how the input is partitioned; the ids of each document do
not.

Tokenising is cached by word: a word's ids do not depend on its neighbours. A cache that
has reached its bound starts anew.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from clickcredit.llm.shared import id_and_text

SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
# Texts that need the tokenizer's own normal form and split: characters from U+0250 on, a
# capital that lowers to two characters, other white space, what may begin a special token.
_SPECIAL = re.compile("[\u0250-\U0010ffff\u0130\x1c-\x1f\x85\xa0]|<\\|")
# The tokenizer's first split, for all other characters.
_LETTER, _NUMBER = "A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼½¾"
_PART = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_NUMBER}]|[^\\x20\\x09-\\x0D{_LETTER}{_NUMBER}]+")
_CACHED_PARTS = 800_000


def _byte_spelling() -> dict[int, str]:
    """How byte-level vocabularies spell bytes: visible ones as themselves, the others, in
    order, as characters from U+0100 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    return {b: chr(b) for b in visible} | {b: chr(256 + i) for i, b in enumerate(hidden)}


_SPELLING = _byte_spelling()
_NEARLY = 8  # ids short of full at which an open window is left as it is


class WordTokenizer:
    """Ids of whole texts by a tokenizer file that lower-cases, drops white space and then
    splits into words, single digits and runs of signs, each encoded on its own."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task per core already
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._known: dict[str, bytes] = {}

    def _learn(self, parts: set[str]) -> None:
        if len(self._known) > _CACHED_PARTS:
            self._known.clear()
        model = self._tokenizer.model
        for p in parts:
            spelled = p if p.isascii() else p.encode().decode("latin1").translate(_SPELLING)
            self._known[p] = b"".join([t.id.to_bytes(4, "little") for t in model.tokenize(spelled)])

    def _plain(self, text: str) -> bytes:
        parts = _PART.findall(text.lower())
        try:
            return b"".join(map(self._known.__getitem__, parts))
        except KeyError:
            self._learn(set(parts).difference(self._known))
            if not all(map(self._known.__contains__, parts)):  # the cache was emptied
                self._learn(set(parts))
            return b"".join(map(self._known.__getitem__, parts))

    def _whole(self, text: str) -> bytes:
        return np.array(self._tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def ids(self, text: str) -> bytes:
        """The text's ids as little-endian unsigned 32-bit integers."""
        if not _SPECIAL.search(text):
            return self._plain(text)
        return b"".join([self._whole(w) if _SPECIAL.search(w) else self._plain(w)
                         for w in _WORD.findall(text)])


class SumOfSquares:
    """Online packer of one partition; ``emit`` gets a finished piece's fields."""

    def __init__(self, capacity: int, first_sequence: int, max_open: int, emit: Callable):
        self.capacity, self.next, self.max_open, self.emit = capacity, first_sequence, max_open, emit
        self.level = np.zeros(capacity + 1, np.int64)  # N[h], 0 < h < capacity
        self.open: list[list] = [[] for _ in range(capacity + 1)]  # windows by fill
        self.n_open = 0

    def _close(self, pieces: list) -> None:
        offset = 0
        for doc, total, start, ids in pieces:
            self.emit(doc, start, ids, total, self.next, offset)
            offset += len(ids) // 4
        self.next += 1

    def add(self, doc: int | None, ids: bytes) -> None:
        total, width = len(ids) // 4, self.capacity * 4
        full = len(ids) - len(ids) % width
        for at in range(0, full, width):
            self._close([(doc, total, at // 4, ids[at:at + width])])
        if full < len(ids):
            self._place((doc, total, full // 4, ids[full:]))

    def _place(self, piece: tuple) -> None:
        size = len(piece[3]) // 4
        n = self.level
        fits = self.capacity - size
        change = n[size:] - n[:fits + 1]  # moving a window from h to h + size, h = 0 .. fits
        change[fits] = -n[fits]
        change[1:][n[1:fits + 1] == 0] = np.iinfo(np.int64).max
        # In units of 2: a move costs change + 1, opening N[size] + 1/2, closing 1/2 - N[h].
        cost = 2 * np.minimum(change, 1 << 60) + 2
        cost[0] = 2 * n[size] + 1
        if fits:
            cost[fits] = 1 - 2 * n[fits] if n[fits] else 1 << 61
        h = int(len(cost) - 1 - np.argmin(cost[::-1]))  # ties: the fullest
        if h:
            pieces = self.open[h].pop()
            n[h] -= 1
            self.n_open -= 1
        else:
            pieces = []
        pieces.append(piece)
        if h + size == self.capacity:
            self._close(pieces)
            return
        self.open[h + size].append(pieces)
        n[h + size] += 1
        self.n_open += 1
        if self.n_open > self.max_open:
            self.finish()

    def finish(self) -> None:
        """Close all open windows."""
        line: list[tuple] = []
        for h in range(self.capacity - 1, 0, -1):
            for pieces in self.open[h]:
                if h >= self.capacity - _NEARLY:
                    self._close(pieces)
                else:
                    line += pieces
            self.open[h] = []
        self.level[:] = 0
        self.n_open = 0
        left = sum(len(p[3]) for p in line) // 4
        line.reverse()
        while left:
            room = self.capacity if left >= self.capacity else 1 << (left.bit_length() - 1)
            left -= room
            pieces = []
            while room:
                doc, total, start, ids = line.pop()
                if len(ids) // 4 > room:
                    line.append((doc, total, start + room, ids[room * 4:]))
                    ids = ids[:room * 4]
                pieces.append((doc, total, start, ids))
                room -= len(ids) // 4
            self._close(pieces)


_TOKENIZERS: dict[str, WordTokenizer] = {}


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 1,
         max_open: int = 1024, with_ids: bool = False, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """One row per piece; ``with_ids`` adds its ids (little-endian unsigned 32-bit)."""
    schema = SCHEMA + (", ids binary" if with_ids else "")
    names = [x.split()[0] for x in schema.split(", ")]
    types = [pa.int64()] * 7 + [pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if tokenizer_path not in _TOKENIZERS:
            _TOKENIZERS[tokenizer_path] = WordTokenizer(tokenizer_path)
        tokenizer = _TOKENIZERS[tokenizer_path]
        rows: list[tuple] = []

        def emit(doc, start, ids, total, sequence, offset):
            row = (doc, start, len(ids) // 4, zlib.crc32(ids), total, sequence, offset)
            rows.append(row + (ids,) if with_ids else row)

        def out() -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
            rows.clear()
            return pa.record_batch([pa.array(c, t) for c, t in
                                    zip(columns, types[:len(names)], strict=True)], names=names)

        end = np.array([end_id], "<u4").tobytes()
        packer = SumOfSquares(capacity, TaskContext.get().partitionId() << 36, max_open, emit)
        for batch in batches:
            for doc, text in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
                packer.add(doc, tokenizer.ids(text.as_py()) + end)
                if len(rows) >= 4096:
                    yield out()
        packer.finish()
        yield out()

    return id_and_text(docs, id_col, text_col).mapInArrow(run, schema)
