"""Fill-in-middle transformation with cuts found by Fenwick trees.

A text is cut into units: a word with the white space before it, or the white space that
ends the text. Over fixed blocks of its bytes a Fenwick tree holds two counts, the units
that end in a block and the code points that begin in it. To find the end of unit k, a
descent by binary lifting goes to the block where it lies and sums the code points before
that block; the exact place is then found inside this one block.

Python finds only the two cuts of each text, in Arrow batches; hashes that decide, pieces and output
are Spark functions. Nothing is shuffled, so a hot source, copies or a lost executor
cost no more than their own rows.

The numbers that decide are the first four groups of eight hex digits of the SHA-256 of
"seed:id", so a row's form depends on its id alone and not on partitions.

Defined results: a null or empty text, and one that holds a mark, is given back plain
(n counts its units, 0 for none). A null id is hashed as no digits ("seed:"). Every row
gives a row, repeated ones too. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickcredit.llm.shared import id_and_text
from clickcredit.llm.words import is_space, slices

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 42
FIM_PERCENT = 50  # of documents that are rearranged
SPM_PERCENT = 80  # of those, suffix first
BLOCK_BYTES = 512


class UnitTree:
    """Fenwick tree of (units that end, code points that begin) in blocks of one text."""

    def __init__(self, data: np.ndarray, block: int = BLOCK_BYTES):
        self.data, self.block = data, block
        n = len(data)
        self.starts = np.arange(0, n, block)
        self.ends = np.zeros(n, dtype=bool)  # bytes that are the last one of a unit
        if n:
            solid = ~is_space(data)
            np.greater(solid[:-1], solid[1:], out=self.ends[:-1])
            self.ends[-1] = True
        self.begins = (data & 0xC0) != 0x80  # bytes that begin a code point
        self.tree = np.zeros((len(self.starts) + 1, 2), np.int64)
        if n:
            sums = np.zeros_like(self.tree)
            sums[1:, 0] = np.add.reduceat(self.ends, self.starts, dtype=np.int64)
            sums[1:, 1] = np.add.reduceat(self.begins, self.starts, dtype=np.int64)
            np.cumsum(sums, axis=0, out=sums)
            i = np.arange(len(sums))
            self.tree = sums - sums[i - (i & -i)]  # node i covers its lowest set bit's width
        self.units = int(self.ends.sum())

    def end_of(self, k: int) -> int:
        """Code points up to the end of the first ``k`` units."""
        if k <= 0:
            return 0
        at, left, points = 0, k, 0
        step = 1 << (len(self.tree) - 1).bit_length()
        while step:
            if at + step < len(self.tree) and self.tree[at + step, 0] < left:
                at += step
                left -= int(self.tree[at, 0])
                points += int(self.tree[at, 1])
            step >>= 1
        lo = int(self.starts[at])
        last = int(np.flatnonzero(self.ends[lo:lo + self.block])[left - 1])
        return points + int(self.begins[lo:lo + last + 1].sum())


def _cuts(block: int):
    """Adds units n and, in code points, the two cuts, from the four numbers h1 to h4."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h1, h2 = (batch[c].to_numpy() for c in ("h1", "h2"))
            n, first, second = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
            for row, _, data, offsets in slices(batch["text"]):
                for i, (lo, hi) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True), row):
                    tree = UnitTree(data[lo:hi], block)
                    n[i] = tree.units
                    a, b = sorted((int(h1[i]) % (tree.units + 1), int(h2[i]) % (tree.units + 1)))
                    first[i] = tree.end_of(a)
                    second[i] = first[i] if a == b else tree.end_of(b)
            yield pa.RecordBatch.from_arrays(
                [*(batch[c] for c in ("doc_id", "text", "h3", "h4")), *map(pa.array, (n, first, second))],
                names=["doc_id", "text", "h3", "h4", "n", "first", "second"])

    return emit


def transform(docs: DataFrame, seed: int = SEED, fim_percent: int = FIM_PERCENT,
              spm_percent: int = SPM_PERCENT, block: int = BLOCK_BYTES,
              id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text, n, form (plain, psm or spm), prefix_chars, middle_chars, output."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    number = lambda k: F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long")
    numbered = id_and_text(docs, id_col, text_col).select(
        "doc_id", "text", *[number(k).alias(f"h{k + 1}") for k in range(4)])
    cut = numbered.mapInArrow(
        _cuts(block), "doc_id long, text string, h3 long, h4 long, n long, first long, second long")
    plain = ((F.col("text") == "") | (F.col("h3") % 100 >= fim_percent)
             | F.col("text").contains(PREFIX) | F.col("text").contains(SUFFIX) | F.col("text").contains(MIDDLE))
    form = (F.when(plain, "plain").when(F.col("h4") % 100 < spm_percent, "spm").otherwise("psm"))
    piece = lambda lo, hi: F.substring("text", lo + F.lit(1), hi - lo)
    start, stop, far = F.lit(0).cast("int"), F.col("first").cast("int"), F.col("second").cast("int")
    prefix, middle = piece(start, stop), piece(stop, far)
    suffix = F.substring("text", far + F.lit(1), F.length("text"))
    output = (F.when(F.col("form") == "plain", F.col("text"))
              .when(F.col("form") == "psm", F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix,
                                                     F.lit(MIDDLE), middle))
              .otherwise(F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle)))
    cut_in = F.col("form") != "plain"
    return cut.withColumn("form", form).select(
        "doc_id", "text", "n", "form", F.when(cut_in, F.col("first")).alias("prefix_chars"),
        F.when(cut_in, F.col("second") - F.col("first")).alias("middle_chars"), output.alias("output"))


def restored(output: Column, form: Column) -> Column:
    """The text, rebuilt from output and form alone. No mark can arise at a seam: its first
    character occurs in it only once, and the text itself holds none."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)  # the first is empty
    return (F.when(form == "plain", output)
            .when(form == "psm", F.concat(parts[1], parts[3], parts[2]))
            .otherwise(F.concat(parts[2], parts[3], parts[1])))
