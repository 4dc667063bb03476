"""Token alignment, fill-in-middle and SimHash near copies against brute force."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from clickcredit.llm import fill_in_middle, simhash_dedup, token_alignment

SCHEMA = "doc_id long, text string, print long, n long, block string, h1 long, choice int"
PATHS = [public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "piece_bpe_32k.model")]


def make_rows():
    r = random.Random(3)
    words = ["".join(r.choice("abcdefgàéß") for _ in range(r.randint(1, 9))) for _ in range(200)]
    say = lambda n: " ".join(r.choice(words) for _ in range(n))
    texts = [None, "", " ", " \t\n", "One", "one", "a b\tc", "x  y \n z  ", "日本語 " * 40, "é ﬁ½  x",
             "▁under", "line\r\nend);\r\n", "<s> <|endoftext|> <P> in it", "ends in <", "M> begins", "tab\x1c odd",
             "☃" * 50 + " 𝄞𝄞 x", "'s it's 12 345!?", "\x00nul \x85 next", say(30000), "q" * 20000, " " * 5000 + "z",
             "👩‍🚀 ok", "Ünïcödé ÀÉ"]
    base = say(150).split()
    for k in range(25):
        copy = list(base)
        for _ in range(k % 4):
            copy[r.randrange(len(copy))] = r.choice(words)
        texts.append(" ".join(copy))
    texts += [say(r.randint(1, 80)) for _ in range(40)]
    rows = [(i * 7 + 2, t, 1, 2, "clash", 3, 4) for i, t in enumerate(texts)]
    rows += [rows[5], (rows[7][0], "same id, other text", 1, 2, "c", 3, 4),
             (None, texts[30], 1, 2, "c", 3, 4), (None, None, 1, 2, "c", 3, 4), (None, "alone with no id", 1, 2, "c", 3, 4)]
    r.shuffle(rows)
    return rows


ROWS = make_rows()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def as_bag(rows):
    return Counter(map(tuple, rows))


# fill in the middle

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def expected_fim(doc_id, text):
    text = text or ""
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * k:8 * k + 8], 16) for k in range(4))
    units = UNIT.findall(text)
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return doc_id, text, n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < 80:
        return doc_id, text, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, text, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("block", [1, 7, 512])
def test_fill_in_middle(docs, block):
    done = fill_in_middle.transform(docs, block=block)
    got = done.collect()
    assert as_bag(got) == Counter(expected_fim(r[0], r[1]) for r in ROWS)
    assert {r.form for r in got} == {"plain", "psm", "spm"}
    back = done.select("text", fill_in_middle.restored(F.col("output"), F.col("form")).alias("back"))
    assert back.where("text != back").count() == 0


def test_fill_in_middle_of_nothing(empty):
    assert fill_in_middle.transform(empty).count() == 0


def test_unit_tree_finds_every_end():
    for text in [r[1] for r in ROWS if r[1] and len(r[1]) < 3000]:
        units = UNIT.findall(text)
        tree = fill_in_middle.UnitTree(np.frombuffer(text.encode(), np.uint8), 3)
        assert tree.units == len(units)
        assert [tree.end_of(k) for k in range(len(units) + 1)] == [len("".join(units[:k])) for k in range(len(units) + 1)]


# SimHash

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def expected_print(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().translate(LOWER))
    grams = [b" ".join(words[i:i + 4]) for i in range(len(words) - 3)] or [b" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def expected_roots(prints):
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for a in prints:
        for b in prints:
            if a < b and (a ^ b).bit_count() <= 4 and find(a) != find(b):
                root[find(a)] = find(b)
    return {p: find(p) for p in prints}


def test_near_copies(docs):
    prints = [expected_print(r[1]) for r in ROWS]
    roots = expected_roots(set(prints))
    least = {}
    for row, p in zip(ROWS, prints, strict=True):
        if row[0] is not None:
            least[roots[p]] = min(least.get(roots[p], row[0]), row[0])
    got = simhash_dedup.near_copies(docs).collect()
    assert Counter((r.doc_id, r.print % 2**64, r.component_id) for r in got) == Counter(
        (row[0], p, least.get(roots[p])) for row, p in zip(ROWS, prints, strict=True))
    assert len(set(roots.values())) < len(set(prints))


def test_near_copies_of_nothing(empty):
    assert simhash_dedup.near_copies(empty).collect() == []


def families(r):
    """Fingerprints in families of every width, and some that only long chains of links join."""
    prints = {0, 2**64 - 1, 1 << 63}
    for width in (3, 6, 9, 14):
        centre = r.getrandbits(64)
        for _ in range(60):
            p = centre
            for _ in range(r.randint(0, width)):
                p ^= 1 << r.randrange(64)
            prints.add(p)
    p = r.getrandbits(64)
    for _ in range(40):
        prints.add(p)
        for b in r.sample(range(64), 4):
            p ^= 1 << b
    return sorted(prints)


@pytest.mark.parametrize("seed", [1, 2])
def test_links_of_fingerprints(spark, seed):
    prints = families(random.Random(seed))
    signed = [(p - 2**64 if p >> 63 else p,) for p in prints]
    found = simhash_dedup.link_fingerprints(spark.createDataFrame(signed, "print long").repartition(4)).collect()
    got = {r.node % 2**64: r.root % 2**64 for r in found}
    classes = lambda of: {frozenset(p for p in prints if of[p] == x) for x in set(of.values())}
    assert classes({p: got.get(p, p) for p in prints}) == classes(expected_roots(prints))


def test_open_lists_are_compared(spark):
    """Links that no neighbours show come from the exact comparison of lists."""
    prints = families(random.Random(5))
    rows = [(c, int(e), p - 2**64 if p >> 63 else p) for p in prints
            for c, e in [(0, np.int32(p & 0xFF))]]
    placed = spark.createDataFrame(rows, "choice int, entry int, print long").withColumn("root", F.col("print"))
    got = {(r.a % 2**64, r.b % 2**64) for r in simhash_dedup._open_links(placed).collect()}
    tally = lambda x: sum(x >> 8 * k & 0xFF == 0 for k in range(8))
    same = {frozenset((a, b)) for a in prints for b in prints
            if a < b and a & 0xFF == b & 0xFF and tally(a ^ b) >= 4 and (a ^ b).bit_count() <= 4}
    assert {frozenset(x) for x in got} == same and same


# Alignment


class Plain:
    """Tokens of whole texts, without caches or stretches."""

    def __init__(self):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(PATHS[0])
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
        visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
        self.byte = {chr(b): b for b in visible} | {
            chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in visible)}

    def tokens(self, text):
        ids_a, ids_b = self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text)
        bytes_a = [bytes(self.byte[c] for c in self.a.id_to_token(i)) for i in ids_a]
        bytes_b = [bytes([int(self.b.id_to_piece(i)[3:5], 16)]) if self.b.is_byte(i)
                   else self.b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
        if b"".join(bytes_a) != (" " + text).encode() or b"".join(bytes_b) != (" " + text).encode():
            return None
        return ids_a, bytes_a, ids_b, bytes_b

    def groups(self, text):
        if not text or (found := self.tokens(text)) is None:
            return []
        ids_a, bytes_a, ids_b, bytes_b = found
        out, a, b, end_a, end_b, in_a, in_b = [], 0, 0, 0, 0, [], []
        while a < len(ids_a) or b < len(ids_b):
            if end_a <= end_b:
                end_a += len(bytes_a[a])
                in_a.append(ids_a[a])
                a += 1
            else:
                end_b += len(bytes_b[b])
                in_b.append(ids_b[b])
                b += 1
            if end_a == end_b:
                out.append((in_a, in_b))
                in_a, in_b = [], []
        return out


def expected_alignment():
    plain = Plain()
    every = [plain.groups(r[1]) for r in ROWS]
    linked = [Counter() for _ in ROWS]
    for counts, groups in zip(linked, every, strict=True):
        for a, b in groups:
            for x, n in Counter(a).items():
                for y, m in Counter(b).items():
                    counts[x, y] += n * m
    documents = Counter(k for counts in linked for k in counts)
    best = {}
    for (a, _), n in documents.items():
        best[a] = max(best.get(a, 0), n)
    return documents, [
        (row[0], sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), sum(counts.values()),
         sum(n for k, n in counts.items() if documents[k] == best[k[0]]), sum(n * documents[k] for k, n in counts.items()),
         ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups))
        for row, groups, counts in zip(ROWS, every, linked, strict=True)]


@pytest.fixture(scope="module")
def alignment():
    return expected_alignment()


@pytest.mark.parametrize("block_links", [1, 500, 1 << 18])
def test_alignment(docs, alignment, block_links):
    got = token_alignment.align(docs, *PATHS, block_links=block_links, with_groups=True).collect()
    assert as_bag(got) == Counter(alignment[1])
    assert sum(r.n_a > 0 for r in got) > 80 and any(r.n_a == 0 and r.doc_id is not None for r in got)


def test_alignment_digests(docs, alignment):
    got = token_alignment.align(docs, *PATHS).select("doc_id", "groups").collect()
    assert as_bag(got) == Counter((r[0], r[7] and hashlib.sha256(r[7].encode()).hexdigest()) for r in alignment[1])


def test_pair_counts(docs, alignment):
    blocks = token_alignment.aligned_blocks(docs, *PATHS, block_links=700)
    got = {(r.id_a, r.id_b): r.documents for r in token_alignment.pair_counts(blocks).collect()}
    assert got == dict(alignment[0])


def test_alignment_of_nothing(empty):
    assert token_alignment.align(empty, *PATHS).collect() == []


def test_stretches_equal_whole_texts(monkeypatch):
    """Cached stretches give what whole texts give, also when the cache overflows."""
    monkeypatch.setattr(token_alignment, "_CACHED", 50)
    pair, plain = token_alignment.Pair(*PATHS), Plain()
    assert pair.by_stretch
    r = random.Random(11)
    bits = [" ", "  ", "\n", "\t", "a", "the", "é", " ", "　", "日", "1", "23", "'s", "'", "!", "),", "\r", "▁", "\x85", "\x1d", "Ω"]
    for _ in range(1500):
        text = "".join(r.choice(bits) for _ in range(r.randint(1, 14)))
        found, want = pair.ids(text), plain.tokens(text)
        assert (found is None) == (want is None), repr(text)
        if want:
            assert [x.tolist() for x in found] == [want[0], want[2]], repr(text)


def test_links_of_a_large_group(monkeypatch):
    r = np.random.default_rng(1)
    a, b = r.integers(0, 9, 400).astype(np.int32), r.integers(0, 7, 300).astype(np.int32)
    cuts = np.array([10, 350, 400]), np.array([20, 290, 300])
    want = token_alignment.links(a, b, *cuts)
    monkeypatch.setattr(token_alignment, "_EXPANDED", 64)
    got = token_alignment.links(a, b, *cuts)
    assert all(np.array_equal(x, y) for x, y in zip(want, got, strict=True))
    assert int(got[1].sum()) == 10 * 20 + 340 * 270 + 50 * 10


def test_blocks_do_not_depend_on_batches():
    table = pa.table({"doc_id": [1, 2, 3], "text": ["a b", None, "c d e"]})
    rows = lambda size: [r for b in token_alignment._blocks(*PATHS, 1 << 18, True)(iter(table.to_batches(size)))
                         for r in b.drop_columns(["block"]).to_pylist()]
    assert rows(1) == rows(3)


def test_cache_holds_its_bound(monkeypatch):
    """What moved to the older half counts too."""
    monkeypatch.setattr(token_alignment, "_CACHED", 40)
    pair, most = token_alignment.Pair(*PATHS), 0
    for n in range(100):
        assert pair.align(" ".join(f"w{n}x{k}" for k in range(5)))
        most = max(most, len({*pair._known, *pair._older}))
    assert 20 < most <= 40 + 10  # a text more for each half


def test_blocks_are_small_and_so_are_batches(spark):
    """A block takes less than a byte a link; Spark's 10,000 whole texts are no batch."""
    text = " ".join(f"word{k % 900}" for k in range(2000))
    table = pa.table({"doc_id": list(range(200)), "text": [text] * 200})
    [block] = token_alignment._blocks(*PATHS, 1 << 30, False)(iter(table.to_batches()))
    links = sum(block["sizes"][0].as_py())
    assert links > 100_000 and block.nbytes < links
    token_alignment.align(spark.createDataFrame([(1, "a b")], "doc_id long, text string"), *PATHS)
    assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) < 10_000


@pytest.mark.parametrize("values", [[], [0], [3, 0, 255], [0, 65535, 256], [2**32 + 1, 7, 2**62]])
def test_packed_integers(values):
    got = token_alignment._unpacked(token_alignment._packed(np.array(values, np.int64)), len(values))
    assert got.dtype == np.int64 and got.tolist() == values
