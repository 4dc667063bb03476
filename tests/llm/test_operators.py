"""Each training-data operator against brute force on a small table with every odd case."""

from __future__ import annotations

import gzip
import hashlib
import itertools
import random
import re
import string
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from clickcredit.llm import (
    decontamination,
    exact_dedup,
    line_dedup,
    ngram_join,
    packing,
    secret_scan,
    substring_dedup,
    suffix_dedup,
    toxicity,
    warc,
)

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, h long, row string, body string"


def make_rows():
    r = random.Random(7)
    words = ["".join(r.choice("abcdefgàéß") for _ in range(r.randint(2, 9))) for _ in range(400)]
    say = lambda n: " ".join(r.choice(words) for _ in range(n))
    passage, base = say(70), say(120).split()
    texts = [None, "", " \t\n", "one", "One", "two  words", say(4), say(49), say(50), say(3000),
             say(30) + " " + passage + "\n" + say(40), say(61) + "\t" + passage, passage, passage,
             "a " * 300, "a " * 280, "日本語 " * 60, passage.upper()]
    for _ in range(12):
        copy = list(base)
        for _ in range(r.randint(0, 3)):
            copy[r.randrange(len(copy))] = r.choice(words)
        texts.append(" ".join(copy))
    lines = [say(6) for _ in range(12)]
    texts += ["\n".join(lines), "\n".join([say(3), *lines]), "\n".join([*lines[:9], say(2)]), "x\n\n\ny\n\n\nx"]
    texts += ["password = Abcdef0123456789x", "AKIA" + "Q7" * 9 + " token:'short'", "é deadbeef00112233445566 ok",
              "key " + "Zk3vQ9xT1bL7mW2sR8uY5cH4", "token=password: abcdefghijklmnop"]
    texts += [base and " ".join(base), " ".join(base) + " "]
    rows = [(i * 3 + 1, t, "en", "s", 1, 5, "clash", "clash") for i, t in enumerate(texts)]
    rows.append(rows[14])  # a repeated row
    r.shuffle(rows)
    return rows


ROWS = make_rows()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def items(spark):
    leaked = " ".join(WORD.findall(next(t for i, t, *_ in ROWS if i == 37))[5:35])
    return spark.createDataFrame([(1, leaked), (2, "not in any text of this small table at all"),
                                  (3, None), (4, ""), (5, "two words")], "item_id long, text string")


def by_id(df, *columns):
    return sorted(set(tuple(r) for r in df.select("doc_id", *columns).collect()), key=repr)


def unique():
    return sorted({(i, t or "") for i, t, *_ in ROWS})


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t)


def shingles(t):
    w = WORD.findall(lower(t))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def near_components(rows):
    sets = {i: shingles(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {i: find(i) for i in sets}, {i: len(s) for i, s in sets.items()}


def exact_groups(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t)].append((-len(t), i))
    return groups


def test_exact_copies(docs):
    n = Counter(re.sub(r"[\x20\x09-\x0D]", "", t or "") for _, t, *_ in ROWS)
    want = [(i, min(g)[1], n[body], min(g)[1] == i, hashlib.sha256(body.encode()).hexdigest())
            for body, g in exact_groups(unique()).items() for _, i in g]
    got = exact_dedup.exact_copies(docs)
    assert got.count() == len(ROWS)
    assert by_id(got, "keep_id", "group_size", "kept", "text_sha256") == sorted(want, key=repr)
    # Every group in slots of its own, and every group in one place: the same rows.
    for slot_bytes in (1, 1 << 40):
        assert by_id(exact_dedup.exact_copies(docs, slot_bytes=slot_bytes),
                     "keep_id", "group_size", "kept", "text_sha256") == sorted(want, key=repr)
    kept = exact_dedup.drop_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(min(g)[1] for g in exact_groups(unique()).values())


def test_exact_copies_by_neighbours(docs, monkeypatch):
    """The window takes the range exchange and its sort as they are; light groups need no join by digest."""
    tables = {}

    def kept(df, name):
        tables[name] = df
        return df

    monkeypatch.setattr(exact_dedup, "written", kept)
    exact_dedup.exact_copies(docs, slot_bytes=1 << 40)
    plan = tables["judged"]._jdf.queryExecution().executedPlan().toString()
    window = plan[plan.index("Window"):plan.index("rangepartitioning")]
    assert "Exchange hashpartitioning" not in window and window.count("Sort [") == 1, plan
    many = docs.sparkSession.range(4000).selectExpr("id AS doc_id", "concat('text ', id % 3000) AS text")
    exact_dedup.exact_copies(many)
    rows = tables["judged"].collect()
    assert not any(r.heavy for r in rows) and sum(r.n == 2 for r in rows) == 2000


def test_word_windows(docs):
    words = {i: WORD.findall(t) for i, t in unique()}
    first = {}
    for i in sorted(words):
        for s in range(len(words[i]) - 49):
            first.setdefault(tuple(words[i][s:s + 50]), i)
    want = []
    for i, w in words.items():
        gone = {p for s in range(len(w) - 49) if first[tuple(w[s:s + 50])] < i for p in range(s, s + 50)}
        kept = " ".join(x for p, x in enumerate(w) if p not in gone)
        want.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    assert any(x[2] for x in want)
    got = substring_dedup.dedup_windows(docs)
    assert by_id(got, "n_words", "n_removed", "kept_sha256") == sorted(want, key=repr)


def test_cover_has_every_difference():
    differences = {(a - b) % substring_dedup.PERIOD for a in substring_dedup.COVER for b in substring_dedup.COVER}
    assert differences == set(range(substring_dedup.PERIOD))


def test_near_components(docs):
    component, size = near_components(unique())
    assert len(set(component.values())) < len(component)
    got = ngram_join.link_documents(docs)
    assert by_id(got, "n_shingles", "component_id") == sorted(
        ((i, size[i], component[i]) for i in component), key=repr)
    kept = {r.doc_id for r in ngram_join.drop_near(docs).collect()}
    assert kept == {i for i in component if component[i] == i}


def test_leaks(docs, items):
    want = set()
    for k, (_, text) in enumerate([(r.item_id, r.text) for r in items.orderBy("item_id").collect()], 1):
        w = WORD.findall(lower(text or ""))
        if not w:
            continue
        width = min(5, len(w))
        grams = lambda x: Counter(tuple(x[i:i + width]) for i in range(len(x) - width + 1))
        for i, t in unique():
            d = WORD.findall(lower(t))
            n = min(len(d), len(w))
            for s in range(len(d) - n + 1):
                a, b = grams(d[s:s + n]), grams(w)
                if sum((a & b).values()) >= 0.8 * sum((a | b).values()) > 0:
                    want.add((i, k))
    found = decontamination.leaks(docs, items)
    assert want and {(r.doc_id, r.item_id) for r in found.collect()} == want
    kept = {r.doc_id for r in decontamination.drop_leaks(docs, items).collect()}
    assert kept == {i for i, _ in unique()} - {i for i, _ in want}


def test_hamming_blocks_find_all_within_radius():
    r = np.random.default_rng(1)
    index = decontamination.ItemIndex([(k, " ".join(f"w{k}x{j}" for j in range(30))) for k in range(20)])
    prints = []
    for f in index.prints:
        for d in (0, 5, 20, 21):
            flips = r.choice(64, d, replace=False)
            prints.append(int(f) ^ sum(1 << int(b) for b in flips))
    prints = np.array(prints, np.uint64)
    got = set(zip(*(x.tolist() for x in index.near(30, prints)[:2]), strict=True))
    want = {(i, k) for i, p in enumerate(prints) for k, f in enumerate(index.prints)
            if int(np.bitwise_count(p ^ f)) <= decontamination.RADIUS}
    assert got == want


def test_warc_round_trip(spark, tmp_path):
    pages = spark.createDataFrame(
        [(1, "http://a/", "<html lang=en><title>T &amp; x</title><script>var a='</p>'</script><p>Hé <b>llo</b>"
                          "<br>two&nbsp;&lt;<a href='/l'>l</a><!-- no -->"),
         (2, None, None), (3, "http://b/", ""), (1, "http://a/", "plain"), (4, "http://c/", "<script>open")],
        "page_id long, url string, html string").withColumnRenamed("page_id", "page_id")
    records = warc.derivatives(warc.responses_of_pages(pages))
    rows = records.collect()
    assert len(rows) == 10
    text = {(r.source_key, r.block) for r in rows if r.warc_type == "conversion"}
    assert text == {("1", "Hé llo\ntwo <l"), ("2", ""), ("3", ""), ("1", "plain"), ("4", "")}
    for r in rows:
        assert r.block_digest == warc.digest(r.block.encode()) and f"WARC-Refers-To: {r.refers_to}" in r.header
        if r.warc_type == "metadata":
            assert "source-header: HTTP/1.1 200 OK\r\n" in r.block
    path = str(tmp_path / "warc")
    warc.write(records, path)
    names = [f for f in warc.FIELDS if f != "source_key"] + ["content_length"]
    back = warc.read(spark, path)
    key = lambda df: sorted(tuple(r) for r in df.select([df[n].cast("string") for n in names])
                            .na.fill("-").collect())
    assert key(back) == key(records)
    assert warc.derivatives(warc.responses_of_pages(pages.limit(0))).count() == 0


def test_warc_foreign_records(spark, tmp_path):
    """Records as crawlers write them: a gzip member each, mixed case, foreign types, cut files."""
    def record(kind, body, **fields):
        lines = [f"WARC-Type: {kind}", *(f"{k.replace('_', '-')}: {v}" for k, v in fields.items()),
                 f"content-length:{len(body)}"]
        return b"WARC/1.0\r\n" + "\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"

    page = b"HTTP/1.1 200 OK\r\nServer: x\r\nX-Note: WARC/1.0\r\n\r\n<p>one</p>\r\n\r\n<a href=/z>WARC/1.0</a>"
    good = record("response", page, WARC_Record_ID="<urn:a>", WARC_Target_URI="http://a/\r\n more",
                  WARC_Date="2020-01-01T00:00:00Z", WARC_Payload_Digest="sha1:KEPT")
    latin = record("response", b"HTTP/1.0 200 OK\n\nh\xe9", WARC_Record_ID="<urn:b>")
    parts = [record("warcinfo", b"software: x\r\n"), good, record("request", b"GET / HTTP/1.1\r\n\r\n"), latin]
    (tmp_path / "a.warc.gz").write_bytes(b"".join(gzip.compress(x) for x in parts))
    (tmp_path / "cut.warc.gz").write_bytes(gzip.compress(good) + gzip.compress(good * 50)[:-30])
    (tmp_path / "cut.warc").write_bytes(good + record("response", b"HTTP/1.1 200 OK\r\n\r\nabcdef")[:-7])
    (tmp_path / "empty.warc").write_bytes(b"")
    assert [r.warc_type for r in warc.read(spark, str(tmp_path), "a.*").collect()] == [
        "warcinfo", "response", "request", "response"]
    assert warc.read(spark, str(tmp_path), "cut.warc.gz").count() >= 1
    assert [(r.content_length, r.block[-3:]) for r in warc.read(spark, str(tmp_path), "cut.warc").collect()] == [
        (len(page), "/a>"), (22, "abc")]
    assert warc.read(spark, str(tmp_path), "empty.warc").count() == 0

    made = warc.derivatives(warc.responses_of_records(warc.read(spark, str(tmp_path), "a.*"))).collect()
    text = {(r.refers_to, r.warc_type): r for r in made}
    assert len(made) == len(text) == 4
    meta = text["<urn:a>", "metadata"]
    assert meta.target_uri == "http://a/ more" and meta.source_payload_digest == "sha1:KEPT"
    assert meta.block.splitlines() == [
        "source-header: HTTP/1.1 200 OK", "source-header: Server: x", "source-header: X-Note: WARC/1.0",
        "source-payload-digest: sha1:KEPT", f"source-payload-length: {len(page) - page.index(b'<p>')}",
        "outlink: /z"]
    assert text["<urn:a>", "conversion"].block == "one\nWARC/1.0"
    assert text["<urn:b>", "conversion"].block == "h\ufffd"
    assert "source-header: HTTP/1.0 200 OK\r\n" in text["<urn:b>", "metadata"].block


@pytest.mark.parametrize("piece", ["<a ", "<html ", "<title ", "<script ", "<p ", "<!--", "<a href=", "<a href='",
                                   "</script ", "<title>", "<", "&amp;", "<a href = "])
def test_warc_long_odd_pages(piece):
    """A megabyte of any opening takes about as long as a megabyte of text."""
    page, began = piece * (1_000_000 // len(piece)), time.process_time()
    assert len(list(warc._derive("k", None, None, None, None, page, None))) == 2
    assert time.process_time() - began < 4


def test_line_chunks(docs):
    rows = [r.asDict() for r in line_dedup.dedup_chunks(docs).collect()]
    texts = dict(unique())
    assert len(rows) == len(ROWS) and any(r["n_removed_chunks"] for r in rows)
    for r in rows:
        lines = texts[r["doc_id"]].split("\n")
        kept = r["kept_text"].split("\n") if r["n_removed_lines"] < r["n_lines"] else []
        assert r["n_lines"] == len(lines) and len(kept) == len(lines) - r["n_removed_lines"]
        rest = iter(lines)
        assert all(x in rest for x in kept)  # in order
        if not r["n_removed_chunks"]:
            assert r["kept_text"] == texts[r["doc_id"]]
    # What was removed is still there, in a smaller id.
    everything = "\n\n".join(r["kept_text"] for r in rows)
    for r in rows:
        for line in texts[r["doc_id"]].split("\n"):
            assert line in everything


def test_repeated_runs_of_lines_go(spark):
    r = random.Random(3)
    say = lambda n: " ".join(r.choice("abcdefgh") * r.randint(1, 4) for _ in range(n))
    passages = [[say(9) for _ in range(n)] for n in (2, 2, 2, 2, 3, 3, 3, 4, 6, 9)]
    passages += [["top", "", "", "", "", "bottom " + say(5)], ["only one line of this " + say(6)]]
    rows = []
    for k in range(60):
        middle = [x for p in r.sample(passages, 3) for x in [*p, f"{k} {say(8)}"]]
        rows.append((k, "\n".join([f"{k} {say(7)}", *middle])))
    rows += [(100 + k, "\n".join(p)) for k, p in enumerate(passages)] + [(200, rows[5][1]), (None, rows[6][1])]
    seen, want = set(), {}
    for i, t in rows:
        lines = t.split("\n")
        lost = set()
        for at, pair in enumerate(itertools.pairwise(lines)):
            if "".join(pair).strip() and pair in seen:
                lost |= {at, at + 1}
            seen.add(pair)
        want[i] = lost, [x for k, x in enumerate(lines) if k not in lost]
    got = {x.doc_id: x for x in line_dedup.dedup_chunks(
        spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    assert len(got) == len(rows)
    for i, (lost, kept) in want.items():
        x = got[i]
        # Empty lines among empty ones may go with their chunk as well.
        assert [y for y in x.kept_text.split("\n") if y] == [y for y in kept if y], i
        assert x.n_removed_lines >= len(lost) and 0 <= x.n_removed_chunks <= x.n_chunks
        assert bool(x.n_removed_lines) == bool(x.n_removed_chunks)
    for i in (*range(100, 111), 200, None):  # whole copies of two lines or more
        assert got[i].kept_text.strip("\n") == "", i
    assert got[111].n_removed_lines == 0


def test_secrets(docs):
    assign = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
    want = []
    for i, t in unique():
        found = [(m.start(), 0, m.end()) for m in assign.finditer(t) if len(m[2]) >= 12]
        found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 18]
        found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 16]
        spans = ",".join(f"{secret_scan.KINDS[k]}:{a}:{b}" for a, k, b in sorted(found))
        want.append((i, *(sum(x[1] == k for x in found) for k in range(3)), hashlib.sha256(spans.encode()).hexdigest()))
    got = secret_scan.scan(docs)
    assert got.count() == len(ROWS)
    assert by_id(got, "n_assign", "n_access", "n_hex", "base_sha256") == sorted(want, key=repr)
    random_spans = {r.doc_id for r in got.collect() if "random:" in r.spans}
    assert next(i for i, t in unique() if t.startswith("key Zk3")) in random_spans


def test_secrets_in_paths_and_of_letters(spark):
    key, aws = "9f8AXk2LmQ7wZ3vTb1YcR5uN", "wJalrXUtnFEMI/K7MDENGq/bPxRfiCY9Zk3EwQ"
    letters = "".join(random.Random(1).choices(string.ascii_letters, k=32))
    texts = {f"go com/reset-password/{key} now": key, f"/my-bucket/{aws}": aws, f"x {letters} y": letters,
             f"é path/of/many/plain/words/that/go/on/and/on/{key}/and/so/on": key,
             f"of-some-plain-words-in-a-name-{key}-and-more_{letters}": key}
    plain = ["the/usual/words/of/some/path/here", "one-more-name-of-plain-words", "getTheNameOfThisElementHere"] * 20
    rows = [(k, t) for k, t in enumerate([*texts, *plain])]
    got = {r.doc_id: r for r in secret_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(got) == len(rows)
    for k, (t, want) in enumerate(texts.items()):
        spans = [tuple(map(int, x.split(":")[1:])) for x in got[k].spans.split(",") if x.startswith("random:")]
        a = t.index(want)
        assert any(start <= a and a + len(want) <= end for start, end in spans), (t, spans)
        assert got[k].n_random == len(spans) and all(x[1] <= y[0] for x, y in itertools.pairwise(spans))
    assert not any(got[k].n_random for k in range(len(texts), len(rows)))


def test_byte_strings(docs):
    seen, want = set(), []
    for i, t in unique():
        b = t.encode()
        lost = [False] * len(b)
        for s in range(len(b) - 99):
            if b[s:s + 100] in seen:
                lost[s:s + 100] = [True] * 100
            seen.add(b[s:s + 100])
        kept = bytes(x for x, gone in zip(b, lost, strict=True) if not gone)
        want.append((i, len(b), sum(lost), sum(k for k, _ in itertools.groupby(lost)),
                     hashlib.sha256(kept).hexdigest()))
    got = suffix_dedup.dedup_substrings(docs)
    assert by_id(got, "n_bytes", "n_removed", "n_spans", "kept_sha256") == sorted(want, key=repr)


def removed_bytes(texts):
    seen, want = set(), []
    for i, t in enumerate(texts):
        b = t.encode()
        lost = [False] * len(b)
        for s in range(len(b) - 99):
            if b[s:s + 100] in seen:
                lost[s:s + 100] = [True] * 100
            seen.add(b[s:s + 100])
        kept = bytes(x for x, gone in zip(b, lost, strict=True) if not gone)
        want.append((i, sum(lost), hashlib.sha256(kept).hexdigest()))
    return want


def test_byte_strings_of_common_anchors(spark, monkeypatch):
    """Anchors that many documents share are sorted by all tasks; the rows are the same."""
    draw = random.Random(5)
    word = lambda n: "".join(draw.choices(string.ascii_lowercase + " é", k=n))
    line, passage = word(60), word(300)
    texts = [word(draw.randrange(150)) + line + word(80) + (passage[draw.randrange(100):] if i % 3 else "") + word(20)
             for i in range(60)] + ["a" * 700, "b" + "a" * 400, line * 9, "", passage]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(7)
    want = removed_bytes(texts)
    for spread in (1000, 5, 0):
        monkeypatch.setattr(suffix_dedup, "SPREAD", spread, raising=False)
        monkeypatch.setattr(suffix_dedup, "SORTED_BYTES", 3000, raising=False)
        got = suffix_dedup.dedup_substrings(rows.union(rows)).distinct()
        assert by_id(got, "n_removed", "kept_sha256") == sorted(want, key=repr), spread


def test_byte_strings_of_common_anchors_stay_few_rows(spark, monkeypatch):
    """A phrase of very many documents in different surroundings, and near copies of a long text: the
    rows made of their pieces are few a piece, not one for each suffix."""
    draw = random.Random(12)
    word = lambda n: "".join(draw.choices(string.ascii_lowercase, k=n))
    phrase, text = word(40), word(900)
    texts = [word(150) + phrase + word(150) for _ in range(120)] + [text[:k + 400] + "#" + text[k + 400:]
                                                                    for k in range(60)]
    n_rows, plain = {}, suffix_dedup.written

    def counted(df, name):
        out = plain(df, name)
        n_rows[name] = out.count()
        return out

    monkeypatch.setattr(suffix_dedup, "written", counted)
    monkeypatch.setattr(suffix_dedup, "SPREAD", 30)
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = suffix_dedup.dedup_substrings(rows)
    assert by_id(got, "n_removed", "kept_sha256") == sorted(removed_bytes(texts), key=repr)
    assert n_rows["windows"] < 10 * len(texts)  # 5,327 with a row for each suffix
    assert n_rows["pieces"] < 40 * len(texts)


def test_equal_byte_strings_share_a_core():
    """The parts of a piece cover its strings once each; equal strings of any two pieces meet."""
    draw = random.Random(13)
    pieces: dict[int, set[bytes]] = {}
    period = "".join(draw.choices("abc", k=40))
    for t in (period * 12 + "x" * 300, "x" * 200 + period * 5, "".join(draw.choices("ab", k=800)), period * 9):
        data = np.frombuffer(t.encode(), np.uint8)
        least = suffix_dedup._least(data)[1].view(np.int64)
        turns = [0, *(np.flatnonzero(least[1:] != least[:-1]) + 1).tolist(), len(least)]
        for s, e in itertools.pairwise(turns):
            pieces.setdefault(int(least[s]), set()).add(data[s:e + 99].tobytes())
    cores: dict[bytes, set[int]] = {}
    for anchor, bodies in pieces.items():
        for body in bodies:
            parts = list(suffix_dedup._parts(anchor, body))
            assert [k for _, s, e in parts for k in range(s, e)] == list(range(len(body) - 99))
            for core, s, e in parts:
                for k in range(s, e):
                    cores.setdefault(body[k:k + 100], set()).add(core)
    assert all(len(found) == 1 for found in cores.values()) and len(cores) > 800


def test_byte_strings_travel_as_pieces(spark, monkeypatch):
    """What the operator writes stays near the size of the text, also where most of it repeats."""
    import os

    draw = random.Random(6)
    texts = []
    for _ in range(40):
        t = "".join(draw.choices(string.ascii_letters, k=6000))
        texts += [t, "".join(t[k:k + 299] + "#" for k in range(0, 6000, 300)) + "."]
    paths, plain = [], suffix_dedup.written

    def counted(df, name):
        out = plain(df, name)
        paths.extend(x.removeprefix("file://").removeprefix("file:") for x in out.inputFiles())
        return out

    monkeypatch.setattr(suffix_dedup, "written", counted)
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = suffix_dedup.dedup_substrings(rows)
    assert by_id(got, "n_removed", "kept_sha256") == sorted(removed_bytes(texts), key=repr)
    assert paths and sum(map(os.path.getsize, paths)) < 4 * sum(map(len, texts))


def test_byte_strings_are_sorted_in_little_memory():
    import tracemalloc

    draw = np.random.default_rng(8)
    data = draw.integers(97, 100, 1 << 19, dtype=np.uint8)
    data[300_000:400_000] = data[:100_000]
    at = np.arange(0, len(data) - 99, 3)
    tracemalloc.start()
    order, new = suffix_dedup._sorted_suffixes(data, at)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    bodies = [data[k:k + 100].tobytes() for k in at.tolist()]
    want = sorted(range(len(at)), key=bodies.__getitem__)
    assert order.tolist() == want
    assert new.tolist() == [k == 0 or bodies[want[k]] != bodies[want[k - 1]] for k in range(len(want))]
    assert peak < 40 * len(data)


def test_byte_strings_come_in_small_batches(spark):
    """The JVM and the worker hold few whole texts at once, and pieces of several batches are still judged together."""
    import pyarrow as pa

    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.unset(key)
    try:
        suffix_dedup.dedup_substrings(spark.createDataFrame([(1, "a" * 120)], "doc_id long, text string"))
        assert int(spark.conf.get(key)) <= 1000
    finally:
        if before is not None:
            spark.conf.set(key, before)
    body = "".join(random.Random(9).choices(string.ascii_letters, k=102)).encode()
    batches = [suffix_dedup._piece_batch([(7, True, i, i, 0, body)]) for i in range(3)]
    rows = pa.Table.from_batches(suffix_dedup._first_windows(iter([batches[0], batches[1].slice(0, 0), *batches[1:]])))
    assert [(x["doc_id"], x["start"], x["end"]) for x in rows.to_pylist() if x["body"] is None] == [(1, 0, 3), (2, 0, 3)]
    assert [x["body"] for x in rows.to_pylist() if x["doc_id"] == 0] == [body[k:k + 100] for k in range(3)]


def test_packing(docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    whole = Tokenizer.from_file(path)
    ids = {i: np.array(whole.encode(t, add_special_tokens=False).ids + [1], "<u4") for i, t in unique()}
    pieces = packing.pack(docs, path, capacity=256).collect()
    cover, fill = Counter(), defaultdict(list)
    for p in pieces:
        own = ids[p.doc_id]
        assert p.doc_tokens == len(own)
        assert p.ids_crc32 == zlib.crc32(own[p.start:p.start + p.length].tobytes())
        cover.update((p.doc_id, k) for k in range(p.start, p.start + p.length))
        fill[p.sequence_id].append((p.offset, p.length))
    times = Counter(i for i, *_ in ROWS)
    assert cover == Counter({(i, k): times[i] for i in ids for k in range(len(ids[i]))})
    padding = 0
    for parts in fill.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 256
        padding += 0 if at & (at - 1) == 0 else 256 - at
    assert padding <= 0.05 * sum(cover.values())


def test_tokenizer_cache_is_exact():
    import public_tokenizers

    t = packing.WordTokenizer(public_tokenizers.path("word_bpe_49k.json"))
    r = random.Random(3)
    alphabet = "aAbéÉ'sStTlLdDmM .,!?<|>12²½\xa0\x1c\x85İıſKǺΣςσ中文🙂\n\t"
    for text in ["", "İstanbul <|endoftext|>x", "don't I'LL it's"] + [
            "".join(r.choice(alphabet) for _ in range(r.randint(1, 30))) for _ in range(2000)]:
        assert np.frombuffer(t.ids(text), "<u4").tolist() == t._tokenizer.encode(text, add_special_tokens=False).ids


@pytest.fixture(scope="module")
def labelled(spark):
    r = random.Random(5)
    rows, labels = [], []
    for i in range(400):
        words = ["".join(r.choice("abcdefghij") for _ in range(6)) for _ in range(40)]
        if i % 5 == 0:
            words[r.randrange(40)] = "wretched"
            words[r.randrange(40)] = "wretched"
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(i % 5 == 0)))
    rows += [(1000, None), (1001, ""), (1001, ""), (None, "ab")]
    labels += [(1000, 1, None), (None, 1, 1), (5000, 1, 1)]
    return (spark.createDataFrame(rows, "doc_id long, text string"),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_toxicity_held_out(labelled):
    docs, labels = labelled
    model = toxicity.fit(docs, labels)
    rows = toxicity.score(docs, model).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id is not None and r.doc_id < 400]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows if r.doc_id is not None)
    assert sum((r.doc_id % 5 == 0) == bool(r.predicted) for r in held) >= 0.9 * len(held)
    again = toxicity.fit(docs.repartition(5), labels)
    assert np.allclose(model.weights, again.weights) and model.bias == pytest.approx(again.bias)


def test_empty_tables(spark, none, items):
    import public_tokenizers

    empty_labels = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.fit(none, empty_labels)
    for df in (exact_dedup.exact_copies(none), exact_dedup.drop_copies(none), substring_dedup.dedup_windows(none),
               ngram_join.link_documents(none), decontamination.leaks(none, items),
               decontamination.leaks(none, items.limit(0)), line_dedup.dedup_chunks(none), secret_scan.scan(none),
               suffix_dedup.dedup_substrings(none), toxicity.score(none, model),
               packing.pack(none, public_tokenizers.path("word_bpe_49k.json"))):
        assert df.collect() == []


def test_pipeline_equals_brute_force(spark, docs, items, tmp_path):
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    items.write.parquet(str(tmp_path / "benchmark.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    rows = unique()  # no labels: nothing is toxic
    kept = {min(g)[1] for g in exact_groups(rows).values()}
    rows = [x for x in rows if x[0] in kept]
    component, _ = near_components(rows)
    rows = [x for x in rows if component[x[0]] == x[0]]
    leaked = {r.doc_id for r in decontamination.leaks(docs, items).collect()}
    want = {i for i, _ in rows} - leaked
    assert {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} == want
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "exact_dedup", "ngram_jaccard", "decontamination", "packing"]


def test_pipeline_stage_by_stage_with_toxic_documents(spark, items, tmp_path):
    r = random.Random(11)
    say = lambda words: " ".join(r.choice(words) for _ in range(40))
    toxic = [(1000 + k, say(["zzvile", "qqfoul", "xxnasty", "jjrotten"])) for k in range(20)]
    clean = [(2000 + k, say(["garden", "river", "window", "summer", "market", "letter", "music"])) for k in range(60)]
    rows = [(i, t, *x) for i, t, *x in ROWS] + [(i, t, "en", "s", 1, 5, "", "") for i, t in toxic + clean]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    items.write.parquet(str(tmp_path / "benchmark.parquet"))
    spark.createDataFrame([(i, 0, int(1000 <= i < 2000)) for i, *_ in rows], "doc_id long, quality int, toxic int").write.parquet(
        str(tmp_path / "labels.parquet"))
    docs = corpus_pipeline.documents(spark, str(tmp_path))
    left = sorted({(i, t or "") for i, t, *_ in rows} - set(toxic))
    stages = dict(corpus_pipeline.STAGES)

    def after(name):
        nonlocal docs
        docs = corpus_pipeline.written(stages[name](spark, docs, str(tmp_path)), name)
        return {x.doc_id for x in docs.collect()}

    assert after("toxicity") == {i for i, _ in left}
    kept = {min(g)[1] for g in exact_groups(left).values()}
    left = [x for x in left if x[0] in kept]
    assert after("exact_dedup") == {i for i, _ in left}
    component, _ = near_components(left)
    left = [x for x in left if component[x[0]] == x[0]]
    assert after("ngram_jaccard") == {i for i, _ in left}
    leaked = set()
    for item in items.collect():
        w = WORD.findall(lower(item.text or ""))
        if not w:
            continue
        width = min(5, len(w))
        grams = lambda x, k=width: Counter(tuple(x[i:i + k]) for i in range(len(x) - k + 1))
        for i, t in left:
            d = WORD.findall(lower(t))
            n = min(len(d), len(w))
            for start in range(len(d) - n + 1):
                a, b = grams(d[start:start + n]), grams(w)
                if sum((a & b).values()) >= 0.8 * sum((a | b).values()) > 0:
                    leaked.add(i)
    assert leaked and after("decontamination") == {i for i, _ in left} - leaked
    assert after("packing") == {i for i, _ in left} - leaked
