"""WARC derivatives: metadata and plain-text conversion records of response records.

Each response gives two records that point back to it (WARC-Refers-To) and carry its
target URI and date. The metadata record (application/warc-fields) keeps the source's
HTTP header lines and digests and lists title, language and links; the conversion record
(text/plain) holds the text of the HTML. Both keep the source's payload digest in
WARC-Source-Payload-Digest, are concurrent to each other, and have digests of their own.
Record ids are made from the source id and the record's kind, so a rerun (or a retried
task) makes the same records. There is no shuffle.

``write`` puts out WARC files with Spark's text writer (a record is one value, the two
line ends after it the separator; gzip is by file, not by record). ``read`` parses records
of any WARC files by Content-Length, plain or gzip, also with a gzip member for each record,
and ``responses_of_records`` takes the responses out of them, with their header lines and
payload digests, for ``derivatives``. A file is one row of Spark's file source, so files
should stay at the usual 1 GB or less.

Defined results: a null payload counts as empty; its conversion record has an empty block.
Null URI, date, headers or id: the header line is left out (id: made from the payload
digest and URI). Comments, scripts, styles and tags that are never closed reach to the
end; for the title, language and links a tag also ends before the next "<". A record cut
short by the end of its file is kept with the bytes that are there; what follows the last
record and isn't one is left. Bytes that are not UTF-8 read as U+FFFD, so the digest of the
source's bytes is kept from its header (WARC-Payload-Digest) where it has one. Repeated
rows give repeated records. An empty table gives an empty result. Extra columns are
ignored.
"""

from __future__ import annotations

import base64
import hashlib
import html
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FIELDS = ("source_key", "record_id", "warc_type", "refers_to", "target_uri", "warc_date",
          "content_type", "block_digest", "source_payload_digest", "header", "block")
SCHEMA = ", ".join(f"{x} string" for x in FIELDS) + ", content_length long"

# Each pattern either ends at the next "<" or matches to the end, so a page is read a fixed
# number of times whatever it holds.
_HIDDEN = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|title)\b[^>]*"
                     r"(?:>.*?(?:</\1\s*>|\Z)|\Z)", re.S | re.I)
_BREAK = re.compile(r"</?(?:p|div|br|li|ul|ol|tr|table|h[1-6]|article|section|nav|header|footer|"
                    r"body|html|head|blockquote|pre|hr|dd|dt|dl|form|main|aside)\b[^>]*(?:>|\Z)", re.I)
_TAG = re.compile(r"<[!/?a-zA-Z][^>]*(?:>|\Z)")
_BLANKS = re.compile(r"[ \t\r\f\v\xa0]+")
_LINE_END = re.compile(r"\r?\n")
_TITLE = re.compile(r"<title\b[^<>]*>(.*?)(?:</title\s*>|\Z)", re.S | re.I)
_LANG = re.compile(r"<html\b[^<>]*?\blang\s*=\s*[\"']?([A-Za-z0-9-]+)", re.I)
_LINK = re.compile(r"<a\b[^<>]*?\bhref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)


def plain_text(page: str) -> str:
    """Visible text of an HTML page: a line per block element, entities decoded."""
    text = _TAG.sub("", _BREAK.sub("\n", _HIDDEN.sub("", page)))
    lines = (_BLANKS.sub(" ", x).strip() for x in html.unescape(text).split("\n"))
    return "\n".join(x for x in lines if x)


def digest(block: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()


def _one_line(text: str) -> str:
    return " ".join(html.unescape(text).split())


def _header(lines: list[tuple[str, str | None]]) -> str:
    return "\r\n".join(["WARC/1.1", *(f"{k}: {v}" for k, v in lines if v is not None)])


def _derive(key, record_id, uri, date, headers, payload, given_digest) -> Iterator[tuple]:
    page = payload or ""
    raw = page.encode()
    source_digest = given_digest or digest(raw)
    if record_id is None:
        record_id = f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{uri}|{source_digest}')}>"
    own = {k: f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{record_id}|{k}')}>"
           for k in ("metadata", "conversion")}
    title, lang = _TITLE.search(page), _LANG.search(page)
    fields = [("title", _one_line(title[1]) if title else None), ("language", lang[1] if lang else None)]
    fields += [("source-header", x) for x in _LINE_END.split(headers or "") if x]
    fields += [("source-payload-digest", source_digest), ("source-payload-length", str(len(raw)))]
    fields += [("outlink", _one_line(a or b or c)) for a, b, c in _LINK.findall(page)]
    blocks = {"metadata": "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None),
              "conversion": plain_text(page)}
    for kind, other in (("metadata", "conversion"), ("conversion", "metadata")):
        block = blocks[kind].encode()
        kept = digest(block)
        content_type = "application/warc-fields" if kind == "metadata" else "text/plain; charset=UTF-8"
        header = _header([
            ("WARC-Type", kind), ("WARC-Record-ID", own[kind]), ("WARC-Refers-To", record_id),
            ("WARC-Concurrent-To", own[other]), ("WARC-Target-URI", uri), ("WARC-Date", date),
            ("WARC-Source-Payload-Digest", source_digest), ("WARC-Block-Digest", kept),
            ("Content-Type", content_type), ("Content-Length", str(len(block)))])
        yield (key, own[kind], kind, record_id, uri, date, content_type, kept, source_digest,
               header, blocks[kind], len(block))


def _table(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * (len(FIELDS) + 1)
    kinds = [pa.string()] * len(FIELDS) + [pa.int64()]
    return pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                           names=[*FIELDS, "content_length"])


def derivatives(responses: DataFrame) -> DataFrame:
    """Metadata and conversion records of ``responses`` (source_key, record_id, target_uri,
    warc_date, http_headers, payload and, if known, payload_digest: all strings)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for row in zip(*batch.columns, strict=True):
                rows += _derive(*(x.as_py() for x in row))
                if len(rows) >= 1000:
                    yield _table(rows)
                    rows = []
            yield _table(rows)

    names = ("source_key", "record_id", "target_uri", "warc_date", "http_headers", "payload")
    given = responses["payload_digest"] if "payload_digest" in responses.columns else F.lit(None)
    return responses.select(*[responses[n].cast("string").alias(n) for n in names],
                            given.cast("string").alias("payload_digest")).mapInArrow(run, SCHEMA)


def responses_of_pages(pages: DataFrame, warc_date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Response records of a table (page_id, url, html): ids from page id and URL, and the
    header lines that such a response has. The table has no date, so it is a parameter."""
    url, page = pages["url"].cast("string"), pages["html"].cast("string")
    name = F.md5(F.concat_ws("|", pages["page_id"].cast("string"), url).cast("binary"))
    parts = [F.substring(name, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return pages.select(
        pages["page_id"].cast("string").alias("source_key"),
        F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">")).alias("record_id"),
        url.alias("target_uri"), F.lit(warc_date).alias("warc_date"),
        F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                 F.coalesce(F.octet_length(page), F.lit(0)).cast("string")).alias("http_headers"),
        page.alias("payload"))


def write(records: DataFrame, path: str, max_records_per_file: int = 50_000,
          compression: str = "gzip") -> None:
    """Write records as WARC files."""
    (records.select(F.concat_ws("\r\n\r\n", "header", "block").alias("value"))
     .write.option("lineSep", "\r\n\r\n").option("compression", compression)
     .option("maxRecordsPerFile", max_records_per_file).text(path))


def _inflated(content: bytes) -> bytes:
    """The bytes of a gzip file of one or more members; of a cut one, what is there."""
    parts = []
    while content:
        member = zlib.decompressobj(wbits=31)
        try:
            parts.append(member.decompress(content))
        except zlib.error:
            break
        content = member.unused_data
    return b"".join(parts)


def _fields(header: str) -> dict[str, str]:
    """Fields of a record header by lower-cased name; a line that begins with a blank goes on."""
    out: dict[str, str] = {}
    name = None
    for line in _LINE_END.split(header)[1:]:
        if line[:1] in (" ", "\t") and name:
            out[name] += " " + line.strip()
        elif ":" in line:
            name, value = line.split(":", 1)
            name = name.strip().lower()
            out[name] = value.strip()
    return out


def _records(data: bytes) -> Iterator[tuple]:
    at = data.find(b"WARC/")
    while 0 <= at < len(data):
        end = data.find(b"\r\n\r\n", at)
        header = data[at:end if end >= 0 else len(data)].decode("utf-8", "replace")
        fields = _fields(header)
        length = fields.get("content-length", "")
        size = int(length) if length.isascii() and length.isdigit() else 0
        start = end + 4 if end >= 0 else len(data)
        block = data[start:start + size]
        yield (None, fields.get("warc-record-id"), fields.get("warc-type"), fields.get("warc-refers-to"),
               fields.get("warc-target-uri"), fields.get("warc-date"), fields.get("content-type"),
               fields.get("warc-block-digest"),
               fields.get("warc-source-payload-digest") or fields.get("warc-payload-digest"),
               header, block.decode("utf-8", "replace"), len(block))
        at = data.find(b"WARC/", start + len(block))


def read(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Records of the WARC files under ``path`` whose names match ``glob``; content_length
    counts the bytes that are there."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch["path"], batch["content"], strict=True):
                data = content.as_py()
                rows: list[tuple] = []
                for row in _records(_inflated(data) if name.as_py().endswith(".gz") else data):
                    rows.append(row)
                    if len(rows) >= 1000:
                        yield _table(rows)
                        rows = []
                yield _table(rows)

    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    return files.select("path", "content").mapInArrow(run, SCHEMA)


def responses_of_records(records: DataFrame) -> DataFrame:
    """The HTTP responses among ``records`` (of ``read``) as input of ``derivatives``: the
    header lines end at the first empty line of the block."""
    block = F.col("block")
    border = F.regexp_instr(block, F.lit(r"\r?\n\r?\n"))
    cut = F.when(border > 0, border).otherwise(F.length(block) + 1)
    return records.where("lower(warc_type) = 'response'").select(
        F.coalesce("source_key", "record_id").alias("source_key"), "record_id", "target_uri", "warc_date",
        F.substr(block, F.lit(1), cut - 1).alias("http_headers"),
        F.regexp_replace(F.substr(block, cut), r"\A\r?\n\r?\n", "").alias("payload"),
        F.col("source_payload_digest").alias("payload_digest"))
