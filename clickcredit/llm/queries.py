"""Registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickcredit.llm import (
    decontamination,
    exact_dedup,
    fill_in_middle,
    line_dedup,
    ngram_join,
    packing,
    secret_scan,
    simhash_dedup,
    substring_dedup,
    suffix_dedup,
    token_alignment,
    toxicity,
    warc,
)
from clickcredit.llm.shared import documents


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs, model)


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.dedup_windows(documents(spark, sf_dir)).drop("kept")


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.link_documents(documents(spark, sf_dir))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.leaks(documents(spark, sf_dir),
                                 spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return warc.derivatives(warc.responses_of_pages(pages))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_chunks(documents(spark, sf_dir))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(documents(spark, sf_dir))


def op8_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup_substrings(documents(spark, sf_dir)).drop("kept")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_copies(documents(spark, sf_dir))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.align(
        documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("piece_bpe_32k.model")).withColumnRenamed("groups", "groups_sha256")


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = fill_in_middle.transform(documents(spark, sf_dir))
    back = fill_in_middle.restored(F.col("output"), F.col("form"))
    return done.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                       F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(back, 256).alias("restored_sha256"))


def op13_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.near_copies(documents(spark, sf_dir)).select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_ngram_jaccard": op3_ngram_jaccard,
    "op4_decontamination": op4_decontamination,
    "op5_warc": op5_warc,
    "op6_line_dedup": op6_line_dedup,
    "op7_secret_scan": op7_secret_scan,
    "op8_suffix_array": op8_suffix_array,
    "op9_packing": op9_packing,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_token_alignment": op11_token_alignment,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_simhash_dedup": op13_simhash_dedup,
}

ORACLE = {
    "op2_substring_dedup": """
WITH d AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'),
                             lambda x: x <> '') AS words
  FROM documents
), win AS (
  SELECT doc_id, s, sha256(array_to_string(words[s:s + 49], ' ')) AS h
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS s FROM d WHERE len(words) >= 50)
), hit AS (
  SELECT doc_id, s FROM (SELECT doc_id, s, min(doc_id) OVER (PARTITION BY h) AS lo FROM win)
  WHERE lo < doc_id
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(s, s + 50)) AS p FROM hit
), g AS (
  SELECT doc_id, list(p) AS ps FROM gone GROUP BY doc_id
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
       CAST(coalesce(len(ps), 0) AS BIGINT) AS n_removed,
       sha256(array_to_string(
         CASE WHEN ps IS NULL THEN words
              ELSE list_transform(list_filter(range(1, len(words) + 1),
                                              lambda i: NOT list_contains(ps, i)), lambda i: words[i]) END,
         ' ')) AS kept_sha256
FROM d LEFT JOIN g USING (doc_id)
""",
    "op10_exact_dedup": """
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_points,
         sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g')) AS text_sha256
  FROM documents
)
SELECT doc_id,
       first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER w = 1 AS kept,
       text_sha256
FROM t WINDOW w AS (PARTITION BY text_sha256 ORDER BY n_points DESC, doc_id)
""",
    "op12_fill_in_middle": """
WITH h AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS hx
  FROM documents
), u AS (
  SELECT doc_id, text, CAST('0x' || hx[1:8] AS BIGINT) AS h1, CAST('0x' || hx[9:16] AS BIGINT) AS h2,
         CAST('0x' || hx[17:24] AS BIGINT) AS h3, CAST('0x' || hx[25:32] AS BIGINT) AS h4,
         regexp_extract_all(text, '[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+') AS units
  FROM h
), c AS (
  SELECT *, CAST(len(units) AS BIGINT) AS n,
         least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS a,
         greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                   OR h3 % 100 >= 50 THEN 'plain'
              WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM u
), p AS (
  SELECT doc_id, text, n, form, coalesce(array_to_string(units[1:a], ''), '') AS prefix,
         coalesce(array_to_string(units[a + 1:b], ''), '') AS middle,
         coalesce(array_to_string(units[b + 1:], ''), '') AS suffix
  FROM c
)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text
                        WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM p
""",
}
