"""Hit sources: the tab-separated hit files, and hits derived from ``events``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.sqltext import rx
from ..schema import HIT_COLUMNS, HIT_SCHEMA
from .tables import read_table


def read_hits(spark: SparkSession, path: str | list[str], *, multiline: bool = False,
              with_source: bool = True) -> DataFrame:
    """Scan hit files: header row, tab-separated, explicit schema.

    ``enforceSchema=false`` makes a header that does not match the schema an
    error instead of silently shifting columns. Short rows become nulls
    (PERMISSIVE). ``multiLine`` allows quoted newlines but stops file
    splitting, so it is off by default. ``source_file`` scopes sessions to one
    file when a whole folder is read. Split sizes are the session's
    (``spark.sql.files.maxPartitionBytes``, ``minPartitionNum``).
    """
    reader = (spark.read.schema(HIT_SCHEMA)
              .option("header", True)
              .option("sep", "\t")
              .option("enforceSchema", False)
              .option("mode", "PERMISSIVE")
              .option("timestampFormat", "yyyy-MM-dd HH:mm:ss")
              .option("multiLine", multiline))
    df = reader.csv(path)
    if with_source:
        df = df.withColumn("source_file", F.col("_metadata.file_path"))
    return df


# props holds one flat object like {"k": 69}; reading the number by pattern
# gives the same value as a JSON path at a fraction of the cost.
_K = r'"k"\s*:\s*(-?[0-9]+)'

_VIEW_REFERRER = """CASE WHEN _k % 4 = 0 THEN concat('http://www.google.com/search?hl=en&q=Key+', CAST(_k % 7 AS STRING))
     WHEN _k % 4 = 1 THEN concat('http://www.bing.com/search?q=key%20', CAST(_k % 7 AS STRING), '&form=QBLH')
     WHEN _k % 4 = 2 THEN concat('http://search.yahoo.com/search?p=KEY+', CAST(_k % 7 AS STRING), '&toggle=1')
     ELSE 'http://www.esshopzilla.com/search/?k=Key' END"""
_ERROR_REFERRER = """CASE WHEN _k % 6 = 0 THEN 'https://www.google.com/search?q=C%2B%2B&hl=en'
     WHEN _k % 6 = 1 THEN concat('https://duckduckgo.com/?q=&p=x', CAST(_k % 5 AS STRING))
     WHEN _k % 6 = 2 THEN 'http://Search.Yahoo.com:8080/s?search=100%25+off#q=frag'
     WHEN _k % 6 = 3 THEN '//m.example.org/find?keywords=Blue%2BRed'
     WHEN _k % 6 = 4 THEN 'www.google.com/search?q=nohost'
     ELSE 'https://www.bing.com/search?p=a&q=b&q=c' END"""


def hits_from_events(events: DataFrame) -> DataFrame:
    """Derive web hits from the ``events`` table (one hit per event).

    The same rules exist as SQL in ``plans.oracle`` so both engines see the
    same input:

    * ``ip`` = ``10.0.0.<user_id>``; order key ``(ts, hit_id)``; ``ts`` stays a
      zone-less timestamp, so results do not depend on the session time zone.
    * ``event_list``: purchase ``1``, click ``2``, signup ``12``, else blank.
    * ``k`` = the number in ``props`` (``{"k": n}``).
    * ``product_list``: purchase ``Electronics;Item;<1 + k % 3>;<value, 2 decimals>;``,
      click ``Electronics;Item;1;;``, else null.
    * ``referrer``: views come from google / bing / yahoo / the own site by
      ``k % 4``; errors carry URL edge cases by ``k % 6``; others null.
    """
    with_k = events.selectExpr("event_id", "ts", "user_id", "event_type", "value",
                               f"try_cast(regexp_extract(props, {rx(_K)}, 1) AS BIGINT) AS _k")
    return with_k.selectExpr(
        "event_id AS hit_id",
        "ts",
        # ts is a wall-clock timestamp (no zone); epoch seconds without any
        # session-zone conversion, which could shift times near DST changes.
        "CAST(unix_date(CAST(ts AS DATE)) AS BIGINT) * 86400 + hour(ts) * 3600 + minute(ts) * 60 + second(ts) "
        "AS hit_time_gmt",
        "ts AS date_time",
        "CAST(NULL AS STRING) AS user_agent",
        "concat('10.0.0.', CAST(user_id AS STRING)) AS ip",
        "CASE event_type WHEN 'purchase' THEN '1' WHEN 'click' THEN '2' WHEN 'signup' THEN '12' "
        "ELSE '' END AS event_list",
        "CAST(NULL AS STRING) AS geo_city",
        "CAST(NULL AS STRING) AS geo_region",
        "CAST(NULL AS STRING) AS geo_country",
        "event_type AS pagename",
        "CAST(NULL AS STRING) AS page_url",
        "CASE WHEN event_type = 'purchase' THEN concat('Electronics;Item;', CAST(1 + _k % 3 AS STRING), "
        "';', CAST(CAST(value AS DECIMAL(18,2)) AS STRING), ';') "
        "WHEN event_type = 'click' THEN 'Electronics;Item;1;;' END AS product_list",
        f"CASE WHEN event_type = 'view' THEN {_VIEW_REFERRER} "
        f"WHEN event_type = 'error' THEN {_ERROR_REFERRER} END AS referrer",
    )


def load_event_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hits_from_events(read_table(spark, sf_dir, "events"))


__all__ = ["HIT_COLUMNS", "hits_from_events", "load_event_hits", "read_hits"]
