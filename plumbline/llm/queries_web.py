"""Queries over pages: URL verdicts and deduplicated archives."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import scratch, stored, table
from .url_filter import Rule, url_verdicts
from .warc import read_archives, resolved, write_archives

RULES = [
    Rule.of("com/", True),
    Rule.of("example.com/en/", False),
    Rule.of("www.example.com/en/", True),
    Rule.of("net/es/", False),
    Rule.of("net/fr/", False),
]


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_verdicts(table(spark, sf_dir, "pages"), RULES)


def op7_warc_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch(spark, "warc")
    write_archives(table(spark, sf_dir, "pages"), folder)
    out = resolved(stored(spark, read_archives(spark, folder), "headers"))
    return out.select(
        F.col("id").alias("page_id"), F.col("bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"), "record_type", "refers_to"
    )


QUERIES = {"op1_url_filter": op1_url_filter, "op7_warc_dedup": op7_warc_dedup}

ORACLE_SQL = {
    "op1_url_filter": """
WITH u AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), p AS (
  SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw,
         regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path
  FROM u
), h AS (
  SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path FROM p
), rules(rhost, rpath, verdict) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
         ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), hit AS (
  SELECT h.page_id, h.host, h.path, rhost || rpath AS rule, verdict,
         row_number() OVER (PARTITION BY h.page_id ORDER BY length(rhost) DESC NULLS LAST, length(rpath) DESC) AS k
  FROM h LEFT JOIN rules ON ('.' || h.host LIKE '%.' || rhost) AND starts_with(h.path, rpath)
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM hit WHERE k = 1
""",
    "op7_warc_dedup": """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), f AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM f
""",
}
