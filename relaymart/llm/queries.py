"""The registered corpus queries: each applies its operator to whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relaymart.llm import (decontaminate, html_wrappers, language_id, license_scan, nearest, packing, pii, quality_fm, secret_scan,
                           simhash, token_alignment, warc, whitening)
from relaymart.llm.common import table


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_fm.classify(table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars"),
                               table(spark, sf_dir, "labels"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.predict(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))


def op4_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.report(table(spark, sf_dir, "documents"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


OP6_SQL = """
with p as (select page_id, coalesce(html, '') as html from pages),
d as (select page_id, octet_length(encode(html)) as n, sha1(html) as hex from p),
m as (select hex, max(page_id) as last from d group by hex)
select d.page_id, d.n::bigint as payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    (1 + ((('0x' || substr(d.hex, (1 + 5 * (i // 4))::int, 5))::bigint >> (15 - 5 * (i % 4))::int) & 31))::int, 1)), '')
    as payload_digest,
  case when d.page_id = m.last then 'response' else 'revisit' end as record_type,
  case when d.page_id <> m.last then m.last end as refers_to
from d join m using (hex)
"""


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.report(table(spark, sf_dir, "documents"))


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_wrappers.extract(table(spark, sf_dir, "pages"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.groups(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op11_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.report(table(spark, sf_dir, "documents"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.report(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_quality, op2_decontaminate, op3_language_id, op4_pack, op5_license_scan, op6_warc, op7_secret_scan, op8_html_text, op9_simhash, op10_nearest,
                              op11_pii, op12_token_alignment, op13_whitening)
}
ORACLE_SQL: dict[str, str] = {"op6_warc": OP6_SQL}
