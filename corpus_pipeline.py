"""The corpus pipeline: language ID, SimHash near-dedup, benchmark
decontamination, secret scans, packing, in this order.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's docs; all but the last return the
columns of ``documents`` (further columns pass through unchanged).

Null ids, null and empty texts, repeated rows and empty tables pass every stage
with the results its operator defines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from relaymart.llm import decontaminate, language_id, packing, secret_scan, simhash
from relaymart.llm.common import forget, ship, table, written


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or long ones like no learned language, go."""
    ship(spark)
    return language_id.in_known_language(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    ship(spark)
    return simhash.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out; documents mostly made of them go."""
    return decontaminate.remove_spans(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Credentials are replaced in the texts; every document stays."""
    ship(spark)
    return secret_scan.redact(docs, secret_scan.learn(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of training sequences, one row each."""
    ship(spark)
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("secret_scan", secrets),
    ("packing", pack),
]

#: Tokenisers, fingerprints and learned models have no SQL form; the stages are
#: tested against brute force instead.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    docs, last = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
        if last is not None:
            forget(last)
        last = docs
    return STAGES[-1][1](spark, docs, sf_dir)
