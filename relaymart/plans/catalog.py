"""Registered queries: name -> (spark, sf_dir) -> DataFrame, with oracles.

Every query derives its provider sources from the driver tables in
``sf_dir`` (whole tables, see :mod:`relaymart.sources.fixtures`) and runs
with the fixed ``AS_OF`` date, so results are reproducible. Array columns are
rendered as comma-joined text in the registered form (``tags``) so that the
order-insensitive value hash of the driver sees plain strings; the mart
functions themselves keep ``array<string>``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relaymart.plans.graph import MARTS, MODELS, SHARED, ModelGraph
from relaymart.session import apply_defaults, work_path
from relaymart.sources.fixtures import load_sources
from relaymart.testing import oracle as O

AS_OF = O.AS_OF

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE_SQL: dict[str, str] = {}


def graph(spark: SparkSession, sf_dir: str, as_of: str = AS_OF,
          materialize: bool = False) -> ModelGraph:
    """The model graph over the sources derived from ``sf_dir``.

    ``materialize``: write the multi-consumer intermediates and the marts
    once (zstd Parquet under the shared checkpoint folder) as they are first
    needed, and let consumers read the files. Used by queries that touch
    many models many times (the check suite). Staging models are a scan and
    a projection, cheaper to recompute than to write.
    """
    apply_defaults(spark)
    mat = None
    if materialize:
        base = work_path(spark, "models")

        def mat(name: str, df: DataFrame) -> DataFrame:
            path = f"{base}/{name}"
            df.write.mode("overwrite").option("compression", "zstd").parquet(path)
            return spark.read.schema(df.schema).parquet(path)
    return ModelGraph(load_sources(spark, sf_dir), as_of=as_of, materialize=mat,
                      shared=SHARED + MARTS if materialize else ())


def _render_arrays(df: DataFrame) -> DataFrame:
    for f in df.schema.fields:
        if f.dataType.typeName() == "array":
            df = df.withColumn(f.name, F.array_join(f.name, ","))
    return df


def register(name: str, fn: QueryFn, sql: str | None) -> None:
    QUERIES[name] = fn
    if sql is not None:
        ORACLE_SQL[name] = sql


def _model_query(name: str) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _render_arrays(graph(spark, sf_dir)[name])
    run.__name__ = name
    return run


_ARRAY_MODELS = {"stg_jobs": "tags", "dim_jobs": "tags"}

for _m in MODELS:
    _sel = None
    if _m in _ARRAY_MODELS:
        _c = _ARRAY_MODELS[_m]
        _sel = f"select * replace (array_to_string({_c}, ',') as {_c}) from {_m}"
    register(_m, _model_query(_m), O.model_sql(_m, select=_sel))


def _load_operator_queries() -> None:
    from relaymart.plans import operator_queries  # noqa: F401  (registers on import)


_load_operator_queries()
