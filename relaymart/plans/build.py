"""The build: models -> contracts -> checks -> publish, as Spark jobs.

``build(...)`` writes the shared intermediates once (to the cluster's shared
checkpoint folder) so their several consumers read files instead of
recomputing the plan, enforces each mart's contract before writing it, and
counts NULLs in its NOT NULL columns and values of its JSON columns that are no
JSON while writing it (observed metrics).
Marts are written as a new generation (:mod:`relaymart.sinks.generations`) and
become current together, by one pointer, only when all of them are written and, in
a strict build, none was refused. Then the declared checks run, and the exports are
published only when all of that passed. The intermediates, and a generation that
did not become current, are removed at the end.
"""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from relaymart.plans.graph import MARTS, ModelGraph
from relaymart.quality.checks import run_suite
from relaymart.quality.contracts import ContractError, constraint_metrics, enforce_schema
from relaymart.session import apply_defaults, work_path
from relaymart.operators.sets import combine_properties
from relaymart.sinks import files, generations
from relaymart.sinks.buckets import KEYS, register_buckets, write_buckets
from relaymart.sinks.publish import publish_exports, write_table
from relaymart.sources.fixtures import load_sources
from relaymart.sources.tables import UtcSources
from relaymart.streaming.incremental import rebuild_trailing_window


@dataclass
class BuildResult:
    marts: dict[str, DataFrame]
    marts_dir: str
    constraint_violations: DataFrame
    check_report: DataFrame | None
    published: DataFrame | None = None
    problems: list[str] = field(default_factory=list)
    json_violations: DataFrame | None = None


def _materializer(spark: SparkSession, base: str):
    def materialize(name: str, df: DataFrame) -> DataFrame:
        path = f"{base}/{name}"
        write_table(df, path)
        return spark.read.schema(df.schema).parquet(path)
    return materialize


# intermediate model -> mart that holds the same rows and columns
SAME_COLUMNS = {"int_email_messages": "dim_email_messages", "int_email_subscribers": "dim_email_subscribers"}

# Fixed value: first day of the web-analytics exports that is read.
WEB_START_DATE = "20220101"

# mart -> marts it reads (the rest of its inputs are staging/intermediate)
MART_DEPENDENCIES = {
    "dim_organizations": (),
    "dim_jobs": ("dim_organizations",),
    "dim_email_messages": (),
    "dim_email_subscribers": (),
    "fct_email_events": (),
    "fct_email_subscriber_messages": ("fct_email_events",),
    "fct_email_subscribers_daily": (),
    "fct_form_submissions": ("dim_email_subscribers", "dim_jobs", "dim_organizations"),
}


def register_table(spark: SparkSession, database: str, name: str, path: str) -> None:
    """Register ``database.name`` as an external Parquet table at ``path``. A
    table that is there already with these columns is pointed at the path in one
    step, so its readers see no gap."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    full, columns = f"`{database}`.`{name}`", spark.read.parquet(path).dtypes
    if spark.catalog.tableExists(f"{database}.{name}"):
        if _table_columns(spark, full) == columns:
            spark.sql(f"ALTER TABLE {full} SET LOCATION '{_qualified(spark, path)}'")
            spark.sql(f"REFRESH TABLE {full}")
            return
        spark.sql(f"DROP TABLE {full}")
    spark.catalog.createTable(f"{database}.{name}", path=path, source="parquet")


def _table_columns(spark: SparkSession, full: str) -> list[tuple[str, str]]:
    """Columns as the catalog has them: the files may be gone."""
    rows = spark.sql(f"DESCRIBE TABLE {full}").collect()  # a row a column
    return [(r.col_name, r.data_type) for r in rows if r.col_name and not r.col_name.startswith("#")]


def _qualified(spark: SparkSession, path: str) -> str:
    fs, p = files._path(spark, path)
    return fs.makeQualified(p).toString()


def mart_waves() -> list[list[str]]:
    """Marts grouped so each wave depends only on earlier waves."""
    done: set[str] = set()
    waves = []
    while len(done) < len(MARTS):
        wave = [m for m in MARTS if m not in done
                and all(d in done for d in MART_DEPENDENCIES[m])]
        waves.append(wave)
        done.update(wave)
    return waves


def build(
    spark: SparkSession,
    sources: Mapping[str, DataFrame],
    as_of: str,
    marts_dir: str | None = None,
    strict: bool = True,
    run_checks: bool = True,
    publish_base: str | None = None,
    threads: int = 4,
    database: str | None = None,
    manifest=None,
    web_exports: Mapping[int, DataFrame] | None = None,
    full_refresh: bool = False,
    buckets: int | None = None,
) -> BuildResult:
    """Build every mart from ``sources``.

    ``strict``: raise :class:`ContractError` on a schema mismatch, a NULL in a
    NOT NULL column or a value of a JSON column that is none, before marts that read the refused one are built; what was
    there before the build, tables included, stays as it was. Otherwise
    violations are recorded in the result. Publishing happens only after the
    checks ran and when there were no problems. Up to ``threads`` independent
    marts are written at the same time.

    ``web_exports``: event exports by web-analytics property; their union is
    rebuilt over the trailing window at ``<marts_dir>/web_events`` (or whole,
    if it is not there yet; its history is protected, so ``full_refresh`` does
    not rewrite it). The marts themselves are rebuilt whole in every build.

    ``database``: also register each mart as the catalog table
    ``<database>.<mart>`` (pointed at the new set on every build), the per-target
    schema of a deployment (e.g. ``prd``, ``ci_<n>``, ``dev_<user>``). Readers that
    need all marts of one build use :func:`generations.read_mart`.

    ``buckets``: with a ``database``, dimensions are written and registered in so
    many buckets of their key (:mod:`relaymart.sinks.buckets`)."""
    apply_defaults(spark)
    if publish_base and not run_checks:
        raise ValueError("only checked data is published")
    if buckets and not database:
        raise ValueError("buckets are known to a catalog table only: name a database")
    inter_dir = work_path(spark, "intermediate")
    marts_dir = (marts_dir or work_path(spark, "marts")).rstrip("/")
    generation = generations.begin()
    run_dir = generations.folder(marts_dir, generation)
    try:
        return _build(spark, sources, as_of, marts_dir, generation, inter_dir, strict, run_checks, publish_base, threads,
                      database, manifest, web_exports, full_refresh, buckets)
    finally:
        if run_dir not in {path.rsplit("/", 1)[0] for path in generations.current(spark, marts_dir).values()}:
            files.remove(spark, run_dir)
        files.remove(spark, inter_dir)


def _build(spark, sources, as_of, marts_dir, generation, inter_dir, strict, run_checks, publish_base, threads,
           database, manifest, web_exports, full_refresh, buckets) -> BuildResult:
    sources = UtcSources(sources)
    run_dir = generations.folder(marts_dir, generation)
    g = ModelGraph(sources, as_of=as_of, materialize=_materializer(spark, inter_dir))
    marts: dict[str, DataFrame] = {}
    problems: list[str] = []
    observations: dict[str, Observation] = {}
    bad: list[tuple[str, str, str, int]] = []  # mart, constraint, column, rows
    written: list[str] = []
    for wave in mart_waves():
        # plans are built on this thread; independent marts are then written
        # as concurrent Spark jobs (the scheduler shares the executors). What
        # breaks a constraint is counted *while* each mart is written
        # (observed metrics of the write job): no second pass over the data.
        plans = {}
        for name in wave:
            obs = observations[name] = Observation(f"constraints_{name}")
            plans[name] = enforce_schema(g[name], name).observe(obs, *constraint_metrics(name))
        with ThreadPoolExecutor(max_workers=min(threads, len(wave))) as pool:
            list(pool.map(lambda n: write_buckets(plans[n], f"{run_dir}/{n}", KEYS[n], buckets) if buckets and n in KEYS
                          else write_table(plans[n], f"{run_dir}/{n}"), wave))
        bad += [(m, *c.split(":"), int(n)) for m in wave for c, n in observations[m].get.items() if n]
        if bad and strict:
            raise ContractError("; ".join(_problem(*b) for b in bad))
        for name in wave:  # later marts read the written table
            g._cache[name] = spark.read.schema(plans[name].schema).parquet(f"{run_dir}/{name}")
        written += wave
    generations.switch(spark, marts_dir, generation, written)
    for name in written:
        marts[name] = g._cache[name]
        if buckets and name in KEYS:
            register_buckets(spark, database, name, f"{run_dir}/{name}", KEYS[name], buckets)
        elif database:
            register_table(spark, database, name, f"{run_dir}/{name}")
    generations.clean(spark, marts_dir)
    violations = spark.createDataFrame([(m, c, n) for m, kind, c, n in bad if kind == "null"],
                                       "mart string, column_name string, n_nulls bigint")
    not_json = spark.createDataFrame([(m, c, n) for m, kind, c, n in bad if kind == "json"],
                                     "mart string, column_name string, n_invalid bigint")
    problems += [_problem(*b) for b in bad]
    if web_exports:
        union = combine_properties(web_exports, WEB_START_DATE)
        rebuild_trailing_window(spark, union, f"{marts_dir}/web_events", "event_date", as_of,
                                full_refresh=full_refresh, protected=True)
    report = None
    if run_checks:
        # models that a mart repeats column by column are checked in the mart
        same = {n: marts[m].select(*g[n].columns) for n, m in SAME_COLUMNS.items()}
        lookup = {**{n: g[n] for n in g._cache}, **marts, **same}
        report = run_suite(lambda n: lookup[n] if n in lookup else g[n])
        write_table(report, f"{run_dir}/_check_report")
        report = spark.read.parquet(f"{run_dir}/_check_report")
        failed = report.filter(F.col("failures") > 0).count()
        if failed:
            problems.append(f"{failed} data check(s) failed")
    published = None
    if publish_base and not problems:
        published = publish_exports(spark, marts, publish_base, manifest)
    return BuildResult(marts, marts_dir, violations, report, published, problems, not_json)


def _problem(mart: str, kind: str, column: str, n: int) -> str:
    return f"{mart}.{column}: {n} " + ("NULL(s) in a NOT NULL column" if kind == "null" else "value(s) that are no JSON")


def build_all(spark: SparkSession, sf_dir: str, as_of: str, **kw) -> BuildResult:
    """Build from the provider sources derived from the driver tables."""
    kw.setdefault("strict", False)
    return build(spark, load_sources(spark, sf_dir), as_of, **kw)
