"""Sinks: mart tables, Parquet exports and the publish manifest.

Executors write in parallel; nothing passes through the driver. Exports of
one publish run are written side by side under ``<base>/runs/<run_id>/`` and
then made current together by a new version of the one-row-per-export pointer
table, ``<base>/_pointers/<version>`` (:mod:`relaymart.sinks.versions`). Readers
take the newest version that was written to its end, so there is always one, and
they never mix two runs. A pointer row holds its export's row count and content
hash, observed while it was written, and readers check them.

The last ``KEEP`` versions and their runs stay. Older ones go, and so does what
runs left that died on the way, at the first publish that finds it dead; until
then it stands in nobody's way.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from relaymart.sinks import versions
from relaymart.sinks.digests import digest, digest_columns

#: Pointer versions (and their runs) that stay: the current one, and some for
#: readers that have begun on an older one.
KEEP = 3

# The published exports (name, dataset, relation).
MANIFEST_JSON = """[
  {"name": "jobs", "dataset": "dbt_prd", "relation": "dim_jobs"},
  {"name": "organizations", "dataset": "dbt_prd", "relation": "dim_organizations"}
]"""


@dataclass(frozen=True)
class ExportSpec:
    name: str
    dataset: str
    relation: str


def load_manifest(text: str = MANIFEST_JSON) -> list[ExportSpec]:
    """Parse and validate the export manifest (a JSON list of objects with
    non-empty ``name``, ``dataset`` and ``relation``; names unique)."""
    items = json.loads(text)
    if not isinstance(items, list):
        raise ValueError("manifest must be a JSON list")
    specs = []
    for it in items:
        missing = [k for k in ("name", "dataset", "relation")
                   if not isinstance(it.get(k), str) or not it.get(k)]
        if missing:
            raise ValueError(f"manifest entry {it!r} lacks {missing}")
        specs.append(ExportSpec(it["name"], it["dataset"], it["relation"]))
    names = [s.name for s in specs]
    if len(names) != len(set(names)):
        raise ValueError("duplicate export names")
    return specs


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None,
                mode: str = "overwrite") -> None:
    """Replace a table at ``path`` (zstd Parquet), optionally partitioned."""
    w = df.write.mode(mode).option("compression", "zstd")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def export_parquet(df: DataFrame, path: str) -> str:
    """Export a whole relation as zstd Parquet (``select *``) at ``path``.

    The export is a directory of part files written by all tasks in
    parallel; it is never funnelled through one task or the driver."""
    write_table(df, path)
    return path


_POINTER = "name string, relation string, run_id string, path string, n_rows long, content string"


class DamagedExport(ValueError):
    """An export does not hold what was published."""


def publish_exports(
    spark: SparkSession,
    relations: Mapping[str, DataFrame],
    base: str,
    manifest: list[ExportSpec] | None = None,
    run_id: str | None = None,
    dead_after: float = versions.DEAD_AFTER,
) -> DataFrame:
    """Export every manifest relation, then make this run the current one.
    Returns the pointer rows (name, relation, run_id, path, n_rows, content).

    A run that dies at any point leaves the previous version current; what it
    wrote is removed by the first publish at least ``dead_after`` seconds later."""
    manifest = manifest if manifest is not None else load_manifest()
    run_id, base = run_id or uuid.uuid4().hex[:12], base.rstrip("/")
    version = versions.claim(spark, f"{base}/_pointers")
    rows = []
    for spec in manifest:
        path, seen = f"{base}/runs/{run_id}/{spec.name}", Observation(f"export_{spec.name}")
        df = relations[spec.relation]
        export_parquet(df.observe(seen, *digest_columns(df.columns)), path)
        rows.append((spec.name, spec.relation, run_id, path, seen.get["n"], str(int(seen.get["content"]))))
    pointer = spark.createDataFrame(rows, _POINTER)
    versions.write(pointer, f"{base}/_pointers", version)
    kept = versions.clean(spark, f"{base}/_pointers", KEEP, dead_after)
    named = {r.run_id for v in kept for r in versions.read(spark, f"{base}/_pointers", v).select("run_id").collect()}
    versions.clean_runs(spark, f"{base}/runs", named, dead_after)
    return pointer


def read_published(spark: SparkSession, base: str, name: str, check: bool = True) -> DataFrame:
    """Read the current version of an export; ``check`` compares its rows with
    the pointer's count and content hash first (one pass over the export)."""
    pointer = versions.read(spark, f"{base.rstrip('/')}/_pointers")
    if pointer is None:
        raise FileNotFoundError(f"nothing is published under {base}")
    found = pointer.filter(F.col("name") == name).collect()  # a row an export
    if not found:
        raise FileNotFoundError(f"no published export {name!r} under {base}")
    df = spark.read.parquet(found[0].path)
    if check:
        n, content = digest(df)
        if (n, str(content)) != (found[0].n_rows, found[0].content):
            raise DamagedExport(f"{name} holds {n} rows with content {content}, not the published "
                                f"{found[0].n_rows} rows with {found[0].content}")
    return df
