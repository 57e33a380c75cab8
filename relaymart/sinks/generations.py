"""Sets of marts that are switched as one.

Each build writes its marts under ``<marts_dir>/generations/<generation>/`` and
then a new version of the pointer ``<marts_dir>/_generations``, which names the
generation of every mart. That one version is all that readers go by, so they see
the whole old set or the whole new one, whatever step a build dies at, and nothing
is ever renamed. The generations that the last ``KEEP`` versions name stay, for
readers that have begun on them and for :func:`roll_back`; others are removed.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from relaymart.sinks import files, versions

#: Pointer versions that stay.
KEEP = 3


def begin() -> str:
    """The name of a new generation."""
    return uuid.uuid4().hex[:12]


def folder(marts_dir: str, generation: str) -> str:
    return f"{marts_dir.rstrip('/')}/generations/{generation}"


def _pointer(marts_dir: str) -> str:
    return f"{marts_dir.rstrip('/')}/_generations"


def switch(spark: SparkSession, marts_dir: str, generation: str, marts: Iterable[str]) -> None:
    """Make a wholly written generation the current one."""
    rows = [(mart, generation) for mart in marts]
    versions.write(spark.createDataFrame(rows, "mart string, generation string"), _pointer(marts_dir))


def clean(spark: SparkSession, marts_dir: str, dead_after: float = versions.DEAD_AFTER) -> None:
    """Remove what no remaining version names and no live build can be writing."""
    kept = versions.clean(spark, _pointer(marts_dir), KEEP, dead_after)
    named = {r.generation for v in kept for r in versions.read(spark, _pointer(marts_dir), v).collect()}  # a row a mart
    versions.clean_runs(spark, f"{marts_dir.rstrip('/')}/generations", named, dead_after)


def current(spark: SparkSession, marts_dir: str, version: str | None = None) -> dict[str, str]:
    """Mart -> path in the current (or a named) version; empty if there is none."""
    pointer = versions.read(spark, _pointer(marts_dir), version)
    if pointer is None:
        return {}
    return {r.mart: f"{folder(marts_dir, r.generation)}/{r.mart}" for r in pointer.collect()}  # a row a mart


def read_mart(spark: SparkSession, marts_dir: str, mart: str, schema: StructType | None = None) -> DataFrame:
    """A mart of the current set."""
    path = current(spark, marts_dir).get(mart)
    if path is None:
        raise FileNotFoundError(f"no mart {mart!r} under {marts_dir}")
    return (spark.read.schema(schema) if schema is not None else spark.read).parquet(path)


def check_report(spark: SparkSession, marts_dir: str) -> DataFrame | None:
    """The check report of the current set; None if it was not checked."""
    for path in current(spark, marts_dir).values():
        report = f"{path.rsplit('/', 1)[0]}/_check_report"
        return spark.read.parquet(report) if files.exists(spark, f"{report}/_SUCCESS") else None
    return None


def roll_back(spark: SparkSession, marts_dir: str) -> str:
    """Make the set before the current one current again; returns its generation.
    Rolling back twice goes on to the set before that, if it is still there."""
    done = versions.complete(spark, _pointer(marts_dir))
    if not done:
        raise FileNotFoundError(f"no marts under {marts_dir}")
    sets = [{(r.mart, r.generation) for r in versions.read(spark, _pointer(marts_dir), v).collect()} for v in done]
    # a set's place in time is where it was first switched to
    order = [s for i, s in enumerate(sets) if s not in sets[:i]]
    at = order.index(sets[-1])
    earlier = [s for s in order[:at] if all(files.exists(spark, folder(marts_dir, g)) for _, g in s)]
    if not earlier:
        raise FileNotFoundError(f"no earlier set of marts under {marts_dir}")
    rows = spark.createDataFrame(sorted(earlier[-1]), "mart string, generation string")
    versions.write(rows, _pointer(marts_dir))
    return sorted(earlier[-1])[0][1]
