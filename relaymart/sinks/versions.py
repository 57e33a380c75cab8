"""Small tables in numbered versions, the newest complete one counting.

A version is claimed (a file created exclusively, so two runs never write the
same number), written, and complete once Spark's ``_SUCCESS`` is there; that
single file is what switches readers. A run that dies on the way leaves a claim
and perhaps half a version: readers never see it, later runs number above it,
and :func:`clean` removes it once it is older than any run takes.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession

from relaymart.sinks import files

#: Seconds after which what an unfinished run left is taken for dead (runs are
#: started every six hours and end within one).
DEAD_AFTER = 6 * 3600
_CLAIM = ".claim"


def complete(spark: SparkSession, base: str) -> list[str]:
    """Names of complete versions, oldest first."""
    return sorted(v for v in files.names(spark, base)
                  if v.isdigit() and files.exists(spark, f"{base}/{v}/_SUCCESS"))


def claim(spark: SparkSession, base: str) -> str:
    """A new version number, above all that were ever begun."""
    while True:
        begun = [int(n.removesuffix(_CLAIM)) for n in files.names(spark, base) if n.removesuffix(_CLAIM).isdigit()]
        version = f"{max(begun, default=0) + 1:012d}"
        if files.create(spark, f"{base}/{version}{_CLAIM}"):
            return version


def write(rows: DataFrame, base: str, version: str | None = None) -> str:
    """Write ``rows`` (few) as a new version, or the one claimed before."""
    version = version or claim(rows.sparkSession, base)
    rows.coalesce(1).write.mode("errorifexists").parquet(f"{base}/{version}")
    files.remove(rows.sparkSession, f"{base}/{version}{_CLAIM}")
    return version


def read(spark: SparkSession, base: str, version: str | None = None) -> DataFrame | None:
    """A version's rows, by default the newest's; None if there is none."""
    if version is None:
        version = (complete(spark, base) or [None])[-1]
    return None if version is None else spark.read.parquet(f"{base}/{version}")


def clean(spark: SparkSession, base: str, keep: int, dead_after: float = DEAD_AFTER) -> list[str]:
    """Remove all but the newest ``keep`` complete versions, and what dead runs
    left unfinished. Returns the complete versions that stay."""
    done = complete(spark, base)
    for name, changed in files.listing(spark, base):
        number = name.removesuffix(_CLAIM)
        if not number.isdigit() or number in done[-keep:]:
            if number in done and name.endswith(_CLAIM):  # died between the version and its claim
                files.remove(spark, f"{base}/{name}")
            continue
        if number in done or time.time() - changed >= dead_after:
            files.remove(spark, f"{base}/{name}")
    return done[-keep:]


def clean_runs(spark: SparkSession, folder: str, named: set[str], dead_after: float = DEAD_AFTER) -> None:
    """Remove run folders that no remaining version names and no live run can be writing."""
    for name, changed in files.listing(spark, folder):
        if name not in named and time.time() - changed >= dead_after:
            files.remove(spark, f"{folder}/{name}")
