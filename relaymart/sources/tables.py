"""Read real provider source tables (one Parquet folder per source).

A production run reads the loaders' tables instead of the fixture
derivations: ``<base>/<source name>`` for each of the nine sources (names in
:data:`relaymart.sources.fixtures.SOURCE_NAMES`). Each is read lazily, on
first use, so a command only lists the folders it needs.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from relaymart.sources.fixtures import SOURCE_NAMES


def utc_wall_clock(df: DataFrame) -> DataFrame:
    """Zoned TIMESTAMP columns as UTC wall clock (TIMESTAMP_NTZ), which is what
    the models compute with; the session zone has no part in it. Columns that
    are TIMESTAMP_NTZ already are taken to be UTC and stay as they are."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    zoned = [f.name for f in df.schema.fields if isinstance(f.dataType, TimestampType)]
    return df.withColumns({c: F.timestamp_add("MICROSECOND", F.unix_micros(F.col(c)), epoch) for c in zoned}) if zoned else df


class UtcSources(Mapping):
    """Any mapping of sources, each read through :func:`utc_wall_clock`."""

    def __init__(self, sources: Mapping[str, DataFrame]):
        self._sources = sources

    def __getitem__(self, name: str) -> DataFrame:
        return utc_wall_clock(self._sources[name])

    def __iter__(self):
        return iter(self._sources)

    def __len__(self):
        return len(self._sources)


class SourceTables(Mapping):
    def __init__(self, spark: SparkSession, base: str, names=SOURCE_NAMES,
                 fmt: str = "parquet"):
        self._spark, self._base, self._names, self._fmt = spark, base.rstrip("/"), tuple(names), fmt
        self._cache: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._names:
            raise KeyError(name)
        if name not in self._cache:
            self._cache[name] = utc_wall_clock(
                self._spark.read.format(self._fmt).load(f"{self._base}/{name}"))
        return self._cache[name]

    def __iter__(self):
        return iter(self._names)

    def __len__(self):
        return len(self._names)
