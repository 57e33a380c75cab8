"""Dimensions stored in buckets of their key.

A lookup of a fact in a dimension too large to broadcast shuffles both. A
dimension written in buckets of its key is read already dealt out and sorted by
it, so only the fact is shuffled, at every lookup of every reader. Dimensions are
unique on their key, so buckets are even; facts are not bucketed, as all rows of a
hot key would have to be read by one task.

What it costs: Spark does not split a hot key of the fact in such a join, as it
can when both sides are shuffled. Use buckets where the dimension is large against
the fact's hottest key.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

#: Bytes of a dimension that a bucket should hold.
BUCKET_BYTES = 256 * 1024 * 1024
#: Mart -> key that facts look it up by.
KEYS = {"dim_email_subscribers": "subscriber_id", "dim_email_messages": "email_id", "dim_jobs": "job_id",
        "dim_organizations": "organization_id"}


def bucket_count(size_bytes: int, cores: int) -> int:
    """Buckets for a dimension of this size: full ones, at least one a core, a power of two."""
    wanted = max(1, cores, -(-size_bytes // BUCKET_BYTES))
    return 1 << (wanted - 1).bit_length()


def write_buckets(df: DataFrame, path: str, key: str, n: int) -> None:
    """Write ``df`` at ``path`` in ``n`` sorted buckets of ``key``, one file each:
    rows are dealt out by the hash that gives the bucket."""
    spark, name = df.sparkSession, f"writing_{uuid.uuid4().hex[:12]}"
    (df.repartition(n, key).write.format("parquet").mode("overwrite").option("compression", "zstd")
     .bucketBy(n, key).sortBy(key).option("path", path).saveAsTable(name))
    spark.sql(f"DROP TABLE {name}")  # external: the files stay


def register_buckets(spark: SparkSession, database: str, name: str, path: str, key: str, n: int) -> None:
    """Register files of :func:`write_buckets` as ``database.name``. A table that is
    there already with these columns and buckets is pointed at them in one step."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    full, columns = f"`{database}`.`{name}`", spark.read.parquet(path).dtypes
    if spark.catalog.tableExists(f"{database}.{name}"):
        said = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {full}").collect()}
        same = said.get("Num Buckets") == str(n) and said.get("Bucket Columns") == f"[`{key}`]"
        if same and [(c, said.get(c)) for c, _ in columns] == columns:
            spark.sql(f"ALTER TABLE {full} SET LOCATION '{path}'")
            spark.sql(f"REFRESH TABLE {full}")
            return
        spark.sql(f"DROP TABLE {full}")
    listed = ", ".join(f"`{c}` {t}" for c, t in columns)
    spark.sql(f"CREATE TABLE {full} ({listed}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {n} BUCKETS "
              f"LOCATION '{path}'")
