"""The staging and intermediate models by name, for SQL texts."""

from __future__ import annotations

from relaymart.plans.graph import INTERMEDIATE, STAGING, ModelGraph

#: Models that are views (``dates`` is inlined into what reads it, but has a name too).
VIEWS = STAGING + INTERMEDIATE


def create_views(spark, graph: ModelGraph, names=VIEWS, prefix: str = "") -> list[str]:
    """Register models as temporary views of the session, ``<prefix><model>``.

    A view is the model's plan over the graph's sources, computed when it is read
    and no further than the reader needs: Spark prunes columns and pushes filters
    through it down to the scans. A later call replaces the views."""
    for name in names:
        graph[name].createOrReplaceTempView(f"{prefix}{name}")
    return [f"{prefix}{name}" for name in names]


def drop_views(spark, names=VIEWS, prefix: str = "") -> None:
    for name in names:
        spark.catalog.dropTempView(f"{prefix}{name}")
