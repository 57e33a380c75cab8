"""Command line: ``python -m relaymart <command>``.

* ``build``     - build every mart from the provider sources derived from the
                  driver tables in ``--sf-dir``, enforce contracts, run the
                  161 checks, and publish the exports when ``--publish-base``
                  is given and nothing failed;
* ``freshness`` - print the source freshness report (exit status 1 if a source
                  is too old);
* ``checks``    - print the failing checks of a build;
* ``publish``   - export the marts in ``--marts-dir`` as the manifest says and
                  make them current, without a build.
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="relaymart")
    sub = p.add_subparsers(dest="command", required=True)
    for name in ("build", "freshness", "checks"):
        sp = sub.add_parser(name)
        src = sp.add_mutually_exclusive_group(required=True)
        src.add_argument("--sf-dir", help="folder with the driver tables (derived sources)")
        src.add_argument("--sources-dir",
                         help="folder with one Parquet folder per provider source table")
        sp.add_argument("--as-of", default=None, help="run date (default: today, UTC)")
        sp.add_argument("--master", default=None, help="local master, e.g. local[8]")
        if name in ("build", "checks"):
            sp.add_argument("--marts-dir", default=None)
            sp.add_argument("--publish-base", default=None)
            sp.add_argument("--database", default=None,
                            help="register the marts as tables in this schema (per target)")
            sp.add_argument("--strict", action="store_true",
                            help="fail on contract violations before running checks")
        if name == "freshness":
            sp.add_argument("--now", default=None, help="UTC timestamp to age against")
        if name == "build":
            sp.add_argument("--manifest", default=None, help="JSON file with the exports")
            sp.add_argument("--full-refresh", action="store_true",
                            help="rewrite unprotected incremental tables whole")
            sp.add_argument("--web-export", action="append", default=[], metavar="ID=PATH",
                            help="event export (Parquet) of a web-analytics property")
    sp = sub.add_parser("roll-back", help="make the set of marts before the current one current again")
    sp.add_argument("--marts-dir", required=True)
    sp.add_argument("--master", default=None, help="local master, e.g. local[8]")
    sp = sub.add_parser("publish")
    sp.add_argument("--marts-dir", required=True)
    sp.add_argument("--publish-base", required=True)
    sp.add_argument("--manifest", default=None, help="JSON file with the exports")
    sp.add_argument("--master", default=None, help="local master, e.g. local[8]")
    args = p.parse_args(argv)

    from pyspark.sql import SparkSession

    from relaymart.plans.intermediate import default_as_of
    from relaymart.session import apply_defaults, ensure_checkpoint_dir, local_session

    if args.master:
        spark = local_session(args.master.removeprefix("local[").rstrip("]") or "*")
    else:
        spark = SparkSession.builder.getOrCreate()
        apply_defaults(spark)
        ensure_checkpoint_dir(spark)
    manifest = None
    if getattr(args, "manifest", None):
        from relaymart.sinks.publish import load_manifest
        with open(args.manifest, encoding="utf-8") as f:
            manifest = load_manifest(f.read())
    if args.command == "roll-back":
        from relaymart.sinks import generations
        print(f"generation {generations.roll_back(spark, args.marts_dir)} is current")
        return 0
    if args.command == "publish":
        return publish(spark, args.marts_dir, args.publish_base, manifest)
    as_of = args.as_of or default_as_of()

    if args.sources_dir:
        from relaymart.sources.tables import SourceTables
        sources = SourceTables(spark, args.sources_dir)
    else:
        from relaymart.sources.fixtures import load_sources
        sources = load_sources(spark, args.sf_dir)

    if args.command == "freshness":
        from relaymart.sources.freshness import freshness_report
        now = args.now or dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
        rows = freshness_report(sources, now).collect()  # one row a source
        for r in rows:
            print(f"{r.source}: {r.status}, newest row {r.max_loaded_at}, {r.age_hours} h old")
        return int(any(r.status == "error" for r in rows))

    from relaymart.plans.build import build
    from relaymart.quality.contracts import ContractError
    try:
        res = build(spark, sources, as_of, marts_dir=args.marts_dir, strict=args.strict,
                    publish_base=args.publish_base, database=args.database, manifest=manifest,
                    web_exports=_web_exports(spark, getattr(args, "web_export", [])),
                    full_refresh=getattr(args, "full_refresh", False))
    except ContractError as e:
        print(f"contract violation: {e}", file=sys.stderr)
        return 2
    if args.command == "checks" and res.check_report is not None:
        res.check_report.filter("failures > 0").show(200, truncate=False)
    for problem in res.problems:
        print(f"problem: {problem}", file=sys.stderr)
    print(f"marts written to {res.marts_dir}")
    if res.published is not None:
        res.published.show(truncate=False)
    return 1 if res.problems else 0


def _web_exports(spark, items: list[str]):
    return {int(i): spark.read.parquet(path) for i, _, path in (item.partition("=") for item in items)}


def publish(spark, marts_dir: str, base: str, manifest=None) -> int:
    """Export marts whose last build was checked without a failure."""
    from relaymart.sinks import files, generations
    from relaymart.sinks.publish import load_manifest, publish_exports

    marts_dir, manifest = marts_dir.rstrip("/"), manifest or load_manifest()
    paths, report = generations.current(spark, marts_dir), generations.check_report(spark, marts_dir)
    if not paths:  # one plain folder a mart
        paths = {spec.relation: f"{marts_dir}/{spec.relation}" for spec in manifest}
        if files.exists(spark, f"{marts_dir}/_check_report"):
            report = spark.read.parquet(f"{marts_dir}/_check_report")
    if report is None or report.filter("failures > 0").limit(1).count():
        print("the marts were not checked, or a check failed: nothing published", file=sys.stderr)
        return 1
    marts = {spec.relation: spark.read.parquet(paths[spec.relation]) for spec in manifest}
    publish_exports(spark, marts, base, manifest).show(truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
