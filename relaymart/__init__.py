"""relaymart: engagement marts (e-mail, forms, jobs) as Spark DataFrame jobs.

Public entry points (imported lazily, so ``import relaymart`` stays light):

* ``build`` / ``build_all``     - the whole build (marts, contracts, checks, publish)
* ``ModelGraph``                - any single model as a lazy DataFrame
* ``load_sources``              - provider sources derived from the driver tables
* ``SourceTables``              - provider sources read from real tables
* ``run_suite``                 - the declared data checks over any models
* ``rebuild_trailing_window``   - trailing-window incremental rebuild
* ``local_session``             - a local session for tests and the bench
"""

__version__ = "0.1.0"

_EXPORTS = {
    "build": "relaymart.plans.build",
    "build_all": "relaymart.plans.build",
    "ModelGraph": "relaymart.plans.graph",
    "load_sources": "relaymart.sources.fixtures",
    "SourceTables": "relaymart.sources.tables",
    "run_suite": "relaymart.quality.checks",
    "rebuild_trailing_window": "relaymart.streaming.incremental",
    "local_session": "relaymart.session",
}

__all__ = list(_EXPORTS)


def __getattr__(name):
    if name in _EXPORTS:
        import importlib
        return getattr(importlib.import_module(_EXPORTS[name]), name)
    raise AttributeError(f"module 'relaymart' has no attribute {name!r}")
