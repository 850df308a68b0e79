"""zipledger: manifest-driven bulk export and retention as Spark jobs.

Layout:
  functions/  column expressions (parse, format, predicates) - all JVM-side
  operators/  DataFrame -> DataFrame transformations (ledger, packing, retention)
  sources/    readers (ledger, content fetch/lookup, file inventory, table adapters)
  sinks/      writers (archives, ledger snapshots, audit log)
  streaming/  Structured Streaming variants (manifest stream, commit, stateful pack)
  plans/      composite jobs and the registered query catalog
"""

__version__ = "0.1.0"


def _ship_by_value() -> None:
    """Pickle this package's functions by value, so Python tasks on executors do
    not need the package installed (mapInPandas helpers reference it)."""
    import sys

    try:
        from pyspark import cloudpickle
        cloudpickle.register_pickle_by_value(sys.modules[__name__])
    except Exception:  # noqa: BLE001 - older cloudpickle: ship with --py-files instead
        pass


_ship_by_value()
