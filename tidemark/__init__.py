"""tidemark — hourly market-data ETL expressed as Spark DataFrame operators.

Layers:
  functions/  column expressions (time parsing/flooring, nested access)
  sources/    landed JSON payloads -> typed rows (+ quarantine)
  operators/  harmonise, keyed merges, audits
  plans/      table store (create / merge / windowed read) and the ingest run
  streaming/  the same ingest as a Structured Streaming job
"""

__version__ = "0.1.0"

_API = {
    "build_session": "tidemark.session", "TableStore": "tidemark.plans.store",
    "run_ingest": "tidemark.plans.ingest", "run_all": "tidemark.plans.ingest",
    "ingest_frame": "tidemark.plans.ingest", "report_frame": "tidemark.plans.ingest",
    "start_ingest_stream": "tidemark.streaming.stream",
}


def __getattr__(name):
    """Lazy top-level access to the main API (``from tidemark import TableStore``)."""
    if name in _API:
        import importlib
        return getattr(importlib.import_module(_API[name]), name)
    raise AttributeError(name)
