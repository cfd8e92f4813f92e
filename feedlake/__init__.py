"""feedlake - set-based ingest and analytics for landed market-data feeds on Spark.

Main entry points (imported lazily)::

    from feedlake import get_session, run_ingest, run_ingest_stream, scan_landing, inspect
"""

from __future__ import annotations

import importlib

__version__ = "0.1.0"

_EXPORTS = {
    "get_session": "feedlake.session",
    "run_ingest": "feedlake.plans.ingest_run",
    "run_ingest_stream": "feedlake.streaming.ingest",
    "scan_landing": "feedlake.sources.landing",
    "describe_files": "feedlake.sources.landing",
    "parse_documents": "feedlake.operators.feeds",
    "quarantine": "feedlake.operators.feeds",
    "run_report": "feedlake.operators.report",
    "write_table": "feedlake.sinks.tables",
    "merge_into_chart_table": "feedlake.sinks.tables",
    "inspect": "feedlake.plans.inspect_table",
}
__all__ = sorted(_EXPORTS)


def __getattr__(name: str):
    if name in _EXPORTS:
        return getattr(importlib.import_module(_EXPORTS[name]), name)
    raise AttributeError(f"module 'feedlake' has no attribute {name!r}")
