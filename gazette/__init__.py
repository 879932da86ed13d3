"""gazette: turn landed pages, feeds and chunked JSON exports into one
publications table, as Spark DataFrame plans.

Layout
------
functions/  column expressions (text, URLs, dates) — all JVM-side except NFKC
sources/    scans: driver tables, HTML extraction, RSS, chunk database, files
operators/  validate-and-split, lookups, top-N, zip, runs/fetch logs, sinks
plans/      end-to-end flows and the registered queries with their oracles
streaming/  the same batch transform driven by a file stream (availableNow)
"""

from gazette.session import build_session, checkpoint_dir  # noqa: F401

__all__ = ["build_session", "checkpoint_dir"]
