"""Totals over all micro-batches of a streaming query.

A query keeps only its last reports, and its last report is often a batch
without data.  A listener sees every report; it keeps sums, not reports, so
long runs cost nothing.
"""

from __future__ import annotations

import threading
import time

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener


class Totals(StreamingQueryListener):
    """Per run of a query: batches, input rows, rows dropped by watermarks, observed counts."""

    def __init__(self):
        self._runs: dict[str, dict] = {}
        self._lock = threading.Lock()

    def _run(self, run_id) -> dict:
        return self._runs.setdefault(str(run_id), {"batches": 0, "rows": 0, "dropped": 0, "observed": {}, "ended": False})

    def onQueryStarted(self, event) -> None:
        with self._lock:
            self._run(event.runId)

    def onQueryProgress(self, event) -> None:
        p = event.progress
        with self._lock:
            run = self._run(p.runId)
            run["batches"] += 1
            run["rows"] += p.numInputRows
            run["dropped"] += sum(s.numRowsDroppedByWatermark for s in p.stateOperators)
            for name, row in (p.observedMetrics or {}).items():
                seen = run["observed"].setdefault(name, {})
                for k, v in row.asDict().items():
                    seen[k] = seen.get(k, 0) + (v or 0)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._lock:
            self._run(event.runId)["ended"] = True

    def knows(self, query: StreamingQuery) -> bool:
        with self._lock:
            return str(query.runId) in self._runs

    def of(self, query: StreamingQuery, wait: float = 30.0) -> dict:
        """Totals of a query's run; of an ended run, all of them (reports arrive a little later)."""
        until = time.time() + wait
        while not query.isActive and time.time() < until:
            with self._lock:
                if self._run(query.runId)["ended"]:
                    break
            time.sleep(0.02)
        with self._lock:
            run = self._run(query.runId)
            return {**run, "observed": {k: dict(v) for k, v in run["observed"].items()}}


_TOTALS: dict = {}


def run_totals(query: StreamingQuery) -> dict:
    """Totals of a query of any session with a listener (all batches of its run)."""
    for listener, _ in _TOTALS.values():
        if listener.knows(query):
            return listener.of(query, wait=0 if query.isActive else 30)
    return {"batches": 0, "rows": 0, "dropped": 0, "observed": {}, "ended": False}


def totals(spark: SparkSession) -> Totals:
    """The session's listener (added once)."""
    key = (spark.sparkContext.applicationId, id(spark))
    if key not in _TOTALS:
        _TOTALS[key] = (Totals(), spark)        # the session is kept: its id stays its own
        spark.streams.addListener(_TOTALS[key][0])
    return _TOTALS[key][0]
