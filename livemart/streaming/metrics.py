"""SNK11: per-batch counts and progress of streaming queries.

Counts are attached to the streaming plan with ``DataFrame.observe`` (no
extra job per batch, unlike ``count()`` on the batch) and read from each
query's progress, either by polling ``lastProgress`` or through a
``StreamingQueryListener`` registered on the session.
"""

from __future__ import annotations

import json

from pyspark.sql.streaming import StreamingQueryListener


def batch_summary(progress) -> dict:
    """Input rows, observed counts and rows dropped behind the watermark of one batch."""
    if progress is None:
        return {}
    raw = getattr(progress, "json", None)
    if raw is not None:  # a StreamingQueryProgress: its JSON form has plain dicts throughout
        p = json.loads(raw() if callable(raw) else raw)
    else:
        p = dict(progress)
    state = p.get("stateOperators") or []
    return {
        "batch_id": p.get("batchId"),
        "input_rows": p.get("numInputRows"),
        "observed": {k: v for k, v in (p.get("observedMetrics") or {}).items()},
        "dropped_by_watermark": sum(int(s.get("numRowsDroppedByWatermark", 0) or 0) for s in state),
        "state_rows": sum(int(s.get("numRowsTotal", 0) or 0) for s in state),
    }


class ProgressLog(StreamingQueryListener):
    """Keeps the summaries of the most recent batches of every query (bounded)."""

    def __init__(self, keep: int = 100):
        self.keep = keep
        self.batches: list[dict] = []

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        summary = batch_summary(event.progress)
        summary["name"] = event.progress.name
        self.batches = (self.batches + [summary])[-self.keep:]

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass


def attach(spark) -> ProgressLog:
    """Register a ``ProgressLog`` on the session and return it."""
    log = ProgressLog()
    spark.streams.addListener(log)
    return log
