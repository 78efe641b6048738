"""Counters of running queries."""

from __future__ import annotations

from pyspark.sql.streaming import StreamingQueryListener


class Progress(StreamingQueryListener):
    """Rows and batches of all queries since it was added."""

    def __init__(self):
        self.rows, self.batches, self.ended = 0, 0, 0

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        self.rows += event.progress.numInputRows
        self.batches += 1

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        self.ended += 1
