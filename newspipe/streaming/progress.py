"""Progress of streaming queries as Spark reports it, step by step.

A listener hears of every step, however many there are, while a query itself remembers its
last reports only. Totals are kept by query and step: a step that is run again after a
restart replaces its first report, and counts once.
"""

from __future__ import annotations

import threading
from dataclasses import dataclass, field

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from .ledger import Ledger


@dataclass
class Totals:
    """What is known of one query: rows read by step, and how it stands."""

    name: str | None = None
    by_step: dict[int, int] = field(default_factory=dict)
    earlier: int = 0  # rows of steps below ``first``
    first: int = 0
    running: int = 0  # runs that have started and not ended
    error: str | None = None

    @property
    def rows(self) -> int:
        return self.earlier + sum(self.by_step.values())

    @property
    def steps(self) -> int:
        return self.first + len(self.by_step)


class Progress(StreamingQueryListener):
    """Adds up what the queries of a session read; start it before them.

    Reports come in on a thread of their own, some time after a step. ``wait`` returns once
    the query has ended and its last report is in. With a ``folder``, steps are noted there,
    and a listener started later, after a restart of the driver too, goes on from them.
    Only the latest steps of a query are held one by one.
    """

    HELD = 1024

    def __init__(self, spark: SparkSession, folder: str | None = None) -> None:
        self.spark, self.folder = spark, folder
        self.queries: dict[str, Totals] = {}
        self.news = threading.Condition()
        spark.streams.addListener(self)

    def close(self) -> None:
        self.spark.streams.removeListener(self)

    def _ledger(self, query: str) -> Ledger | None:
        return Ledger(self.spark, self.folder, query.replace("-", "_")) if self.folder else None

    def _of(self, query: str) -> Totals:
        if query not in self.queries:
            found = self.queries[query] = Totals()
            ledger = self._ledger(query)
            last = ledger.latest() if ledger else None
            if last:
                # The last step may come again, so it is held apart from those before.
                found.earlier, found.first = last.total - last.rows, last.step
                found.by_step[last.step] = last.rows
        return self.queries[query]

    def onQueryStarted(self, event) -> None:
        with self.news:
            totals = self._of(str(event.id))
            totals.name, totals.error = event.name, None
            totals.running += 1
            self.news.notify_all()

    def onQueryProgress(self, event) -> None:
        report = event.progress
        with self.news:
            totals = self._of(str(report.id))
            step, rows = report.batchId, report.numInputRows
            if step < totals.first:
                return
            # A step without new data is reported again under its number, with no rows.
            rows = max(rows, totals.by_step.get(step, 0))
            new = step not in totals.by_step
            totals.by_step[step] = rows
            ledger = self._ledger(str(report.id))
            if ledger and new:
                ledger.done(step, rows)
            while len(totals.by_step) > self.HELD:
                totals.earlier += totals.by_step.pop(totals.first)
                totals.first += 1
            self.news.notify_all()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self.news:
            totals = self._of(str(event.id))
            totals.running -= 1
            totals.error = event.exception
            self.news.notify_all()

    def rows(self, query: StreamingQuery) -> int:
        """Rows the query has read, as far as reports are in."""
        with self.news:
            return self._of(str(query.id)).rows

    def wait(self, query: StreamingQuery, seconds: float = 60) -> Totals:
        """The totals once the query has ended; its steps are numbered without gaps."""
        query.awaitTermination()
        with self.news:
            totals = self._of(str(query.id))
            ended = self.news.wait_for(lambda: totals.running <= 0, seconds)
            if not ended:
                raise TimeoutError("the end of the query was not reported in time")
            missing = set(range(totals.first, max(totals.by_step, default=-1) + 1)) - set(totals.by_step)
            if missing:
                raise RuntimeError(f"no report came of {len(missing)} steps")
            return totals
