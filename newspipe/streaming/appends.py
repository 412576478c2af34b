"""Steps of a stream as appends that happen exactly once, and a budget of rows over all of them.

A folder that a streaming file sink writes cannot take other appends, as its readers go by the
sink's own list of files. Here every step adds plain files to a plain folder, as a batch
append does, and readers need to know nothing. A step is written to a folder aside first; then
its files are renamed into place, under names that begin with the run and the step, and the
ledger notes the step. If all this stops anywhere, the step comes again: what is in place under
its name is taken away and written anew. A step that the ledger has is left alone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.messages import limit_messages
from ..sinks.csv import BATCH_RECORDS, csv_rows, write_options
from .ledger import Folder, Ledger
from .runs import ONCE

LEDGER = "_steps"  # names with an underscore are passed over by readers
ASIDE = "_aside"


class Appender:
    """Appends numbered steps to a folder of files, each exactly once."""

    def __init__(self, path: str, write: Callable[[DataFrame, str], None], run: str = "run") -> None:
        self.path, self.write, self.run = path.rstrip("/"), write, run

    def ledger(self, spark) -> Ledger:
        return Ledger(spark, f"{self.path}/{LEDGER}", self.run)

    def __call__(self, rows: DataFrame, step: int) -> int:
        """The rows of a step into place; gives how many there are."""
        spark = rows.sparkSession
        ledger = self.ledger(spark)
        if ledger.is_done(step):
            entry = ledger.entry(step)
            return entry.rows if entry else 0
        head = f"{self.run}-{step:018d}-"
        place = Folder(spark, self.path)
        for left in [n for n in place.names() if n.startswith(head)]:
            place.delete(left)
        aside = f"{self.path}/{ASIDE}/{head}files"
        counted, seen = _counted(rows)
        self.write(counted, aside)
        written = Folder(spark, aside)
        for name in [n for n in written.names() if not n.startswith(("_", "."))]:
            written.move(name, place, head + name)
        n = seen()
        self.publish(ledger, step, n)
        written.delete("")
        return n

    def publish(self, ledger: Ledger, step: int, rows: int) -> None:
        ledger.done(step, rows)


def _counted(rows: DataFrame) -> tuple[DataFrame, Callable[[], int]]:
    """The rows, and their number once they are written."""
    from ..operators.analyze import counted

    watched, observation = counted(rows, f"rows_{id(rows)}")
    return watched, lambda: observation.get["rows"]


def csv_writer(
    columns: list[str] | None = None, max_records_per_file: int | None = BATCH_RECORDS
) -> Callable[[DataFrame, str], None]:
    """Writes a step as CSV files of as many records at most."""

    def write(rows: DataFrame, path: str) -> None:
        cells = csv_rows(rows, columns)
        writer = cells.write.mode("overwrite").options(**write_options(cells))
        if max_records_per_file:
            writer = writer.option("maxRecordsPerFile", max_records_per_file)
        writer.csv(path)

    return write


def append_csv_stream(
    df: DataFrame,
    path: str,
    checkpoint: str,
    columns: list[str] | None = None,
    trigger: dict | None = None,
    max_records_per_file: int | None = BATCH_RECORDS,
    run: str = "run",
) -> StreamingQuery:
    """Append every step of a stream to a folder of CSV files that takes other appends too.

    The last incomplete batch of records is written like any other. Streams that share a folder
    need different ``run`` names; a stream with a new checkpoint needs a new one too.
    """
    append = Appender(path, csv_writer(columns, max_records_per_file), run)
    return _start(df, append, checkpoint, trigger)


def append_table_stream(
    df: DataFrame, path: str, checkpoint: str, trigger: dict | None = None, run: str = "run"
) -> StreamingQuery:
    """The same with Parquet files, as a table that batch jobs append to as well."""
    append = Appender(path, lambda rows, to: rows.write.mode("overwrite").parquet(to), run)
    return _start(df, append, checkpoint, trigger)


def _start(
    df: DataFrame, step: Callable[[DataFrame, int], object], checkpoint: str, trigger: dict | None
) -> StreamingQuery:
    def run(rows: DataFrame, number: int) -> None:
        step(rows, number)

    writer = df.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or ONCE)).start()


class Budget:
    """Passes the first ``count`` rows of a stream on, over all its steps and restarts.

    What is spent is kept in the ledger. A step that comes again passes on the same rows,
    provided that ``order`` tells rows of a step apart. Streams with checkpoints of their own
    share a budget if they share the ledger and run one after the other; each is a ``run``.
    """

    def __init__(
        self,
        path: str,
        count: int,
        append: Callable[[DataFrame, int], int],
        order: tuple[str, ...] = (),
        run: str = "run",
    ) -> None:
        if count < 0:
            raise ValueError("a budget must not be negative")
        self.path, self.count, self.append, self.order, self.run = path, count, append, order, run

    def spent(self, spark) -> int:
        """Rows passed on so far, by all runs."""
        folder = Folder(spark, self.path)
        runs = {n.rsplit("-", 1)[0] for n in folder.names() if n.endswith(".json")}
        entries = [Ledger(spark, self.path, run).latest() for run in runs]
        return sum(e.total for e in entries if e)

    def __call__(self, rows: DataFrame, step: int) -> int:
        spark = rows.sparkSession
        ledger = Ledger(spark, self.path, self.run)
        if ledger.is_done(step):
            return 0
        left = self.count - self.spent(spark)
        if self.count and left <= 0:
            ledger.done(step, 0)
            return 0
        n = self.append(limit_messages(rows, left if self.count else None, self.order), step)
        ledger.done(step, n)
        return n


def budgeted_stream(
    df: DataFrame, budget: Budget, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """A stream that passes rows on until the budget is spent, and none after that."""
    return _start(df, budget, checkpoint, trigger)


def finish_budget(query: StreamingQuery, budget: Budget, spark, every_seconds: float = 1) -> int:
    """Wait until the budget is spent or the stream ends; stopped in any case. Gives what is spent."""
    try:
        while not query.awaitTermination(timeout=every_seconds):
            if budget.count and budget.spent(spark) >= budget.count:
                break
        return budget.spent(spark)
    finally:
        query.stop()
