"""Exactly-once appends, budgets and progress, over failures and restarts."""

import pytest

from newspipe import read_csv
from newspipe.schemas import text_fields
from newspipe.streaming.appends import (
    Appender,
    Budget,
    append_csv_stream,
    append_table_stream,
    budgeted_stream,
    csv_writer,
    finish_budget,
)
from newspipe.streaming.ledger import Ledger
from newspipe.streaming.progress import Progress
from newspipe.streaming.runs import finish, stream_parquet


def landed(spark, path, *parts):
    """A folder with one file for each range of numbers."""
    for begin, end in parts:
        spark.range(begin, end, 1, 1).selectExpr("id", "concat('n', id) as text").write.mode("append").parquet(path)


def stream(spark, path):
    reader = spark.readStream.schema("id long, text string").option("maxFilesPerTrigger", 1)
    return reader.parquet(path)


def ids(spark, path):
    return sorted(int(r.id) for r in read_csv(spark, path, text_fields("id", "text")).collect())


def test_stream_and_batch_append_to_one_folder(spark, tmp_path):
    source, path = f"{tmp_path}/in", f"{tmp_path}/out"
    landed(spark, source, (0, 250), (250, 300), (300, 301))
    finish(append_csv_stream(stream(spark, source), path, f"{tmp_path}/steps"))
    # 100 records a file: 3 + 1 + 1 files, the last incomplete one of each step included.
    files = [p for p in (tmp_path / "out").iterdir() if p.suffix == ".csv"]
    assert len(files) == 5
    spark.range(1000, 1003).selectExpr("id", "'b' as text").coalesce(1).write.mode("append").options(
        header="true"
    ).csv(path)
    landed(spark, source, (301, 400))
    finish(append_csv_stream(stream(spark, source), path, f"{tmp_path}/steps"))
    assert ids(spark, path) == [*range(400), 1000, 1001, 1002]


@pytest.mark.parametrize("stop", ["write", "move", "publish"])
def test_a_stop_neither_loses_nor_repeats(spark, tmp_path, stop):
    """The step is stopped while files are written, moved, or before the ledger has it."""
    source, path, checkpoint = f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/steps"
    landed(spark, source, (0, 30), (30, 60), (60, 90))
    writer = csv_writer(max_records_per_file=10)

    class Stopping(Appender):
        fails = True

        def publish(self, ledger, step, rows):
            if stop == "publish" and step == 1 and Stopping.fails:
                raise RuntimeError("stopped")
            super().publish(ledger, step, rows)

    def write(rows, to):
        writer(rows, to)
        if stop == "write" and "-000000000000000001-" in to and Stopping.fails:
            raise RuntimeError("stopped")

    appender = Stopping(path, write)

    def step(rows, number):
        appender(rows, number)

    def run():
        started = stream(spark, source).writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
        return started.trigger(availableNow=True).start()

    if stop == "move":
        from newspipe.streaming import ledger

        original, moves = ledger.Folder.move, []

        def move(self, name, other, to):
            if "00001-" in to and to.endswith(".csv") and Stopping.fails:
                moves.append(to)
                if len(moves) == 2:
                    raise RuntimeError("stopped")
            original(self, name, other, to)

        ledger.Folder.move = move
    try:
        with pytest.raises(Exception, match="stopped"):
            finish(run())
        assert ids(spark, path) != list(range(90))
        Stopping.fails = False
        finish(run())
        assert ids(spark, path) == list(range(90))
        finish(run())
        assert ids(spark, path) == list(range(90))
    finally:
        if stop == "move":
            ledger.Folder.move = original


def test_a_step_that_comes_again_is_left_alone(spark, tmp_path):
    append = Appender(f"{tmp_path}/out", csv_writer())
    rows = spark.range(5).selectExpr("id", "'a' as text")
    assert append(rows, 0) == append(rows, 0) == 5
    assert append(rows, 1) == 5
    assert Appender(f"{tmp_path}/out", csv_writer(), "other")(rows, 0) == 5
    assert len(ids(spark, f"{tmp_path}/out")) == 15


def test_tables_take_streams_and_batches(spark, tmp_path):
    source, path = f"{tmp_path}/in", f"{tmp_path}/out"
    landed(spark, source, (0, 20), (20, 30))
    finish(append_table_stream(stream(spark, source), path, f"{tmp_path}/steps"))
    spark.range(30, 40).selectExpr("id", "'b' as text").write.mode("append").parquet(path)
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == list(range(40))


def test_ledger(spark, tmp_path):
    ledger = Ledger(spark, f"{tmp_path}/ledger")
    assert ledger.latest() is None and ledger.total_before(3) == 0 and not ledger.is_done(0)
    for step in range(30):
        ledger.done(step, step)
    again = Ledger(spark, f"{tmp_path}/ledger")
    assert again.latest().total == sum(range(30)) and again.total_before(29) == sum(range(29))
    assert again.is_done(4) and again.is_done(29) and not again.is_done(30)
    assert len(list((tmp_path / "ledger").glob("*.json"))) <= 9
    with pytest.raises(ValueError):
        Ledger(spark, f"{tmp_path}/ledger", "a/b")


def budget(spark, tmp_path, count, run="run"):
    append = Appender(f"{tmp_path}/out", csv_writer(), run)
    return Budget(f"{tmp_path}/budget", count, append, ("id",), run)


@pytest.mark.parametrize("count", [1, 25, 60, 75, 90, 500])
def test_a_budget_over_steps_and_restarts(spark, tmp_path, count):
    """Exactly so many messages, the first ones of each step, whatever is restarted."""
    source = f"{tmp_path}/in"
    landed(spark, source, (0, 30), (30, 60))
    spent = budget(spark, tmp_path, count)
    finish(budgeted_stream(stream(spark, source), spent, f"{tmp_path}/steps"))
    landed(spark, source, (60, 90))
    query = budgeted_stream(stream(spark, source), budget(spark, tmp_path, count), f"{tmp_path}/steps")
    assert finish_budget(query, spent, spark) == min(count, 90)
    assert ids(spark, f"{tmp_path}/out") == list(range(min(count, 90)))
    # A new query with a checkpoint of its own finds the same budget.
    again = budget(spark, tmp_path, count, "second")
    landed(spark, f"{tmp_path}/more", (90, 100))
    finish(budgeted_stream(stream(spark, f"{tmp_path}/more"), again, f"{tmp_path}/second"))
    assert ids(spark, f"{tmp_path}/out") == list(range(min(count, 100)))


def test_a_budget_that_stops_before_it_is_noted(spark, tmp_path):
    rows = spark.range(10).selectExpr("id", "'a' as text")
    first = budget(spark, tmp_path, 15)
    assert first(rows, 0) == 10
    # The append is done, the note of it is lost; the step comes again.
    lost = tmp_path / "budget" / f"run-{0:018d}.json"
    lost.unlink()
    assert first(rows, 0) == 10 and first(rows, 0) == 0
    assert first(spark.range(10, 20).selectExpr("id", "'a' as text"), 1) == 5
    assert first.spent(spark) == 15 and ids(spark, f"{tmp_path}/out") == list(range(15))


def test_no_budget_passes_all(spark, tmp_path):
    rows = spark.range(10).selectExpr("id", "'a' as text")
    assert budget(spark, tmp_path, 0)(rows, 0) == 10
    with pytest.raises(ValueError):
        budget(spark, tmp_path, -1)


def test_progress_beyond_the_reports_kept(spark, tmp_path):
    """More steps than a query remembers, a restart, and a listener that starts later."""
    source = f"{tmp_path}/in"
    landed(spark, source, *((10 * i, 10 * i + 10) for i in range(12)))
    kept = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates", None)
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "3")
    progress = Progress(spark, f"{tmp_path}/progress")
    try:
        query = stream_parquet(stream(spark, source), f"{tmp_path}/out", f"{tmp_path}/steps")
        totals = progress.wait(query)
        assert (totals.rows, totals.steps) == (120, 12) and len(query.recentProgress) <= 3
        landed(spark, source, (120, 130), (130, 140))
        query = stream_parquet(stream(spark, source), f"{tmp_path}/out", f"{tmp_path}/steps")
        assert progress.wait(query).rows == 140
    finally:
        progress.close()
        if kept:
            spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", kept)
        else:
            spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    later = Progress(spark, f"{tmp_path}/progress")
    try:
        landed(spark, source, (140, 145))
        query = stream_parquet(stream(spark, source), f"{tmp_path}/out", f"{tmp_path}/steps")
        totals = later.wait(query)
        assert (totals.rows, totals.steps) == (145, 15)
    finally:
        later.close()


def test_progress_tells_of_errors(spark, tmp_path):
    landed(spark, f"{tmp_path}/in", (0, 3))
    progress = Progress(spark)
    try:
        bad = stream(spark, f"{tmp_path}/in").selectExpr("raise_error('broken') as x", "id")
        query = bad.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/steps")
        query = query.trigger(availableNow=True).start(f"{tmp_path}/out")
        with pytest.raises(Exception, match="broken"):
            progress.wait(query)
        with progress.news:
            progress.news.wait_for(lambda: progress.queries[str(query.id)].running == 0, 30)
        assert "broken" in progress.queries[str(query.id)].error
    finally:
        progress.close()


def test_publishing_within_a_budget(spark, tmp_path):
    """The first items in arrival order, as messages, over two files of a stream."""
    from newspipe.plans import flows

    items = "fetch_seq long, pos int, title string, description string"
    for seq in (0, 1):
        rows = [(seq, i, f"t{seq}{i}", "d") for i in range(5)]
        spark.createDataFrame(rows, items).coalesce(1).write.mode("append").parquet(f"{tmp_path}/items")
    found = spark.readStream.schema(items).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/items")
    finish(flows.publish_budgeted(found, f"{tmp_path}/topic", f"{tmp_path}/budget", 7, f"{tmp_path}/steps"))
    sent = spark.read.parquet(f"{tmp_path}/topic").selectExpr("get_json_object(cast(value as string), '$.title') as t")
    got = {r.t for r in sent.collect()}
    # Whichever file comes first is whole, and of the other one the first two items go.
    assert got in ({f"t0{i}" for i in range(5)} | {"t10", "t11"}, {f"t1{i}" for i in range(5)} | {"t00", "t01"})
    assert sent.count() == 7


def test_records_and_rejects_from_one_parse(spark, tmp_path):
    from newspipe.plans import flows
    from newspipe.schemas import NEWS_MESSAGE
    from newspipe.streaming.runs import read_judged

    values = [b'{"title": "a", "category": ["x"]}', b"0 cats", b'{"title": "b"}', b"{", None]
    spark.createDataFrame([(v,) for v in values], "value binary").write.parquet(f"{tmp_path}/topic")
    wire = flows.read_topic(spark, f"{tmp_path}/topic")
    query = flows.consume_judged(wire, NEWS_MESSAGE, f"{tmp_path}/out", f"{tmp_path}/steps")
    finish(query)
    good = read_judged(spark, f"{tmp_path}/out", "readable", True).collect()
    bad = read_judged(spark, f"{tmp_path}/out", "readable", False).collect()
    assert sorted((r.title, r.category, r.value) for r in good) == [("a", ["x"], None), ("b", None, None)]
    assert sorted((bytes(r.value) if r.value else b"") for r in bad) == [b"", b"0 cats", b"{"]
