"""Keeping costly expressions from running more than once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed_once(df: DataFrame, *columns: Column) -> DataFrame:
    """A projection that later filters cannot be pushed through.

    The optimizer would otherwise repeat the extraction inside the filter on its
    result and run every expression twice per row.
    """
    return df.select(F.inline(F.array(F.struct(*columns))))


def folded(items: Column, start: Column, step, out: str = "string") -> Column:
    """What ``step(state, item) -> (state, found)`` finds for each item of a list, in order.

    Nothing is found where ``found`` is null. A fold copies its state at every step, so one
    that gathers a list takes time with the square of its length. Here the items are cut
    into runs of about the square root of their number, and what a run finds is gathered
    before it joins the rest.
    """
    nothing = F.array().cast(f"array<{out}>")

    def within(state: Column, item: Column) -> Column:
        def keep(pair: Column) -> Column:
            found = F.when(pair["found"].isNotNull(), F.array(pair["found"])).otherwise(nothing)
            return F.struct(
                pair["state"].alias("state"), F.concat(state["found"], found).alias("found")
            )

        new, found = step(state["state"], item)
        return let(F.struct(new.alias("state"), found.alias("found")), keep)

    def across(state: Column, run: Column) -> Column:
        begun = F.struct(state["state"].alias("state"), nothing.alias("found"))
        return let(
            F.aggregate(run, begun, within),
            lambda done: F.struct(
                done["state"].alias("state"),
                F.concat(state["found"], done["found"]).alias("found"),
            ),
        )

    def all_runs(listed: Column) -> Column:
        size = F.greatest(F.lit(16), F.ceil(F.sqrt(F.size(listed))).cast("int"))
        runs = F.transform(
            F.sequence(F.lit(1), F.greatest(F.size(listed), F.lit(1)), size),
            lambda at: F.slice(listed, at, size),
        )
        begun = F.struct(start.alias("state"), nothing.alias("found"))
        return F.aggregate(runs, begun, across, lambda s: s["found"])

    return let(items, all_runs)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once however often body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)
