"""Children of a parent from a flat table, in order (a page already holds them as an array)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Places of one parent that are joined to text together.
CHUNK = 1024


def rendered_events(events: DataFrame, keys: list[str], place: str, run: str | None = None, together: bool = False) -> DataFrame:
    """``events_primary`` and ``events_cont`` per parent from rows with ``date, description, location``.

    ``place`` is a non-negative integer order; equal places are put in text
    order. A parent's rows are first joined to text per run, spread over tasks,
    so that a parent that holds most of the table costs its last task a few run
    texts instead of all its rows. A run is ``CHUNK`` places, or a value of the
    column ``run`` that orders like ``place``; where ``events`` is already
    partitioned by keys and run, this step moves nothing. What comes out per
    parent is one cell of text; that cell is the only thing built whole.

    With ``together``, ``events`` is partitioned by keys already: a parent's
    rows lie in one task whatever is done, so they are joined in one step.
    """
    from docketframe.functions.text import format_event

    line = format_event(F.struct("date", "description", "location"))
    part = F.floor(F.col(place) / CHUNK) if run is None else F.col(run)
    shown = events.select(*keys, part.alias("run"), F.col(place).alias("place"), line.alias("line"))
    shows = F.when(F.col("line") != "", F.struct("place", "line"))  # blank events are no events
    others = F.array_join(F.slice("lines.line", F.lit(2), F.size("lines")), "; ")
    if together:
        cells = shown.groupBy(*keys).agg(F.sort_array(F.collect_list(shows)).alias("lines")).where(F.size("lines") > 0)
        return cells.select(*keys, F.element_at("lines", 1)["line"].alias("events_primary"), others.alias("events_cont"))
    runs = (
        shown.groupBy(*keys, "run")
        .agg(F.sort_array(F.collect_list(shows)).alias("lines"))
        .where(F.size("lines") > 0)
        .select(
            *keys,
            "run",
            F.element_at("lines", 1)["line"].alias("head"),
            others.alias("tail"),
            F.size("lines").alias("n"),
        )
    )
    ordered = runs.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("run", "head", "tail", "n"))).alias("runs"))
    first = F.element_at("runs", 1)
    later = F.transform(
        F.slice("runs", F.lit(2), F.size("runs")),
        lambda run: F.when(run["n"] > 1, F.concat_ws("; ", run["head"], run["tail"])).otherwise(run["head"]),
    )
    own = F.when(first["n"] > 1, F.array(first["tail"])).otherwise(F.array().cast("array<string>"))
    return ordered.select(
        *keys, first["head"].alias("events_primary"), F.array_join(F.concat(own, later), "; ").alias("events_cont")
    )


def ordered_children(children: DataFrame, keys: list[str], place: str, child: Column, name: str) -> DataFrame:
    """One array of children per parent in ``place`` order, for parents whose children fit one record."""
    return (
        children.select(*keys, F.struct(F.col(place).alias("place"), child.alias("child")).alias("item"))
        .groupBy(*keys)
        .agg(F.sort_array(F.collect_list("item")).alias("items"))
        .select(*keys, F.col("items.child").alias(name))
    )
