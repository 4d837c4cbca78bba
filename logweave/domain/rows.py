"""From logs to rows for training: one per turn whose actions are clear, with its prompt."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweave.domain import conditions, protocol, series, texts


def turn_rows(logs: DataFrame, side: str = "p1", fix: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """game_id, turn, prompt, actions (both slots', in order): turns of which every action of the side is known.

    The prompt has the state when the turn begins, the conditions with their turns left, and the turn before; sections without content are left out.
    """
    snap, events = protocol.snapshots(logs, fix), protocol.events(logs, fix)
    clear = series.clear_turns(series.labels(snap, snap, events, side))
    state = texts.state_lines(snap).withColumnRenamed("text", "state")
    held = conditions.lines_of(conditions.timed(logs)).withColumnRenamed("text", "held")
    last = texts.history(events).select("game_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("last"))
    key = ["game_id", "turn"]
    j = clear.join(state, key).join(held, key, "left").join(last, key, "left")
    prompt = texts.prompt([F.col("state"), F.concat(F.lit("=== CONDITIONS ===\n"), "held"), F.concat(F.lit(texts.header("history") + "\n"), "last")])
    return j.select(*key, prompt.alias("prompt"), "actions")
