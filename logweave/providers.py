"""Interfaces for what lies outside: effect functions, text generators, judges; with deterministic stand-ins."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class Generator(Protocol):
    """Answers prompts: one answer for each."""

    name: str

    def answer(self, prompts: list[str]) -> list[str]: ...


class Judge(Protocol):
    """Flags items of a group by position."""

    def flagged(self, texts: list[str]) -> list[int]: ...


class Echo:
    """A stand-in generator: the prompt's last line, marked as a dry run."""

    name = "echo"

    def answer(self, prompts: list[str]) -> list[str]:
        return [f"[DRY RUN] {(p or '').splitlines()[-1] if (p or '').strip() else ''}" for p in prompts]


class Flag:
    """A stand-in judge: flags texts that contain a word."""

    def __init__(self, word: str) -> None:
        self.word = word

    def flagged(self, texts: list[str]) -> list[int]:
        return [k for k, t in enumerate(texts) if self.word in (t or "")]


def answered(rows: DataFrame, prompt: str, generators: list[Generator]) -> DataFrame:
    """Every row with every generator, in Arrow batches: provider and answer; a batch that fails has a null answer and its error."""
    names = {g.name: g for g in generators}
    many = rows.withColumn("provider", F.explode(F.array(*[F.lit(n) for n in names])))
    schema = many.withColumn("answer", F.lit("")).withColumn("error", F.lit("")).schema

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for name, part in pdf.groupby("provider", sort=True):
                try:
                    yield part.assign(answer=names[name].answer(part[prompt].tolist()), error=None)
                except Exception as e:  # noqa: BLE001  (an outside service)
                    yield part.assign(answer=None, error=f"{type(e).__name__}: {e}")

    for f in schema.fields:
        f.nullable = True
    return many.mapInPandas(run, schema)


def retried(rows: DataFrame, ask: Callable[[DataFrame], DataFrame], bad: F.Column, most: int, keep: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """Asks again, at most ``most`` times, for rows whose answer is bad; column clean says how it ended."""
    done, left = None, rows
    columns = rows.columns
    for k in range(most + 1):
        got = keep(ask(left).withColumn("clean", ~F.coalesce(bad, F.lit(False))), f"retry-{k}")
        ok = got.where("clean") if k < most else got
        done = ok if done is None else done.unionByName(ok)
        left = got.where("NOT clean").select(*columns)
        if k < most and left.isEmpty():
            break
    return done


def unflagged(rows: DataFrame, group: str, pos: str, text: str, judge: Judge) -> DataFrame:
    """``rows`` without those that the judge flags; positions out of range and repeated ones are ignored, a judge that fails flags nothing.

    A group's texts go to the judge together, so groups are to be bounded (the turns of a match).
    """
    key = rows.schema[group].dataType.simpleString()

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(pos)
        try:
            bad = {k for k in judge.flagged(pdf[text].tolist()) if 0 <= k < len(pdf)}
        except Exception:  # noqa: BLE001  (fail open)
            bad = set()
        keep = [k in bad for k in range(len(pdf))]
        return pdf.loc[keep, [group, pos]]

    verdicts = rows.select(group, pos, text).groupBy(group).applyInPandas(run, f"{group} {key}, {pos} {rows.schema[pos].dataType.simpleString()}")
    return rows.join(verdicts, [group, pos], "left_anti")
