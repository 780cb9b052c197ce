"""Release of groups once they are complete, in batch and as a stream."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F


def sized_groups(rows: DataFrame, key: str, item: str, size: int) -> DataFrame:
    """Groups that have `size` items or more: their first `size`, in order."""
    return groups_and_rest(rows, key, item, size).where("complete").drop("complete")


def groups_and_rest(rows: DataFrame, key: str, item: str, size: int) -> DataFrame:
    """All groups, their first `size` items in order, and whether they are complete; the last flush of what waited for more.

    Tasks keep `size` rows a group before anything is shuffled, so a group of any size is small when it is put together.
    """
    rank = F.row_number().over(Window.partitionBy(key).orderBy(F.col(item).asc_nulls_last()))
    got = rows.select(key, item).withColumn("_rank", rank).where(F.col("_rank") <= size).groupBy(key).agg(F.sort_array(F.collect_list(item)).alias("items"))
    return got.select(key, F.array_join("items", ",").alias("items"), (F.size("items") >= size).alias("complete"))


def complete_groups(rows: DataFrame, key: str, item: str, size: int) -> DataFrame:
    """`sized_groups`; an error if a group isn't complete, as one that isn't must not go on."""
    short = rows.groupBy(key).agg(F.count("*").alias("n")).where(F.col("n") < size).orderBy(key).limit(3).collect()
    if short:
        raise ValueError("incomplete groups: " + ", ".join(f"{r[key]} ({r['n']} of {size})" for r in short))
    return sized_groups(rows, key, item, size)


def counted(rows: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """rows, and what counts them as they pass (`rows` in its `get`), with no pass of its own."""
    seen = Observation(name)
    return rows.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def conserved(seen: Observation, expected: int) -> None:
    """An error unless as many rows have passed as a manifest promised."""
    if (n := seen.get["rows"]) != expected:
        raise ValueError(f"{n} rows passed, {expected} were expected")


def stream_sized_groups(rows: DataFrame, key: str, item: str, size: int) -> DataFrame:
    """The same over a stream: a group leaves, in arrival order, with its size-th item; later items are dropped."""

    def step(k: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        held, done = state.get if state.exists else ([], False)
        held = list(held)
        for f in frames:
            held += [] if done else f[item].astype(str).tolist()
        if not done and len(held) >= size:
            yield pd.DataFrame({key: [k[0]], "items": [",".join(held[:size])]})
            held, done = [], True
        state.update((held, done))

    return rows.groupBy(key).applyInPandasWithState(step, f"{key} long, items string", "held array<string>, done boolean", "append", "NoTimeout")
