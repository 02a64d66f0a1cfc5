"""States that tasks keep while they read their rows, and their merging in rounds of small groups."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waitspark.workspace import discard, materialize

# States that one task merges.
FAN = 32
STATE = "part long, state binary"
STATE_ARROW = pa.schema([("part", pa.int64()), ("state", pa.binary())])


def task_states(df: DataFrame, take: Callable[[object | None, pa.RecordBatch], object]) -> DataFrame:
    """(part, state): what ``take`` makes of a task's batches, one after the other, from None."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        state = None
        for batch in batches:
            state = take(state, batch)
        if state is not None:
            row = {"part": TaskContext.get().partitionId(), "state": pickle.dumps(state)}
            yield pa.RecordBatch.from_pylist([row], STATE_ARROW)

    return df.mapInArrow(run, STATE)


def fold_states(states: DataFrame, merge: Callable[[object, object], object]):
    """All states merged in the order of their parts; None if there is none.

    A task merges up to ``FAN`` states and each round is written, so the driver gets one state at last.
    """

    def step(group: pa.Table) -> pa.Table:
        rows = sorted(group.to_pylist(), key=lambda r: r["part"])
        total = pickle.loads(rows[0]["state"])
        for row in rows[1:]:
            total = merge(total, pickle.loads(row["state"]))
        return pa.table({"part": [rows[0]["part"] // FAN], "state": [pickle.dumps(total)]}, STATE_ARROW)

    states = materialize(states, "states")
    last = states.agg(F.max("part")).first()[0]
    while last:
        above = states.groupBy(F.floor(F.col("part") / FAN).alias("_group")).applyInArrow(step, STATE)
        above = materialize(above, "states")
        discard(states)
        states, last = above, last // FAN
    row = states.first()
    discard(states)
    return None if row is None else pickle.loads(row["state"])


def numbers(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """(values, presence) of a batch of double columns as matrices; null and NaN are absent, as 0."""
    columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
    values = np.column_stack(columns).astype(float) if columns else np.zeros((batch.num_rows, 0))
    present = ~np.isnan(values)
    return np.where(present, values, 0.0), present
