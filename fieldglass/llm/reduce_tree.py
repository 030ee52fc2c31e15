"""States of tasks (a few matrices each) merged on the executors in rounds of bounded fan-in."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldglass.sources.scratch import materialize

#: States that one task merges.
FAN_IN = 16

State = dict[str, Any]


def packed(node: int, state: State) -> pa.RecordBatch:
    """One row ``(node, state)``; arrays keep their type."""
    import pickle

    return pa.RecordBatch.from_arrays([pa.array([node], pa.int64()), pa.array([pickle.dumps(state)], pa.binary())], names=["node", "state"])


def task_states(rows: DataFrame, state_of: Callable[[Iterator[pa.RecordBatch]], State | None]) -> DataFrame:
    """``(node, state)``: one row per task that has a state to give."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        state = state_of(batches)
        if state is not None:
            yield packed(TaskContext.get().partitionId(), state)

    return rows.mapInArrow(run, "node long, state binary")


def tree_merged(states: DataFrame, merge: Callable[[State, State], State], fan_in: int = FAN_IN) -> State | None:
    """The states merged to one, in the order of their nodes; None if there is none. Only the last one comes to the driver."""
    import pickle

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, last = None, None
        for batch in batches:
            for node, data in zip(batch.column("node").to_pylist(), batch.column("state")):
                state = pickle.loads(data.as_py())
                if node == last:
                    held = merge(held, state)
                else:
                    if held is not None:
                        yield packed(last, held)
                    held, last = state, node
        if held is not None:
            yield packed(last, held)

    level = materialize(states, "states")
    while (top := level.agg(F.max("node").alias("top")).first().top) is not None and top > 0:
        up = level.withColumns({"child": F.col("node"), "node": F.floor(F.col("node") / fan_in)})
        dealt = up.repartition(int(top // fan_in) + 1, "node").sortWithinPartitions("node", "child").select("node", "state")
        level = materialize(dealt.mapInArrow(run, "node long, state binary"), "states")
    last = level.first()
    return None if last is None else pickle.loads(last.state)
