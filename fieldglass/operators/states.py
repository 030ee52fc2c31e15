"""States of tasks (a few matrices each) merged on the executors in rounds of bounded fan-in.

The functions are pickled by value: workers need no package for them.
"""

from __future__ import annotations

import pickle
import sys
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import materialize

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: States that one task merges.
FAN_IN = 16
SCHEMA = "key string, node long, state binary"

State = Any


def packed(states: dict[str, State], node: int) -> pa.RecordBatch:
    """Rows ``(key, node, state)``."""
    data = [pickle.dumps(s) for s in states.values()]
    return pa.RecordBatch.from_arrays([pa.array(states, pa.string()), pa.array([node] * len(data), pa.int64()), pa.array(data, pa.binary())], names=["key", "node", "state"])


def task_states(rows: DataFrame, states_of: Callable[[Iterator[pa.RecordBatch]], dict[str, State]]) -> DataFrame:
    """``(key, node, state)``: what each task makes of its rows, by key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states = states_of(batches)
        if states:
            yield packed(states, TaskContext.get().partitionId())

    return rows.mapInArrow(run, SCHEMA)


def tree_merged(states: DataFrame, merge: Callable[[State, State], State], fan_in: int = FAN_IN) -> dict[str, State]:
    """The states of each key merged to one, in the order of their nodes; a few may have the same one. Only the last come to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, last = None, None
        for batch in batches:
            for key, node, data in zip(batch.column("key").to_pylist(), batch.column("node").to_pylist(), batch.column("state")):
                state = pickle.loads(data.as_py())
                if (key, node) == last:
                    held = merge(held, state)
                else:
                    if last is not None:
                        yield packed({last[0]: held}, last[1])
                    held, last = state, (key, node)
        if last is not None:
            yield packed({last[0]: held}, last[1])

    level = materialize(states, "states")
    while True:
        size = level.agg(F.max("node").alias("top"), F.count_distinct("key").alias("keys"), F.count(F.lit(1)).alias("rows")).first()
        if size["rows"] == size["keys"]:
            return {r["key"]: pickle.loads(r["state"]) for r in level.select("key", "state").collect()}
        up = level.withColumns({"child": F.col("node"), "node": F.floor(F.col("node") / fan_in)})
        tasks = (int(size["top"]) // fan_in + 1) * int(size["keys"])
        dealt = up.repartition(tasks, "key", "node").sortWithinPartitions("key", "node", "child").select("key", "node", "state")
        level = materialize(dealt.mapInArrow(run, SCHEMA), "states")
