"""Ordered folds: what a key's next row gives depends on all rows before it, so no window or aggregate can say it.

Rows are dealt by key and sorted, and one pass holds a single state at a time: a key's rows are never gathered, the sort
may spill, and a lost task is read again. Keys differ in length; a key's own rows are sequential by nature.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


def folded(
    rows: DataFrame, keys: list[str], order: list[str], start: Callable[[], Any], step: Callable[[Any, tuple], tuple[Any, list[tuple]]], schema: str, finish: Callable[[tuple, Any], list[tuple]] | None = None
) -> DataFrame:
    """step(state, row) gives the next state and rows of `schema`; finish(key, state) gives rows once a key ends.

    A row is a tuple of all columns of `rows`, in their order. Rows should have a total order; null keys are one key.
    """
    columns = rows.columns
    at = [columns.index(k) for k in keys]
    out = StructType.fromDDL(schema)
    arrow = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, seen = None, None, False
        for batch in batches:
            made: list[tuple] = []
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                mine = tuple(row[i] for i in at)
                if not seen or mine != key:
                    if seen and finish:
                        made += finish(key, state)
                    key, state, seen = mine, start(), True
                state, some = step(state, row)
                made += some
            yield table(made)
        if seen and finish:
            yield table(finish(key, state))

    def table(made: list[tuple]) -> pa.RecordBatch:
        arrays = [pa.array(list(c), f.type) for c, f in zip(zip(*made, strict=True), arrow, strict=True)] if made else [pa.array([], f.type) for f in arrow]
        return pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return rows.repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(run, out)


def smoothed(rows: DataFrame, key: str, order: str, value: str) -> DataFrame:
    """(9 * old + new) div 10 over the ordered whole values of each key; the first value starts it. ema and n per key."""

    def step(state: tuple | None, row: tuple) -> tuple[tuple, list]:
        return ((row[2], 1) if state is None else ((9 * state[0] + row[2]) // 10, state[1] + 1)), []

    return folded(rows.select(key, order, value), [key], [order], lambda: None, step, f"{key} long, ema long, n long", lambda k, s: [(k[0], *s)])


def controlled(rows: DataFrame, key: str, order: str, error: str, kp: float, ki: float, kd: float, low: float, high: float) -> DataFrame:
    """The last output of a PID controller per key, clamped, the integral held while it is (no wind-up)."""

    def step(state: tuple, row: tuple) -> tuple[tuple, list]:
        integral, before, _ = state
        e = row[2]
        raw = kp * e + ki * (integral + e) + kd * (e - before)
        clamped = min(high, max(low, raw))
        return (integral + e if clamped == raw else integral, e, clamped), []

    return folded(rows.select(key, order, error), [key], [order], lambda: (0.0, 0.0, 0.0), step, f"{key} long, out double", lambda k, s: [(k[0], s[2])])


def gated(rows: DataFrame, key: str, order: list[str], at: str, delay: str) -> DataFrame:
    """Rows with `runs`: whether at least the delay set by the last run has passed. at and delay are whole numbers
    of one unit; the first row runs; a run's own delay holds from then on. What runs are refreshes, what does not is served from cache."""
    i, j = rows.columns.index(at), rows.columns.index(delay)

    def step(state: tuple | None, row: tuple) -> tuple[tuple, list]:
        if state is None or row[i] - state[0] >= state[1]:
            return (row[i], row[j]), [(*row, True)]
        return state, [(*row, False)]

    return folded(rows, [key], order, lambda: None, step, _ddl(rows) + ", runs boolean")


def running_with_reset(rows: DataFrame, key: str, order: list[str], value: str, reset: str) -> DataFrame:
    """Rows with `total`: the sum of value since the last row with `reset`, that row's report included; after it 0."""
    i, j = rows.columns.index(value), rows.columns.index(reset)

    def step(state: int, row: tuple) -> tuple[int, list]:
        now = state + (row[i] or 0)
        return (0 if row[j] else now), [(*row, now)]

    return folded(rows, [key], order, lambda: 0, step, _ddl(rows) + ", total long")


def bounded_queue(ticks: DataFrame, key: str, at: str, arrivals: str, capacity: int = 10_000, batch: int = 100, warn: float = 0.8) -> DataFrame:
    """K8: per key a queue that takes arrivals while there is room, drops the rest, and works off a batch a tick.

    processed, dropped, left and warned (ticks that begin above the warning share) per key; ticks are one row each.
    """

    def step(state: tuple, row: tuple) -> tuple[tuple, list]:
        size, done, lost, warned = state
        taken = min(row[2], capacity - size)
        full = size + taken
        work = min(batch, full)
        return (full - work, done + work, lost + row[2] - taken, warned + (full > warn * capacity)), []

    return folded(ticks.select(key, at, arrivals), [key], [at], lambda: (0, 0, 0, 0), step, f"{key} string, processed long, dropped long, left long, warned long", lambda k, s: [(k[0], s[1], s[2], s[0], s[3])])


def loot_sets(rows: DataFrame, key: str, order: list[str], item: str, at: str, capacity: int, lifetime: int) -> DataFrame:
    """(key, item, at) in each key's set at the end: a set that is full sheds what is older than the lifetime when a
    row comes, is cleared if it is full still, and takes the row's item if it has it not."""
    i, j = rows.columns.index(item), rows.columns.index(at)

    def step(state: dict, row: tuple) -> tuple[dict, list]:
        if len(state) >= capacity:
            state = {k: v for k, v in state.items() if v > row[j] - lifetime}
        if len(state) >= capacity:
            state = {}
        state.setdefault(row[i], row[j])
        return state, []

    return folded(rows, [key], order, dict, step, f"{key} long, {item} long, {at} long", lambda k, s: [(k[0], *x) for x in s.items()])


def span_names(rows: DataFrame, key: str, order: list[str], name: str, finishes: str) -> DataFrame:
    """Rows that start a span, with `stack_name`: the name and, from the innermost out, the spans open around it. A
    finish ends the innermost span; without one it does nothing."""
    i, j = rows.columns.index(name), rows.columns.index(finishes)

    def step(state: tuple, row: tuple) -> tuple[tuple, list]:
        if row[j]:
            return state[:-1], []
        around = f" [{'|'.join(reversed(state))}]" if state else ""
        return (*state, row[i]), [(*row, row[i] + around)]

    return folded(rows, [key], order, tuple, step, _ddl(rows) + ", stack_name string")


def shortcuts(points: DataFrame, path: str, order: list[str], name: str, position: str, start: float, too_close: float, far: float) -> DataFrame:
    """Where a traveller at `start` should enter each path: from the last point that is nearest, or near while far along
    the path (lengths are summed as squares, as the rule has it); path, entry (the point's name) and whether it is worth it."""
    i, j = points.columns.index(position), points.columns.index(name)

    def step(state: tuple | None, row: tuple) -> tuple[tuple, list]:
        near = (row[i] - start) ** 2
        if state is None:
            return (near, near, row[i], row[i], row[j]), []
        least, total, first, before, entry = state
        total += (row[i] - before) ** 2
        if near < too_close**2 or near < least or (near < far**2 and near < total / 2):
            least, total, entry = near, near, row[j]
        return (least, total, first, row[i], entry), []

    return folded(points, [path], order, lambda: None, step, f"{path} long, entry long, worth boolean", lambda k, s: [(k[0], s[4], s[0] <= far**2)])


def shelves(boxes: DataFrame, key: str, gap: float = 500.0, left: float = -13_000.0, right: float = 3_000.0) -> DataFrame:
    """(key, dx, dy) that lay the boxes (key, x0, y0, x1, y1) on shelves from left to right, in order of the key; past
    `right` the next shelf begins below the highest box so far. One box after the other: one row per map is all this reads."""
    from pyspark.sql import functions as F

    def step(state: tuple, row: tuple) -> tuple[tuple, list]:
        x, y, high = state
        k, x0, y0, x1, y1, _ = row
        placed = (k, x - x0, y - y1)
        high = max(high, y1 - y0 + gap)
        x += x1 - x0 + gap
        return ((left, y - high, high) if x > right else (x, y, high)), [placed]

    return folded(boxes.select(key, "x0", "y0", "x1", "y1").withColumn("_all", F.lit(1)), ["_all"], [key], lambda: (left, left, 0.0), step, f"{key} long, dx double, dy double")


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{c}` {kind}" for c, kind in df.dtypes)
