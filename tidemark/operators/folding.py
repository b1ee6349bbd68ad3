"""Aggregates that a user gives as functions: a start, a step and a merge.

``Fold`` is any commutative monoid with a step: every task folds its rows by key into states,
states are rows of a given schema, and sorted streams of them are merged until a key has one.
A key with very many states (one in every task) is merged in a tree: its states are numbered
and dealt to as many groups as keep a group at ``fan_in`` states, level by level.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tidemark.sources import scratch

#: Keys whose states a task holds at a time, and states of a key that one task merges.
HELD_KEYS = 100_000
FAN_IN = 256
State = tuple


@dataclass(frozen=True)
class Fold:
    """``zero`` is the state of no rows; ``step`` takes a state and a row's values; ``merge``
    takes two states, in any order; ``finish`` makes the result's columns of a state. States
    and results are tuples in the order of their schemas."""

    zero: State
    step: Callable[[State, tuple], State]
    merge: Callable[[State, State], State]
    finish: Callable[[State], tuple]
    state: str
    result: str


def _batches(
    rows: Iterable[tuple], schema: pa.Schema, size: int = 10_000
) -> Iterator[pa.RecordBatch]:
    kept: list[tuple] = []
    for row in rows:
        kept.append(row)
        if len(kept) == size:
            yield _batch(kept, schema)
            kept = []
    if kept:
        yield _batch(kept, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[Any, ...]]:
    for batch in batches:
        yield from zip(*[column.to_pylist() for column in batch.columns], strict=True)


def _fields(ddl: str) -> list:
    return list(StructType.fromDDL(ddl).fields)


def partial_states(
    df: DataFrame, keys: Sequence[str], values: Sequence[str], fold: Fold,
    held_keys: int = HELD_KEYS,
) -> DataFrame:
    """The keys and the state of some of their rows: about one state per key and task. A task
    that meets more than ``held_keys`` keys hands over what it holds and begins anew."""
    kind = StructType([*[df.schema[k] for k in keys], *_fields(fold.state)])
    arrow, width = to_arrow_schema(kind), len(keys)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, State] = {}
        for row in _rows(batches):
            key = row[:width]
            held[key] = fold.step(held.get(key, fold.zero), row[width:])
            if len(held) >= held_keys:
                yield from _batches(((*k, *s) for k, s in held.items()), arrow)
                held = {}
        yield from _batches(((*k, *s) for k, s in held.items()), arrow)

    return df.select(*keys, *values).mapInArrow(run, kind)


def merged_states(states: DataFrame, keys: Sequence[str], fold: Fold) -> DataFrame:
    """One state for each different key among the rows of a task, which are sorted by key."""
    kind = StructType([*[states.schema[k] for k in keys], *_fields(fold.state)])
    arrow, width = to_arrow_schema(kind), len(keys)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def merged() -> Iterator[tuple]:
            key, state = None, None
            for row in _rows(batches):
                if state is not None and row[:width] == key:
                    state = fold.merge(state, row[width:])
                    continue
                if state is not None:
                    yield (*key, *state)
                key, state = row[:width], row[width:]
            if state is not None:
                yield (*key, *state)

        yield from _batches(merged(), arrow)

    return states.select(*keys, *[f.name for f in _fields(fold.state)]).mapInArrow(run, kind)


def fold_by_key(
    df: DataFrame, keys: Sequence[str], values: Sequence[str], fold: Fold,
    fan_in: int = FAN_IN, held_keys: int = HELD_KEYS,
) -> DataFrame:
    """The keys and the finished result of all their rows' values.

    NULL is a key like others. NaN equals nothing in Python, itself included, so make NaN keys
    NULL first. The functions run on the executors, row by row: for what built-in aggregates
    cannot express.
    """
    if fan_in < 2:
        raise ValueError("a group must merge at least two states")
    names = [f.name for f in _fields(fold.state)]
    if set(names) & set(keys):
        raise ValueError("state columns and keys need different names")
    states = scratch.written(partial_states(df, keys, values, fold, held_keys), "fold-states")
    while True:
        most = states.groupBy(*keys).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
        if most <= fan_in:
            break
        groups = -(-most // fan_in)
        # states of a key lie in many tasks of the scan: number them there, not by key
        salt = F.pmod(F.monotonically_increasing_id() + F.spark_partition_id(), F.lit(groups))
        dealt = states.withColumn("_salt", salt.cast("int"))
        spread = dealt.repartition(*keys, "_salt").sortWithinPartitions(*keys, "_salt")
        fewer = merged_states(spread, [*keys, "_salt"], fold).drop("_salt")
        states = scratch.written(fewer, "fold-states")
    whole = merged_states(states.repartition(*keys).sortWithinPartitions(*keys), keys, fold)
    kind = StructType([*[df.schema[k] for k in keys], *_fields(fold.result)])
    arrow, width = to_arrow_schema(kind), len(keys)

    def finish(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((*row[:width], *fold.finish(row[width:])) for row in _rows(batches))
        yield from _batches(rows, arrow)

    return whole.mapInArrow(finish, kind)


def average() -> Fold:
    """The mean of a value, NULLs left out; NULL if there is none."""
    return Fold(
        zero=(0.0, 0),
        step=lambda s, row: s if row[0] is None else (s[0] + row[0], s[1] + 1),
        merge=lambda a, b: (a[0] + b[0], a[1] + b[1]),
        finish=lambda s: (s[0] / s[1] if s[1] else None,),
        state="total double, n bigint",
        result="average double",
    )


def first_two(rank: Callable[[tuple], Any], state: str, result: str, finish) -> Fold:
    """The two rows that come first by ``rank``. The state holds the columns of both, NULL
    where there are fewer, and how many rows there were, up to two."""
    width = (len(_fields(state)) - 1) // 2

    def rows(s: State) -> list[tuple]:
        return [s[1 : 1 + width], s[1 + width :]][: s[0]]

    def packed(found: list[tuple]) -> State:
        kept = sorted(found, key=rank)[:2]
        none = (None,) * width
        return (len(kept), *(kept[0] if kept else none), *(kept[1] if len(kept) > 1 else none))

    return Fold(
        zero=packed([]),
        step=lambda s, row: packed([*rows(s), tuple(row)]),
        merge=lambda a, b: packed([*rows(a), *rows(b)]),
        finish=lambda s: finish(rows(s)),
        state=state,
        result=result,
    )
