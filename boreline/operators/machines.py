"""Finite state machines over rows in order, on many tasks for one long entity.

A machine turns a state and a row's symbol into the next state. What a whole
slot does to each state is a small function of states, and such functions are
put one after the other without looking at rows again. So every slot's
function is made first, all slots at once; the states in which the slots are
entered follow from the functions alone; and then every slot is run once more,
again all at once, from the state it is entered in. One slot is one task's
work, whatever the entity's length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numbers import slot
from ..session import stored
from .anomaly import STAGE, TIME
from .ordered import SLOT, SLOT_SECONDS, group_starts

BEFORE, AFTER = "state_before", "state_after"


@dataclass(frozen=True)
class Machine:
    """``steps[state][symbol]`` is the next state; states and symbols are numbers from 0."""

    steps: tuple[tuple[int, ...], ...]
    start: int = 0

    def __post_init__(self) -> None:
        wide = {len(row) for row in self.steps}
        if len(wide) != 1 or not all(0 <= to < len(self.steps) for row in self.steps for to in row) or not 0 <= self.start < len(self.steps):
            raise ValueError("every state needs a next state for every symbol")


def run_machine(
    df: DataFrame, machine: Machine, symbol: Column, keys: list[str] | None = None, ts: str = TIME, tie: list[str] | None = None, slot_seconds: float = SLOT_SECONDS, reverse: bool = False
) -> DataFrame:
    """Add ``state_before`` and ``state_after`` of each row.

    Rows of an entity are taken by time, then by ``tie``, or with ``reverse``
    from the end. Rows without a time come first (or last). ``symbol`` is a
    whole number; rows without one, or with one the machine does not have,
    leave the state as it is.
    """
    keys = STAGE if keys is None else keys
    steps, start, size = [list(row) for row in machine.steps], machine.start, len(machine.steps)
    names = len(steps[0])
    known = F.when(symbol.between(0, names - 1), symbol).otherwise(-1).cast("int")
    turn = -1 if reverse else 1
    rows = df.withColumns({SLOT: F.coalesce(slot(ts, slot_seconds), F.lit(-(1 << 62))) * turn, "_symbol": known})
    group = [*keys, SLOT]
    order = [F.col(c).desc_nulls_last() if reverse else F.col(c).asc_nulls_first() for c in [ts, *(tie or [])]]

    def functions(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, now, last = None, list(range(size)), None
        for batch in batches:
            if batch.empty:
                continue
            begins, last = group_starts(batch, group, last)
            starts = begins.nonzero()[0].tolist()
            symbols, ends, done = batch["_symbol"].tolist(), [*starts, len(batch)], []
            for s in symbols[: ends[0]]:
                if s >= 0:
                    now = [steps[q][s] for q in now]
            for begin, end in zip(starts, ends[1:]):
                done.append(now)
                now = list(range(size))
                for s in symbols[begin:end]:
                    if s >= 0:
                        now = [steps[q][s] for q in now]
            heads = batch.iloc[starts][group]
            if held is None:
                done = done[1:]  # nothing came before the first group
            else:
                heads = pd.concat([held, heads])
            if done:
                yield heads.iloc[: len(done)].assign(to=done)
            held = heads.iloc[len(done) :]
        if held is not None:
            yield held.assign(to=[now])

    def entered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state, last = start, None
        for batch in batches:
            if batch.empty:
                continue
            begins, last = group_starts(batch, keys, last)
            out = []
            for first, to in zip(begins.tolist(), batch["to"].tolist()):
                state = start if first else state
                out.append(state)
                state = int(to[state])
            yield batch[group].assign(_entry=out)

    def states(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state, last = start, None
        for batch in batches:
            if batch.empty:
                continue
            begins, last = group_starts(batch, group, last)
            before, after = [], []
            for first, entry, s in zip(begins.tolist(), batch["_entry"].tolist(), batch["_symbol"].tolist()):
                state = int(entry) if first else state
                before.append(state)
                state = steps[state][s] if s >= 0 else state
                after.append(state)
            yield batch[shape.names[:-2]].assign(**{BEFORE: before, AFTER: after})

    named = [T.StructField(c, rows.schema[c].dataType) for c in group]
    lean = rows.select(*group, ts, *(tie or []), "_symbol").repartition(*group).sortWithinPartitions(*group, *order)
    table = lean.select(*group, "_symbol").mapInPandas(functions, T.StructType([*named, T.StructField("to", T.ArrayType(T.IntegerType()))]))
    # A row per slot; of one entity they are read in order by one task.
    table = stored(table, "slot-functions").repartition(*keys).sortWithinPartitions(*keys, SLOT)
    entry = table.mapInPandas(entered, T.StructType([*named, T.StructField("_entry", T.IntegerType())]))
    entry = entry.toDF(*[f"_e{k}" for k in range(len(group))], "_entry")
    same = F.lit(True)
    for k, c in enumerate(group):
        same = same & F.col(c).eqNullSafe(F.col(f"_e{k}"))
    shape = T.StructType([*[T.StructField(f.name, f.dataType) for f in df.schema], T.StructField(BEFORE, T.IntegerType()), T.StructField(AFTER, T.IntegerType())])
    placed = rows.join(entry, same).drop(*[f"_e{k}" for k in range(len(group))]).repartition(*group).sortWithinPartitions(*group, *order)
    return placed.mapInPandas(states, shape)


# --- machines ------------------------------------------------------------------

#: Symbols of a restart search: a row's marker (0 another, 1 low, 2 ``PRE``, 3 ``MID_TRIAL``), and 4 more if its label ends the stage.
RESTART = Machine(
    (
        (0, 0, 0, 0, 1, 1, 1, 1),  # 0 before the first end
        (1, 2, 1, 1, 1, 2, 1, 1),  # 1 after it
        (2, 2, 3, 2, 2, 2, 3, 2),  # 2 a low marker since
        (3, 3, 3, 4, 3, 3, 3, 4),  # 3 the first ``PRE`` behind that
        (4, 4, 4, 4, 4, 4, 4, 4),  # 4 a trial behind that: the stage started again
    )
)


def restarts(rows: DataFrame, label: str = "substage", marker: str = "marker", ts: str = TIME, slot_seconds: float = SLOT_SECONDS) -> DataFrame:
    """Where stages start again: keys, ``stage_end_at``, ``restart_at``. Rows carry label and marker; a stage has one row per time."""
    kind = F.when(F.col(marker).isin("LOW", "PRE_LOW"), 1).when(F.col(marker) == "PRE", 2).when(F.col(marker) == "MID_TRIAL", 3).otherwise(0)
    symbol = kind + F.when(F.col(label) == "stage_end", 4).otherwise(0)
    run = run_machine(rows.select(*STAGE, ts, label, marker), RESTART, symbol, ts=ts, slot_seconds=slot_seconds)

    def moved(a: int, b: int) -> Column:
        return F.min(F.when((F.col(BEFORE) == a) & (F.col(AFTER) == b), F.col(ts)))

    found = run.groupBy(*STAGE).agg(moved(0, 1).alias("stage_end_at"), moved(2, 3).alias("restart_at"), F.max(AFTER).alias("_last"))
    return found.where("_last = 4").drop("_last")


def run_length(rows: int) -> Machine:
    """Counts rows with symbol 1 since the last 0, up to ``rows``."""
    return Machine(tuple((0, min(k + 1, rows)) for k in range(rows + 1)))


def long_runs(df: DataFrame, keys: list[str], ts: str, mask: str, rows: int, name: str, slot_seconds: float = SLOT_SECONDS) -> DataFrame:
    """Add ``name``: the mask, kept only in runs of at least ``rows`` rows; counted from both sides by one machine."""
    machine, symbol = run_length(rows), F.when(F.col(mask), 1).otherwise(0)
    ahead = run_machine(df, machine, symbol, keys, ts, slot_seconds=slot_seconds).withColumnRenamed(AFTER, "_ahead").drop(BEFORE)
    ahead = stored(ahead, "runs-ahead")
    both = run_machine(ahead, machine, symbol, keys, ts, slot_seconds=slot_seconds, reverse=True)
    kept = F.col(mask) & (F.col("_ahead") + F.col(AFTER) - 1 >= rows)
    return both.withColumn(name, F.coalesce(kept, F.lit(False))).select(*df.columns, name)
