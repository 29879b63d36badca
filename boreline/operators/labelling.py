"""Row labels from a user's rule, and the values the rule is given.

The rules themselves belong to the caller. A rule that looks at one row is a
Column; one that needs the rows before it is a ``Fold``, which gets a stage in
parts and carries what it must remember; one that needs a whole stage at once
is a function of its sorted rows, or ``Grouped``, which gets many short stages
by one call.
"""

from __future__ import annotations

from abc import ABC, abstractmethod
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stored
from .anomaly import STAGE, TIME
from .ordered import HALO, SLOT, SLOT_SECONDS, exact_median, group_starts, with_halo
from .stages import sampling_gaps

# Marker labels the restart search and the design values look for.
DESIGN_MARKERS = ["MID_TRIAL", "MID"]
LOW_MARKERS = ["LOW", "PRE_LOW"]

@dataclass(frozen=True)
class Trimmed:
    """Labels of the rows from position ``start`` to ``end`` of what the labeller was given; the other rows are not written."""

    labels: Sequence
    start: int
    end: int


class Fold(ABC):
    """A labeller that reads a stage once, in order, and holds no more of it than its state."""

    @abstractmethod
    def start(self) -> Any:
        """The state before a stage's first row."""

    @abstractmethod
    def step(self, state: Any, rows: pd.DataFrame) -> tuple[Any, Any]:
        """Labels of the next rows of the stage (one each, ``Trimmed``, or None for none of them) and the state behind them."""


#: Number of a row's stage in what a ``Grouped`` labeller is given.
GROUP = "_group"


@dataclass(frozen=True)
class Grouped:
    """A labeller of many whole stages at once: ``label`` gets their rows in order, those of a stage with one number as ``_group``, and returns one label per row."""

    label: Callable[[pd.DataFrame], Sequence | pd.Series]


Labels = Sequence | pd.Series | Trimmed | None
Labeller = Callable[[pd.DataFrame], Labels] | Fold | Grouped | Column


def design_medians(markers: DataFrame) -> DataFrame:
    """Median rate and pressure of a stage's design-marker rows; only finite values above zero count."""
    rows = markers.where(F.col("substage").isin(DESIGN_MARKERS))
    values = F.explode(F.array(
        F.struct(F.lit("rate").alias("measure"), F.col("rate_slurry").alias("value")),
        F.struct(F.lit("pressure").alias("measure"), F.col("press_mainline").alias("value")),
    ))
    long = rows.select(*STAGE, values.alias("_v")).select(*STAGE, "_v.*")
    medians = exact_median(long, [*STAGE, "measure"], "value", "median", width=5.0)
    usable = F.when((F.col("median") > 0) & (F.col("median") < float("inf")), F.col("median"))
    return medians.groupBy(*STAGE).agg(
        F.max(F.when(F.col("measure") == "rate", usable)).alias("inferred_design_rate"),
        F.max(F.when(F.col("measure") == "pressure", usable)).alias("inferred_pressure"),
    )


def sampling_step(df: DataFrame, ts: str = "record_ts", slot_seconds: float = SLOT_SECONDS) -> DataFrame:
    """Median seconds between the rows of a stage; 1.0 where a stage has one row."""
    gaps = sampling_gaps(df, STAGE, ts, slot_seconds)
    steps = exact_median(gaps, STAGE, "gap_seconds", "_step", width=0.001)  # jittered gaps all differ, by less than a second
    return df.select(*STAGE).distinct().join(steps, STAGE, "left").select(*STAGE, F.coalesce("_step", F.lit(1.0)).alias("sampling_step"))


def _labelled(part: pd.DataFrame, labels: Labels) -> pd.DataFrame | None:
    """The rows that got labels, null as ``NA``."""
    if labels is None:
        return None
    if isinstance(labels, Trimmed):
        if not 0 <= labels.start <= labels.end < len(part):
            raise ValueError(f"labels of the rows {labels.start} to {labels.end} of {len(part)}")
        part, labels = part.iloc[labels.start : labels.end + 1], labels.labels
    labels = pd.Series(labels)
    if len(labels) != len(part):
        raise ValueError("a labeller must return one label per row")
    return part.assign(substage=labels.astype(object).where(labels.notna(), "NA").astype(str).to_numpy())


def _parts(batches: Iterator[pd.DataFrame], group: list[str]) -> Iterator[tuple[pd.DataFrame, bool]]:
    """The runs of one group in each batch, and whether a run begins its group."""
    last = None
    for batch in batches:
        if batch.empty:
            continue
        begins, last = group_starts(batch, group, last)
        starts = begins.nonzero()[0].tolist()
        edges = sorted({0, *starts, len(batch)})
        for start, end in zip(edges, edges[1:]):
            yield batch.iloc[start:end].reset_index(drop=True), bool(begins[start])


def _whole_groups(batches: Iterator[pd.DataFrame], group: list[str]) -> Iterator[pd.DataFrame]:
    """The same rows, cut where a group begins, with the number of their group."""
    held: list[pd.DataFrame] = []  # with the last group, which may go on in the next batch
    last, number = None, 0
    for batch in batches:
        if batch.empty:
            continue
        begins, last = group_starts(batch, group, last)
        numbers = number + begins.cumsum()
        number = int(numbers[-1])
        batch = batch.assign(**{GROUP: numbers})
        starts = begins.nonzero()[0]
        if len(starts):
            ready = pd.concat([*held, batch.iloc[: starts[-1]]], ignore_index=True)
            if len(ready):
                yield ready
            held, batch = [], batch.iloc[starts[-1] :]
        held.append(batch)
    if held:
        yield pd.concat(held, ignore_index=True)


def label_stages(df: DataFrame, labeller: Labeller, context_rows: int = 0, ts: str = TIME, slot_seconds: float | None = None) -> DataFrame:
    """Add the labels of a rule as ``substage``; null becomes ``NA``.

    A Column is computed where the rows are. Other labellers get a stage's
    rows in order; Spark deals stages out and sorts the rows of a task, so they
    reach Python many to an Arrow batch. A ``Fold`` gets them as the batches
    come and nothing is held back, so a stage may be longer than a task's
    memory. A ``Grouped`` labeller is called once for each Arrow batch, with
    the whole stages that end in it, so that many short stages cost a few calls;
    a plain function is called once for each stage, with all of its rows;
    if it is declared local, one whose label of a row depends on
    ``context_rows`` rows on either side only, it may be given
    ``slot_seconds``: a stage is then handed over in time slots, each with
    those rows around it, and labels of context rows are discarded.

    A labeller returns one label per row it is given, ``Trimmed`` labels of
    some of them (then only those rows are returned), or None: a stage
    without labels is left out. A local function of slots labels every row.
    """
    own = df.drop("substage")
    if isinstance(labeller, Column):
        return own.withColumn("substage", F.coalesce(labeller.cast("string"), F.lit("NA")))
    schema = T.StructType([*own.schema.fields, T.StructField("substage", T.StringType())])
    names = schema.names
    if isinstance(labeller, Fold):

        def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            state = None
            for part, begins in _parts(batches, STAGE):
                if begins:
                    state = labeller.start()
                labels, state = labeller.step(state, part)
                done = _labelled(part, labels)
                if done is not None:
                    yield done[names]

        return own.repartition(*STAGE).sortWithinPartitions(*STAGE, ts).mapInPandas(fold, schema)
    if slot_seconds is None:
        haloed = own.withColumn(SLOT, F.lit(0)).withColumn(HALO, F.lit(0))
    else:
        haloed = with_halo(own, STAGE, ts, before=context_rows, after=context_rows, slot_seconds=slot_seconds)
    group = [*STAGE, SLOT]
    if isinstance(labeller, Grouped):

        def many(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for part in _whole_groups(batches, group):
                done = _labelled(part, labeller.label(part))
                yield done.loc[done[HALO] == 0, names]

        return haloed.repartition(*group).sortWithinPartitions(*group, ts).mapInPandas(many, schema)

    def call(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []  # the parts of one group, which may go on in the next batch
        ready: list[pd.DataFrame] = []
        size = 0

        def label() -> None:
            part = held[0] if len(held) == 1 else pd.concat(held, ignore_index=True)
            labels = labeller(part)
            if slot_seconds is not None and (labels is None or isinstance(labels, Trimmed)):
                raise ValueError("a labeller of slots must label every row")
            done = _labelled(part, labels)
            if done is not None:
                ready.append(done.loc[done[HALO] == 0, names])

        for part, begins in _parts(batches, group):
            if begins and held:
                label()
                held = []
                size += len(ready[-1]) if ready else 0
                if size >= 10_000:
                    yield pd.concat(ready, ignore_index=True)
                    ready, size = [], 0
            held.append(part)
        if held:
            label()
        if ready:
            yield pd.concat(ready, ignore_index=True)

    return haloed.repartition(*group).sortWithinPartitions(*group, ts).mapInPandas(call, schema)


def with_stage_facts(df: DataFrame, ts: str = TIME) -> DataFrame:
    """Add ``stage_first_ts``, ``stage_last_ts``, ``stage_rows`` and ``stage_max_rate``.

    What a rule must know of a whole stage, counted with map-side combine and
    joined on, so that the rule itself can be a Column or a ``Fold``.
    """
    facts = df.groupBy(*STAGE).agg(
        F.min(ts).alias("stage_first_ts"), F.max(ts).alias("stage_last_ts"), F.count(F.lit(1)).alias("stage_rows"), F.max("rate_slurry").alias("stage_max_rate")
    )
    return df.join(facts.toDF("_name", "_stage", *facts.columns[2:]), F.col("name").eqNullSafe(F.col("_name")) & F.col("stage_num_td").eqNullSafe(F.col("_stage"))).drop("_name", "_stage")


def restart_positions(labels: DataFrame, markers: DataFrame, ts: str = TIME) -> DataFrame:
    """Where a stage starts again after its first end.

    The restart is the first ``PRE`` row after the first ``stage_end`` that has
    a low marker between the two and a ``MID_TRIAL`` after it. One aggregate
    with map-side combine leaves the few stages that can have one, and only
    their rows are looked at again: no stage is ordered in one task, and the
    rows of the others are not joined at all.
    """
    low, pre, trial = F.col("_m").isin(LOW_MARKERS), F.col("_m") == "PRE", F.col("_m") == "MID_TRIAL"
    m = markers.select(*STAGE, ts, F.col("substage").alias("_m")).where(low | pre | trial)
    ends = labels.where(F.col("substage") == "stage_end").select(*STAGE, ts, F.lit(None).cast("string").alias("_m"))

    def last(kind: Column) -> Column:
        return F.max(F.when(kind, F.col(ts)))

    bounds = ends.unionByName(m).groupBy(*STAGE).agg(
        F.min(F.when(F.col("_m").isNull(), F.col(ts))).alias("stage_end_at"), last(low).alias("_low"), last(pre).alias("_pre"), last(trial).alias("_trial")
    )
    end = F.col("stage_end_at")
    bounds = stored(bounds.where((F.col("_low") > end) & (F.col("_pre") > end) & (F.col("_trial") > end)).select(*STAGE, "stage_end_at", "_trial"), "restart-bounds")
    tail = m.where(low | pre).join(bounds, STAGE).where((F.col(ts) > end) & (F.col(ts) < F.col("_trial")))
    return (
        tail.where(pre)
        .join(tail.where(low).groupBy(*STAGE).agg(F.min(ts).alias("_low")), STAGE)
        .where(F.col(ts) > F.col("_low"))
        .groupBy(*STAGE)
        .agg(F.first("stage_end_at").alias("stage_end_at"), F.min(ts).alias("restart_at"))
    )


def two_pass_labels(rows: DataFrame, markers: DataFrame, labeller: Labeller, context_rows: int = 0, ts: str = TIME, slot_seconds: float | None = None) -> DataFrame:
    """Label with design values, look for restarts, label again from there.

    ``rows`` carries the stage's readings. Each row gets its stage's medians as
    ``inferred_design_rate`` and ``inferred_pressure``. After a restart the
    second pass labels the remaining rows alone; rows between the end and the
    restart become ``NA``. ``design`` is written as ``slurry``.
    """
    ready = rows.join(design_medians(markers), STAGE, "left")
    first = stored(label_stages(ready, labeller, context_rows, ts, slot_seconds), "first-pass")
    restarts = stored(restart_positions(first, markers, ts), "restarts")  # both branches below join it; its size is known by then
    marked = first.join(restarts, STAGE, "left")
    after = marked.where(F.col(ts) >= F.col("restart_at")).drop("stage_end_at", "restart_at")
    second = label_stages(after, labeller, context_rows, ts, slot_seconds)
    between = (F.col(ts) > F.col("stage_end_at")) & (F.col(ts) < F.col("restart_at"))
    kept = (
        marked.where(F.col("restart_at").isNull() | (F.col(ts) < F.col("restart_at")))
        .withColumn("substage", F.when(between, "NA").otherwise(F.col("substage")))
        .drop("stage_end_at", "restart_at")
    )
    both = kept.unionByName(second)
    return both.withColumn("substage", F.when(F.lower("substage") == "design", "slurry").otherwise(F.col("substage")))
