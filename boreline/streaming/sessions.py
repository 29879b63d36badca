"""Gap stages kept as state: one interval per stage and well, right whatever order readings come in.

A micro-batch is reduced to the first and last reading of each (well, slot)
before it is shuffled; slots are no wider than the gap, so what lies in one is
never split. The state of a well is the list of its stages' first and last
readings. A slot's interval that is nearer than the gap to a stage becomes part
of it; one that is near two stages makes them one, and one that is near none is
a stage of its own. This holds for late readings as for others, and doing it
twice changes nothing, so resent readings and replayed batches do no harm.

The last stage of a well is kept apart from the closed ones, which are read
only when a reading comes that lies before the last stage.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import _parse_datatype_string
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..functions.numbers import MICROS, micros
from ..sources.writes import prune_folder, read_folder, upsert_folder

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Folders that the stage index is kept in; a batch rewrites those of the wells it changes.
FOLDERS = 16
DAY = 86_400 * MICROS
CHANGES = "name string, kind string, stage_num_td bigint, lo bigint, hi bigint, readings bigint"
INDEX = "name string, stage_num_td bigint, lo bigint, hi bigint, folder string"


def slot_intervals(stream: DataFrame, gap_seconds: float) -> DataFrame:
    """``name, lo, hi, readings`` of the slots that each Arrow batch touches, in microseconds."""
    width = int(gap_seconds * MICROS)

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            t = batch.column(1)
            # Integer division goes towards zero, slots go down.
            slots = pc.subtract(pc.divide(t, width), pc.cast(pc.less(t, 0), pa.int64()))
            table = pa.table({"name": batch.column(0), "t": t, "slot": slots})
            out = table.group_by(["name", "slot"]).aggregate([("t", "min"), ("t", "max"), ("t", "count")])
            yield from out.select(["name", "t_min", "t_max", "t_count"]).rename_columns(["name", "lo", "hi", "readings"]).to_batches()

    rows = stream.where(F.col("name").isNotNull() & F.col("record_ts").isNotNull())
    return rows.select("name", micros("record_ts").alias("t")).mapInArrow(reduce, "name string, lo bigint, hi bigint, readings bigint")


def insert(stages: list[tuple[int, int]], lo: int, hi: int, gap: int) -> None:
    """Put an interval into a well's stages, which are in order and at least the gap apart."""
    at = bisect_left(stages, (lo, hi))
    first = at - 1 if at and lo - stages[at - 1][1] < gap else at
    last = first
    while last < len(stages) and stages[last][0] - hi < gap:
        lo, hi = min(lo, stages[last][0]), max(hi, stages[last][1])
        last += 1
    stages[first:last] = [(lo, hi)]


class Stages(StatefulProcessor):
    """The stages of one well. Closed ones that end more than ``kept`` before the last reading are forgotten, by the readings' own time."""

    def __init__(self, gap: int, kept: int | None = None):
        self.gap, self.kept = gap, kept

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.tail = handle.getValueState("tail", "n bigint, lo bigint, hi bigint, forgotten bigint")
        self.closed = handle.getMapState("closed", "lo bigint", "hi bigint")

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:  # noqa: N802, N803
        """Stages of an index that exists already: ``stage_num_td, lo, hi``."""
        rows = sorted(zip(initialState["stage_num_td"].tolist(), initialState["lo"].tolist(), initialState["hi"].tolist(), strict=True))
        if self.tail.exists():
            rows = sorted([*rows, tuple(self.tail.get())[:3]])
        for _, lo, hi in rows[:-1]:
            self.closed.updateValue((lo,), (hi,))
        self.tail.update((*rows[-1], None))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        batch = pd.concat(list(rows))  # one row for each slot and task of the micro-batch
        came = sorted(zip(batch["lo"].tolist(), batch["hi"].tolist(), batch["readings"].tolist(), strict=True))
        n, lo, hi, forgotten = self.tail.get() if self.tail.exists() else (0, None, None, None)
        late = [c for c in came if n and c[0] <= hi]
        out: list[tuple] = []
        if n and came[0][0] < lo:
            known = sorted((k[0], v[0]) for k, v in self.closed.iterator())
        else:
            known = []
        before = n - 1 - len(known) if n else 0  # stages that are not at hand
        old = [*known, (lo, hi)] if n else []
        new = list(old)
        for a, b, readings in came:
            if forgotten is not None and a - forgotten < self.gap:  # among what has been forgotten
                out.append(("unplaced", None, a, b, readings))
            else:
                insert(new, a, b, self.gap)
        for k in range(max(len(old), len(new))):
            if k >= len(new):
                out.append(("gone", before + k + 1, None, None, 0))
            elif k >= len(old) or old[k] != new[k]:
                out.append(("stage", before + k + 1, *new[k], 0))
        for a, b in set(old[:-1]) - set(new[:-1]):
            self.closed.removeKey((a,))
        for a, b in set(new[:-1]) - set(old[:-1]):
            self.closed.updateValue((a,), (b,))
        if new:
            if self.kept is not None and (not n or new[-1][1] // DAY > hi // DAY):  # looked through once a day
                for k, v in list(self.closed.iterator()):
                    if v[0] < new[-1][1] - self.kept:
                        self.closed.removeKey(k)
                        forgotten = v[0] if forgotten is None else max(forgotten, v[0])
            self.tail.update((before + len(new), *new[-1], forgotten))
        if late:
            out.append(("late", None, late[0][0], max(c[1] for c in late), sum(c[2] for c in late)))
        frame = pd.DataFrame(out, columns=["kind", "stage_num_td", "lo", "hi", "readings"], dtype="object")
        frame = frame.astype({c: "Int64" for c in ("stage_num_td", "lo", "hi", "readings")})
        yield frame.assign(name=key[0])[["name", "kind", "stage_num_td", "lo", "hi", "readings"]]


def stage_changes(stream: DataFrame, gap_seconds: float, index: DataFrame | None = None, kept_days: float | None = None) -> DataFrame:
    """A stream of what each micro-batch changes in the stage index.

    ``stage`` rows are stages as they are now, ``gone`` rows numbers that are
    no longer used, ``late`` rows count the readings of a well's slots that
    begin at or before its last reading, ``unplaced`` rows those among
    stages that the state has forgotten. ``index`` (``name, stage_num_td, stage_start_ts,
    stage_end_ts``) is what a new stream begins with.
    """
    initial = None
    if index is not None:
        initial = index.select("name", "stage_num_td", micros("stage_start_ts").alias("lo"), micros("stage_end_ts").alias("hi")).groupBy("name")
    processor = Stages(int(gap_seconds * MICROS), None if kept_days is None else int(kept_days * DAY))
    return slot_intervals(stream, gap_seconds).groupBy("name").transformWithStateInPandas(processor, CHANGES, "Update", "None", initialState=initial)


def sessions(stream: DataFrame, root: str, gap_seconds: float, index: DataFrame | None = None, kept_days: float | None = None, every: str | None = None) -> StreamingQuery:
    """Keep the stage index below ``root``; read it with ``stage_index``, and what came late with ``late_readings``.

    The index is upserted by well and number, so a replayed batch writes what
    it wrote before. Versions that no reader can see are deleted.
    """
    spark = stream.sparkSession
    schema = _parse_datatype_string(INDEX)

    def handle(batch: DataFrame, number: int) -> None:
        own = batch.sparkSession
        batch.persist()
        try:
            changed = batch.where("kind in ('stage', 'gone')").select("name", "stage_num_td", "lo", "hi", F.pmod(F.xxhash64("name"), F.lit(FOLDERS)).cast("string").alias("folder"))
            upsert_folder(own, f"{root}/index", changed, ["name", "stage_num_td"], "folder")
            batch.where("kind in ('late', 'unplaced')").write.mode("overwrite").parquet(f"{root}/late/batch={number}")
            prune_folder(own, f"{root}/index", schema, "folder", behind=1)
        finally:
            batch.unpersist()

    changes = stage_changes(stream, gap_seconds, index, kept_days)
    writer = changes.writeStream.outputMode("update").option("checkpointLocation", f"{root}/checkpoint").foreachBatch(handle)
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKS)  # a query keeps the store it was started with
    try:
        return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)


def stage_index(spark: SparkSession, root: str, index: DataFrame | None = None) -> DataFrame:
    """``name, stage_num_td, stage_start_ts, stage_end_ts`` as of the last micro-batch; ``index`` is what the stream began with."""
    rows = read_folder(spark, f"{root}/index", _parse_datatype_string(INDEX), "folder")
    at = [F.timestamp_micros(c).cast("timestamp_ntz").alias(t) for c, t in (("lo", "stage_start_ts"), ("hi", "stage_end_ts"))]
    now = rows.select("name", "stage_num_td", *at)
    if index is not None:
        now = now.unionByName(index.join(now, ["name", "stage_num_td"], "left_anti").select(*now.columns))
    return now.where("stage_start_ts is not null")


def late_readings(spark: SparkSession, root: str) -> DataFrame:
    """``name, kind, lo, hi, readings`` and the ``batch`` of what came late."""
    return spark.read.schema(f"{CHANGES}, batch bigint").parquet(f"{root}/late").select("name", "kind", "lo", "hi", "readings", "batch")
