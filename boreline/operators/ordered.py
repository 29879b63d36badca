"""Ordered computation that does not put a whole entity into one task.

A plain ``Window.partitionBy(entity)`` moves every row of an entity to one
task, and one entity may hold a third of all rows. Here an entity's time line
is cut into slots. Row-level windows run inside one (entity, slot), and what
must cross a slot edge is carried by a small table with a few rows per slot,
so an entity-wide window only ever sees rows that are bounded by its number of
slots.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import slot

SLOT = "_slot"
HALO = "_halo"
SLOT_SECONDS = 3_600.0


def with_halo(
    df: DataFrame,
    keys: list[str],
    ts: str,
    before: int = 0,
    after: int = 0,
    tie: list[str] | None = None,
    slot_seconds: float = SLOT_SECONDS,
) -> DataFrame:
    """Copy the neighbouring rows of other slots into each slot.

    Adds ``_slot`` and ``_halo``. Inside ``partitionBy(*keys, "_slot")`` in time
    order, every row with ``_halo = 0`` then has its true ``before`` previous and
    ``after`` next rows of the entity, so ``lag``, ``lead`` and row frames up to
    those widths are right. Drop the rows with ``_halo != 0`` afterwards.
    """
    order = [ts, *(tie or [])]
    rest = [c for c in df.columns if c not in keys and c not in order]
    rows = df.withColumn(SLOT, slot(ts, slot_seconds))
    out = rows.withColumn(HALO, F.lit(0))
    for width, mark, ascending in ((before, -1, False), (after, 1, True)):
        if width == 0:
            continue
        ranked = Window.partitionBy(*keys, SLOT).orderBy(*[F.col(c).asc() if ascending else F.col(c).desc() for c in order])
        edge = (
            rows.withColumn("_rank", F.row_number().over(ranked))
            .where(F.col("_rank") <= width)
            .groupBy(*keys, SLOT)
            .agg(F.array_sort(F.collect_list(F.struct(*order, *rest))).alias("_edge"))
        )
        line = Window.partitionBy(*keys).orderBy(SLOT)
        line = line.rowsBetween(1, width) if ascending else line.rowsBetween(-width, -1)
        near = F.flatten(F.collect_list("_edge").over(line))
        start = F.lit(1) if ascending else F.greatest(F.size("_near") - width + 1, F.lit(1))
        halo = (
            edge.select(*keys, SLOT, near.alias("_near"))
            .where(F.size("_near") > 0)
            .select(*keys, SLOT, F.explode(F.slice("_near", start, F.lit(width))).alias("_row"))
            .select(*keys, SLOT, "_row.*", F.lit(mark).alias(HALO))
        )
        out = out.unionByName(halo)
    return out


def in_slot(keys: list[str], ts: str, tie: list[str] | None = None):
    """Window over one slot in time order."""
    return Window.partitionBy(*keys, SLOT).orderBy(ts, *(tie or []))


def group_starts(batch: pd.DataFrame, group: list[str], last: tuple | None) -> tuple[np.ndarray, tuple]:
    """Which rows of a batch of sorted rows begin a group, and the key of its last row; ``last`` is that of the batch before. Nulls of a key are equal."""
    begins = np.zeros(len(batch), dtype=bool)
    ends = []
    for c in group:
        codes, _ = pd.factorize(batch[c])  # null is -1
        begins[1:] |= codes[1:] != codes[:-1]
        ends.append([None if pd.isna(v) else v for v in batch[c].iloc[[0, -1]]])
    begins[0] = tuple(e[0] for e in ends) != last
    return begins, tuple(e[1] for e in ends)


def drop_halo(df: DataFrame) -> DataFrame:
    return df.where(F.col(HALO) == 0).drop(HALO, SLOT)


def prefix_sums(df: DataFrame, keys: list[str], order: list[str], sums: dict[str, Column], slot_col: str, totals: bool = False) -> DataFrame:
    """Running sums along an entity, slot by slot.

    ``slot_col`` must rise with ``order``. Sums run inside a slot and are
    lifted by the totals of the slots before it. With ``totals`` the
    entity-wide sum is added as ``<name>_total``.
    """
    part = df
    for name, value in sums.items():
        part = part.withColumn(f"_v_{name}", value)
    per_slot = part.groupBy(*keys, slot_col).agg(*[F.sum(f"_v_{n}").alias(f"_s_{n}") for n in sums])
    line = Window.partitionBy(*keys).orderBy(slot_col)
    lifted = per_slot.select(
        *keys,
        slot_col,
        *[F.coalesce(F.sum(f"_s_{n}").over(line.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias(f"_b_{n}") for n in sums],
        *([F.sum(f"_s_{n}").over(Window.partitionBy(*keys)).alias(f"{n}_total") for n in sums] if totals else []),
    )
    inside = Window.partitionBy(*keys, slot_col).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = part.select("*", *[F.sum(f"_v_{n}").over(inside).alias(f"_l_{n}") for n in sums])
    joined = local.join(lifted, [*keys, slot_col])
    return joined.select(
        *df.columns,
        *[(F.col(f"_b_{n}") + F.coalesce(F.col(f"_l_{n}"), F.lit(0))).alias(n) for n in sums],
        *([f"{n}_total" for n in sums] if totals else []),
    )


def exact_median(df: DataFrame, keys: list[str], value: str, name: str, width: float = 1.0) -> DataFrame:
    """Exact median per entity; nulls and NaN do not count.

    Equal values are counted before the shuffle; the distinct values are cut
    into slots ``width`` wide, so no task holds all values of an entity.
    """
    counts = df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double"))).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    counts = counts.withColumn(SLOT, F.floor(F.col(value) / F.lit(width)))
    ranked = prefix_sums(counts, keys, [value], {"_cum": F.col("_n")}, SLOT, totals=True)
    low = F.floor((F.col("_cum_total") + 1) / 2)
    high = F.floor(F.col("_cum_total") / 2) + 1

    def at(rank: Column) -> Column:
        return F.max(F.when((F.col("_cum") >= rank) & (F.col("_cum") - F.col("_n") < rank), F.col(value)))

    return ranked.groupBy(*keys).agg(((at(low) + at(high)) / 2).alias(name))
