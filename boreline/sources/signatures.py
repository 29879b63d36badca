"""Change signatures over source rows and over whole populations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.clean import number_text, time_text


def signature_text(df: DataFrame, column: str) -> Column:
    kind = dict(df.dtypes)[column]
    if kind.startswith("timestamp"):
        text = time_text(column)
    elif kind == "double":
        text = number_text(column)
    else:
        text = F.col(column).cast("string")
    return F.coalesce(text, F.lit(""))


def source_signature(df: DataFrame, version: str, columns: list[str]) -> Column:
    """SHA-256 over the version and the columns, null as empty text."""
    return F.sha2(F.concat_ws("|", F.lit(version), *[signature_text(df, c) for c in columns]), 256)


def population_signature(df: DataFrame, version: str, keys: list[str], signature: str) -> DataFrame:
    """One digest of a whole population of signed rows.

    Each member is digested with its key; the digests are then added up as
    numbers. Addition does not depend on order, so Spark combines partial sums
    before the shuffle and no list of members is ever built.
    """
    member = F.sha2(F.concat_ws("|", *[signature_text(df, c) for c in (*keys, signature)]), 256)
    words = [F.conv(F.substring("_member", 1 + 15 * i, 15), 16, 10).cast("decimal(20,0)") for i in range(4)]
    sums = [F.coalesce(F.sum(w), F.lit(0).cast("decimal(30,0)")).cast("string").alias(f"_w{i}") for i, w in enumerate(words)]
    totals = df.select(member.alias("_member")).agg(F.count(F.lit(1)).alias("population_size"), *sums)
    text = F.concat_ws("|", F.lit(version), F.col("population_size").cast("string"), *[F.col(f"_w{i}") for i in range(4)])
    return totals.select(F.sha2(text, 256).alias("population_signature"), "population_size")


# --- signature trees --------------------------------------------------------

TREE = ["rows", "d0", "d1"]
_SIZE = 1 << 60


def _digests(df: DataFrame, columns: list[str]) -> list[Column]:
    """Two 60-bit numbers of a row's columns, null as empty text."""
    member = F.md5(F.concat_ws("|", *[signature_text(df, c) for c in columns]))
    return [F.conv(F.substring(member, 1 + 15 * k, 15), 16, 10).cast("decimal(38,0)") for k in range(2)]


def _added(df: DataFrame, keys: list[str]) -> DataFrame:
    sums = [(F.sum(d) % F.lit(_SIZE)).cast("bigint").alias(d) for d in TREE[1:]]
    return df.groupBy(*keys).agg(F.sum("rows").cast("bigint").alias("rows"), *sums)


def signature_tree(df: DataFrame, path: list[str], columns: list[str]) -> DataFrame:
    """A signature of every entity on a path such as fleet, pad, well, stage.

    One row per entity: ``level`` (0 for the whole table), the path's columns
    (null below the entity's own), ``rows``, and two sums of its rows' digests
    modulo 2^60. Sums do not depend on order and count repeated rows, each
    level is added up from the one below, and rows are read once.
    """
    leaf = df.select(*path, F.lit(1).cast("bigint").alias("rows"), *[d.alias(n) for d, n in zip(_digests(df, columns), TREE[1:])])
    level = _added(leaf.withColumns({n: F.col(n).cast("decimal(38,0)") for n in TREE[1:]}), path)
    levels = [level]
    for k in range(len(path) - 1, -1, -1):
        level = _added(level.withColumns({n: F.col(n).cast("decimal(38,0)") for n in TREE[1:]}), path[:k])
        levels.append(level)
    out = None
    for k, level in zip(range(len(path), -1, -1), levels):
        shaped = level.select(F.lit(k).alias("level"), *[(F.col(c) if i < k else F.lit(None).cast(df.schema[c].dataType)).alias(c) for i, c in enumerate(path)], *TREE)
        out = shaped if out is None else out.unionByName(shaped)
    return out


def _of(tree: DataFrame, level: int, keys: list[str], tag: str) -> DataFrame:
    return tree.where(F.col("level") == level).select(*[F.col(c).alias(f"{tag}_{c}") for c in [*keys, *TREE]])


def changed_entities(old: DataFrame, new: DataFrame, path: list[str]) -> DataFrame:
    """The path's last entities that were added, changed or lost: their columns and ``change``.

    The trees are compared from the top; of each level only the children of
    what differs are looked at. A tree that is partitioned by ``level`` is so
    read along the changed paths, but for the filter on their parents.
    """
    open_ = None
    for level in range(len(path) + 1):
        keys = path[:level]
        a, b = _of(old, level, keys, "a"), _of(new, level, keys, "b")
        if open_ is not None and level > 1:
            parents = open_.select(*[F.col(c).alias(f"p_{c}") for c in path[: level - 1]])
            a, b = (side.join(parents, same_key([(f"{t}_{c}", f"p_{c}") for c in path[: level - 1]]), "left_semi") for side, t in ((a, "a"), (b, "b")))
        both = a.join(b, same_key([(f"a_{c}", f"b_{c}") for c in keys]) if keys else F.lit(True), "full")
        differs = ~F.struct(*[f"a_{c}" for c in TREE]).eqNullSafe(F.struct(*[f"b_{c}" for c in TREE]))
        change = F.when(F.col("a_rows").isNull(), "added").when(F.col("b_rows").isNull(), "lost").otherwise("changed")
        open_ = both.where(differs).select(*[F.coalesce(f"a_{c}", f"b_{c}").alias(c) for c in keys], change.alias("change"))
    return open_


def same_key(pairs: list[tuple[str, str]]) -> Column:
    out = F.lit(True)
    for a, b in pairs:
        out = out & F.col(a).eqNullSafe(F.col(b))
    return out


def moved_tree(tree: DataFrame, old_leaves: DataFrame, new_leaves: DataFrame, path: list[str]) -> DataFrame:
    """The rows of the tree that change when leaves are replaced: every ancestor by the difference of its leaves.

    ``old_leaves`` and ``new_leaves`` are rows of the last level, before and
    after. Nothing but the changed paths is read; entities that have no rows
    left come with ``rows`` 0.
    """
    signed = None
    for leaves, sign in ((old_leaves, -1), (new_leaves, 1)):
        side = leaves.select(*path, *[(F.col(c).cast("decimal(38,0)") * sign).alias(c) for c in TREE])
        signed = side if signed is None else signed.unionByName(side)
    out = None
    for k in range(len(path), -1, -1):
        keys = path[:k]
        delta = signed.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in TREE]).select(F.lit(k).alias("level"), *[(F.col(c) if i < k else F.lit(None).cast(tree.schema[c].dataType)).alias(c) for i, c in enumerate(path)], *TREE)
        out = delta if out is None else out.unionByName(delta)
    names = [c for c in ("level", *path)]
    was = tree.select(*[F.col(c).alias(f"w_{c}") for c in [*names, *TREE]])
    both = out.join(was, same_key([(c, f"w_{c}") for c in names]), "left")
    total = {c: F.col(c) + F.coalesce(F.col(f"w_{c}").cast("decimal(38,0)"), F.lit(0)) for c in TREE}
    return both.select(*names, total["rows"].cast("bigint").alias("rows"), *[F.pmod(total[c], F.lit(_SIZE).cast("decimal(38,0)")).cast("bigint").alias(c) for c in TREE[1:]])
