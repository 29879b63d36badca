"""Near-duplicate documents: MinHash bands, signature and set verification, components.

1. One pass over the texts gives each document the size and digest of its
   shingle set and a signature of ``bands * rows`` universal hash minima.
   Documents of equal sets are one class from here on.
2. Classes that share a band are candidates, unless the size of one set alone
   rules the pair out. In each bucket the class with the most company leads;
   the others are compared with it only: signatures first, then whole sets.
   This links most groups, without pairs inside a bucket.
3. Buckets that still hold several components are compared in full. Those of
   two classes are pairs: each is compared once, however many bands it shares,
   and not again if step 2 did it on whole sets. Larger ones are compared in
   blocks of bounded size: a block pair gets the whole sets of two blocks and
   counts all intersections with a matrix product over the shingles that occur
   more than once in it. It returns at most one link per pair of components.

Only a pair that shares no band escapes: (1 - s^rows)^bands for similarity s,
5e-6 at 0.75. Everything that is linked is linked on whole sets.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from boreline.llm.components import components
from boreline.llm.rows import drop_stored, map_rows, text_of
from boreline.session import stored

SHINGLE = 5
BANDS, ROWS = 32, 4
PERCENT = 75
#: Signatures that agree less than this cannot be expected from a pair at the limit: 4.5 standard deviations below it.
SLACK = 4.5
#: A block holds about so many classes and shingles at most.
BLOCK_CLASSES, BLOCK_SHINGLES = 512, 400_000
#: Bits of the map of classes whose texts are read again: 2^24, two megabytes.
MAP_BITS = 24
#: Words kept with their hash in one Python worker.
CACHE_ENTRIES = 150_000
#: Columns of a block's matrix that are multiplied at once.
COLUMNS = 4096

_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xFF51AFD7ED558CCD)


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        code = xxhash.xxh3_64_intdigest(word)
        if len(self) < CACHE_ENTRIES:
            self[word] = code
        return code


def shingle_set(text: str, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles.

    Words are runs of other than the six ASCII white-space characters, with
    A-Z in lower case: what ``bytes.lower`` and ``bytes.split`` do. Fewer than
    ``SHINGLE`` words are one shingle, none give an empty set.
    """
    words = text.encode("utf-8", "surrogatepass").lower().split()
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    codes = np.fromiter(map(hashes.__getitem__, words), np.uint64, n)
    width = min(n, SHINGLE)
    with np.errstate(over="ignore"):
        out = np.full(n - width + 1, np.uint64(width), np.uint64)
        for k in range(width):
            out = out * _STEP + codes[k : n - width + 1 + k]
        out ^= out >> np.uint64(32)
        out *= _MIX
        out ^= out >> np.uint64(29)
    return np.unique(out)


def _coefficients(count: int) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(5)
    return random.integers(1, 2**31, count, dtype=np.uint32) * np.uint32(2) + np.uint32(1), random.integers(0, 2**32, count, dtype=np.uint32)


def signature(shingles: np.ndarray, factors: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """The minimum of each universal hash x -> factor * x + shift over the set."""
    folded = (shingles ^ (shingles >> np.uint64(32))).astype(np.uint32)
    least = np.full(len(factors), 0xFFFFFFFF, np.uint32)
    for k in range(0, len(folded), 512):
        np.minimum(least, (folded[k : k + 512, None] * factors + shifts).min(axis=0), out=least)
    return least


def sketches(df: DataFrame, key: str, text: str, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``key``, ``n_shingles``, ``set_key`` (digest of the set) and ``sig``; one row per input row."""
    factors, shifts = _coefficients(bands * rows)

    def make():
        hashes = WordHashes()

        def work(keys, texts):
            sizes, digests, signatures = [], [], []
            for t in texts:
                found = shingle_set(t, hashes)
                sizes.append(len(found))
                digests.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest() if len(found) else None)
                signatures.append(signature(found, factors, shifts).view(np.int32) if len(found) else None)
            return [keys, sizes, digests, signatures]

        return work

    kind = dict(df.dtypes)[key]
    return map_rows(df.select(F.col(key), text_of(text)), f"`{key}` {kind}, n_shingles bigint, set_key binary, sig array<int>", make)


def _whole_sets(df: DataFrame, key: str, text: str) -> DataFrame:
    def make():
        hashes = WordHashes()

        def work(keys, texts):
            return [keys, [shingle_set(t, hashes).tobytes() for t in texts]]

        return work

    return map_rows(df.select(F.col(key), text_of(text)), "rep bigint, shingles binary", make)


def _probable(df: DataFrame, reps: DataFrame) -> DataFrame:
    """The rows of ``df`` whose ``rep`` may be in ``reps``: all that are, few others.

    Spares a join the shuffle of the other rows' texts. The bit map has a fixed
    size whatever the number of reps; the join behind it decides.
    """
    place = F.pmod(F.xxhash64("rep"), F.lit(1 << MAP_BITS)) + 1
    parts = reps.select(place.alias("place")).groupBy(F.bitmap_bucket_number("place").alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits")).collect()
    marks = np.zeros((1 << MAP_BITS) // 8, np.uint8)
    for r in parts:
        size = len(r.bits)
        marks[(r.part - 1) * size : r.part * size] = np.frombuffer(r.bits, np.uint8)

    @F.pandas_udf("boolean")
    def marked(places: pd.Series) -> pd.Series:
        at = places.to_numpy(np.int64) - 1
        return pd.Series((marks[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1)

    return df.where(F.col("rep").isNotNull()).where(marked(place))


def _among(df: DataFrame, reps: DataFrame) -> DataFrame:
    """The rows of ``df`` whose ``rep`` is in ``reps``.

    Never by a broadcast: the shuffle sets the Python of ``_probable`` apart
    from that of the caller. In one task they would need two workers at once,
    and an executor keeps idle workers with all their memory.
    """
    return _probable(df, reps).join(reps.select("rep").hint("merge"), "rep", "left_semi")


def _fits(left: str, right: str, percent: int) -> Column:
    """Whether sets of these sizes can be similar enough: the smaller one lies in the larger one at best."""
    return 100 * F.least(left, right) >= percent * F.greatest(left, right)


def _agree(left: np.ndarray, right: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(left, right, assume_unique=True))
    return 100 * both >= percent * (len(left) + len(right) - both)


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) whose whole sets are similar enough."""

    def make():
        def work(us, vs, lefts, rights):
            good = [k for k, (a, b) in enumerate(zip(lefts, rights, strict=True)) if _agree(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64), percent)]
            return [[us[k] for k in good], [vs[k] for k in good]]

        return work

    both = pairs.join(sets.toDF("u", "left"), "u").join(sets.toDF("v", "right"), "v").select("u", "v", "left", "right")
    return map_rows(both, "u bigint, v bigint", make)


def _links_in_block(percent: int):
    def found(block: pd.DataFrame) -> pd.DataFrame:
        block = block.drop_duplicates(["rep", "shingles"])
        if block["component"].nunique() < 2:
            return pd.DataFrame({"u": [], "v": []}, dtype="int64")
        sets = [np.frombuffer(s, np.uint64) for s in block["shingles"]]
        sizes = np.array([len(s) for s in sets])
        owner = np.repeat(np.arange(len(sets)), sizes)
        _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        shared = times[column] > 1
        owner, column = owner[shared], column[shared]
        order = np.argsort(column, kind="stable")
        owner, column = owner[order], column[order]
        _, column = np.unique(column, return_inverse=True)
        both = np.zeros((len(sets), len(sets)), np.float32)
        for first in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
            a, b = np.searchsorted(column, [first, first + COLUMNS])
            part = np.zeros((len(sets), COLUMNS), np.float32)
            part[owner[a:b], column[a:b] - first] = 1
            both += part @ part.T
        of = block["component"].to_numpy()
        near = 100 * both >= percent * (sizes[:, None] + sizes[None, :] - both)
        near &= of[:, None] < of[None, :]
        a, b = np.nonzero(near)
        return pd.DataFrame({"u": of[a], "v": of[b]}).drop_duplicates()

    return found


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", bands: int = BANDS, rows: int = ROWS, percent: int = PERCENT) -> DataFrame:
    """``key``, ``n_shingles``, ``component_id`` and ``kept`` for every row.

    Rows are linked where ``100 * intersection >= percent * union`` holds for
    their sets of five-word shingles; ``component_id`` is the smallest key
    that can be reached. Null, empty and blank texts have no set and stand
    alone. A row without a key is not linked, has a null component and is
    kept. Repeated rows share their component; rows of one key with different
    texts are told apart by their texts. Columns beside key and text are
    ignored. The key is an integer.
    """
    spark = df.sparkSession
    base = df.select(F.col(key).cast("bigint").alias("rep"), F.col(text).alias("text"))
    full = stored(sketches(base, "rep", "text", bands, rows), "sketches")
    classes = stored(full.where("n_shingles > 0 and rep is not null").groupBy("set_key").agg(F.min("rep").alias("rep"), F.first("n_shingles").alias("n"), F.first("sig").alias("sig")), "classes")
    # Signatures are kept once, with the classes, and only until their pairs are known.
    sketch = stored(full.select("rep", "n_shingles", "set_key"), "slim")
    drop_stored(spark, full)
    named = stored(classes.select("set_key", "rep"), "named")

    cut = [F.xxhash64(F.lit(k), F.slice("sig", k * rows + 1, rows)) for k in range(bands)]
    banded = classes.select("rep", "n", F.explode(F.array(*cut)).alias("band"))
    shared = stored(banded.groupBy("band").agg(F.count(F.lit(1)).alias("company")).where("company > 1"), "shared-bands")
    together = stored(banded.join(shared, "band"), "together")
    # Most buckets hold two classes, and many of those are of sizes that cannot be alike.
    unlike = together.where("company = 2").groupBy("band").agg(F.min("n").alias("least"), F.max("n").alias("most")).where(~_fits("least", "most", percent))
    members = stored(together.join(unlike.select("band"), "band", "left_anti"), "members")
    company = stored(members.groupBy("rep").agg(F.sum("company").alias("weight")), "company")
    lead = F.max(F.struct("weight", (-F.col("rep")).alias("low"), F.col("n").alias("lead_n"))).alias("lead")
    leaders = stored(members.join(company, "rep").groupBy("band").agg(lead).select("band", (-F.col("lead.low")).alias("v"), "lead.lead_n"), "leaders")
    star = members.join(leaders, "band").where((F.col("rep") != F.col("v")) & _fits("n", "lead_n", percent)).select(F.col("rep").alias("u"), "v").distinct()

    signs = classes.select("rep", "sig").join(company.select("rep"), "rep", "left_semi")
    least = percent / 100 - SLACK * (percent / 100 * (1 - percent / 100) / (bands * rows)) ** 0.5
    same = F.size(F.filter(F.zip_with("left", "right", lambda a, b: a == b), lambda x: x))
    alike = star.join(signs.toDF("u", "left"), "u").join(signs.toDF("v", "right"), "v").where(same >= least * bands * rows).select("u", "v")
    alike = stored(alike, "alike")
    # Whole sets once for every class that has company: the stars read some of them, mixed buckets others.
    sets = stored(_whole_sets(_among(base, company), "rep", "text"), "sets")
    for used in (classes, shared, together, leaders):
        drop_stored(spark, used)
    found = stored(_linked(alike, sets, percent), "links")
    tied = stored(components(found), "tied")

    placed = members.join(tied.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    mixed = placed.groupBy("band").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.sum("n").alias("total"), F.count(F.lit(1)).alias("many"), F.min("rep").alias("u"), F.max("rep").alias("v")
    )
    mixed = stored(mixed.where("low < high").drop("low", "high"), "mixed")
    compared = alike.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
    lone = mixed.where("many = 2").select("u", "v").distinct().join(compared, ["u", "v"], "left_anti")
    rest = stored(_linked(lone, sets, percent), "lone-links")
    blocks = F.greatest(F.ceil(F.col("many") / BLOCK_CLASSES), F.ceil(F.col("total") / BLOCK_SHINGLES)).cast("int")
    own = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    other = F.explode(F.expr("sequence(0, blocks - 1)"))
    dealt = placed.join(mixed.where("many > 2").select("band", blocks.alias("blocks")), "band").withColumn("own", own).select("band", "rep", "component", "own", other.alias("other"))
    dealt = dealt.select("band", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "rep", "component")
    filled = dealt.join(sets, "rep").select("band", "i", "j", "rep", "component", "shingles")
    more = stored(filled.groupBy("band", "i", "j").applyInPandas(_links_in_block(percent), "u bigint, v bigint"), "more-links")
    whole = stored(components(found.unionByName(rest).unionByName(more)), "components")

    home = named.join(whole.withColumnRenamed("node", "rep"), "rep", "left").select("set_key", F.coalesce("component", "rep").alias("component_id"))
    home = stored(home, "class-components")
    for used in (named, members, company, alike, sets, found, tied, mixed, rest, more, whole):
        drop_stored(spark, used)
    out = sketch.join(home, "set_key", "left").select(
        F.col("rep").alias(key), "n_shingles", F.when(F.col("rep").isNotNull(), F.coalesce("component_id", "rep")).alias("component_id")
    )
    return out.withColumn("kept", F.coalesce(F.col(key) == F.col("component_id"), F.lit(True)))


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
