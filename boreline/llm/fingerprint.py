"""Document fingerprints: quartile codes of hashed byte triplets, and a length.

Each window of five bytes gives a few triplets (the newest byte and two of the
four before it); a triplet is hashed to one of ``BUCKETS`` counters. The
quartiles of the counters turn each into two bits: below, between, above.
Beside the codes a fingerprint holds the logarithm of the length and the
ratios of the quartiles. ``likeness`` is one minus a bounded difference.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boreline.llm.rows import text_of
from boreline.session import stored

BUCKETS = 256
#: Distances of the two older bytes of each triplet from the newest one.
TRIPLETS = ((1, 2), (1, 3), (2, 3), (2, 4), (1, 4), (3, 4))
#: Bytes that are counted at once.
PART = 1 << 18
#: What the code distances 0 to 3 cost, and what a step of length or quartile ratio costs at most.
CODE_COST = np.array([0, 1, 2, 6])
LENGTH_COST, RATIO_COST = 12, 12
#: A code difference that counts as no likeness at all: half of the most that is possible.
MOST = BUCKETS * 3


def counts(data: bytes) -> np.ndarray:
    """How often each bucket is hit. Fewer than five bytes are padded with zeros."""
    total = np.zeros(BUCKETS, np.int64)
    data = data + bytes(5 - len(data)) if 0 < len(data) < 5 else data
    for start in range(0, max(0, len(data) - 4), PART):
        b = np.frombuffer(data, np.uint8, min(PART, len(data) - 4 - start) + 4, start).astype(np.uint32)
        n = len(b) - 4
        newest = b[4:] * np.uint32(0x9E3779B1)
        for salt, (near, far) in enumerate(TRIPLETS):
            code = newest + b[4 - near : 4 - near + n] * np.uint32(0x85EBCA77) + b[4 - far : 4 - far + n] * np.uint32(0xC2B2AE3D) + np.uint32(salt * 0x27D4EB2F & 0xFFFFFFFF)
            code ^= code >> np.uint32(15)
            code *= np.uint32(0x2C1B3C6D)
            total += np.bincount(code >> np.uint32(24), minlength=BUCKETS)
    return total


def fingerprint(text: str) -> str:
    """Header (length, two quartile ratios) and 64 bytes of codes, in hex; the same for equal texts.

    An empty text has the code 0 everywhere and length 0.
    """
    data = text.encode("utf-8", "surrogatepass")
    hit = counts(data)
    low, middle, high = (int(q) for q in np.sort(hit)[[BUCKETS // 4 - 1, BUCKETS // 2 - 1, BUCKETS * 3 // 4 - 1]])
    codes = (hit > low).astype(np.uint8) + (hit > middle) + (hit > high)
    packed = codes[0::4] | codes[1::4] << 2 | codes[2::4] << 4 | codes[3::4] << 6
    length = min(255, round(8 * math.log2(1 + len(data))))
    ratios = (min(255, 255 * low // high), min(255, 255 * middle // high)) if high else (0, 0)
    return bytes((length, *ratios)).hex() + packed.astype(np.uint8).tobytes().hex()


def likeness(left: str, right: str) -> float:
    """From 0 to 1; 1 for equal fingerprints."""
    if left == right:
        return 1.0
    a, b = (np.frombuffer(bytes.fromhex(f), np.uint8) for f in (left, right))
    header = np.abs(a[:3].astype(int) - b[:3].astype(int))
    cost = min(LENGTH_COST, int(header[0])) + min(RATIO_COST, int(header[1:].sum()) // 16)
    for shift in (0, 2, 4, 6):
        cost += int(CODE_COST[np.abs((a[3:] >> shift & 3).astype(int) - (b[3:] >> shift & 3).astype(int))].sum())
    return max(0.0, 1.0 - cost / (MOST + LENGTH_COST + RATIO_COST))


def edited(text: str, following: str) -> str:
    """The last half of the code points replaced by the first as many of the following text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _compare(text: str, following: str, own: str | None = None, other: str | None = None) -> tuple:
    changed = edited(text, following)
    own, after, other = own or fingerprint(text), fingerprint(changed), other or fingerprint(following)
    return len(text), hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(), own, after, likeness(own, after), likeness(own, other)


OUT = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def compare_with_next(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprint each text, and it again after an edit with the next document's text.

    The next document is the one below in descending key; after the last comes
    the first. Repeated keys follow each other in the order of their texts;
    rows without a key come last. Null texts are empty. A table of one row is
    its own next. Other columns are ignored.

    Texts are dealt out by ranges of the key once and sorted within each; a
    task holds two texts at a time. What a range cannot know is the first
    document of the one behind it, so it leaves its last row open and hands
    over its first: two rows per range, joined in a second small step.
    """
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    schema = _parse_datatype_string(OUT + ", place int, edge string, text string")
    arrow = to_arrow_schema(schema)
    place = {name: k for k, name in enumerate(arrow.names)}

    def run(batches):
        from pyspark import TaskContext

        number = TaskContext.get().partitionId()
        last = last_own = None
        held: list[tuple] = []

        def batch():
            out = pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*held, strict=True), arrow, strict=True)], schema=arrow)
            held.clear()
            return out

        def edge(kind, row):
            out = [None] * len(place)
            out[place["doc_id"]], out[place["place"]], out[place["edge"]], out[place["text"]] = row[0], number, kind, row[1]
            held.append(tuple(out))

        for part in batches:
            for row in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                own = fingerprint(row[1])
                if last is None:
                    edge("first", row)
                else:
                    held.append((last[0], *_compare(last[1], row[1], last_own, own), number, None, None))
                    if len(held) >= 500:
                        yield batch()
                last, last_own = row, own
        if last is not None:
            edge("last", last)
        if held:
            yield batch()

    rows = df.select(F.col(key).cast("bigint").alias("doc_id"), text_of(text).alias("text"))
    order = [F.col("doc_id").desc_nulls_last(), F.sha2("text", 256)]
    laid = rows.repartitionByRange(F.col("doc_id").desc_nulls_last()).sortWithinPartitions(*order)
    done = stored(laid.mapInArrow(run, schema), "fingerprints")

    from pyspark.sql import Window

    # One first and one last row for each range of keys.
    firsts = done.where("edge = 'first'").select("place", F.col("text").alias("following"))
    lasts = done.where("edge = 'last'").select("place", "doc_id", "text")
    ranges = firsts.select("place").withColumn("before", F.lag("place").over(Window.orderBy("place")))
    ranges = ranges.withColumn("before", F.coalesce("before", F.max("place").over(Window.partitionBy(F.lit(1)))))
    pairs = lasts.join(ranges.select(F.col("place").alias("behind"), F.col("before").alias("place")), "place")
    pairs = pairs.join(firsts.withColumnRenamed("place", "behind"), "behind").select("doc_id", "text", "following")

    def close(batches):
        for part in batches:
            for key_, own, following in zip(*(c.to_pylist() for c in part.columns), strict=True):
                values = (key_, *_compare(own, following))
                yield pa.RecordBatch.from_arrays([pa.array([v], type=f.type) for v, f in zip(values, list(arrow)[: len(values)], strict=True)], names=arrow.names[: len(values)])

    names = list(place)[:7]
    return done.where("edge is null").select(*names).unionByName(pairs.mapInArrow(close, OUT))


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_with_next(spark.read.parquet(f"{sf_dir}/documents.parquet"))
