"""Resampling a corpus towards a target by importance weights of hashed n-grams.

Each document is an array of feature counts over a fixed number of buckets. A
bucket's gain says how much likelier it is in the target than in the corpus; a
document's weight is the mean gain of its features. With Gumbel noise from a
hash of its key added, the highest scores are a sample without replacement.

The cutoff is found without sorting the corpus: a quantile sketch brackets it,
exact counts beyond the bracket validate the bracket or widen it, and only the
rows inside are sorted. Drawn rows get their places from a sort by ranges, so
no task holds all of them.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from boreline.llm.rows import STEP, drop_stored, map_rows, table, text_of
from boreline.session import stored

BUCKETS = 10_000
PERCENT = 25
MIN_WORDS = 20
SEED = 7
#: The sketch's rank error is one of so many parts of the rows; the bracket is a few times that.
ACCURACY = 2_000
#: Words kept with their checksums in one Python worker, and words that are hashed at once.
CACHED_WORDS, CHUNK_WORDS = 400_000, 300_000
#: Bytes of a text that are cut into words at once.
PIECE = 1 << 21
#: Words of more bytes are hashed one by one.
TABLED = 48

#: A-Z become a-z; what is no digit, letter or byte of a character beyond ASCII becomes a space.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def shift_tables() -> np.ndarray:
    """What ``n`` further bytes do to each byte of a CRC-32, by ``n``: checksums are linear."""
    out = np.empty((TABLED + 1, 4, 256), np.uint32)
    for n in range(TABLED + 1):
        zeros = bytes(n)
        none = zlib.crc32(zeros, 0)
        for k in range(4):
            out[n, k] = [zlib.crc32(zeros, v << (8 * k)) ^ none for v in range(256)]
    return out


class Words(dict):
    """Numbers of the words seen; for each its checksum, that of the word and a space, and its length."""

    def __init__(self):
        super().__init__()
        self.words: list[bytes] = []
        self.sums, self.spaced, self.lengths = (np.empty(1 << 12, np.uint32) for _ in range(3))

    def __missing__(self, word: bytes) -> int:
        self[word] = k = len(self.words)
        if k == len(self.sums):
            self.sums, self.spaced, self.lengths = (np.concatenate((a, np.empty_like(a))) for a in (self.sums, self.spaced, self.lengths))
        self.words.append(word)
        self.sums[k] = plain = zlib.crc32(word)
        self.spaced[k], self.lengths[k] = zlib.crc32(b" ", plain), len(word)
        return k

    def forget(self) -> None:
        self.clear()
        self.words.clear()


class Features:
    """The hashed features of texts: all words, and all pairs of neighbours joined by a space."""

    def __init__(self, buckets: int = BUCKETS):
        self.buckets, self.known, self.tables = np.uint32(buckets), Words(), shift_tables()

    def of(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """In parts: bucket and row of each feature, and the rows of the words."""
        words: list[bytes] = []
        runs: list[tuple[int, int, bool]] = []  # row, words, whether the first one has been counted before
        for row, text in enumerate(texts):
            data, start, last = text.encode("utf-8", "surrogatepass").translate(WORD_BYTES), 0, []
            while start < len(data):
                cut = data.find(b" ", start + PIECE) if len(data) - start > PIECE else -1
                found = data[start : cut if cut >= 0 else len(data)].split()
                if found:
                    words += last + found
                    runs.append((row, len(last) + len(found), bool(last)))
                    last = found[-1:]
                if len(words) >= CHUNK_WORDS:
                    yield self._hashed(words, runs)
                    words, runs = [], []
                start = cut if cut >= 0 else len(data)
        if runs:
            yield self._hashed(words, runs)

    def _hashed(self, words: list[bytes], runs: list[tuple[int, int, bool]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        known = self.known
        if len(known) > CACHED_WORDS:
            known.forget()
        codes = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
        rows, sizes, seen = (np.array(c) for c in zip(*runs, strict=True))
        ends = np.cumsum(sizes)
        row = np.repeat(rows, sizes)
        fresh = np.ones(len(codes), bool)
        fresh[(ends - sizes)[seen]] = False
        pairs = np.ones(len(codes), bool)
        pairs[ends - 1] = False
        left = np.nonzero(pairs)[0]
        before, after = known.spaced[codes[left]], codes[left + 1]
        size = known.lengths[after]
        long = size > TABLED
        size = np.where(long, 0, size)
        both = known.sums[after]
        for k in range(4):
            both = both ^ self.tables[size, k, (before >> np.uint32(8 * k)) & np.uint32(255)]
        for k in np.nonzero(long)[0]:
            both[k] = zlib.crc32(known.words[after[k]], int(before[k]))
        sums = np.concatenate((known.sums[codes[fresh]], both))
        return (sums % self.buckets).astype(np.int64), np.concatenate((row[fresh], row[left])), row[fresh]


def bucket_counts(df: DataFrame, text: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """Features in each bucket over all texts. Tasks count first; the driver gets a row for each bucket."""

    def run(batches):
        features, total = Features(buckets), np.zeros(buckets, np.int64)
        for batch in batches:
            for start in range(0, batch.num_rows, STEP):
                for found, _, _ in features.of(batch.column(0).slice(start, STEP).to_pylist()):
                    total += np.bincount(found, minlength=buckets)
        at = np.nonzero(total)[0]
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], names=["bucket", "n"])

    counted = df.select(text_of(text)).mapInArrow(run, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for row in counted.collect():
        out[row.bucket] = row.n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of smoothed shares, rounded down."""
    n = float(len(source))
    s, t = float(source.sum()) + n, float(target.sum()) + n
    return np.array([math.floor(1000 * math.log((float(b) + 1) * s / ((float(a) + 1) * t))) for a, b in zip(source.tolist(), target.tolist(), strict=True)], np.int64)


def weights(df: DataFrame, gain: np.ndarray, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``n_words``, ``n_features`` and ``weight``, the mean gain rounded down, of every row."""
    sent = df.sparkSession.sparkContext.broadcast(gain.astype(np.float64))

    def make():
        features, gain = Features(len(sent.value)), sent.value

        def work(keys, texts):
            n_words, n, total = (np.zeros(len(texts), np.int64) for _ in range(3))
            for found, row, words in features.of(texts):
                n_words += np.bincount(words, minlength=len(texts))
                n += np.bincount(row, minlength=len(texts))
                # Sums of whole numbers are exact in doubles.
                total += np.bincount(row, gain[found], minlength=len(texts)).astype(np.int64)
            return [keys, n_words, n, total // np.maximum(n, 1)]

        return work

    return map_rows(df.select(F.col(key).cast("bigint"), text_of(text)), f"`{key}` bigint, n_words bigint, n_features bigint, weight bigint", make)


def gumbel(key: str, seed: int) -> Column:
    """Thousandths of Gumbel noise, from a hash of the key; a null key counts as an empty one."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("bigint")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0)))


def places(df: DataFrame, *order: Column) -> DataFrame:
    """``place``, from 1, of each row in the order. Rows are dealt by ranges; only row counts of tasks are added up in one place."""
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    # The number has the task in its upper bits and the row within it in the 33 lower ones.
    numbered = stored(ranged.withColumn("place", F.monotonically_increasing_id()), "places").withColumn("part", F.shiftright("place", 33))
    parts = numbered.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = numbered.join(parts.select("part", before.alias("before")), "part")
    return placed.select(*df.columns, (F.col("place").bitwiseAND((1 << 33) - 1) + F.col("before") + 1).alias("place"))


def bracket(df: DataFrame, value: str, k: int, n: int, accuracy: int = ACCURACY) -> tuple[int, int, int]:
    """Two values between which the ``k``-th highest of ``n`` lies, and how many rows lie above them."""
    middle, margin = (n - k + 0.5) / n, 2 / accuracy
    while True:
        shares = [max(0.0, middle - margin), min(1.0, middle + margin)]
        low, high = df.agg(F.percentile_approx(value, shares, accuracy)).first()[0]
        if margin >= 1:
            low, high = df.agg(F.min(value), F.max(value)).first()
        above, inside = df.agg(F.count(F.when(F.col(value) > high, 1)), F.count(F.when(F.col(value).between(low, high), 1))).first()
        if above < k <= above + inside:
            return low, high, above
        margin *= 4


def drawn(df: DataFrame, k: int, n: int, key: str, accuracy: int = ACCURACY) -> Column:
    """Whether a row of ``score``, key and ``row`` is among the ``k`` first: high scores, small keys, no key last."""
    low, high, above = bracket(df, "score", k, n, accuracy)
    inside = places(df.where(F.col("score").between(low, high)).select("score", key, "row"), *_order(key))
    last = inside.where(F.col("place") == k - above).first()
    drop_stored(df.sparkSession, inside)
    same = F.col("row") <= last["row"]
    if last[key] is None:
        tie = F.col(key).isNotNull() | same
    else:
        tie = F.coalesce((F.col(key) < last[key]) | ((F.col(key) == last[key]) & same), F.lit(False))
    return (F.col("score") > last["score"]) | ((F.col("score") == last["score"]) & tie)


def _order(key: str) -> list[Column]:
    return [F.col("score").desc(), F.col(key).asc_nulls_last(), F.col("row").asc()]


def importance_ranks(
    df: DataFrame,
    target: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    percent: int = PERCENT,
    min_words: int = MIN_WORDS,
    seed: int = SEED,
    buckets: int = BUCKETS,
    accuracy: int = ACCURACY,
) -> DataFrame:
    """``key``, ``n_words``, ``n_features``, ``weight``, ``score`` and ``rank`` of every row; ``rank`` is null where a row is not drawn.

    Of the rows with ``min_words`` words, ``percent`` in a hundred are drawn,
    rounded down. Null and empty texts have no features, weight 0 and are
    never drawn (if a word is asked for). Rows of equal score are ranked by
    key, those without a key last; repeated rows, whose scores are equal, are
    ranked in any order and count one by one. An empty table gives no row; an
    empty target gives smoothed shares. Other columns are ignored. The key is
    an integer.
    """
    spark = df.sparkSession
    gain = gains(bucket_counts(df, text, buckets), bucket_counts(target, text, buckets))
    scored = weights(df, gain, key, text).withColumn("score", F.col("weight") + gumbel(key, seed))
    scored = stored(scored.withColumn("row", F.monotonically_increasing_id()), "scores")
    able = F.col("n_words") >= min_words
    n = scored.where(able).count()
    k = percent * n // 100
    columns = [key, "n_words", "n_features", "weight", "score"]
    if not k:
        return scored.select(*columns, F.lit(None).cast("bigint").alias("rank"))
    chosen = able & drawn(scored.where(able), k, n, key, accuracy)
    first = places(scored.where(chosen), *_order(key)).select(*columns, F.col("place").alias("rank"))
    return first.unionByName(scored.where(~chosen).select(*columns, F.lit(None).cast("bigint").alias("rank")))


def resampled(df: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """The rows that are drawn, with all their columns; a row without a key is drawn if one with its score is."""
    ranks = importance_ranks(df, target, key, text, **how).where("rank is not null")
    ranks = stored(ranks.select(F.col(key).alias("drawn")).distinct(), "drawn")
    return df.join(ranks, F.col(key).cast("bigint").eqNullSafe(F.col("drawn")), "left_semi")


def op12_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = importance_ranks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return ranks.select("doc_id", "n_features", "weight", "score", "rank")


ORACLE = rf"""
WITH crc AS (SELECT list(list_reduce([v, 1, 2, 3, 4, 5, 6, 7, 8], lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) ORDER BY v) AS t FROM range(256) r(v)),
texts AS (
  SELECT 's' AS side, row_number() OVER () AS n, doc_id, coalesce(text, '') AS text FROM documents
  UNION ALL SELECT 't', 0, item_id, coalesce(text, '') FROM benchmark),
words AS (SELECT side, n, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts),
features AS (SELECT side, n, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM words),
counted AS (SELECT side, n, f, count(*) AS c FROM features GROUP BY ALL),
bytes AS (SELECT f, hex(encode(f)) AS h FROM (SELECT DISTINCT f FROM counted)),
buckets AS (
  SELECT f, xor(list_reduce(list_prepend(4294967295, list_transform(range(0, len(h) // 2), lambda i: ('0x' || h[2 * i + 1:2 * i + 2])::BIGINT)), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % {BUCKETS} AS bucket
  FROM bytes, crc),
filled AS (SELECT bucket, coalesce(sum(c) FILTER (side = 's'), 0)::DOUBLE AS s, coalesce(sum(c) FILTER (side = 't'), 0)::DOUBLE AS t FROM counted JOIN buckets USING (f) GROUP BY 1),
gain AS (SELECT bucket, floor(1000 * ln((t + 1) * ((SELECT sum(s) FROM filled) + {BUCKETS}) / ((s + 1) * ((SELECT sum(t) FROM filled) + {BUCKETS}))))::BIGINT AS g FROM filled),
summed AS (SELECT n, sum(c)::BIGINT AS n_features, floor(sum(c * g) / sum(c))::BIGINT AS weight FROM counted JOIN buckets USING (f) JOIN gain USING (bucket) WHERE side = 's' GROUP BY 1),
scored AS (
  SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, len(w) AS n_words,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('{SEED}:' || coalesce(doc_id::VARCHAR, ''))[:8])::BIGINT + 0.5) / 4294967296)))::BIGINT AS score
  FROM words LEFT JOIN summed USING (n) WHERE side = 's'),
ranked AS (SELECT *, CASE WHEN n_words >= {MIN_WORDS} THEN row_number() OVER (PARTITION BY n_words >= {MIN_WORDS} ORDER BY score DESC, doc_id) END AS place FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= (SELECT count(*) * {PERCENT} // 100 FROM scored WHERE n_words >= {MIN_WORDS}) THEN place END AS rank FROM ranked
"""
