"""Benchmark decontamination by templates.

Numbers, names and units of a text become typed placeholders, so a question
with other numbers or names has the same template. Windows of ``WINDOW``
template tokens are hashed and joined with the benchmark's. A document is
contaminated by an item if enough of the item's windows are in it and what
stood in the placeholders maps consistently: one value of the item to one of
the document, and back. Where other copies in the same document contradict
that, each region of the document is judged by itself.

A bit map of the benchmark's window hashes, of a fixed size whatever the
benchmark's, spares the shuffle windows that cannot match. It only lets too
much pass; the join decides.
"""

from __future__ import annotations

import re

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from boreline.llm.rows import drop_stored, map_rows, table, text_of
from boreline.session import stored

WINDOW = 5
#: Tokens of a window that are no placeholders, at least.
LITERALS = 3
#: Share of an item's windows, number of them (or all), and share of consistent slots.
MIN_SHARE, MIN_WINDOWS, MIN_CONSISTENT = 0.5, 8, 0.75
#: A short item, of fewer windows than this, may instead have this share of its tokens in one region; a long one may have a run of windows.
SHORT, SHORT_SHARE, RUN = 2 * MIN_WINDOWS, 0.5, 32
#: Widths of the bands of neighbouring alignments that may be one copy.
DRIFTS = (4, 16)
#: Bits of the map of window hashes: 2^22, half a megabyte.
MAP_BITS = 22
CACHE_ENTRIES = 100_000

# Units of measure, and what may stand around a word.
UNITS = frozenset("mm cm m km inch inches ft feet mile miles mg g kg t lb lbs oz ml l s sec secs second seconds min mins minute minutes h hr hour hours day days week weeks year years % percent usd eur $ € £ dollars euros cents °c °f".split())
EDGE = ".,;:!?\"'()[]{}<>«»„“”‘’…-–—*#&$%|"
NUMBER = re.compile(r"[+-]?[$€£]?\d[\d.,:/]*(?:e[+-]?\d+)?%?")
STOPS = (".", "!", "?", ":", "…")

_NUM, _NAME, _UNIT = (np.uint64(c) for c in (0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3))
#: Sets windows of exact words apart.
_EXACT = np.uint64(0x589965CC75374CC3)
_STEP, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xFF51AFD7ED558CCD)


class Tokens(dict):
    """What is known of a word by itself: hash, flags (kept, number, capitalised, unit, ends a sentence)."""

    def __missing__(self, word: str) -> tuple[int, int]:
        core = word.strip(EDGE)
        number = bool(NUMBER.fullmatch(core)) or bool(core and NUMBER.fullmatch(word.strip(",;:!?.\"'()")))
        lower = core.lower()
        capital = core[:1].isupper() and core[1:].islower()
        flags = bool(core) | number << 1 | (capital and not number) << 2 | (lower in UNITS or word in UNITS) << 3 | word.rstrip("\"'”»)]").endswith(STOPS) << 4
        known = (xxhash.xxh3_64_intdigest(lower.encode("utf-8", "surrogatepass")), flags)
        if len(self) < CACHE_ENTRIES:
            self[word] = known
        return known


def template(text: str, tokens: Tokens) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """The words that count, their own codes, their slot kinds (0 none, 1 number, 2 name, 3 unit), and where a line's first word may be a name or not."""
    words, starts = [], []
    for line in text.split("\n"):
        starts.append(len(words))
        words += line.split()
    if not words:
        return [], np.empty(0, np.uint64), np.empty(0, np.int8), np.empty(0, bool)
    known = list(map(tokens.__getitem__, words))
    codes = np.fromiter((k[0] for k in known), np.uint64, len(known))
    flags = np.fromiter((k[1] for k in known), np.int8, len(known))
    opens = np.concatenate(([True], (flags[:-1] & 16) > 0))
    after_number = np.concatenate(([False], (flags[:-1] & 2) > 0))
    slots = np.zeros(len(words), np.int8)
    slots[(flags & 4 > 0) & ~opens] = 2
    slots[(flags & 8 > 0) & after_number] = 3
    slots[flags & 2 > 0] = 1
    either = np.zeros(len(words), bool)
    either[[k for k in starts if k < len(words)]] = True
    either &= (flags & 4 > 0) & (slots != 3)
    keep = (flags & 1) > 0
    if not keep.all():
        words = [w for w, k in zip(words, keep, strict=True) if k]
        codes, slots, either = codes[keep], slots[keep], either[keep]
    return words, codes, slots, either


def windows(codes: np.ndarray, width: int = WINDOW) -> np.ndarray:
    """Hash of the window at each place."""
    n = len(codes) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        out = np.zeros(n, np.uint64)
        for k in range(width):
            out = out * _STEP + codes[k : k + n]
        out ^= out >> np.uint64(32)
        out *= _MIX
        out ^= out >> np.uint64(29)
    return out


def _sums(marks: np.ndarray, width: int = WINDOW) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(marks)))
    return total[width:] - total[:-width]


def readings(codes: np.ndarray, slots: np.ndarray, either: np.ndarray):
    """Hashes, whether there are enough literal tokens, and slots: by the text alone, and with the first words of lines read the other way."""
    seen = windows(np.choose(slots, (codes, _NUM, _NAME, _UNIT)))
    yield seen, _sums(slots == 0)[: len(seen)] >= LITERALS, slots
    if either.any() and len(seen):
        other = np.where(either, 2 - slots, slots).astype(np.int8)
        yield windows(np.choose(other, (codes, _NUM, _NAME, _UNIT))), (_sums(other == 0) >= LITERALS) & (_sums(either) > 0), other


def _benchmark_windows(df: DataFrame, key: str, text: str) -> DataFrame:
    """``item``, ``window``, ``part`` (the window by the text alone), ``at``, ``width``, ``values``, ``exact``.

    An item without a window of enough literal tokens, or shorter than one,
    has windows of its exact words instead.
    """

    def make():
        tokens = Tokens()

        def work(keys, texts):
            out = ([], [], [], [], [], [], [])

            def add(k, found, named, places, width, slots, words):
                out[0].extend([k] * len(places))
                out[1].extend(found[places].view(np.int64).tolist())
                out[2].extend(named[places].view(np.int64).tolist())
                out[3].extend(places.tolist())
                out[4].extend([width] * len(places))
                out[5].extend([_values(words, slots, i) if slots is not None else [] for i in places.tolist()])
                out[6].extend([slots is None] * len(places))

            for k, t in zip(keys, texts, strict=True):
                words, codes, slots, either = template(t, tokens)
                named = None
                for hashes, good, kinds in readings(codes, slots, either):
                    if named is None:
                        named, by_itself = hashes, good
                    add(k, hashes, named, np.flatnonzero(good & by_itself), WINDOW, kinds, words)
                if not by_itself.any() and words:
                    width = min(len(words), WINDOW)
                    hashes = windows(codes ^ _EXACT, width)
                    add(k, hashes, hashes, np.arange(len(hashes)), width, None, words)
            return list(out)

        return work

    rows = df.where(F.col(key).isNotNull()).select(F.col(key).cast("bigint").alias("key"), text_of(text))
    return map_rows(rows, "item bigint, window bigint, part bigint, at bigint, width int, values array<string>, exact boolean", make)


def _values(words: list[str], slots: np.ndarray, i: int) -> list[str]:
    return [f"{slots[j]}{words[j].strip(EDGE).lower()}" for j in range(i, i + WINDOW) if slots[j]]


def _windows(df: DataFrame, key: str, text: str, bits: bytes, exact: list[int]) -> DataFrame:
    """``key``, ``window``, ``at`` (word number), ``values`` (what stands in its slots) of the windows in the bit map; also windows of exact words, of the widths asked for."""

    def make():
        tokens = Tokens()
        allowed = np.unpackbits(np.frombuffer(bits, np.uint8)).astype(bool)

        def work(keys, texts):
            out = ([], [], [], [])

            def add(k, hashes, places, slots, words):
                out[0].extend([k] * len(places))
                out[1].extend(hashes[places].view(np.int64).tolist())
                out[2].extend(places.tolist())
                out[3].extend([_values(words, slots, i) if slots is not None else [] for i in places.tolist()])

            for k, t in zip(keys, texts, strict=True):
                words, codes, slots, either = template(t, tokens)
                for hashes, good, kinds in readings(codes, slots, either):
                    add(k, hashes, np.flatnonzero(good & allowed[hashes >> np.uint64(64 - MAP_BITS)]), kinds, words)
                for width in exact:
                    hashes = windows(codes ^ _EXACT, width)
                    add(k, hashes, np.flatnonzero(allowed[hashes >> np.uint64(64 - MAP_BITS)]), None, words)
            return list(out)

        return work

    rows = df.where(F.col(key).isNotNull()).select(F.col(key).cast("bigint").alias("key"), text_of(text))
    return map_rows(rows, "key bigint, window bigint, at bigint, values array<string>", make)


def _pairs(theirs: str, ours: str) -> Column:
    return F.zip_with(theirs, ours, lambda x, y: F.struct(x.alias("theirs"), y.alias("ours")))


def _consistent(pairs: DataFrame, *by: str) -> DataFrame:
    """Share of the values of ``theirs`` and ``ours`` that map one to one; of two claims on a value the rarer is inconsistent."""
    pairs = pairs.select(*by, "pair.theirs", "pair.ours").distinct().groupBy(*by)
    return pairs.agg((F.least(F.count_distinct("theirs"), F.count_distinct("ours")) / F.count(F.lit(1))).alias("consistent"))


def _regions(met: DataFrame, asked: DataFrame, sizes: DataFrame) -> DataFrame:
    """One row per (document, item) that some region of the document leaks.

    A copy of an item lies on one alignment (place in the document less place
    in the item), or on neighbouring ones where its names have more or fewer
    words. Values are compared inside a region, so other copies of the
    template, and other places of a window in the item, do not contradict.
    """
    spots = met.drop("width").join(asked.select("item", "window", "part", "spots"), ["item", "window", "part"]).select("key", "item", "part", "at", "values", F.explode("spots").alias("spot"))
    shift = F.col("at") - F.col("spot.at")
    bands = [F.struct(F.lit(0).alias("width"), shift.alias("band"))]
    bands += [F.struct(F.lit(2 * width + half).alias("width"), F.floor((shift + half * width // 2) / width).alias("band")) for width in DRIFTS for half in (0, 1)]
    spots = spots.select("key", "item", "part", "at", F.col("spot.at").alias("theirs"), F.col("spot.width").alias("width"), F.col("spot.place").alias("place"), _pairs("spot.values", "values").alias("pairs"), F.explode(F.array(*bands)).alias("region"))
    by = ["key", "item", "region"]
    places = spots.groupBy(*by, "theirs").agg(F.min("part").alias("part"), F.min("place").alias("place"), F.min("width").alias("width"), F.min("at").alias("first"), F.max("at").alias("last"))
    order = Window.partitionBy(*by).orderBy("theirs")
    places = places.withColumn("new", F.coalesce(F.least("width", F.col("theirs") - F.lag("theirs").over(order)), "width")).withColumn("island", F.col("place") - F.row_number().over(order))
    places = places.withColumn("run", F.count(F.lit(1)).over(Window.partitionBy(*by, "island")))
    areas = places.groupBy(*by).agg(F.count_distinct("part").alias("matched"), F.sum("new").alias("covered"), F.max("run").alias("run"), F.min("first").alias("first_word"), F.max(F.col("last") + F.col("width") - 1).alias("last_word"))
    slots = _consistent(spots.select(*by, F.explode("pairs").alias("pair")), *by)
    short = (F.col("windows") < SHORT) & (F.col("covered") >= SHORT_SHARE * F.col("tokens")) & (F.col("matched") >= F.least(F.lit(2), F.col("windows")))
    areas = areas.join(sizes, "item").where(_enough() | short | (F.col("run") >= RUN))
    areas = areas.join(slots, by, "left").withColumn("consistent", F.coalesce("consistent", F.lit(1.0))).where(F.col("consistent") >= MIN_CONSISTENT)
    best = F.max(F.struct("matched", "consistent", -F.col("region.width"), (-F.col("first_word")).alias("before"), "last_word", "windows")).alias("best")
    return areas.groupBy("key", "item").agg(best).select("key", "item", "best.matched", "best.windows", "best.consistent", (-F.col("best.before")).alias("first_word"), "best.last_word")


def _enough() -> Column:
    return (F.col("matched") >= MIN_SHARE * F.col("windows")) & (F.col("matched") >= F.least(F.lit(MIN_WINDOWS), F.col("windows")))


def contaminated(df: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per document and item that it leaks.

    A document leaks an item as a whole, or in one of its regions (see
    ``_regions``). Columns: the key, the item's key, ``matched`` and
    ``windows`` (distinct windows found, and of the item), ``share``,
    ``consistent`` (share of slot values that map one to one; 1 without
    slots), ``first_word`` and ``last_word`` (place in the document). Null and
    empty texts and rows without a key leak nothing. An item without a window
    of its template, one of a single word too, is looked for by its exact
    words. Repeated rows change nothing; rows of one key with different texts
    count as one document. Both tables may be empty; other columns are ignored.
    """
    spark = df.sparkSession
    raw = stored(_benchmark_windows(benchmark, item_key, item_text), "benchmark-spots")
    # Places of an item, numbered; other readings of a place have its number.
    places = raw.groupBy("item", "at").agg(F.min("part").alias("part"), F.min("width").alias("width"))
    order = Window.partitionBy("item").orderBy("at")
    places = places.withColumn("place", F.row_number().over(order)).withColumn("new", F.coalesce(F.least("width", F.col("at") - F.lag("at").over(order)), "width"))
    sizes = stored(places.groupBy("item").agg(F.count_distinct("part").alias("windows"), F.sum("new").alias("tokens")), "item-sizes")
    spots = raw.join(places.select("item", "at", "place"), ["item", "at"])
    asked = stored(spots.groupBy("item", "window", "part").agg(F.collect_set(F.struct("at", "place", "width", "values")).alias("spots"), F.min("values").alias("asked"), F.max("width").alias("width")), "benchmark-windows")
    marks = np.zeros(1 << MAP_BITS, bool)
    marks[[r.place for r in asked.select(F.expr(f"shiftrightunsigned(window, {64 - MAP_BITS})").cast("int").alias("place")).distinct().toLocalIterator()]] = True
    exact = [r.width for r in raw.where("exact").select("width").distinct().collect()]
    found = _windows(df, key, text, np.packbits(marks).tobytes(), exact)
    met = stored(found.join(asked.drop("spots"), "window").select("key", "item", "window", "part", "at", "width", "values", "asked"), "window-matches")
    counted = met.groupBy("key", "item", "part").agg(F.min("at").alias("first"), F.max(F.col("at") + F.col("width") - 1).alias("last"))
    counted = counted.groupBy("key", "item").agg(F.count(F.lit(1)).alias("matched"), F.min("first").alias("first_word"), F.max("last").alias("last_word"))
    pairs = met.where(F.size("asked") > 0).select("key", "item", F.explode(_pairs("asked", "values")).alias("pair"))
    # What may be enough in a region: two windows of a short item, a run of a long one.
    likely = counted.join(sizes, "item").where(_enough() | (F.col("matched") >= F.when(F.col("windows") < SHORT, F.least(F.lit(2), "windows")).otherwise(RUN)))
    judged = likely.join(_consistent(pairs, "key", "item"), ["key", "item"], "left").withColumn("consistent", F.coalesce("consistent", F.lit(1.0)))
    judged = stored(judged.withColumn("whole", _enough() & (F.col("consistent") >= MIN_CONSISTENT)), "judged")
    whole = judged.where("whole")
    doubtful = judged.where("not whole").select("key", "item")
    parts = _regions(met.join(doubtful, ["key", "item"], "left_semi"), asked, sizes)
    out = whole.select(*parts.columns).unionByName(parts)
    out = out.select(F.col("key").alias(key), F.col("item").alias(item_key), "matched", "windows", (F.col("matched") / F.col("windows")).alias("share"), "consistent", "first_word", "last_word")
    out = stored(out, "contaminated")
    for used in (raw, sizes, asked, met, judged):
        drop_stored(spark, used)
    return out


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
