"""Removal of repeated passages by line and sentence hashing.

Units are the lines of a text, cut into sentences, so that a passage put into
the middle of a line is found too. A unit is normalised (lower case, white
space runs to one space) and hashed; digests are grouped over all documents,
and the occurrence of lowest (document, offset) stays. A passage is a run of
neighbouring units that have all been seen before, whatever their own length,
so that verse, lists and narrow lines count too. It is removed if it has
``MIN_CHARS`` characters: short lines recur in unrelated texts. Each removal
keeps its place in the original text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from boreline.llm.rows import drop_stored, fresh, map_rows, text_of
from boreline.session import stored

#: Characters of a passage at least, in its normalised form.
MIN_CHARS = 120
#: A sentence ends behind its marks: before white space, or at once where none is written.
SENTENCE = re.compile(r"(?=\S)[^\n]*?(?:[.!?]+(?=\s)|[\u3002\uff01\uff1f]+|$)", re.MULTILINE)


def units(text: str) -> Iterator[tuple[int, int]]:
    """Start and end of every sentence of every line, in order; offsets in code points."""
    return (m.span() for m in SENTENCE.finditer(text))


def normal(text: str) -> str:
    return " ".join(text.lower().split())


def hashed_units(df: DataFrame, key: str, text: str) -> DataFrame:
    """One row per unit: ``doc``, ``mark`` (digest of the text), ``seq``, ``start``, ``end``, ``chars``, ``digest``."""

    def make():
        def work(keys, marks, texts):
            out = ([], [], [], [], [], [], [])
            for k, mark, t in zip(keys, marks, texts, strict=True):
                for seq, (start, end) in enumerate(units(t)):
                    unit = normal(t[start:end])
                    for column, value in zip(out, (k, mark, seq, start, end, len(unit), xxhash.xxh3_128_digest(unit.encode("utf-8", "surrogatepass"))), strict=True):
                        column.append(value)
            return list(out)

        return work

    rows = df.where(F.col(key).isNotNull()).select(F.col(key).cast("bigint"), F.xxhash64(text_of(text)), text_of(text))
    return map_rows(rows, "doc bigint, mark bigint, seq int, start int, end int, chars int, digest binary", make)


def repeated_passages(df: DataFrame, key: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """What to remove: ``doc_id``, ``mark``, ``start``, ``end``, ``units``, ``first_doc_id``, ``first_start``, ``copies``.

    One row per passage; ``first_*`` is where its first unit stays, ``copies``
    how often the rarest of its units occurs. ``mark`` (xxhash64 of the text)
    tells rows of one key with different texts apart. Null and empty texts
    have no units; rows without a key are not looked at; a repeated row
    repeats itself, and its second copy, which has the same place, counts in
    ``copies`` but cannot be told from the first and stays. Other columns are
    ignored.

    Digests are counted within tasks before they are shuffled. Only repeated
    ones are joined with the units again, from a written table, so that AQE
    can split the rows of a digest that a third of all documents share. Of a
    document its repeated units meet in one task, numbers without text.
    """
    spark = df.sparkSession
    found = stored(hashed_units(df, key, text), "units")
    place = F.struct("doc", "mark", "start")
    groups = found.groupBy("digest").agg(F.min(place).alias("first"), F.max(place).alias("last"), F.count(F.lit(1)).alias("copies"))
    groups = stored(groups.where("copies > 1 and first != last").drop("last"), "repeated-units")
    gone = found.join(groups, "digest").where(place != F.col("first")).select("doc", "mark", "seq", "start", "end", "chars", "first", "copies").distinct()
    line = Window.partitionBy("doc", "mark").orderBy("seq")
    runs = gone.withColumn("run", F.col("seq") - F.row_number().over(line))
    out = runs.groupBy("doc", "mark", "run").agg(
        F.min("start").cast("bigint").alias("start"), F.max("end").cast("bigint").alias("end"), F.count(F.lit(1)).alias("units"), F.min(F.struct("seq", "first")).alias("opening"), F.min("copies").alias("copies"),
        (F.sum("chars") + F.count(F.lit(1)) - 1).alias("chars"),
    )
    out = out.where(F.col("chars") >= min_chars)
    out = stored(out.select(F.col("doc").alias(key), "mark", "start", "end", "units", F.col("opening.first.doc").alias("first_doc_id"), F.col("opening.first.start").cast("bigint").alias("first_start"), "copies"), "passages")
    drop_stored(spark, found)
    drop_stored(spark, groups)
    return out


def op7_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def without_passages(df: DataFrame, removed: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with the removed spans cut out of their texts; the spans of a document are cut in one go."""
    name = fresh(df, "spans")
    spans = removed.groupBy(F.col(key).alias("_key"), F.col("mark").alias("_mark")).agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias(name))

    @F.pandas_udf("string")
    def cut(texts: pd.Series, spans: pd.Series) -> pd.Series:
        out = []
        for value, own in zip(texts, spans, strict=True):
            if own is not None:
                at, parts = 0, []
                for span in own:
                    parts.append(value[at : span["start"]])
                    at = max(at, span["end"])
                value = "".join(parts) + value[at:]
            out.append(value)
        return pd.Series(out, dtype="object")

    same = (F.col(key) == F.col("_key")) & (F.xxhash64(text_of(text)) == F.col("_mark"))
    return df.join(spans, same, "left").withColumn(text, F.when(F.col(name).isNull(), F.col(text)).otherwise(cut(text_of(text), F.col(name)))).select(*df.columns)
