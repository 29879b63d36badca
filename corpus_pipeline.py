"""A corpus in five stages: toxicity, line dedup, near-dedup, decontamination, encoding.

Each stage reads what the one before kept and returns the columns of
``documents`` (the last one its own). Decisions are made by row, so a null
text or key is no reason to drop a document, and repeated rows get the same
decision; only near-dedup keeps one of rows that are equal in key and text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from boreline.llm import bpe, decontam, linededup, minhash, toxicity
from boreline.llm.rows import fresh
from boreline.session import stored


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score less than 0.5 by a model learned from the labelled ones among them."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.where(toxicity.score_column(model, F.col("text")) < 0.5)


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the lines that recur; ``n_chars`` follows. Documents of such lines alone are whole copies, which the next stage sees to."""
    out = linededup.without_recurring_lines(docs, keep_copies=True)
    changed = F.when(F.col("n_dropped") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return out.withColumn("n_chars", changed).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each group, and all without an id."""
    kept = minhash.near_duplicates(docs).where("kept and doc_id is not null").groupBy("doc_id").agg((F.count(F.lit(1)) > 1).alias("again"))
    kept = stored(kept, "kept")
    # Rows of a key that stands alone need no second look; of the others, one of those that are equal in text stays.
    alone = docs.join(kept.where("not again"), "doc_id", "left_semi")
    copy = fresh(docs, "copy")
    first = F.row_number().over(Window.partitionBy("doc_id", F.xxhash64("text")).orderBy("source", "lang"))
    named = docs.join(kept.where("again"), "doc_id", "left_semi").withColumn(copy, first).where(F.col(copy) == 1)
    return alone.unionByName(named.drop(copy)).unionByName(docs.where("doc_id is null")).select(*docs.columns)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    leaks = decontam.contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return docs.join(leaks.select("doc_id").distinct(), "doc_id", "left_anti").select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of what is left."""
    return bpe.encode_decode(docs, bpe.default_vocabulary())


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_boilerplate),
    ("MinHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_leaks),
    ("BPE encoding and decoding", encode),
]
#: A learned model decides in the first stage, which SQL cannot express.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage over ``documents``, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
