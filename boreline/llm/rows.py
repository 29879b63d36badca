"""Row helpers that the operators of this folder share."""

from __future__ import annotations

import re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: Rows handed to a row function at once; bounds what a Python worker holds besides one Arrow batch.
STEP = 128


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def map_rows(df: DataFrame, schema: StructType | str, make: Callable[[], Callable[..., list]]) -> DataFrame:
    """``make()`` runs once per task and returns a function from columns to columns.

    The function gets one Python list per input column, a few rows long, and
    returns one list per output column. Lists of another length than the input
    are fine: the function may emit any number of rows.
    """
    from pyspark.sql.types import _parse_datatype_string

    out = _parse_datatype_string(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(out)

    def run(batches):
        work = make()
        for batch in batches:
            for start in range(0, batch.num_rows, STEP):
                part = batch.slice(start, STEP)
                columns = work(*[c.to_pylist() for c in part.columns])
                if columns and len(columns[0]):
                    yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    return df.mapInArrow(run, out)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that the table does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_of(column: str = "text") -> Column:
    """A null text counts as an empty one."""
    return F.coalesce(F.col(column), F.lit(""))


def drop_stored(spark: SparkSession, df: DataFrame) -> None:
    """Delete a table written by ``stored`` that nothing will read again."""
    for file in df.inputFiles()[:1]:
        folder = re.match(r"(.*/boreline/(?:[^/]+/)*[^/]+-[0-9a-f]{32})/", file)
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder[1])
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
