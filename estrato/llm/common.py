"""What the text operators share: session settings, row identity, Arrow access to texts."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from estrato.workspace import RESULT_SETTINGS

# A Python task holds one Arrow batch at a time; few rows a batch keep long texts in bounds.
BATCH_ROWS = 512

# The white space that separates words in the contracts of the queries.
SPACE = " \t\n\v\f\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def arrow_ready(df: DataFrame) -> DataFrame:
    """The frame, with its session set up for small Arrow batches."""
    conf = df.sparkSession.conf
    conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    for key, value in RESULT_SETTINGS.items():
        conf.set(key, value)
    return df


def map_batches(
    df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], ddl
) -> DataFrame:
    return arrow_ready(df).mapInArrow(fn, ddl)


def row_key(doc_id: Column, text: Column) -> Column:
    """64 bits that name a row by content; only repeated rows share one."""
    return F.xxhash64(doc_id, text)


class Texts:
    """The UTF-8 bytes of one Arrow column of strings, without decoding; null is empty."""

    def __init__(self, column: pa.Array):
        column = column.cast(pa.large_string()).fill_null("")
        _, offsets, data = column.buffers()
        at = column.offset
        self.ends = np.frombuffer(offsets, np.int64)[at : at + len(column) + 1]
        self.data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)

    def __len__(self) -> int:
        return len(self.ends) - 1

    def __getitem__(self, i: int) -> np.ndarray:
        return self.data[self.ends[i] : self.ends[i + 1]]


def record(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=f.type) for c, f in zip(columns, schema)], schema=schema
    )


_TYPES = {
    "long": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(),
    "string": T.StringType(), "binary": T.BinaryType(), "boolean": T.BooleanType(),
}


def fields(names: str) -> list[T.StructField]:
    """Fields from "name type, ..." of plain types; needs no session."""
    return [T.StructField(n, _TYPES[t]) for n, t in (x.split() for x in names.split(","))]
