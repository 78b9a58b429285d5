"""Landing files: typed CSV and JSON, in and out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from estrato.model import Table


def _tolerant(schema: T.StructType) -> T.StructType:
    """Whole numbers are read as decimals first: `561.0` is not a valid integer text."""
    swap = {"int": T.DecimalType(12, 2), "bigint": T.DecimalType(22, 2)}
    return T.StructType(
        [T.StructField(f.name, swap.get(f.dataType.simpleString(), f.dataType)) for f in schema]
    )


def _typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


# Blanks around a text are data; Spark's writer would trim them.
CSV = {
    "header": "true",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "quote": '"',
    "escape": '"',
}


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType, multiline: bool = False
) -> DataFrame:
    """Header row, optional UTF-8 byte-order mark, empty fields as NULL.

    Columns go by the names in the header, whatever their order; a missing one is an error,
    others are left out. All files of a folder have the header of the first: one that differs
    stops the read instead of giving columns the wrong values. Quotes inside a quoted field are doubled. Fields with line breaks
    need `multiline`, at the price that a file is then read by one task.
    """
    options = {**CSV, "multiLine": str(multiline).lower()}
    header = spark.read.options(**options).csv(path).columns
    known = {f.name.lower(): f for f in _tolerant(schema)}
    missing = known.keys() - {name.lstrip("\ufeff").lower() for name in header}
    if missing:
        raise ValueError(f"{path} has no column {', '.join(sorted(missing))}")
    text = T.StringType()
    found = [known.get(name.lstrip("\ufeff").lower(), T.StructField(name, text)) for name in header]
    # Under the names of the header, which Spark then compares with every file.
    named = T.StructType([T.StructField(n, f.dataType) for n, f in zip(header, found)])
    raw = spark.read.schema(named).options(**options, mode="FAILFAST", enforceSchema="false")
    return _typed(raw.csv(path).toDF(*[f.name for f in found]), schema)


def read_json(
    spark: SparkSession, path: str, schema: T.StructType, lines: bool = True
) -> DataFrame:
    """JSON lines, as `write_json` writes them. `lines=False` reads one array of records per
    file, which a single task must parse. Dates may carry a midnight time part."""
    raw = spark.read.schema(_tolerant(schema)).option("multiLine", not lines)
    return _typed(raw.option("mode", "FAILFAST").json(path), schema)


def to_date_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Text dates to DATE; texts that are no date become NULL."""
    return df.withColumns({c: _date(F.col(c)) for c in columns})


def _date(text: Column) -> Column:
    return text.try_cast("date")


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(**CSV).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    """JSON lines."""
    df.write.mode("overwrite").json(path)


def read_landing(
    spark: SparkSession, folder: str, table: Table, fmt: str = "csv", lines: bool = True
) -> DataFrame:
    """One landed table; `lines` is the layout of JSON files (see `read_json`)."""
    path = f"{folder}/{table.name}.{fmt}"
    if fmt == "csv":
        return read_csv(spark, path, table.schema)
    return read_json(spark, path, table.schema, lines)
