"""Marts over Bronze tables that follow their versions by the changed rows alone."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F, types as T

from estrato.model import MART_LOG, Table
from estrato.operators import deltas
from estrato.operators.increment import MICROS
from estrato.plans import bronze
from estrato.sources import buckets
from estrato.sources.lake import Lake
from estrato.workspace import freeze

MARTS = "marts"


def changes_since(lake: Lake, table: Table, manifest: str) -> tuple[DataFrame, DataFrame]:
    """Images before and after of the rows changed since a version.

    Only buckets that differ are read. Their new rows are those stamped later than the old
    version; the old images are the rows of the same keys in the buckets it held.
    """
    schema = bronze.stored_schema(table)
    old = buckets.read_version(lake.spark, manifest, lake.buckets)
    new = buckets.read_version(lake.spark, _newest(lake, table), lake.buckets)
    moved = {i for i, part in new.parts.items() if old.parts.get(i) != part}
    mark = max((p.changed for p in old.parts.values()), default=-(1 << 62))
    timed = T.StructType([*schema.fields, T.StructField(MICROS, T.LongType())])
    after = buckets.read_buckets(lake.spark, new.paths(moved), timed)
    after = after.filter(F.col(MICROS) > mark).drop(MICROS)
    before = buckets.read_buckets(lake.spark, old.paths(moved), schema)
    return before.join(after.select(table.key), table.key, "left_semi"), after


def _newest(lake: Lake, table: Table) -> str | None:
    return bronze.versions(lake, table).agg(F.max_by("ruta", "id_log")).first()[0]


def refresh(lake: Lake, table: Table, name: str, mart: deltas.Mart) -> DataFrame:
    """Brings a stored mart up to the current version of its table and returns it.

    The first call builds it. Later ones read the stored mart and the changed rows; the table
    itself is read for the groups whose maximum may have fallen, and not at all for marts of
    sums. A mart becomes current through its log row, which names the version it shows.
    """
    log = lake.read_or_empty("logs", MARTS, MART_LOG).filter(F.col("mart") == name)
    last = log.agg(F.max_by(F.struct("manifiesto", "ruta"), "id_log")).first()[0]
    newest = _newest(lake, table)
    if last is not None and last["manifiesto"] == newest:
        return lake.spark.read.parquet(last["ruta"])
    path = f"{lake.path('marts', name)}/{uuid.uuid4().hex}"
    if last is None:
        deltas.build(bronze.current(lake, table), mart).write.parquet(path)
    else:
        stored = lake.spark.read.parquet(last["ruta"])
        before, after = changes_since(lake, table, last["manifiesto"])
        marked = deltas.changed(stored, mart, before, after)
        if mart.maxima:
            marked = freeze(marked, "mart")
        fact = bronze.current(lake, table) if mart.maxima else None
        deltas.repaired(marked, mart, fact).write.parquet(path)
    lake.log_row(MARTS, MART_LOG, (name, table.name, newest, path))
    return lake.spark.read.parquet(path)
