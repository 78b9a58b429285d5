"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Callable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

# Results depend on these.
RESULT_SETTINGS = {"spark.sql.session.timeZone": "UTC", "spark.sql.ansi.enabled": "true"}

SETTINGS = {
    **RESULT_SETTINGS,
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}

OWN_DIR = "spark.estrato.dir"
_block: ContextVar[list[str] | None] = ContextVar("scratch tables of a block", default=None)


def build_session(app: str = "estrato", **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: `spark.checkpoint.dir`, or where that is unset
    the session's own `spark.estrato.dir`. One of the two is required."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(OWN_DIR, None)
    if not named:
        raise RuntimeError(f"set spark.checkpoint.dir (or {OWN_DIR}) to a shared folder")
    return f"{named.rstrip('/')}/estrato/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder, removed by an enclosing `temporary_tables`."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    block = _block.get()
    if block is not None:
        block.append(path)
    return path


def freeze(df: DataFrame, label: str) -> DataFrame:
    """Write once, read back: a columnar cut of the lineage that outlives executors."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> bool:
    """Delete a file or folder in whatever store holds it; False where there was none."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    there = jvm.org.apache.hadoop.fs.Path(path)
    return there.getFileSystem(conf).delete(there, True)


@contextmanager
def temporary_tables(spark: SparkSession) -> Iterator[None]:
    """Delete, on leaving the block, the scratch tables that were written inside it.

    Use it where everything built in the block has been written elsewhere. Every block has
    a list of its own; jobs submitted with `together` belong to the block they come from.
    """
    block: list[str] = []
    outer = _block.set(block)
    try:
        yield
    finally:
        _block.reset(outer)
        for path in block:
            remove(spark, path)


@contextmanager
def lasting_tables() -> Iterator[None]:
    """Scratch tables written inside outlive any enclosing `temporary_tables`."""
    outer = _block.set(None)
    try:
        yield
    finally:
        _block.reset(outer)


def together(spark: SparkSession, tasks: Mapping[str, Callable[[], object]]) -> dict[str, object]:
    """Submit independent jobs at once, so that small tables fill the gaps of large ones.

    Every task is waited for; the first failure is then raised. What earlier jobs
    shuffled is removed before and after.
    """
    release_shuffles(spark)
    with ThreadPoolExecutor(max_workers=max(len(tasks), 1)) as pool:
        waiting = {
            name: pool.submit(copy_context().run, inheritable_thread_target(spark)(task))
            for name, task in tasks.items()
        }
    done = {name: future.result() for name, future in waiting.items()}
    release_shuffles(spark)
    return done


def release_shuffles(spark: SparkSession) -> None:
    """Let executors delete the shuffle files of plans that nothing refers to any more.

    Spark deletes them when the driver's JVM has collected the plan. A driver that plans much
    less than its executors shuffle collects seldom, and files of finished jobs pile up.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def small_frame(spark: SparkSession, rows: list[tuple], ddl: str) -> DataFrame:
    """A handful of driver values as a frame, without starting Python workers."""
    schema = T.StructType.fromDDL(ddl)
    frames = [
        spark.range(0, 1, 1, 1).select(
            *[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, schema.fields)]
        )
        for row in rows
    ]
    whole = frames[0]
    for frame in frames[1:]:
        whole = whole.unionByName(frame)
    return whole
