"""Marts from changed rows, distinct counts from bitmaps, checks of a fact in one scan."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from estrato import model
from estrato.operators import bitmaps, checks, deltas
from estrato.operators.upsert import Batch
from estrato.plans import bronze, marts
from estrato.sources import buckets
from estrato.sources.lake import Lake

T = model.Table("t", "t", "k", "k bigint, g string, v decimal(18,2), d int")
SUMS = deltas.Mart(("g",), {"total": "v", "positivos": "CASE WHEN d > 0 THEN 1 END"})
MAXIMA = deltas.Mart(("g",), {"total": "v"}, {"peor": "d", "ultimo": "k"})


def batch(n):
    return Batch(dt.datetime(2026, 1, n, 8), f"b{n}", "core")


def states(n, seed=1):
    """Batches of random rows: new ones, changed ones, groups that appear and empty out."""
    rnd = random.Random(seed)
    for _ in range(n):
        keys = rnd.sample(range(40), 25)
        yield [
            (k, rnd.choice(["a", "b", None, "c"]), rnd.choice([None, 1, 5, -2]),
             rnd.choice([None, 0, 3, 9])) for k in keys
        ]


@pytest.mark.parametrize("mart", [SUMS, MAXIMA])
def test_marts_from_changes_equal_a_full_rebuild(spark, folder, mart):
    lake = Lake(spark, folder, buckets=3)
    for n, data in enumerate(states(4), 1):
        source = spark.createDataFrame(
            [(k, g, None if v is None else Decimal(v), d) for k, g, v, d in data], T.schema)
        bronze.ingest(lake, T, source, batch(n))
        if n == 3:
            continue  # two batches at once
        kept = marts.refresh(lake, T, "m", mart)
        assert rows(kept) == rows(deltas.build(bronze.current(lake, T), mart))
    assert rows(marts.refresh(lake, T, "m", mart)) == rows(kept)


def test_a_falling_maximum_and_an_emptied_group(spark):
    ddl = "k bigint, g string, v decimal(18,2), d int"
    old = spark.createDataFrame([(1, "a", None, 9), (2, "a", None, 3), (3, "b", None, 4)], ddl)
    new = spark.createDataFrame([(1, "a", None, 1), (2, "a", None, 3), (3, "a", None, 4)], ddl)
    stored = deltas.build(old, MAXIMA)
    marked = deltas.changed(stored, MAXIMA, old.filter("k <> 2"), new.filter("k <> 2"))
    assert {r.g: r["__fell_peor"] for r in marked.collect()} == {"a": True}
    assert rows(deltas.repaired(marked, MAXIMA, new)) == rows(deltas.build(new, MAXIMA))


def test_a_mart_of_sums_reads_changed_buckets_and_not_the_table(spark, folder, monkeypatch):
    lake = Lake(spark, folder, buckets=8)
    whole = spark.range(2000).selectExpr(
        "id AS k", "cast(id % 5 AS string) AS g", "cast(1 AS decimal(18,2)) AS v", "1 AS d")
    bronze.ingest(lake, T, whole, batch(1))
    marts.refresh(lake, T, "m", SUMS)
    bronze.ingest(lake, T, whole.filter("k = 7").withColumn("v", F.lit(3).cast("decimal(18,2)")),
                  batch(2))
    read = []
    real = buckets.read_buckets
    monkeypatch.setattr(
        buckets, "read_buckets", lambda s, paths, schema: read.append(paths) or real(s, paths, schema)
    )
    kept = {r.g: r.total for r in marts.refresh(lake, T, "m", SUMS).collect()}
    assert [len(paths) for paths in read] == [1, 1]
    assert kept["2"] == 402 and kept["1"] == 400


def test_bitmaps_count_like_distinct(spark):
    df = spark.range(200_000).selectExpr(
        "(id * 7919) % 90000 AS key", "cast(id % 3 AS string) AS a",
        "CASE WHEN id % 7 = 0 THEN NULL ELSE id % 2 END AS b")
    df = df.unionByName(df.limit(5).withColumn("key", F.lit(None).cast("bigint")))
    stored = bitmaps.partial(df, "key", ["a", "b"])
    for groups in (["a"], ["b"], ["a", "b"], []):
        expected = df.groupBy(*groups).agg(F.count_distinct("key").alias("n"))
        assert rows(bitmaps.distinct_counts(stored, groups, "n")) == rows(expected)
    grains = [("b",), ("a", "b"), ()]
    found = bitmaps.distinct_rollups(stored, grains, "n")
    for i, grain in enumerate(grains):
        expected = df.groupBy(*grain).agg(F.count_distinct("key").alias("n"))
        assert rows(found.filter(F.col("nivel") == i).select(*grain, "n")) == rows(expected)


def test_bitmaps_of_two_days_put_together(spark):
    days = spark.range(1000).selectExpr("id % 300 AS key", "id % 2 AS day", "'x' AS g")
    parts = [bitmaps.partial(days.filter(f"day = {i}"), "key", ["g"]) for i in (0, 1)]
    both = bitmaps.merged(parts[0].unionByName(parts[1]), ["g"])
    assert bitmaps.distinct_counts(both, ["g"], "n").first().asDict() == {"g": "x", "n": 300}


def test_profile_counts_orphans_and_flags_in_one_scan(spark):
    fact = spark.createDataFrame(
        [(1, 10, 1), (1, 11, 0), (2, None, 1), (None, 10, 0), (3, 12, 1)], "a int, b int, f int")
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    counted = fact.mapInArrow(count, fact.schema)
    profile = checks.key_profile(counted, ["a", "b"], F.col("f") == 1)
    dims = {"a": spark.createDataFrame([(1,), (2,)], "a int"),
            "b": spark.createDataFrame([(10,), (11,), (12,)], "b int")}
    got = {r.llave: r.huerfanos for r in checks.orphans_of(profile, dims).collect()}
    assert got == {"a": 2, "b": 1}
    assert checks.flagged(profile).first().n == 3
    assert seen.value == 5
    empty = checks.key_profile(fact.limit(0), ["a", "b"])
    assert {r.huerfanos for r in checks.orphans_of(empty, dims).collect()} == {0}
