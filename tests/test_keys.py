from pyspark.sql import functions as F

from estrato.operators.keys import dense_key
from estrato.workspace import freeze


def test_dense_key_follows_the_order(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("k"), F.lit("x").alias("v"))
    got = dense_key(df.repartition(13), ["k"], "llave").orderBy("llave").collect()
    assert [r.llave for r in got] == list(range(1, 5001))
    keys = [r.k for r in got]
    assert keys == sorted(keys)
    assert df.columns == ["k", "v"]


def test_dense_key_with_repeated_order_values(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    got = dense_key(df, ["k", "id"], "llave").orderBy("llave").collect()
    assert [(r.k, r.id) for r in got] == sorted((i % 3, i) for i in range(1000))
    loose = dense_key(df, ["k"], "llave")
    assert sorted(r.llave for r in loose.collect()) == list(range(1, 1001))


def test_dense_key_of_nothing(spark):
    assert dense_key(spark.range(0), ["id"], "llave").count() == 0


def test_dense_key_has_no_global_sort_of_the_rows(spark):
    plan = dense_key(spark.range(100), ["id"], "llave")._jdf.queryExecution().toString()
    executed = plan.split("Physical Plan")[-1]
    # Only the list of partition sizes passes through one task.
    single = executed.split("Exchange SinglePartition")
    assert len(single) == 2 and "HashAggregate(keys=[_part" in single[1]


def test_cuts_from_a_stored_key_column(spark):
    """The same keys, and the input of the numbering is evaluated once."""
    df = spark.range(40_000).select((F.col("id") * 7919 % 40_009).alias("k"), (F.col("id") % 2).alias("v"))
    keys = freeze(df.select("k"), "keys")
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    counted = df.mapInArrow(count, df.schema)
    got = [tuple(r) for r in dense_key(counted, ["k", "v"], "llave", keys).collect()]
    assert sorted(got) == [(i + 1, *r) for i, r in enumerate(sorted(tuple(x) for x in df.collect()))]
    assert seen.value == 40_000
    assert dense_key(df.limit(0), ["k"], "llave", keys.limit(0)).collect() == []
