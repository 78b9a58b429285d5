import datetime as dt
import math
import random
import statistics
from decimal import Decimal as M

import pytest
from pyspark.sql import functions as F

from estrato.functions.dates import seconds_of_day
from estrato.operators import history
from estrato.operators.history import fraud_flags, history_stats
from estrato.operators.ranges import range_of, splitters
from estrato.workspace import freeze

DDL = "id bigint, who bigint, day date, sec int, v decimal(18,2)"


def brute(data, days):
    """Count, mean, deviation and daily count by definition."""
    out = {}
    for i, who, day, sec, _ in data:
        past = [v for j, w, d, s, v in data if w == who and d >= day - dt.timedelta(days)
                and (d, s, j) < (day, sec, i)]
        per_day = sum(1 for _, w, d, _, _ in data if w == who and d == day)
        mean = sum(past) / len(past) if past else None
        sd = statistics.stdev(past) if len(past) > 1 else None
        out[i] = (len(past), mean, sd, per_day)
    return out


def check(spark, data, days, range_rows):
    df = spark.createDataFrame(data, DDL)
    scored = history_stats(df, "who", "day", F.col("sec"), "id", "v", days, range_rows)
    assert scored.columns[: len(df.columns)] == df.columns
    expected = brute(data, days)
    got = scored.collect()
    assert len(got) == len(data)
    for r in got:
        n, mean, sd, per_day = expected[r.id]
        assert (r.movimientos_previos, r.frecuencia_diaria) == (n, per_day)
        if mean is None:
            assert r.promedio_historico is None
        else:
            assert abs(r.promedio_historico - mean) <= M("0.000001")
        if sd is None:
            assert r.desviacion_historica is None
        else:
            assert math.isclose(r.desviacion_historica, float(sd), rel_tol=1e-12, abs_tol=1e-12)


@pytest.mark.parametrize("range_rows", [1_000_000, 60, 7, 1])
def test_skewed_entity_against_brute_force(spark, range_rows):
    """One entity has half of the rows, one of its days most of those, many in one second."""
    rng = random.Random(7)
    data, start = [], dt.date(2026, 1, 1)
    for i in rng.sample(range(-10_000, 10_000), 400):
        if rng.random() < 0.5:
            day = start if rng.random() < 0.7 else start + dt.timedelta(rng.randrange(50))
            sec = 0 if rng.random() < 0.6 else rng.randrange(86_400)
            row = (i, 1, day, sec)
        else:
            row = (i, rng.randrange(2, 9), start + dt.timedelta(rng.randrange(80)),
                   rng.randrange(4))
        data.append((*row, M(rng.randrange(-500, 100_000)) / 100))
    check(spark, data, 30, range_rows)


def test_window_edge_is_inclusive(spark):
    start = dt.date(2026, 1, 31)
    data = [(1, 1, start, 5, M("10.00")), (2, 1, start + dt.timedelta(30), 0, M("10.00")),
            (3, 1, start + dt.timedelta(31), 0, M("10.00"))]
    check(spark, data, 30, 100)


@pytest.mark.parametrize("range_rows", [100, 1])
def test_equal_amounts_have_no_deviation(spark, range_rows):
    day = dt.date(2026, 1, 1)
    amounts = ["0.10"] * 3 + ["0.11", "0.10"]
    data = [(i, 1, day, 0, M(a)) for i, a in enumerate(amounts)]
    df = spark.createDataFrame(data, DDL)
    scored = history_stats(df, "who", "day", F.col("sec"), "id", "v", 30, range_rows)
    flagged = fraud_flags(scored, "v", F.col("sec") + 18_000, F.lit(False))
    got = {r.id: r for r in flagged.collect()}
    assert got[3].desviacion_historica == 0.0
    # One cent above three equal amounts alerts; an equal amount does not.
    assert [got[i].alerta_monto for i in range(5)] == [0, 0, 0, 1, 0]
    assert [got[i].alerta_frecuencia for i in range(5)] == [1] * 5


def test_large_amounts_stay_exact(spark):
    day = dt.date(2026, 1, 1)
    amounts = ["9999999999999.99"] * 4 + ["0.01"]
    data = [(i, 1, day, i, M(a)) for i, a in enumerate(amounts)]
    df = spark.createDataFrame(data, DDL)
    got = {r.id: r for r in history_stats(df, "who", "day", F.col("sec"), "id", "v").collect()}
    assert got[4].desviacion_historica == 0.0
    assert got[4].promedio_historico == M("9999999999999.990000")


def test_alerts(spark):
    df = spark.createDataFrame(
        [(1, 2, M("100.00"), 0.0, 4, "04:59:59", "WEB", M("900.00")),
         (2, 3, M("100.00"), 10.0, 5, "05:00:00", "atm", M("130.00")),
         (3, 3, M("100.00"), 10.0, 1, "00:00:00", None, M("130.01")),
         (4, 3, None, None, 1, "12:00:00", "Corresponsal ", M("130.01"))],
        "id int, movimientos_previos bigint, promedio_historico decimal(22,6), "
        "desviacion_historica double, frecuencia_diaria bigint, clock string, canal string, "
        "v decimal(18,2)")
    risky = F.coalesce(F.upper(F.rtrim("canal")).isin("ATM", "CORRESPONSAL"), F.lit(False))
    flagged = fraud_flags(df, "v", seconds_of_day(F.col("clock")), risky)
    names = ["alerta_monto", "alerta_horario", "alerta_frecuencia", "alerta_canal",
             "total_alertas", "ind_sospechoso"]
    got = {r.id: tuple(r[n] for n in names) for r in flagged.collect()}
    assert got == {1: (0, 1, 0, 0, 1, 0), 2: (0, 0, 1, 1, 2, 0), 3: (1, 1, 0, 0, 2, 1),
                   4: (0, 0, 0, 1, 1, 0)}


def test_one_shuffle_and_no_join(spark):
    data = [(1, 1, dt.date(2026, 1, 1), 0, M("1.00"))]
    df = spark.createDataFrame(data, DDL)
    scored = history_stats(df, "who", "day", F.col("sec"), "id", "v")
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    assert "Join" not in plan


def test_deviation_of_long_histories_of_large_amounts(spark):
    big = 9 * 10**14
    data = [("a", dt.date(2024, 1, 1), i, i, M(big + i % 2)) for i in range(400)]
    df = spark.createDataFrame(data, "who string, day date, sec int, id bigint, v decimal(18,2)")
    got = {
        r.id: r.desviacion_historica
        for r in history_stats(df, "who", "day", F.col("sec"), "id", "v").collect()
    }
    for i in (3, 50, 300, 399):
        assert got[i] == pytest.approx(statistics.stdev([float(k % 2) for k in range(i)]))


def test_no_task_holds_more_than_twice_its_share(spark):
    """A third of the rows in one second of one client, with one id far away."""
    day, clock = dt.date(2026, 1, 1), F.lit(0)
    base = spark.range(30_000).select(
        F.when(F.col("id") == 0, F.lit(-(2**62))).otherwise(F.col("id")).alias("id"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 500).cast("long").alias("who"),
        F.lit(day).alias("day"), F.lit("1.00").cast("decimal(18,2)").alias("v"),
    )
    df = freeze(base, "skewed")
    scored = history_stats(df, "who", "day", clock, "id", "v", range_rows=3_000)
    sizes = [r["count"] for r in scored.groupBy(F.spark_partition_id()).count().collect()]
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert sum(sizes) == 30_000
    cuts = splitters(df, [F.col("who"), F.col("id")], 10, 30_000)
    parts = df.groupBy(range_of(F.struct("who", "id"), cuts).alias("r")).count().collect()
    assert len(parts) == 10 and max(r["count"] for r in parts) < 2 * 3_000
    assert max(sizes) <= 2 * 3_000 * math.ceil(10 / tasks)
    hot = scored.filter("who = 0").agg(F.max("movimientos_previos"), F.min("movimientos_previos"))
    assert tuple(hot.first()) == (df.filter("who = 0").count() - 1, 0)


def test_no_rows(spark):
    df = spark.createDataFrame([], DDL)
    assert history_stats(df, "who", "day", F.col("sec"), "id", "v").collect() == []


def test_more_ranges_than_an_integer_squared_holds(spark):
    """Ranges times the size of the sample leave 32 bits."""
    base = spark.range(50_000).select(
        "id", (F.col("id") % 500).alias("who"), F.lit(dt.date(2026, 1, 1)).alias("day"),
        F.lit("1.00").cast("decimal(18,2)").alias("v"),
    )
    df = freeze(base, "many")
    scored = history_stats(df, "who", "day", F.lit(0), "id", "v", range_rows=1)
    wrong = F.col("movimientos_previos") != F.floor(F.col("id") / 500)
    assert scored.agg(F.count("*"), F.count_if(wrong)).first() == (50_000, 0)
    cuts = splitters(freeze(spark.range(400_000), "ids"), [F.col("id")], 6_000, 400_000)
    assert df.select(F.size(cuts)).first()[0] == 5_999


@pytest.mark.parametrize("range_rows", [60, 7, 1])
def test_hot_client_in_ranges_cut_by_rank(spark, monkeypatch, range_rows):
    """Few cuts in the plan, so that a client's days and seconds are cut by rank."""
    monkeypatch.setattr(history, "MOST_CUTS", 3)
    rng = random.Random(11)
    data = [
        (i, 1 if i % 3 == 0 else rng.randrange(2, 6),
         dt.date(2026, 1, 1) + dt.timedelta(rng.randrange(6)), rng.randrange(2),
         M(rng.randrange(-500, 100_000)) / 100)
        for i in [-(2**62), *rng.sample(range(10_000), 300)]
    ]
    check(spark, data, 3, range_rows)


def test_ranks_take_one_shuffle_of_the_rows_and_no_join(spark, monkeypatch):
    monkeypatch.setattr(history, "MOST_CUTS", 2)
    data = [(i, 1, dt.date(2026, 1, 1), 0, M("1.00")) for i in range(20)]
    df = spark.createDataFrame(data, DDL)
    scored = history_stats(df, "who", "day", F.col("sec"), "id", "v", range_rows=2)
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    assert "Join" not in plan
