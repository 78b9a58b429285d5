"""Overlap sums over months as changes, against the definition."""

import datetime as dt
import random
from decimal import Decimal as M

from pyspark.sql import functions as F

from estrato.functions.dates import month_starts, next_month
from estrato.operators.months import monthly_grid, overlap_changes

DDL = "who string, a date, b date, v decimal(18,2)"


def test_changes_against_the_definition(spark):
    """A third of the intervals belong to one entity; some are open, reversed or worth nothing."""
    rng, start = random.Random(3), dt.date(2001, 3, 1)
    rows = []
    for i in range(400):
        a = start + dt.timedelta(rng.randrange(8_000))
        b = a + dt.timedelta(rng.randrange(-40, 4_000))
        who = "hot" if i % 3 == 0 else rng.choice(["x", "y", "z", None])
        value = None if i % 17 == 0 else M(rng.randrange(-9_999, 99_999)) / 100
        rows.append((who, None if i % 29 == 0 else a, None if i % 31 == 0 else b, value))
    df = spark.createDataFrame(rows, DDL)
    months = month_starts(dt.date(2026, 5, 9), 300)
    changes = overlap_changes(df, "who", "a", "b", {"total": F.col("v")})
    assert changes.count() <= 2 * len(rows)
    got = {
        (r.who, r.mes_inicio): (r.vivos, r.total)
        for r in monthly_grid(changes, months[0], months[-1]).collect()
    }
    expected = {}
    for who, a, b, v in rows:
        for m in months:
            if a and b and a < next_month(m) and b >= m:
                n, total = expected.get((who, m), (0, M(0)))
                expected[who, m] = (n + 1, total + (v or 0))
    assert got == expected


def test_no_intervals(spark):
    df = spark.createDataFrame([("x", None, None, None)], DDL)
    changes = overlap_changes(df, "who", "a", "b", {"total": F.col("v")})
    assert changes.collect() == []
    assert monthly_grid(changes, dt.date(2026, 1, 1), dt.date(2026, 2, 1)).collect() == []
