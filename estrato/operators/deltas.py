"""Marts kept up to date from changed rows instead of from the whole fact.

A change is the image of a row before and after it. Counted with -1 and +1, both are summed by
group and added to what is stored. Sums and counts need nothing else. A maximum can fall when
the row that held it goes; only the groups where that may be are computed again.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from estrato.operators.quality import union_all

ROWS = "registros"


@dataclass(frozen=True)
class Mart:
    """Groups, sums (a NULL adds nothing) and maxima of SQL expressions over a fact's rows.

    Every mart has the number of rows of a group; a group without rows is not there.
    """

    groups: tuple[str, ...]
    sums: Mapping[str, str]
    maxima: Mapping[str, str] = field(default_factory=dict)

    @property
    def columns(self) -> list[str]:
        return [*self.groups, ROWS, *self.sums, *self.maxima]


def build(fact: DataFrame, mart: Mart) -> DataFrame:
    """The mart from all rows."""
    return _summed(fact, mart, 1).select(*mart.columns)


def _summed(rows: DataFrame, mart: Mart, sign: int) -> DataFrame:
    kinds = rows.select(*[F.expr(e).alias(n) for n, e in mart.sums.items()]).dtypes
    return rows.groupBy(*mart.groups).agg(
        (F.count("*") * sign).alias(ROWS),
        *[
            (F.coalesce(F.sum(F.expr(mart.sums[name])), F.lit(0)) * sign).cast(_total(kind)).alias(name)
            for name, kind in kinds
        ],
        *[F.max(F.expr(e)).alias(name) for name, e in mart.maxima.items()],
    )


def _total(kind: str) -> str:
    """Totals of decimals as wide as they get, others as Spark sums them."""
    scale = kind.rstrip(")").split(",")[1] if kind.startswith("decimal") else None
    return f"decimal(38,{scale})" if scale else "double" if kind in ("float", "double") else "bigint"


def changed(stored: DataFrame, mart: Mart, before: DataFrame, after: DataFrame) -> DataFrame:
    """The mart with the changes added, and per maximum `__fell_`: it may be too high.

    One shuffle of the stored mart and the changes, both by group; the fact is not read.
    """
    parts = []
    for rows, role in ((stored, "old"), (_summed(after, mart, 1), "in"),
                       (_summed(before, mart, -1), "out")):
        maxima = [
            (F.col(m) if role == kind else F.lit(None).cast(stored.schema[m].dataType))
            .alias(f"__{kind}_{m}")
            for m in mart.maxima for kind in ("old", "in", "out")
        ]
        parts.append(rows.select(*mart.groups, ROWS, *mart.sums, *maxima))
    joined = union_all(parts).groupBy(*mart.groups).agg(
        F.sum(ROWS).alias(ROWS),
        *[F.sum(s).cast(stored.schema[s].dataType).alias(s) for s in mart.sums],
        *[
            F.max(f"__{kind}_{m}").alias(f"__{kind}_{m}")
            for m in mart.maxima for kind in ("old", "in", "out")
        ],
    )
    old, new, gone = (lambda m, k=k: F.col(f"__{k}_{m}") for k in ("old", "in", "out"))
    return joined.filter(F.col(ROWS) > 0).select(
        *mart.groups, ROWS, *mart.sums,
        *[F.greatest(old(m), new(m)).alias(m) for m in mart.maxima],
        *[
            F.coalesce((gone(m) >= old(m)) & (new(m).isNull() | (new(m) < gone(m))), F.lit(False))
            .alias(f"__fell_{m}")
            for m in mart.maxima
        ],
    )


def repaired(marked: DataFrame, mart: Mart, fact: DataFrame | None) -> DataFrame:
    """The result of `changed` with the maxima that may have fallen taken from the rows of
    their groups. `marked` should be stored, as it is read twice."""
    if not mart.maxima:
        return marked.select(*mart.columns)
    fell = marked.filter(F.greatest(*[F.col(f"__fell_{m}").cast("int") for m in mart.maxima]) > 0)
    names = {g: f"__g_{g}" for g in mart.groups}
    some = fell.select(*[F.col(g).alias(n) for g, n in names.items()])

    def same(left: DataFrame) -> Column:
        tests = [left[g].eqNullSafe(some[n]) for g, n in names.items()]
        return tests[0] if len(tests) == 1 else _all(tests)

    again = fact.join(some, same(fact), "left_semi").groupBy(*mart.groups).agg(
        *[F.max(F.expr(e)).alias(f"__new_{m}") for m, e in mart.maxima.items()]
    ).select(
        *[F.col(g).alias(f"__a_{g}") for g in mart.groups],
        *[f"__new_{m}" for m in mart.maxima],
    )
    match = _all([F.col(g).eqNullSafe(F.col(f"__a_{g}")) for g in mart.groups])
    return marked.join(again, match, "left").select(
        *mart.groups, ROWS, *mart.sums,
        *[
            F.when(F.col(f"__fell_{m}"), F.col(f"__new_{m}")).otherwise(F.col(m)).alias(m)
            for m in mart.maxima
        ],
    )


def _all(tests: list[Column]) -> Column:
    out = tests[0]
    for test in tests[1:]:
        out &= test
    return out
