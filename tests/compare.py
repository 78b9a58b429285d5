"""Run named queries on Spark and their SQL on DuckDB and report differences.

    python tests/compare.py [folder] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _type_family(text: str) -> str:
    text = text.lower()
    for family, words in {
        "text": ("varchar", "string"), "time": ("timestamp",), "real": ("double", "float"),
        "bool": ("bool",),
    }.items():
        if any(w in text for w in words):
            return family
    return text.replace("integer", "int").replace(" ", "")


def _plain(value):
    if isinstance(value, float):
        return 0.0 if value == 0 else value
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, decimal.Decimal):
        return format(value, "f")
    return value


def difference(con, df, sql: str) -> str | None:
    """None when columns, types and rows agree, else what differs."""
    names = sorted(df.columns)
    spark_types = {f.name: _type_family(f.dataType.simpleString()) for f in df.schema}
    spark_rows = sorted(
        (tuple(_plain(v) for v in r) for r in df.select(*names).collect()), key=repr
    )
    result = con.execute(sql)
    duck_types = {c[0]: _type_family(str(c[1])) for c in result.description}
    if sorted(duck_types) != names:
        return f"columns {names} / {sorted(duck_types)}"
    if spark_types != duck_types:
        off = {n: (spark_types[n], duck_types[n]) for n in names if spark_types[n] != duck_types[n]}
        return f"types {off}"
    order = [[c[0] for c in result.description].index(n) for n in names]
    duck_rows = sorted(
        (tuple(_plain(r[i]) for i in order) for r in result.fetchall()), key=repr
    )
    if len(spark_rows) != len(duck_rows):
        return f"rows {len(spark_rows)} / {len(duck_rows)}"
    for a, b in zip(spark_rows, duck_rows):
        if a != b:
            return f"first difference {dict(zip(names, a))} / {dict(zip(names, b))}"
    return None


def main(argv: list[str]) -> int:
    import __spark_entry__ as entry
    from estrato.workspace import build_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    session = build_session(
        "compare", **{"spark.master": "local[8]", "spark.sql.shuffle.partitions": "8",
                      "spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    session.sparkContext.setLogLevel("OFF")
    con, sqls, bad = connect(sf_dir), entry.oracle_sql(), 0
    for name, run in entry.queries().items():
        if argv[1:] and name not in argv[1:]:
            continue
        started = time.perf_counter()
        try:
            found = difference(con, run(session, sf_dir), sqls[name]) if name in sqls else "no SQL"
        except Exception as error:
            found = f"{type(error).__name__}: {str(error)[:600]}"
        bad += found is not None
        print(f"{name:36s} {time.perf_counter() - started:6.2f}s {found or 'ok'}", flush=True)
    print(f"{bad} differ")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
