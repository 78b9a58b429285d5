import datetime as dt
from decimal import Decimal as M

import pytest
from conftest import rows, write_text_csv
from pyspark.sql import functions as F

from estrato import model
from estrato.operators.increment import (
    day_bound, mark_micros, micros, slice_since, volume_flags, watermarks,
)
from estrato.operators.upsert import Batch, DuplicateKeys, upsert, with_audit_columns
from estrato.plans import bronze, summary
from estrato.sources import landing
from estrato.sources.lake import Lake, append_daily, read_daily

T0, T1 = dt.datetime(2026, 1, 1, 8), dt.datetime(2026, 1, 2, 8)
B0, B1 = Batch(T0, "b0", "core"), Batch(T1, "b1", "core")
DDL = "k bigint, a string, v decimal(18,2)"


def states(spark, old, new):
    source = spark.createDataFrame(new, DDL)
    target = spark.createDataFrame(old, DDL).withColumns(B0.columns())
    return target, source


def merged(spark, old, new, batch=B1):
    target, source = states(spark, old, new)
    return upsert(target, source, "k", ["a", "v"], batch)


def test_upsert_actions_and_stamps(spark):
    old = [(1, "x", M("1")), (2, None, M("2")), (3, "x", None), (4, "x", M("4"))]
    new = [(1, "x", M("1")), (2, "y", M("2")), (3, "x", M("3")), (5, None, None)]
    got = {r.k: (r.accion, r.a, r.v, r.id_lote, r.fecha_ingesta)
           for r in merged(spark, old, new).collect()}
    assert got == {
        1: ("SAME", "x", M("1"), "b0", T0),
        2: ("UPDATE", "y", M("2"), "b1", T1),
        3: ("UPDATE", "x", M("3"), "b1", T1),
        4: ("KEEP", "x", M("4"), "b0", T0),
        5: ("INSERT", None, None, "b1", T1),
    }


def test_value_to_null_is_a_change(spark):
    got = merged(spark, [(1, "x", M("1"))], [(1, None, M("1"))]).first()
    assert (got.accion, got.a) == ("UPDATE", None)


def test_repeated_source_keys_are_refused(spark):
    with pytest.raises(DuplicateKeys):
        merged(spark, [], [(1, "x", None), (1, "y", None)])


def test_rows_without_key_are_added_once(spark):
    new = [(None, "x", None), (None, "x", None), (None, None, M("1")), (1, "z", None)]
    first = merged(spark, [], new)
    assert first.count() == 3
    again = upsert(first.drop("accion"), spark.createDataFrame(new, DDL), "k", ["a", "v"], B1)
    assert rows(again.drop("accion")) == rows(first.drop("accion"))


def test_audit_columns_are_added_once(spark):
    bare = spark.createDataFrame([(1,)], "k int")
    once = with_audit_columns(bare)
    assert once.columns == ["k", "fecha_ingesta", "sistema_fuente", "id_lote"]
    assert with_audit_columns(once).columns == once.columns
    assert once.first().id_lote is None


def test_csv_with_mark_and_float_like_integers(spark, folder):
    path = f"{folder}/x.csv"
    write_text_csv(path, ["id", "doc", "score", "v", "d"],
                   [[1, "0012", "561.0", "", "2026-01-31"], [2, "", "", "5.25", ""]])
    schema = spark.createDataFrame([], "id bigint, doc string, score int, v decimal(18,2), d date")
    got = [tuple(r) for r in landing.read_csv(spark, path, schema.schema).orderBy("id").collect()]
    assert got == [(1, "0012", 561, None, dt.date(2026, 1, 31)), (2, None, None, M("5.25"), None)]


def test_json_array_with_timestamps(spark, folder):
    path = f"{folder}/x.json"
    with open(path, "w", encoding="utf-8") as f:
        f.write('[{"id": 1, "d": "2026-01-31T00:00:00.000", "s": 561.0},\n'
                ' {"id": 2, "d": null, "s": null}]')
    schema = spark.createDataFrame([], "id bigint, d date, s int").schema
    got = landing.read_json(spark, path, schema, lines=False).orderBy("id").collect()
    assert [tuple(r) for r in got] == [(1, dt.date(2026, 1, 31), 561), (2, None, None)]


def test_bad_dates_become_null(spark):
    texts = spark.createDataFrame([("2026-02-28",), ("2026-02-30",), ("x",)], "d string")
    got = [r.d for r in landing.to_date_columns(texts, ["d"]).collect()]
    assert got == [dt.date(2026, 2, 28), None, None]


def test_slice_is_strict_at_microseconds(spark):
    df = spark.sql("SELECT timestamp_ntz '2026-01-01 00:00:00.000001' AS t UNION ALL "
                   "SELECT timestamp_ntz '2026-01-01 00:00:00.000002'")
    mark = dt.datetime(2026, 1, 1, 0, 0, 0, 1)
    assert slice_since(df, "t", mark).count() == 1
    assert slice_since(df, "t", None).count() == 2


def test_time_as_a_number(spark):
    texts = ["1969-12-31 23:59:59.999999", "1970-01-01 00:00:00", "2026-03-29 02:30:15.000001"]
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Madrid")  # 02:30 does not exist
        df = spark.createDataFrame([(t,) for t in texts], "t string")
        got = [r.n for r in df.select(micros(F.col("t").cast("timestamp_ntz")).alias("n")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert got == [mark_micros(dt.datetime.fromisoformat(t)) for t in texts]


def test_slice_skips_row_groups(spark, folder):
    lake, t = Lake(spark, folder), model.BRANCHES

    def branches(first, last):
        return spark.range(first, last).selectExpr(
            "cast(id as string) AS cod_suc", "uuid() AS nom_suc", "'x' AS tip_punto",
            "'x' AS ciudad", "'x' AS depto", "cast(1 as decimal(10,7)) AS latitud",
            "cast(1 as decimal(10,7)) AS longitud", "1 AS activo")

    first = lake.overwrite("landing", t.name, branches(0, 20_000))
    bronze.ingest(lake, t, first, B0)
    spark.conf.set("parquet.block.size", 1 << 14)
    try:
        bronze.ingest(lake, t, first.unionByName(branches(20_000, 20_100)), B1)
    finally:
        spark.conf.unset("parquet.block.size")
    new = slice_since(bronze.current(lake, t, timed=True), "fecha_ingesta", T0)
    assert len(new.collect()) == 100
    scanned = new._jdf.queryExecution().executedPlan().collectLeaves().head().metrics()
    assert scanned.apply("numOutputRows").value() < 20_100


def test_failed_runs_do_not_move_the_mark(spark):
    log = spark.createDataFrame(
        [(1, "a", "OK", T0), (2, "a", "SIN_CAMBIOS", T0), (3, "a", "ERROR", T1),
         (4, "b", "OK", None), (5, "c", "ERROR", T1)],
        "id_log bigint, tabla string, estado string, watermark_hasta timestamp_ntz")
    assert rows(watermarks(log)) == [("a", T0)]


def lake_with(spark, folder, ddl="k bigint, fecha_ingesta timestamp_ntz"):
    return Lake(spark, folder), lambda data: spark.createDataFrame(data, ddl)


def test_export_outcomes(spark, folder):
    lake, frame = lake_with(spark, folder)
    good = frame([(1, T0), (2, T1)])
    broken = spark.createDataFrame([(1,)], "k int")
    first = {r.tabla: r for r in bronze.export_changes(lake, {"a": broken, "b": good}).collect()}
    assert (first["a"].estado, first["b"].estado) == ("ERROR", "OK")
    assert "fecha_ingesta" in first["a"].mensaje_error
    assert len(first["a"].mensaje_error) <= 2000
    assert (first["b"].registros_procesados, first["b"].watermark_hasta) == (2, T1)
    assert first["b"].tamano_archivo_bytes > 0
    assert "anio=2026/mes=01/dia=02" in first["b"].ruta_archivo

    later = dt.datetime(2026, 1, 3)
    second = {r.tabla: r for r in bronze.export_changes(
        lake, {"a": good, "b": good.unionByName(frame([(3, later)]))}).collect()}
    assert (second["a"].registros_procesados, second["a"].watermark_desde) == (2, None)
    assert (second["b"].registros_procesados, second["b"].watermark_hasta) == (1, later)

    third = {r.tabla: r for r in bronze.export_changes(lake, {"b": good}).collect()}["b"]
    assert (third.estado, third.registros_procesados, third.ruta_archivo) == (
        "SIN_CAMBIOS", 0, None)
    assert third.watermark_hasta == later
    log = lake.read(bronze.LOGS, bronze.INGESTION)
    assert sorted(r.id_log for r in log.collect()) == [1, 2, 3, 4, 5]


def test_unpublished_run_is_invisible_and_replayed(spark, folder):
    """A crash after the data and before the log row: the next run exports the same rows."""
    lake, frame = lake_with(spark, folder)
    good = frame([(1, T0), (2, T1)])
    append_daily(good, "fecha_ingesta", lake.path("cambios", "b"), "crashed")
    bronze.export_changes(lake, {"b": good})
    log = lake.read(bronze.LOGS, bronze.INGESTION)
    back = read_daily(spark, lake.path("cambios", "b"), good.schema, log, "b")
    assert sorted(r.k for r in back.collect()) == [1, 2]
    recent = read_daily(spark, lake.path("cambios", "b"), good.schema, log, "b", since=T1)
    assert [r.k for r in recent.collect()] == [2]


def test_day_bound_prunes_partitions(spark, folder):
    lake, frame = lake_with(spark, folder)
    append_daily(frame([(1, T0), (2, T1)]), "fecha_ingesta", lake.path("cambios", "b"), "r")
    pruned = spark.read.parquet(lake.path("cambios", "b")).filter(day_bound(T1))
    assert "PartitionFilters: []" not in pruned._jdf.queryExecution().toString()
    assert pruned.count() == 1


def test_error_log_cuts_long_messages(spark, folder):
    lake = Lake(spark, folder)
    bronze.log_error(lake, "GOLD", "Pipeline principal", ValueError("x" * 5000), "run")
    bronze.log_error(lake, "SILVER", "Pipeline principal", KeyError("k"), "run")
    got = lake.read(bronze.LOGS, bronze.ERRORS).orderBy("id_error").collect()
    assert [(r.id_error, r.etapa, r.tipo_error, r.estado) for r in got] == [
        (1, "GOLD", "ValueError", "ERROR"), (2, "SILVER", "KeyError", "ERROR")]
    assert len(got[0].mensaje_error) == 2000
    bronze.log_error(lake, "GOLD", "Otro", ValueError("y"), "run")
    newest = summary.last_error(lake.read(bronze.LOGS, bronze.ERRORS), "ValueError")
    assert rows(newest) == [("ERROR", "Otro", "ValueError")]


def test_failed_batch_leaves_the_snapshot(spark, folder):
    lake = Lake(spark, folder)
    t = model.BRANCHES
    one = spark.createDataFrame([("S1", "a", None, None, None, None, None, 1)], t.schema)
    bronze.ingest(lake, t, one, B0)
    with pytest.raises(DuplicateKeys):
        bronze.ingest(lake, t, one.unionByName(one), B1)
    assert [r.id_lote for r in bronze.current(lake, t).collect()] == ["b0"]
    counts = bronze.ingest(lake, t, one.withColumn("activo", F.lit(0)), B1)
    assert rows(counts) == [("UPDATE", 1)]
    assert [r.id_lote for r in bronze.current(lake, t).collect()] == ["b1"]


def test_published_batch_can_be_repeated(spark, folder):
    """A crash after publishing: the batch comes again and reads its own snapshot."""
    lake, t = Lake(spark, folder), model.BRANCHES
    one = spark.createDataFrame([("S1", "a", None, None, None, None, None, 1)], t.schema)
    assert rows(bronze.ingest(lake, t, one, B0)) == [("INSERT", 1)]
    assert rows(bronze.ingest(lake, t, one, B0)) == [("SAME", 1)]
    assert bronze.current(lake, t).count() == 1


def test_volume_alerts_look_at_exports_with_rows(spark):
    log = spark.createDataFrame(
        [(1, "a", "OK", 100), (2, "a", "SIN_CAMBIOS", 0), (3, "a", "OK", 99),
         (4, "b", "OK", 10), (5, "b", "OK", 21), (6, "b", "SIN_CAMBIOS", 0)],
        "id_log bigint, tabla string, estado string, registros_procesados bigint")
    got = [(r.tabla, r.registros_procesados, r.media_previa)
           for r in summary.volume_alerts(log).collect()]
    assert got == [("b", 21, 10.0)]


def test_volume_flags(spark):
    log = spark.createDataFrame(
        [(i, "a", n) for i, n in enumerate([100, 100, 100, 201, 100, 49])],
        "id_log bigint, tabla string, registros_procesados bigint")
    got = {r.id_log: r.anomalia for r in volume_flags(log, runs=3, ratio=2.0).collect()}
    assert got == {0: 0, 1: 0, 2: 0, 3: 1, 4: 0, 5: 1}


def test_csv_columns_go_by_name_and_quotes_are_doubled(spark, folder):
    from pyspark.sql import types as T

    schema = T.StructType.fromDDL("a string, b int")
    path = f"{folder}/x.csv"
    with open(path, "w", encoding="utf-8-sig") as f:
        f.write('b,a,more\n1,"x ""q"", y",z\n2,,\n')
    read = landing.read_csv(spark, path, schema)
    assert {tuple(r) for r in read.collect()} == {('x "q", y', 1), (None, 2)}
    landing.write_csv(read, f"{folder}/out")
    again = landing.read_csv(spark, f"{folder}/out", schema)
    assert {tuple(r) for r in again.collect()} == {('x "q", y', 1), (None, 2)}
    with pytest.raises(ValueError):
        landing.read_csv(spark, path, T.StructType.fromDDL("a string, c int"))


def test_a_day_is_written_to_few_files(spark, folder):
    import glob

    rows_ = spark.range(0, 10_000, 1, 8).select(
        "id", F.timestamp_seconds(F.col("id") % 30 * 86_400).cast("timestamp_ntz").alias("ts"))
    done = append_daily(rows_, "ts", f"{folder}/days", "r1")
    assert done["rows"] == 10_000 and len(done["folders"]) == 30
    files = glob.glob(f"{folder}/days/*/*/*/*/*.parquet")
    assert len(files) <= 30 + int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_files_of_a_folder_with_other_headers_stop_the_read(spark, folder):
    schema = model.T.StructType.fromDDL("a string, b int")

    def put(name, text, mark=False):
        with open(f"{folder}/{name}.csv", "w", encoding="utf-8-sig" if mark else "utf-8") as f:
            f.write(text)

    put("one", "a,b\nx,1\n")
    put("two", "a,b\ny,2\n")
    assert rows(landing.read_csv(spark, folder, schema)) == [("x", 1), ("y", 2)]
    put("three", "b,a\n7,8\n")
    with pytest.raises(Exception, match="(?i)header"):
        landing.read_csv(spark, folder, schema).collect()


def test_a_byte_order_mark_in_some_files(spark, folder):
    schema = model.T.StructType.fromDDL("a string, b int")
    for name, code in (("one", "utf-8"), ("two", "utf-8-sig")):
        with open(f"{folder}/{name}.csv", "w", encoding=code) as f:
            f.write(f"a,b\n{name},1\n")
    assert rows(landing.read_csv(spark, folder, schema)) == [("one", 1), ("two", 1)]
