import datetime as dt
from decimal import Decimal as M

from conftest import rows
from pyspark.sql import functions as F

from estrato import model
from estrato.operators.checks import Check, latest_run, orphans, run_checks
from estrato.operators.observed import Counts, null_profile_of, written
from estrato.operators.quality import (
    Rule, classify, conformity, existing, latest_by, null_profile, quarantine, reject_detail,
)
from estrato.plans import silver
from estrato.workspace import freeze

AS_OF = dt.date(2026, 3, 10)
STAMP = (dt.datetime(2026, 1, 1), "core", "b0")


def clients(spark, *people):
    """People as (id, name, surname, document, born)."""
    full = [(i, n, s, "CC", d, b, None, None, None, None, None, None, None)
            for i, n, s, d, b in people]
    return with_stamp(spark.createDataFrame(full, model.CLIENTS.schema))


def with_stamp(df):
    return df.withColumns({
        "fecha_ingesta": F.lit(STAMP[0]).cast("timestamp_ntz"),
        "sistema_fuente": F.lit(STAMP[1]), "id_lote": F.lit(STAMP[2])})


def test_client_rules(spark):
    ok, future = dt.date(1990, 1, 1), dt.date(2026, 3, 11)
    people = clients(
        spark, (1, "a", "b", "1", ok), (None, "a", "b", "1", ok), (3, " ", None, "1", ok),
        (4, "a", "b", "", None), (5, "a", "b", "1", None), (6, "a", "b", "1", future),
        (7, None, "b", "1", future), (8, "a", "b", "1", AS_OF))
    got = {r.id_registro: (r.tipo_error, r.campo_error, r.motivo_rechazo)
           for r in silver.client_rejects(people, AS_OF).collect()}
    null = "CAMPO_OBLIGATORIO_NULO"
    assert got == {
        "NULL": (null, "id_cli", "El identificador del cliente es obligatorio."),
        "3": (null, "nomb_cli", "El nombre es obligatorio."),
        "4": (null, "num_doc", "El documento es obligatorio."),
        "5": (null, "fec_nac", "La fecha de nacimiento es obligatoria."),
        "6": ("FECHA_INVALIDA", "fec_nac", "La fecha de nacimiento no puede ser futura."),
        # The future date names the type although the name fails first.
        "7": ("FECHA_INVALIDA", "nomb_cli", "El nombre es obligatorio."),
    }
    kept = silver.clients(people, silver.client_rejects(people, AS_OF), AS_OF)
    assert sorted(r.id_cli for r in kept.collect()) == [1, 8]


def test_one_bad_version_rejects_the_key(spark):
    two = clients(spark, (1, "a", "b", "1", dt.date(1990, 1, 1)),
                  (1, "", "b", "1", dt.date(1990, 1, 1)), (2, "a", "b", "1", AS_OF))
    rejects = silver.client_rejects(two, AS_OF)
    assert [r.id_cli for r in silver.clients(two, rejects, AS_OF).collect()] == [2]


def test_text_keys_are_quarantined_as_text(spark):
    df = spark.createDataFrame([("01",), ("1",), (None,)], "k string")
    bad = classify(df, "t", "k", [Rule(F.col("k") == "1", "malo", "k", "no")])
    assert [r.k for r in quarantine(df, bad, "t", "k").collect()] == ["01"]
    assert quarantine(df, bad, "otra", "k").count() == 2
    detail = reject_detail(df, bad, "t", "k", ["k"], ["tipo_error"])
    assert rows(detail) == [("1", "malo")]


def test_latest_version_by_time_then_batch(spark):
    df = spark.createDataFrame(
        [(1, 5, "a", "x"), (1, 5, "b", "y"), (1, 4, "z", "w"), (2, 1, "a", "v")],
        "k int, t int, b string, v string")
    got = latest_by(df, ["k"], [F.desc("t"), F.desc("b")])
    assert sorted((r.k, r.v) for r in got.collect()) == [(1, "y"), (2, "v")]


def test_hot_key_is_reduced_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    plan = latest_by(df, ["k"], [F.desc("id")])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan.split("Exchange")[-1]


def test_hot_client_is_split_in_the_referential_join(spark, folder):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50k",
    }
    old = {k: spark.conf.get(k, None) for k in settings}
    spark.range(0, 60_000, 1, 8).selectExpr(
        "if(id % 3 = 0, 7, id % 5000) AS k", "uuid() AS v").write.parquet(f"{folder}/rows")
    spark.range(5000).toDF("k").write.parquet(f"{folder}/known")
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        kept = existing(spark.read.parquet(f"{folder}/rows"),
                        spark.read.parquet(f"{folder}/known"), "k")
        assert len(kept.collect()) == 60_000
        assert "skew=true" in kept._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_null_profile_and_empty_tables(spark):
    some = spark.createDataFrame([(1, None), (2, "x"), (None, None)], "a int, b string")
    empty = spark.createDataFrame([], "a int")
    got = {(r.tabla, r.columna): (r.total_registros, r.registros_nulos, r.porcentaje_nulos)
           for r in null_profile({"t": some, "e": empty}).collect()}
    assert got == {("t", "a"): (3, 1, M("33.33")), ("t", "b"): (3, 2, M("66.67")),
                   ("e", "a"): (0, 0, None)}


def test_conformity(spark):
    bronze = {"x": spark.range(3), "y": spark.range(0)}
    kept = {"x": spark.range(2), "y": spark.range(0)}
    rejects = spark.createDataFrame([("TX",), ("TY",)], "tabla_origen string")
    got = {r.tabla: tuple(r)[1:]
           for r in conformity(bronze, kept, rejects, {"x": "TX"}).collect()}
    assert got == {"x": (3, 2, 1, M("66.67")), "y": (0, 0, 0, None)}


def test_movements_need_every_field_and_known_parents(spark):
    day = dt.date(2026, 1, 1)
    base = (1, 1, "P", "C", day, "10:00:00", M("1"), None, None, None, None, None)

    def variant(i, **change):
        row = dict(zip(model.MOVEMENTS.columns, base)) | {"id_mov": i} | change
        return tuple(row.values())

    data = [base, variant(2, hra_mov=None), variant(3, vr_mov=None), variant(4, id_cli=9),
            variant(5, cod_prod="Q"), variant(6, fec_mov=None), variant(None)]
    bronze = with_stamp(spark.createDataFrame(data, model.MOVEMENTS.schema))
    cli = spark.createDataFrame([(1,)], "id_cli bigint")
    prod = spark.createDataFrame([("P",)], "cod_prod string")
    kept = silver.movements(silver.valid_movements(bronze, cli, prod))
    got = kept.select("id_mov", "cod_canal", "id_dispositivo", "ind_sospechoso").collect()
    assert [tuple(r) for r in got] == [(1, "NO_INFORMADO", "NO_INFORMADO", 0)]


def test_counts_taken_while_writing(spark):
    some = spark.createDataFrame([(1, None), (None, None), (3, "x")], "`a.b` int, c string")
    cases = {"t": some, "e": some.limit(0), "n": some.filter("false"), "s": some.repartition("c")}
    counts = {k: written(df, lambda df, k=k: freeze(df, f"watched-{k}"))[1] for k, df in cases.items()}
    assert counts["t"] == counts["s"] == Counts(3, {"a.b": 1, "c": 2})
    assert counts["e"] == counts["n"] == Counts(0, {"a.b": 0, "c": 0})
    got = {(r.tabla, r.columna): (r.total_registros, r.registros_nulos, r.porcentaje_nulos)
           for r in null_profile_of(spark, counts).collect()}
    assert got["t", "c"] == (3, 2, M("66.67")) and got["e", "c"] == (0, 0, None)
    assert len(got) == 8


def test_orphans_send_no_dimension_to_the_driver(spark):
    """A dimension whose key column looks small in its file; a NULL key counts."""
    fact = spark.createDataFrame([(1, 1), (1, 9), (None, 2), (7, None)], "a bigint, b bigint")
    dims = {"a": freeze(spark.range(1, 5).withColumnRenamed("id", "a"), "a"),
            "b": freeze(spark.range(1, 5).withColumnRenamed("id", "b"), "b")}
    found = orphans(fact, dims)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert {r.llave: r.huerfanos for r in found.collect()} == {"a": 2, "b": 2}


def test_results_of_checks_are_stored(spark):
    """The log of two runs is read twice, the checks are not run again for it."""
    table = freeze(spark.range(3), "checked")
    check = Check("n", "GOLD", table.agg(F.count("*")), "none", 3)
    ts = dt.datetime(2026, 1, 1)
    log = run_checks([check], "z-old", ts, 1).unionByName(run_checks([check], "a-new", ts, 2))
    assert not any("checked-" in path for path in log.inputFiles())
    got = [(r.id_ejecucion, r.valor_observado, r.resultado) for r in latest_run(log).collect()]
    assert got == [("a-new", 3, "PASS")]
