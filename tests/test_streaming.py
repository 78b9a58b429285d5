import datetime as dt

from estrato import model
from estrato.plans.bronze import current
from estrato.sources.lake import Lake
from estrato.streaming.landing import start


def test_new_files_are_merged_once(spark, folder):
    lake, table = Lake(spark, f"{folder}/lake"), model.BRANCHES

    def drop(*branches):
        rows = [(c, n, None, None, None, None, None, 1) for c, n in branches]
        spark.createDataFrame(rows, table.schema).coalesce(1).write.mode("append").parquet(
            f"{folder}/in")

    def drain(minute):
        query = start(lake, table, f"{folder}/in", f"{folder}/state", "core",
                      lambda: dt.datetime(2026, 1, 1, 0, minute))
        query.awaitTermination()
        return {r.cod_suc: (r.nom_suc, r.fecha_ingesta.minute)
                for r in current(lake, table).collect()}

    drop(("S1", "a"), ("S2", "b"))
    assert drain(1) == {"S1": ("a", 1), "S2": ("b", 1)}
    drop(("S2", "b"), ("S3", "c"))
    assert drain(2) == {"S1": ("a", 1), "S2": ("b", 1), "S3": ("c", 2)}
    assert drain(3) == {"S1": ("a", 1), "S2": ("b", 1), "S3": ("c", 2)}
