import datetime
from decimal import Decimal

from pyspark.sql import functions as F

from tallyloom.queries import load_all

KINDS = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"


def rows_of(spark, folder, name):
    at = datetime.datetime(2024, 1, 1, 12, tzinfo=datetime.timezone.utc)
    users = [(0, 150), (2, 9_999), (4, 10_000), (6, 89_999), (7, 89_999), (8, None)]
    events = [(event, at + datetime.timedelta(hours=event), user, "view", 250.0, "{}") for event, user in users]
    spark.createDataFrame(events, KINDS).write.mode("overwrite").parquet(f"{folder}/events.parquet")
    return load_all()[name].run(spark, str(folder))


def test_shares_of_users_beyond_four_digits(spark, tmp_path):
    staged = rows_of(spark, tmp_path, "staged_results").filter(F.col("nm_candidato_origem") == "Beta")
    shares = sorted(row["pc_votos_validos_acumulado"] for row in staged.collect())
    assert shares == [Decimal(s) for s in ("0.1500", "9.9990", "10.0000", "89.9990")]


def test_final_shares_of_users_beyond_four_digits(spark, tmp_path):
    final = rows_of(spark, tmp_path, "results_fact").filter("fl_resultado_final").collect()
    assert {(r["nr_turno"], r["nm_candidato"]) for r in final} == {(1, "Alpha 1"), (2, "Alpha 1")}
    sums = {r["nr_turno"]: r["pc_soma"] for r in rows_of(spark, tmp_path, "final_results_off_balance").collect()}
    assert sums == {1: Decimal("25.0000"), 2: Decimal("25.0000")}
