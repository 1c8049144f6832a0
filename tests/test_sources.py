import os
import json

import pytest
from pyspark.sql import functions as F

from delaykit.operators import models
from delaykit.operators import enrichment
from delaykit.sources import csv_files, sinks, tables


def put(folder, name, text):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text)


def test_directory_of_csvs(spark, tmp_path):
    put(tmp_path, "a.csv", "x,y\n1,2\n3,4\n")
    put(tmp_path, "B.CSV", "y,x,z\n6,5,7\n")
    put(tmp_path, "empty.csv", "")
    put(tmp_path, "note.txt", "x\n9\n")
    put(tmp_path / "deeper", "c.csv", "x\n8\n")
    got = csv_files.scan_csv_dir(spark, str(tmp_path)).select("x", "y", "z").collect()
    assert sorted(map(tuple, got)) == sorted([("1", "2", None), ("3", "4", None), ("5", "6", "7")])


def test_no_csv(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        csv_files.scan_csv_dir(spark, str(tmp_path))


def test_reports_below_a_folder(spark, tmp_path):
    put(tmp_path / "p" / "q", "Airline_Delay_Cause.csv", "year,carrier,arr_flights\n2024,AA,7\n")
    put(tmp_path / "r", "airline_delay_cause.csv", "something,else\n1,2\n")
    df = csv_files.scan_delay_cause(spark, str(tmp_path))
    assert [tuple(r) for r in csv_files.typed_delay_cause(df).collect()] == [(2024.0, "AA", 7.0)]
    assert csv_files.scan_delay_cause(spark, str(tmp_path / "none")) is None


def test_single_csv(spark, tmp_path):
    put(tmp_path, "one.csv", "carrier,n\nAA,1\n")
    assert csv_files.scan_single_csv(spark, str(tmp_path / "one.csv")).count() == 1


def test_tables_and_lookups(spark, tmp_path):
    df = spark.createDataFrame([(2024, 1, "x"), (2024, 2, "y")], "year int, month int, v string")
    sinks.write_tables(
        {"lookup_airport": df, "lookup_carrier": df}, str(tmp_path), partition_by={"lookup_carrier": ["year", "month"]}
    )
    found = tables.load_lookups(spark, str(tmp_path))
    assert found.airport.count() == 2 and found.carrier.filter("month = 2").count() == 1 and found.route is None
    sinks.write_history(df, str(tmp_path / "h"), "csv")
    assert spark.read.option("header", True).csv(str(tmp_path / "h")).count() == 2


def test_run_summary_and_model(spark, tmp_path):
    data = spark.range(40).select(
        F.col("id").cast("double").alias("a"), (F.col("id") * 2.0 + 1).alias("DEP_DELAY")
    )
    fitted, metrics = models.train_and_evaluate({"linear": models.pipeline(models.linear(), ["a"], ())}, data, data)
    assert models.select_best(metrics).first()["mae"] == pytest.approx(0.0, abs=1e-6)
    sizes = spark.createDataFrame([(40, 40)], "n_train long, n_test long")
    summary = sinks.training_summary(metrics, sizes, {"LAX", "ATL"}, target="DEP_DELAY")
    sinks.write_metadata(summary, str(tmp_path / "meta"))
    part = next((tmp_path / "meta").glob("part-*.json"))
    told = json.loads(part.read_text())
    assert told["best_model"] == "linear" and told["n_test"] == 40 and told["major_hubs"] == ["ATL", "LAX"]
    sinks.save_model(fitted["linear"], str(tmp_path / "model"))
    again = models.scored(sinks.load_model(str(tmp_path / "model")), data)
    assert again.filter(F.abs(F.col("predicted") - F.col("DEP_DELAY")) > 1e-6).count() == 0


def test_headers_with_commas_and_files_that_cannot_be_read(spark, tmp_path):
    put(tmp_path, "a.csv", '"x, first","say ""y""",z\n1,2,3\n')
    put(tmp_path, "b.csv", 'z,"x, first"\n6,4\n')
    put(tmp_path, "blank.csv", "\n")
    put(tmp_path, "long.csv", '"' + "x" * 70_000 + "\n")
    os.symlink(tmp_path / "gone", tmp_path / "broken.csv")
    got = csv_files.scan_csv_dir(spark, str(tmp_path))
    assert set(got.columns) == {"x, first", 'say "y"', "z"}
    assert sorted(r["x, first"] + r["z"] for r in got.collect()) == ["13", "46"]
    left_out = {r["file"].split("/")[-1] for r in csv_files.unreadable_files(spark, str(tmp_path)).collect()}
    assert left_out >= {"blank.csv", "long.csv"} and not left_out & {"a.csv", "b.csv"}


def test_a_saved_route_is_there_once(spark, tmp_path):
    for name in ("airport", "carrier"):
        spark.range(1).write.parquet(str(tmp_path / f"lookup_{name}"))
    rows = [("AA1", "ATL", "DEN", 100.0), ("AA2", "ATL", "DEN", 300.0), ("AA3", "DEN", "ATL", 5.0), ("AA4", None, "ATL", 5.0)]
    spark.createDataFrame(rows, "FLIGHT string, ORIGIN string, DEST string, DISTANCE double").write.parquet(str(tmp_path / "flight_lookup"))
    routes = tables.load_lookups(spark, str(tmp_path)).route
    assert sorted(tuple(r) for r in routes.collect()) == [("ATL", "DEN", 200.0), ("DEN", "ATL", 5.0)]
    requests = spark.createDataFrame([("ATL", "DEN"), ("X", "Y")], "origin string, dest string")
    assert enrichment.route_lookup_default(requests, routes).count() == 2
