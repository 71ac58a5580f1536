"""CSV, parquet, JSON, views and the whole batch."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from profitlens.config import Thresholds
from profitlens.plans.batch import run_batch
from profitlens.session import name_shared_folder, shared_folder, stage
from profitlens.sources import csv, star, tables

HEADER = "Customer Id,Market,BENEFIT_PER_ORDER,Sales,order date (DateOrders),Customer City,Unknown Column\n"
LINES = "1,LATAM,5.5,10.25,1/31/2018 22:56,México,x\n2,EU,NaN,oops,never,\"a, b\",y\n"


@pytest.mark.parametrize("encoding", ["utf-8", "utf-8-sig", "latin-1"])
def test_csv_in_either_encoding(spark, tmp_path, encoding):
    path = tmp_path / "raw.csv"
    path.write_bytes((HEADER + LINES).encode(encoding))
    df = csv.read_transactions_csv(spark, str(path))
    assert df.columns == ["customer_id", "market", "benefit_per_order", "sales", "order_date", "customer_city"]
    assert dict(df.dtypes)["order_date"] == "timestamp_ntz"
    first, second = df.orderBy("customer_id").collect()
    assert (first["sales"], first["customer_city"]) == (10.25, "México")
    assert (second["sales"], second["benefit_per_order"], second["order_date"]) == (None, None, None)
    assert second["customer_city"] == "a, b"


def test_each_value_has_its_own_encoding(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_bytes(HEADER.encode() + LINES.encode("utf-8") + LINES.replace("2,EU", "3,ß").encode("latin-1"))
    rows = csv.read_transactions_csv(spark, str(path)).collect()
    assert sorted(r["customer_city"] for r in rows) == ["México", "México", "a, b", "a, b"]
    assert {r["market"] for r in rows if r["customer_id"] == 3} == {"ß"}
    plain = csv.read_transactions_csv(spark, str(path), encoding="ISO-8859-1").collect()
    assert "MÃ©xico" in {r["customer_city"] for r in plain}


def test_numbers_that_are_not_finite_are_null_on_every_read(spark, tmp_path):
    rows = [(1.5, 2.5), (float("nan"), float("-inf")), (float("inf"), None)]
    df = spark.createDataFrame(rows, "x double, y float")
    path = tables.write_table(df, str(tmp_path), "numbers")
    expected = {(1.5, 2.5), (None, None)}
    assert {tuple(r) for r in tables.read_or_empty(spark, path, df.schema).collect()} == expected
    tables.register_views(spark, [path])
    assert {tuple(r) for r in tables.run_sql(spark, "SELECT * FROM numbers").collect()} == expected
    text = spark.createDataFrame([("Infinity",), ("NaN",), ("2.5",)], "sales string")
    assert {r[0] for r in csv.cast_tolerant(text).collect()} == {None, 2.5}


def test_csv_scan_reads_only_the_columns_asked_for(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text(HEADER + LINES)
    df = csv.read_transactions_csv(spark, str(path)).select("market")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<Market:string>" in plan


def test_missing_table_is_empty(spark, tmp_path):
    schema = spark.createDataFrame([(1, "a")], "i int, s string").schema
    assert tables.read_or_empty(spark, str(tmp_path / "none.parquet"), schema).count() == 0
    path = tables.write_table(spark.createDataFrame([(1, "a")], schema), str(tmp_path), "some")
    assert tables.read_or_empty(spark, path, schema).count() == 1


def test_json_roundtrip_over_several_lines(spark, tmp_path):
    path = tmp_path / "kpis.json"
    path.write_text(json.dumps({"total_revenue": 1.5, "nested": {"a": 2}}, indent=4))
    row = tables.read_json(spark, str(path)).first()
    assert row["total_revenue"] == 1.5 and row["nested"]["a"] == 2
    tables.write_json(spark.createDataFrame([(1.5,)], "v double"), str(tmp_path / "out.json"))
    assert spark.read.json(str(tmp_path / "out.json")).first()["v"] == 1.5


def test_views_and_parameters(spark, tmp_path):
    df = spark.createDataFrame([("a", 1.0), ("b'; --", 2.0)], "name string, v double")
    tables.write_table(df, str(tmp_path), "some_table", narrow=True)
    assert tables.register_views(spark, tables.list_tables(spark, str(tmp_path))) == ["some_table"]
    got = tables.run_sql(spark, "SELECT v FROM some_table WHERE name = :name", {"name": "b'; --"})
    assert got.collect()[0]["v"] == 2.0 and dict(got.dtypes)["v"] == "float"


def test_plain_sql(spark):
    assert [tuple(r) for r in tables.run_sql(spark, "SELECT 1 AS test_col").collect()] == [(1,)]


def test_staged_tables_go_to_the_shared_folder(spark):
    staged = stage(spark.range(5).withColumn("s", F.lit("x")), "five")
    assert staged.count() == 5
    files = staged.inputFiles()
    assert files and all(shared_folder(spark).replace("file:", "") in f for f in files)


class FakeContext:
    def __init__(self, master):
        self.master, self.folder = master, None

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


class FakeSession:
    """Stands in for a session without the setting."""

    def __init__(self, master):
        self.sparkContext = FakeContext(master)
        self.conf = {}


def test_the_shared_folder_has_to_be_named():
    for master in ("yarn", "local[2]"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            shared_folder(FakeSession(master))
    cluster, local = FakeSession("yarn"), FakeSession("local[2]")
    for session in (cluster, local):
        name_shared_folder(session, lambda: "/some/folder")
    assert cluster.sparkContext.folder is None and shared_folder(local) == "/some/folder"
    local.conf = {"spark.checkpoint.dir": "hdfs://shared/"}
    assert shared_folder(local) == "hdfs://shared"


def test_batch_writes_every_table(spark, data, tmp_path):
    raw = star.transactions(spark, data)
    paths = run_batch(raw, str(tmp_path), Thresholds(sample_rows=200))
    names = {Path(p).name for p in paths}
    assert {
        "transactions.parquet", "customer_agg.parquet", "rfm_segments.parquet", "abc_classification.parquet",
        "macro_kpis.parquet", "insights.parquet", "spatial_nodes_agg.parquet", "ui_sample.parquet",
        "segmented_customers.parquet", "product_agg_advanced.parquet", "monthly_trend.parquet",
    } <= names
    report = tables.read_json(spark, str(tmp_path / "cleaning_report.json")).first()
    clean = spark.read.parquet(str(tmp_path / "transactions.parquet"))
    assert report["final_rows"] == clean.count()
    assert spark.read.parquet(str(tmp_path / "ui_sample.parquet")).count() == 200
    document = json.loads(next((tmp_path / "macro_kpis.json").glob("part-*")).read_text())
    assert len(document["segment_discount_elasticity"]) == 5 and document["n_orders"] > 0
    found = json.loads(next((tmp_path / "insights.json").glob("part-*")).read_text())
    customers = spark.read.parquet(str(tmp_path / "customer_agg.parquet")).count()
    assert sum(found["rfm_distribution"].values()) == customers


def test_batch_without_dates_places_and_order_ids(spark, data, tmp_path):
    raw = star.transactions(spark, data).drop(
        "order_date", "ship_date", "order_id", "latitude", "longitude", "scheduled_days", "order_region"
    )
    names = {Path(p).name for p in run_batch(raw, str(tmp_path))}
    assert "monthly_trend.parquet" not in names and "spatial_nodes_agg.parquet" not in names
    assert "rfm_segments.parquet" in names
