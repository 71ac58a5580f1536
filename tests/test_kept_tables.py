"""The cube, partial totals, clustered and bucketed tables."""

import random
import re
from datetime import datetime, timedelta
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from profitlens.functions import arithmetic
from profitlens.operators import aggregates, cube, filters, kpis
from profitlens.operators.cleaning import with_delivery_overrun
from profitlens.plans import queries, refresh
from profitlens.sources import star, tables

WANTED = {"customer_segment": ["BUILDING", "nobody"], "category_name": ["b", "c"], "market": ["ASIA", "EUROPE"]}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def items(spark):
    random.seed(5)
    rows = [
        (
            random.choice([*range(40), 1 << 40, -7, None]), random.choice([*range(70_000, 70_300), None]), random.choice(["BUILDING", "AUTO", None]),
            random.choice("abcde"), random.choice(["ASIA", "EUROPE", "AFRICA"]), random.choice([0.1, 0.2, 1e9, 3.3, float("nan"), None]), random.uniform(-9, 9),
        )
        for _ in range(3000)
    ]
    return spark.createDataFrame(
        rows, "customer_id long, order_id long, customer_segment string, category_name string, market string, sales double, profit double"
    ).repartition(5)


def test_kept_sums_merge_to_the_same_bits(spark):
    random.seed(1)
    rows = [(i, random.choice([0.1, 1e-9, 1e15, -3.3, 7.0, None, float("inf")])) for i in range(2000)]
    df = spark.createDataFrame(rows, "i long, v double")
    whole = df.agg(arithmetic.total("v"), arithmetic.mean("v")).first()
    for parts in (1, 7, 50):
        kept = df.groupBy((F.col("i") % parts).alias("g")).agg(*arithmetic.partial_sums("v", "v"))
        again = kept.groupBy((F.col("g") % 3).alias("h")).agg(*arithmetic.merged_sums("v"))
        for table in (kept, again):
            assert tuple(table.agg(arithmetic.merged_total("v"), arithmetic.merged_mean("v")).first()) == tuple(whole)


def test_every_selection_of_the_cube(spark, items, tmp_path):
    cube.write_cube(cube.build_cube(items), str(tmp_path))
    kept = cube.read_cube(spark, str(tmp_path))
    for n in range(4):
        for chosen in combinations(WANTED, n):
            own = {d: WANTED[d] for d in chosen}
            assert cube.routed_kpis(kept, **own).collect() == kpis.filtered_kpis(filters.cross_filter(items, **own)).collect()
    nothing = {"market": ["nowhere"]}
    assert cube.routed_kpis(kept, **nothing).collect() == kpis.filtered_kpis(filters.cross_filter(items, **nothing)).collect()


def test_a_selection_reads_one_level_of_the_cube(spark, items, tmp_path):
    cube.write_cube(cube.build_cube(items), str(tmp_path))
    plan = plan_of(cube.routed_kpis(cube.read_cube(spark, str(tmp_path)), market=["ASIA"]))
    # customer_segment, category_name, market: the two that are summed up
    assert len(re.findall(r"PartitionFilters: \[isnotnull\(level#\d+\), \(level#\d+ = 6\)\]", plan)) >= 2
    assert "sales_large" in plan and "bitmap" in plan


def test_the_registered_cube_answers_without_order_items(spark, data):
    plan = plan_of(queries.all_queries()["routed_kpis"](spark, data))
    assert "l_extendedprice" not in plan and "l_orderkey" not in plan and "sales_large" in plan and "bitmap" in plan


def test_a_cube_without_orders_counts_rows(spark, items):
    without = items.drop("order_id")
    made = cube.build_cube(without)
    assert cube.routed_kpis(made, market=["ASIA"]).collect() == kpis.filtered_kpis(without.filter("market = 'ASIA'")).collect()


@pytest.mark.parametrize("unit", ["day", "month"])
def test_loads_in_any_order_equal_a_rebuild(spark, data, tmp_path, unit):
    items = star.transactions(spark, data)
    first = items.agg(F.min("order_date")).first()[0]
    items = items.filter(F.col("order_date") < first + timedelta(days=100))
    folder, third = str(tmp_path), F.pmod(F.month("order_date") if unit == "month" else F.dayofyear("order_date"), F.lit(3))
    for number in (1, 2, 1, 0):
        refresh.load(items.filter(third == number), folder, unit)
    rows = with_delivery_overrun(items)

    def same(ours, theirs):
        assert sorted(ours.columns) == sorted(theirs.columns)
        order = sorted(ours.columns)
        assert sorted(map(tuple, ours.select(order).collect())) == sorted(map(tuple, theirs.select(order).collect()))

    same(refresh.monthly_trend(spark, folder).na.fill(0.0), kpis.monthly_trend(items).na.fill(0.0))
    same(refresh.category_agg(spark, folder), aggregates.category_agg(items))
    same(refresh.product_agg(spark, folder), aggregates.product_agg(items))
    same(refresh.place_agg(spark, folder, "market"), aggregates.market_agg(items))
    same(refresh.place_agg(spark, folder, "order_region"), aggregates.region_agg(items))
    same(refresh.place_agg(spark, folder, "order_country"), aggregates.country_agg(items))
    same(refresh.shipping_agg(spark, folder), aggregates.shipping_agg(rows))


def test_a_load_replaces_its_days_only(spark, tmp_path):
    schema = "order_date timestamp_ntz, market string, product_name string, sales double, profit double, quantity double, discount_rate double"
    first = [("1995-01-01 05:00:00", "A", "p", 1.0), ("1995-01-02 00:00:00", "A", "p", 10.0), (None, "A", "p", 100.0)]
    second = [("1995-01-02 23:59:59", "B", "p", 20.0)]

    def frame(rows):
        return spark.createDataFrame([(d and datetime.fromisoformat(d), m, p, s, s, 1.0, 0.0) for d, m, p, s in rows], schema)

    refresh.load(frame(first), str(tmp_path))
    refresh.load(frame(second), str(tmp_path))
    found = {r["market"]: r["total_sales"] for r in refresh.place_agg(spark, str(tmp_path), "market").collect()}
    assert found == {"A": 101.0, "B": 20.0}
    assert [(r["month"], r["monthly_revenue"]) for r in refresh.monthly_trend(spark, str(tmp_path)).collect()] == [("1995-01", 21.0)]


@pytest.fixture(scope="module")
def clustered(spark, data, tmp_path_factory):
    items = star.transactions(spark, data)
    path = tables.write_clustered(items, str(tmp_path_factory.mktemp("clustered")), "t", ["market"], ["customer_segment", "category_name"], files=3)
    return items, spark.read.parquet(path)


def files_read(df):
    shown = df.select("sales")
    shown.collect()
    leaves = shown._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numFiles").value() for i in range(leaves.size()))


def test_clustered_tables_are_pruned(spark, clustered):
    items, kept = clustered
    chosen = filters.cross_filter(kept, market=["ASIA", "EUROPE"], customer_segment=["BUILDING"])
    plan = plan_of(chosen)
    assert re.search(r"PartitionFilters: \[market#\d+ IN \(ASIA,EUROPE\)\]", plan)
    assert re.search(r"PushedFilters: \[.*customer_segment", plan)
    assert files_read(chosen) < files_read(kept) / 2
    assert chosen.count() == filters.cross_filter(items, market=["ASIA", "EUROPE"], customer_segment=["BUILDING"]).count()


def test_a_selection_table_prunes_while_running(spark, clustered):
    items, kept = clustered
    regions = spark.createDataFrame([("ASIA", "east"), ("EUROPE", "west"), ("AFRICA", "south")], "market string, side string")
    chosen = filters.matching(kept, regions.filter("side = 'east'"), ["market"])
    assert "dynamicpruning" in plan_of(chosen)
    assert chosen.count() == items.filter("market = 'ASIA'").count()


def test_bucketed_tables_meet_without_an_exchange(spark, data):
    joined = queries.all_queries()["bucketed_customer_join"](spark, data)
    plan = plan_of(joined)
    assert plan.count("SortMergeJoin") == 2 and "Exchange" not in plan
    assert joined.count() == star.transactions(spark, data).select("customer_id").distinct().count()


def test_a_large_unit_is_written_by_several_tasks(spark, items, tmp_path, monkeypatch):
    monkeypatch.setattr(refresh, "ROWS_A_TASK", 300, raising=False)
    rows = items.withColumns({
        "order_date": F.lit("1995-01-05").cast("timestamp_ntz"), "product_name": F.concat("category_name", F.col("order_id").cast("string")),
        "quantity": F.lit(1.0), "discount_rate": F.lit(0.1),
    })
    refresh.load(rows, str(tmp_path), "month")
    assert len(list((tmp_path / "partials_products.parquet" / "unit=1995-01").glob("*.parquet"))) > 3
    kept = refresh.product_agg(spark, str(tmp_path)).orderBy("product_name")
    named = aggregates.product_agg(rows).filter("product_name IS NOT NULL").select(kept.columns).orderBy("product_name")
    assert kept.collect() == named.collect()


def test_kept_sums_of_small_steps_are_narrow(spark):
    kept = spark.range(3).select(F.col("id").cast("double").alias("v")).agg(*arithmetic.partial_sums("v", "v"))
    assert [t for _, t in kept.dtypes] == ["decimal(38,0)"] + ["bigint"] * 4
    assert kept.agg(*arithmetic.merged_sums("v")).dtypes == kept.dtypes


def test_one_value_of_the_keys_is_several_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "ROWS_A_FILE", 100, raising=False)
    rows = spark.range(1000).select("id", F.lit("ASIA").alias("market"), F.lit("AUTO").alias("customer_segment"))
    path = tables.write_clustered(rows, str(tmp_path), "t", ["market"], ["customer_segment"])
    kept = spark.read.parquet(path)
    sizes = [r["count"] for r in kept.groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) > 5 and max(sizes) < 300
    assert sorted(r["id"] for r in kept.collect()) == list(range(1000))


def test_a_level_of_the_cube_is_written_by_several_tasks(spark, items, tmp_path, monkeypatch):
    monkeypatch.setattr(cube, "BITMAPS_A_TASK", 16, raising=False)
    monkeypatch.setattr(cube, "IDS_A_TASK", 500, raising=False)
    cube.write_cube(cube.build_cube(items), str(tmp_path))
    assert len(list((tmp_path / "cube_sets.parquet" / "level=0").glob("*.parquet"))) > 1
    kept = cube.read_cube(spark, str(tmp_path))
    assert kept.sets.groupBy("level", "kind", "bucket", *kept.dimensions).count().filter("count > 1").isEmpty()
    for own in ({}, {"market": ["ASIA"]}, WANTED):
        assert cube.routed_kpis(kept, **own).collect() == kpis.filtered_kpis(filters.cross_filter(items, **own)).collect()
