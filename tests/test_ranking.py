"""Ranking by index."""

import random

import pytest
from pyspark.sql import functions as F

from hazeline import plans
from hazeline.operators import filter_parameter, rank_by_aqi, top_aqi
from hazeline.sinks import write_table

READING = "ParameterName string, AQI float, area string"


def readings(spark, rows):
    return spark.createDataFrame(rows, READING)


ROWS = [
    ("PM2.5", 3.0, "c"),
    ("PM2.5", None, "e"),
    ("PM2.5", 9.0, "a"),
    ("O3", 99.0, "x"),
    (None, 98.0, "y"),
    ("pm2.5", 97.0, "z"),
    ("PM2.5", 5.0, "b"),
    ("PM2.5", 0.0, "d"),
]


def test_parameter_filter_is_exact(spark):
    assert filter_parameter(readings(spark, ROWS)).count() == 5
    assert filter_parameter(readings(spark, ROWS), "O3").first().area == "x"


def test_all_forms_rank_alike(spark, tmp_path):
    df = readings(spark, ROWS)
    path = str(tmp_path / "t")
    write_table(df, path, files=3)
    df.createOrReplaceTempView("some_readings")
    ranked = {
        "frame": rank_by_aqi(filter_parameter(df)),
        "table": plans.rank_table(spark, path),
        "sql": plans.rank_sql(spark, "some_readings"),
        "top": top_aqi(df),
        "top table": plans.top_table(spark, path),
    }
    for form, result in ranked.items():
        assert result.columns == df.columns, form
        assert "".join(r.area for r in result.collect()) == "abcde", form


def test_sql_parameter_is_a_value(spark):
    readings(spark, ROWS).createOrReplaceTempView("some_readings")
    assert plans.rank_sql(spark, "some_readings", "' OR '1'='1").count() == 0


def test_top_k_with_tie_break(spark):
    rows = [("PM2.5", float(i % 3), f"{i:02d}") for i in range(30)]
    random.Random(3).shuffle(rows)
    df = readings(spark, rows).repartition(5)
    best = top_aqi(df, k=12, tie_break=("area",)).collect()
    expected = sorted(rows, key=lambda r: (-r[1], r[2]))[:12]
    assert [tuple(r) for r in best] == expected


def test_top_k_needs_no_full_sort(spark, tmp_path, plan):
    path = str(tmp_path / "t")
    write_table(readings(spark, ROWS), path)
    text = plan(plans.top_table(spark, path))
    assert "TakeOrderedAndProject" in text and "Exchange" not in text
    assert "PushedFilters: [IsNotNull(ParameterName), EqualTo(ParameterName,PM2.5)]" in text
    narrow = plan(plans.top_table(spark, path).select("AQI"))
    assert "EqualTo(ParameterName,PM2.5)" in narrow


@pytest.mark.parametrize("identical", [False, True])
def test_one_value_in_most_rows_is_divided(spark, tmp_path, identical):
    area = F.lit("same") if identical else F.col("id").cast("string")
    df = spark.range(60_000).select(
        F.lit("PM2.5").alias("ParameterName"),
        F.when(F.col("id") % 10 < 9, 50).otherwise(F.col("id")).cast("float").alias("AQI"),
        area.alias("area"),
    )
    path = str(tmp_path / "t")
    write_table(df, path)
    df.createOrReplaceTempView("hot_readings")
    forms = [plans.rank_table(spark, path), rank_by_aqi(df), plans.rank_sql(spark, "hot_readings")]
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalesce, "false")
    try:
        for ranked in forms:
            placed = ranked.select("AQI", F.spark_partition_id().alias("p"))
            sizes = [r["count"] for r in placed.groupBy("p").count().collect()]
            assert sum(sizes) == 60_000
            assert max(sizes) < 20_000
    finally:
        spark.conf.unset(coalesce)


def test_working_names_take_no_column_away(spark, tmp_path):
    rows = spark.createDataFrame(
        [("PM2.5", 3.0, 1, 2, 3, 4, 5), ("PM2.5", 4.0, 6, 7, 8, 9, 10)],
        "ParameterName string, AQI float, _place int, _FILE int, _row int, tie int, place int",
    )
    path = str(tmp_path / "t")
    rows.write.parquet(path)
    rows.createOrReplaceTempView("clashing")
    expected = sorted(map(tuple, rows.collect()), reverse=True, key=lambda row: row[1])
    ranked = (rank_by_aqi(rows), plans.rank_table(spark, path), plans.rank_sql(spark, "clashing"))
    for frame in ranked:
        assert frame.columns == rows.columns
        assert list(map(tuple, frame.collect())) == expected
