import datetime as dt
import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from urbanflow.operators.flatten import discover_keys, flatten_object, projection_text, rows_to_array, schema_rows
from urbanflow.operators.joins import attach_borough, attach_zone_names, one_row_per_key
from urbanflow.operators.predicates import drop_nulls, exclude_values, in_month, not_blank, within_bounds
from urbanflow.operators.project import (
    MissingColumns,
    conform,
    fill_zero,
    keep_present,
    prefix_cols,
    presentation_view,
    rename_first,
    require,
    select_except,
)
from urbanflow.operators.quality import (
    audit_funnel,
    dedup_by_key,
    distinct_count,
    distinct_values,
    flag_counts,
    landing_gaps,
    missing_months,
    null_audit,
    row_count,
    sample_rows,
    table_check,
    time_range,
    top_n,
    value_counts,
)
from urbanflow.operators.rollup import classify_counts, hourly_rollup, weighted_rollup
from urbanflow.schemas import TRIP_BOUNDS, Bound, Measure, layout


def rows(df, *order):
    df = df.orderBy(*order) if order else df
    return [tuple(r) for r in df.collect()]


# --- projections ------------------------------------------------------------


def test_conform(spark):
    df = spark.createDataFrame([("7", "x", 1.5)], "A string, b string, c double")
    got = conform(df, layout("a int, B bigint, c double"))
    assert got.dtypes == [("a", "int"), ("B", "bigint"), ("c", "double")]
    assert rows(got) == [(7, None, 1.5)]
    with pytest.raises(MissingColumns):
        conform(df, layout("d int"))
    assert rows(conform(df, layout("d int, a int"), optional=["d"])) == [(None, 7)]
    assert rows(presentation_view(df, layout("zz string, c double"))) == [(None, 1.5)]


def test_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], "year int, total_complaints int, z int")
    assert rename_first(df, ["complaints_total", "total_complaints"], "n").columns == ["year", "n", "z"]
    assert rename_first(df, ["nope"], "n").columns == df.columns
    assert rename_first(df, ["year"], "z").columns == df.columns
    assert prefix_cols(df, "w").columns == ["w_year", "total_complaints", "z"]
    assert keep_present(df, ["z", "q", "year"]).columns == ["z", "year"]
    assert select_except(df, ["z", "q"]).columns == ["year", "total_complaints"]
    assert require(df, ["Year"]) is df
    with pytest.raises(MissingColumns, match="q"):
        require(df, ["q"])


def test_fill_zero(spark):
    df = spark.createDataFrame([(None, None, None)], "a int, b double, s string")
    assert rows(fill_zero(df)) == [(0, 0.0, None)]
    assert rows(fill_zero(df, ["a", "q"])) == [(0, None, None)]


# --- filters ----------------------------------------------------------------


def test_month_range_is_half_open_and_pushed(spark, tmp_path, plan):
    stamps = ["2023-11-30 23:59:59.999999", "2023-12-01 00:00:00", "2023-12-31 23:59:59.999999", "2024-01-01 00:00:00"]
    df = spark.createDataFrame([(s,) for s in stamps], "s string").select(F.col("s").cast("timestamp_ntz").alias("t"))
    assert df.filter(in_month("t", 2023, 12)).count() == 2
    df.write.parquet(str(tmp_path / "t"))
    text = plan(spark.read.parquet(str(tmp_path / "t")).filter(in_month("t", 2023, 12)))
    assert "GreaterThanOrEqual(t,2023-12-01" in text and "LessThan(t,2024-01-01" in text


def test_bounds(spark):
    inside = (60, 1.0, 1.0, 1.0, 5)
    cases = [
        (inside, True),
        ((0, 1.0, 1.0, 1.0, 5), False),
        ((1, 1.0, 1.0, 1.0, 5), True),
        ((14400, 200.0, 1000.0, 2000.0, 5), True),
        ((14401, 1.0, 1.0, 1.0, 5), False),
        ((60, 200.01, 1.0, 1.0, 5), False),
        ((60, 0.0, 0.0, 0.0, 5), True),
        ((60, -0.01, 1.0, 1.0, 5), False),
        ((60, 1.0, -0.01, 1.0, 5), False),
        ((60, 1.0, 1000.01, 1.0, 5), False),
        ((60, 1.0, 1.0, 2000.01, 5), False),
        ((60, None, 1.0, 1.0, 5), False),
        ((None, 1.0, 1.0, 1.0, 5), False),
        ((60, 1.0, 1.0, 1.0, None), False),
    ]
    schema = "trip_duration_s bigint, trip_distance double, fare_amount double, total_amount double, z int"
    for values, kept in cases:
        df = spark.createDataFrame([values], schema)
        assert within_bounds(df, TRIP_BOUNDS, ["z"]).count() == int(kept), values
    assert within_bounds(df, {"trip_duration_s": Bound(0, 60)}).count() == 1


def test_value_filters(spark):
    df = spark.createDataFrame([("a",), ("b",), ("",), (None,)], "s string")
    assert rows(exclude_values(df, "s", ["a"])) == [("b",), ("",)]
    assert rows(not_blank(df, "s")) == [("a",), ("b",)]
    assert drop_nulls(df).count() == 3 and drop_nulls(df, ["s"]).count() == 3


# --- rollups ----------------------------------------------------------------


def test_hourly_rollup(spark):
    data = [("2024-01-01 05:10:00", 1, 10.0, 60), ("2024-01-01 05:59:59", 1, None, 120), ("2024-01-01 06:00:00", 1, None, None)]
    df = spark.createDataFrame(data, "t string, z int, fare double, s bigint").withColumn("t", F.col("t").cast("timestamp_ntz"))
    got = hourly_rollup(df, "t", ["z"], [Measure("fare", "avg_fare"), Measure("s", "avg_min", 60.0)])
    assert rows(got, "hour_ts") == [
        (dt.datetime(2024, 1, 1, 5), 1, 2, 10.0, 1.5),
        (dt.datetime(2024, 1, 1, 6), 1, 1, None, None),
    ]


def test_exact_sums_do_not_depend_on_order(spark):
    values = [0.1, 0.2, 0.3, 1e9 + 0.07, -0.01, 12.34] * 50
    exact = (1e9 * 100 + 7 + 10 + 20 + 30 - 1 + 1234) * 50 / (300 * 100.0)
    for data in (values, values[::-1], sorted(values)):
        df = spark.createDataFrame([(v,) for v in data], "v double").withColumn("t", F.timestamp_seconds(F.lit(0)))
        (row,) = hourly_rollup(df, "t", [], [Measure("v", "m", digits=2)]).collect()
        assert row["m"] == exact


def test_weighted_rollup(spark):
    df = spark.createDataFrame([("a", 1, 10.0), ("a", 3, 2.0), ("b", 5, None), ("b", 5, 4.0), ("c", 0, 1.0)], "k string, trips bigint, m double")
    assert rows(weighted_rollup(df, ["k"], ["m"]), "k") == [("a", 4, 4.0), ("b", 10, 2.0), ("c", 0, None)]
    assert rows(weighted_rollup(df, ["k"], ["m"], strict=True), "k")[1] == ("b", 10, 4.0)


def test_rollup_combines_before_the_shuffle(spark, plan):
    df = spark.range(1000).select(F.current_timestamp().alias("t"), F.lit(1).alias("z"), F.col("id").alias("v"))
    text = plan(hourly_rollup(df, "t", ["z"], [Measure("v", "m")]))
    assert text.index("Exchange") < text.index("partial_sum") and text.count("Exchange hash") == 1


def test_classes_overlap(spark):
    texts = ["Noise - Street/Sidewalk", "Rodent", None, "Illegal Parking"]
    df = spark.createDataFrame([(1, t) for t in texts], "k int, t string")
    for by in ("regex", "upper"):
        assert rows(classify_counts(df, ["k"], "t", by=by)) == [(1, 4, 1, 1, 2)]


# --- joins ------------------------------------------------------------------


@pytest.fixture
def lookup(spark):
    data = [("1", " bronx", "Zone A", "S"), ("2", "N/A", "Zone B", "S"), ("x", "Queens", "Zone C", "S"), ("4", None, "Zone D", "S")]
    return spark.createDataFrame(data, "LocationID string, Borough string, Zone string, service_zone string")


def test_attach_borough(spark, lookup):
    facts = spark.createDataFrame([(1, 10), (2, 20), (3, 30), (4, 40), (None, 50)], "PULocationID int, trips int")
    assert rows(attach_borough(facts, lookup), "trips") == [(1, 10, "BRONX"), (2, 20, "N/A")]


def test_attach_zone_names(spark, lookup):
    facts = spark.createDataFrame([(1, 10), (3, 30)], "PULocationID int, trips int")
    got = attach_zone_names(facts, lookup).select("locationid", "trips", "borough", "zone")
    assert rows(got, "trips") == [(1, 10, " bronx", "Zone A"), (3, 30, None, None)]


def test_one_row_per_key(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c")], "k int, v string")
    assert one_row_per_key(df, ["k"], "keep").count() == 3
    assert rows(one_row_per_key(df.filter("v <> 'c'"), ["k"]), "k") == [(1, "a"), (2, "b")]
    with pytest.raises(PySparkException, match="repeated key"):
        one_row_per_key(df, ["k"]).collect()


# --- counts and audits ------------------------------------------------------


def test_counts(spark):
    df = spark.createDataFrame([(1, "a", 1), (2, "b", 0), (3, "b", None), (4, None, 1)], "t int, s string, f int")
    assert rows(row_count(df)) == [(4,)]
    assert rows(time_range(df, "t")) == [(1, 4)]
    assert rows(flag_counts(df, ["f", "absent"])) == [(2,)]
    assert rows(null_audit(df, ["s", "f"])) == [(1, 1)]
    assert rows(table_check(df, "t", ["f"], ["s"])) == [(4, 1, 4, 2, 1)]
    assert rows(value_counts(df, "s")) == [("b", 2), (None, 1), ("a", 1)]
    assert rows(distinct_count(df, "s", "f")) == [(2, 2)]
    assert distinct_values(df, "s").count() == 3
    assert rows(top_n(df, 2, F.desc("t"))) == [(4, None, 1), (3, "b", None)]
    assert sample_rows(df, 3).count() == 3


def test_audit_funnel(spark, tmp_path, plan):
    data = [
        ("2024-01", "2024-01-01 00:10:00", 1),
        ("2024-01", "2024-01-01 00:20:00", 1),
        ("2024-01", "2024-01-05 00:00:00", None),
        ("2024-01", "2024-02-01 00:00:00", 1),
        ("2024-01", None, 1),
        ("2024-02", "2023-02-01 00:00:00", 1),
    ]
    df = spark.createDataFrame(data, "ym string, t string, z int").withColumn("t", F.col("t").cast("timestamp_ntz"))
    df.write.parquet(str(tmp_path / "f"))
    got = audit_funnel(spark.read.parquet(str(tmp_path / "f")), "ym", "t", "z", F.date_format("t", "yyyy-MM") == F.col("ym"))
    hour = dt.datetime(2024, 1, 1)
    assert rows(got, "ym") == [("2024-01", 5, 1, 3, 1, 2, 1, hour, hour), ("2024-02", 1, 0, 0, 0, 0, 0, None, None)]
    assert plan(got).count("FileScan") == 1


def test_landing(spark):
    expected = spark.createDataFrame([("a", 3), ("b", 3), ("c", 3), ("d", 3)], "ym string, expected_rows bigint")
    landed = spark.createDataFrame([("a", 3), ("b", 2), ("c", 4), ("z", 1)], "ym string, landed_rows bigint")
    assert rows(landing_gaps(expected, landed, ["ym"]), "ym") == [("b", 3, 2, "short"), ("c", 3, 4, "over"), ("d", 3, 0, "missing")]
    assert rows(missing_months(expected, landed, ["ym"])) == [("d", 3)]


def test_dedup_limits_rows_before_the_shuffle(spark, plan):
    df = spark.range(1000).select(F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("o"))
    got = dedup_by_key(df, ["k"], "o")
    assert got.count() == 334 and got.filter("k = 0").first()["o"] == 0
    text = plan(got)
    assert text.count("WindowGroupLimit") == 2 and text.index("Final") < text.index("Exchange") < text.index("Partial")


# --- objects ----------------------------------------------------------------


@pytest.fixture
def objects(spark):
    data = [(1, '{"Trips": 1, "trips": "x", "a.b": null}'), (2, '{"Trips": 2.5}'), (3, "broken"), (4, None), (5, '{"deep": {"q": [1]}}')]
    return spark.createDataFrame(data, "id int, value string")


def test_discover_keys(objects):
    got = rows(discover_keys(objects, "value").select("key", "column_name"), "key")
    assert got == [("Trips", "v_trips"), ("a.b", "v_a.b"), ("deep", "v_deep"), ("trips", "v_trips_2")]
    only = discover_keys(objects, "value", prefix="", where=F.col("id") == 2)
    assert rows(only.select("key", "column_name")) == [("Trips", "trips")]
    text = projection_text(only).first()[0]
    assert text == """try_variant_get(value, '$["Trips"]', 'string') AS `trips`"""


def test_flatten_object(objects):
    got = flatten_object(objects, "value")
    assert got.columns == ["id", "v_a.b", "v_deep", "v_trips", "v_trips_2"]
    assert rows(got, "id") == [
        (1, None, None, "1", "x"),
        (2, None, None, "2.5", None),
        (3, None, None, None, None),
        (4, None, None, None, None),
        (5, None, '{"q":[1]}', None, None),
    ]
    with pytest.raises(ValueError, match="clash"):
        flatten_object(objects, "value", keys=[("a", "id")])


def test_flatten_variant(spark):
    df = spark.sql("SELECT 1 AS id, parse_json('{\"A\": 5, \"a\": \"t\"}') AS value")
    assert isinstance(df.schema["value"].dataType, T.VariantType)
    got = flatten_object(df, "value")
    assert got.columns == ["id", "v_a", "v_a_2"] and rows(got) == [(1, "5", "t")]


ODD = {"a": 1, "A": 2, "a_2": 3, "a_3": 4, "a.b": 5, "it's": 6, 'say "x"': 7, "k[0]": [8, 9], "both ' and \"": 10, "back\\slash": 11, "tick`": 12, "$": 13, "é ü": 14}


@pytest.mark.parametrize("variant", [True, False])
@pytest.mark.parametrize("typed", [True, False])
def test_odd_keys(spark, variant, typed):
    df = spark.createDataFrame([(1, json.dumps(ODD)), (2, json.dumps({"a.b": -5, "a": {"b": 99}})), (3, "no json"), (4, None)], "id int, value string")
    df = df.withColumn("value", F.try_parse_json("value")) if variant else df
    named = discover_keys(df, "value", typed=typed)
    names = {r["key"]: r["column_name"] for r in named.collect()}
    assert set(names) == set(ODD)
    assert (names["A"], names["a"], names["a_2"], names["a_3"]) == ("v_a", "v_a_4", "v_a_2", "v_a_3")
    got = {r["id"]: r for r in flatten_object(df, "value", typed=typed).collect()}
    for key, value in ODD.items():
        found = got[1][names[key]]
        if typed and key != "a":  # a holds a number and an object
            assert found == value and type(found) is type(value)
        else:
            assert json.loads(found) == value
    assert str(got[2][names["a.b"]]) == "-5" and json.loads(got[2][names["a"]]) == {"b": 99}
    assert not any(got[3][n] for n in names.values()) and not any(got[4][n] for n in names.values())
    # the text is SQL that does the same
    source = "value" if variant else "try_parse_json(value)"
    df.createOrReplaceTempView("odd_rows")
    text = projection_text(named, source).first()[0]
    plain = spark.sql(f"SELECT id, {text} FROM odd_rows").orderBy("id")
    assert plain.collect() == [got[i] for i in (1, 2, 3, 4)] or not variant and not typed  # json_tuple writes text its own way


def test_key_types(spark):
    data = ['{"n": 1, "x": 1, "d": 1.5, "m": 1, "z": null, "o": {"q": 1}, "l": ["a"], "f": 1e300}', '{"n": 9999999999, "x": 2.25, "m": "t", "d": 0.125, "l": []}']
    df = spark.createDataFrame([(v,) for v in data], "value string")
    types = {r["key"]: r["type"] for r in discover_keys(df, "value", typed=True).collect()}
    assert types["n"] == "bigint" and types["x"].startswith("decimal(") and types["d"] == "decimal(4,3)"
    assert (types["m"], types["z"], types["o"], types["l"], types["f"]) == ("string", "string", "string", "array<string>", "double")


def test_rows_to_array(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (2, "c")], "k int, v string")
    assert [(r["k"], [i["v"] for i in r["items"]]) for r in rows_to_array(df, ["k"], ["v"]).orderBy("k").collect()] == [
        (1, ["a", "b"]),
        (2, ["c"]),
    ]
    assert rows(schema_rows(df), "order_id") == [(0, "k", "int", True), (1, "v", "string", True)]
