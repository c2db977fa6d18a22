import datetime as dt

from pyspark.sql import functions as F

from urbanflow.functions.text import get_path, label, mentions, mentions_upper, path_number, unquote
from urbanflow.functions.times import (
    bucket,
    epoch_nanos_to_time,
    minutes_between,
    month_bounds,
    month_range,
    month_tag,
    parse_time,
    seconds_between,
    time_from_parts,
)
from urbanflow.functions.weather import code_in, code_text, is_extreme
from urbanflow.schemas import COMPLAINT_CLASSES, RAIN_TEXT, SNOW_TEXT


def column(df, *exprs):
    return [tuple(r) for r in df.select(*exprs).collect()]


def test_labels_and_quotes(spark):
    df = spark.createDataFrame([(" queens ",), ('"Bronx" ',), (None,)], "s string")
    assert column(df, label("s")) == [("QUEENS",), ('"BRONX"',), (None,)]
    assert column(df, unquote("s")) == [("queens",), ("Bronx",), (None,)]


def test_keyword_tests_agree(spark):
    texts = ["Noise - Street/Sidewalk", "UNSANITARY", "nOiSe", "", None, "Heat", "Pest (rodent)", "PARKING"]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    for words in COMPLAINT_CLASSES.values():
        expected = [any(w in (t or "").lower() for w in words) for t in texts]
        assert [r[0] for r in column(df, mentions("s", words))] == expected
        assert [r[0] for r in column(df, mentions_upper("s", words))] == expected


def test_keywords_are_literal(spark):
    df = spark.createDataFrame([("a.b",), ("axb",)], "s string")
    assert column(df, mentions("s", ["a.b"])) == [(True,), (False,)]


def test_paths(spark):
    df = spark.createDataFrame([("x/year=2023/month=01/p",), ("x/p",), (None,)], "p string")
    assert column(df, path_number("p", "year"), path_number("p", "month")) == [(2023, 1), (None, None), (None, None)]
    df = spark.createDataFrame([('{"a": {"b": 3}}',), ("broken",)], "j string")
    assert column(df, get_path("j", "$.a.b")) == [("3",), (None,)]


def test_durations_floor_each_side(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-01-01 00:00:00.9' a, timestamp_ntz'2024-01-01 00:01:00.1' b")
    assert column(df, seconds_between("a", "b"), minutes_between("a", "b")) == [(60, 1.0)]


def test_time_expressions(spark):
    df = spark.createDataFrame([("2024-02-29 13:59:59",), ("nonsense",), (None,)], "s string")
    t = df.select(parse_time("s").alias("t"))
    assert t.dtypes == [("t", "timestamp_ntz")]
    assert column(t, "t", bucket("t"), bucket("t", "day"), month_tag("t"))[0] == (
        dt.datetime(2024, 2, 29, 13, 59, 59),
        dt.datetime(2024, 2, 29, 13),
        dt.datetime(2024, 2, 29),
        "2024-02",
    )
    assert column(t, "t")[1:] == [(None,), (None,)]


def test_time_from_parts(spark):
    df = spark.createDataFrame([(2024, 2, 29, 5), (2023, 2, 29, 5), (None, 1, 1, 1)], "year int, month int, day int, hour int")
    assert column(df, time_from_parts()) == [(dt.datetime(2024, 2, 29, 5),), (None,), (None,)]


def test_epoch_nanos(spark):
    nanos = int(dt.datetime(2024, 7, 1, 3, 30, tzinfo=dt.timezone.utc).timestamp()) * 10**9 + 1999
    df = spark.createDataFrame([(nanos,), (None,)], "n bigint")
    got = column(df, epoch_nanos_to_time("n"), epoch_nanos_to_time("n", "America/New_York"))
    assert got[0] == (dt.datetime(2024, 7, 1, 3, 30, 0, 1), dt.datetime(2024, 6, 30, 23, 30, 0, 1))
    assert got[1] == (None, None)


def test_month_helpers():
    assert month_bounds(2023, 12) == ("2023-12-01 00:00:00", "2024-01-01 00:00:00")
    assert month_range((2023, 11), (2024, 2)) == [(2023, 11), (2023, 12), (2024, 1), (2024, 2)]
    assert len(month_range((2023, 1), (2025, 11))) == 35


def test_weather_codes(spark):
    rows = [(float(c), None) for c in range(6, 20)] + [(None, 20.0), (None, 20.1), (None, None), (9.0, 0.0)]
    df = spark.createDataFrame(rows, "code double, gust double")
    got = column(
        df,
        code_in("code", RAIN_TEXT),
        code_text("code", RAIN_TEXT, "No rain"),
        code_in("code", SNOW_TEXT),
        code_text("code", SNOW_TEXT, "No snow"),
        is_extreme("code", "gust"),
    )
    for code, row in zip(range(6, 20), got):
        rain, snow = 7 <= code <= 13, 15 <= code <= 18
        assert row[0] == (code if rain else 0) and (row[1] == "No rain") != rain
        assert row[2] == (code if snow else 0) and (row[3] == "No snow") != snow
        assert row[4] == (1 if code in (9, 11, 13, 17, 18) else 0)
    assert [r[4] for r in got[-4:]] == [0, 1, 0, 1]
    assert got[8][:4] == (0, "No rain", 0, "No snow")  # 14 is neither
    assert df.select(F.lit(1)).count() == len(rows)
