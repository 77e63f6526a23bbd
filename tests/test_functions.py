import math

from pyspark.sql import functions as F

from tracklake.functions import times, values


def test_milliseconds_survive_text_and_back(spark):
    texts = [f"2013-06-11 10:01:01.{i:03d}" for i in range(1000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    out = df.select("t", times.millis_text(times.parse_time(F.col("t"))).alias("back"))
    assert all(r.t == r.back for r in out.collect())


def test_times_round_to_the_nearest_millisecond(spark):
    df = spark.sql("select timestamp '2013-06-11 10:01:01.0006' as t")
    assert df.select(times.millis_text(F.col("t"))).first()[0] == "2013-06-11 10:01:01.001"


def test_all_time_texts_are_read(spark):
    rows = [
        ("2013-06-11 10:01:01", "2013-06-11 10:01:01.000"),
        ("2013-06-11T10:01:01Z", "2013-06-11 10:01:01.000"),
        ("2013-06-11T10:01:01.25Z", "2013-06-11 10:01:01.250"),
        ("1308697200", None),
        ("2013", None),
        ("NA", None),
        (None, None),
    ]
    df = spark.createDataFrame(rows, "t string, want string")
    got = df.select("want", times.millis_text(times.parse_time(F.col("t"))).alias("got")).collect()
    assert [r.got for r in got] == [r.want for r in got]


def test_epoch_seconds_become_iso_text(spark):
    rows = [
        ("1308697200", "2011-06-21T23:00:00Z"),
        ("1560816000", "2019-06-18T00:00:00Z"),
        ("-1", "1969-12-31T23:59:59Z"),
        ("2019-06-18T00:00:00Z", "2019-06-18T00:00:00Z"),
        ("NA", "NA"),
        (None, None),
    ]
    df = spark.createDataFrame(rows, "t string, want string")
    assert all(r.want == r.got for r in df.select("want", times.epoch_text_to_iso(F.col("t")).alias("got")).collect())


def test_milliseconds_of_times_before_1970(spark):
    df = spark.sql("select timestamp '1969-12-31 23:59:59.250' as t")
    assert df.select(times.millis_of(F.col("t"))).first()[0] == 250


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(1.0, "a"), (math.nan, ""), (None, None)], "x double, s string")
    assert [r[0] for r in df.select(values.present(df, "x")).collect()] == [True, False, False]
    assert [r[0] for r in df.select(values.present(df, "s")).collect()] == [True, True, False]
    assert [r[0] for r in df.select(values.value_count(df, ["x", "s"])).collect()] == [2, 1, 0]


def test_first_present_passes_over_nan(spark):
    df = spark.createDataFrame([(math.nan, 2.0), (1.0, 2.0), (None, 2.0), (None, None)], "a double, b double")
    assert [r[0] for r in df.select(values.first_present(df, "a", "b")).collect()] == [2.0, 1.0, 2.0, None]


def test_text_is_tidied(spark):
    rows = [(" a\r\nb ", "a  b"), ("\tx\t", "x"), ("plain", "plain"), (None, None)]
    df = spark.createDataFrame(rows, "s string, want string")
    got = df.select("want", values.without_line_breaks(F.col("s")).alias("got"), values.untidy(F.col("s")).alias("bad"))
    assert all(r.want == r.got for r in got.collect())
    assert [r.bad for r in got.collect()] == [True, True, False, None]


def test_halves_round_to_even(spark):
    df = spark.createDataFrame([(0.125,), (0.375,)], "x double")
    assert [r[0] for r in df.select(values.round_even(F.col("x"), 2)).collect()] == [0.12, 0.38]
