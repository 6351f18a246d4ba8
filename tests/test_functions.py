import datetime as dt
import math

from pyspark.sql import functions as F

from gridpulse.functions import (category_lookup, clip, day_number_to_date, first_set, fmt2,
                                 floor_ntz, json_has_key, json_number, label_lines, level,
                                 marker_size, month_day_label, on_day, palette_index,
                                 parse_timestamp, replace_exact, rescale, truncate_to_int)


def one(spark, expr, schema="x double", data=((1.0,),)):
    return spark.createDataFrame(list(data), schema).select(expr.alias("r")).collect()


def test_rescale_degenerate_range_maps_to_upper(spark):
    df = spark.createDataFrame([(5.0, 5.0, 5.0), (1.0, 0.0, 4.0), (4.0, 0.0, 4.0), (0.0, 0.0, 4.0)],
                               "x double, lo double, hi double")
    got = [r[0] for r in df.select(rescale("x", "lo", "hi", 0.0, 1.0)).collect()]
    assert got == [1.0, 0.25, 1.0, 0.0]
    got = [r[0] for r in df.select(rescale("x", "lo", "hi", 0.3, 1.0)).collect()]
    assert got[0] == 1.0 and abs(got[1] - (0.3 + 0.25 * 0.7)) < 1e-12 and got[3] == 0.3


def test_palette_index_truncates_and_nan_is_null(spark):
    df = spark.createDataFrame([(0.99,), (0.5,), (float("nan"),), (None,), (1.0,)], "s double")
    got = [r[0] for r in df.select(palette_index("s", 9)).collect()]
    assert got == [7, 4, None, None, 8]
    got = [r[0] for r in df.select(clip(truncate_to_int(F.col("s") * 20), 0, 8)).collect()]
    assert got == [8, 8, None, None, 8]


def test_fmt2_and_null(spark):
    df = spark.createDataFrame([(12310.0,), (None,), (-0.5,)], "x double")
    assert [r[0] for r in df.select(fmt2("x")).collect()] == ["12310.00", None, "-0.50"]


def test_marker_size(spark):
    df = spark.createDataFrame([(0.0,), (16.0,), (-1.0,)], "v double")
    got = [r[0] for r in df.select(marker_size("v", 7)).collect()]
    assert got[0] == 0.0 and abs(got[1] - math.log(5) * 7) < 1e-12 and got[2] is None


def test_parse_timestamp_strict(spark):
    df = spark.createDataFrame([("2022-12-31 23:59:59",), ("junk",), (None,), ("2022-12-31",)], "s string")
    got = [r[0] for r in df.select(parse_timestamp("s")).collect()]
    assert got == [dt.datetime(2022, 12, 31, 23, 59, 59), None, None, None]


def test_parse_timestamp_in_a_dst_zone(spark):
    df = spark.createDataFrame([("2024-03-31 02:30:00",), ("bad",)], "s string")
    prev = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Copenhagen")
        got = [r[0] for r in df.select(parse_timestamp("s")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)
    assert got == [dt.datetime(2024, 3, 31, 2, 30), None]


def test_wall_clock_text_in_a_dst_gap(spark):
    from gridpulse.functions import iso_hour, short_date, wall_clock_text
    df = spark.createDataFrame([(dt.datetime(2024, 3, 31, 2, 30, 5),), (None,)], "t timestamp_ntz")
    prev = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Copenhagen")
        got = df.select(iso_hour("t"), wall_clock_text("t"), short_date("t")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)
    assert tuple(got[0]) == ("2024-03-31T02:30:05", "2024-03-31 02:30:05", "2024-03-31")
    assert tuple(got[1]) == (None, None, None)


def test_floor_ntz_is_zone_free(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 3, 31, 2, 30, 15),)], "t timestamp_ntz")
    prev = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Copenhagen")
        h, d = df.select(floor_ntz("t", "hour"), floor_ntz("t", "day")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)
    assert h == dt.datetime(2024, 3, 31, 2, 0) and d == dt.datetime(2024, 3, 31)


def test_on_day_is_half_open(spark):
    df = spark.createDataFrame([(dt.datetime(2022, 1, 2, 0, 0),), (dt.datetime(2022, 1, 2, 23, 59, 59),),
                                (dt.datetime(2022, 1, 3, 0, 0),), (dt.datetime(2022, 1, 1, 23, 59, 59),)],
                               "t timestamp_ntz")
    assert df.filter(on_day("t", "2022-01-02")).count() == 2


def test_json_helpers(spark):
    data = [('{"temp": 1.5, "municipality": "Copenhagen"}',), ('{"temp": 1.5',), (None,),
            ('{"wspd": 3}',), ('{"temp": "warm"}',)]
    df = spark.createDataFrame(data, "s string")
    got = df.select(json_number("s", "temp"), json_number("s", "temp", default=0.0),
                    json_has_key("s", "temp")).collect()
    assert [r[0] for r in got] == [1.5, None, None, None, None]
    assert [r[1] for r in got] == [1.5, None, None, 0.0, None]
    assert [r[2] for r in got] == [True, None, None, False, True]


def test_replace_exact_is_whole_value(spark):
    df = spark.createDataFrame([("Copenhagen",), ("Copenhagen North",), (None,)], "m string")
    got = [r[0] for r in df.select(replace_exact("m", {"Copenhagen": "København"})).collect()]
    assert got == ["København", "Copenhagen North", None]


def test_label_lines_optional_part(spark):
    df = spark.createDataFrame([("A", 1.5, None), ("B", None, 2.0)], "n string, a double, d double")
    got = [r[0] for r in df.select(label_lines([("", F.col("n")), ("Area: ", F.col("a"))],
                                               optional=[("Dist: ", F.col("d"))])).collect()]
    assert got == ["A<br>Area: 1.5<br>", "B<br>Area: <br>Dist: 2.0"]


def test_level_thresholds(spark):
    df = spark.createDataFrame([(79.0, 100.0), (80.0, 100.0), (94.9, 100.0), (95.0, 100.0)], "c double, m double")
    assert [r[0] for r in df.select(level("c", "m")).collect()] == ["green", "yellow", "yellow", "red"]


def test_first_set_and_category(spark):
    df = spark.createDataFrame([(0, 1, 1), (0, 0, 0)], "a int, b int, c int")
    expr = first_set([(F.col("a") == 1, "production"), (F.col("b") == 1, "consumption"),
                      (F.col("c") == 1, "import_export")], "weather_data")
    assert [r[0] for r in df.select(expr).collect()] == ["consumption", "weather_data"]
    df2 = spark.createDataFrame([("solar_power_mwh",), ("offshore_wind_mwh_lt_100",)], "m string")
    got = [r[0] for r in df2.select(category_lookup("m", {"solar_power_mwh": "YlOrBr"}, "Blues")).collect()]
    assert got == ["YlOrBr", "Blues"]


def test_day_numbers_and_labels(spark):
    df = spark.createDataFrame([(1,), (61,)], "d int")
    got = df.select(day_number_to_date("d", "2022-01-01").alias("x")) \
            .select("x", month_day_label("x")).collect()
    assert got[0][0] == dt.date(2022, 1, 1) and got[1][0] == dt.date(2022, 3, 2)
    assert got[1][1] == "March 02"


STRICT = [  # text, value, value or zero, has the key, name
    ('{"temp": 1.5, "municipality": "A"}', 1.5, 1.5, True, "A"), ('{"temp": 1.5} junk', None, None, None, None),
    ('{"temp": 1.5, "temp": 2.5}', 2.5, 2.5, True, None), ('{"a": 1}', None, 0.0, False, None), ('{"temp": null}', None, None, True, None),
    ('{"temp": "2.25"}', 2.25, 2.25, True, None), ('{"temp": "abc"}', None, None, True, None), ("[1]", None, None, False, None),
    ("1", None, None, False, None), ('"s"', None, None, False, None), ("", None, None, None, None), (None, None, None, None, None),
    ('{"temp": 1.5', None, None, None, None), (' {"temp": 1}\n', 1.0, 1.0, True, None), ('{"temp": 1}{"temp": 2}', None, None, None, None),
    ('{"temp": 1}, 5', None, None, None, None), ('{"temp": 1}] x', None, None, None, None), ("{'temp': 1}", None, None, None, None),
    ('{"o": {"temp": 1}, "temp": 2}', 2.0, 2.0, True, None), ('{"temp": [1]}', None, None, True, None), ('{"te\\u006dp": 3}', 3.0, 3.0, True, None),
]


def test_strict_documents(spark):
    from gridpulse.functions.jsonx import document_has, document_number, document_text, keep_last_of_repeated_keys, with_document

    keep_last_of_repeated_keys(spark)
    df = spark.createDataFrame([(i, r[0]) for i, r in enumerate(STRICT)], "i int, s string")
    got = with_document(df, "s", "d").orderBy("i").select(document_number("d", "temp"), document_number("d", "temp", default=0.0),
                                                          document_has("d", "temp"), document_text("d", "municipality")).collect()
    assert [tuple(r) for r in got] == [r[1:] for r in STRICT]
    plan = with_document(df, "s", "d").select(document_number("d", "temp"), document_text("d", "municipality"))
    assert plan._jdf.queryExecution().executedPlan().toString().count("parseJson") == 1
