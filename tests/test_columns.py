from datetime import datetime

from conftest import rows
from pyspark.sql import functions as F

from wardgrid.functions import columns as C

BIRTHS = "id int, dob timestamp, admit timestamp"


def test_clip_keeps_missing_missing(spark):
    df = spark.createDataFrame([(1, None), (2, -5.0), (3, 40.0), (4, 7.0)], "id int, v double")
    assert rows(df.select("id", C.clip_value("v", 0, 30)), "id") == [
        (1, None), (2, 0.0), (3, 30.0), (4, 7.0)
    ]


def test_clip_by_code_uses_each_items_bounds(spark):
    df = spark.createDataFrame(
        [(1, "a", 50.0), (2, "b", 50.0), (3, "c", 50.0), (4, "a", None)], "id int, item string, v double"
    )
    out = C.clip_by_code(df, "item", "v", {"a": (0, 10), "b": (60, 70)})
    assert rows(out.select("id", "v"), "id") == [(1, 10.0), (2, 60.0), (3, 50.0), (4, None)]


def test_safe_age(spark):
    admit = datetime(2000, 1, 1)
    df = spark.createDataFrame(
        [
            (1, datetime(1950, 1, 1), admit),
            (2, datetime(1850, 1, 1), admit),
            (3, None, admit),
            (4, datetime(1864, 1, 1), datetime(2164, 1, 1)),
            (5, datetime(1999, 12, 31, 12), admit),
        ],
        BIRTHS,
    )
    age, imputed = C.safe_age("admit", "dob")
    out = rows(df.select("id", F.round(age, 4), imputed), "id")
    assert out == [(1, 49.9986, 0), (2, 91.0, 1), (3, 91.0, 1), (4, 91.0, 1), (5, 0.0, 0)]


def test_one_hot_unknown_and_missing_are_all_zero(spark):
    df = spark.createDataFrame([(1, "EMERGENCY"), (2, "OTHER"), (3, None)], "id int, t string")
    out = C.one_hot_fixed(df, "t", ["EMERGENCY", "ELECTIVE", "URGENT"], prefix="adm")
    assert rows(out.drop("t"), "id") == [(1, 1, 0, 0), (2, 0, 0, 0), (3, 0, 0, 0)]


def test_temperature_conversion_modes(spark):
    df = spark.createDataFrame(
        [(1, 678, 98.6), (2, 5, 37.2), (3, 678, None), (4, 9, 500.0)], "id int, item int, v double"
    )
    good = C.convert_unit_for_code(df, "item", "v", [678], among=[678, 5])
    old = C.convert_unit_for_code(df, "item", "v", [678], among=[678, 5], mode="as_coded")
    assert rows(good.select("id", F.round("v", 6)), "id") == [(1, 37.0), (2, 37.2), (3, None), (4, 500.0)]
    assert rows(old.select("id", "v"), "id") == [(1, 25.0), (2, 37.2), (3, None), (4, 500.0)]


def test_category_and_number_cleaning(spark):
    df = spark.createDataFrame([(1, " urgent ", "4.5"), (2, None, "x"), (3, "", None)], "id int, c string, n string")
    out = df.select("id", C.normalise_category("c"), C.normalise_category("c", upper=False), C.coerce_numeric("n"))
    assert rows(out, "id") == [(1, "URGENT", "urgent", 4.5), (2, "NAN", "nan", None), (3, "", "", None)]


def test_small_scalars(spark):
    df = spark.createDataFrame([(1, None, "t", "c", 80.0), (2, 1, None, "c", 40.0), (3, 0, None, None, 0.0)],
                               "id int, f int, t string, c string, v double")
    out = df.select("id", C.fill_flag("f"), C.label_or_code("t", "c"), C.uln_ratio("v", 40), C.outcome_label("f"))
    assert rows(out, "id") == [
        (1, 0, "t", 2.0, None), (2, 1, "c", 1.0, "Deceased"), (3, 0, "nan", 0.0, "Survived")
    ]
    back = df.select(F.round(C.expm1(C.log1p_target("v")), 9).alias("v"))
    assert sorted(r.v for r in back.collect()) == [0.0, 40.0, 80.0]


def test_range_filters(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (5.0,), (5.1,), (-1.0,), (None,)], "v double")
    assert rows(C.filter_half_open_range(df, "v", 0, 5), "v") == [(1.0,), (5.0,)]
    assert rows(C.filter_positive_target(df, "v"), "v") == [(1.0,), (5.0,), (5.1,)]


def test_hours_between_is_exact_over_centuries(spark):
    df = spark.createDataFrame(
        [(datetime(1864, 1, 1), datetime(2164, 1, 1)), (datetime(2000, 1, 1, 12), datetime(2000, 1, 1))],
        "a timestamp, b timestamp",
    )
    got = sorted(r[0] for r in df.select(C.hours_between("a", "b")).collect())
    assert got == [-12.0, (datetime(2164, 1, 1) - datetime(1864, 1, 1)).total_seconds() / 3600]
