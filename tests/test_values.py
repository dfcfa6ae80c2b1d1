import datetime as dt
import io

import pandas as pd
import pytest
from pyspark.sql import functions as F

from plumbline.functions import naming, parsing
from plumbline.operators import profile
from plumbline.plans import marts

NUMBER_TEXTS = [
    "42", " 42 ", "4_2", "1e5", "1E-3", ".5", "5.", "inf", "-inf", "+inf", "Infinity", "0x1F",
    "1,000", "1d", "5f", "--1", "+5", "1e", "\t7\n", "INF", "٣", "1 2", "  ", "True", "1e400",
    "123456789012345678901234567890", "- 5", "+-5", "1.5e+3", "in", "2.0", "-0", "00", "1.0", "x",
]


def kinds_of(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, value string")
    rows = df.select("i", profile.value_kind(F.col("value")).alias("kind")).orderBy("i").collect()
    return [row.kind for row in rows]


def test_numbers_are_read_as_pandas_reads_them(spark):
    parsed = [
        pd.to_numeric(pd.Series([text, "x"]), errors="coerce")[0] for text in NUMBER_TEXTS
    ]
    numeric = {profile._BITS, profile._WHOLE, profile._FRACTION}
    for text, number, kind in zip(NUMBER_TEXTS, parsed, kinds_of(spark, NUMBER_TEXTS)):
        assert (kind in numeric) == pd.notna(number), text
        if kind in numeric:
            assert (kind != profile._FRACTION) == float(number).is_integer(), text


def test_booleans_ignore_case_and_blanks(spark):
    words = ["true", "FALSE", " yes ", "No", "t", "F", "y", "N"]
    assert kinds_of(spark, words) == [profile._BOOLEANS] * len(words)
    assert kinds_of(spark, ["1", "0", " 1"]) == [profile._BITS] * 3
    assert kinds_of(spark, ["yes!", "tr", "10", None]) == [
        profile._TEXT,
        profile._TEXT,
        profile._WHOLE,
        profile._NULL,
    ]


@pytest.mark.parametrize(
    "text, is_date",
    [
        ("2024-01-31", True),
        ("2024-1-5", True),
        ("2024-02-30", False),
        ("2024-01-31 10:30", True),
        ("2024-01-31T10:30:05.123Z", True),
        ("2024/01/31", True),
        ("2024-13-01", False),
        ("1/3/2017 12:00", True),
        ("01/31/2017 23:59:59", True),
        ("31/01/2017", True),
        ("31/13/2017", False),
        ("2/30/2017", False),
        ("29/2/2016", True),
        ("29/2/2017", False),
        ("01/01/2017 25:00", False),
        ("not a date", False),
        ("", False),
    ],
)
def test_dates(spark, text, is_date):
    assert (kinds_of(spark, [text]) == [profile._DATE]) == is_date


def test_null_tokens_are_those_of_the_csv_reader(spark):
    candidates = [*parsing.NULL_TOKENS, "none", "Null", "nil", "-", "0", "n/A", " NA"]
    read = pd.read_csv(io.StringIO("i,v\n" + "\n".join(f'{i},"{c}"' for i, c in enumerate(candidates))))
    df = spark.createDataFrame(list(enumerate(candidates)), "i int, v string")
    ours = [row.v is None for row in parsing.null_tokens_to_null(df).orderBy("i").collect()]
    assert ours == list(read["v"].isna())


def test_whole_numbers_keep_every_digit(spark):
    texts = ["7", " 7 ", "3.0", "3.7", "9007199254740993", "-5", "x", None, "1e3"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, v string")
    rows = df.select("i", parsing.whole_number(F.col("v")).alias("n")).orderBy("i").collect()
    assert [r.n for r in rows] == [7, 7, 3, None, 9007199254740993, -5, None, None, 1000]


def test_stamps_with_and_without_padding(spark):
    texts = ["01/03/2017 12:00", "1/3/2017 9:05", "13/3/2017 9:05", "soon", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, v string")
    rows = df.select("i", parsing.stamp(F.col("v")).cast("string").alias("t")).orderBy("i")
    assert [r.t for r in rows.collect()] == [
        "2017-01-03 12:00:00",
        "2017-01-03 09:05:00",
        None,
        None,
        None,
    ]


def test_calendar_of_four_years(spark):
    dates = marts.dim_dates(spark)
    rows = {row.date_id: row for row in dates.collect()}
    assert len(rows) == 1461
    for day, week in [
        (dt.date(2016, 1, 1), 0),
        (dt.date(2016, 1, 3), 0),
        (dt.date(2016, 1, 4), 1),
        (dt.date(2017, 1, 1), 0),
        (dt.date(2018, 12, 31), 53),
        (dt.date(2015, 1, 1), 1),
    ]:
        assert rows[day].week_of_year == week, day
    # Elsewhere the week is the ISO one.
    off = [d for d, row in rows.items() if row.week_of_year != d.isocalendar().week]
    assert len(off) == 5
    first = rows[dt.date(2015, 1, 1)]
    assert (first.month_name, first.day_name, first.day_of_week) == ("January", "Thursday", 5)
    assert (first.year_quarter, first.year_month, first.is_weekend) == ("2015-Q1", "2015-01", 0)
    assert rows[dt.date(2015, 1, 3)].is_weekend == 1


@pytest.mark.parametrize(
    "unique_id, name, table, column",
    [
        (
            "test.shop.not_null_fact_shipments_order_id.abc123",
            "not_null_fact_shipments_order_id",
            "fact_shipments",
            "order_id",
        ),
        ("test.shop.unique_dim_dates_date_id.f0", "unique_dim_dates_date_id", "dim_dates", "date_id"),
        ("test.shop.unique_dim_dates.f0", "unique_dim_dates", "dim_dates", ""),
        ("test.shop.assert_something", "assert_something", "", ""),
        ("loose", "loose", "", ""),
        ("", "unknown", "", ""),
    ],
)
def test_names_read_out_of_check_ids(spark, unique_id, name, table, column):
    df = spark.createDataFrame([(unique_id,)], "id string")
    row = df.select(
        naming.short_name(F.col("id")).alias("name"),
        naming.table_of(F.col("id")).alias("table"),
        naming.column_of(F.col("id")).alias("column"),
    ).first()
    assert (row.name, row.table, row.column) == (name, table, column)


def test_profile_of_typed_columns_and_distinct_counts(spark):
    df = spark.createDataFrame(
        [(1, 0.5, "a", dt.date(2024, 1, 1)), (2, -0.0, None, dt.date(2024, 1, 3))],
        "`an id` int, x double, s string, d date",
    )
    rows = {row.column_name: row for row in profile.table_profile(df).collect()}
    assert (rows["an id"].min_value, rows["an id"].max_value) == ("1", "2")
    assert (rows["s"].null_count, rows["s"].distinct_count) == (1, 1)
    assert rows["x"].min_value == "0.0"
    assert rows["d"].max_value == "2024-01-03"
