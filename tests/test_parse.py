"""Edge values of the parsers (FIXTURES section 3)."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from riverbed.functions import parse as P


def one_col(spark, values, expr):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    return [r[0] for r in df.select(expr(F.col("s"))).collect()]


def test_timestamp_two_layouts(spark):
    both = lambda c: P.parse_first(c, [P.TS_WITH_SECONDS, P.TS_WITHOUT_SECONDS])
    got = one_col(spark, ["21-06-2020 12:14:25", "21-06-2020 12:14"], both)
    assert got == [dt.datetime(2020, 6, 21, 12, 14, 25), dt.datetime(2020, 6, 21, 12, 14)]
    short = one_col(spark, ["21-06-2020 12:14:25", "21-06-2020 12:14"],
                    lambda c: P.try_timestamp(c, P.TS_WITHOUT_SECONDS))
    assert short == [None, dt.datetime(2020, 6, 21, 12, 14)]


def test_timestamp_invalid_values(spark):
    bad = ["2020-06-21", "31-02-2020 10:00", "21-06-2020 25:00", "1-6-2020 10:00", "x", None]
    got = one_col(spark, bad, lambda c: P.parse_first(c, [P.TS_WITH_SECONDS, P.TS_WITHOUT_SECONDS]))
    assert got == [None] * len(bad)


def test_timestamp_in_dst_gap_is_kept(spark):
    spark.conf.set("spark.sql.session.timeZone", "Europe/Warsaw")
    try:
        got = one_col(spark, ["29-03-2020 02:30"], lambda c: P.try_timestamp(c, P.TS_WITHOUT_SECONDS))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == [dt.datetime(2020, 3, 29, 2, 30)]


def test_date(spark):
    got = one_col(spark, ["21-06-2020", "31-02-2020", "1-6-2020", "x"], P.try_date)
    assert got == [dt.date(2020, 6, 21), None, None, None]


def test_decimal_18_2(spark):
    good = one_col(spark, ["1.005", "1e2", " 12.5 ", ".5", "5.", "-0.001"],
                   lambda c: P.try_decimal(c, 18, 2))
    assert good == [Decimal("1.01"), Decimal("100.00"), Decimal("12.50"), Decimal("0.50"),
                    Decimal("5.00"), Decimal("0.00")]
    bad = one_col(spark, ["abc", "1,234.50", "$5", "NaN", "12345678901234567890"],
                  lambda c: P.try_decimal(c, 18, 2))
    assert bad == [None] * 5


def test_decimal_11_8(spark):
    got = one_col(spark, ["49.123456789", "999.99999999", "1000.0"], lambda c: P.try_decimal(c, 11, 8))
    assert got == [Decimal("49.12345679"), Decimal("999.99999999"), None]


def test_boolean(spark):
    assert one_col(spark, ["1", "t", "YES", "y", "TRUE", "on"], P.try_boolean) == [True] * 6
    assert one_col(spark, ["0", "F", "n", "NO", "false", "off"], P.try_boolean) == [False] * 6
    assert one_col(spark, ["2", "1.0", "maybe", ""], P.try_boolean) == [None] * 4


def test_first_failure_order_and_partition(spark):
    df = spark.createDataFrame([(None, None, None), (1, None, None), (1, 1, None), (1, 1, 1)],
                               "a int, b int, c int")
    status = P.first_failure([(F.col("a").isNull(), "A"), (F.col("b").isNull(), "B"),
                              (F.col("c").isNull(), "C")])
    got = [r[0] for r in df.select(status).collect()]
    assert got == ["A", "B", "C", "VALID"]
    labelled = df.withColumn("s", status)
    n_valid = labelled.filter(F.col("s") == "VALID").count()
    n_invalid = labelled.filter(F.col("s") != "VALID").count()
    assert n_valid + n_invalid == df.count()


def test_null_tokens(spark):
    got = one_col(spark, ["NULL", "null", "", "x", None], P.null_if_tokens)
    assert got == [None, None, None, "x", None]


def test_distinct_and_interval(spark):
    df = spark.createDataFrame([(None, None), (1, None), (1, 1)], "a int, b int")
    got = [r[0] for r in df.select(P.any_distinct([F.col("a")], [F.col("b")])).collect()]
    assert got == [False, True, False]
    iv = spark.createDataFrame(
        [(dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)),
         (dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)),
         (dt.datetime(2024, 1, 9), dt.datetime(2024, 1, 1), None),
         (None, dt.datetime(2024, 1, 1), None)], "ts timestamp_ntz, f timestamp_ntz, t timestamp_ntz")
    got = [r[0] for r in iv.select(P.in_half_open(F.col("ts"), F.col("f"), F.col("t"))).collect()]
    assert got == [False, True, True, None]


def test_seconds_between_counts_boundaries(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0, 0, 900000), dt.datetime(2024, 1, 1, 0, 0, 1, 100000))],
                               "a timestamp_ntz, b timestamp_ntz")
    assert df.select(P.seconds_between(F.col("a"), F.col("b"))).first()[0] == 1


def test_datetime_literals_ignore_session_zone(spark):
    from riverbed.operators.upsert import after_mark
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 10),), (dt.datetime(2024, 1, 1, 12),)],
                               "ts timestamp_ntz")
    for zone in ("Asia/Tokyo", "America/Los_Angeles"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            got = [r.ts for r in after_mark(df, "ts", dt.datetime(2024, 1, 1, 11)).collect()]
            lit = df.select(P.ntz(dt.datetime(2024, 1, 1, 11)).alias("x")).first().x
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
        assert got == [dt.datetime(2024, 1, 1, 12)]
        assert lit == dt.datetime(2024, 1, 1, 11)
