from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskgraph.functions import exprs as X


def _one(spark, values, fn, typ=T.StringType()):
    df = spark.createDataFrame([(v,) for v in values], T.StructType([T.StructField("x", typ)]))
    return [r[0] for r in df.select(fn(F.col("x"))).collect()]


def test_digits_or_zero_traps(spark):
    vals = ["120", "12a", "", None, "12\n", "007", "n/a", " 12"]
    assert _one(spark, vals, X.digits_or_zero) == [120.0, 0.0, 0.0, 0.0, 0.0, 7.0, 0.0, 0.0]


def test_two_decimals_half_up_on_shortest_decimal(spark):
    vals = [0.125, 1.005, 1234.125, 2.0, 59.999, 0.0]
    assert _one(spark, vals, X.two_decimals, T.DoubleType()) == ["0.13", "1.01", "1234.13", "2.00", "60.00", "0.00"]


def test_full_match_patterns(spark):
    vals = ["13800000000", "1380000000", "138000000000", "03800000000", None, "13800000000\n", "1380000000a"]
    got = _one(spark, vals, lambda c: X.full_match(c, X.MOBILE))
    assert got == [True, False, False, False, None, False, False]
    loose = _one(spark, ["p138000", "p13800", "p13800000000", "p138000000000", "138000"],
                 lambda c: X.full_match(c, X.LOOSE))
    assert loose == [True, False, True, False, False]
    any11 = _one(spark, ["03800000000", "13800000000", "1380000000"], lambda c: X.full_match(c, X.ANY11))
    assert any11 == [True, True, False]


def test_prefix_and_phone_cleanup(spark):
    assert _one(spark, ["138", None], X.prefixed) == ["p138", None]
    a = _one(spark, ["p008613800000000;cpc", "p(86)13800000000", "p8613800000000", "p13800000000;cpc", "p138"],
             X.clean_phone_a)
    assert a == ["p13800000000", "p(86)13800000000", "p13800000000", "p13800000000", "p138"]
    b = _one(spark, ["p008613800000000;cpc", "p(86)13800000000", "p8613800000000;cpc", "p13800000000;cpc", "p()1"],
             X.clean_phone_b)
    assert b == ["p13800000000;cpc", "p13800000000", "p13800000000;cpc", "p13800000000", "p1"]


def test_days_and_text_compare(spark):
    assert X.days("2001-09-01") == ("2001-09-01", "2001-08-31")
    assert X.days("2001-03-01") == ("2001-03-01", "2001-02-28")
    import datetime as dt
    df = spark.createDataFrame([(dt.datetime(2001, 6, 1),), (dt.datetime(2001, 5, 31, 23, 59),)],
                               T.StructType([T.StructField("t", T.TimestampNTZType())]))
    got = [r[0] for r in df.select(X.later_than_day("t", "2001-06-01")).collect()]
    assert got == [True, False]


def test_orientation_and_unknown_channel(spark):
    df = spark.createDataFrame(
        [("a", "b", X.CHANNEL_OUT), ("a", "b", X.CHANNEL_IN)], "m string, o string, c string")
    src, dst = X.oriented("m", "o", "c")
    assert sorted(tuple(r) for r in df.select(src, dst).collect()) == [("a", "b"), ("b", "a")]
