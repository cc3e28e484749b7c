from pyspark.sql import functions as F

from chargepulse.functions.times import digits_to_ts, elapsed_ms, middle, month_span, prefix
from chargepulse.functions.values import counter_key, month_of_year, trunc_long


def one(spark, col):
    return spark.range(1).select(col.alias("x")).collect()[0].x


def test_digits_to_ts(spark):
    assert one(spark, F.unix_millis(digits_to_ts(F.lit("20230512040013393000000000000077")))) \
        == 1683864013393
    assert one(spark, digits_to_ts(F.lit("20241301000000000"))) is None
    assert one(spark, digits_to_ts(F.lit("2024"))) is None
    assert one(spark, digits_to_ts(F.lit(None).cast("string"))) is None


def test_elapsed_across_midnight(spark):
    assert one(spark, elapsed_ms(F.lit("20231231235959900123"), F.lit("20240101000000100"))) == 200


def test_month_span(spark):
    assert one(spark, month_span(F.lit("2018-09"), F.lit("2018-09"))) == 1
    assert one(spark, month_span(F.lit("2017-11"), F.lit("2018-02"))) == 4


def test_slices(spark):
    assert one(spark, prefix(F.lit("20240101123456789"), 10)) == "2024010112"
    assert one(spark, middle(F.lit("20240101123456789"), 8, 10)) == "12"
    assert one(spark, middle(F.lit("20240101123456789"), 10, 12)) == "34"
    assert one(spark, month_of_year(F.lit("2018-09"))) == "09"
    assert one(spark, counter_key(F.lit("2018-09"), F.lit("183"))) == "2018-09 183"


def test_trunc_toward_zero(spark):
    assert one(spark, trunc_long(F.lit(-1.7))) == -1
    assert one(spark, trunc_long(F.lit(2.7))) == 2
