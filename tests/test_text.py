from pyspark.sql import functions as F

from shelfweek.functions import text
from shelfweek.functions.measures import plausible_cost


def one(spark, values, make):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    return [r[0] for r in df.select(make(F.col("x"))).collect()]


def test_pad_code_keeps_the_end_of_long_codes(spark):
    assert one(spark, ["12", " 12", "123456", None], lambda c: text.pad_code(c, 5)) == ["00012", "00 12", "23456", None]


def test_drop_last_three(spark):
    assert one(spark, ["ABC12301", "AB", "ABC123.01  ", ""], text.drop_last_three) == ["ABC12", "", "ABC123", ""]


def test_digit_and_number_tests(spark):
    values = ["12", "", "1a", "$1", "1e3", "-2.5", None]
    assert one(spark, values, text.is_digits) == [True, True, False, False, False, False, None]
    assert one(spark, values, text.is_numeric) == [True, False, False, False, True, True, False]


def test_text_equality_ignores_case_and_trailing_blanks(spark):
    assert one(spark, ["Init", "init  ", " init"], lambda c: text.same_text(c, F.lit("INIT "))) == [True, True, False]
    assert one(spark, ["HBF ", "HBF", "XHBF"], lambda c: text.list_test(c, ("HBF",))) == [True, True, False]


def test_ean_prefers_the_isbn(spark):
    df = spark.createDataFrame([("978", "5551234567890123"), ("", "5551234567890123"), (" ", ""), (None, None)], "i string, u string")
    assert [r[0] for r in df.select(text.ean(F.col("i"), F.col("u"))).collect()] == ["978", "5551234567890", None, None]


def test_joined_skips_nulls(spark):
    assert one(spark, ["b", None], lambda c: text.joined(F.lit("a"), c)) == ["ab", "a"]


def test_plausible_cost_without_quantity(spark):
    df = spark.createDataFrame([(76, 2), (76, 1), (10, 0), (76, 0), (500, 1), (10, 1000)], "cost int, qty int")
    kept = df.where(plausible_cost(F.col("cost"), F.col("qty"))).collect()
    assert [tuple(r) for r in kept] == [(76, 1), (10, 0)]
