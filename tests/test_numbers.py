import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from granero.functions.numbers import (
    checked_int,
    is_numeric,
    required,
    scaled_div,
    trunc_int,
    trunc_int_or_zero,
)

INTS = {
    "5": 5,
    "5.9": 5,
    "-5.9": -5,
    " 5 ": 5,
    "\t5\n": 5,
    "1e3": 1000,
    "3000000000": 2147483647,
    "-3e9": -2147483648,
    "1e400": 2147483647,
    "NaN": 0,
    "-NaN": 0,
    "Infinity": 2147483647,
    "-Infinity": -2147483648,
    "1d": 1,
    "5F": 5,
    "0x1p3": 8,
    "0x.8p1": 1,
    "+.5": 0,
    "5.": 5,
    "-0": 0,
    "2147483647.9": 2147483647,
    "-2147483648.9": -2147483648,
}
JUNK = [
    "",
    " ",
    "K",
    "inf",
    "-INF",
    "infinity",
    "nan",
    "12345678-",
    "1.000.3-",
    "12.345.678",
    "1_000",
    "1e",
    "0x1",
    "5 5",
    "5 ",
    " 5",
    "5L",
    "--5",
    "null",
    "true",
]


def frame(spark, texts):
    return spark.createDataFrame([(text,) for text in texts], "x string")


def value(spark, text, convert):
    return frame(spark, [text]).select(convert(F.col("x")).alias("y")).first().y


def test_trunc_int(spark):
    rows = frame(spark, INTS).select("x", trunc_int(F.col("x")).alias("y")).collect()
    assert {row.x: row.y for row in rows} == INTS


@pytest.mark.parametrize("text", [*JUNK, None])
def test_trunc_int_fails_on_junk_and_null(spark, text):
    with pytest.raises(PySparkException):
        value(spark, text, trunc_int)


def test_trunc_int_null_to_zero(spark):
    assert value(spark, None, lambda x: trunc_int(x, null="zero")) == 0
    with pytest.raises(PySparkException):
        value(spark, "K", lambda x: trunc_int(x, null="zero"))


def test_trunc_int_or_zero(spark):
    texts = {**INTS, **dict.fromkeys([*JUNK, None], 0)}
    rows = frame(spark, texts).select("x", trunc_int_or_zero(F.col("x")).alias("y")).collect()
    assert {row.x: row.y for row in rows} == texts


def test_two_step_parse(spark):
    texts = {**INTS, **dict.fromkeys(JUNK), None: 7}
    rows = frame(spark, texts).select("x", checked_int(F.col("x"), missing=7).alias("y")).collect()
    assert {row.x: row.y for row in rows} == texts
    assert value(spark, "5.9", lambda x: required(checked_int(x), "x")) == 5
    for text in ("K", None):
        with pytest.raises(PySparkException):
            value(spark, text, lambda x: required(checked_int(x), "x"))


def test_number_texts_are_those_the_jvm_parses(spark):
    def parses(text):
        try:
            spark._jvm.java.lang.Double.parseDouble(text)
            return True
        except Exception:
            return False

    texts = [*INTS, *JUNK]
    rows = frame(spark, texts).select("x", is_numeric(F.col("x")).alias("y")).collect()
    assert {row.x: row.y for row in rows} == {text: parses(text) for text in texts}
    assert value(spark, None, is_numeric) is False


@pytest.mark.parametrize(
    "text, whole",
    [("12999999", 12), ("-12999999", -12), ("999999", 0), ("3e9", 2147), (None, 0)],
)
def test_scaled_div(spark, text, whole):
    assert value(spark, text, scaled_div) == whole


def test_numbers_of_other_types(spark):
    df = spark.sql("SELECT 5.9D AS a, CAST(7 AS BIGINT) AS b, CAST(8.75 AS DECIMAL(10, 2)) AS c")
    row = df.select(*(trunc_int(F.col(name)).alias(name) for name in df.columns)).first()
    assert tuple(row) == (5, 7, 8)


def test_without_ansi(spark):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        assert value(spark, "3e9", trunc_int) == 2147483647
        assert value(spark, "K", trunc_int_or_zero) == 0
        with pytest.raises(PySparkException):
            value(spark, "K", trunc_int)
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
