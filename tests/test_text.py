import pytest
from pyspark.sql import functions as F

from granero.functions.text import default_missing, full_name, split_dv, to_text, trim_blanks
from granero.operators.project import emit_rows, rename


@pytest.mark.parametrize(
    "text, number, digit",
    [
        ("12345678k", "12345678", "K"),
        ("12345678-9", "12345678-", "9"),
        ("9", "", "9"),
        ("", "", ""),
        (None, "", ""),
        (" ", "", " "),
    ],
)
def test_split_dv(spark, text, number, digit):
    df = spark.createDataFrame([(text,)], "x string")
    assert tuple(df.select(*split_dv(F.col("x"))).first()) == (number, digit)


@pytest.mark.parametrize(
    "parts, name",
    [
        ((" ana ", "perez", None), "ANA PEREZ "),
        (("ana", None, "soto"), "ANA  SOTO"),
        ((None, None, None), "  "),
        (("\tana\n", "\u0001perez", "soto\r"), "ANA PEREZ SOTO"),
        (("ana maría", "de la cruz", ""), "ANA MARÍA DE LA CRUZ "),
        (("strauß", "x", "y"), "STRAUSS X Y"),
        ((" ana", "x", "y"), " ANA X Y"),
    ],
)
def test_full_name(spark, parts, name):
    df = spark.createDataFrame([parts], "a string, b string, c string")
    assert df.select(full_name(F.col("a"), F.col("b"), F.col("c"))).first()[0] == name


def test_trim_blanks_strips_all_controls_and_nothing_else(spark):
    blanks = "".join(map(chr, range(1, 0x21)))
    texts = [f"{blanks}a{blanks}b{blanks}", blanks, "", " a  ", "a\u007f", "\x00a\x00"]
    df = spark.createDataFrame([(text,) for text in texts], "x string")
    got = [row[0] for row in df.select(trim_blanks(F.col("x"))).collect()]
    assert got == [f"a{blanks}b", "", "", " a  ", "a\u007f", "a"]


def test_to_text(spark):
    row = spark.sql("SELECT 5D AS a, 1e7 AS b, 5BD AS c, 12L AS d, true AS e, NULL AS f").select(
        *(to_text(F.col(name)) for name in "abcdef")
    )
    assert tuple(row.first()) == ("5.0", "1.0E7", "5", "12", "true", None)


def test_default_missing(spark):
    df = spark.createDataFrame([("a",), ("",), (None,)], "x string")
    got = [row[0] for row in df.select(default_missing(F.col("x"), "Sin Plan")).collect()]
    assert got == ["a", "", "Sin Plan"]


def test_rename_keeps_the_rest(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert rename(df, {"b": "d", "absent": "e"}).columns == ["a", "d", "c"]


def test_emit_rows(spark):
    df = spark.createDataFrame([(1, ["a", "b"]), (2, []), (3, None)], "k int, v array<string>")
    assert [tuple(row) for row in emit_rows(df, ["k"], F.col("v"), "x").collect()] == [
        (1, "a"),
        (1, "b"),
    ]
