import pytest
from pyspark.sql import functions as F

from fundscape.functions import contains_any, holds, lacks, matches_any, ngrams, normal, starts_with_any, tokens, uniform
from fundscape.functions.numbers import parse_eu_number, to_number

MONEY = [
    ("€ 1.234.567,89", 1234567.89),
    ("1,234.56", 1234.56),
    ("1,234", 1.234),
    ("1.234", 1.234),
    ("1,234,567", None),
    ("1.234.567", None),
    ("1e5", 100000.0),
    ("1.0E7", 1e7),
    ("-12,5", -12.5),
    (".5", 0.5),
    ("abc", None),
    ("", None),
    (None, None),
    ("1d", None),
    ("1.0f", None),
    ("0x1p3", None),
    ("inf", None),
    ("nan", None),
    ("1_000", None),
]


def test_money(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(MONEY)], "i int, t string")
    got = [r[0] for r in df.orderBy("i").select(parse_eu_number(F.col("t"))).collect()]
    assert got == [v for _, v in MONEY]


def test_to_number(spark):
    df = spark.createDataFrame([("3648573136",), ("1.5",), ("",), (None,), ("1,5",)], "t string")
    assert [r[0] for r in df.select(to_number(F.col("t"))).collect()] == [3648573136.0, 1.5, None, None, None]


def test_predicates_and_null(spark):
    df = spark.createDataFrame([("AB-1",), ("AC-1",), (None,)], "t string")
    p = starts_with_any(F.col("t"), ["AB-", "AD-"])
    assert [tuple(r) for r in df.select(holds(p), lacks(p)).collect()] == [(True, False), (False, True), (False, True)]


@pytest.mark.parametrize(
    "text,expected",
    [
        ("less CO2.", True),
        ("CO2eq", False),
        ("NET-ZERO now", True),
        ("Net Zero", True),
        ("éco2", False),
        ("decarbonization", True),
        ("decarbonising", False),
    ],
)
def test_built_in_pattern(spark, text, expected):
    from fundscape.constants import CLIMATE_PATTERN

    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(matches_any(F.col("t"), CLIMATE_PATTERN)).first()[0] is expected


def test_contains_any(spark):
    df = spark.createDataFrame([("Low Carbon",), ("wind",)], "t string")
    assert [r[0] for r in df.select(contains_any(F.col("t"), ["carbon", "net zero"])).collect()] == [True, False]


def test_tokens_and_ngrams(spark):
    df = spark.createDataFrame([(1, "The sun, a SUN and été!"), (2, "x"), (3, "one")], "i int, t string")
    words = df.select("i", tokens(F.col("t"), ["the", "and"]).alias("w"))
    got = {r[0]: r[1:] for r in words.select("i", "w", ngrams(F.col("w"), 2), ngrams(F.col("w"), 3)).collect()}
    assert got[1] == (["sun", "sun", "été"], ["sun sun", "sun été"], ["sun sun été"])
    assert got[2] == ([], [], [])
    assert got[3] == (["one"], [], [])


def test_noise_law_and_partitioning(spark):
    keys = spark.range(20000)
    noise = keys.select("id", uniform([F.col("id")], 1, "s").alias("u"), normal([F.col("id")], 1, "s").alias("z"))
    low, high, mean, z_mean, z_std = noise.agg(
        F.min("u"), F.max("u"), F.avg("u"), F.avg("z"), F.stddev("z")
    ).first()
    assert 0 < low and high < 1 and abs(mean - 0.5) < 0.02 and abs(z_mean) < 0.03 and abs(z_std - 1) < 0.03
    again = keys.repartition(13).select("id", uniform([F.col("id")], 1, "s").alias("u"))
    assert noise.select("id", "u").exceptAll(again).count() == 0
