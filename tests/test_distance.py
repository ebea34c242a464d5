from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from namelink.functions import (
    levenshtein_sql,
    levenshtein_strict,
    match_score,
    name_distance,
    total_distance,
)


def test_lenient(spark):
    cases = [
        ("Klueppel", "Knopfel", 4), ("Klueppel", "Klappel", 2), ("Klueppel", "Culpepper", 4),
        (None, "abc", 0), ("", "abc", 0), ("  ", "abc", 0),
        ("abc", None, 3), ("abc", "", 3), ("abc ", "  ", 3), ("ABC", "abc  ", 0), (None, None, 0),
    ]
    frame = spark.createDataFrame([(a, b) for a, b, _ in cases], "a string, b string")
    got = [r[0] for r in frame.select(levenshtein_sql("a", "b")).collect()]
    assert got == [d for _, _, d in cases]


def test_strict(spark):
    frame = spark.createDataFrame(
        [("Klueppel", "Knopfel"), ("", "abc"), ("abc", "ABC"), ("abc", "")], "a string, b string"
    )
    assert [r[0] for r in frame.select(levenshtein_strict("a", "b")).collect()] == [4, 3, 3, 3]
    assert [r[0] for r in frame.select(levenshtein_strict("b", "a")).collect()] == [4, 3, 3, 3]
    missing = spark.createDataFrame([("a", None)], "a string, b string")
    with pytest.raises(Exception, match="both texts must be given"):
        missing.select(levenshtein_strict("a", "b")).collect()


def test_name_distance_takes_the_smaller_order(spark):
    frame = spark.createDataFrame(
        [("Jose", "Lopez", "Lopez", "Jose"), (None, "Lopez", "Anyone", "Lopes")],
        "f string, l string, of string, ol string",
    )
    assert [r[0] for r in frame.select(name_distance("f", "l", "of", "ol")).collect()] == [0, 1]


def test_scores(spark):
    frame = spark.createDataFrame([(Decimal("0.900"), 2, 31)], "w decimal(18,3), t int, c int")
    score = match_score("w", "t", "c")
    row = frame.select(score.alias("s"), total_distance(F.lit(3), F.lit(1), score).alias("d")).first()
    assert row["s"] == Decimal("29.700")
    assert row["d"] == Decimal("-14.700")


def test_letters_keep_their_number(spark):
    row = spark.range(1).select(
        levenshtein_sql(F.lit("Straße"), F.lit("")).alias("n"), levenshtein_sql(F.lit("STRAßE"), F.lit("straße")).alias("same")
    ).first()
    assert tuple(row) == (6, 0)
