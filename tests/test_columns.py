"""T1-T6 and F helpers on hand-written values (FIXTURES §D edge cases)."""
import datetime as dt

from pyspark.sql import functions as F

from varzea.functions import columns as C


def one(spark, expr, value, ddl="v string"):
    return spark.createDataFrame([(value,)], ddl).select(expr.alias("r")).first()["r"]


def test_safe_int(spark):
    assert one(spark, C.safe_int("v"), "3") == 3
    assert one(spark, C.safe_int("v"), "3.0") == 3
    assert one(spark, C.safe_int("v"), " 7 ") == 7
    assert one(spark, C.safe_int("v"), "nan") == 0
    assert one(spark, C.safe_int("v"), "abc") == 0
    assert one(spark, C.safe_int("v"), None) == 0


def test_safe_float(spark):
    assert one(spark, C.safe_float("v"), "55%") == 55.0
    assert one(spark, C.safe_float("v"), " 80 % ") == 80.0
    assert one(spark, C.safe_float("v"), " - ") is None
    assert one(spark, C.safe_float("v"), None) is None


def test_clean_str(spark):
    assert one(spark, C.clean_str("v"), "  Flamengo ") == "Flamengo"
    assert one(spark, C.clean_str("v"), " nan ") is None
    assert one(spark, C.clean_str("v"), None) is None


def test_parse_date_and_season(spark):
    assert one(spark, C.parse_date("v"), "25/02/2021") == dt.date(2021, 2, 25)
    assert one(spark, C.parse_date("v"), "31/02/2020") is None
    assert one(spark, C.parse_date("v"), "garbage") is None
    assert one(spark, C.season_of(C.parse_date("v")), "25/02/2021") == 2020
    assert one(spark, C.season_of(C.parse_date("v")), "29/05/2021") == 2021
    assert one(spark, C.season_of(C.parse_date("v")), "10/12/2019") == 2019


def test_minute_of(spark):
    assert one(spark, C.minute_of("v"), "45+2") == 45
    assert one(spark, C.minute_of("v"), "90'") == 90
    assert one(spark, C.minute_of("v"), "") == 0
    assert one(spark, C.minute_of("v"), None) == 0


def test_pct_result_capitalize(spark):
    df = spark.createDataFrame([(3, 4, 2, 2, "são paulo fc")], "w int, t int, a int, b int, s string")
    r = df.select(C.pct_of("w", "t").alias("p"), C.pct_of("w", F.lit(0)).alias("z"),
                  C.result_letter("a", "b").alias("r"), C.result_letter(F.lit(None), "b").alias("n"),
                  C.capitalize_first("s").alias("c"), C.round_half_up(F.lit(2.5)).alias("h")).first()
    assert r.p == 75.0 and r.z == 0.0 and r.r == "E" and r.n is None
    assert r.c == "São paulo fc" and r.h == 3.0


def test_collation_match(spark):
    df = spark.createDataFrame([("São Paulo",), ("Sao Paulo",), ("SAO PAULO ",)], "c string")
    assert df.filter(C.club_match("c", "sao paulo", "UNICODE_CI_AI_RTRIM")).count() == 3
    assert df.filter(C.club_match("c", "Sao Paulo")).count() == 1
