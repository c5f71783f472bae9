import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from martlet.functions.casts import safe_date, safe_int64, safe_numeric
from martlet.functions.expressions import matchable_product_id, merge_key, not_cancelled, order_cost, ratio


def _one(spark, expr, values, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [r[0] for r in df.select(expr(F.col("x")).alias("y")).collect()]


def test_safe_numeric_text_and_numbers(spark):
    assert _one(spark, safe_numeric, ["12.5", "abc", "1,5", None, "7"]) == [
        Decimal("12.500000000"), None, None, None, Decimal("7.000000000")]
    assert _one(spark, safe_numeric, [3.25], "double") == [Decimal("3.250000000")]


def test_safe_int64_rounds_half_away_from_zero(spark):
    assert _one(spark, safe_int64, ["1.5", "-1.5", "2.4", "abc", "1,5", None]) == [2, -2, 2, None, None, None]
    assert _one(spark, safe_int64, [1.5, 2.0], "double") == [2, 2]


def test_safe_date_only_full_iso_dates(spark):
    got = _one(spark, safe_date, ["2024-01-05", "0000-00-00", "2024", "2024-02-30", "2024-1-5", None, "abc"])
    assert got == [dt.date(2024, 1, 5), None, None, None, None, None, None]


def test_merge_key(spark):
    df = spark.createDataFrame([(0, 7), (5, 7), (None, 7)], "p bigint, o bigint")
    got = [r[0] for r in df.select(merge_key(F.col("p"), F.col("o"))).collect()]
    assert got == ["missing_7", "5", None]
    got = [r[0] for r in df.select(matchable_product_id(F.col("p"))).collect()]
    assert got == [None, 5, None]


def test_not_cancelled_drops_null(spark):
    df = spark.createDataFrame([("CANCELADO",), ("ATENDIDO",), (None,)], "s string")
    assert [r[0] for r in df.where(not_cancelled(F.col("s"))).collect()] == ["ATENDIDO"]


def test_ratio_and_cost_nulls_no_error_under_ansi(spark):
    df = spark.createDataFrame([(Decimal("10.00"), Decimal("0.00")), (Decimal("5.00"), Decimal("20.00"))],
                               "a decimal(18,2), b decimal(18,2)")
    assert [r[0] for r in df.select(ratio(F.col("a"), F.col("b"))).collect()] == [None, 0.25]
    df2 = spark.createDataFrame([(1, 2, None, 4), (1, 2, 3, 4)], "a int, b int, c int, d int")
    got = [r[0] for r in df2.select(order_cost(F.col("a"), F.col("b"), F.col("c"), F.col("d"))).collect()]
    assert got == [None, 10]


def test_money_keeps_nine_decimals_under_default_settings(spark):
    from martlet.functions.expressions import money_minus, units_times
    one = spark.createDataFrame([(Decimal("1.123456789"), Decimal("0.111111111"), 1, Decimal("4.381381367"))],
                                "price decimal(38,9), cost decimal(38,9), q bigint, fee decimal(38,9)")
    price, cost, q = F.col("price"), F.col("cost"), F.col("q")
    got = one.select(units_times(price, q), units_times(cost, q), units_times(money_minus(price, cost), q),
                     order_cost(F.col("fee"), price, cost, cost).cast("decimal(38,9)")).first()
    assert [str(x) for x in got] == ["1.123456789", "0.111111111", "1.012345678", "5.727060378"]


def test_ids_from_text(spark):
    from martlet.functions.casts import safe_id
    df = spark.createDataFrame([("12",), ("abc",), ("",), (None,), ("99999999999999999999",)], "x string")
    assert [r[0] for r in df.select(safe_id("x")).collect()] == [12, None, None, None, None]
