import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from martlet.operators import audit
from martlet.operators.running import running_sum
from martlet.plans import analyses

from helpers import rows


def test_window_parameters():
    assert audit.weekly_window(dt.date(2024, 1, 10)) == (dt.date(2024, 1, 3), dt.date(2024, 1, 9))
    assert audit.parse_window("2024-01-01", "2024-08-17") == (dt.date(2024, 1, 1), dt.date(2024, 8, 17))
    with pytest.raises(ValueError):
        audit.parse_window("01/01/2024", "2024-08-17")


def test_batch_and_retry_reconciliation(spark):
    att = spark.createDataFrame([
        ("r", "sales", 1, 10, 0, True),
        ("r", "sales", 1, 11, 0, False), ("r", "sales", 1, 11, 1, False), ("r", "sales", 1, 11, 2, True),
        ("r", "sales", 2, 12, 0, False), ("r", "sales", 2, 12, 1, False), ("r", "sales", 2, 12, 2, False),
        ("r", "sales", 2, 12, 3, False),
        ("r", "sales", 2, 13, 0, True),
    ], "run_id string, entity string, batch int, object_id bigint, attempt int, ok boolean")
    assert rows(audit.batch_summary(att)) == [("r", "sales", 1, 1, 1), ("r", "sales", 2, 1, 1)]
    s = audit.run_summary(att).collect()[0]
    assert (s.total_retried, s.successful_retries, s.permanent_failures) == (2, 1, 1)
    assert (s.successful_extractions, s.failed_extractions, s.batches_processed) == (3, 1, 2)
    assert rows(audit.permanent_failures(att)) == [("r", "sales", 12)]
    assert rows(audit.failed_ids(att), "object_id") == [(11,), (12,)]


def test_running_sum_matches_serial_with_ties(spark):
    rnd = random.Random(7)
    data = [(i, rnd.choice([0, 1, 5, 5, 5, 9, 100])) for i in range(500)]
    df = spark.createDataFrame(data, "k int, v int")
    out = running_sum(df, "v", [-F.col("v"), F.col("k")], ranges=7)
    got = {r.k: r.running_total for r in out.collect()}
    acc, want = 0, {}
    for k, v in sorted(data, key=lambda t: (-t[1], t[0])):
        acc += v
        want[k] = acc
    assert got == want


def test_running_sum_with_more_columns_and_without_exchange_reuse(spark):
    n = 100_000
    df = spark.range(n).select(F.col("id").alias("k"), (F.col("id") * 7919 % 1009).alias("v"),
                               F.concat(F.lit("x"), F.col("id")).alias("note"), (F.col("id") % 7).alias("other"))
    data = sorted(((r.k, r.v) for r in df.select("k", "v").collect()), key=lambda t: (-t[1], t[0]))
    acc, want = 0, {}
    for k, v in data:
        acc += v
        want[k] = acc
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        out = running_sum(df, "v", [-F.col("v"), F.col("k")], ranges=9, total_out="total").collect()
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")
    assert {r.k: r.running_total for r in out} == want and {r.total for r in out} == {acc}


def test_abc_classes(spark):
    lines = spark.createDataFrame([(1, 70.0), (2, 20.0), (3, 6.0), (4, 4.0), (0, 1000.0)],
                                  "product_id bigint, gross_revenue double")
    got = rows(analyses.abc_curve(lines.withColumn("gross_revenue", F.col("gross_revenue").cast("decimal(38,9)")),
                                  ranges=2), "product_id", "abc_class")
    assert got == [(1, "A"), (2, "B"), (3, "C"), (4, "C")]  # product 0 (missing) left out


def test_replenishment(spark):
    d = spark.createDataFrame([(1, "A", dt.date(2024, 1, 28), 28), (1, "A", dt.date(2024, 1, 1), 1),
                               (1, "A", dt.date(2023, 12, 31), 999)],
                              "component_product_id bigint, product_name string, order_date date, total_quantity_sold bigint")
    r = analyses.replenishment(d, dt.date(2024, 1, 28), window_days=28, lead_time_days=14).collect()[0]
    assert r.window_quantity == 29 and r.avg_daily_demand == pytest.approx(29 / 28) and r.reorder_quantity == 15
