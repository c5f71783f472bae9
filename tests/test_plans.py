"""Plan shape: what should reach the scan, what is broadcast, where the shuffles are."""

import re

from pyspark.sql import functions as F

from martlet.plans.catalog import mart
from martlet.sources.tables import TableStore

from helpers import SF001


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _explain(df):
    import io
    import contextlib
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_dedup_plans_partial_window_group_limit(spark):
    p = _explain(mart(spark, SF001).silver_order_items)
    assert p.count("WindowGroupLimit") >= 2  # partial before the shuffle, final after


def test_only_a_counted_small_product_list_is_hinted(spark):
    from martlet.operators.lookup import MOST_ROWS

    def hinted(df):
        return "strategy=broadcast" in df._jdf.queryExecution().analyzed().toString()

    m = mart(spark, SF001)
    assert not hinted(m.silver_orders) and not hinted(m.stg_products) and hinted(m.fact_orders)
    large = mart(spark, SF001)
    large.product_rows = MOST_ROWS + 1
    for df in (large.fact_orders, large.fact_channel_performance, large.fact_component_demand):
        assert not hinted(df)


def test_queries_write_nothing_while_they_are_built(spark, monkeypatch):
    from pyspark.sql import DataFrameWriter

    from martlet.plans.catalog import queries

    def refuse(*a, **k):
        raise AssertionError("a query wrote a table")
    monkeypatch.setattr(DataFrameWriter, "parquet", refuse)
    for name in ("fact_channel_performance", "upsert_null_safe", "abc_curve", "landed_audit"):
        queries()[name](spark, SF001)


def test_jobs_need_a_shared_folder():
    import pytest

    from martlet.session import shared_folder

    class Conf:
        def get(self, *a):
            return None

    class Context:
        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError):
        shared_folder(Session())


def test_submitted_settings_survive(tmp_dir):
    """A session built without requests keeps the master and parallelism of the submission."""
    import os
    import subprocess
    import sys

    code = ("from martlet.session import build_session; s = build_session(); "
            "print('GOT', s.sparkContext.master, s.conf.get('spark.sql.shuffle.partitions'))")
    env = {**os.environ, "PYTHONPATH": os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
           "PYSPARK_SUBMIT_ARGS": "--master local[3] --conf spark.sql.shuffle.partitions=777 "
                                  "--conf spark.ui.enabled=false pyspark-shell"}
    out = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=120, cwd=tmp_dir)
    assert "GOT local[3] 777" in out.stdout


def test_scans_read_only_needed_columns(spark):
    p = _explain(mart(spark, SF001).fact_component_demand)
    schemas = re.findall(r"ReadSchema: (struct<[^\n]*>)", p)
    line_scans = [s for s in schemas if "l_orderkey" in s]
    assert line_scans and all("l_shipdate" not in s and "l_discount" not in s for s in line_scans)


def test_component_demand_aggregates_before_kit_join(spark):
    p = _explain(mart(spark, SF001).fact_component_demand)
    physical = p.split("\n\n")[0]
    # the first (lowest) aggregate over lines appears below the join with the kit bridge
    assert "HashAggregate" in physical and "Join" in physical


def test_partition_filter_reaches_table_scan(spark, tmp_dir):
    import datetime as dt
    store = TableStore(spark, tmp_dir)
    df = spark.createDataFrame([(1, dt.date(2024, 1, 1)), (2, dt.date(2024, 1, 9))], "order_id bigint, order_date date")
    store.overwrite("o", df, partition_by="order_date")
    q = store.read("o").where(F.col("order_date") > F.lit(dt.date(2024, 1, 5)))
    p = _explain(q)
    assert "PartitionFilters: [isnotnull(order_date" in p and "PartitionFilters: []" not in p
    assert q.count() == 1
