"""End to end: land the sf0.001 fixture as NDJSON (header rows included), read
it back through the bronze layer, and check the mart equals the one built from
the parquet fixture; then the refresh jobs on a table store."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from martlet.plans import refresh
from martlet.plans.catalog import for_compare
from martlet.plans.mart import Mart
from martlet.sources import bronze, fixtures
from martlet.streaming import landing

from helpers import SF001

SINCE = "2001-06-04"  # the refresh tests take the last weeks only: every order date is a folder per table
FIRST_END = "2001-07-05"
AS_OF_FIRST = dt.date(2001, 7, 6)
AS_OF_WEEK = dt.date(2001, 8, 2)


def recent(spark, until=None):
    raw = fixtures.from_driver_tables(spark, SF001, until=until)
    since = F.col("dt") >= F.lit(SINCE).cast("date")
    return fixtures.RawSources(sales_orders=raw.sales_orders.where(since), sales_items=raw.sales_items.where(since),
                               products=raw.products, categories=raw.categories, channels=raw.channels,
                               statuses=raw.statuses)


def whole(spark):
    """The mart over all recent inputs, built at once."""
    return Mart(recent(spark))


def _land(spark, root, sf_dir=SF001):
    """Test helper (sf0.001 only): nest the fixture's lines back into order records, as the
    extraction lands them, and write them with header rows.  The library never nests lines."""
    orders, lines = recent(spark).sales_orders, recent(spark).sales_items
    per_order = lines.groupBy(F.col("data.id").alias("_id")).agg(F.collect_list("item").alias("itens"))
    nested = (orders.join(per_order, orders["data.id"] == per_order["_id"], "left")
              .select(F.col("data").withField("itens", F.col("itens")).alias("data"), "dt"))
    # one write for all windows, one header row per dt folder
    header = nested.groupBy("dt").agg(F.count(F.lit(1)).alias("total_orders"))
    header = header.select(F.struct(F.col("total_orders")).alias("metadata"), "dt")
    nested.unionByName(header, allowMissingColumns=True).write.mode("overwrite").partitionBy("dt").json(
        f"{root}/{bronze.SALES_DIR}")
    # one window landed through land_sales as the weekly job does (replaces that dt folder)
    d = nested.agg(F.max("dt")).first()[0]
    recs = nested.where(F.col("dt") == F.lit(d)).select("data")
    n = recs.count()
    assert bronze.land_sales(recs, root, d, bronze.metadata_for_run({"dataFinal": str(d)}, n, 0, 1, n))
    assert not bronze.land_sales(recs.limit(0), root, d, {})  # nothing is written when empty
    bronze.land_full(fixtures.raw_products(spark, sf_dir), f"{root}/{bronze.PRODUCTS_DIR}", {"total_records": 1})
    for name, fn in (("categories", fixtures.raw_categories), ("channels", fixtures.raw_channels),
                     ("statuses", fixtures.raw_statuses)):
        bronze.land_full(fn(spark, sf_dir), f"{root}/{bronze.LOOKUP_DIRS[name]}", {"total_records": 1})


def _same(a, b):
    a, b = for_compare(a), for_compare(b)
    assert sorted(a.columns) == sorted(b.columns)
    b = b.select(*a.columns)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.fixture(scope="module")
def landed(spark):
    import tempfile
    root = tempfile.mkdtemp(prefix="martlet-landing-", dir="/tmp")
    _land(spark, root)
    return root


def test_json_landing_round_trip(spark, landed):
    raw = bronze.read_landed(spark, f"{landed}/{bronze.SALES_DIR}", bronze.S.RAW_SALES)
    audit = bronze.run_audit(raw)
    assert audit.where(~F.col("count_matches")).count() == 0
    m_json = Mart(bronze.read_sources(spark, landed))
    m_fix = whole(spark)
    for attr in ("fact_orders", "fact_channel_performance", "fact_component_demand", "silver_order_items"):
        _same(getattr(m_json, attr), getattr(m_fix, attr))


def test_streaming_ingest_matches_batch(spark, landed, tmp_dir):
    q = landing.ingest_sales(spark, landed, f"{tmp_dir}/bronze", f"{tmp_dir}/chk")
    q.awaitTermination(300)
    m_stream = Mart(landing.sources_from_bronze(spark, f"{tmp_dir}/bronze", landed))
    _same(m_stream.fact_orders, whole(spark).fact_orders)
    # a second run finds no new files and writes nothing new
    q2 = landing.ingest_sales(spark, landed, f"{tmp_dir}/bronze", f"{tmp_dir}/chk")
    q2.awaitTermination(300)
    assert spark.read.parquet(f"{tmp_dir}/bronze/sales_orders").count() == recent(spark).sales_orders.count()


def test_first_load_then_weekly_equals_full_build(spark, tmp_dir):
    first = recent(spark, FIRST_END)
    refresh.refresh_full(spark, f"{tmp_dir}/mart", first, AS_OF_FIRST)
    store = refresh.refresh_weekly(spark, f"{tmp_dir}/mart", recent(spark), AS_OF_WEEK)
    full = whole(spark)
    _same(store.read("fact_orders"), full.fact_orders)
    _same(store.read("fact_order_channel_performance"), full.fact_channel_performance)
    _same(store.read("fact_order_items_stock"), full.fact_component_demand)
    _same(store.read("silver_orders_details").select(*full.silver_orders.columns), full.silver_orders)
    si = store.read("silver_order_items_details")
    assert set(si.columns) >= {"_ingested_at", "rn"}
    # invariants: M17 has one row per M15 order; M16 units per order equal M14's
    assert store.read("fact_orders").count() == store.read("silver_orders_details").count()
    a = store.read("fact_order_items_details").groupBy("order_id").agg(F.sum("quantity").alias("q"))
    b = si.groupBy("order_id").agg(F.sum("quantity").alias("q"))
    assert a.exceptAll(b).count() == 0
    # a second weekly run with the same data changes nothing (null-safe keys)
    assert spark.table("stg_orders").columns[0] == "order_id"  # staging models are views
    n = store.read("fact_order_channel_performance").count()
    store = refresh.refresh_weekly(spark, f"{tmp_dir}/mart", recent(spark), AS_OF_WEEK)
    assert store.read("fact_order_channel_performance").count() == n


def test_weekly_gold_limited_to_touched_dates_equals_full_recompute(spark, tmp_dir):
    first = recent(spark, FIRST_END)
    refresh.refresh_full(spark, f"{tmp_dir}/a", first, AS_OF_FIRST)
    refresh.refresh_full(spark, f"{tmp_dir}/b", first, AS_OF_FIRST)
    full = recent(spark)
    a = refresh.refresh_weekly(spark, f"{tmp_dir}/a", full, AS_OF_WEEK, gold_scope="all")
    b = refresh.refresh_weekly(spark, f"{tmp_dir}/b", full, AS_OF_WEEK, gold_scope="touched")
    for t in refresh.GOLD:
        _same(a.read(t), b.read(t))


def test_missing_gold_table_is_built_in_full(spark, tmp_dir):
    first = recent(spark, FIRST_END)
    store = refresh.refresh_full(spark, f"{tmp_dir}/m", first, AS_OF_FIRST)
    store._delete(store.path("fact_orders"))
    store = refresh.refresh_weekly(spark, f"{tmp_dir}/m", recent(spark), AS_OF_WEEK)
    _same(store.read("fact_orders"), whole(spark).fact_orders)


def test_weekly_run_leaves_other_dates_alone(spark, tmp_dir):
    import os
    full = recent(spark)
    store = refresh.refresh_full(spark, f"{tmp_dir}/m", full, AS_OF_FIRST)

    def files():
        out = {}
        for name in ("silver_order_items_details", *refresh.GOLD):
            for d in os.listdir(store.path(name)):
                if "=" in d:
                    out[name, d] = sorted(os.listdir(f"{store.path(name)}/{d}"))
        return out
    before = files()
    store = refresh.refresh_weekly(spark, f"{tmp_dir}/m", full, AS_OF_WEEK)
    changed = {d for (name, d), f in files().items() if before.get((name, d)) != f}
    assert changed and min(changed) > "order_date=2001-07-20"


def test_cancelled_orders_leave_the_mart(spark, tmp_dir):
    raw = recent(spark)
    refresh.refresh_full(spark, f"{tmp_dir}/m", raw, AS_OF_FIRST)
    some = whole(spark).silver_orders.where("order_date > '2001-07-20'").orderBy("order_id").limit(3)
    ids = [r.order_id for r in some.collect()]
    assert ids
    cancelled = F.when(F.col("data.id").isin(ids), F.lit(3)).otherwise(F.col("data.situacao.id")).cast("bigint")
    data = F.col("data").withField("situacao", F.struct(cancelled.alias("id")))
    again = fixtures.RawSources(sales_orders=raw.sales_orders.withColumn("data", data),
                                sales_items=raw.sales_items.withColumn("data", data), products=raw.products,
                                categories=raw.categories, channels=raw.channels, statuses=raw.statuses)
    store = refresh.refresh_weekly(spark, f"{tmp_dir}/m", again, dt.date(2001, 7, 28), delete_cancelled=True)
    for name in ("silver_orders_details", "silver_order_items_details", "fact_order_items_details", "fact_orders"):
        assert store.read(name).where(F.col("order_id").isin(ids)).count() == 0
    _same(store.read("fact_order_channel_performance"), Mart(again).fact_channel_performance)


def test_command_line_full_weekly_and_back_fill(spark, landed, tmp_dir, capsys):
    import os

    from martlet.__main__ import main
    from martlet.sources.tables import TableStore

    m = f"{tmp_dir}/m"
    assert main(["full", "--landing", landed, "--mart", m, "--as-of", "2001-08-02"]) == 0
    _same(TableStore(spark, m).read("fact_orders"), whole(spark).fact_orders)
    written = {d: os.stat(f"{m}/bronze/sales/{d}").st_mtime_ns for d in os.listdir(f"{m}/bronze/sales") if "=" in d}
    assert main(["weekly", "--landing", landed, "--mart", m, "--start", "2001-07-01", "--end", "2001-07-31"]) == 0
    again = {d for d in written if os.stat(f"{m}/bronze/sales/{d}").st_mtime_ns != written[d]}
    assert again == {d for d in written if "dt=2001-07-01" <= d <= "dt=2001-07-31"}  # only its folders are read
    _same(TableStore(spark, m).read("fact_orders"), whole(spark).fact_orders)
    assert main(["weekly", "--landing", landed, "--mart", m, "--as-of", "2001-08-02"]) == 0
