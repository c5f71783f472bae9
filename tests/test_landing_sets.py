"""Observed landing counts, whole records, merges on a stream, mergeable sets of orders, counted lookups."""

import datetime as dt
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from helpers import SF001, rows
from martlet.operators.distinct import count_sets, id_sets, merge_sets
from martlet.operators.lookup import lookup, spread_join
from martlet.plans import refresh
from martlet.sources import bronze, fixtures
from martlet.sources import schemas as S
from martlet.sources.tables import TableStore
from martlet.streaming import landing


def D(n):
    return dt.date(2024, 1, 1) + dt.timedelta(days=n)


def order(i, day, status=1, total="10.50", items=((5, 2, "3.00"),), **more):
    return json.dumps({"data": {"id": i, "data": str(day), "situacao": {"id": status}, "total": total, "loja": {"id": 1},
                                "itens": [{"produto": {"id": p}, "quantidade": q, "valor": v} for p, q, v in items], **more}})


def land(root, day, lines, header=None, name="f.json"):
    folder = f"{root}/sales_data/dt={day}"
    os.makedirs(folder, exist_ok=True)
    head = [json.dumps({"metadata": {"total_orders": len(lines) if header is None else header}})] if header != -1 else []
    with open(f"{folder}/{name}", "w") as f:
        f.write("\n".join([*head, *lines]) + "\n")


@pytest.fixture
def dims(spark, tmp_dir):
    """Products and lookups landed, dimensions stored."""
    root = f"{tmp_dir}/landing"
    bronze.land_full(fixtures.raw_products(spark, SF001).limit(50), f"{root}/{bronze.PRODUCTS_DIR}", {"total_records": 1})
    lists = {"categories": fixtures.raw_categories(spark, SF001),
             "channels": spark.createDataFrame([(1, "Shop")], "id long, descricao string"),
             "statuses": spark.createDataFrame([(1, "Atendido"), (3, "Cancelado")], "id long, nome string")}
    for name, df in lists.items():
        bronze.land_full(df, f"{root}/{bronze.LOOKUP_DIRS[name]}", {"total_records": 1})
    return root


def test_counts_observed_on_the_write_equal_the_scan(spark, dims, tmp_dir):
    land(dims, D(0), [order(1, D(0)), order(2, D(0)), "{broken"])
    land(dims, D(7), [order(3, D(7))], header=9)
    land(dims, D(14), [order(4, D(14))], header=-1)  # no header: no audit row
    land(dims, D(21), [], header=0)
    raw, audit = bronze.ingest_audited(spark, dims, f"{tmp_dir}/bronze")
    scanned = bronze.run_audit(bronze.read_landed(spark, f"{dims}/{bronze.SALES_DIR}", S.RAW_SALES))
    cols = ["dt", "declared_rows", "landed_rows", "quarantined_rows", "count_matches"]
    assert rows(audit, *cols) == rows(scanned, *cols)
    assert rows(audit, *cols) == [(D(0), 3, 2, 1, False), (D(7), 9, 1, 0, False), (D(21), 0, 0, 0, True)]
    assert raw.sales_orders.count() == 4
    _, week = bronze.ingest_audited(spark, dims, f"{tmp_dir}/bronze2", (D(7), None), only_sales=True)
    assert [r.dt for r in week.orderBy("dt").collect()] == [D(7), D(21)]


def test_a_first_load_of_many_days_is_counted_by_group(spark, dims, tmp_dir, monkeypatch):
    for n in range(4):
        land(dims, D(7 * n), [order(10 * n + i, D(7 * n)) for i in range(n + 1)], header=2)
    _, observed = bronze.ingest_audited(spark, dims, f"{tmp_dir}/a")
    monkeypatch.setattr(bronze, "OBSERVED_DAYS", 3)
    _, grouped = bronze.ingest_audited(spark, dims, f"{tmp_dir}/b")
    assert rows(observed) == rows(grouped) and observed.count() == 4


def test_a_line_is_parsed_once(spark):
    df = spark.createDataFrame([(order(1, D(0)), D(0))], "value string, dt date")
    orders, lines = bronze.split_sales(bronze.data_rows(bronze.parse_lines(df, S.RAW_SALES)))
    from martlet.plans import staging
    for q in (staging.stg_orders(orders), staging.stg_order_items(lines, with_order_header=True)):
        assert q._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1


def test_fields_outside_the_schema_stay(spark, tmp_dir):
    land(tmp_dir, D(0), [order(1, D(0), nota={"texto": "olá", "peso": 1.5}, extra=[1, 2]), order(2, D(0)), "{broken"])
    path = f"{tmp_dir}/sales_data"
    whole = bronze.read_landed_whole(spark, path, S.RAW_SALES)
    whole.write.parquet(f"{tmp_dir}/bronze")
    kept = spark.read.parquet(f"{tmp_dir}/bronze")
    d = kept.where("data is not null")
    got = d.select("data.id", bronze.undeclared(d, "$.data.nota.texto").alias("a"), bronze.undeclared(d, "$.data.nota.peso", "double").alias("b"),
                   bronze.undeclared(d, "$.data.extra[1]", "int").alias("c"), bronze.undeclared(d, "$.data.nota.texto", "int").alias("d"))
    assert rows(got) == [("1", "olá", 1.5, 2, None), ("2", None, None, None, None)]
    plain = bronze.read_landed(spark, path, S.RAW_SALES).drop("dt", "metadata")  # the header's text may be spaced otherwise
    assert rows(kept.select(*plain.columns)) == rows(plain)


def test_stream_merges_equal_the_batch_refresh(spark, dims, tmp_dir):
    root, mart = f"{tmp_dir}/bronze", f"{tmp_dir}/mart"
    land(dims, D(7), [order(1, D(3), total="5"), order(2, D(4)), order(9, D(4), items=((5, 1, "1"), (6, 2, "2")))])
    refresh.refresh_dims(TableStore(spark, mart), bronze.read_sources(spark, dims))

    def run():
        landing.merge_sales(spark, dims, root, mart, f"{tmp_dir}/chk", delete_cancelled=True).awaitTermination(300)

    def tables():
        store = TableStore(spark, mart)
        return {n: rows(store.read(n).drop("_ingested_at")) for n in
                ("silver_orders_details", "silver_order_items_details", "fact_orders", "fact_order_channel_performance")}
    run()
    # order 1 again, moved and re-priced; order 2 cancelled; then a file of an older window that comes late
    land(dims, D(14), [order(1, D(9), total="7"), order(2, D(4), status=3), order(3, D(10))])
    run()
    land(dims, D(6), [order(1, D(1), total="1"), order(4, D(2))], name="late.json")
    run()
    after = tables()
    orders = {
        r.order_id: (r.order_date, float(r.total_order_value)) for r in TableStore(spark, mart).read("silver_orders_details").collect()}
    assert orders == {1: (D(9), 7.0), 3: (D(10), 10.5), 4: (D(2), 10.5), 9: (D(4), 10.5)}
    # the batch refresh over the same files
    batch = refresh.refresh_full(spark, f"{tmp_dir}/batch", bronze.read_sources(spark, dims), D(20))
    assert rows(batch.read("silver_orders_details")) == after["silver_orders_details"]
    assert rows(batch.read("fact_orders")) == after["fact_orders"]
    # an epoch that comes again is skipped; without its note it merges to the same rows
    for epoch in (0, 1, 2):
        assert landing.merge_epoch(spark, root, mart, epoch, delete_cancelled=True) == []
    TableStore(spark, mart)._delete(f"{root}/merged_epochs/epoch=2")
    landing.merge_epoch(spark, root, mart, 2, delete_cancelled=True)
    assert tables() == after


def test_sets_of_orders_merge_exactly(spark, tmp_dir):
    rng = random.Random(9)
    data = [(rng.choice(["a", "b", None]), rng.choice("xyz"), D(rng.randrange(20)),
             rng.choice([None, rng.randrange(-50, 90_000), 7])) for _ in range(3000)]
    df = spark.createDataFrame(data, "channel string, category string, day date, order_id bigint").repartition(4)
    daily = id_sets(df, ["channel", "category", "day"], "order_id")
    daily.write.partitionBy("day").parquet(f"{tmp_dir}/sets")
    stored = spark.read.parquet(f"{tmp_dir}/sets")
    week = F.date_trunc("week", "day").cast("date")
    for by in ({"channel": "channel", "week": week}, {"category": "category"}, {"week": week}):
        want = df.where("order_id is not null").groupBy(*[c if isinstance(c, str) else c.alias(n) for n, c in by.items()]).agg(
            F.count_distinct("order_id").alias("n"))
        assert rows(count_sets(merge_sets(stored, by), list(by), "n")) == rows(want)


def test_a_set_of_one_far_id_is_one_whole_number(spark):
    ids = [0, 63, 64, -1, -64, 2 ** 62, -2 ** 63, 2 ** 63 - 1, 7, 7]
    df = spark.createDataFrame([(n % 3, i) for n, i in enumerate(ids)], "g int, order_id bigint")
    sets = id_sets(df, ["g"], "order_id")
    # no group pays for a wide bitmap where its ids lie far apart
    assert dict(sets.dtypes)["ids"] == "bigint"
    want = df.groupBy("g").agg(F.count_distinct("order_id").alias("n"))
    assert rows(count_sets(sets, ["g"], "n")) == rows(want)
    assert count_sets(merge_sets(sets, {}), [], "n").first()[0] == 9


def test_a_join_on_a_few_keys_spreads_the_rows(spark):
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    lines = spark.createDataFrame([(i, [1, 2, None, 9][i % 4]) for i in range(400)], "order_id long, status_id long")
    few = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (None, "d")], "status_id long, status_name string")
    for how in ("left", "left_semi"):
        want = lines.join(few, "status_id", how)
        got = spread_join(lines, few, "status_id", ["order_id"], how)
        assert got.columns == want.columns and rows(got) == rows(want)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        where = spread_join(lines.where("status_id = 1"), few.hint("merge"), "status_id", ["order_id"])
        tasks = {r.p for r in where.select(F.spark_partition_id().alias("p"), "status_name").collect()}
        assert n < 2 or len(tasks) > 1
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_a_lookup_is_broadcast_only_where_it_is_counted_and_small(spark):
    big, small = spark.range(1000), spark.range(10)
    plan = lambda n, most: big.join(lookup(small, n, most), "id", "left")._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" in plan(10, 10) and "broadcast" not in plan(10, 9) and "broadcast" not in plan(None, 10)


def test_lines_cross_one_exchange_by_order_at_scale(spark):
    """Without broadcasts of orders, one exchange of the lines serves W1, M16 and M17's sums."""
    import re

    from martlet.plans.mart import Mart
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    raw = fixtures.from_driver_tables(spark, SF001)
    statuses = F.broadcast(spark.createDataFrame([(1, "Atendido"), (2, "Em aberto")], "id bigint, nome string"))
    channels = F.broadcast(spark.createDataFrame([(1, "Shop")], "id bigint, descricao string"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "2000")
    try:
        m = Mart(fixtures.RawSources(sales_orders=raw.sales_orders, sales_items=raw.sales_items, products=raw.products,
                                     statuses=statuses, channels=channels))
        for q in (m.fact_item_details, m.fact_orders):
            plan = q._jdf.queryExecution().executedPlan().toString().splitlines()
            at = next(i for i, x in enumerate(plan) if "FileScan parquet [l_orderkey" in x)
            depth = plan[at].index("FileScan")
            above = []
            for line in reversed(plan[:at]):  # the chain of parents of the scan of the lines
                start = re.search(r"[A-Za-z*]", line).start()
                if start < depth:
                    depth = start
                    above.append(line)
            exchanges = [x for x in above if "Exchange hashpartitioning" in x]
            assert len(exchanges) == 1 and "l_orderkey" in exchanges[0], exchanges
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
