import datetime as dt
from decimal import Decimal as Dm

import pytest
from pyspark.sql import functions as F

from martlet.plans import gold, silver
from martlet.plans.catalog import mart

from helpers import SF001, rows

D = dt.date
STATUS = [(1, "ATENDIDO"), (2, "EM ABERTO"), (3, "CANCELADO")]


def _statuses(spark):
    return spark.createDataFrame(STATUS, "status_id bigint, status_name string")


def _orders(spark, data):
    return spark.createDataFrame(data, (
        "order_id bigint, client_id bigint, sale_channel_id bigint, status_id bigint, order_date date, "
        "dispatch_date date, estimated_delivery_date date, order_shipping_cost decimal(38,9), "
        "order_discount_value decimal(38,9), order_commission_fee decimal(38,9), "
        "total_order_value decimal(38,9), dt date"))


def test_silver_orders_status_filter_and_latest_copy(spark):
    o = _orders(spark, [
        (1, 1, 1, 1, D(2024, 1, 1), None, None, Dm(1), Dm(1), Dm(1), Dm(10), D(2024, 1, 7)),
        (1, 1, 1, 1, D(2024, 1, 2), None, None, Dm(1), Dm(1), Dm(1), Dm(20), D(2024, 1, 14)),  # later copy
        (2, 1, 1, 3, D(2024, 1, 1), None, None, Dm(1), Dm(1), Dm(1), Dm(10), D(2024, 1, 7)),   # cancelled
        (3, 1, 1, 99, D(2024, 1, 1), None, None, Dm(1), Dm(1), Dm(1), Dm(10), D(2024, 1, 7)),  # unknown
        (4, 1, 1, None, D(2024, 1, 1), None, None, Dm(1), Dm(1), Dm(1), Dm(10), D(2024, 1, 7)),  # NULL
    ])
    got = silver.silver_orders(o, _statuses(spark)).collect()
    assert [(r.order_id, r.order_date, r.total_order_value) for r in got] == [(1, D(2024, 1, 2), Dm("20.000000000"))]


def test_newest_landing_decides_whatever_the_input_order(spark):
    rows_ = [
        (1, 1, 1, 1, D(2024, 1, 1), None, None, Dm(1), Dm(1), Dm(1), Dm(100), D(2024, 1, 7)),
        (1, 1, 1, 1, D(2024, 1, 1), None, None, Dm(1), Dm(1), Dm(1), Dm(200), D(2024, 1, 7)),   # same dt
        (2, 1, 1, 1, D(2024, 1, 1), None, None, Dm(1), Dm(1), Dm(1), Dm(10), D(2024, 1, 7)),
        (2, 1, 1, 3, D(2024, 1, 1), None, None, Dm(1), Dm(1), Dm(1), Dm(10), D(2024, 1, 14)),   # cancelled later
    ]
    got = {tuple(rows(silver.silver_orders(_orders(spark, r), _statuses(spark)), "order_id", "total_order_value"))
           for r in (rows_, rows_[::-1])}
    assert got == {((1, Dm("200.000000000")),)}
    epochs = _orders(spark, rows_[:2]).withColumn("epoch", F.when(F.col("total_order_value") == 100, 1).otherwise(0))
    assert silver.silver_orders(epochs, _statuses(spark)).first().total_order_value == 100
    assert rows(silver.cancelled_orders(_orders(spark, rows_), _statuses(spark))) == [(2,)]


def test_silver_items_dedup_and_merge_key(spark):
    items = spark.createDataFrame([
        (1, 5, 2, Dm("5.0"), D(2024, 1, 1), 1, D(2024, 1, 7)),
        (1, 5, 3, Dm("4.0"), D(2024, 1, 1), 1, D(2024, 1, 7)),   # larger quantity wins
        (2, 6, 1, Dm("4.0"), D(2024, 1, 1), 1, D(2024, 1, 7)),
        (2, 6, 1, Dm("9.0"), D(2024, 1, 1), 1, D(2024, 1, 7)),   # same quantity: higher price
        (3, 0, 1, Dm("1.0"), D(2024, 1, 1), 2, D(2024, 1, 7)),   # missing product
        (4, 7, 1, Dm("1.0"), D(2024, 1, 1), 3, D(2024, 1, 7)),   # cancelled
    ], "order_id bigint, product_id bigint, quantity bigint, order_unit_price decimal(38,9), "
       "order_date date, status_id bigint, dt date")
    d = silver.silver_order_items(items, _statuses(spark), audit_columns=True)
    assert d.columns == silver.SILVER_ITEM_COLUMNS
    got = rows(d, "order_id", "product_id_for_merge", "quantity", "order_unit_price", "rn")
    assert got == [(1, "5", 3, Dm("4.000000000"), 1), (2, "6", 1, Dm("9.000000000"), 1),
                   (3, "missing_3", 1, Dm("1.000000000"), 1)]


def _products(spark, data):
    return spark.createDataFrame(data, (
        "product_id bigint, product_name string, product_internal_code string, brand string, "
        "price decimal(38,9), is_active boolean, is_kit boolean, category_id bigint, supplier_name string, "
        "product_supplier_code string, cost_price decimal(38,9), buy_price decimal(38,9)"))


def test_kit_cost_rollup_one_level_nulls_skipped(spark):
    p = _products(spark, [
        (1, "A", None, None, None, True, False, 1, None, None, Dm(10), None),
        (2, "B", None, None, None, True, False, 1, None, None, None, None),
        (3, "K", None, None, None, True, True, 1, None, None, Dm(99), None),   # A*2 + B*1 -> 20
        (4, "L", None, None, None, True, True, 1, None, None, Dm(7), None),    # only B -> own cost 7
        (5, "KK", None, None, None, True, True, 1, None, None, Dm(1), None),   # kit of kit K -> K's listed 99
    ])
    comp = spark.createDataFrame([(3, 1, 2), (3, 2, 1), (4, 2, 3), (5, 3, 1), (5, None, 1)],
                                 "composite_product_id bigint, component_id bigint, component_quantity bigint")
    dp = {r.product_id: r.cost_price for r in silver.dim_products(p, comp).collect()}
    assert dp[3] == Dm(20) and dp[4] == Dm(7) and dp[5] == Dm(99) and dp[1] == Dm(10) and dp[2] is None
    assert rows(silver.kit_bridge(comp)) == [(3, 1, 2), (3, 2, 1), (4, 2, 3), (5, 3, 1)]
    dk = rows(silver.dim_kit_components(silver.kit_bridge(comp), silver.dim_products(p, comp)))
    assert dk[0] == (3, "K", 1, "A", 2)


def _gold_inputs(spark):
    so = _orders(spark, [
        (1, 9, 1, 1, D(2024, 1, 1), None, None, Dm(5), Dm(2), Dm(1), Dm(100), None),
        (2, 9, 1, 1, D(2024, 1, 1), None, None, Dm(5), Dm(2), Dm(1), Dm(100), None),    # no lines
        (3, 9, 1, 1, D(2024, 1, 1), None, None, None, Dm(2), Dm(1), Dm(100), None),     # NULL freight
        (4, 9, 1, 1, D(2024, 1, 1), None, None, Dm(0), Dm(0), Dm(0), Dm(0), None),      # total 0
        (5, 9, 7, 1, D(2024, 1, 2), None, None, Dm(1), Dm(1), Dm(1), Dm(50), None),     # unknown channel
    ]).drop("dt")
    si = spark.createDataFrame([
        (1, 10, 2, Dm(20), "10", D(2024, 1, 1)),
        (1, 30, 3, Dm(50), "30", D(2024, 1, 1)),    # kit of 2 x 10 + 1 x 11
        (3, 10, 1, Dm(20), "10", D(2024, 1, 1)),
        (4, 10, 1, Dm(0), "10", D(2024, 1, 1)),
        (5, 99, 1, Dm(5), "99", D(2024, 1, 2)),     # unknown product
        (5, 0, 1, Dm(5), "missing_5", D(2024, 1, 2)),
    ], "order_id bigint, product_id bigint, quantity bigint, order_unit_price decimal(38,9), "
       "product_id_for_merge string, order_date date")
    p = _products(spark, [
        (10, "A", None, None, None, True, False, 1, None, None, Dm(4), None),
        (11, "B", None, None, None, True, False, 2, None, None, Dm(3), None),
        (30, "KIT", None, None, None, True, True, 1, None, None, Dm(11), None),
    ])
    ch = spark.createDataFrame([(1, "LOJA")], "channel_id bigint, channel_name string")
    cat = spark.createDataFrame([(1, "C1", 0), (2, "C2", 0)], "category_id bigint, category_name string, parent_category_id bigint")
    bridge = spark.createDataFrame([(30, 10, 2), (30, 11, 1)], "composite_product_id bigint, component_id bigint, component_quantity bigint")
    return so, si, p, ch, cat, bridge


def test_fact_orders_null_and_zero_rules(spark):
    so, si, p, ch, cat, _ = _gold_inputs(spark)
    fid = gold.fact_item_details(si, so, p)
    fo = {r.order_id: r for r in gold.fact_orders(so, fid, ch).collect()}
    # order 1: products 2*4 + 3*11 = 41; cost = 5 + 2 + 1 + 41 = 49 (discount counts as a cost)
    assert fo[1].total_order_product_cost == Dm(41) and fo[1].total_order_cost == Dm(49)
    assert fo[1].total_order_profit == Dm(51) and fo[1].total_order_margin == pytest.approx(0.51)
    assert fo[2].total_order_product_cost is None and fo[2].total_order_cost is None
    assert fo[2].total_order_profit is None and fo[2].total_order_margin is None
    assert fo[3].total_order_cost is None                         # NULL freight
    assert fo[4].total_order_margin is None                       # value 0: no error
    assert fo[5].sale_channel_name is None


def test_channel_performance_null_kit_flag_and_unpaired_channel(spark):
    so, si, p, ch, cat, _ = _gold_inputs(spark)
    fid = gold.fact_item_details(si, so, p)
    fo = gold.fact_orders(so, fid, ch)
    cp = gold.fact_channel_performance(fid, fo, p, cat, ch)
    got = rows(cp, "sale_channel_name", "order_date", "category_name", "total_orders",
               "total_quantity_sold", "kit_quantity_sold", "individual_product_quantity_sold")
    # unknown product 99 and missing product: NULL is_kit -> total only
    assert (None, D(2024, 1, 2), None, None, 2, 0, 0) in got
    assert (None, D(2024, 1, 2), None, 1, None, None, None) in got   # order side apart (NULL channel)
    assert ("LOJA", D(2024, 1, 1), "C1", 4, 7, 3, 4) in got          # totals repeat per category row


def test_component_demand_expands_kits(spark):
    so, si, p, ch, cat, bridge = _gold_inputs(spark)
    fid = gold.fact_item_details(si, so, p)
    fo = gold.fact_orders(so, fid, ch)
    cd = rows(gold.fact_component_demand(fid, fo, bridge, p), "component_product_id", "order_date", "total_quantity_sold")
    # 3 kits of (2 x 10 + 1 x 11) -> 6 x 10 and 3 x 11, plus the plain lines of product 10 (2 + 1 + 1)
    assert (10, D(2024, 1, 1), 10) in cd and (11, D(2024, 1, 1), 3) in cd
    assert (0, D(2024, 1, 2), 1) in cd and (99, D(2024, 1, 2), 1) in cd


def test_dates_from_orders_equivalence(spark):
    m = mart(spark, SF001)
    m2 = mart(spark, SF001, dates_from_orders=True)
    for attr in ("fact_product_performance", "fact_component_demand"):
        a, b = getattr(m, attr), getattr(m2, attr)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_component_units_equal_line_units_with_kits_expanded(spark):
    m = mart(spark, SF001)
    lines = m.fact_item_details
    per_kit = m.kit_bridge.groupBy("composite_product_id").agg(F.sum("component_quantity").alias("units"))
    expanded = (lines.join(per_kit, lines.product_id == per_kit.composite_product_id, "left")
                .select((F.col("quantity") * F.coalesce(F.col("units"), F.lit(1))).alias("u"))
                .agg(F.sum("u")).first()[0])
    demand = m.fact_component_demand.agg(F.sum("total_quantity_sold")).first()[0]
    assert demand == expanded and demand > lines.agg(F.sum("quantity")).first()[0]
