"""One order holding a third of all lines: results stay whole and exact."""

import datetime as dt
from decimal import Decimal as Dm

from pyspark.sql import functions as F

from martlet.plans import gold, silver

D = dt.date


def test_hot_order_dedup_and_sums(spark):
    n_cold, n_hot_same, n_hot_distinct = 400, 150, 50   # hot order 1: 200 of 600 lines
    rows = [(1000 + i, 10 + i % 7, 1, Dm(2), D(2024, 1, 1), 1, D(2024, 1, 7)) for i in range(n_cold)]
    rows += [(1, 5, 1 + i % 9, Dm(3), D(2024, 1, 1), 1, D(2024, 1, 7)) for i in range(n_hot_same)]
    rows += [(1, 100 + i, 2, Dm(4), D(2024, 1, 1), 1, D(2024, 1, 7)) for i in range(n_hot_distinct)]
    items = spark.createDataFrame(rows, "order_id bigint, product_id bigint, quantity bigint, "
                                        "order_unit_price decimal(38,9), order_date date, status_id bigint, dt date")
    items = items.repartition(8)
    statuses = spark.createDataFrame([(1, "ATENDIDO")], "status_id bigint, status_name string")
    si = silver.silver_order_items(items, statuses)
    hot = si.where("order_id = 1")
    assert hot.count() == 1 + n_hot_distinct                       # one line per merge key, none dropped beyond W1
    assert hot.where("product_id = 5").first().quantity == 9       # the largest quantity of the copies
    assert si.count() == n_cold + 1 + n_hot_distinct
    orders = spark.createDataFrame(
        [(o, 1, 1, 1, D(2024, 1, 1), None, None, Dm(0), Dm(0), Dm(0), Dm(100)) for o in [1] + list(range(1000, 1400))],
        "order_id bigint, client_id bigint, sale_channel_id bigint, status_id bigint, order_date date, "
        "dispatch_date date, estimated_delivery_date date, order_shipping_cost decimal(38,9), "
        "order_discount_value decimal(38,9), order_commission_fee decimal(38,9), total_order_value decimal(38,9)")
    products = spark.createDataFrame([(p, Dm(1)) for p in [5] + list(range(10, 17)) + list(range(100, 150))],
                                     "product_id bigint, cost_price decimal(38,9)").withColumn(
        "product_name", F.lit("P")).withColumn("is_kit", F.lit(False)).withColumn("category_id", F.lit(1))
    fid = gold.fact_item_details(si, orders, products)
    fo = gold.fact_orders(orders, fid, spark.createDataFrame([(1, "C")], "channel_id bigint, channel_name string"))
    assert fo.where("order_id = 1").first().total_order_product_cost == Dm(9 + 2 * n_hot_distinct)
    bridge = spark.createDataFrame([], "composite_product_id bigint, component_id bigint, component_quantity bigint")
    cd = gold.fact_component_demand(fid, fo, bridge, products)
    assert cd.agg(F.sum("total_quantity_sold")).first()[0] == n_cold + 9 + 2 * n_hot_distinct
