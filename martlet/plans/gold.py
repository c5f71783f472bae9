"""Gold models (M16-M20): line profit, order profit and margin, channel / product /
component performance.

Scale notes
-----------
* Lines meet orders on ``order_id`` once, in M16, which stores the order's date and
  channel id with the line; M18 needs no second join.
* Where the result is grouped by product (M18-M20), lines are first
  aggregated per product (and day / channel), partially on the map side, and
  only the aggregated rows meet the product dimension and the kit bridge.  A
  best-selling product is therefore one row per day and map task before any
  shuffle, whatever its share of the lines.  The sums are exact decimals, so
  ``SUM(cost * q) = cost * SUM(q)`` per product holds to the last digit.
* Lookup joins carry no hint here; ``plans.mart`` marks the product dimension where its rows are counted.
* ``dates_from_orders=False`` (default) takes a line's order date from the
  line table itself: M16 stores exactly M15's date of the order, the same
  value M17 carries, so joining M17 back only to read it again is a shuffle of all
  lines for nothing.  ``True`` performs that join; tests check both give the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlet.functions.casts import NUMERIC
from martlet.functions.expressions import matchable_product_id, money_minus, order_cost, ratio, units_times
from martlet.operators.asof import as_of, as_of_join
from martlet.operators.distinct import count_sets, id_sets, merge_sets
from martlet.operators.lookup import spread_join

ITEM_DETAIL_COLUMNS = ["order_id", "order_date", "product_id", "product_name", "product_id_for_merge",
                       "quantity", "order_unit_price", "order_product_cost", "gross_revenue", "gross_profit"]
# M16 as stored also has sale_channel_id
FACT_ORDER_COLUMNS = ["order_id", "order_date", "client_id", "sale_channel_name", "order_shipping_cost",
                      "order_discount_value", "order_commission_fee", "total_order_value",
                      "total_order_product_cost", "total_order_cost", "total_order_profit", "total_order_margin"]
CHANNEL_PERF_COLUMNS = ["sale_channel_name", "order_date", "category_name", "total_orders", "total_revenue",
                        "total_shipping_cost", "total_discount_value", "total_profit", "total_quantity_sold",
                        "kit_quantity_sold", "individual_product_quantity_sold"]
PRODUCT_PERF_COLUMNS = ["product_id", "product_name", "product_id_for_merge", "order_date", "gross_revenue",
                        "total_cost", "gross_profit", "total_quantity", "category_name"]
COMPONENT_DEMAND_COLUMNS = ["component_product_id", "product_name", "order_date", "total_quantity_sold"]


def _num(c) -> F.Column:
    return c.cast(NUMERIC)


def fact_item_details(silver_items: DataFrame, silver_orders: DataFrame, products: DataFrame,
                      costs: DataFrame | None = None) -> DataFrame:
    """One row per silver line with cost, revenue and profit at the current product cost.

    With ``costs`` (``plans.history.product_costs``) at the cost of the order's day instead.

    The product join is on the integer id (so a product 0, if one existed, would match).
    ``sale_channel_id`` of the order comes along for M18.
    """
    od = silver_orders.select("order_id", F.col("order_date").alias("_od_date"), "sale_channel_id")
    p = products.select("product_id", "product_name", "cost_price")
    oi = silver_items.select("order_id", "product_id", "product_id_for_merge", "quantity", "order_unit_price")
    j = oi.join(od, "order_id", "left").join(p, "product_id", "left")
    if costs is not None:
        j = as_of_join(j.drop("cost_price"), costs, ["product_id"], "_od_date", "valid_from", ["cost_price"])
    q, price, cost = F.col("quantity"), F.col("order_unit_price"), F.col("cost_price")
    return j.select(
        "order_id",
        F.col("_od_date").alias("order_date"),
        "product_id", "product_name", "product_id_for_merge", "quantity", "order_unit_price",
        _num(units_times(cost, q)).alias("order_product_cost"),
        _num(units_times(price, q)).alias("gross_revenue"),
        _num(units_times(money_minus(price, cost), q)).alias("gross_profit"),
        "sale_channel_id",
    )


def line_costs(silver_items: DataFrame, products: DataFrame) -> DataFrame:
    """order_id, order_product_cost of M16: what M17 needs of it, without the join with orders."""
    p = products.select("product_id", "cost_price")
    return (silver_items.select("order_id", "product_id", "quantity").join(p, "product_id", "left")
            .select("order_id", _num(units_times(F.col("cost_price"), F.col("quantity"))).alias("order_product_cost")))


def fact_orders(silver_orders: DataFrame, item_details: DataFrame, channels: DataFrame) -> DataFrame:
    """Order costs, profit and margin (of ``item_details``: ``order_id`` and ``order_product_cost``).

    Lines are summed per order first (partial aggregation, then one row per
    order), and joined 1:1, instead of joining all lines and grouping by order.
    An order without lines, or whose lines have no cost, has a NULL product
    cost and so a NULL cost, profit and margin; the discount counts as a cost.
    """
    per_order = (item_details.groupBy("order_id")
                 .agg(F.sum("order_product_cost").alias("total_order_product_cost")))
    ch = channels.select(F.col("channel_id").alias("sale_channel_id"), F.col("channel_name").alias("sale_channel_name"))
    j = spread_join(silver_orders.join(per_order, "order_id", "left"), ch, "sale_channel_id", ["order_id"])
    ship, disc, comm = F.col("order_shipping_cost"), F.col("order_discount_value"), F.col("order_commission_fee")
    value, pcost = F.col("total_order_value"), F.col("total_order_product_cost")
    cost = order_cost(ship, disc, comm, pcost)
    return j.select(
        "order_id", "order_date", "client_id", "sale_channel_name",
        "order_shipping_cost", "order_discount_value", "order_commission_fee", "total_order_value",
        _num(pcost).alias("total_order_product_cost"),
        _num(cost).alias("total_order_cost"),
        _num(money_minus(value, cost)).alias("total_order_profit"),
        ratio(money_minus(value, cost), value).alias("total_order_margin"),
    )


def _product_attrs(products: DataFrame, categories: DataFrame) -> DataFrame:
    p = products.select(F.col("product_id").alias("_pk"), "product_name", "is_kit", "category_id", "cost_price")
    c = categories.select("category_id", "category_name")
    return p.join(c, "category_id", "left")


def _line_dates(item_details: DataFrame, orders: DataFrame, dates_from_orders: bool) -> DataFrame:
    if not dates_from_orders:
        return item_details
    od = orders.select("order_id", F.col("order_date").alias("_fo_date"))
    return (item_details.drop("order_date").join(od, "order_id", "left")
            .withColumnRenamed("_fo_date", "order_date"))


def fact_channel_performance(item_details: DataFrame, orders: DataFrame, products: DataFrame,
                             categories: DataFrame, channels: DataFrame) -> DataFrame:
    """Units by (channel, day, category) next to order totals by (channel, day).

    Order totals repeat on every category row of their (channel, day); rows
    with a NULL channel or day never pair, so they appear once from each side.
    An unknown product has NULL ``is_kit`` and counts in the total only.
    """
    named = channels.select(F.col("channel_id").alias("sale_channel_id"),
                            F.col("channel_name").alias("sale_channel_name"))
    # one row per (channel, day, product) before any dimension
    sold = (item_details.groupBy("sale_channel_id", "order_date",
                                 matchable_product_id(F.col("product_id")).alias("_pk"))
            .agg(F.sum("quantity").alias("_q")))
    sold = (spread_join(sold, named, "sale_channel_id", ["order_date", "_pk"])
            .join(_product_attrs(products, categories), "_pk", "left"))
    q = F.col("_q")
    units = (sold.groupBy("sale_channel_name", "order_date", "category_name").agg(
        F.sum(q).alias("total_quantity_sold"),
        F.sum(F.when(F.col("is_kit"), q).otherwise(F.lit(0))).alias("kit_quantity_sold"),
        F.sum(F.when(~F.col("is_kit"), q).otherwise(F.lit(0))).alias("individual_product_quantity_sold")))
    # fact_orders is one row per order_id, so counting ids is COUNT(DISTINCT order_id)
    totals = (orders.groupBy(F.col("sale_channel_name").alias("_channel"), F.col("order_date").alias("_day")).agg(
        F.count("order_id").alias("total_orders"),
        *[_num(F.sum(c)).alias(name) for c, name in (
            ("total_order_value", "total_revenue"), ("order_shipping_cost", "total_shipping_cost"),
            ("order_discount_value", "total_discount_value"), ("total_order_profit", "total_profit"))]))
    both = units.join(totals, (F.col("sale_channel_name") == F.col("_channel")) & (F.col("order_date") == F.col("_day")),
                      "full_outer")
    return (both.withColumn("sale_channel_name", F.coalesce("sale_channel_name", "_channel"))
            .withColumn("order_date", F.coalesce("order_date", "_day")).select(*CHANNEL_PERF_COLUMNS))


def fact_product_performance(item_details: DataFrame, orders: DataFrame, products: DataFrame,
                             categories: DataFrame,
                             dates_from_orders: bool = False, costs: DataFrame | None = None) -> DataFrame:
    """Revenue, cost at today's cost price, profit and units per product and day.

    With ``costs`` (``plans.history.product_costs``) the cost is that of the day.

    Per (product, merge key, day) the lines are summed first; the product's
    cost then multiplies the summed units.  ``priced_q`` counts only units of
    lines with a price, so ``revenue - cost * priced_q`` equals the sum of
    per-line profits, which skip lines without a price.
    """
    lines = _line_dates(item_details, orders, dates_from_orders)
    price, q = F.col("order_unit_price"), F.col("quantity")
    per_day = (lines.groupBy("product_id", "product_id_for_merge", "order_date").agg(
        F.sum(units_times(price, q)).alias("_rev"),
        F.sum(q).alias("_q"),
        F.sum(F.when(price.isNotNull(), q)).alias("_priced_q")))
    per_day = per_day.withColumn("_pk", matchable_product_id(F.col("product_id")))
    pa = _product_attrs(products, categories)
    j = per_day.join(pa, "_pk", "left")
    if costs is not None:  # a row per product, merge key and day by now
        j = as_of(j.drop("cost_price"), costs.withColumnRenamed("product_id", "_pk"), ["_pk"], "order_date", "valid_from",
                  ["cost_price"])
    cost = F.col("cost_price")
    agg = j.groupBy("product_id", "product_name", "product_id_for_merge", "order_date", "category_name").agg(
        F.sum("_rev").alias("gross_revenue"),
        F.sum(units_times(cost, F.col("_q"))).alias("total_cost"),
        F.sum(money_minus(F.col("_rev"), units_times(cost, F.col("_priced_q")))).alias("gross_profit"),
        F.sum("_q").alias("total_quantity"))
    return agg.select(
        "product_id", "product_name", "product_id_for_merge", "order_date",
        _num(F.col("gross_revenue")).alias("gross_revenue"),
        _num(F.col("total_cost")).alias("total_cost"),
        _num(F.col("gross_profit")).alias("gross_profit"),
        "total_quantity", "category_name")


def fact_component_demand(item_details: DataFrame, orders: DataFrame, bridge: DataFrame,
                          products: DataFrame, dates_from_orders: bool = False) -> DataFrame:
    """Units per component and day, a sold kit counted as its components.

    Lines are summed per (product, day) before the 1:N kit expansion.  All
    lines without a product (id 0) fold into component 0.
    """
    lines = _line_dates(item_details, orders, dates_from_orders)
    per_day = lines.groupBy("product_id", "order_date").agg(F.sum("quantity").alias("_q"))
    b = bridge.select(F.col("composite_product_id").alias("product_id"), "component_id", "component_quantity")
    x = per_day.join(b, "product_id", "left").select(
        F.coalesce(F.col("component_id"), F.col("product_id")).alias("component_product_id"),
        "order_date",
        (F.col("_q") * F.coalesce(F.col("component_quantity"), F.lit(1))).alias("final_quantity"))
    p = products.select(F.col("product_id").alias("component_product_id"), "product_name")
    j = x.join(p, "component_product_id", "left")
    return (j.groupBy("component_product_id", "order_date", "product_name")
            .agg(F.sum("final_quantity").alias("total_quantity_sold"))
            .select(*COMPONENT_DEMAND_COLUMNS))


def order_sets(item_details: DataFrame, products: DataFrame, categories: DataFrame, channels: DataFrame) -> DataFrame:
    """A4 per channel, category and day, as sets of orders that can be merged (``operators.distinct``).

    Lines are reduced to one row per (channel id, day, product, block) before the small dimensions.
    """
    sets = id_sets(item_details.withColumn("_pk", matchable_product_id(F.col("product_id"))),
                   ["sale_channel_id", "order_date", "_pk"], "order_id")
    named = channels.select(F.col("channel_id").alias("sale_channel_id"), F.col("channel_name").alias("sale_channel_name"))
    j = (spread_join(sets, named, "sale_channel_id", ["order_date", "_pk", "block"])
         .join(_product_attrs(products, categories), "_pk", "left"))
    return merge_sets(j, {c: c for c in ("sale_channel_name", "category_name", "order_date")})


def weekly_orders(sets: DataFrame) -> DataFrame:
    """Distinct orders per week by channel and category, by channel, and in all, from stored daily sets."""
    week = F.date_trunc("week", "order_date").cast("date")
    none = F.lit(None).cast("string")
    fine = merge_sets(sets, {"sale_channel_name": "sale_channel_name", "category_name": "category_name", "week": week})
    by_channel = merge_sets(fine, {"sale_channel_name": "sale_channel_name", "week": "week"})
    in_all = merge_sets(by_channel, {"week": "week"})
    levels = (("category", fine), ("channel", by_channel.withColumn("category_name", none)),
              ("week", in_all.withColumn("sale_channel_name", none).withColumn("category_name", none)))
    out = None
    for level, part in levels:
        counted = count_sets(part, ["sale_channel_name", "category_name", "week"], "total_orders").withColumn("level", F.lit(level))
        out = counted if out is None else out.unionByName(counted)
    return out.select("level", "sale_channel_name", "category_name", "week", "total_orders")
