"""Silver models (M8-M15): dimensions, kit cost roll-up, cancelled-order filter, de-dup."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlet.functions.casts import NUMERIC
from martlet.functions.expressions import CANCELLED_STATUS, merge_key, not_cancelled, units_times
from martlet.operators.dedup import latest_per_key
from martlet.operators.lookup import lookup, spread_join

SILVER_ORDER_COLUMNS = [
    "order_id", "client_id", "sale_channel_id", "status_id",
    "order_date", "dispatch_date", "estimated_delivery_date",
    "order_shipping_cost", "order_discount_value", "order_commission_fee",
    "total_order_value",
]
SILVER_ITEM_COLUMNS = ["order_id", "product_id", "_ingested_at", "quantity", "order_unit_price",
                       "product_id_for_merge", "order_date", "rn"]


def dim_categories(stg_categories: DataFrame) -> DataFrame:
    """M8."""
    return stg_categories.select("category_id", "category_name", "parent_category_id")


def dim_channels(stg_channels: DataFrame) -> DataFrame:
    """M11."""
    return stg_channels.select("channel_id", "channel_name")


def dim_statuses(stg_statuses: DataFrame) -> DataFrame:
    """M12."""
    return stg_statuses.select("status_id", "status_name")


def kit_bridge(stg_kit_components: DataFrame) -> DataFrame:
    """Kit components with an id."""
    return (stg_kit_components
            .select("composite_product_id", "component_id", "component_quantity")
            .where(F.col("component_id").isNotNull()))


def kit_costs(stg_products: DataFrame, stg_kit_components: DataFrame, rows: int | None = None) -> DataFrame:
    """A1: per kit, SUM(component cost * component quantity); one level, NULL costs skipped.

    The sum is partial-aggregated before the shuffle on the kit id.  ``rows``: how many
    products there are, if counted.
    """
    comp = stg_kit_components.select("composite_product_id", "component_id", "component_quantity")
    cost = stg_products.select(F.col("product_id").alias("component_id"), "cost_price")
    j = comp.join(lookup(cost, rows), "component_id", "left")
    return (j.groupBy("composite_product_id")
            .agg(F.sum(units_times(F.col("cost_price"), F.col("component_quantity"))).cast(NUMERIC)
                 .alias("calculated_composite_product_cost")))


def dim_products(stg_products: DataFrame, stg_kit_components: DataFrame, rows: int | None = None) -> DataFrame:
    """Products with a kit's cost replaced by its rolled-up component cost.

    ``rows``: how many products there are, if counted; there is at most one kit per product.
    """
    kc = lookup(kit_costs(stg_products, stg_kit_components, rows), rows)
    j = stg_products.join(kc, stg_products.product_id == kc.composite_product_id, "left")
    return j.select(
        "product_id", "product_name", "product_internal_code", "brand", "price",
        "is_active", "is_kit", "category_id", "supplier_name", "product_supplier_code",
        F.coalesce(F.col("calculated_composite_product_cost"), F.col("cost_price").cast(NUMERIC)).alias("cost_price"),
        "buy_price",
    )


def dim_kit_components(bridge: DataFrame, products: DataFrame) -> DataFrame:
    """M9: kit bridge with kit and component names (the product dim joined twice)."""
    kit = products.select(F.col("product_id").alias("kit_id"), F.col("product_name").alias("kit_name"))
    comp = products.select(F.col("product_id").alias("component_id"),
                           F.col("product_name").alias("component_name"))
    b = bridge.select(F.col("composite_product_id").alias("kit_id"), "component_id", "component_quantity")
    j = b.join(kit, "kit_id", "left").join(comp, "component_id", "left")
    return j.select("kit_id", "kit_name", "component_id", "component_name", "component_quantity")


def incremental_lower_bound(max_existing: dt.date | None, as_of: dt.date, lookback_days: int = 7) -> dt.date:
    """F4 as one literal: ``order_date > max OR order_date >= as_of - 7``
    equals ``order_date > least(max, as_of - 8)`` on dates.  A NULL max (empty
    target) is handled by the caller as a first run."""
    floor_ = as_of - dt.timedelta(days=lookback_days + 1)
    return floor_ if max_existing is None else min(max_existing, floor_)


def _window_filter(df: DataFrame, after: dt.date | None) -> DataFrame:
    return df if after is None else df.where(F.col("order_date") > F.lit(after))


def latest_orders(stg_orders: DataFrame) -> DataFrame:
    """The newest landing of each order: by ``dt``, then ``epoch`` (both if the input has them),
    then every other column, so that the row kept never depends on the order of the input."""
    if "dt" not in stg_orders.columns:
        return stg_orders
    first = [c for c in ("dt", "epoch") if c in stg_orders.columns]
    rest = [c for c in stg_orders.columns if c not in (*first, "order_id")]
    return latest_per_key(stg_orders, ["order_id"], [F.col(c).desc_nulls_last() for c in (*first, *rest)])


def silver_orders(stg_orders: DataFrame, statuses: DataFrame, after: dt.date | None = None) -> DataFrame:
    """Orders that are not cancelled (NULL or unknown status drops too).

    ``after`` is the incremental bound of F4 (None on a first run).  The newest
    landing of an order is picked first and judged then, so an order landed as
    active and later as cancelled is out.
    """
    st = statuses.select("status_id", "status_name")
    j = spread_join(_window_filter(latest_orders(stg_orders), after), st, "status_id", ["order_id"])
    return j.where(not_cancelled(F.col("status_name"))).select(*SILVER_ORDER_COLUMNS)


def cancelled_orders(stg_orders: DataFrame, statuses: DataFrame) -> DataFrame:
    """order_id of the orders whose newest landing is cancelled (their rows leave the tables)."""
    gone = statuses.where(F.col("status_name") == F.lit(CANCELLED_STATUS)).select("status_id")
    return spread_join(latest_orders(stg_orders), gone, "status_id", ["order_id"], "left_semi").select("order_id")


def silver_order_items(stg_items: DataFrame, statuses: DataFrame, after: dt.date | None = None, audit_columns: bool = True) -> DataFrame:
    """Order lines of non-cancelled orders, one per (order, merge key).

    ``stg_items`` is ``stg_order_items(with_order_header=True)``: each line
    carries its own order record's date, status and ``dt``.  W1 keeps the line
    of the latest order date; ties are broken by ``dt``, ``epoch``, quantity and
    price (all descending), which makes the kept values deterministic.
    """
    st = statuses.select("status_id", "status_name")
    j = spread_join(stg_items, st, "status_id", ["order_id", "product_id"]).where(not_cancelled(F.col("status_name")))
    j = _window_filter(j, after)
    j = j.withColumn("product_id_for_merge", merge_key(F.col("product_id"), F.col("order_id")))
    landed = [c for c in ("dt", "epoch") if c in stg_items.columns]
    order = [F.col(c).desc_nulls_last() for c in ("order_date", *landed, "quantity", "order_unit_price", "product_id")]
    d = latest_per_key(j, ["order_id", "product_id_for_merge"], order, keep_rank=audit_columns)
    if not audit_columns:
        return d.select("order_id", "product_id", "quantity", "order_unit_price",
                        "product_id_for_merge", "order_date")
    return d.withColumn("_ingested_at", F.current_timestamp()).select(*SILVER_ITEM_COLUMNS)
