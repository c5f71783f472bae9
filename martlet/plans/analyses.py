"""Business questions stated by the reference without a model.

Cut-offs, window and lead time are parameters of ours.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlet.operators.running import running_sum

# Fixed parameters (ours).
ABC_A_PERCENT = 80
ABC_B_PERCENT = 95
DEMAND_WINDOW_DAYS = 28
LEAD_TIME_DAYS = 14
FORECAST_DAYS = 180
SIZE_WEIGHT, CHANCE_WEIGHT, ERROR_WEIGHT = 0.1, 0.05, 0.1
SERVICE_FACTOR = 1.65          # normal deviate of 95 %
MAD_TO_DEVIATION = 1.25        # fixed value: standard deviation over mean absolute deviation


def abc_curve(item_details: DataFrame, a_percent: int = ABC_A_PERCENT, b_percent: int = ABC_B_PERCENT,
              ranges: int | None = None) -> DataFrame:
    """Products by revenue, cumulative share of total revenue, class A/B/C.

    Revenue is reduced to one row per product first (partial aggregation);
    the cumulative sum is computed range by range (``operators.running``).
    The class compares exact decimals: A while the cumulative revenue is at
    most ``a_percent`` of the total, B up to ``b_percent``, else C.
    """
    rev = (item_details.where(F.col("product_id") != 0)
           .groupBy("product_id").agg(F.sum("gross_revenue").alias("gross_revenue")))
    least = F.lit(0).cast("decimal(38,9)")
    order = [F.col("gross_revenue").isNull(), -F.coalesce(F.col("gross_revenue"), least), F.col("product_id")]
    j = running_sum(rev, "gross_revenue", order, out="cumulative_revenue", ranges=ranges, total_out="_total")
    c, t = F.col("cumulative_revenue"), F.col("_total")
    cls = (F.when(c * 100 <= t * a_percent, F.lit("A"))
           .when(c * 100 <= t * b_percent, F.lit("B")).otherwise(F.lit("C")))
    return j.select(
        "product_id",
        F.col("gross_revenue").cast("double").alias("gross_revenue"),
        c.cast("double").alias("cumulative_revenue"),
        (c.cast("double") / F.nullif(t, F.lit(0)).cast("double")).alias("cumulative_share"),
        cls.alias("abc_class"))


def replenishment(component_demand: DataFrame, as_of: dt.date, window_days: int = DEMAND_WINDOW_DAYS,
                  lead_time_days: int = LEAD_TIME_DAYS) -> DataFrame:
    """Mean daily component demand over the ``window_days`` up to ``as_of``
    (inclusive) and the units to cover ``lead_time_days`` of it (rounded up)."""
    start = as_of - dt.timedelta(days=window_days - 1)
    d = component_demand.where(F.col("order_date").between(F.lit(start), F.lit(as_of)))
    agg = d.groupBy("component_product_id", "product_name").agg(
        F.sum("total_quantity_sold").alias("window_quantity"))
    q = F.col("window_quantity")
    return agg.select(
        "component_product_id", "product_name", "window_quantity",
        (q.cast("double") / F.lit(float(window_days))).alias("avg_daily_demand"),
        F.expr(f"(window_quantity * {lead_time_days} + {window_days - 1}) div {window_days}")
        .alias("reorder_quantity"))


def demand_spine(component_demand: DataFrame, as_of: dt.date, days: int = FORECAST_DAYS) -> DataFrame:
    """A row per component and day from its first sale within ``days`` up to ``as_of``, with zero days.

    Days of a component are collected into one map, of ``days`` entries at most, and laid over the
    sequence of all its days; so the spine needs no calendar table and no join.
    """
    start = as_of - dt.timedelta(days=days - 1)
    sold = (component_demand.where(F.col("order_date").between(F.lit(start), F.lit(as_of)))
            .groupBy("component_product_id", "product_name", "order_date").agg(F.sum("total_quantity_sold").alias("q"))
            .where(F.col("q") > 0))
    per = sold.groupBy("component_product_id", "product_name").agg(
        F.min("order_date").alias("first_day"),
        F.map_from_entries(F.collect_list(F.struct("order_date", "q"))).alias("_sold"))
    return (per.withColumn("day", F.explode(F.sequence(F.col("first_day"), F.lit(as_of))))
            .select("component_product_id", "product_name", "first_day", "day",
                    F.coalesce(F.col("_sold")[F.col("day")], F.lit(0)).alias("units")))


def demand_forecast(component_demand: DataFrame, as_of: dt.date, days: int = FORECAST_DAYS,
                    lead_time_days: int = LEAD_TIME_DAYS, size_weight: float = SIZE_WEIGHT,
                    chance_weight: float = CHANCE_WEIGHT, error_weight: float = ERROR_WEIGHT,
                    service_factor: float = SERVICE_FACTOR) -> DataFrame:
    """G4 as a forecast: intermittent demand by a recursive smoother over the dense spine.

    Each day smooths the chance of a sale (zero days too, so an item that no longer sells fades
    out) and, on days with a sale, its size; the forecast is their product.  The day's forecast
    error is smoothed as well.  The reorder point covers the lead time's forecast plus a safety
    stock from the error.  The recursion runs in Spark over the component's array of days
    (``days`` entries at most).
    """
    spine = demand_spine(component_demand, as_of, days)
    per = spine.groupBy("component_product_id", "product_name", "first_day").agg(
        F.sort_array(F.collect_list(F.struct("day", F.col("units").cast("double").alias("q")))).alias("s"))

    def step(a, x):
        q, p, z, mad = x["q"], a["p"], a["z"], a["mad"]
        sale = q > 0
        return F.struct(
            F.when(sale, p + chance_weight * (1.0 - p)).otherwise(p + chance_weight * (0.0 - p)).alias("p"),
            F.when(sale, z + size_weight * (q - z)).otherwise(z).alias("z"),
            (mad + error_weight * (F.abs(q - p * z) - mad)).alias("mad"))

    begin = F.struct(F.lit(1.0).alias("p"), F.col("s")[0]["q"].alias("z"), F.lit(0.0).alias("mad"))
    done = per.withColumn("e", F.aggregate(F.slice("s", F.lit(2), F.size("s")), begin, step))
    daily = F.col("e.p") * F.col("e.z")
    lead, safety = F.ceil(daily * float(lead_time_days)), F.ceil(
        service_factor * MAD_TO_DEVIATION * F.col("e.mad") * F.sqrt(F.lit(float(lead_time_days))))
    return done.select(
        "component_product_id", "product_name", "first_day", F.size("s").cast("bigint").alias("spine_days"),
        F.size(F.filter("s", lambda x: x["q"] > 0)).cast("bigint").alias("demand_days"),
        F.col("e.p").alias("sale_chance"), F.col("e.z").alias("sale_size"), daily.alias("daily_forecast"),
        F.col("e.mad").alias("mean_error"), lead.cast("bigint").alias("lead_time_units"),
        safety.cast("bigint").alias("safety_units"), (lead + safety).cast("bigint").alias("reorder_point"))
