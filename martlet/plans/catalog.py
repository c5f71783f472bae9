"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Each query builds the mart lazily from the driver's tables (``sources.fixtures``)
and returns one model.  Decimal money is returned as DOUBLE (exact cents, so the
conversion is the same in every engine); internal columns are left out.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlet.operators import audit, keyindex
from martlet.operators.upsert import PartitionedMerge, duplicate_source_keys, incremental_bound, merge_rows, merge_tagged
from martlet.plans import analyses, gold, history, silver, staging
from martlet.plans.mart import FirstLoad, Mart
from martlet.sources import bronze, fixtures, schemas

# Fixed parameters of the incremental, upsert and analysis queries (as in martlet.oracle).
FIRST_LOAD_END = "1999-12-31"
WEEKLY_AS_OF = dt.date(2000, 1, 5)
REPLENISH_AS_OF = dt.date(2001, 8, 1)
UPSERT_AFTER = dt.date(1999, 6, 30)
REPRICED_EVERY, MOVED_EVERY, MOVED_DAYS, GONE_EVERY = 7, 5, 3, 11
CANCELLED_ID = 3
CHANNEL_KEYS = ["sale_channel_name", "category_name", "order_date"]

Query = Callable[[SparkSession, str], DataFrame]


def for_compare(df: DataFrame) -> DataFrame:
    """Output of a registered query: DECIMAL as DOUBLE (exact cents convert the
    same way in every engine) and DATE as ISO ``yyyy-MM-dd`` text (the same
    value whatever client library reads it); everything else as is."""
    def out(f):
        if isinstance(f.dataType, T.DecimalType):
            return F.col(f.name).cast("double").alias(f.name)
        if isinstance(f.dataType, T.DateType):
            return F.col(f.name).cast("string").alias(f.name)
        return F.col(f.name)
    return df.select(*[out(f) for f in df.schema.fields])


def mart(spark: SparkSession, sf_dir: str, until: str | None = None, **kw) -> Mart:
    """The mart over the driver's tables, as lazy plans."""
    return Mart(fixtures.from_driver_tables(spark, sf_dir, until), **kw)


def first_load(spark: SparkSession, sf_dir: str) -> Mart:
    """The mart after a first load of the orders dated up to FIRST_LOAD_END."""
    return FirstLoad(mart(spark, sf_dir), dt.date.fromisoformat(FIRST_LOAD_END))


def _incremental_orders(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(first-load silver orders, the weekly run's F4 source rows)."""
    target = first_load(spark, sf_dir).silver_orders
    after = incremental_bound(target, WEEKLY_AS_OF)
    m = mart(spark, sf_dir)
    source = silver.silver_orders(m.stg_orders, m.stg_statuses, after)
    return target, source


def incremental_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """rows a weekly run on WEEKLY_AS_OF selects after a first load up to FIRST_LOAD_END."""
    return for_compare(_incremental_orders(spark, sf_dir)[1])


def stored_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver orders as an older run left them: some since re-priced, some since moved to
    another day, and some that no later extraction brings."""
    o = first_load(spark, sf_dir).silver_orders
    k = F.col("order_id")
    old = o.withColumn("total_order_value", F.when(k % REPRICED_EVERY == 0, F.col("total_order_value") * 2)
                       .otherwise(F.col("total_order_value")).cast("decimal(38,9)"))
    old = old.withColumn("order_date", F.when(k % MOVED_EVERY == 0, F.date_sub("order_date", MOVED_DAYS))
                         .otherwise(F.col("order_date")))
    return old.unionByName(o.where(k % GONE_EVERY == 0).withColumn("order_id", -k))


def later_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver orders after UPSERT_AFTER, as a later run brings them."""
    m = mart(spark, sf_dir)
    return silver.silver_orders(m.stg_orders, m.stg_statuses, UPSERT_AFTER)


def _upsert(null_safe: bool) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        perf = mart(spark, sf_dir).fact_channel_performance
        day = F.col("order_date")
        stored = day <= F.lit(FIRST_LOAD_END).cast("date")
        # the rows of the model once, as the older run stored them (two kinds) and as the later run brings them
        part = F.explode(F.array_compact(F.array(F.when(stored, "target"), F.when(stored, "gone"),
                                                 F.when(day > F.lit(UPSERT_AFTER), "source"))))
        rows = perf.withColumn("_part", part)
        source = F.col("_part") == "source"
        rows = rows.withColumn("total_revenue", F.when(source, F.col("total_revenue")).otherwise(
            F.col("total_revenue") + 1).cast("decimal(38,9)"))
        rows = rows.withColumn("sale_channel_name", F.when(F.col("_part") == "gone", F.concat(F.lit("GONE "), "sale_channel_name"))
                               .otherwise(F.col("sale_channel_name")))
        return for_compare(merge_tagged(rows, source, CHANNEL_KEYS, null_safe).drop("_part"))
    run.__name__ = "upsert_null_safe" if null_safe else "upsert_plain"
    return run


def upsert_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The merge of changed, moved and new orders, rewriting only the touched order dates."""
    target = stored_orders(spark, sf_dir)
    pm = PartitionedMerge.plan(target, later_orders(spark, sf_dir), ["order_id"], "order_date")
    return for_compare(pm.full_result(target, "order_date"))


def _held_partitions(target: DataFrame, source: DataFrame) -> DataFrame:
    index = keyindex.key_bitmaps(target, "order_id", "order_date")
    return keyindex.partitions_holding(index, source, "order_id", "order_date")


def key_index_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order dates whose stored rows hold an order that a later run brings, from the key index."""
    return for_compare(_held_partitions(stored_orders(spark, sf_dir), later_orders(spark, sf_dir)))


def upsert_indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``upsert_partitioned``, reading only the partitions that the key index names."""
    target, source = stored_orders(spark, sf_dir), later_orders(spark, sf_dir)
    dates = [r[0] for r in _held_partitions(target, source).collect()]  # bounded by the calendar
    pm = PartitionedMerge.plan(target, source, ["order_id"], "order_date", candidates=dates)
    return for_compare(pm.full_result(target, "order_date"))


def upsert_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored table lacks a column of the source and has one that the source dropped."""
    target = stored_orders(spark, sf_dir).drop("client_id").withColumn("legacy_flag", F.lit("x"))
    return for_compare(merge_rows(target, later_orders(spark, sf_dir), ["order_id"]))


def upsert_cancelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U6 with cancellations: stored when still active, landed again, some of them as cancelled."""
    m = mart(spark, sf_dir)
    typed = m.stg_orders
    target = typed.where(F.col("order_date") <= F.lit(FIRST_LOAD_END).cast("date")).select(
        *silver.SILVER_ORDER_COLUMNS)
    again = typed.where(F.col("order_date") > F.lit(UPSERT_AFTER))
    merged = merge_rows(target, silver.silver_orders(again, m.stg_statuses), ["order_id"],
                        deletes=silver.cancelled_orders(again, m.stg_statuses))
    return for_compare(merged)


def upsert_duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U4: keys that several source rows hold."""
    return for_compare(duplicate_source_keys(mart(spark, sf_dir).fact_channel_performance, CHANNEL_KEYS))


def latest_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M15 over orders landed three times: re-priced on the same ``dt``, then cancelled later."""
    m = mart(spark, sf_dir)
    one = m.stg_orders.withColumn("epoch", F.lit(0))
    k = F.col("order_id")
    second = one.where(k % REPRICED_EVERY == 0).withColumn("epoch", F.lit(1)).withColumn(
        "total_order_value", (F.col("total_order_value") + 5).cast("decimal(38,9)"))
    third = one.where(k % GONE_EVERY == 0).withColumn("dt", F.date_add("dt", 7)).withColumn(
        "status_id", F.lit(CANCELLED_ID).cast("bigint"))
    return for_compare(silver.silver_orders(one.unionByName(second).unionByName(third), m.stg_statuses))


def money_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P4-P6 with nine decimals: line measures per product as text, exact to the last digit."""
    def nine(col, every: int, step: str):
        return ((col % every).cast("decimal(13,0)") + F.lit(step).cast("decimal(13,9)")).cast("decimal(38,9)")

    li = fixtures._read(spark, sf_dir, "lineitem")
    items = li.select(F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"),
                      F.col("l_partkey").cast("string").alias("product_id_for_merge"),
                      F.col("l_quantity").cast("bigint").alias("quantity"),
                      nine(F.col("l_orderkey"), 89, "0.123456789").alias("order_unit_price"))
    part = fixtures._read(spark, sf_dir, "part")
    products = part.select(F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"),
                           nine(F.col("p_partkey"), 7, "0.111111111").alias("cost_price"))
    fid = gold.fact_item_details(items, mart(spark, sf_dir).silver_orders, products)
    return fid.groupBy("product_id").agg(*[
        F.sum(c).cast("string").alias(c) for c in ("order_product_cost", "gross_revenue", "gross_profit")])


def _landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze.parse_lines(fixtures.landed_lines(spark, sf_dir), schemas.RAW_SALES)


def landed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order records parsed from text with bad ids, dates and amounts."""
    lines = fixtures.landed_lines(spark, sf_dir, items=False)
    orders, _ = bronze.split_sales(bronze.data_rows(bronze.parse_lines(lines, schemas.RAW_SALES)))
    return for_compare(staging.stg_orders(orders).select("order_id", "order_date", "total_order_value", "status_id",
                                                         "sale_channel_id"))


def landed_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines exploded from parsed records; empty and missing lists give none."""
    _, lines = bronze.split_sales(bronze.data_rows(_landed(spark, sf_dir)))
    return for_compare(staging.stg_order_items(lines))


def landed_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Header counts against landed and quarantined lines."""
    lines = fixtures.landed_lines(spark, sf_dir, items=False)
    return for_compare(bronze.run_audit(bronze.parse_lines(lines, schemas.RAW_SALES)).select(
        "dt", "declared_rows", "landed_rows", "quarantined_rows", "count_matches"))


def landed_undeclared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1-S6 with the whole record: a field outside the schema, beside declared ones."""
    rows = bronze.parse_lines(fixtures.landed_lines(spark, sf_dir, items=False), schemas.RAW_SALES, whole=True)
    kept = rows.where(F.col("metadata").isNull() & F.col("data").isNotNull())
    return for_compare(kept.select(
        F.col("data.id").try_cast("bigint").alias("order_id"),
        bronze.undeclared(kept, "$.data.observacoes.texto").alias("note"),
        bronze.undeclared(kept, "$.data.observacoes.codigo", "bigint").alias("note_code"),
        bronze.undeclared(kept, "$.data.situacao.id", "bigint").alias("status_id")))


def weekly_distinct_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4 by week at three levels, merged from daily sets of orders."""
    m = mart(spark, sf_dir)
    return for_compare(gold.weekly_orders(gold.order_sets(m.fact_item_details, m.dim_products, m.dim_categories, m.dim_channels)))


def _attempts(fn) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return for_compare(fn(fixtures.extraction_attempts(spark, sf_dir)))
    run.__name__ = f"audit_{fn.__name__}"
    return run


def audit_batch_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return for_compare(audit.batch_summary(fixtures.extraction_attempts(spark, sf_dir)))


def audit_retry_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return for_compare(audit.run_summary(fixtures.extraction_attempts(spark, sf_dir)))


def abc_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return for_compare(analyses.abc_curve(mart(spark, sf_dir).fact_item_details))


def replenishment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return for_compare(analyses.replenishment(mart(spark, sf_dir).fact_component_demand, REPLENISH_AS_OF))


def _product_costs(spark: SparkSession, sf_dir: str, m: Mart) -> DataFrame:
    return history.product_costs(history.own_costs(fixtures.product_landings(spark, sf_dir)), m.stg_kit_components)


def product_cost_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M10 over time: every product's cost versions, kits from their components' versions."""
    return for_compare(_product_costs(spark, sf_dir, mart(spark, sf_dir)))


def item_details_at_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M16 at the cost of the order's day."""
    m = mart(spark, sf_dir)
    fid = gold.fact_item_details(m.silver_order_items, m.silver_orders, m.dim_products, _product_costs(spark, sf_dir, m))
    return for_compare(fid.select(*gold.ITEM_DETAIL_COLUMNS))


def product_performance_at_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M19 at the cost of each day."""
    m = mart(spark, sf_dir)
    return for_compare(gold.fact_product_performance(m.fact_item_details, m.fact_orders, m.dim_products, m.dim_categories,
                                                     costs=_product_costs(spark, sf_dir, m)))


def demand_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units per component and day, zero days included."""
    return for_compare(analyses.demand_spine(mart(spark, sf_dir).fact_component_demand, REPLENISH_AS_OF))


def demand_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forecast, safety stock and reorder point per component."""
    return for_compare(analyses.demand_forecast(mart(spark, sf_dir).fact_component_demand, REPLENISH_AS_OF))


def _model(attr: str, columns: list[str] | None = None) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = getattr(mart(spark, sf_dir), attr)
        if columns is not None:
            df = df.select(*columns)
        return for_compare(df)
    run.__name__ = attr
    return run


def _stg_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return for_compare(staging.stg_order_items(fixtures.raw_sales_items(spark, sf_dir, with_header=False)))


def _stg_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return for_compare(staging.stg_orders(fixtures.raw_sales_orders(spark, sf_dir)))


def _silver_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = mart(spark, sf_dir)
    rows = silver.silver_order_items(m.stg_order_items, m.stg_statuses)
    return for_compare(rows.drop("_ingested_at"))


QUERIES: dict[str, Query] = {
    # staging (M1-M7)
    "stg_categories": _model("stg_categories"),
    "stg_order_items": _stg_order_items,
    "stg_products": _model("stg_products"),
    "stg_kit_components": _model("stg_kit_components"),
    "stg_channels": _model("stg_channels"),
    "stg_orders": _stg_orders,
    "stg_statuses": _model("stg_statuses"),
    # silver (M8-M15)
    "dim_products_kit_cost": _model("dim_products"),
    "silver_kit_bridge": _model("kit_bridge"),
    "dim_kit_components": _model("dim_kit_components"),
    "silver_orders": _model("silver_orders"),
    "silver_order_items_dedup": _silver_items,
    "dim_categories": _model("dim_categories"),
    "dim_channels": _model("dim_channels"),
    "dim_statuses": _model("dim_statuses"),
    "latest_landing": latest_landing,
    # gold (M16-M20)
    "fact_item_details": _model("fact_item_details", gold.ITEM_DETAIL_COLUMNS),
    "fact_orders": _model("fact_orders"),
    "fact_channel_performance": _model("fact_channel_performance"),
    "fact_product_performance": _model("fact_product_performance"),
    "fact_component_demand": _model("fact_component_demand"),
    "weekly_distinct_orders": weekly_distinct_orders,
    # incremental runs and upserts
    "incremental_window": incremental_window,
    "upsert_null_safe": _upsert(True),
    "upsert_plain": _upsert(False),
    "upsert_partitioned": upsert_partitioned,
    "key_index_partitions": key_index_partitions,
    "upsert_indexed": upsert_indexed,
    "upsert_columns": upsert_columns,
    "upsert_cancelled": upsert_cancelled,
    "upsert_duplicate_keys": upsert_duplicate_keys,
    # landed text (S1-S6, N1, C2-C4, E4) and money scale
    "landed_orders": landed_orders,
    "landed_items": landed_items,
    "landed_audit": landed_audit,
    "landed_undeclared": landed_undeclared,
    "money_scale": money_scale,
    # extraction audit
    "audit_batch_summary": audit_batch_summary,
    "audit_retry_reconcile": audit_retry_reconcile,
    "audit_failed_ids": _attempts(audit.failed_ids),
    "audit_permanent_failures": _attempts(audit.permanent_failures),
    # stated business questions
    "abc_curve": abc_curve,
    "replenishment": replenishment,
    "demand_spine": demand_spine,
    "demand_forecast": demand_forecast,
    # costs of the day of sale
    "product_cost_history": product_cost_history,
    "item_details_at_cost": item_details_at_cost,
    "product_performance_at_cost": product_performance_at_cost,
}


def queries() -> dict[str, Query]:
    return dict(QUERIES)
