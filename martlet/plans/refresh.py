"""Refresh jobs: write the mart layer by layer.

``refresh_full`` builds every model (the first load); ``refresh_weekly``
builds the weekly tag set only: staging orders and lines, silver orders and
lines with the 7-day look-back (F4) or a given window (F6), and the five gold
tables for the order dates that the silver merge touched.  Dimensions are read
as they stand.  Staging models are views; silver and gold are written, orders,
lines and gold partitioned by order date.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlet.operators.audit import in_window
from martlet.operators.upsert import DuplicateKeyError, duplicate_source_keys, incremental_bound
from martlet.plans import gold, silver, staging
from martlet.sources.fixtures import RawSources
from martlet.sources.tables import TableStore, indexed_key

# Table names and merge keys of the incremental models; all are partitioned by order date.
DAY = "order_date"
SILVER_ORDERS = ("silver_orders_details", ["order_id"])
SILVER_ITEMS = ("silver_order_items_details", ["order_id", "product_id_for_merge"])
GOLD = {
    "fact_order_items_details": ["order_id", "product_id_for_merge"],
    "fact_orders": ["order_id"],
    "fact_order_channel_performance": ["sale_channel_name", "category_name", "order_date"],
    "fact_order_items_performance": ["product_id_for_merge", "order_date"],
    "fact_order_items_stock": ["component_product_id", "order_date"],
}
# M18 holds two rows per (NULL channel, day, NULL category) by design, so a one-to-one merge would fail
UNCHECKED = {"fact_order_channel_performance"}
DIMS = ["dim_categories", "dim_sales_channels", "dim_sales_status", "dim_products",
        "silver_composites_products", "dim_product_components"]

Window = tuple[dt.date, dt.date]


def refresh_dims(store: TableStore, raw: RawSources) -> None:
    staging.create_views(raw)
    products = staging.stg_products(raw.products)
    comps = staging.stg_kit_components(raw.products)
    store.overwrite("dim_categories", silver.dim_categories(staging.stg_categories(raw.categories)))
    store.overwrite("dim_sales_channels", silver.dim_channels(staging.stg_channels(raw.channels)))
    store.overwrite("dim_sales_status", silver.dim_statuses(staging.stg_statuses(raw.statuses)))
    dp = store.overwrite("dim_products", silver.dim_products(products, comps))
    twice = duplicate_source_keys(dp, ["product_id"]).limit(5).collect()
    if twice:  # every line of such a product would count twice
        raise DuplicateKeyError(f"several products share an id: {[r[0] for r in twice]}")
    bridge = store.overwrite("silver_composites_products", silver.kit_bridge(comps))
    store.overwrite("dim_product_components", silver.dim_kit_components(bridge, dp))


def _landed(raw: DataFrame, after: dt.date | None, window: Window | None) -> DataFrame:
    """Landed rows a run can need, by their ``dt`` folders.

    An order is landed under the end date of the extraction window that
    contained its order date, so ``dt >= order_date``: rows after F4's bound sit
    in folders after it, and a back-fill of a window is landed under its dates.
    """
    if "dt" not in raw.columns:
        return raw
    if window is not None:
        return raw.where(F.col("dt").between(F.lit(window[0]), F.lit(window[1])))
    return raw if after is None else raw.where(F.col("dt") > F.lit(after))


def refresh_silver(store: TableStore, raw: RawSources, as_of: dt.date, null_safe: bool = True,
                   window: Window | None = None, delete_cancelled: bool = False) -> list | None:
    """M14, M15 with F4 (or F6 for a window); the order dates touched (None: all).

    The bound is one literal per table, computed from the stored table (a
    one-row aggregate); a missing or empty table is a first run.
    ``delete_cancelled`` also removes stored orders, and their lines, whose newest
    landing in this run is cancelled.
    """
    statuses = store.read("dim_sales_status")
    touched: list | None = []
    for (name, keys), source in ((SILVER_ORDERS, raw.sales_orders), (SILVER_ITEMS, raw.sales_items)):
        after = None if window is not None else incremental_bound(store.read(name), as_of)
        landed = _landed(source, after, window)
        if name == SILVER_ORDERS[0]:
            typed = staging.stg_orders(landed, with_dt=True)
            rows = silver.silver_orders(typed, statuses, after)
            gone = silver.cancelled_orders(typed, statuses) if delete_cancelled else None
        else:
            rows = silver.silver_order_items(staging.stg_order_items(landed, with_order_header=True),
                                             statuses, after, audit_columns=True)
            if gone is not None:
                rows = rows.join(gone, "order_id", "left_anti").select(*rows.columns)
        if window is not None:
            rows = in_window(rows, *window)
        store.upsert(name, rows, keys, partition_by=DAY, null_safe=null_safe, deletes=gone)
        dates = store.last_touched[name]
        touched = None if dates is None or touched is None else touched + dates
    return None if touched is None else sorted(set(touched), key=lambda d: (d is None, d))


def _in_dates(df: DataFrame, dates: list | None) -> DataFrame:
    if dates is None:
        return df
    vals = [d for d in dates if d is not None]
    cond = F.col(DAY).isin(vals) if vals else F.lit(False)
    if None in dates:
        cond = cond | F.col(DAY).isNull()
    return df.where(cond)


def refresh_gold(store: TableStore, null_safe: bool = True, dates: list | None = None,
                 replace: bool = False) -> None:
    """M16-M20 recomputed from the stored silver tables and dims, then upserted.

    ``dates`` limits reading, computing and writing to those order dates (all when
    None, and always all when a gold table is missing).  Every gold key carries its
    order date (M16 / M17 through the order), so rows of other dates cannot change
    as long as the dimensions do not.  ``replace`` puts the recomputed rows in
    place of all rows of those dates instead of merging key by key, so that rows of
    orders that are gone go too.
    """
    if any(not store.exists(name) for name in GOLD):
        dates = None
    so, si = (_in_dates(store.read(name), dates) for name, _ in (SILVER_ORDERS, SILVER_ITEMS))
    dp, channels, categories = (store.read(d) for d in ("dim_products", "dim_sales_channels", "dim_categories"))

    def put(name: str, rows: DataFrame) -> DataFrame:
        if replace and dates is not None:
            store.replace(name, rows, GOLD[name], DAY, dates)
        elif replace:
            store.overwrite(name, rows, DAY, indexed_key(rows, GOLD[name], DAY))
        else:
            store.upsert(name, rows, GOLD[name], DAY, null_safe, check=name not in UNCHECKED)
        return _in_dates(store.read(name), dates)

    fid = put("fact_order_items_details", gold.fact_item_details(si, so, dp))
    fo = put("fact_orders", gold.fact_orders(so, fid, channels))
    put("fact_order_channel_performance", gold.fact_channel_performance(fid, fo, dp, categories, channels))
    put("fact_order_items_performance", gold.fact_product_performance(fid, fo, dp, categories))
    put("fact_order_items_stock", gold.fact_component_demand(fid, fo, store.read("silver_composites_products"), dp))


def refresh_full(spark: SparkSession, root: str, raw: RawSources, as_of: dt.date,
                 null_safe: bool = True) -> TableStore:
    """First load: all models (dims overwritten; incremental models merged if they exist)."""
    store = TableStore(spark, root)
    refresh_dims(store, raw)
    refresh_silver(store, raw, as_of, null_safe)
    refresh_gold(store, null_safe)
    return store


def refresh_weekly(spark: SparkSession, root: str, raw: RawSources, as_of: dt.date, null_safe: bool = True,
                   gold_scope: str = "touched", window: Window | None = None,
                   delete_cancelled: bool = False) -> TableStore:
    """Weekly tag set: orders and lines only; dims as they stand.

    ``gold_scope="touched"`` recomputes gold only for the order dates the silver merge
    touched (dates landed, and earlier dates of orders that moved or left); ``"all"``
    recomputes everything, as the SQL models do, to the same rows.
    """
    store = TableStore(spark, root)
    missing = [d for d in ("dim_sales_status", "dim_products", "dim_sales_channels", "dim_categories",
                           "silver_composites_products") if not store.exists(d)]
    if missing:
        raise RuntimeError(f"weekly refresh needs the dimension tables first: {missing}")
    touched = refresh_silver(store, raw, as_of, null_safe, window, delete_cancelled)
    refresh_gold(store, null_safe, touched if gold_scope == "touched" else None, replace=delete_cancelled)
    return store


def first_needed(spark: SparkSession, root: str, as_of: dt.date) -> dt.date | None:
    """The first ``dt`` folder a weekly run can need (None: all)."""
    bounds = [incremental_bound(TableStore(spark, root).read(name), as_of) for name, _ in (SILVER_ORDERS, SILVER_ITEMS)]
    return None if None in bounds else min(bounds) + dt.timedelta(days=1)
