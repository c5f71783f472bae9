"""One lazy build of the whole mart from landed inputs.

Every attribute is a DataFrame whose plan reaches back to the landed inputs;
nothing runs until an action and nothing is written.  The refresh jobs
(``plans.refresh``) materialize the same models layer by layer instead.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlet.operators.lookup import lookup
from martlet.plans import gold, silver, staging
from martlet.sources.fixtures import RawSources


class Mart:
    """The mart's models as DataFrames over the raw inputs."""

    def __init__(self, raw: RawSources, after: dt.date | None = None, dates_from_orders: bool = False):
        self.raw = raw
        self.after = after
        self.dates_from_orders = dates_from_orders

    # staging -------------------------------------------------------------
    @cached_property
    def stg_categories(self) -> DataFrame:
        return staging.stg_categories(self.raw.categories)

    @cached_property
    def stg_channels(self) -> DataFrame:
        return staging.stg_channels(self.raw.channels)

    @cached_property
    def stg_statuses(self) -> DataFrame:
        return staging.stg_statuses(self.raw.statuses)

    @cached_property
    def stg_products(self) -> DataFrame:
        return staging.stg_products(self.raw.products)

    @cached_property
    def stg_kit_components(self) -> DataFrame:
        return staging.stg_kit_components(self.raw.products)

    @cached_property
    def stg_orders(self) -> DataFrame:
        return staging.stg_orders(self.raw.sales_orders, with_dt=True)

    @cached_property
    def stg_order_items(self) -> DataFrame:
        return staging.stg_order_items(self.raw.sales_items, with_order_header=True)

    # silver --------------------------------------------------------------
    @cached_property
    def dim_categories(self) -> DataFrame:
        return silver.dim_categories(self.stg_categories)

    @cached_property
    def dim_channels(self) -> DataFrame:
        return silver.dim_channels(self.stg_channels)

    @cached_property
    def dim_statuses(self) -> DataFrame:
        return silver.dim_statuses(self.stg_statuses)

    @cached_property
    def product_rows(self) -> int:
        """One number, read first: Spark cannot tell the size of a list that is itself a join."""
        return self.raw.products.count()

    @cached_property
    def dim_products(self) -> DataFrame:
        products = silver.dim_products(self.stg_products, self.stg_kit_components, self.product_rows)
        return lookup(products, self.product_rows)

    @cached_property
    def kit_bridge(self) -> DataFrame:
        return silver.kit_bridge(self.stg_kit_components)

    @cached_property
    def dim_kit_components(self) -> DataFrame:
        return silver.dim_kit_components(self.kit_bridge, self.dim_products)

    @cached_property
    def silver_orders(self) -> DataFrame:
        return silver.silver_orders(self.stg_orders, self.stg_statuses, self.after)

    @cached_property
    def silver_order_items(self) -> DataFrame:
        return silver.silver_order_items(self.stg_order_items, self.stg_statuses, self.after, audit_columns=False)

    # gold ----------------------------------------------------------------
    @cached_property
    def fact_item_details(self) -> DataFrame:
        return gold.fact_item_details(self.silver_order_items, self.silver_orders, self.dim_products)

    @cached_property
    def fact_orders(self) -> DataFrame:
        return gold.fact_orders(self.silver_orders, gold.line_costs(self.silver_order_items, self.dim_products), self.dim_channels)

    @cached_property
    def fact_channel_performance(self) -> DataFrame:
        return gold.fact_channel_performance(self.fact_item_details, self.fact_orders, self.dim_products,
                                             self.dim_categories, self.dim_channels)

    @cached_property
    def fact_product_performance(self) -> DataFrame:
        return gold.fact_product_performance(self.fact_item_details, self.fact_orders, self.dim_products,
                                             self.dim_categories, self.dates_from_orders)

    @cached_property
    def fact_component_demand(self) -> DataFrame:
        return gold.fact_component_demand(self.fact_item_details, self.fact_orders, self.kit_bridge,
                                          self.dim_products, self.dates_from_orders)


class FirstLoad(Mart):
    """The mart as a first load of the orders dated up to ``until`` builds it.

    Silver rows depend only on their own order record (status filter, W1 within
    one order, one copy per order), so the first load's silver layers are the
    parent's silver layers cut to ``order_date <= until``; lookups and
    dimensions are the parent's.  Gold is recomputed from the cut layers.
    (Exact when every order has a date, as in the driver's tables.)
    """

    def __init__(self, parent: Mart, until: dt.date):
        super().__init__(parent.raw, parent.after, parent.dates_from_orders)
        self.parent = parent
        self.until = until

    def _cut(self, df: DataFrame) -> DataFrame:
        return df.where(F.col("order_date") <= F.lit(self.until))

    @cached_property
    def stg_categories(self) -> DataFrame:
        return self.parent.stg_categories

    @cached_property
    def stg_channels(self) -> DataFrame:
        return self.parent.stg_channels

    @cached_property
    def stg_statuses(self) -> DataFrame:
        return self.parent.stg_statuses

    @cached_property
    def dim_products(self) -> DataFrame:
        return self.parent.dim_products

    @cached_property
    def kit_bridge(self) -> DataFrame:
        return self.parent.kit_bridge

    @cached_property
    def silver_orders(self) -> DataFrame:
        return self._cut(self.parent.silver_orders)

    @cached_property
    def silver_order_items(self) -> DataFrame:
        return self._cut(self.parent.silver_order_items)
