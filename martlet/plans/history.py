"""Costs as of the day of sale (M10, M16, M19 with a history; today's cost stays the default).

The products' landings give a cost per product and day.  ``own_costs`` turns them into
versions; ``product_costs`` adds the kits, whose cost at a day is that of their components at
that day (A1: one level, NULL costs skipped, P11: own cost where there is none).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlet.functions.casts import NUMERIC
from martlet.functions.expressions import units_times
from martlet.operators.asof import as_of, versions


def own_costs(landings: DataFrame) -> DataFrame:
    """product_id, cost_price, observed (a row per landing) -> versions of the listed cost."""
    return versions(landings, "product_id", "observed", ["cost_price"])


def kit_costs_by_day(own: DataFrame, components: DataFrame) -> DataFrame:
    """product_id (a kit), since, kit_cost: at every day one of its components' costs changes."""
    parts = (components.where(F.col("component_id").isNotNull())
             .select(F.col("composite_product_id").alias("kit"), F.col("component_id").alias("product_id"), "component_quantity"))
    # versions come of exploded landings, which Spark takes for as few as the products: never broadcast
    days = (parts.join(own.select("product_id", "valid_from").hint("merge"), "product_id")
            .select("kit", F.col("valid_from").alias("since")).distinct())
    # a row per kit, day and component; a component's days are bounded by the calendar and its kits
    at = days.hint("merge").join(parts, "kit")
    priced = as_of(at.select("product_id", "since").distinct(), own, ["product_id"], "since", "valid_from", ["cost_price"])
    return (at.join(priced.hint("merge"), ["product_id", "since"])
            .groupBy(F.col("kit").alias("product_id"), "since")
            .agg(F.sum(units_times(F.col("cost_price"), F.col("component_quantity"))).cast(NUMERIC).alias("kit_cost")))


def product_costs(own: DataFrame, components: DataFrame) -> DataFrame:
    """M10 over time: product_id, cost_price, valid_from, valid_to."""
    kits = kit_costs_by_day(own, components)
    listed = own.select("product_id", "valid_from", F.col("cost_price").alias("_own"))
    days = listed.select("product_id", F.col("valid_from").alias("observed")).unionByName(
        kits.select("product_id", F.col("since").alias("observed"))).distinct()
    both = as_of(days, listed, ["product_id"], "observed", "valid_from", ["_own"])
    both = as_of(both, kits, ["product_id"], "observed", "since", ["kit_cost"])
    cost = F.coalesce(F.col("kit_cost"), F.col("_own").cast(NUMERIC))
    return versions(both.select("product_id", cost.alias("cost_price"), "observed"), "product_id", "observed", ["cost_price"])
