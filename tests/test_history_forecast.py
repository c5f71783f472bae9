"""As-of joins, cost history and the demand forecast against plain Python."""

import datetime as dt
import math
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from helpers import rows
from martlet.operators.asof import SINCE_EVER, as_of, as_of_join, extend_versions, versions
from martlet.plans import analyses, history


def D(n):
    return dt.date(2024, 1, 1) + dt.timedelta(days=n)


def held(obs, key, day):
    """The newest observation of the key up to the day, as [value], or None."""
    found = [(d, v) for k, d, v in obs if k == key and day is not None and d <= day]
    return None if key is None or not found else max(found)[1]


@pytest.fixture(scope="module")
def cases():
    rng = random.Random(11)
    obs = {(rng.randrange(6), D(rng.randrange(40))): rng.choice([None, 1, 2, 3]) for _ in range(60)}
    obs = [(k, d, v) for (k, d), v in obs.items()]
    left = [(i, rng.choice([*range(8), None]), rng.choice([*[D(n) for n in range(-3, 45)], None])) for i in range(500)]
    return obs, left


@pytest.mark.parametrize("join", [as_of, as_of_join])
def test_as_of_matches_brute_force(spark, cases, join):
    obs, left = cases
    h = spark.createDataFrame(obs, "k int, since date, v int")
    df = spark.createDataFrame(left, "id int, k int, day date").repartition(5)
    got = join(df, h, ["k"], "day", "since", ["v"]).select("id", "k", "day", "v")
    assert rows(got) == rows(spark.createDataFrame([(i, k, d, held(obs, k, d)) for i, k, d in left],
                                                   "id int, k int, day date, v int"))


def test_as_of_with_a_hot_key_makes_no_pairs(spark):
    """A third of all lines on one product: the rows sorted per key are its days, not its lines."""
    from pyspark.sql import functions as F

    lines = spark.range(30_000).select("id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).alias("k"),
                                       F.date_add(F.lit(D(0)), (F.col("id") % 20).cast("int")).alias("day"))
    h = spark.createDataFrame([(7, D(0), 1), (7, D(10), 2)], "k long, since date, v int")
    out = as_of_join(lines, h, ["k"], "day", "since", ["v"])
    got = {r[0]: r[1] for r in out.where("k = 7").groupBy("v").count().collect()}
    assert out.count() == 30_000 and set(got) == {1, 2}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" in plan and plan.index("Aggregate") > plan.index("Window")  # reduced below the window


def test_versions_are_islands_of_equal_values(spark, cases):
    obs, _ = cases
    got = versions(spark.createDataFrame(obs, "k int, since date, v int"), "k", "since", ["v"])
    want = []
    for k in {o[0] for o in obs}:
        mine, opened = sorted((d, v) for kk, d, v in obs if kk == k), []
        for i, (d, v) in enumerate(mine):
            if i == 0 or v != mine[i - 1][1]:
                opened.append((SINCE_EVER if i == 0 else d, v))
        ends = [d for d, _ in opened[1:]] + [None]
        want += [(k, v, d, e) for (d, v), e in zip(opened, ends)]
    assert rows(got, "k", "v", "valid_from", "valid_to") == rows(
        spark.createDataFrame(want, "k int, v int, valid_from date, valid_to date"))


def test_a_history_extended_day_by_day_equals_one_built_at_once(spark, cases, tmp_dir):
    obs, _ = cases
    days = sorted({d for _, d, _ in obs})
    h = versions(spark.createDataFrame([o for o in obs if o[1] == days[0]], "k int, since date, v int"), "k", "since", ["v"])
    for n, day in enumerate(days[1:12]):
        snap = spark.createDataFrame([(k, v) for k, d, v in obs if d == day], "k int, v int")
        h = extend_versions(h, snap, "k", ["v"], day)
        if n == 5:  # the same day again changes nothing
            h = extend_versions(h, snap, "k", ["v"], day)
        h.write.parquet(f"{tmp_dir}/{n}")
        h = spark.read.parquet(f"{tmp_dir}/{n}")
    at_once = versions(spark.createDataFrame([o for o in obs if o[1] <= days[11]], "k int, since date, v int"), "k", "since", ["v"])
    assert rows(h, "k", "v", "valid_from", "valid_to") == rows(at_once, "k", "v", "valid_from", "valid_to")
    late = spark.createDataFrame([(0, 99)], "k int, v int")
    with pytest.raises(ValueError):
        extend_versions(h, late, "k", ["v"], days[0])


def test_a_kit_costs_what_its_parts_cost_that_day(spark):
    money = "decimal(38,9)"
    landings = spark.createDataFrame(
        [(1, Decimal(10), D(0)), (2, Decimal(5), D(0)), (2, Decimal(6), D(10)), (3, Decimal(7), D(0)), (3, None, D(20)),
         (9, Decimal(100), D(0)), (8, Decimal(50), D(0))], f"product_id long, cost_price {money}, observed date")
    parts = spark.createDataFrame([(9, 1, 2), (9, 2, 1), (9, None, 4), (8, 3, 3)],
                                  "composite_product_id long, component_id long, component_quantity long")
    got = history.product_costs(history.own_costs(landings), parts)
    by = {(r.product_id, r.valid_from): (r.cost_price, r.valid_to) for r in got.collect()}
    assert by[9, SINCE_EVER] == (Decimal(25), D(10)) and by[9, D(10)] == (Decimal(26), None)
    # all its parts without a cost: the kit's own cost holds
    assert by[8, SINCE_EVER] == (Decimal(21), D(20)) and by[8, D(20)] == (Decimal(50), None)
    assert by[3, D(20)] == (None, None) and by[1, SINCE_EVER] == (Decimal(10), None)


def test_sales_before_and_after_a_price_change(spark):
    from martlet.plans import gold

    m = "decimal(38,9)"
    items = spark.createDataFrame([(1, 5, "5", 2, Decimal(10)), (2, 5, "5", 1, Decimal(10)), (3, 6, "6", 1, Decimal(4))],
                                  f"order_id long, product_id long, product_id_for_merge string, quantity long, order_unit_price {m}")
    orders = spark.createDataFrame([(1, D(0), 1), (2, D(9), 1), (3, None, 1)], "order_id long, order_date date, sale_channel_id long")
    products = spark.createDataFrame([(5, "P", Decimal(9)), (6, "Q", Decimal(1))], f"product_id long, product_name string, cost_price {m}")
    costs = history.own_costs(spark.createDataFrame([(5, Decimal(3), D(0)), (5, Decimal(4), D(9)), (6, Decimal(1), D(0))],
                                                    f"product_id long, cost_price {m}, observed date"))
    today = {r.order_id: r.order_product_cost for r in gold.fact_item_details(items, orders, products).collect()}
    then = {r.order_id: r.order_product_cost for r in gold.fact_item_details(items, orders, products, costs).collect()}
    assert today == {1: 18, 2: 9, 3: 1} and then == {1: 6, 2: 4, 3: None}


def forecast_by_hand(units, lead=14):
    p, z, mad = 1.0, float(units[0]), 0.0
    for q in map(float, units[1:]):
        mad = mad + 0.1 * (abs(q - p * z) - mad)
        if q > 0:
            p, z = p + 0.05 * (1.0 - p), z + 0.1 * (q - z)
        else:
            p = p + 0.05 * (0.0 - p)
    first, safe = math.ceil(p * z * lead), math.ceil(1.65 * 1.25 * mad * math.sqrt(lead))
    return p, z, mad, first, safe


def test_forecast_matches_the_recursion(spark):
    rng = random.Random(5)
    sold = [(c, f"n{c}", D(d), q) for c in range(12) for d in range(-40, 60) if rng.random() < c / 12
            for q in [rng.choice([0, 1, 2, 9])]]
    sold += [(50, None, D(59), 4), (51, "gone", D(3), 7), (52, "old", D(-40), 3)]
    df = spark.createDataFrame(sold, "component_product_id long, product_name string, order_date date, total_quantity_sold long")
    got = {r.component_product_id: r for r in analyses.demand_forecast(df, D(59), days=60).collect()}
    spine = analyses.demand_spine(df, D(59), days=60)
    for c in {s[0] for s in sold}:
        mine = {d: q for cc, _, d, q in sold if cc == c and q > 0 and D(0) <= d <= D(59)}
        if not mine:
            assert c not in got
            continue
        units = [mine.get(min(mine) + dt.timedelta(days=i), 0) for i in range((D(59) - min(mine)).days + 1)]
        assert [r.units for r in spine.where(f"component_product_id = {c}").orderBy("day").collect()] == units
        r, (p, z, mad, first, safe) = got[c], forecast_by_hand(units)
        assert (r.sale_chance, r.sale_size, r.mean_error) == pytest.approx((p, z, mad), rel=1e-12)
        assert (r.spine_days, r.demand_days, r.lead_time_units, r.safety_units) == (len(units), len(mine), first, safe)
        assert r.reorder_point == first + safe
    assert 52 not in got and got[51].sale_chance < 0.1 and got[50].spine_days == 1
    nothing = analyses.demand_forecast(df.limit(0), D(59))
    assert nothing.count() == 0 and "Python" not in nothing._jdf.queryExecution().executedPlan().toString()


def test_cost_versions_are_never_broadcast_by_the_size_of_the_list_they_come_from(spark):
    # three products landed on many days each: few rows to Spark's estimate, many in fact
    p = spark.range(1, 4).select(F.col("id").alias("product_id"), F.explode(F.sequence(F.lit(0), F.lit(99))).alias("k"))
    landings = p.select("product_id", F.col("k").cast("decimal(38,9)").alias("cost_price"),
                        F.date_add(F.lit(D(0)), F.col("k")).alias("observed"))
    parts = spark.range(10, 12).select(F.col("id").alias("composite_product_id"), (F.col("id") - 9).alias("component_id"),
                                       F.lit(2).cast("long").alias("component_quantity"))
    got = history.kit_costs_by_day(history.own_costs(landings), parts)
    assert "BroadcastHashJoin" not in got._jdf.queryExecution().executedPlan().toString()
    days = sorted((r.product_id, r.since, int(r.kit_cost)) for r in got.collect())
    assert days == [(k, SINCE_EVER if n == 0 else D(n), 2 * n) for k in (10, 11) for n in range(100)]
