"""Independent DuckDB SQL for every registered query (the correctness oracle).

The SQL starts from the driver's tables and states each model's meaning on its own:
status by membership, de-dup by the greatest (quantity, price), costs by scalar
subqueries, kits as a union of plain and expanded lines.  It shares no form with the
Spark plans, so that it stays a check.  Money is cast to DOUBLE and BIGINT sums are
cast back from HUGEINT, matching the Spark output types.
"""

from __future__ import annotations

import re


def C(x: str) -> str:  # floored integer cents, as in sources.fixtures.cents
    return f"CAST(CAST(floor({x}) AS BIGINT) * 0.01 AS DECIMAL(18,2))"


STATUS_ID = ("CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 WHEN 'P' THEN 3 END")
STATUS_NAME = ("CASE o_orderstatus WHEN 'F' THEN 'Atendido' WHEN 'O' THEN 'Em aberto' "
               "WHEN 'P' THEN 'Cancelado' END")
CAT_ID = ("CASE p_type WHEN 'ECONOMY' THEN 1 WHEN 'LARGE' THEN 2 WHEN 'MEDIUM' THEN 3 "
          "WHEN 'SMALL' THEN 5 WHEN 'STANDARD' THEN 6 END")
CAT_NAME = ("CASE p_type WHEN 'ECONOMY' THEN 'Economy' WHEN 'LARGE' THEN 'Large' WHEN 'MEDIUM' THEN 'Medium' "
            "WHEN 'SMALL' THEN 'Small' WHEN 'STANDARD' THEN 'Standard' END")
CAT_PARENT = ("CASE p_type WHEN 'ECONOMY' THEN 0 WHEN 'LARGE' THEN 0 WHEN 'MEDIUM' THEN 1 "
              "WHEN 'SMALL' THEN 1 WHEN 'STANDARD' THEN 2 END")
PRODUCT_CAT = ("CASE p_type WHEN 'ECONOMY' THEN 1 WHEN 'LARGE' THEN 2 WHEN 'MEDIUM' THEN 3 WHEN 'PROMO' THEN 4 "
               "WHEN 'SMALL' THEN 5 WHEN 'STANDARD' THEN 6 END")
DT = ("CAST(o_orderdate AS DATE) + CAST(6 - date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) % 7 "
      "AS INTEGER)")

def D(col: str, alias: str | None = None) -> str:
    return f"CAST({col} AS DOUBLE) AS {alias or col.split('.')[-1]}"


def B(col: str, alias: str | None = None) -> str:
    return f"CAST({col} AS BIGINT) AS {alias or col.split('.')[-1]}"


CHANNEL_ID = "TRY_CAST(split_part(o_orderpriority, '-', 1) AS BIGINT)"

# Driver tables -> typed staging rows.
STAGING = {
    "s_status": f"""
        SELECT DISTINCT CAST({STATUS_ID} AS BIGINT) AS status_id, upper({STATUS_NAME}) AS status_name
        FROM orders WHERE {STATUS_ID} IS NOT NULL""",
    "s_channels": f"""
        SELECT {CHANNEL_ID} AS channel_id,
               upper(max(substr(o_orderpriority, strpos(o_orderpriority, '-') + 1))) AS channel_name
        FROM orders WHERE o_orderpriority <> '5-LOW' AND {CHANNEL_ID} IS NOT NULL GROUP BY 1""",
    "s_categories": f"""
        SELECT DISTINCT CAST({CAT_ID} AS BIGINT) AS category_id, upper({CAT_NAME}) AS category_name,
               CAST({CAT_PARENT} AS BIGINT) AS parent_category_id
        FROM part WHERE {CAT_ID} IS NOT NULL""",
    "s_products": f"""
        SELECT p_partkey AS product_id, upper(p_name) AS product_name,
               'P-' || CAST(p_partkey AS VARCHAR) AS product_internal_code, upper(p_brand) AS brand,
               CAST(p_retailprice AS DECIMAL(18,2)) AS price, p_size <= 40 AS is_active, p_partkey % 10 = 0 AS is_kit,
               CAST({PRODUCT_CAT} AS BIGINT) AS category_id,
               upper(s_name) AS supplier_name, CAST(s_suppkey AS VARCHAR) AS product_supplier_code,
               CASE WHEN p_partkey % 17 = 0 THEN NULL ELSE {C('p_retailprice * 60')} END AS cost_price,
               {C('p_retailprice * 55')} AS buy_price
        FROM part LEFT JOIN supplier
          ON s_suppkey = p_partkey % (SELECT COALESCE(max(s_suppkey), 0) + 1 FROM supplier)
        WHERE p_partkey > 0""",
    "s_kit_components": """
        SELECT kit.p_partkey AS composite_product_id, kit.p_partkey + c.step AS component_id, c.n AS component_quantity
        FROM part kit, (VALUES (1, CAST(2 AS BIGINT)), (2, 1), (NULL, 1)) AS c(step, n)
        WHERE kit.p_partkey > 0 AND kit.p_partkey % 10 = 0 AND (c.step IS NOT NULL OR kit.p_partkey % 50 = 0)""",
    "s_orders": f"""
        SELECT o_orderkey AS order_id, o_orderkey AS order_number,
               CAST(o_orderdate AS DATE) AS order_date,
               CAST(o_orderdate AS DATE) + 2 AS dispatch_date,
               CAST(o_orderdate AS DATE) + 10 AS estimated_delivery_date,
               CAST(o_totalprice AS DECIMAL(18,2)) AS total_products_value,
               CAST(o_totalprice AS DECIMAL(18,2)) AS total_order_value,
               o_custkey AS client_id,
               CAST(CASE WHEN o_orderkey % 97 = 0 THEN 99 ELSE {STATUS_ID} END AS BIGINT) AS status_id,
               {CHANNEL_ID} AS sale_channel_id,
               {C('o_totalprice * 2')} AS order_discount_value,
               {C('o_totalprice * 10')} AS order_commission_fee,
               CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE {C('o_totalprice * 5')} END AS order_shipping_cost,
               CAST(o_totalprice AS DECIMAL(18,2)) AS base_value,
               {DT} AS dt
        FROM orders""",
    "s_items": f"""
        SELECT l_orderkey AS order_id, l_partkey AS product_id, CAST(l_quantity AS BIGINT) AS quantity,
               {C('l_extendedprice * 100 / l_quantity')} AS order_unit_price
        FROM lineitem""",
}

MODELS = {
    "kit_spend": """
        SELECT k.composite_product_id AS kit, sum(k.component_quantity * part_of.cost_price) AS spend
        FROM s_kit_components k, s_products part_of WHERE part_of.product_id = k.component_id GROUP BY ALL""",
    "catalogue": """
        SELECT * REPLACE (COALESCE((SELECT spend FROM kit_spend WHERE kit = product_id), cost_price) AS cost_price)
        FROM s_products""",
    "kit_parts": "SELECT * FROM s_kit_components WHERE component_id IS NOT NULL",
    "active_orders": """
        SELECT * EXCLUDE (dt, order_number, total_products_value, base_value) FROM s_orders
        WHERE status_id IN (FROM s_status SELECT status_id WHERE NOT status_name = 'CANCELADO')""",
    "best_lines": """
        SELECT order_id, product_id, best.units AS quantity, best.price AS order_unit_price,
               IF(product_id = 0, printf('missing_%d', order_id), CAST(product_id AS VARCHAR)) AS product_id_for_merge,
               order_date
        FROM (SELECT order_id, product_id, order_date, max({'units': quantity, 'price': order_unit_price}) AS best
              FROM s_items SEMI JOIN active_orders USING (order_id)
              JOIN (SELECT order_id, order_date FROM s_orders) USING (order_id) GROUP BY ALL)""",
    "costed": """
        SELECT line.*, product_name, quantity * cost_price AS order_product_cost,
               quantity * order_unit_price AS gross_revenue, quantity * (order_unit_price - cost_price) AS gross_profit
        FROM best_lines line LEFT JOIN (FROM catalogue SELECT product_id, product_name, cost_price) USING (product_id)""",
    "settled": """
        SELECT order_id, order_date, client_id, channel_name AS sale_channel_name, order_shipping_cost,
               order_discount_value, order_commission_fee, total_order_value, goods AS total_order_product_cost,
               spent AS total_order_cost, total_order_value - spent AS total_order_profit,
               CASE WHEN total_order_value <> 0
                    THEN CAST(total_order_value - spent AS DOUBLE) / CAST(total_order_value AS DOUBLE) END
                 AS total_order_margin
        FROM (SELECT *, goods + order_commission_fee + order_discount_value + order_shipping_cost AS spent
              FROM (SELECT *, (SELECT sum(order_product_cost) FROM costed WHERE costed.order_id = active_orders.order_id)
                           AS goods,
                       (SELECT any_value(channel_name) FROM s_channels WHERE channel_id = sale_channel_id) AS channel_name
                    FROM active_orders))""",
    "units_sold": """
        SELECT sale_channel_name, order_date, category_name,
               CAST(sum(quantity) AS BIGINT) AS total_quantity_sold,
               CAST(sum(IF(is_kit, quantity, 0)) AS BIGINT) AS kit_quantity_sold,
               CAST(sum(IF(is_kit IS FALSE, quantity, 0)) AS BIGINT) AS individual_product_quantity_sold
        FROM (FROM costed SELECT order_id, quantity, NULLIF(product_id, 0) AS product_id)
        JOIN (FROM settled SELECT order_id, order_date, sale_channel_name) USING (order_id)
        LEFT JOIN (FROM catalogue SELECT product_id, is_kit, category_id) USING (product_id)
        LEFT JOIN (FROM s_categories SELECT category_id, category_name) USING (category_id) GROUP BY ALL""",
    "day_totals": f"""
        SELECT sale_channel_name, order_date, CAST(count(*) AS BIGINT) AS total_orders,
               {D('sum(total_order_value)', 'total_revenue')}, {D('sum(order_shipping_cost)', 'total_shipping_cost')},
               {D('sum(order_discount_value)', 'total_discount_value')}, {D('sum(total_order_profit)', 'total_profit')}
        FROM settled GROUP BY ALL""",
    "channel_days": """
        FROM units_sold LEFT JOIN day_totals USING (sale_channel_name, order_date)
        SELECT sale_channel_name, order_date, category_name, total_orders, total_revenue, total_shipping_cost,
               total_discount_value, total_profit, total_quantity_sold, kit_quantity_sold,
               individual_product_quantity_sold
        UNION ALL BY NAME
        FROM day_totals ANTI JOIN units_sold USING (sale_channel_name, order_date)""",
    "product_days": f"""
        SELECT product_id, product_name, product_id_for_merge, order_date,
               {D('sum(gross_revenue)', 'gross_revenue')}, {D('sum(order_product_cost)', 'total_cost')},
               {D('sum(gross_profit)', 'gross_profit')}, {B('sum(quantity)', 'total_quantity')},
               (SELECT any_value(category_name) FROM s_categories JOIN catalogue USING (category_id)
                WHERE catalogue.product_id = costed.product_id) AS category_name
        FROM costed GROUP BY product_id, product_name, product_id_for_merge, order_date""",
    "demand": f"""
        SELECT component_product_id, (SELECT any_value(product_name) FROM catalogue
                                      WHERE product_id = component_product_id) AS product_name,
               order_date, {B('sum(units)', 'total_quantity_sold')}
        FROM (SELECT product_id AS component_product_id, order_date, quantity AS units FROM costed
              ANTI JOIN (SELECT composite_product_id AS product_id FROM kit_parts) USING (product_id)
              UNION ALL
              SELECT component_id, order_date, quantity * component_quantity FROM costed
              JOIN kit_parts ON composite_product_id = product_id)
        GROUP BY component_product_id, order_date""",
    "attempts": f"""
        SELECT CAST({DT} AS VARCHAR) AS run_id, 'sales' AS entity, CAST(floor(o_orderkey / 100) AS INTEGER) AS batch,
               o_orderkey AS object_id, 0 AS attempt, o_orderkey % 53 <> 0 AS ok
        FROM orders
        UNION ALL
        SELECT CAST({DT} AS VARCHAR), 'sales', CAST(floor(o_orderkey / 100) AS INTEGER), o_orderkey, r.attempt,
               CASE WHEN o_orderkey % 106 = 0 THEN false ELSE r.attempt = 1 + o_orderkey % 3 END
        FROM orders, LATERAL (SELECT unnest(generate_series(1,
               CASE WHEN o_orderkey % 106 = 0 THEN 3 ELSE 1 + o_orderkey % 3 END)) AS attempt) r
        WHERE o_orderkey % 53 = 0""",
}

# Fixed parameters of the incremental, upsert and analysis queries (as in plans.catalog).
FIRST_LOAD_END = "1999-12-31"
WEEKLY_AS_OF = "2000-01-05"
UPSERT_AFTER = "1999-06-30"
LOOKBACK_DAYS = 7
REPLENISH_AS_OF = "2001-08-01"
DEMAND_WINDOW_DAYS, LEAD_TIME_DAYS = 28, 14
ABC_A, ABC_B = 80, 95


def _with(select: str, extra: dict[str, str] | None = None) -> str:
    """``select`` with the CTEs it needs, directly or through others."""
    known = {**STAGING, **MODELS, **(extra or {})}
    need: list[str] = []

    def add(sql: str) -> None:
        for name, body in known.items():
            if name not in need and re.search(rf"\b{name}\b", sql) and body != sql:
                add(body)
                need.append(name)

    add(select)
    ctes = ",\n".join(f"{name} AS ({known[name]}\n)" for name in need)
    return f"{f'WITH {ctes}' if ctes else ''}\nSELECT * FROM ({select}\n) AS q"


def _merge(target: str, source: str, keys: list[str], null_safe: bool) -> str:
    op = "IS NOT DISTINCT FROM" if null_safe else "="
    cond = " AND ".join(f"s.{k} {op} t.{k}" for k in keys)
    return (f"SELECT * FROM {target} t WHERE NOT EXISTS (SELECT 1 FROM {source} s WHERE {cond})\n"
            f"UNION ALL BY NAME SELECT * FROM {source}")


ORDER_FEES = ("order_shipping_cost", "order_discount_value", "order_commission_fee", "total_order_value")
ORDER_SELECT = f"""SELECT order_id, client_id, sale_channel_id, status_id, order_date, dispatch_date,
        estimated_delivery_date, {', '.join(D(c) for c in ORDER_FEES)}"""
CHANNEL_KEYS = ["sale_channel_name", "category_name", "order_date"]
UPSERT_CTES = {
    "first_orders": f"SELECT * FROM active_orders WHERE order_date <= DATE '{FIRST_LOAD_END}'",
    "older_orders": f"""
        {ORDER_SELECT} FROM (SELECT * REPLACE (IF(order_id % 7 = 0, total_order_value * 2, total_order_value) AS total_order_value,
                              IF(order_id % 5 = 0, order_date - 3, order_date) AS order_date) FROM first_orders)
        UNION ALL {ORDER_SELECT.replace('SELECT order_id', 'SELECT -order_id AS order_id')}
        FROM first_orders WHERE order_id % 11 = 0""",
    "newer_orders": f"{ORDER_SELECT} FROM active_orders WHERE order_date > DATE '{UPSERT_AFTER}'",
    "stored_days": f"""
        SELECT * REPLACE (total_revenue + 1 AS total_revenue) FROM channel_days WHERE order_date <= DATE '{FIRST_LOAD_END}'
        UNION ALL SELECT * REPLACE ('GONE ' || sale_channel_name AS sale_channel_name, total_revenue + 1 AS total_revenue)
        FROM channel_days WHERE order_date <= DATE '{FIRST_LOAD_END}'""",
    "newer_days": f"SELECT * FROM channel_days WHERE order_date > DATE '{UPSERT_AFTER}'",
    "nine": """
        SELECT l_partkey AS product_id, CAST(l_quantity AS BIGINT) AS units,
               CAST(l_orderkey % 89 AS DECIMAL(28,9)) + CAST('0.123456789' AS DECIMAL(28,9)) AS price,
               CASE WHEN p_partkey IS NOT NULL
                    THEN CAST(p_partkey % 7 AS DECIMAL(28,9)) + CAST('0.111111111' AS DECIMAL(28,9)) END AS cost
        FROM lineitem LEFT JOIN part ON p_partkey = l_partkey""",
    "thrice": """
        SELECT *, 0 AS epoch FROM s_orders
        UNION ALL SELECT * REPLACE (total_order_value + 5 AS total_order_value), 1 FROM s_orders WHERE order_id % 7 = 0
        UNION ALL SELECT * REPLACE (dt + 7 AS dt, 3 AS status_id), 0 FROM s_orders WHERE order_id % 11 = 0""",
}
HISTORY_CTES = {
    "listed": f"""
        SELECT p_partkey AS product_id, day, CASE WHEN p_partkey % 17 <> 0
               THEN {C('p_retailprice * (60 + ((p_partkey + k) // 2) % 5)')} END AS listed_cost
        FROM part, (SELECT k, first + CAST(90 * k AS INTEGER) AS day
                    FROM (SELECT min(CAST(o_orderdate AS DATE)) AS first, max(CAST(o_orderdate AS DATE)) AS last FROM orders),
                         range(0, 100000) t(k) WHERE first + CAST(90 * k AS INTEGER) <= last)
        WHERE p_partkey > 0""",
    "day_costs": """
        SELECT product_id, day, COALESCE((SELECT sum(component_quantity * part_of.listed_cost) FROM s_kit_components k
                                          JOIN listed part_of ON part_of.product_id = k.component_id
                                          WHERE k.composite_product_id = listed.product_id AND part_of.day = listed.day),
                                         listed_cost) AS cost
        FROM listed""",
    "costed_then": """
        SELECT line.* EXCLUDE (order_product_cost, gross_profit), quantity * cost AS order_product_cost,
               quantity * (order_unit_price - cost) AS gross_profit
        FROM costed line ASOF LEFT JOIN day_costs then_cost
          ON line.product_id = then_cost.product_id AND line.order_date >= then_cost.day""",
    "day_units": f"""
        SELECT component_product_id, product_name, order_date AS day, sum(total_quantity_sold) AS q FROM demand
        WHERE order_date BETWEEN DATE '2001-08-01' - 179 AND DATE '2001-08-01' GROUP BY ALL HAVING sum(total_quantity_sold) > 0""",
    "spine": """
        SELECT c.component_product_id, c.product_name, c.first_day, d.day, CAST(COALESCE(u.q, 0) AS BIGINT) AS units
        FROM (SELECT component_product_id, product_name, min(day) AS first_day FROM day_units GROUP BY ALL) c
        JOIN (SELECT DATE '2001-08-01' - CAST(i AS INTEGER) AS day FROM range(0, 180) t(i)) d ON d.day >= c.first_day
        LEFT JOIN day_units u ON u.component_product_id = c.component_product_id AND u.day = d.day""",
}
LANDED_DATE = "CASE WHEN o_orderkey % 29 <> 0 THEN CAST(o_orderdate AS DATE) END"


def forecast_sql() -> str:
    """The recursion over the dense spine, day by day."""
    spine = _with("SELECT * FROM spine", HISTORY_CTES)
    head, _, _ = spine.rpartition("\nSELECT * FROM (")
    return head.replace("WITH ", "WITH RECURSIVE ", 1) + """,
walk AS (
  SELECT component_product_id, day, CAST(1.0 AS DOUBLE) AS p, CAST(units AS DOUBLE) AS z, CAST(0.0 AS DOUBLE) AS mad
  FROM spine WHERE day = first_day
  UNION ALL
  SELECT s.component_product_id, s.day,
         CASE WHEN s.units > 0 THEN w.p + CAST(0.05 AS DOUBLE) * (CAST(1.0 AS DOUBLE) - w.p)
              ELSE w.p + CAST(0.05 AS DOUBLE) * (CAST(0.0 AS DOUBLE) - w.p) END,
         CASE WHEN s.units > 0 THEN w.z + CAST(0.1 AS DOUBLE) * (CAST(s.units AS DOUBLE) - w.z) ELSE w.z END,
         w.mad + CAST(0.1 AS DOUBLE) * (abs(CAST(s.units AS DOUBLE) - w.p * w.z) - w.mad)
  FROM walk w JOIN spine s ON s.component_product_id = w.component_product_id AND s.day = w.day + 1),
lengths AS (SELECT component_product_id, product_name, first_day, count(*) AS n, count(*) FILTER (WHERE units > 0) AS sold
            FROM spine GROUP BY ALL)
SELECT component_product_id, product_name, CAST(first_day AS VARCHAR) AS first_day, CAST(n AS BIGINT) AS spine_days,
       CAST(sold AS BIGINT) AS demand_days, p AS sale_chance, z AS sale_size, p * z AS daily_forecast, mad AS mean_error,
       CAST(ceil(p * z * CAST(14 AS DOUBLE)) AS BIGINT) AS lead_time_units,
       CAST(ceil(CAST(1.65 AS DOUBLE) * CAST(1.25 AS DOUBLE) * mad * sqrt(CAST(14 AS DOUBLE))) AS BIGINT) AS safety_units,
       CAST(ceil(p * z * CAST(14 AS DOUBLE))
            + ceil(CAST(1.65 AS DOUBLE) * CAST(1.25 AS DOUBLE) * mad * sqrt(CAST(14 AS DOUBLE))) AS BIGINT) AS reorder_point
FROM walk JOIN lengths USING (component_product_id) WHERE day = DATE '2001-08-01'"""


def history_queries() -> dict[str, str]:
    w = lambda sql: _with(sql, HISTORY_CTES)
    return {
        "product_cost_history": w("""
            SELECT product_id, CAST(cost AS DOUBLE) AS cost_price,
                   CASE WHEN day = (SELECT min(day) FROM listed) THEN '1900-01-01' ELSE CAST(day AS VARCHAR) END AS valid_from,
                   CAST(lead(day) OVER (PARTITION BY product_id ORDER BY day) AS VARCHAR) AS valid_to
            FROM (SELECT *, lag(cost) OVER (PARTITION BY product_id ORDER BY day) AS earlier,
                         row_number() OVER (PARTITION BY product_id ORDER BY day) AS n FROM day_costs)
            WHERE n = 1 OR cost IS DISTINCT FROM earlier"""),
        "item_details_at_cost": w(SELECTS["fact_item_details"].replace("FROM costed", "FROM costed_then")),
        "product_performance_at_cost": w(MODELS["product_days"].replace("FROM costed GROUP", "FROM costed_then GROUP").replace(
            "catalogue.product_id = costed.product_id", "catalogue.product_id = costed_then.product_id")),
        "demand_spine": w("SELECT component_product_id, product_name, CAST(first_day AS VARCHAR) AS first_day, "
                          "CAST(day AS VARCHAR) AS day, units FROM spine"),
        "demand_forecast": forecast_sql(),
    }


def extra_queries() -> dict[str, str]:
    w = lambda sql: _with(sql, UPSERT_CTES)
    return {
        "incremental_window": w(f"""{ORDER_SELECT} FROM active_orders
            WHERE order_date > LEAST((SELECT max(order_date) FROM first_orders),
                                     DATE '{WEEKLY_AS_OF}' - {LOOKBACK_DAYS + 1})"""),
        "upsert_null_safe": w(_merge("stored_days", "newer_days", CHANNEL_KEYS, True)),
        "upsert_plain": w(_merge("stored_days", "newer_days", CHANNEL_KEYS, False)),
        "upsert_partitioned": w(_merge("older_orders", "newer_orders", ["order_id"], True)),
        "key_index_partitions": w("""SELECT DISTINCT order_date FROM older_orders
            WHERE order_id IN (SELECT order_id FROM newer_orders)"""),
        "upsert_indexed": w(_merge("older_orders", "newer_orders", ["order_id"], True)),
        "upsert_columns": w(_merge("(SELECT * REPLACE (CAST(NULL AS BIGINT) AS client_id) FROM older_orders)",
                                   "newer_orders", ["order_id"], True)),
        "upsert_cancelled": w(f"""SELECT * FROM newer_orders
            UNION ALL {ORDER_SELECT} FROM s_orders kept WHERE order_date <= DATE '{FIRST_LOAD_END}'
              AND NOT (order_date > DATE '{UPSERT_AFTER}'
                       AND status_id IN (SELECT status_id FROM s_status))"""),
        "upsert_duplicate_keys": w("""SELECT sale_channel_name, category_name, order_date FROM channel_days
            GROUP BY ALL HAVING count(*) > 1"""),
        "latest_landing": w(f"""{ORDER_SELECT} FROM (
                SELECT * FROM thrice QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY dt DESC, epoch DESC) = 1)
            WHERE status_id IN (SELECT status_id FROM s_status WHERE status_name <> 'CANCELADO')"""),
        "money_scale": w("""SELECT product_id, CAST(sum(cost * units) AS VARCHAR) AS order_product_cost,
                CAST(sum(price * units) AS VARCHAR) AS gross_revenue,
                CAST(sum((price - cost) * units) AS VARCHAR) AS gross_profit FROM nine GROUP BY product_id"""),
        "landed_orders": f"""SELECT o_orderkey AS order_id, CAST({LANDED_DATE} AS VARCHAR) AS order_date,
                CASE WHEN o_orderkey % 31 <> 0 THEN {D('CAST(o_totalprice AS DECIMAL(18,2))', 'x')[:-5]} END
                  AS total_order_value,
                CAST(CASE WHEN o_orderkey % 97 = 0 THEN 99 ELSE {STATUS_ID} END AS BIGINT) AS status_id,
                CASE WHEN o_orderkey % 37 <> 0 THEN {CHANNEL_ID} END AS sale_channel_id FROM orders""",
        "landed_items": f"""SELECT l_orderkey AS order_id, l_partkey AS product_id,
                CASE WHEN l_partkey % 47 <> 0 THEN CAST(l_quantity AS BIGINT) + IF(l_orderkey % 43 = 0, 1, 0) END AS quantity,
                {D(C('l_extendedprice * 100 / l_quantity'), 'order_unit_price')}
            FROM lineitem SEMI JOIN orders ON o_orderkey = l_orderkey""",
        "landed_audit": f"""SELECT CAST({DT} AS VARCHAR) AS dt,
                CAST(count(*) + IF(day(any_value({DT})) % 3 = 0, 1, 0) AS BIGINT) AS declared_rows,
                CAST(count(*) AS BIGINT) AS landed_rows,
                CAST(count(*) FILTER (WHERE o_orderkey % 41 = 0) AS BIGINT) AS quarantined_rows,
                day(any_value({DT})) % 3 <> 0 AS count_matches FROM orders GROUP BY {DT}""",
        "landed_undeclared": f"""SELECT o_orderkey AS order_id,
                CASE WHEN o_orderkey % 19 = 0 THEN 'nota ' || CAST(o_orderkey AS VARCHAR) END AS note,
                CASE WHEN o_orderkey % 19 = 0 THEN o_orderkey END AS note_code,
                CAST(CASE WHEN o_orderkey % 97 = 0 THEN 99 ELSE {STATUS_ID} END AS BIGINT) AS status_id FROM orders""",
        "weekly_distinct_orders": _with("""
            SELECT CASE GROUPING(sale_channel_name, category_name) WHEN 0 THEN 'category' WHEN 1 THEN 'channel' ELSE 'week' END
                     AS level, sale_channel_name, category_name, CAST(week AS VARCHAR) AS week,
                   CAST(count(DISTINCT order_id) AS BIGINT) AS total_orders
            FROM (SELECT order_id, sale_channel_name, category_name, CAST(date_trunc('week', order_date) AS DATE) AS week
                  FROM (FROM costed SELECT order_id, NULLIF(product_id, 0) AS product_id)
                  JOIN (FROM settled SELECT order_id, order_date, sale_channel_name) USING (order_id)
                  LEFT JOIN (FROM catalogue SELECT product_id, category_id) USING (product_id)
                  LEFT JOIN (FROM s_categories SELECT category_id, category_name) USING (category_id))
            GROUP BY GROUPING SETS ((sale_channel_name, category_name, week), (sale_channel_name, week), (week))"""),
        "audit_batch_summary": _with("""SELECT run_id, entity, batch,
            CAST(count(*) FILTER (WHERE ok) AS BIGINT) AS successful_count,
            CAST(count(*) FILTER (WHERE NOT ok) AS BIGINT) AS failed_count
            FROM attempts WHERE attempt = 0 GROUP BY run_id, entity, batch"""),
        "audit_failed_ids": _with("""SELECT run_id, entity, batch, object_id FROM attempts
            WHERE attempt = 0 AND NOT ok"""),
        "audit_permanent_failures": _with("""SELECT run_id, entity, object_id FROM attempts
            GROUP BY ALL HAVING NOT bool_or(ok)"""),
        "audit_retry_reconcile": _with("""
            SELECT run_id, entity, CAST(count(DISTINCT batch) AS BIGINT) AS batches_processed,
                   CAST(count(*) FILTER (WHERE at_once) AS BIGINT) AS first_pass_ok,
                   CAST(count(*) FILTER (WHERE NOT at_once) AS BIGINT) AS first_pass_failed,
                   CAST(count(*) FILTER (WHERE NOT at_once) AS BIGINT) AS total_retried,
                   CAST(count(*) FILTER (WHERE NOT at_once AND ever) AS BIGINT) AS successful_retries,
                   CAST(count(*) FILTER (WHERE NOT ever) AS BIGINT) AS permanent_failures,
                   CAST(count(*) FILTER (WHERE ever) AS BIGINT) AS successful_extractions,
                   CAST(count(*) FILTER (WHERE NOT ever) AS BIGINT) AS failed_extractions
            FROM (SELECT run_id, entity, batch, object_id, bool_or(ok AND attempt = 0) AS at_once, bool_or(ok) AS ever
                  FROM attempts GROUP BY ALL) GROUP BY run_id, entity"""),
        "abc_curve": _with(f"""SELECT product_id, CAST(rev AS DOUBLE) AS gross_revenue,
                CAST(cum AS DOUBLE) AS cumulative_revenue,
                CAST(cum AS DOUBLE) / CAST(NULLIF(tot, 0) AS DOUBLE) AS cumulative_share,
                CASE WHEN cum * 100 <= tot * {ABC_A} THEN 'A' WHEN cum * 100 <= tot * {ABC_B} THEN 'B' ELSE 'C' END
                  AS abc_class
            FROM (SELECT product_id, rev,
                         COALESCE(SUM(rev) OVER (ORDER BY rev DESC NULLS LAST, product_id
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS cum,
                         SUM(rev) OVER () AS tot
                  FROM (SELECT product_id, SUM(gross_revenue) AS rev FROM costed
                        WHERE product_id <> 0 GROUP BY product_id) r) c"""),
        "replenishment": _with(f"""SELECT component_product_id, product_name,
                CAST(SUM(total_quantity_sold) AS BIGINT) AS window_quantity,
                CAST(SUM(total_quantity_sold) AS DOUBLE) / {float(DEMAND_WINDOW_DAYS)} AS avg_daily_demand,
                CAST((SUM(total_quantity_sold) * {LEAD_TIME_DAYS} + {DEMAND_WINDOW_DAYS - 1}) // {DEMAND_WINDOW_DAYS}
                     AS BIGINT) AS reorder_quantity
            FROM demand
            WHERE order_date BETWEEN DATE '{REPLENISH_AS_OF}' - {DEMAND_WINDOW_DAYS - 1} AND DATE '{REPLENISH_AS_OF}'
            GROUP BY component_product_id, product_name"""),
    }


PRODUCT_SELECT = f"""SELECT product_id, product_name, product_internal_code, brand, {D('price')}, is_active, is_kit,
        category_id, supplier_name, product_supplier_code, {D('cost_price')}, {D('buy_price')}"""
SELECTS = {
    "stg_categories": "SELECT category_id, category_name, parent_category_id FROM s_categories",
    "stg_channels": "SELECT channel_id, channel_name FROM s_channels",
    "stg_statuses": "SELECT status_id, status_name FROM s_status",
    "stg_orders": f"""SELECT order_id, order_number, order_date, dispatch_date, estimated_delivery_date,
        {D('total_products_value')}, {D('total_order_value')}, client_id, status_id, sale_channel_id,
        {D('order_discount_value')}, {D('order_commission_fee')}, {D('order_shipping_cost')}, {D('base_value')}
        FROM s_orders""",
    "stg_order_items": f"SELECT order_id, product_id, quantity, {D('order_unit_price')} FROM s_items",
    "stg_products": f"{PRODUCT_SELECT} FROM s_products",
    "stg_kit_components": "SELECT composite_product_id, component_id, component_quantity FROM s_kit_components",
    "dim_products_kit_cost": f"{PRODUCT_SELECT} FROM catalogue",
    "silver_kit_bridge": "SELECT composite_product_id, component_id, component_quantity FROM kit_parts",
    "dim_kit_components": """SELECT composite_product_id AS kit_id,
        (SELECT product_name FROM s_products WHERE product_id = composite_product_id) AS kit_name, component_id,
        (SELECT product_name FROM s_products WHERE product_id = component_id) AS component_name, component_quantity
        FROM kit_parts""",
    "silver_orders": f"{ORDER_SELECT} FROM active_orders",
    "silver_order_items_dedup": f"""SELECT order_id, product_id, quantity, {D('order_unit_price')},
        product_id_for_merge, order_date, 1 AS rn FROM best_lines""",
    "fact_item_details": f"""SELECT order_id, order_date, product_id, product_name, product_id_for_merge, quantity,
        {D('order_unit_price')}, {D('order_product_cost')}, {D('gross_revenue')}, {D('gross_profit')} FROM costed""",
    "fact_orders": f"""SELECT order_id, order_date, client_id, sale_channel_name, {', '.join(D(c) for c in ORDER_FEES)},
        {D('total_order_product_cost')}, {D('total_order_cost')}, {D('total_order_profit')},
        total_order_margin FROM settled""",
    "fact_channel_performance": "SELECT * FROM channel_days",
    "fact_product_performance": "SELECT * FROM product_days",
    "fact_component_demand": "SELECT * FROM demand",
}
SELECTS |= {"dim_categories": SELECTS["stg_categories"], "dim_channels": SELECTS["stg_channels"],
            "dim_statuses": SELECTS["stg_statuses"]}

ORDER_DATES = ["order_date", "dispatch_date", "estimated_delivery_date"]
DATE_COLUMNS = {  # DATE columns of each query's output, returned as ISO text
    **{q: ORDER_DATES for q in ("stg_orders", "silver_orders", "incremental_window", "upsert_partitioned",
                                "upsert_indexed", "upsert_columns", "upsert_cancelled", "latest_landing")},
    **{q: ["order_date"] for q in ("silver_order_items_dedup", "fact_item_details", "fact_orders",
                                   "fact_channel_performance", "fact_product_performance",
                                   "fact_component_demand", "item_details_at_cost", "product_performance_at_cost",
                                   "upsert_null_safe", "upsert_plain",
                                   "upsert_duplicate_keys",
                                   "key_index_partitions")},
}


def _dates_as_text(name: str, sql: str) -> str:
    cols = DATE_COLUMNS.get(name)
    if not cols:
        return sql
    repl = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in cols)
    head, sep, tail = sql.rpartition("\nSELECT * FROM (")
    return f"{head}{sep.replace('SELECT *', f'SELECT * REPLACE ({repl})')}{tail}"


def oracle_sql() -> dict[str, str]:
    out = {name: _with(sel) for name, sel in SELECTS.items()} | extra_queries() | history_queries()
    return {name: _dates_as_text(name, sql) for name, sql in out.items()}
