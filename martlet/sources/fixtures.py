"""Driver tables -> the raw shapes the mart reads.

The driver supplies TPC-H-like parquet tables; the mart reads what the ERP
landing produces.  This module maps one onto the other, row for row, as plain
DataFrame projections (no grouping of unbounded sets):

* ``raw_sales_orders``  one row per order: the order record without its items, plus ``dt``
* ``raw_sales_items``   one row per order line: the header ids of its order record,
                        the ``item`` struct and ``dt`` (the shape ``bronze.split_sales``
                        gives for landed JSON, where the lines are exploded in place)
* ``raw_products``      one row per product with the nested supplier and kit structure
* ``raw_categories`` / ``raw_channels`` / ``raw_statuses``  lookup lists

Lookup lists are derived from the tables through a fixed mapping; their joins
are left to Spark's size estimates.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values of the mapping (FIXTURES.md section 3).
# ---------------------------------------------------------------------------
STATUS_BY_ORDERSTATUS = {"F": (1, "Atendido"), "O": (2, "Em aberto"), "P": (3, "Cancelado")}
UNKNOWN_STATUS_ID = 99                 # orders with o_orderkey % 97 = 0
UNKNOWN_STATUS_EVERY = 97
NULL_FREIGHT_EVERY = 13                # custoFrete is NULL when o_orderkey % 13 = 0
UNKNOWN_CHANNEL_PRIORITY = "5-LOW"     # left out of the channel list
CATEGORY_ID_BY_TYPE = {"ECONOMY": 1, "LARGE": 2, "MEDIUM": 3, "PROMO": 4, "SMALL": 5, "STANDARD": 6}
CATEGORY_ROWS = {  # p_type -> (id, name, parent); PROMO is left out
    "ECONOMY": (1, "Economy", 0),
    "LARGE": (2, "Large", 0),
    "MEDIUM": (3, "Medium", 1),
    "SMALL": (5, "Small", 1),
    "STANDARD": (6, "Standard", 2),
}
ACTIVE_MAX_SIZE = 40                   # situacao 'A' when p_size <= 40, else 'I'
KIT_EVERY = 10                         # formato 'E' when p_partkey % 10 = 0, else 'S'
NULL_COST_EVERY = 17                   # precoCusto NULL when p_partkey % 17 = 0
NULL_COMPONENT_EVERY = 50              # extra component without id when p_partkey % 50 = 0
COST_FACTOR, BUY_FACTOR = 60, 55       # cents factors on p_retailprice
DISCOUNT_FACTOR, COMMISSION_FACTOR, FREIGHT_FACTOR = 2, 10, 5  # cents factors on o_totalprice
DISPATCH_DAYS, DELIVERY_DAYS = 2, 10
DT_ANCHOR = "1995-01-01"               # dt = end of the order's 7-day block from this day
DT_BLOCK_DAYS = 7

MONEY = "decimal(18,2)"


def cents(x: Column) -> Column:
    """Floored integer cents as DECIMAL(18,2) (exact in both engines)."""
    return (F.floor(x).cast("bigint") * F.lit(Decimal("0.01"))).cast(MONEY)


def _case(col: Column, mapping: dict, default=None) -> Column:
    expr = None
    for k, v in mapping.items():
        expr = F.when(col == F.lit(k), F.lit(v)) if expr is None else expr.when(col == F.lit(k), F.lit(v))
    return expr.otherwise(F.lit(default)) if default is not None else expr


# Columns of the driver tables this mapping reads (declared: no inference job,
# and the scan reads only these columns).
DRIVER_SCHEMAS = {
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_quantity DOUBLE, l_extendedprice DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "supplier": "s_suppkey BIGINT, s_name STRING",
}


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(DRIVER_SCHEMAS[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def priority_id(priority: Column) -> Column:
    """Channel id: the number before the first ``-`` of an order priority."""
    return F.substring_index(priority, "-", 1).try_cast("bigint")


def priority_name(priority: Column) -> Column:
    """Channel name: all that follows the first ``-``."""
    return F.substr(priority, F.instr(priority, "-") + F.lit(1))


def landing_dt(order_ts: Column) -> Column:
    d = order_ts.cast("date")
    offset = F.lit(DT_BLOCK_DAYS - 1) - F.datediff(d, F.lit(DT_ANCHOR).cast("date")) % F.lit(DT_BLOCK_DAYS)
    return F.date_add(d, offset)


def _order_header(o: DataFrame) -> DataFrame:
    """Per-order record fields as columns (shared by orders and items)."""
    status_id = (F.when(o.o_orderkey % UNKNOWN_STATUS_EVERY == 0, F.lit(UNKNOWN_STATUS_ID).cast("bigint"))
                 .otherwise(_case(o.o_orderstatus, {k: v[0] for k, v in STATUS_BY_ORDERSTATUS.items()}).cast("bigint")))
    return o.select(
        o.o_orderkey.alias("id"),
        o.o_orderdate.cast("date").cast("string").alias("data_txt"),
        F.struct(status_id.alias("id")).alias("situacao"),
        landing_dt(o.o_orderdate).alias("dt"),
        o.o_orderdate, o.o_custkey, o.o_totalprice, o.o_orderpriority,
    )


def _orders(spark: SparkSession, sf_dir: str, until: str | None = None) -> DataFrame:
    """Orders, optionally only those dated up to ``until`` (an earlier extraction)."""
    o = _read(spark, sf_dir, "orders")
    return o if until is None else o.where(F.col("o_orderdate") < F.date_add(F.lit(until).cast("date"), 1))


def raw_sales_orders(spark: SparkSession, sf_dir: str, until: str | None = None) -> DataFrame:
    o = _order_header(_orders(spark, sf_dir, until))
    total = o.o_totalprice.cast(MONEY)
    freight = F.when(o.id % NULL_FREIGHT_EVERY == 0, F.lit(None).cast(MONEY)).otherwise(
        cents(o.o_totalprice * FREIGHT_FACTOR))
    # values first, the record of plain columns after: a later field access is then that column
    v = o.select(
        "id", "data_txt", "situacao", "dt", total.alias("total"), freight.alias("freight"),
        F.date_add(o.o_orderdate.cast("date"), DISPATCH_DAYS).cast("string").alias("out"),
        F.date_add(o.o_orderdate.cast("date"), DELIVERY_DAYS).cast("string").alias("due"),
        o.o_custkey.alias("customer"), priority_id(o.o_orderpriority).alias("channel"),
        cents(o.o_totalprice * DISCOUNT_FACTOR).alias("discount"), cents(o.o_totalprice * COMMISSION_FACTOR).alias("commission"))
    data = F.struct(
        v.id.alias("id"),
        v.id.alias("numero"),
        v.data_txt.alias("data"),
        v.out.alias("dataSaida"),
        v.due.alias("dataPrevista"),
        v.total.alias("totalProdutos"),
        v.total.alias("total"),
        F.struct(v.customer.alias("id")).alias("contato"),
        v.situacao,
        F.struct(v.channel.alias("id")).alias("loja"),
        F.struct(v.discount.alias("valor")).alias("desconto"),
        F.struct(v.commission.alias("taxaComissao"), v.freight.alias("custoFrete"), v.total.alias("valorBase")).alias("taxas"),
    )
    return v.select(data.alias("data"), v.dt)


def _item_values(li: DataFrame) -> DataFrame:
    return li.select("l_orderkey", "l_partkey", li.l_quantity.cast("bigint").alias("units"),
                     cents(li.l_extendedprice * 100 / li.l_quantity).alias("price"))


def _item_struct(v: DataFrame) -> Column:
    return F.struct(F.struct(v.l_partkey.alias("id")).alias("produto"), v.units.alias("quantidade"), v.price.alias("valor"))


def raw_sales_items(spark: SparkSession, sf_dir: str, with_header: bool = True,
                    until: str | None = None) -> DataFrame:
    """One row per order line.

    ``with_header`` adds the ids of the order record the line belongs to (date
    text, status, ``dt``), as the bronze split of landed JSON gives them; that
    needs one equi-join of lines with orders on the order key.  Without it only
    the line's own fields are produced, straight from ``lineitem``.
    """
    li = _item_values(_read(spark, sf_dir, "lineitem"))
    if not with_header:
        return li.select(F.struct(li.l_orderkey.alias("id")).alias("data"), _item_struct(li).alias("item"))
    o = _order_header(_orders(spark, sf_dir, until)).select("id", "data_txt", "situacao", "dt")
    j = li.join(o, li.l_orderkey == o.id, "inner")
    return j.select(
        F.struct(j.id.alias("id"), j.data_txt.alias("data"), j.situacao.alias("situacao")).alias("data"),
        j.dt,
        _item_struct(j).alias("item"),
    )


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _read(spark, sf_dir, "part").where(F.col("p_partkey") > 0)
    # every supplier is used: products are dealt over the supplier keys (one number is read first)
    s = _read(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    keys = (s.agg(F.max("s_suppkey")).first()[0] or 0) + 1
    j = p.join(s, (p.p_partkey % keys) == s.s_suppkey, "left")
    pk = j.p_partkey
    is_kit = pk % KIT_EVERY == 0

    def comp(cid: Column, qty: int) -> Column:
        return F.struct(F.struct(cid.alias("id")).alias("produto"), F.lit(qty).cast("bigint").alias("quantidade"))

    base_components = F.array(comp(pk + 1, 2), comp(pk + 2, 1))
    components = F.when(pk % NULL_COMPONENT_EVERY == 0,
                        F.concat(base_components, F.array(comp(F.lit(None).cast("bigint"), 1)))
                        ).otherwise(base_components)
    cost = F.when(pk % NULL_COST_EVERY == 0, F.lit(None).cast(MONEY)).otherwise(cents(j.p_retailprice * COST_FACTOR))
    v = j.select(
        pk.alias("id"), "p_name", "p_brand", F.concat(F.lit("P-"), pk.cast("string")).alias("code"),
        j.p_retailprice.cast(MONEY).alias("price"),
        F.when(j.p_size <= ACTIVE_MAX_SIZE, F.lit("A")).otherwise(F.lit("I")).alias("situation"),
        F.when(is_kit, F.lit("E")).otherwise(F.lit("S")).alias("format"),
        _case(j.p_type, CATEGORY_ID_BY_TYPE).cast("bigint").alias("category"),
        j.s_suppkey.cast("string").alias("supplier"), "s_name", cost.alias("cost"),
        cents(j.p_retailprice * BUY_FACTOR).alias("buy"), F.when(is_kit, components).alias("components"))
    data = F.struct(
        v.id.alias("id"),
        v.p_name.alias("nome"),
        v.code.alias("codigo"),
        v.p_brand.alias("marca"),
        v.price.alias("preco"),
        v.situation.alias("situacao"),
        v.format.alias("formato"),
        F.struct(v.category.alias("id")).alias("categoria"),
        F.struct(v.supplier.alias("codigo"),
                 v.cost.alias("precoCusto"),
                 v.buy.alias("precoCompra"),
                 F.struct(v.s_name.alias("nome")).alias("contato")).alias("fornecedor"),
        F.struct(v.components.alias("componentes")).alias("estrutura"),
    )
    return v.select(data.alias("data"))


def raw_statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order statuses mapped onto the fixed status list."""
    st = F.col("o_orderstatus")
    return (_read(spark, sf_dir, "orders").select(
        _case(st, {k: v[0] for k, v in STATUS_BY_ORDERSTATUS.items()}).cast("bigint").alias("id"),
        _case(st, {k: v[1] for k, v in STATUS_BY_ORDERSTATUS.items()}).alias("nome"))
        .where(F.col("id").isNotNull()).distinct())


def raw_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per number that an order priority starts with."""
    pr = F.col("o_orderpriority")
    return (_read(spark, sf_dir, "orders").where(pr != F.lit(UNKNOWN_CHANNEL_PRIORITY))
            .select(priority_id(pr).alias("id"), priority_name(pr).alias("descricao"))
            .where(F.col("id").isNotNull())
            .groupBy("id").agg(F.max("descricao").alias("descricao")))


def raw_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The product types mapped onto the fixed category list."""
    t = F.col("p_type")
    return (_read(spark, sf_dir, "part").select(
        _case(t, {k: v[0] for k, v in CATEGORY_ROWS.items()}).cast("bigint").alias("id"),
        _case(t, {k: v[1] for k, v in CATEGORY_ROWS.items()}).alias("descricao"),
        F.struct(_case(t, {k: v[2] for k, v in CATEGORY_ROWS.items()}).cast("bigint").alias("id")).alias("categoriaPai"))
        .where(F.col("id").isNotNull()).distinct())


class RawSources:
    """The landed (bronze) inputs of one mart build.

    Built from DataFrames or from zero-argument callables; a callable is
    invoked on first use, so a query only plans the inputs it reads.
    """

    NAMES = ("sales_orders", "sales_items", "products", "categories", "channels", "statuses")

    def __init__(self, **inputs):
        unknown = set(inputs) - set(self.NAMES)
        if unknown:
            raise TypeError(f"unknown raw inputs: {sorted(unknown)}")
        self._inputs = inputs
        self._built: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in self.NAMES:
            raise AttributeError(name)
        if name not in self._built:
            v = self._inputs.get(name)
            if v is None:
                raise AttributeError(f"raw input {name!r} was not given")
            self._built[name] = v() if callable(v) else v
        return self._built[name]


def from_driver_tables(spark: SparkSession, sf_dir: str, until: str | None = None) -> RawSources:
    """All raw inputs; ``until`` limits the landed orders to those dated up to it."""
    return RawSources(
        sales_orders=lambda: raw_sales_orders(spark, sf_dir, until),
        sales_items=lambda: raw_sales_items(spark, sf_dir, until=until),
        products=lambda: raw_products(spark, sf_dir),
        categories=lambda: raw_categories(spark, sf_dir),
        channels=lambda: raw_channels(spark, sf_dir),
        statuses=lambda: raw_statuses(spark, sf_dir),
    )


# ---------------------------------------------------------------------------
# Product landings over time derived from the products and the orders' dates (fixed values of the rule).
# ---------------------------------------------------------------------------
LANDING_EVERY_DAYS = 90    # a product list is landed on the first order's day and every 90 days after
COST_STEPS = 5             # the cost factor of landing k is 60 + ((p_partkey + k) div 2) % 5


def product_landings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """product_id, cost_price, observed: a row per product and landed product list."""
    day = F.col("o_orderdate").cast("date")
    first, last = _read(spark, sf_dir, "orders").agg(F.min(day), F.max(day)).first()
    p = _read(spark, sf_dir, "part").where(F.col("p_partkey") > 0)
    if first is None:
        return p.limit(0).select(F.col("p_partkey").alias("product_id"), F.lit(None).cast(MONEY).alias("cost_price"),
                                 F.lit(None).cast("date").alias("observed"))
    days = F.sequence(F.lit(first), F.lit(last), F.expr(f"interval {LANDING_EVERY_DAYS} days"))
    landed = p.select("p_partkey", "p_retailprice", F.posexplode(days).alias("k", "observed"))
    factor = COST_FACTOR + F.floor((F.col("p_partkey") + F.col("k")) / 2).cast("bigint") % COST_STEPS
    cost = F.when(F.col("p_partkey") % NULL_COST_EVERY == 0, F.lit(None).cast(MONEY)).otherwise(
        cents(F.col("p_retailprice") * factor))
    return landed.select(F.col("p_partkey").alias("product_id"), cost.alias("cost_price"), "observed")


# ---------------------------------------------------------------------------
# Extraction bookkeeping derived from the orders (fixed values of the rule).
# ---------------------------------------------------------------------------
PAGE_SIZE = 100            # ids per listing page = batch
FIRST_PASS_FAIL_EVERY = 53 # first fetch fails when o_orderkey % 53 = 0
PERMANENT_FAIL_EVERY = 106 # ... and every retry fails when o_orderkey % 106 = 0
RETRY_SPREAD = 3           # otherwise retry 1 + o_orderkey % 3 succeeds


def extraction_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per fetch attempt of each order id, run = the landing window end.

    Retries are generated per failed id with ``explode(sequence(...))`` (at
    most 3 rows per id), a narrow per-row expansion.
    """
    o = _read(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    k = F.col("o_orderkey")
    failed = k % FIRST_PASS_FAIL_EVERY == 0
    permanent = k % PERMANENT_FAIL_EVERY == 0
    success_at = F.when(permanent, F.lit(None)).otherwise(F.lit(1) + k % RETRY_SPREAD)
    n_attempts = F.when(~failed, F.lit(0)).when(permanent, F.lit(3)).otherwise(success_at)
    base = o.select(
        landing_dt(F.col("o_orderdate")).cast("string").alias("run_id"),
        F.lit("sales").alias("entity"),
        F.floor(k / PAGE_SIZE).cast("int").alias("batch"),
        k.alias("object_id"),
        n_attempts.alias("_n"), success_at.alias("_ok_at"), failed.alias("_failed"))
    attempts = base.select(
        "run_id", "entity", "batch", "object_id", "_ok_at", "_failed",
        F.explode(F.sequence(F.lit(0), F.col("_n"))).alias("attempt"))
    ok = F.when(F.col("attempt") == 0, ~F.col("_failed")).otherwise(
        F.coalesce(F.col("attempt") == F.col("_ok_at"), F.lit(False)))
    return attempts.select("run_id", "entity", "batch", "object_id",
                           F.col("attempt").cast("int").alias("attempt"), ok.alias("ok"))


# ---------------------------------------------------------------------------
# Landed text derived from the tables (fixed values of the rule): what the files hold,
# line by line, with bad fields, empty and missing item lists, headers and broken lines.
# ---------------------------------------------------------------------------
BAD_TOTAL_EVERY = 31       # total is the text 'abc' when o_orderkey % 31 = 0
BAD_DATE_EVERY = 29        # data is '0000-00-00' when o_orderkey % 29 = 0
BAD_CHANNEL_EVERY = 37     # loja.id is 'x9' when o_orderkey % 37 = 0
BROKEN_LINE_EVERY = 41     # one broken line beside the order when o_orderkey % 41 = 0
HALF_UNIT_EVERY = 43       # quantidade is n.5 when l_orderkey % 43 = 0
BAD_QUANTITY_EVERY = 47    # quantidade is 'x' when l_partkey % 47 = 0
NOTE_EVERY = 19            # the order record has a field outside the schema, observacoes, when o_orderkey % 19 = 0
WRONG_HEADER_EVERY = 3     # the header declares one order more when its day of the month % 3 = 0


def landed_lines(spark: SparkSession, sf_dir: str, items: bool = True) -> DataFrame:
    """(value, dt): the landed lines of all orders.

    Orders come as records with an empty or a missing item list; each line comes as a
    further record of its order with a list of one item, so nothing is collected per order.
    ``items=False`` leaves those out.
    """
    o = _order_header(_read(spark, sf_dir, "orders"))
    k = o.id
    date = F.when(k % BAD_DATE_EVERY == 0, F.lit("0000-00-00")).otherwise(o.data_txt)
    total = F.when(k % BAD_TOTAL_EVERY == 0, F.lit("abc")).otherwise(o.o_totalprice.cast(MONEY).cast("string"))
    channel = F.when(k % BAD_CHANNEL_EVERY == 0, F.lit("x9")).otherwise(priority_id(o.o_orderpriority).cast("string"))
    item = "array<struct<produto:struct<id:bigint>,quantidade:string,valor:decimal(18,2)>>"
    none = F.when(k % 2 == 0, F.array().cast(item))
    head = [k.alias("id"), date.alias("data"), o.situacao.alias("situacao")]
    orders = o.select(o.dt, F.to_json(F.struct(F.struct(
        *head, total.alias("total"), F.struct(channel.alias("id")).alias("loja"), none.alias("itens"),
        F.when(k % NOTE_EVERY == 0, F.struct(F.concat(F.lit("nota "), k.cast("string")).alias("texto"), k.alias("codigo")))
        .alias("observacoes")).alias("data")))
        .alias("value"))
    broken = o.where(k % BROKEN_LINE_EVERY == 0).select(o.dt, F.concat(F.lit("{bad "), k.cast("string")).alias("value"))
    wrong = (F.dayofmonth("dt") % WRONG_HEADER_EVERY == 0).cast("bigint")
    headers = (o.groupBy("dt").agg(F.count(F.lit(1)).alias("n")).select("dt", F.to_json(F.struct(
        F.struct((F.col("n") + wrong).alias("total_orders")).alias("metadata"))).alias("value")))
    landed = headers.unionByName(orders).unionByName(broken)
    if not items:
        return landed.select("value", "dt")
    li = _read(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice")
    j = li.join(o, li.l_orderkey == o.id)
    units = F.concat(j.l_quantity.cast("bigint").cast("string"),
                     F.when(j.l_orderkey % HALF_UNIT_EVERY == 0, F.lit(".5")).otherwise(F.lit("")))
    units = F.when(j.l_partkey % BAD_QUANTITY_EVERY == 0, F.lit("x")).otherwise(units)
    one = F.array(F.struct(F.struct(j.l_partkey.alias("id")).alias("produto"), units.alias("quantidade"),
                           cents(j.l_extendedprice * 100 / j.l_quantity).alias("valor")))
    lines = j.select(j.dt, F.to_json(F.struct(F.struct(*head, one.alias("itens")).alias("data"))).alias("value"))
    return landed.unionByName(lines).select("value", "dt")
