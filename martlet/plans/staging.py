"""Staging models (M1-M7): flatten, rename, upper-case and safely type the raw records.

Each model is a pure, lazy function of landed rows.  The raw inputs have the
header rows already split off (``sources.bronze.data_rows``).  Fields are taken out of
the nested record first and typed after (``_fields``): a projection of plain field accesses
collapses with whatever built the record, so only the fields in use are read or made.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlet.functions.casts import safe_date, safe_id, safe_int64, safe_numeric
from martlet.functions.expressions import ACTIVE_FLAG, KIT_FORMAT


def _fields(raw: DataFrame, prefix: str = "", **paths: str) -> DataFrame:
    return raw.select(*[F.col(prefix + path).alias(name) for name, path in paths.items()],
                      *[F.col(c) for c in ("dt", "epoch") if c in raw.columns])


def stg_categories(raw_categories: DataFrame) -> DataFrame:
    """M1: category_id, category_name, parent_category_id."""
    return raw_categories.select(
        safe_id("id").alias("category_id"),
        F.upper("descricao").alias("category_name"),
        safe_id("categoriaPai.id").alias("parent_category_id"),
    )


def stg_order_items(raw_sales_items: DataFrame, with_order_header: bool = False) -> DataFrame:
    """M2: order_id, product_id, quantity, order_unit_price; one row per order line.

    The input has one row per exploded line (``bronze.split_sales``: orders whose
    item list is NULL or empty give no line).  ``with_order_header`` also returns
    the fields of the line's own order record the silver job needs
    (``order_date``, ``status_id``, ``dt``): they come from the same JSON record,
    so no join of lines with orders is needed to get them.
    """
    f = _fields(raw_sales_items, order_id="data.id", product_id="item.produto.id", quantity="item.quantidade",
                price="item.valor", **({"day": "data.data", "status": "data.situacao.id"} if with_order_header else {}))
    cols = [
        safe_id("order_id").alias("order_id"),
        safe_id("product_id").alias("product_id"),
        safe_int64("quantity").alias("quantity"),
        safe_numeric("price").alias("order_unit_price"),
    ]
    if with_order_header:
        cols += [safe_date("day").alias("order_date"), safe_id("status").alias("status_id"),
                 *[F.col(c) for c in ("dt", "epoch") if c in f.columns]]
    return f.select(*cols)


def stg_products(raw_products: DataFrame) -> DataFrame:
    """M3: product attributes with the supplier flattened; flags are three-valued."""
    f = _fields(raw_products, "data.", id="id", name="nome", code="codigo", brand="marca", price="preco",
                situation="situacao", format="formato", category="categoria.id", supplier="fornecedor.contato.nome",
                supplier_code="fornecedor.codigo", cost="fornecedor.precoCusto", buy="fornecedor.precoCompra")
    return f.select(
        safe_id("id").alias("product_id"),
        F.upper("name").alias("product_name"),
        F.col("code").alias("product_internal_code"),
        F.upper("brand").alias("brand"),
        safe_numeric("price").alias("price"),
        (F.col("situation") == F.lit(ACTIVE_FLAG)).alias("is_active"),
        (F.col("format") == F.lit(KIT_FORMAT)).alias("is_kit"),
        safe_id("category").alias("category_id"),
        F.upper("supplier").alias("supplier_name"),
        F.col("supplier_code").alias("product_supplier_code"),
        safe_numeric("cost").alias("cost_price"),
        safe_numeric("buy").alias("buy_price"),
    )


def stg_kit_components(raw_products: DataFrame) -> DataFrame:
    """M4: composite_product_id, component_id, component_quantity for kits only.

    ``explode`` (not ``explode_outer``): a kit with a NULL or empty component
    list gives no row.  Components without an id are kept here.
    """
    f = _fields(raw_products, "data.", id="id", format="formato", parts="estrutura.componentes")
    kits = f.where(F.col("format") == F.lit(KIT_FORMAT))
    comp = kits.select(safe_id("id").alias("composite_product_id"), F.explode("parts").alias("c"))
    return comp.select(
        "composite_product_id",
        safe_id("c.produto.id").alias("component_id"),
        safe_int64("c.quantidade").alias("component_quantity"),
    )


def stg_channels(raw_channels: DataFrame) -> DataFrame:
    """M5: channel_id, channel_name."""
    return raw_channels.select(safe_id("id").alias("channel_id"), F.upper("descricao").alias("channel_name"))


def stg_orders(raw_sales_orders: DataFrame, with_dt: bool = False) -> DataFrame:
    """M6: one row per landed order record, typed."""
    f = _fields(raw_sales_orders, "data.", id="id", number="numero", day="data", out="dataSaida", due="dataPrevista",
                products="totalProdutos", total="total", client="contato.id", status="situacao.id", channel="loja.id",
                discount="desconto.valor", commission="taxas.taxaComissao", freight="taxas.custoFrete", base="taxas.valorBase")
    cols = [
        safe_id("id").alias("order_id"),
        safe_id("number").alias("order_number"),
        safe_date("day").alias("order_date"),
        safe_date("out").alias("dispatch_date"),
        safe_date("due").alias("estimated_delivery_date"),
        safe_numeric("products").alias("total_products_value"),
        safe_numeric("total").alias("total_order_value"),
        safe_id("client").alias("client_id"),
        safe_id("status").alias("status_id"),
        safe_id("channel").alias("sale_channel_id"),
        safe_numeric("discount").alias("order_discount_value"),
        safe_numeric("commission").alias("order_commission_fee"),
        safe_numeric("freight").alias("order_shipping_cost"),
        safe_numeric("base").alias("base_value"),
    ]
    if with_dt:
        cols += [F.col(c) for c in ("dt", "epoch") if c in f.columns]
    return f.select(*cols)


def stg_statuses(raw_statuses: DataFrame) -> DataFrame:
    """M7: status_id, status_name."""
    return raw_statuses.select(safe_id("id").alias("status_id"), F.upper("nome").alias("status_name"))


def create_views(raw) -> None:
    """The staging models as session views under their names."""
    for name, df in (("stg_categories", stg_categories(raw.categories)), ("stg_order_items", stg_order_items(raw.sales_items)),
                     ("stg_products", stg_products(raw.products)), ("stg_kit_components", stg_kit_components(raw.products)),
                     ("stg_channels", stg_channels(raw.channels)), ("stg_orders", stg_orders(raw.sales_orders)),
                     ("stg_statuses", stg_statuses(raw.statuses))):
        df.createOrReplaceTempView(name)
