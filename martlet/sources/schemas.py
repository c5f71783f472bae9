"""Read schemas for the landed NDJSON files.

Schemas are always declared, never inferred: a file that holds only its header
row would otherwise infer no ``data`` column.  Ids, money, quantities and dates
are read as text and typed by the staging casts (the JSON reader turns a numeric
token into its text for a STRING field), so a bad value becomes NULL in one column
instead of spoiling the whole record.
"""

from __future__ import annotations

from pyspark.sql import types as T

ID = T.StringType()  # typed later by functions.casts.safe_id
TXT = T.StringType()
NUM = T.StringType()  # typed later by functions.casts.safe_numeric


def _s(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


_ID_ONLY = _s(("id", ID))

SALES_ITEM = _s(("produto", _ID_ONLY), ("quantidade", NUM), ("valor", NUM))

SALES_DATA = _s(
    ("id", ID),
    ("numero", ID),
    ("data", TXT),
    ("dataSaida", TXT),
    ("dataPrevista", TXT),
    ("totalProdutos", NUM),
    ("total", NUM),
    ("contato", _ID_ONLY),
    ("situacao", _ID_ONLY),
    ("loja", _ID_ONLY),
    ("desconto", _s(("valor", NUM))),
    ("taxas", _s(("taxaComissao", NUM), ("custoFrete", NUM), ("valorBase", NUM))),
    ("itens", T.ArrayType(SALES_ITEM, True)),
)

COMPONENT = _s(("produto", _ID_ONLY), ("quantidade", NUM))

PRODUCT_DATA = _s(
    ("id", ID),
    ("nome", TXT),
    ("codigo", TXT),
    ("marca", TXT),
    ("preco", NUM),
    ("situacao", TXT),
    ("formato", TXT),
    ("categoria", _ID_ONLY),
    ("fornecedor", _s(("codigo", TXT), ("precoCusto", NUM), ("precoCompra", NUM),
                      ("contato", _s(("nome", TXT))))),
    ("estrutura", _s(("componentes", T.ArrayType(COMPONENT, True)))),
)

# The header row ``{"metadata": {...}}`` is kept as raw JSON text.
CORRUPT = "_corrupt_record"

RAW_SALES = _s(("metadata", TXT), ("data", SALES_DATA), (CORRUPT, TXT))
RAW_PRODUCTS = _s(("metadata", TXT), ("data", PRODUCT_DATA), (CORRUPT, TXT))
RAW_CATEGORIES = _s(("metadata", TXT), ("id", ID), ("descricao", TXT),
                    ("categoriaPai", _ID_ONLY), (CORRUPT, TXT))
RAW_CHANNELS = _s(("metadata", TXT), ("id", ID), ("descricao", TXT), (CORRUPT, TXT))
RAW_STATUSES = _s(("metadata", TXT), ("id", ID), ("nome", TXT), (CORRUPT, TXT))

# Landed extraction bookkeeping, one row per fetch attempt of one object id.
EXTRACTION_ATTEMPTS = _s(("run_id", TXT), ("entity", TXT), ("batch", T.IntegerType()),
                         ("object_id", T.LongType()), ("attempt", T.IntegerType()), ("ok", T.BooleanType()))

# Parsed header of a landed file (the reference's run metadata block).
RUN_METADATA = _s(
    ("extraction_timestamp", TXT),
    ("extraction_timestamp_utc", TXT),
    ("extraction_params", TXT),  # the object kept as JSON text
    ("successful_extractions", T.LongType()),
    ("failed_extractions", T.LongType()),
    ("batches_processed", T.LongType()),
    ("total_orders", T.LongType()),
    ("total_products", T.LongType()),
    ("total_records", T.LongType()),
)
