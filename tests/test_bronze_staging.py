import json
import os

from pyspark.sql import functions as F

from martlet.plans import staging
from martlet.sources import bronze
from martlet.sources import schemas as S

from helpers import rows


def _write(path, lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")


def _order(oid, itens=None, status=1, date="2024-01-03", **extra):
    d = {"id": oid, "numero": oid, "data": date, "situacao": {"id": status}, "loja": {"id": 1},
         "contato": {"id": 9}, "total": 100.5, "totalProdutos": 100.5,
         "desconto": {"valor": 1}, "taxas": {"taxaComissao": 2, "custoFrete": 3, "valorBase": 100.5}}
    if itens is not None:
        d["itens"] = itens
    d.update(extra)
    return json.dumps({"data": d}, ensure_ascii=False)


def test_header_corrupt_and_explode(spark, tmp_dir):
    item = {"produto": {"id": 5}, "quantidade": 2, "valor": 10.5}
    _write(f"{tmp_dir}/sales_data/dt=2024-01-07/a.json", [
        json.dumps({"metadata": {"total_orders": 4, "extraction_params": {"limite": 100}}}),
        _order(1, [item, {"produto": {"id": 0}, "quantidade": 1.5, "valor": "abc"}]),
        _order(2, []),
        _order(3),                     # no itens field
        _order(4, [item], date="0000-00-00"),
        "{bad",
    ])
    raw = bronze.read_landed(spark, f"{tmp_dir}/sales_data", S.RAW_SALES).cache()
    assert raw.where(F.col("metadata").isNotNull()).count() == 1
    assert bronze.quarantine_rows(raw).count() == 1
    data = bronze.data_rows(raw)
    orders, lines = bronze.split_sales(data)
    assert sorted(r[0] for r in orders.select("data.id").collect()) == ["1", "2", "3", "4"]
    st = staging.stg_order_items(lines, with_order_header=True)
    got = rows(st, "order_id", "product_id", "quantity", "order_unit_price")
    assert [(g[0], g[1], g[2]) for g in got] == [(1, 0, 2), (1, 5, 2), (4, 5, 2)]
    assert [str(g[3]) for g in got] == ["None", "10.500000000", "10.500000000"]
    so = staging.stg_orders(orders, with_dt=True)
    d = {r.order_id: r for r in so.collect()}
    assert d[4].order_date is None and str(d[1].order_date) == "2024-01-03"
    assert str(d[1].dt) == "2024-01-07"
    audit = bronze.run_audit(raw).collect()
    assert len(audit) == 1 and audit[0].declared_rows == 4 and audit[0].landed_rows == 4
    assert audit[0].count_matches


def test_products_flags_and_kit_components(spark, tmp_dir):
    recs = [
        {"data": {"id": 10, "nome": "ação kit", "formato": "E", "situacao": "A",
                  "fornecedor": {"precoCusto": 5, "contato": {"nome": "acme"}},
                  "estrutura": {"componentes": [{"produto": {"id": 11}, "quantidade": 2},
                                                {"produto": {}, "quantidade": 1}]}}},
        {"data": {"id": 11, "nome": "peça", "formato": "S", "fornecedor": {"precoCusto": "x"}}},
        {"data": {"id": 12, "formato": "E"}},
    ]
    _write(f"{tmp_dir}/products_data/p.json", [json.dumps({"metadata": {"total_records": 3}})]
           + [json.dumps(r, ensure_ascii=False) for r in recs])
    raw = bronze.data_rows(bronze.read_landed(spark, f"{tmp_dir}/products_data", S.RAW_PRODUCTS))
    p = {r.product_id: r for r in staging.stg_products(raw).collect()}
    assert p[10].product_name == "AÇÃO KIT" and p[10].is_kit is True and p[10].is_active is True
    assert p[11].is_active is None and p[11].cost_price is None  # NULL flag, bad cost text
    assert p[10].supplier_name == "ACME"
    comps = rows(staging.stg_kit_components(raw))
    assert comps == [(10, 11, 2), (10, None, 1)]  # kit 12 without components gives no row


def test_one_bad_field_keeps_the_record(spark, tmp_dir):
    lines = [json.dumps({"metadata": {"total_orders": 2}}), _order(1, loja={"id": "abc"}), _order(2, loja="text"),
             _order("x3"), "{bad"]
    _write(f"{tmp_dir}/sales_data/dt=2024-01-07/a.json", lines)
    raw = bronze.read_landed(spark, f"{tmp_dir}/sales_data", S.RAW_SALES).cache()
    text = spark.createDataFrame([(x,) for x in lines], "value string").selectExpr("value", "date'2024-01-07' AS dt")
    for parsed in (raw, bronze.parse_lines(text, S.RAW_SALES)):
        orders = staging.stg_orders(bronze.split_sales(bronze.data_rows(parsed))[0])
        got = sorted(((r.order_id, r.sale_channel_id) for r in orders.collect()), key=str)
        assert got == [(1, None), (2, None), (None, 1)]
        q = {r[S.CORRUPT]: r.kept for r in bronze.quarantine_rows(parsed).collect()}
        assert q["{bad"] is False and all(q[x] for x in q if x != "{bad")
        audit = bronze.run_audit(parsed).first()
        assert audit.landed_rows == 3 and not audit.count_matches and audit.quarantined_rows == len(q)
