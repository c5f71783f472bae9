import json
import os

from martlet.__main__ import main


def test_cli_audit_reports_header_counts(spark, tmp_dir, capsys):
    d = f"{tmp_dir}/sales_data/dt=2024-01-07"
    os.makedirs(d)
    with open(f"{d}/a.json", "w") as f:
        f.write(json.dumps({"metadata": {"total_orders": 2}}) + "\n")
        f.write(json.dumps({"data": {"id": 1, "itens": []}}) + "\n")
        f.write(json.dumps({"data": {"id": 2}}) + "\n")
    assert main(["audit", "--landing", tmp_dir]) == 0
    out = [json.loads(line) for line in capsys.readouterr().out.strip().splitlines()]
    assert out == [{**out[0], "dt": "2024-01-07", "declared_rows": 2, "landed_rows": 2, "count_matches": True}]


def test_cli_rejects_bad_date(tmp_dir):
    import pytest
    with pytest.raises(ValueError):
        main(["weekly", "--landing", tmp_dir, "--mart", tmp_dir, "--as-of", "02/08/2001"])
