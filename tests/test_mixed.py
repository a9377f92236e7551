"""Folders whose files hold a field in different types."""

import json
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from anticipa import operators as op
from anticipa import plans, sources
from anticipa.__main__ import main
from anticipa.sources import Table
from helpers import rows

NAMES = "factura_id, cliente_id, nombre_fiscal, cant_comision, tasa_descuento, dias_pago"


def put(spark, path, kind, *values):
    """One file of (id, client, name, money, rate, days); `values` are SQL."""
    source = " UNION ALL ".join(f"SELECT {v}" for v in values)
    spark.sql(f"SELECT * FROM ({source}) AS t({NAMES})").coalesce(1).write.mode("append").format(kind).save(path)


@pytest.fixture(params=["parquet", "orc"])
def folder(spark, tmp_path, request):
    path, kind = str(tmp_path / "in voices"), request.param
    put(spark, path, kind, "1L, 7L, 'a', CAST(1.5 AS DECIMAL(18, 4)), 3, 30", "2L, 7L, 'a', CAST(2 AS DECIMAL(18, 4)), 3, 60")
    put(spark, path, kind, "3, 7, 'a', 2.25D, 4D, 'thirty'", "4, 7, 'a', 0.00006D, 4.5D, '45'")
    put(spark, path, kind, "'5', 8L, 12, 'x', '5', 90L", "'6', 8L, 13, ' 1.25', NULL, 5000000000L")
    put(spark, path, kind, "7L, 7L, 'a', DATE'2024-01-01', 3, ARRAY(1)")
    return Table(path, kind, mixed=True)


def test_values_that_fit_are_read_and_others_are_named(spark, folder):
    got = sources.invoices(spark, folder)
    money = lambda x: Decimal(x).quantize(Decimal("1.0000"))
    assert rows(got.select("factura_id", "cliente_id", "nombre_fiscal", "cant_comision", "tasa_descuento", "dias_pago", "_wrong_type")) == [
        (1, 7, "a", money("1.5"), 3, 30, []),
        (2, 7, "a", money("2"), 3, 60, []),
        (3, 7, "a", money("2.25"), 4, None, ["dias_pago"]),
        (4, 7, "a", money("0.0001"), None, 45, ["tasa_descuento"]),
        (5, 8, "12", None, 5, 90, ["cant_comision"]),
        (6, 8, "13", money("1.25"), None, None, ["dias_pago"]),
        (7, 7, "a", None, 3, None, ["cant_comision", "dias_pago"]),
    ]


def test_wrong_types_are_rejects_of_the_jobs_that_use_the_field(spark, folder):
    clients = spark.sql("SELECT * FROM VALUES (7L, 'a'), (8L, 'b') AS t(cliente_id, nombre_fiscal)")
    inputs = {"invoices": sources.invoices(spark, folder), "clients": clients}
    day = date(2024, 3, 5)
    days = plans.compute("credit_days", inputs, day)
    assert {(r["id_analisis"], float(r["dias_promedio"])) for r in days.collect()} == {
        ("TODOS", 56.25), ("CLIENTE-7", 45.0), ("CLIENTE-8", 90.0),
    }
    reasons = lambda job: sorted(r["reason"] for r in plans.rejects(job, inputs)["invoices"].collect())
    assert reasons("credit_days") == ["wrong type dias_pago"] * 3
    assert reasons("rate_indicators") == ["missing tasa_descuento", "wrong type tasa_descuento"]
    required = ("factura_id", "dias_pago")
    accepted, rejects, seen = op.split_once(inputs["invoices"], required, "invoices")
    assert accepted.count() == 4 and "_wrong_type" not in accepted.columns and rejects.count() == 3
    assert {k: v for k, v in seen.get.items() if v} == {"accepted": 4, "wrong type dias_pago": 3}
    with pytest.raises(Exception, match="wrong type dias_pago"):
        op.enforce_contract(inputs["invoices"], required).collect()


def test_the_command_refreshes_from_a_mixed_folder(spark, folder, tmp_path):
    spark.sql("SELECT 7L AS cliente_id, 'a' AS nombre_fiscal").write.parquet(f"{tmp_path}/clients")
    where = {"invoices": {"path": folder.path, "format": folder.format, "mixed": True}, "clients": {"path": f"{tmp_path}/clients"}}
    (tmp_path / "tables.json").write_text(json.dumps(where))
    out = f"{tmp_path}/dashboards"
    main(["--tables", f"{tmp_path}/tables.json", "refresh", "credit_days", "--dashboards", out, "--as-of", "2024-03-05", "--rejects", f"{tmp_path}/left"])
    assert spark.read.parquet(f"{out}/indicadores_dias_credito_dashboard").count() == 2
    left = spark.read.option("recursiveFileLookup", "true").json(f"{tmp_path}/left")
    assert rows(left.groupBy("reason").count()) == [("wrong type dias_pago", 3)]


def test_nested_items_partitions_and_empty_folders(spark, tmp_path):
    path = str(tmp_path / "feed")
    item = "named_struct('dias_pago', {}, 'comision', 1, 'cant_comision', CAST(3 AS DECIMAL(18, 4)), 'fecha_registro', 'f')"
    for day, id_, days in (("a", "1L", "30"), ("b", "'2'", "'31'"), ("b", "'x'", "'no'")):
        spark.sql(f"SELECT {id_} anexo_id, 7L cliente_id, array({item.format(days)}, NULL) jsonb_agg").write.mode("append").parquet(f"{path}/day={day}")
    feed = sources.annex_feed(spark, Table(path, mixed=True))
    got = feed.select("anexo_id", F.col("jsonb_agg.dias_pago"), F.col("jsonb_agg.cant_comision")[0].cast("int"), "_wrong_type")
    assert rows(got) == [(1, [30, None], 3, []), (2, [31, None], 3, []), (None, [None, None], 3, ["anexo_id"])]
    (tmp_path / "none").mkdir()
    empty = sources.clients(spark, Table(str(tmp_path / "none"), mixed=True))
    assert empty.count() == 0 and empty.columns == ["cliente_id", "nombre_fiscal", "_wrong_type"]
    with pytest.raises(ValueError):
        sources.clients(spark, Table(path, "json", mixed=True))
