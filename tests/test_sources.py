"""Readers and the input contract."""

import json
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException

from anticipa import operators as op
from anticipa import plans, schemas, sources
from anticipa.sources import Table
from helpers import rows

GOOD = {"factura_id": 1, "cliente_id": 2, "nombre_fiscal": "A", "cant_comision": 100, "tasa_descuento": 3, "dias_pago": 30}


def write_lines(folder, *lines):
    folder.mkdir()
    (folder / "part.json").write_text("\n".join(l if isinstance(l, str) else json.dumps(l) for l in lines))
    return Table(str(folder), "json")


@pytest.fixture
def loose(tmp_path):
    no_rate = {k: v for k, v in GOOD.items() if k != "tasa_descuento"}
    return write_lines(
        tmp_path / "invoices",
        GOOD,
        {**GOOD, "factura_id": 2, "created_at": "2024-01-01T00:00:00Z", "unused": [1]},
        {**no_rate, "factura_id": 3},
        {**GOOD, "factura_id": 4, "tasa_descuento": None},
        {**GOOD, "factura_id": 5, "tasa_descuento": "x"},
        {**GOOD, "factura_id": 6, "tasa_descuento": 1.5},
        '{"factura_id": 7, "cliente',
    )


def test_contract_splits_json(spark, loose):
    df = sources.invoices(spark, loose)
    valid, rejects = op.split_contract(df, schemas.REQUIRED["invoices"])
    assert [(r.factura_id, r.cant_comision) for r in valid.orderBy("factura_id").collect()] == [(1, Decimal(100)), (2, Decimal(100))]
    assert valid.columns == schemas.INVOICES.fieldNames()
    assert sorted(r.reason for r in rejects.collect()) == ["missing tasa_descuento"] * 2 + ["unreadable"] * 3
    assert rows(op.reject_counts(df, schemas.REQUIRED["invoices"])) == [("missing tasa_descuento", 2), ("unreadable", 3)]


def test_strict_contract_fails_the_job(spark, loose, tmp_path):
    with pytest.raises(PySparkException, match="input contract broken"):
        op.enforce_contract(sources.invoices(spark, loose), schemas.REQUIRED["invoices"]).collect()
    good = write_lines(tmp_path / "good", GOOD)
    assert op.enforce_contract(sources.invoices(spark, good), schemas.REQUIRED["invoices"]).count() == 1


def test_json_array_file_with_other_names(spark, tmp_path):
    file = tmp_path / "clients.json"
    file.write_text(json.dumps([{"cliente_id": 1, "razon": "A"}, {"cliente_id": 2}]))
    table = Table(str(file), "json", {"multiLine": "true"}, {"nombre_fiscal": "razon"})
    assert rows(sources.clients(spark, table).select("cliente_id", "nombre_fiscal")) == [(1, "A"), (2, None)]


def test_nested_feed(spark, tmp_path):
    item = {"cant_comision": 1.1, "dias_pago": 90, "fecha_registro": "2024-01-01"}
    feed = write_lines(
        tmp_path / "feed",
        {"anexo_id": 1, "cliente_id": 5, "jsonb_agg": [item, {**item, "dias_pago": None}]},
        {"anexo_id": 2, "cliente_id": 5, "jsonb_agg": None},
        {"anexo_id": 3, "cliente_id": 5},
        {"anexo_id": 4, "cliente_id": 5, "jsonb_agg": []},
    )
    inputs = {"annex_feed": sources.annex_feed(spark, feed)}
    got = plans.compute("billed_by_term_all", inputs, None).collect()
    assert {r.dias: r.total_facturado for r in got}["90"] == Decimal("1.1")
    assert [r.reason for r in plans.rejects("billed_by_term_all", inputs)["annex_items"].collect()] == ["missing dias_pago"]


def test_accepted_and_rejected_rows_are_complements(spark, tmp_path):
    """A bad field makes a row a reject of just the jobs that use the field, and fails only those in strict form."""
    invoices = write_lines(
        tmp_path / "invoices", GOOD, {**GOOD, "dias_pago": 60, "cant_comision": "bad"}, {**GOOD, "dias_pago": "soon", "tasa_descuento": 9}
    )
    inputs = {"invoices": sources.invoices(spark, invoices)}

    def left_out(job):
        return [r.reason for r in plans.rejects(job, inputs)["invoices"].collect()]

    assert plans.compute("credit_days_all", inputs, None).first().dias_promedio == 45.0 and left_out("credit_days_all") == ["unreadable"]
    assert plans.compute("rate_indicators_all", inputs, None).first().media == 5.0 and left_out("rate_indicators_all") == []
    assert plans.compute("rate_indicators_all", inputs, None, strict=True).count() == 1
    with pytest.raises(PySparkException, match="input contract broken"):
        plans.compute("credit_days_all", inputs, None, strict=True).collect()


def test_unreadable_annexes_are_rejects(spark, tmp_path):
    item = {"cant_comision": 1, "dias_pago": 5, "fecha_registro": "2024-01-01"}
    annex = {"anexo_id": 1, "cliente_id": 5, "jsonb_agg": [item]}
    feed = write_lines(
        tmp_path / "feed",
        annex,
        {**annex, "anexo_id": 2, "jsonb_agg": [item, {**item, "dias_pago": "soon"}]},
        {**annex, "anexo_id": 3, "jsonb_agg": {"not": "a list"}},
        '{"anexo_id": 4, "jsonb_agg": [',
    )
    inputs = {"annex_feed": sources.annex_feed(spark, feed)}
    got = plans.compute("billed_by_term_all", inputs, None).collect()
    assert {r.dias: r.total_facturado for r in got}["0-30"] == 1
    left_out = plans.rejects("billed_by_term_all", inputs)
    assert [r.reason for r in left_out["annex_feed"].collect()] == ["unreadable"] * 3
    assert left_out["annex_items"].count() == 0
    with pytest.raises(PySparkException, match="input contract broken"):
        plans.compute("billed_by_term_all", inputs, None, strict=True).collect()


def test_annex_dates(spark, tmp_path):
    base = {"anexo_id": 1, "cliente_id": 1, "estatus": "s", "estatus_id": 4}
    table = write_lines(
        tmp_path / "annexes",
        {**base, "created_at": "2024-03-05T23:30:00-08:00"},
        {**base, "created_at": "soon"},
        base,
    )
    valid, rejects = op.split_contract(sources.annexes(spark, table), schemas.REQUIRED["annexes"])
    assert [str(r.created_on) for r in valid.collect()] == ["2024-03-05"]
    assert {r.reason for r in rejects.collect()} == {"missing created_on"} and rejects.count() == 2


@pytest.mark.parametrize("kind", ["parquet", "orc", "json"])
def test_formats_give_the_same_rows(spark, tmp_path, kind):
    users = spark.createDataFrame([("a", "a@x", "on", None), ("b", "b@x", None, "P1")], schemas.USERS)
    path = str(tmp_path / kind)
    users.select(*reversed(users.columns)).write.format(kind).save(path)
    got = sources.users(spark, Table(path, kind))
    assert rows(op.split_contract(got, schemas.REQUIRED["users"])[0]) == rows(users)


def test_formats_without_column_names_are_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="by position"):
        sources.users(spark, Table(str(tmp_path), "csv"))


def test_columns_and_filters_reach_the_scan(spark):
    table = Table("/root/testdata/sf0.001/customer.parquet", columns={"cliente_id": "c_custkey", "nombre_fiscal": "c_name"})
    valid, _ = op.split_contract(sources.clients(spark, table), ("cliente_id",))
    plan = valid.select("cliente_id")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<c_custkey:bigint>" in plan and "IsNotNull(c_custkey)" in plan


def test_jdbc_takes_the_databases_columns_by_name(spark):
    """Against a stand-in for the reader, as no database is started."""
    seen = {}

    class Reader:
        def format(self, name):
            seen["format"] = name
            return self

        def options(self, **options):
            seen.update(options)
            return self

        def load(self):
            return spark.createDataFrame([("x", 7, "A")], "extra string, cliente int, nombre_fiscal string")

    class Session:
        read = Reader()

    options = {"url": "jdbc:any", "dbtable": "cliente", "partitionColumn": "cliente", "numPartitions": "8"}
    got = sources.clients(Session(), Table(format="jdbc", options=options, columns={"cliente_id": "cliente"}))
    assert seen == {"format": "jdbc", **options}
    assert got.schema.simpleString() == "struct<cliente_id:bigint,nombre_fiscal:string>" and rows(got) == [(7, "A")]
