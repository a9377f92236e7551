"""Accepted rows and rejects out of one read, and previews that ride on a job."""

import json

import pytest
from pyspark.sql import Observation

from anticipa import operators as op
from anticipa import plans, sources
from anticipa.__main__ import main
from anticipa.sources import Table
from anticipa.sources import order_feeds as feeds
from helpers import rows

FOLDER = "/root/testdata/sf0.001"


def test_split_once_equals_the_lazy_split(spark):
    df, required = feeds.loose_invoices(spark, FOLDER), ("factura_id", "tasa_descuento", "dias_pago")
    accepted, rejects, seen = op.split_once(df, required, "invoices")
    lazy = op.split_contract(df, required)
    assert rows(accepted.select(*df.columns)) == rows(lazy[0]) and rows(rejects.select(*lazy[1].columns)) == rows(lazy[1])
    counts = {r["reason"]: r["n"] for r in op.reject_counts(df, required).collect()}
    assert {k: v for k, v in seen.get.items() if v} == {**counts, "accepted": accepted.count()}


def test_split_once_of_nothing(spark):
    df = feeds.loose_invoices(spark, FOLDER).where("1 = 0")
    accepted, rejects, seen = op.split_once(df, ("dias_pago",), "invoices")
    assert accepted.count() == rejects.count() == 0 and accepted.columns == df.columns
    accepted, rejects, _ = op.split_once(feeds.loose_invoices(spark, FOLDER), ("factura_id",), "invoices", ("dias_pago",))
    assert accepted.count() > accepted.where("dias_pago IS NULL").count() == rejects.count() > 0


def put(folder, name, *lines):
    (folder / f"{name}.json").write_text("\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines))
    return {"path": str(folder / f"{name}.json"), "format": "json"}


def tables(folder):
    item = {"cant_comision": 2.5, "dias_pago": 90, "fecha_registro": "2024-03-01"}
    invoice = {"factura_id": 1, "cliente_id": 7, "nombre_fiscal": "x", "cant_comision": 2.5, "tasa_descuento": 3, "dias_pago": 30}
    found = {
        "invoices": put(folder, "invoices", invoice, {**invoice, "dias_pago": None}, {**invoice, "tasa_descuento": None}, {**invoice, "cliente_id": None}, "{broken"),
        "annexes": put(folder, "annexes", {"anexo_id": 1, "cliente_id": 7, "estatus": "s", "estatus_id": 9, "created_at": "2024-03-05"}),
        "annex_feed": put(folder, "feed", {"anexo_id": 1, "cliente_id": 7, "jsonb_agg": [item, {"dias_pago": 5}, {"cant_comision": 1.0}]}, "none"),
        "clients": put(folder, "clients", {"cliente_id": 7, "nombre_fiscal": "X"}, {"cliente_id": 8}),
    }
    (folder / "tables.json").write_text(json.dumps(found))
    return str(folder / "tables.json"), {n: Table(**t) for n, t in found.items()}


@pytest.mark.parametrize("versioned", [False, True])
def test_refreshes_with_rejects_read_each_input_once(spark, tmp_path, versioned):
    where, found = tables(tmp_path)
    inputs = sources.read_all(spark, found)
    jobs = ["rate_indicators", "credit_days", "billed_by_term", "clients_by_term"]
    args = ["--tables", where, "refresh", *jobs, "--as-of", "2024-03-05", *["--versioned"] * versioned]
    plain = main([*args, "--dashboards", f"{tmp_path}/plain"])
    assert main([*args, "--dashboards", f"{tmp_path}/split", "--rejects", f"{tmp_path}/left"]) == plain
    for job in jobs:
        for table, want in plans.rejects(job, inputs).items():
            want = sorted(r.reason for r in want.collect())
            if want:
                got = spark.read.json(f"{tmp_path}/left/{job}/{table}")
                assert sorted(r.reason for r in got.collect()) == want
    whole = ["--tables", where, "refresh", "all", "--as-of", "2024-03-05", *["--versioned"] * versioned]
    plain = main([*whole, "--dashboards", f"{tmp_path}/whole"])
    assert main([*whole, "--dashboards", f"{tmp_path}/both", "--rejects", f"{tmp_path}/left"]) == plain
    reasons = {t: rows(spark.read.json(f"{tmp_path}/left/all/{t}").select("reason")) for t in ("invoices", "clients", "annex_items", "annex_feed")}
    assert reasons == {
        "invoices": [("missing cliente_id",), ("missing dias_pago",), ("missing tasa_descuento",), ("unreadable",)],
        "clients": [("missing nombre_fiscal",)],
        "annex_items": [("missing comision",), ("missing dias_pago",)],
        "annex_feed": [("unreadable",)],
    }


def test_each_input_is_scanned_once(spark, tmp_path, monkeypatch):
    """Only the copies in the shared folder are read by what follows the split."""
    _, found = tables(tmp_path)
    inputs = sources.read_all(spark, found)
    accepted = []
    split = plans.jobs._split
    monkeypatch.setattr(plans.jobs, "_split", lambda *a: accepted.append(split(*a)) or accepted[-1])
    plans.refresh(spark, "billed_by_term", inputs, f"{tmp_path}/out", feeds.AS_OF, rejects=f"{tmp_path}/left")
    for rows_, left_out in accepted:
        for frame in (rows_, *left_out.values()):
            files = frame.inputFiles()
            assert files and not any(str(tmp_path) in f for f in files)


def test_a_preview_rides_on_the_refresh(spark, tmp_path):
    inputs = {t: getattr(feeds, t)(spark, FOLDER) for t in ("invoices", "clients")}
    for job in ("rate_indicators", "credit_days_all"):
        seen = Observation()
        plans.refresh(spark, job, inputs, str(tmp_path / job), feeds.AS_OF, preview=seen)
        drawn = op.preview_of(seen)
        known = {tuple(r) for r in inputs["invoices"].select(*drawn[0]).collect()}
        assert 5 < len(drawn) <= 10 and all(tuple(r.values()) in known for r in drawn)


def test_rows_are_drawn_evenly(spark):
    df = spark.range(20).selectExpr("id % 10 AS k", "id % 10 AS v")
    drawn = [r.k for seed in range(0, 400, 10) for r in op.drawn_rows(df, seed=seed).collect()]
    assert len(drawn) == 400 and all(15 < drawn.count(k) < 75 for k in range(10))
    assert op.drawn_rows(df.where("k > 10")).collect() == []
