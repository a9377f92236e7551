"""Small frames at the edges of every rule."""

from datetime import date
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from anticipa import operators as op
from anticipa import schemas
from anticipa.functions import TERM_BUCKETS, day_window, term_bucket, written_date
from anticipa.operators.indicators import rates_of_frequencies
from helpers import rows

DAY = date(2024, 3, 5)
INVOICES = "factura_id long, cliente_id long, nombre_fiscal string, cant_comision decimal(18,4), tasa_descuento int, dias_pago int, created_at string"
ITEMS = "anexo_id long, cliente_id long, comision decimal(18,4), dias_pago int, created_at string"
CLIENTS = "cliente_id long, nombre_fiscal string"
ANNEXES = "anexo_id long, cliente_id long, estatus string, estatus_id int, created_on date"


def invoices(spark, *data):
    return spark.createDataFrame([(i, c, n, Decimal(str(m)), r, d, None) for i, (c, n, m, r, d) in enumerate(data)], INVOICES)


def items(spark, *data):
    return spark.createDataFrame([(1, c, Decimal(str(m)), d, "x") for c, m, d in data], ITEMS)


def clients(spark, *data):
    return spark.createDataFrame(list(data), CLIENTS)


@pytest.mark.parametrize(
    "days, label",
    [(-1, None), (0, None), (1, "0-30"), (30, "0-30"), (31, "31-45"), (45, "31-45"), (46, "46-89"), (89, "46-89"), (90, "90"), (91, ">90"), (None, None)],
)
def test_bucket_edges(spark, days, label):
    assert spark.range(1).select(term_bucket(F.lit(days).cast("int"))).first()[0] == label


def test_unbucketed(spark):
    assert op.unbucketed(items(spark, (1, 1, 0), (1, 1, -4), (1, 1, 1))).first()[0] == 2


def test_nested_items(spark):
    item = (Decimal("1.5"), 10, "2024-01-01")
    feed = spark.createDataFrame(
        [(1, 7, None), (2, 7, []), (3, 7, [item]), (4, 8, [item, item])], schemas.ANNEX_FEED
    )
    got = op.annex_items(feed)
    assert got.columns == ["anexo_id", "cliente_id", "comision", "dias_pago", "created_at"]
    assert [r[:2] for r in rows(got)] == [(3, 7), (4, 8), (4, 8)]


def test_mode_takes_the_smallest_of_the_most_frequent(spark):
    facts = invoices(spark, *[(1, "a", 1, r, 1) for r in (3, 1, 3, 1, 7)], (2, "b", 1, -5, 1), (2, "b", 1, 9, 1))
    assert op.rate_indicators_all(facts.where("cliente_id = 1")).first().moda == 1
    by_client = op.rate_indicators_by_client(facts, clients(spark, (1, "A"), (2, "B")))
    assert {r.cliente: (r.moda, r.tasa_minima, r.tasa_maxima, r.media, r.promedio) for r in by_client.collect()} == {
        "A": (1, 1, 7, 3.0, 3.0),
        "B": (-5, -5, 9, 2.0, 2.0),
    }


def test_mode_of_huge_counts(spark):
    huge = 2**31
    cases = {
        1: ([(5, huge), (-3, huge), (9, huge - 1)], -3),
        2: ([(2**31 - 1, huge - 1), (-(2**31), huge - 2)], 2**31 - 1),
        3: ([(4, huge), (1, huge + 1), (0, 7)], 1),
        4: ([(10**6, 10**12), (-(10**6), 10**12)], -(10**6)),
        5: ([(2**31 - 1, 3), (-(2**31), 3)], -(2**31)),
    }
    data = [(c, rate, n) for c, (pairs, _) in cases.items() for rate, n in pairs]
    frequencies = spark.createDataFrame(data, "cliente_id long, tasa_descuento int, n long")
    got = rates_of_frequencies(frequencies, clients(spark, *[(c, str(c)) for c in cases]))
    assert {int(r.cliente): r.moda for r in got.where("cliente <> 'Todos'").collect()} == {
        c: mode for c, (_, mode) in cases.items()
    }


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-(2**31), 2**31 - 1), min_size=1, max_size=12))
def test_rates_of_any_size(spark, rates):
    row = op.rate_indicators_all(invoices(spark, *[(1, "a", 1, r, 1) for r in rates])).first()
    mode = min(rates, key=lambda r: (-rates.count(r), r))
    assert (row.tasa_minima, row.tasa_maxima, row.moda) == (min(rates), max(rates), mode)
    assert row.media == row.promedio == sum(rates) / len(rates)


def test_no_facts(spark):
    no_invoices, no_items = invoices(spark), items(spark)
    no_annexes = spark.createDataFrame([], ANNEXES)
    people = clients(spark, (1, "A"), (2, "B"))
    for df in (
        op.rate_indicators_all(no_invoices),
        op.credit_days_all(no_invoices),
        op.annex_indicators_all(no_annexes, DAY),
        op.rate_indicators_by_client(no_invoices, people),
        op.credit_days_by_client(no_invoices, people),
        op.annex_indicators_by_client(no_annexes, people, DAY),
        op.client_commission(no_invoices, people),
        op.rate_indicators(no_invoices, people),
        op.credit_days(no_invoices, people),
        op.annex_indicators(no_annexes, people, DAY),
    ):
        assert df.count() == 0
    labels = [label for label, *_ in TERM_BUCKETS]
    assert [tuple(r) for r in op.billed_by_term_all(no_items).collect()] == [("TODOS", "Todos", b, Decimal(0)) for b in labels]
    assert [tuple(r) for r in op.clients_by_term_all(no_items).collect()] == [("TODOS", "Todos", b, 0) for b in labels]
    assert {r.total_facturado for r in op.billed_by_term_by_client(no_items, people).collect()} == {Decimal(0)}
    assert op.clients_by_term_by_client(no_items, people).count() == 10
    assert op.billed_by_term(no_items, people).count() == op.clients_by_term(no_items, people).count() == 15


def test_unknown_and_idle_clients(spark):
    facts = items(spark, (1, "10.5", 30), (1, "0.25", 1), (9, "100", 90))
    people = clients(spark, (1, "A"), (2, "B"))
    billed = {(r.id_analisis, r.dias): r.total_facturado for r in op.billed_by_term(facts, people).collect()}
    assert len(billed) == 15
    assert billed["TODOS", "90"] == 100 and billed["TODOS", "0-30"] == Decimal("10.75")
    assert billed["CLIENTE-1", "0-30"] == Decimal("10.75") and billed["CLIENTE-2", "90"] == 0
    counted = {(r.id_analisis, r.dias): r.no_clientes for r in op.clients_by_term(facts, people).collect()}
    assert counted["TODOS", "90"] == 1 and counted["CLIENTE-1", "0-30"] == 1 and counted["CLIENTE-2", "0-30"] == 0


def test_a_client_listed_twice_is_one_client(spark):
    people = clients(spark, (1, "Z"), (1, "A"), (1, "Z"))
    facts = invoices(spark, (1, "x", "1.5", 3, 10), (1, "y", "2", 3, 20), (1, "x", "4", 3, 30))
    assert rows(op.credit_days_by_client(facts, people)) == [("CLIENTE-1", "A", 20.0)]
    assert op.billed_by_term_by_client(items(spark, (1, 1, 5)), people).count() == 5
    assert rows(op.client_commission(facts, people)) == [
        ("CLIENTE-1", "x", 3, Decimal("5.5000")),
        ("CLIENTE-1", "y", 3, Decimal("2.0000")),
    ]


def test_money_is_exact(spark):
    facts = items(spark, *[(1, "0.1", 5)] * 1000, (1, "99999999999999.9999", 5))
    assert op.billed_by_term_all(facts).first().total_facturado == Decimal("100000000000099.9999")


def test_annex_states(spark):
    data = [(1, 1, "s", s, d) for s in (4, 5, 9, 10, 1) for d in (DAY, date(2024, 3, 4))]
    annexes = spark.createDataFrame(data + [(2, 8, "s", 4, DAY)], ANNEXES)
    people = clients(spark, (1, "A"))
    assert rows(op.annex_indicators(annexes, people, DAY)) == [
        ("CLIENTE-1", "A", 5, 4, 2, 2),
        ("TODOS", "Todos", 6, 4, 3, 2),
    ]


@pytest.mark.parametrize("zone", ["UTC", "America/Los_Angeles"])
def test_written_date_ignores_offset_and_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        texts = ["2024-03-05T23:30:00-08:00", "2024-03-05T01:00:00+00:00", "2024-03-05 10:00:00", "2024-03-05", "soon", None]
        df = spark.createDataFrame([(t,) for t in texts], "t string").select(written_date(F.col("t")))
        assert [r[0] for r in df.collect()] == [DAY] * 4 + [None] * 2
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_day_is_half_open(spark):
    times = ["2024-03-04 23:59:59.999999", "2024-03-05 00:00:00", "2024-03-05 23:59:59.999999", "2024-03-06 00:00:00"]
    df = spark.createDataFrame([(t,) for t in times], "t string").withColumn("t", F.col("t").cast("timestamp_ntz"))
    assert df.where(day_window(F.col("t"), DAY)).count() == 2


def test_preview(spark):
    df = spark.range(1000)
    assert op.preview(df).count() == 10
    assert op.preview(df, rows=5, seed=3).collect() == op.preview(df, rows=5, seed=3).collect()
