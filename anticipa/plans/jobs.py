"""Dashboard tables and the jobs that refresh them."""

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import operators as op
from ..operators import Dashboard
from ..schemas import CORRUPT, REQUIRED, WRONG_TYPE
from ..session import written

Inputs = Mapping[str, DataFrame]

# The dashboard tables with their keys and measures.
DASHBOARDS = {
    d.name: d
    for d in (
        Dashboard(
            "indicadores_tasas_dashboard",
            ("id_analisis",),
            ("tasa_minima", "tasa_maxima", "moda", "media", "promedio"),
        ),
        Dashboard(
            "indicadores_anexos_dashboard",
            ("id_analisis",),
            ("generados", "aceptados", "pagados", "cancelados"),
        ),
        Dashboard("indicadores_dias_credito_dashboard", ("id_analisis",), ("dias_promedio",)),
        Dashboard("grafica_total_facturado_x_condicion_pago", ("id_analisis", "dias"), ("total_facturado",)),
        Dashboard("grafica_clientes_x_condicion_pago", ("id_analisis", "dias"), ("no_clientes",)),
        # A client may have invoices under several names; the name is part of the key so that all groups stay. A client
        # computed anew loses the groups it no longer has: after a rename nothing counts twice.
        Dashboard(
            "parreto_clientes_comision", ("id_analisis", "cliente", "tasa_cliente"), ("importe",), ("id_analisis",)
        ),
    )
}


# Fields each job uses of each table; rows that lack one are rejects.
_RATES = ("factura_id", "cliente_id", "tasa_descuento")
_DAYS = ("factura_id", "cliente_id", "dias_pago")
_COMMISSIONS = ("factura_id", "cliente_id", "nombre_fiscal", "cant_comision", "tasa_descuento")
_ANNEXES = REQUIRED["annexes"]
_BILLED_ITEMS = ("comision", "dias_pago")
_TERM_ITEMS = ("cliente_id", "dias_pago")
_BILLED_CLIENT_ITEMS = ("cliente_id", "comision", "dias_pago")
_CLIENTS = REQUIRED["clients"]
_CLIENT_IDS = ("cliente_id",)


@dataclass(frozen=True)
class Job:
    """`compute` gets the accepted rows of the tables in `reads`, in that order, and the day."""

    name: str
    dashboard: str
    reads: Mapping[str, tuple[str, ...]]
    compute: Callable[..., DataFrame]


JOBS = {
    j.name: j
    for j in (
        Job(
            "rate_indicators_all",
            "indicadores_tasas_dashboard",
            {"invoices": _RATES},
            lambda invoices, day: op.rate_indicators_all(invoices),
        ),
        Job(
            "rate_indicators_by_client",
            "indicadores_tasas_dashboard",
            {"invoices": _RATES, "clients": _CLIENTS},
            lambda invoices, clients, day: op.rate_indicators_by_client(invoices, clients),
        ),
        Job(
            "rate_indicators",
            "indicadores_tasas_dashboard",
            {"invoices": _RATES, "clients": _CLIENTS},
            lambda invoices, clients, day: op.rate_indicators(invoices, clients),
        ),
        Job(
            "annex_indicators_all",
            "indicadores_anexos_dashboard",
            {"annexes": _ANNEXES},
            op.annex_indicators_all,
        ),
        Job(
            "annex_indicators_by_client",
            "indicadores_anexos_dashboard",
            {"annexes": _ANNEXES, "clients": _CLIENTS},
            op.annex_indicators_by_client,
        ),
        Job(
            "annex_indicators",
            "indicadores_anexos_dashboard",
            {"annexes": _ANNEXES, "clients": _CLIENTS},
            op.annex_indicators,
        ),
        Job(
            "credit_days_all",
            "indicadores_dias_credito_dashboard",
            {"invoices": _DAYS},
            lambda invoices, day: op.credit_days_all(invoices),
        ),
        Job(
            "credit_days_by_client",
            "indicadores_dias_credito_dashboard",
            {"invoices": _DAYS, "clients": _CLIENTS},
            lambda invoices, clients, day: op.credit_days_by_client(invoices, clients),
        ),
        Job(
            "credit_days",
            "indicadores_dias_credito_dashboard",
            {"invoices": _DAYS, "clients": _CLIENTS},
            lambda invoices, clients, day: op.credit_days(invoices, clients),
        ),
        Job(
            "billed_by_term_all",
            "grafica_total_facturado_x_condicion_pago",
            {"annex_items": _BILLED_ITEMS},
            lambda items, day: op.billed_by_term_all(items),
        ),
        Job(
            "billed_by_term_by_client",
            "grafica_total_facturado_x_condicion_pago",
            {"annex_items": _BILLED_CLIENT_ITEMS, "clients": _CLIENTS},
            lambda items, clients, day: op.billed_by_term_by_client(items, clients),
        ),
        Job(
            "billed_by_term",
            "grafica_total_facturado_x_condicion_pago",
            {"annex_items": _BILLED_CLIENT_ITEMS, "clients": _CLIENTS},
            lambda items, clients, day: op.billed_by_term(items, clients),
        ),
        Job(
            "clients_by_term_all",
            "grafica_clientes_x_condicion_pago",
            {"annex_items": _TERM_ITEMS},
            lambda items, day: op.clients_by_term_all(items),
        ),
        Job(
            "clients_by_term_by_client",
            "grafica_clientes_x_condicion_pago",
            {"annex_items": _TERM_ITEMS, "clients": _CLIENTS},
            lambda items, clients, day: op.clients_by_term_by_client(items, clients),
        ),
        Job(
            "clients_by_term",
            "grafica_clientes_x_condicion_pago",
            {"annex_items": _TERM_ITEMS, "clients": _CLIENTS},
            lambda items, clients, day: op.clients_by_term(items, clients),
        ),
        Job(
            "pareto_client_commission",
            "parreto_clientes_comision",
            {"invoices": _COMMISSIONS, "clients": _CLIENT_IDS},
            lambda invoices, clients, day: op.client_commission(invoices, clients),
        ),
    )
}


def _accept(rows: DataFrame, required: tuple[str, ...], strict: bool) -> DataFrame:
    return op.enforce_contract(rows, required) if strict else op.split_contract(rows, required)[0]


def _table(inputs: Inputs, table: str, required: tuple[str, ...], strict: bool) -> DataFrame:
    if table != "annex_items":
        return inputs[table]
    # An unreadable annex must go before it is opened: with its items lost it would leave no trace.
    return op.annex_items(_accept(inputs["annex_feed"], (), strict), *op.item_fields(required))


def _own_fields(rows: DataFrame, required: tuple[str, ...]) -> DataFrame:
    """Only what the job uses. Whether JSON text is unreadable depends on the fields read: both sides read the same."""
    return rows.select(*required, *[c for c in (CORRUPT, WRONG_TYPE) if c in rows.columns])


def _own_feed(feed: DataFrame, required: tuple[str, ...]) -> DataFrame:
    """The annex feed as `_table` reads it: the job's own columns, and of the items the job's own fields."""
    names = op.item_fields(required)
    header = [c for c in required if c not in names]
    return feed.select(*header, *op.nested_fields(*names), *[c for c in (CORRUPT, WRONG_TYPE) if c in feed.columns])


def _accepted_tables(job: Job, inputs: Inputs, strict: bool) -> list[DataFrame]:
    return [
        _accept(_own_fields(_table(inputs, table, required, strict), required), required, strict)
        for table, required in job.reads.items()
    ]


def compute(name: str, inputs: Inputs, as_of: date, strict: bool = False) -> DataFrame:
    """The job's result over the rows that keep the contract; with `strict`, a bad row fails the job."""
    job = JOBS[name]
    return job.compute(*_accepted_tables(job, inputs, strict), as_of)


def rejects(name: str, inputs: Inputs) -> dict[str, DataFrame]:
    """Rows of each input that the job leaves out: its own fields and the reason."""
    reads = JOBS[name].reads
    left_out = {
        t: op.split_contract(_own_fields(_table(inputs, t, required, False), required), required)[1]
        for t, required in reads.items()
    }
    if "annex_items" in reads:
        left_out["annex_feed"] = op.split_contract(_own_feed(inputs["annex_feed"], reads["annex_items"]), ())[1]
    return left_out


def _split(inputs: Inputs, table: str, required: tuple[str, ...], wanted: tuple[str, ...] = ()) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Accepted rows of a job's table and its rejects by input, from one read of the input."""
    if table != "annex_items":
        rows = _own_fields(inputs[table], tuple(dict.fromkeys((*required, *wanted))))
        accepted, left_out, _ = op.split_once(rows, required, table, wanted)
        return accepted, {table: left_out}
    fields = tuple(dict.fromkeys((*required, *wanted)))
    feed, unread, _ = op.split_once(_own_feed(inputs["annex_feed"], fields), (), "annex_feed")
    items = op.open_fields(feed, *op.item_fields(fields))
    accepted, _ = op.split_contract(items, required)
    return accepted, {"annex_items": op.split_contract(items, fields)[1], "annex_feed": unread}


def _write_rejects(left_out: Mapping[str, DataFrame], folder: str) -> None:
    for table, rows in left_out.items():
        rows.write.json(f"{folder}/{table}")


def refresh(
    spark: SparkSession,
    name: str,
    inputs: Inputs,
    folder: str,
    as_of: date,
    strict: bool = False,
    versioned: bool = False,
    rejects: str | None = None,
    preview: Observation | None = None,
) -> dict[str, int]:
    """Run one job and merge its result into its dashboard under `folder`; returns rows per action.

    `versioned` dashboards switch the day in one step and are read with `operators.read_version`. With a new folder
    `rejects`, rows left out are written there, as JSON with the reason; each input is still read once. `preview` holds
    random rows of the job's first table afterwards, see `operators.preview_of`.
    """
    job = JOBS[name]
    dashboard = DASHBOARDS[job.dashboard]
    merge = op.apply_merge_versioned if versioned else op.apply_merge
    if rejects is None:
        tables = _accepted_tables(job, inputs, strict)
    else:
        tables = []
        for table, required in job.reads.items():
            accepted, left_out = _split(inputs, table, required)
            _write_rejects(left_out, rejects)
            if strict and any(not rows.isEmpty() for rows in left_out.values()):
                raise ValueError(f"input contract broken: see {rejects}")
            tables.append(accepted)
    if preview is not None:
        tables[0] = op.previewed(tables[0], preview)
    return merge(spark, job.compute(*tables, as_of), dashboard, f"{folder}/{dashboard.name}", as_of)


def refresh_all(
    spark: SparkSession,
    inputs: Inputs,
    folder: str,
    as_of: date,
    strict: bool = False,
    versioned: bool = False,
    rejects: str | None = None,
) -> dict[str, dict[str, int]]:
    """Refresh every dashboard, portfolio and client rows, reading each input's facts once.

    The aggregates that several dashboards follow from are written to the shared folder, so that a lost executor
    costs at most its part of one of them. With a new folder `rejects`, rows that are left out of any figure are written
    there by input, as JSON with the first reason.
    """
    # An item without a commission is none for the sums, but its client counts.
    least = {"invoices": ("factura_id", "cliente_id"), "annex_items": _TERM_ITEMS, "annexes": _ANNEXES, "clients": _CLIENT_IDS}
    wanted = {"invoices": REQUIRED["invoices"], "annex_items": _BILLED_CLIENT_ITEMS, "annexes": _ANNEXES, "clients": _CLIENTS}
    needed = wanted if strict else least
    if rejects is None:
        tables = {t: _accept(_table(inputs, t, wanted[t], strict), needed[t], strict) for t in least}
    else:
        tables = {}
        for table in least:
            tables[table], left_out = _split(inputs, table, least[table], wanted[table])
            _write_rejects(left_out, rejects)
            if strict and any(not rows.isEmpty() for rows in left_out.values()):
                raise ValueError(f"input contract broken: see {rejects}")
    invoices, items, annexes, known = (tables[t] for t in ("invoices", "annex_items", "annexes", "clients"))
    clients = known.where(F.col("nombre_fiscal").isNotNull())
    groups = written(op.invoice_groups(invoices), "invoice-groups")
    buckets = written(op.term_buckets(items), "term-buckets")
    computed = {
        "indicadores_tasas_dashboard": op.rates_of_groups(groups, clients),
        "indicadores_anexos_dashboard": op.annex_indicators(annexes, clients, as_of),
        "indicadores_dias_credito_dashboard": op.credit_days_of_groups(groups, clients),
        "grafica_total_facturado_x_condicion_pago": op.billed_of_buckets(buckets, clients),
        "grafica_clientes_x_condicion_pago": op.clients_of_buckets(buckets, clients),
        "parreto_clientes_comision": op.pareto_of_groups(groups, known),
    }
    merge = op.apply_merge_versioned if versioned else op.apply_merge
    return {
        name: merge(spark, rows, DASHBOARDS[name], f"{folder}/{name}", as_of)
        for name, rows in computed.items()
    }
