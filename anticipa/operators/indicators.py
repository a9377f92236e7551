"""Discount-rate, annex-status and credit-day indicators.

Each family has three forms: the whole portfolio, per client, and both in one frame. The combined form aggregates
the facts once per client and rolls the small per-client result up for the portfolio row.
"""

from datetime import date
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .labels import for_all, for_clients_with_facts, with_client

# --- discount rates ---------------------------------------------------------------------------------------------

# As wide as all 32-bit rates, so count * span - rate orders by count first, then by smaller rate.
_RATE_SPAN = 2**32
# Smaller counts make that product fit a long.
_LONG_COUNTS = 2**31


def rate_frequencies(invoices: DataFrame, *keys: str) -> DataFrame:
    """Invoices per discount rate, within `keys`. Invoices without a rate count for no figure of rates."""
    return invoices.where(F.col("tasa_descuento").isNotNull()).groupBy(*keys, "tasa_descuento").agg(F.count(F.lit(1)).alias("n"))


def _mode() -> Column:
    """Most frequent rate, the smallest of several.

    The order is packed in one number because a struct would force a sort-based aggregate: in a long, and in a
    slower decimal only for the counts beyond it, which win over all others.
    """
    rate, n = F.col("tasa_descuento"), F.col("n")
    small = F.when(n < _LONG_COUNTS, n * F.lit(_RATE_SPAN) - rate)
    large = F.when(n >= _LONG_COUNTS, n.cast("decimal(19,0)") * Decimal(_RATE_SPAN) - rate)
    return F.coalesce(F.max_by(rate, large), F.max_by(rate, small))


def _rate_summary(frequencies: DataFrame, *keys: str) -> DataFrame:
    """Everything follows from the frequency table, which is bounded by the number of distinct rates."""
    rate = F.col("tasa_descuento")
    return (
        frequencies.groupBy(*keys)
        .agg(
            F.min(rate).alias("tasa_minima"),
            F.max(rate).alias("tasa_maxima"),
            F.sum(rate * F.col("n")).alias("total"),
            F.sum("n").alias("n"),
            _mode().alias("moda"),
        )
        .where(F.col("n") > 0)
    )


def _rate_measures() -> list[Column]:
    # Mean and average are the same number under two names; both columns are part of the table.
    mean = F.col("total") / F.col("n")
    return [F.col("tasa_minima"), F.col("tasa_maxima"), F.col("moda"), mean.alias("media"), mean.alias("promedio")]


def rate_indicators_all(invoices: DataFrame) -> DataFrame:
    """One row, or none when there are no invoices."""
    return for_all(_rate_summary(rate_frequencies(invoices)), *_rate_measures())


def rate_indicators_by_client(invoices: DataFrame, clients: DataFrame) -> DataFrame:
    summary = _rate_summary(rate_frequencies(invoices, "cliente_id"), "cliente_id")
    return for_clients_with_facts(summary, clients, *_rate_measures())


def rate_indicators(invoices: DataFrame, clients: DataFrame) -> DataFrame:
    return rates_of_frequencies(rate_frequencies(with_client(invoices), "cliente_id"), clients)


def rates_of_frequencies(frequencies: DataFrame, clients: DataFrame) -> DataFrame:
    """Portfolio and client rows from invoices counted by (client, rate)."""
    overall = _rate_summary(frequencies.groupBy("tasa_descuento").agg(F.sum("n").alias("n")))
    per_client = _rate_summary(frequencies, "cliente_id")
    return for_all(overall, *_rate_measures()).unionByName(
        for_clients_with_facts(per_client, clients, *_rate_measures())
    )


# --- annex status -----------------------------------------------------------------------------------------------

# Workflow status codes.
STATUS_PAID = 4
STATUS_REJECTED = 5
STATUS_ACCEPTED = (9, 10)

_ANNEX_MEASURES = ("generados", "aceptados", "pagados", "cancelados")


def _annex_counts(annexes: DataFrame, as_of: date, *keys: str) -> DataFrame:
    status = F.col("estatus_id")
    return (
        annexes.groupBy(*keys)
        .agg(
            F.count_if(F.col("created_on") == F.lit(as_of)).alias("generados"),
            F.count_if(status.isin(*STATUS_ACCEPTED)).alias("aceptados"),
            F.count_if(status == STATUS_PAID).alias("pagados"),
            F.count_if(status == STATUS_REJECTED).alias("cancelados"),
            F.count(F.lit(1)).alias("n"),
        )
        .where(F.col("n") > 0)
    )


def annex_indicators_all(annexes: DataFrame, as_of: date) -> DataFrame:
    """One row, or none when there are no annexes."""
    return for_all(_annex_counts(annexes, as_of), *_ANNEX_MEASURES)


def annex_indicators_by_client(annexes: DataFrame, clients: DataFrame, as_of: date) -> DataFrame:
    return for_clients_with_facts(_annex_counts(annexes, as_of, "cliente_id"), clients, *_ANNEX_MEASURES)


def annex_indicators(annexes: DataFrame, clients: DataFrame, as_of: date) -> DataFrame:
    per_client = _annex_counts(with_client(annexes), as_of, "cliente_id")
    overall = per_client.agg(*[F.sum(m).alias(m) for m in _ANNEX_MEASURES], F.sum("n").alias("n"))
    return for_all(overall.where(F.col("n") > 0), *_ANNEX_MEASURES).unionByName(
        for_clients_with_facts(per_client, clients, *_ANNEX_MEASURES)
    )


# --- credit days ------------------------------------------------------------------------------------------------


def _credit_day_totals(invoices: DataFrame, *keys: str) -> DataFrame:
    return (
        invoices.groupBy(*keys)
        .agg(F.sum("dias_pago").alias("total"), F.count("dias_pago").alias("n"))
        .where(F.col("n") > 0)
    )


def _average_days() -> Column:
    return (F.col("total") / F.col("n")).alias("dias_promedio")


def credit_days_all(invoices: DataFrame) -> DataFrame:
    """One row, or none when there are no invoices."""
    return for_all(_credit_day_totals(invoices), _average_days())


def credit_days_by_client(invoices: DataFrame, clients: DataFrame) -> DataFrame:
    return for_clients_with_facts(_credit_day_totals(invoices, "cliente_id"), clients, _average_days())


def credit_days(invoices: DataFrame, clients: DataFrame) -> DataFrame:
    return credit_days_of_totals(_credit_day_totals(with_client(invoices), "cliente_id"), clients)


def credit_days_of_totals(per_client: DataFrame, clients: DataFrame) -> DataFrame:
    """Portfolio and client rows from the days' `total` and number `n` per client."""
    overall = per_client.agg(F.sum("total").alias("total"), F.sum("n").alias("n")).where(F.col("n") > 0)
    return for_all(overall, _average_days()).unionByName(
        for_clients_with_facts(per_client, clients, _average_days())
    )
