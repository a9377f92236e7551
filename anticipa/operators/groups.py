"""One aggregation of the invoices that three dashboards follow from.

A field that is missing leaves an invoice out of the figures that use it, and only of those, as if each figure had
aggregated the invoices on its own.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .indicators import credit_days_of_totals, rates_of_frequencies
from .labels import with_client
from .pareto import commission_of_groups


def invoice_groups(invoices: DataFrame) -> DataFrame:
    """Invoices by (client, invoice name, rate): number, days and commission, with the counts behind the sums."""
    return (
        with_client(invoices)
        .groupBy("cliente_id", "nombre_fiscal", "tasa_descuento")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("dias_pago").alias("dias"),
            F.count("dias_pago").alias("n_dias"),
            F.sum("cant_comision").alias("importe"),
        )
    )


def rates_of_groups(groups: DataFrame, clients: DataFrame) -> DataFrame:
    frequencies = groups.where(F.col("tasa_descuento").isNotNull()).groupBy("cliente_id", "tasa_descuento")
    return rates_of_frequencies(frequencies.agg(F.sum("n").alias("n")), clients)


def credit_days_of_groups(groups: DataFrame, clients: DataFrame) -> DataFrame:
    totals = groups.groupBy("cliente_id").agg(F.sum("dias").alias("total"), F.sum("n_dias").alias("n"))
    return credit_days_of_totals(totals.where(F.col("n") > 0), clients)


def pareto_of_groups(groups: DataFrame, clients: DataFrame) -> DataFrame:
    whole = F.col("nombre_fiscal").isNotNull() & F.col("tasa_descuento").isNotNull() & F.col("importe").isNotNull()
    return commission_of_groups(groups.where(whole), clients)
