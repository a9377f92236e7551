"""Commission per client and discount rate."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import client_key
from ..schemas import MONEY_TOTAL


def client_commission(invoices: DataFrame, clients: DataFrame) -> DataFrame:
    """Commission of known clients by (client, invoice name, rate).

    The name is the invoice's own. Invoices are summed before the membership test, so only groups meet the
    client table, and its duplicates cannot multiply anything.
    """
    groups = invoices.groupBy("cliente_id", "nombre_fiscal", "tasa_descuento").agg(
        F.sum("cant_comision").alias("importe")
    )
    return commission_of_groups(groups, clients)


def commission_of_groups(groups: DataFrame, clients: DataFrame) -> DataFrame:
    """The groups of known clients as dashboard rows."""
    return groups.join(clients.select("cliente_id"), "cliente_id", "left_semi").select(
        client_key().alias("id_analisis"),
        F.col("nombre_fiscal").alias("cliente"),
        F.col("tasa_descuento").alias("tasa_cliente"),
        F.col("importe").cast(MONEY_TOTAL).alias("importe"),
    )
