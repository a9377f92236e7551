"""Analysis key and label columns that lead every dashboard row."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import ALL_KEY, ALL_LABEL, client_key
from .inputs import unique_clients


def with_client(facts: DataFrame) -> DataFrame:
    """Facts that name a client, as the input contract demands.

    Said here so that the portfolio and the client branch of a combined frame filter alike and share one shuffle.
    """
    return facts.where(F.col("cliente_id").isNotNull())


def for_all(totals: DataFrame, *measures) -> DataFrame:
    return totals.select(F.lit(ALL_KEY).alias("id_analisis"), F.lit(ALL_LABEL).alias("cliente"), *measures)


def for_clients_with_facts(per_client: DataFrame, clients: DataFrame, *measures) -> DataFrame:
    """Keep the aggregates of known clients; clients without facts have no row.

    Both sides are already grouped by client, so the join adds no shuffle of facts and no hot key.
    """
    joined = per_client.join(unique_clients(clients), "cliente_id")
    return joined.select(client_key().alias("id_analisis"), "cliente", *measures)


def for_every_client(per_client: DataFrame, clients: DataFrame, *measures) -> DataFrame:
    """Like `for_clients_with_facts`, but clients without facts stay, with null aggregates."""
    joined = unique_clients(clients).join(per_client, "cliente_id", "left")
    return joined.select(client_key().alias("id_analisis"), "cliente", *measures)
