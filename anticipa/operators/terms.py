"""Commission totals and distinct clients per payment-term bucket.

Facts shrink to one row per client holding all five buckets side by side, combined map-side: one shuffle. That row
meets the client dimension on the client alone and only then opens into five rows: zero-fill needs no join with a bucket
table. `term_buckets` is the long form, one row per (client, bucket), which both charts can be read from.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import TERM_BUCKETS, term_bucket
from ..schemas import MONEY_TOTAL
from .labels import for_all, for_every_client, with_client

_SLOTS = tuple((f"tramo_{i}", label) for i, (label, *_) in enumerate(TERM_BUCKETS))


def _bucketed(items: DataFrame) -> DataFrame:
    return items.withColumn("dias", term_bucket(F.col("dias_pago"))).where(F.col("dias").isNotNull())


def _in_slots(value: Column) -> list[tuple[Column, str]]:
    bucket = term_bucket(F.col("dias_pago"))
    return [(F.when(bucket == label, value), slot) for slot, label in _SLOTS]


def _commissions(items: DataFrame, *keys: str) -> DataFrame:
    """One row per key, and without keys exactly one row, with the commission of each bucket as a column."""
    return items.groupBy(*keys).agg(*[F.sum(v).alias(slot) for v, slot in _in_slots(F.col("comision"))])


def _presence(items: DataFrame) -> DataFrame:
    """One row per client, with 1 for each bucket it has an item in."""
    return items.groupBy("cliente_id").agg(*[F.max(v).alias(slot) for v, slot in _in_slots(F.lit(1))])


def _totals(per_client: DataFrame) -> DataFrame:
    return per_client.agg(*[F.sum(slot).alias(slot) for slot, _ in _SLOTS])


def term_buckets(items: DataFrame) -> DataFrame:
    """Commission per (client, bucket): both charts follow from it."""
    return _bucketed(with_client(items)).groupBy("cliente_id", "dias").agg(F.sum("comision").alias("value"))


def _side_by_side(buckets: DataFrame, *keys: str) -> DataFrame:
    """One row per key, and without keys exactly one row, with the buckets as columns."""
    return buckets.groupBy(*keys).agg(
        *[F.sum(F.when(F.col("dias") == label, F.col("value"))).alias(slot) for slot, label in _SLOTS]
    )


def _open(measure: str, dtype: str) -> Column:
    """Five rows (bucket, measure) out of one wide row; an empty bucket counts 0."""
    rows = [
        F.struct(F.lit(label).alias("dias"), F.coalesce(F.col(slot), F.lit(0)).cast(dtype).alias(measure))
        for slot, label in _SLOTS
    ]
    return F.inline(F.array(*rows))


_BILLED = ("total_facturado", MONEY_TOTAL.simpleString())
_CLIENTS = ("no_clientes", "bigint")


def billed_by_term_all(items: DataFrame) -> DataFrame:
    """Five rows always. The amount summed is the commission, under the name the dashboard knows."""
    return for_all(_commissions(items), _open(*_BILLED))


def billed_by_term_by_client(items: DataFrame, clients: DataFrame) -> DataFrame:
    """Five rows for every client, with or without items; items of unknown clients do not count."""
    return for_every_client(_commissions(items, "cliente_id"), clients, _open(*_BILLED))


def billed_by_term(items: DataFrame, clients: DataFrame) -> DataFrame:
    per_client = _commissions(with_client(items), "cliente_id")
    return for_all(_totals(per_client), _open(*_BILLED)).unionByName(
        for_every_client(per_client, clients, _open(*_BILLED))
    )


def billed_of_buckets(buckets: DataFrame, clients: DataFrame) -> DataFrame:
    """Portfolio and client rows from the commissions per (client, bucket)."""
    return for_all(_side_by_side(buckets), _open(*_BILLED)).unionByName(
        for_every_client(_side_by_side(buckets, "cliente_id"), clients, _open(*_BILLED))
    )


def clients_by_term_all(items: DataFrame) -> DataFrame:
    """Five rows always: exact distinct clients, known or not, with an item in the bucket."""
    return for_all(_totals(_presence(with_client(items))), _open(*_CLIENTS))


def clients_by_term_by_client(items: DataFrame, clients: DataFrame) -> DataFrame:
    """Five rows for every client, each 0 or 1."""
    return for_every_client(_presence(items), clients, _open(*_CLIENTS))


def clients_by_term(items: DataFrame, clients: DataFrame) -> DataFrame:
    per_client = _presence(with_client(items))
    return for_all(_totals(per_client), _open(*_CLIENTS)).unionByName(
        for_every_client(per_client, clients, _open(*_CLIENTS))
    )


def clients_of_buckets(buckets: DataFrame, clients: DataFrame) -> DataFrame:
    """Portfolio and client rows from one row per (client, bucket)."""
    buckets = buckets.withColumn("value", F.lit(1))
    return for_all(_side_by_side(buckets), _open(*_CLIENTS)).unionByName(
        for_every_client(_side_by_side(buckets, "cliente_id"), clients, _open(*_CLIENTS))
    )


def unbucketed(items: DataFrame) -> DataFrame:
    """How many items are in no bucket."""
    return items.agg(F.count_if(term_bucket(F.col("dias_pago")).isNull()).alias("n_unbucketed"))
