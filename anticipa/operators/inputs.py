"""Shaping of the inputs: flat annex items and the client dimension."""

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# Item columns and their names inside the nested array.
_ITEM_FIELDS = {"comision": "cant_comision", "dias_pago": "dias_pago", "created_at": "fecha_registro"}


def item_fields(names: Iterable[str]) -> tuple[str, ...]:
    """Those of `names` that are fields of the nested items."""
    return tuple(n for n in names if n in _ITEM_FIELDS)


def nested_fields(*fields: str) -> list[Column]:
    """The nested `fields` as one array each, which scans can prune."""
    return [F.col("jsonb_agg")[_ITEM_FIELDS[f]].alias(f) for f in fields]


def annex_items(feed: DataFrame, *fields: str) -> DataFrame:
    """One row per nested item with the annex columns the feed has; a null or empty array gives none.

    Naming `fields` reads only those of the nested columns: the array is rebuilt from its single fields, which scans
    can prune, while Spark never prunes what `inline` opens.
    """
    fields = fields or tuple(_ITEM_FIELDS)
    header = [c for c in ("anexo_id", "cliente_id") if c in feed.columns]
    items = F.arrays_zip(*nested_fields(*fields))
    return feed.select(*header, F.inline(items).alias(*fields))


def open_fields(feed: DataFrame, *fields: str) -> DataFrame:
    """One row per item of a feed that holds the item `fields` as one array each, with the other columns."""
    header = [c for c in feed.columns if c not in fields]
    return feed.select(*header, F.inline(F.arrays_zip(*fields)).alias(*fields))


def unique_clients(clients: DataFrame) -> DataFrame:
    """One row per client; of several names the first in text order stands."""
    return clients.groupBy("cliente_id").agg(F.min("nombre_fiscal").alias("cliente"))
