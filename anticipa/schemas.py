"""Declared input schemas. Columns are matched by name, never inferred."""

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 4)
MONEY_TOTAL = T.DecimalType(28, 4)

CORRUPT = "_corrupt_record"
# Names of the fields of a row whose value was of a type that does not fit; only tables of mixed types have it.
WRONG_TYPE = "_wrong_type"


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    # Readers treat every file column as nullable; REQUIRED carries the null contract.
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


INVOICES = _schema(
    ("factura_id", T.LongType()),
    ("cliente_id", T.LongType()),
    ("nombre_fiscal", T.StringType()),
    ("cant_comision", MONEY),
    ("tasa_descuento", T.IntegerType()),
    ("dias_pago", T.IntegerType()),
    ("created_at", T.StringType()),
)

ANNEXES = _schema(
    ("anexo_id", T.LongType()),
    ("cliente_id", T.LongType()),
    ("estatus", T.StringType()),
    ("estatus_id", T.IntegerType()),
    ("created_at", T.StringType()),
)

ANNEX_ITEM = _schema(
    ("cant_comision", MONEY),
    ("dias_pago", T.IntegerType()),
    ("fecha_registro", T.StringType()),
)

ANNEX_FEED = _schema(
    ("anexo_id", T.LongType()),
    ("cliente_id", T.LongType()),
    ("jsonb_agg", T.ArrayType(ANNEX_ITEM, True)),
)

CLIENTS = _schema(
    ("cliente_id", T.LongType()),
    ("nombre_fiscal", T.StringType()),
)

USERS = _schema(
    ("id", T.StringType()),
    ("email", T.StringType()),
    ("status", T.StringType()),
    ("license_plates", T.StringType()),
)

USERS_TARGET = _schema(
    ("id", T.LongType()),
    ("id_user_sb", T.StringType()),
    ("email", T.StringType()),
    ("status", T.StringType()),
    ("license_plates", T.StringType()),
)

# Columns that must not be null, per table (and per flattened annex item).
REQUIRED = {
    "invoices": ("factura_id", "cliente_id", "nombre_fiscal", "cant_comision", "tasa_descuento", "dias_pago"),
    "annexes": ("anexo_id", "cliente_id", "estatus", "estatus_id", "created_on"),
    "annex_items": ("anexo_id", "cliente_id", "comision", "dias_pago", "created_at"),
    "clients": ("cliente_id", "nombre_fiscal"),
    "users": ("id", "email"),
    "users_target": ("id", "id_user_sb"),
}
