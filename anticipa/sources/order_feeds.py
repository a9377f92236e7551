"""The inputs derived from a star schema of orders, for tests and benches.

Every source table is read whole; the edge cases come from the values:

* orders in status P belong to prospects, so their client is not in the client table;
* suppliers are clients that have not financed anything;
* a term grows with quantity and discount, from below zero to far beyond the last bucket;
* a line returned gives an annex page with a null or an empty item list, an accepted one a page with two items;
* copies of dashboard rows and of sync targets come from adding tables whose keys overlap.
"""

from datetime import date
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import CLIENT_PREFIX, TERM_BUCKETS, written_date
from ..schemas import MONEY

AS_OF = date(2001, 8, 1)

# Workflow status by order priority.
_STATUS_BY_PRIORITY = (("1-URGENT", 9), ("2-HIGH", 10), ("3-MEDIUM", 4), ("4-NOT SPECIFIED", 5))


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _client_of_order() -> Column:
    prospect = F.col("o_orderstatus") == "P"
    return F.when(prospect, -1 - F.col("o_custkey")).otherwise(F.col("o_custkey") * 2)


def _hundredths(name: str) -> Column:
    return F.rint(F.col(name) * 100).cast("long")


def _commission(rate: str) -> Column:
    """Price times rate, exact: the doubles hold hundredths, whose product is counted in whole ten-thousandths."""
    units = _hundredths("l_extendedprice") * _hundredths(rate)
    return (units.cast("decimal(18,0)") * Decimal("0.0001")).cast(MONEY)


def _rate() -> Column:
    return _hundredths("l_discount").cast("int")


def _days() -> Column:
    return F.floor(F.col("l_quantity") * 5 / 2).cast("int") + _rate() - 5


def _line_columns() -> list[Column]:
    return [
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("factura_id"),
        _commission("l_tax").alias("cant_comision"),
        _rate().alias("tasa_descuento"),
        _days().alias("dias_pago"),
    ]


def _holders(spark: SparkSession, folder: str) -> DataFrame:
    return _table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"),
        _client_of_order().alias("cliente_id"),
        F.col("o_orderdate").cast("string").alias("created_at"),
    )


def clients(spark: SparkSession, folder: str) -> DataFrame:
    customers = _table(spark, folder, "customer").select(
        (F.col("c_custkey") * 2).alias("cliente_id"), F.col("c_name").alias("nombre_fiscal")
    )
    suppliers = _table(spark, folder, "supplier").select(
        (F.col("s_suppkey") * 2 + 1).alias("cliente_id"), F.col("s_name").alias("nombre_fiscal")
    )
    return customers.unionByName(suppliers)


def invoice_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Invoices without their client, for figures of the whole portfolio: one narrow scan."""
    return _table(spark, folder, "lineitem").select(*_line_columns())


def invoices(spark: SparkSession, folder: str) -> DataFrame:
    lines = _table(spark, folder, "lineitem").select("l_orderkey", *_line_columns())
    return lines.join(_holders(spark, folder), "l_orderkey").select(
        "factura_id",
        "cliente_id",
        F.concat(F.lit("Cliente "), F.col("cliente_id")).alias("nombre_fiscal"),
        "cant_comision",
        "tasa_descuento",
        "dias_pago",
        "created_at",
    )


def annexes(spark: SparkSession, folder: str) -> DataFrame:
    status = F.coalesce(
        *[F.when(F.col("o_orderpriority") == name, code) for name, code in _STATUS_BY_PRIORITY], F.lit(1)
    )
    written = F.concat(F.col("o_orderdate").cast("date").cast("string"), F.lit("T23:30:00-08:00"))
    return (
        _table(spark, folder, "orders")
        .select(
            F.col("o_orderkey").alias("anexo_id"),
            _client_of_order().alias("cliente_id"),
            F.col("o_orderpriority").alias("estatus"),
            status.alias("estatus_id"),
            written.alias("created_at"),
        )
        .withColumn("created_on", written_date(F.col("created_at")))
    )


def _items() -> Column:
    """Nested items of one page; nothing is grouped to build them, so no annex can grow without bound."""
    shipped = F.col("l_shipdate").cast("date").cast("string").alias("fecha_registro")
    first = F.struct(_commission("l_tax").alias("cant_comision"), _days().alias("dias_pago"), shipped)
    second = F.struct(_commission("l_discount").alias("cant_comision"), (_days() - 30).alias("dias_pago"), shipped)
    returned = F.col("l_returnflag") == "R"
    return (
        F.when(returned & (F.col("l_linestatus") == "F"), F.lit(None))
        .when(returned, F.array())
        .when(F.col("l_returnflag") == "A", F.array(first, second))
        .otherwise(F.array(first))
    )


def annex_pages(spark: SparkSession, folder: str) -> DataFrame:
    """The nested feed without the client, for figures of the whole portfolio: one narrow scan."""
    return _table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("anexo_id"), _items().alias("jsonb_agg"))


def annex_feed(spark: SparkSession, folder: str) -> DataFrame:
    # The nested arrays are built after the join, so that only their plain ingredients are shuffled.
    lines = _table(spark, folder, "lineitem").join(_holders(spark, folder), "l_orderkey")
    return lines.select(F.col("l_orderkey").alias("anexo_id"), "cliente_id", _items().alias("jsonb_agg"))


def loose_annex_feed(spark: SparkSession, folder: str) -> DataFrame:
    """The nested feed with fields missing: no date on any item, no term in discounts over 5 %, no commission if tax-free."""
    lines = _table(spark, folder, "lineitem").join(_holders(spark, folder), "l_orderkey")
    item = F.struct(
        F.when(F.col("l_tax") > 0, _commission("l_tax")).alias("cant_comision"),
        F.when(_rate() <= 5, _days()).alias("dias_pago"),
        F.lit(None).cast("string").alias("fecha_registro"),
    )
    return lines.select(F.col("l_orderkey").alias("anexo_id"), "cliente_id", F.array(item).alias("jsonb_agg"))


def loose_invoices(spark: SparkSession, folder: str) -> DataFrame:
    """Invoices as they may arrive, with fields missing: no rate on returned lines, no term on tax-free ones."""
    lines = _table(spark, folder, "lineitem").select("l_returnflag", "l_tax", *_line_columns())
    return (
        lines.withColumn("tasa_descuento", F.when(F.col("l_returnflag") != "R", F.col("tasa_descuento")))
        .withColumn("dias_pago", F.when(F.col("l_tax") > 0, F.col("dias_pago")))
        .drop("l_returnflag", "l_tax")
    )


def users(spark: SparkSession, folder: str) -> DataFrame:
    """Customers, suppliers, and nations whose ids repeat some customers' ids."""
    customers = _table(spark, folder, "customer").select(
        F.concat(F.lit("U-"), F.col("c_custkey")).alias("id"),
        F.lower("c_name").alias("email"),
        F.col("c_mktsegment").alias("status"),
        F.when(F.col("c_mktsegment") != "HOUSEHOLD", F.concat(F.lit("PL"), F.col("c_custkey"))).alias("license_plates"),
    )
    suppliers = _table(spark, folder, "supplier").select(
        F.concat(F.lit("P-"), F.col("s_suppkey")).alias("id"),
        F.lower("s_name").alias("email"),
        F.lit(None).cast("string").alias("status"),
        F.concat(F.lit("PS"), F.col("s_suppkey")).alias("license_plates"),
    )
    nations = _table(spark, folder, "nation").select(
        F.concat(F.lit("U-"), F.col("n_nationkey")).alias("id"),
        F.lower("n_name").alias("email"),
        F.lit(None).cast("string").alias("status"),
        F.lit(None).cast("string").alias("license_plates"),
    )
    return customers.unionByName(suppliers).unionByName(nations)


def users_target(spark: SparkSession, folder: str) -> DataFrame:
    """Parts, and suppliers whose ids repeat some parts' ids."""
    parts = _table(spark, folder, "part").select(
        (F.col("p_partkey") * 2).alias("id"),
        F.concat(F.lit("U-"), F.col("p_partkey")).alias("id_user_sb"),
        F.col("p_name").alias("email"),
        F.col("p_brand").alias("status"),
        F.col("p_type").alias("license_plates"),
    )
    suppliers = _table(spark, folder, "supplier").select(
        (F.col("s_suppkey") * 2 + 1).alias("id"),
        F.concat(F.lit("U-"), F.col("s_suppkey")).alias("id_user_sb"),
        F.col("s_name").alias("email"),
        F.lit("OLD").alias("status"),
        F.lit(None).cast("string").alias("license_plates"),
    )
    return parts.unionByName(suppliers)


def users_target_unreadable(spark: SparkSession, folder: str) -> DataFrame:
    """The same with row ids that could not be read: parts of brand 13, of which some users have other rows, some none."""
    target = users_target(spark, folder)
    return target.withColumn("id", F.when(F.col("status") != "Brand#13", F.col("id")))


def _at(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def credit_days_state(spark: SparkSession, folder: str) -> DataFrame:
    """A dashboard as earlier refreshes left it: history, today's rows, copies, and keys no longer computed."""
    customer = _table(spark, folder, "customer")
    key = F.concat(F.lit(CLIENT_PREFIX), F.col("c_custkey") * 2).alias("id_analisis")
    building = F.col("c_mktsegment") == "BUILDING"
    recent = building | (F.col("c_mktsegment") == "MACHINERY")
    first = customer.select(
        (F.col("c_custkey") * 4).alias("id"),
        key,
        F.upper("c_name").alias("cliente"),
        F.lit(-1.0).alias("dias_promedio"),
        F.when(recent, _at("2001-08-01 09:00:00")).otherwise(_at("2001-07-31 09:00:00")).alias("created_at"),
    )
    again = customer.select(
        (F.col("c_custkey") * 4 + 1).alias("id"),
        key,
        F.upper("c_name").alias("cliente"),
        F.lit(-2.0).alias("dias_promedio"),
        F.when(building, _at("2001-08-01 10:00:00")).otherwise(_at("2001-08-02 00:00:00")).alias("created_at"),
    )
    supplier = _table(spark, folder, "supplier")
    gone = F.concat(F.lit(CLIENT_PREFIX), F.col("s_suppkey") * 2 + 1).alias("id_analisis")
    vanished = [
        supplier.select(
            (F.col("s_suppkey") * 4 + 2 + copy).alias("id"),
            gone,
            F.col("s_name").alias("cliente"),
            F.lit(-3.0).alias("dias_promedio"),
            _at("2001-08-01 00:00:00").alias("created_at"),
        )
        for copy in (0, 1)
    ]
    return first.unionByName(again).unionByName(vanished[0]).unionByName(vanished[1])


def pareto_state(spark: SparkSession, folder: str) -> DataFrame:
    """Today's Pareto groups: of each customer one under its former name, and one at a rate it may no longer have."""
    customer = _table(spark, folder, "customer")
    key = F.col("c_custkey") * 2

    def groups(row: Column, name: Column, rate: Column) -> DataFrame:
        return customer.select(
            row.alias("id"), F.concat(F.lit(CLIENT_PREFIX), key).alias("id_analisis"), name.alias("cliente"),
            rate.alias("tasa_cliente"), F.lit(-1).cast("decimal(28,4)").alias("importe"),
        )

    former = groups(key, F.col("c_name"), F.lit(3))
    return former.unionByName(groups(key + 1, F.concat(F.lit("Cliente "), key), F.col("c_nationkey")))


def billed_by_term_state(spark: SparkSession, folder: str) -> DataFrame:
    """An earlier chart table: one row per order, its priority standing for a bucket, so most keys have copies."""
    labels = [label for label, *_ in TERM_BUCKETS]
    priorities = [name for name, _ in _STATUS_BY_PRIORITY]
    bucket = F.coalesce(
        *[F.when(F.col("o_orderpriority") == p, label) for p, label in zip(priorities, labels)], F.lit(labels[-1])
    )
    return _table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.concat(F.lit(CLIENT_PREFIX), _client_of_order()).alias("id_analisis"),
        F.lit("antes").alias("cliente"),
        bucket.alias("dias"),
        F.lit(-1).cast("decimal(28,4)").alias("total_facturado"),
        F.when(F.col("o_orderstatus") == "O", _at("2001-07-31 12:00:00"))
        .otherwise(_at("2001-08-01 12:00:00"))
        .alias("created_at"),
    )
