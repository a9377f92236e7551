"""Input tables read by path, format and options, always with a declared schema.

Parquet and ORC prune columns and push filters down. JSON is read line by line (splittable); one array per file
needs `multiLine=true`, and then each file is one task, so large feeds belong in many files. JDBC takes Spark's
own `url`, `dbtable`, `partitionColumn`, `lowerBound`, `upperBound` and `numPartitions` options.
"""

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions import written_date
from .mixed import read_mixed


@dataclass(frozen=True)
class Table:
    """Where a table lies. `columns` maps our column name to the name in the source, where they differ.

    `mixed` says that the files of a Parquet or ORC table may hold a field in different types; see `sources.mixed`.
    """

    path: str | None = None
    format: str = "parquet"
    options: Mapping[str, str] = field(default_factory=dict)
    columns: Mapping[str, str] = field(default_factory=dict)
    mixed: bool = False


def read(spark: SparkSession, table: Table, schema: T.StructType) -> DataFrame:
    """Read `table` with the columns of `schema`, matched by name; a missing field is null.

    JSON adds `_corrupt_record`, which holds the raw text of rows that do not fit the schema.
    """
    if table.format == "csv":
        raise ValueError("CSV matches columns by position; use JSON, Parquet, ORC or JDBC")
    renamed = T.StructType([T.StructField(table.columns.get(f.name, f.name), f.dataType, True) for f in schema])
    reader = spark.read.format(table.format).options(**table.options)
    text = table.format == "json"
    if text:
        # Spark's JSON reader loses every row when a pushed filter has folded to TRUE, as filters above an outer join
        # with an empty side do. Filters still run right above the scan.
        spark.conf.set("spark.sql.json.filterPushdown.enabled", "false")
        renamed = renamed.add(schemas.CORRUPT, T.StringType(), True)
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", schemas.CORRUPT)
    if table.format == "jdbc":
        # The database declares its types; cast to ours by name.
        df = reader.load()
        return df.select(*[F.col(table.columns.get(f.name, f.name)).cast(f.dataType).alias(f.name) for f in schema])
    if table.mixed:
        if table.format not in ("parquet", "orc"):
            raise ValueError(f"{table.format} files have no types of their own that could differ")
        names = {table.columns.get(f.name, f.name): f.name for f in schema}
        return read_mixed(lambda: spark.read.format(table.format).options(**table.options), table.path, schema, names)
    df = reader.schema(renamed).load(table.path)
    extra = [schemas.CORRUPT] if text else []
    return df.select(*[F.col(table.columns.get(f.name, f.name)).alias(f.name) for f in schema], *extra)


def invoices(spark: SparkSession, table: Table) -> DataFrame:
    return read(spark, table, schemas.INVOICES)


def annexes(spark: SparkSession, table: Table) -> DataFrame:
    """Annex headers, with the creation text turned into the date it was written with."""
    return read(spark, table, schemas.ANNEXES).withColumn("created_on", written_date(F.col("created_at")))


def annex_feed(spark: SparkSession, table: Table) -> DataFrame:
    """Annexes with their nested items; see `operators.annex_items` for the flat form."""
    return read(spark, table, schemas.ANNEX_FEED)


def clients(spark: SparkSession, table: Table) -> DataFrame:
    return read(spark, table, schemas.CLIENTS)


def users(spark: SparkSession, table: Table) -> DataFrame:
    return read(spark, table, schemas.USERS).drop(schemas.WRONG_TYPE)


def users_target(spark: SparkSession, table: Table) -> DataFrame:
    return read(spark, table, schemas.USERS_TARGET).drop(schemas.WRONG_TYPE)


# Which reader serves each input a job names; flat items come out of the nested feed.
_READERS = {"invoices": invoices, "annexes": annexes, "annex_feed": annex_feed, "clients": clients}


def read_all(spark: SparkSession, tables: Mapping[str, Table]) -> dict[str, DataFrame]:
    """The inputs of the jobs, as far as `tables` says where they lie."""
    return {name: reader(spark, tables[name]) for name, reader in _READERS.items() if name in tables}
