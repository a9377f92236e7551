"""Helpers shared by the corpus operators."""

import os
import shutil
import tempfile
from math import ceil
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ship_code(spark: SparkSession) -> None:
    """Let the Python workers import this package: sends it to them once, unless their path has it already."""
    root, context = Path(__file__).parents[2], spark.sparkContext
    if str(root) in os.environ.get("PYTHONPATH", "").split(os.pathsep) or hasattr(context, "_anticipa_sent"):
        return
    folder = tempfile.mkdtemp(prefix="anticipa-code-")  # of the driver, whose file server hands the archive out
    context.addPyFile(shutil.make_archive(f"{folder}/anticipa_code", "zip", root, "anticipa"))
    context._anticipa_sent = True


def ascii_lower(column: Column) -> Column:
    """A-Z in lower case; every other character stays as it is."""
    return F.translate(column, UPPER, LOWER)


def columns_of(df: DataFrame) -> list[Column]:
    """The columns of `df` by name, whatever characters the names hold."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


def running_total(
    df: DataFrame, groups: list[str], key: str, value: Column, name: str, rows_per_slice: int = 100_000
) -> DataFrame:
    """`df` with a column `name`: the sum of `value` over the rows before this one in its group.

    Rows are in no order that means anything; `key` must tell them apart, and `df` must give the same rows whenever
    it is read (a written table). A group is cut into slices by a hash of `key`, about `rows_per_slice` rows
    each, so that a group that holds most rows is still summed by many tasks. Only one total per slice is gathered
    per group. With value 1 this numbers the rows of a group from 0.
    """
    slices = max(1, ceil(df.count() / rows_per_slice))
    sliced = df.withColumns({"_slice": F.pmod(F.xxhash64(key), F.lit(slices)), "_value": value})
    totals = sliced.groupBy(*groups, "_slice").agg(F.sum("_value").alias("_total"))
    before = Window.partitionBy(*groups).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(*groups, "_slice", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_start"))
    within = (
        Window.partitionBy(*groups, "_slice").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    )
    summed = sliced.withColumn("_within", F.coalesce(F.sum("_value").over(within), F.lit(0)))
    return (
        summed.join(starts, [*groups, "_slice"])
        .withColumn(name, (F.col("_start") + F.col("_within")).cast("long"))
        .drop("_slice", "_value", "_start", "_within")
    )
