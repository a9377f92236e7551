"""Day-snapshot merge of computed rows into a dashboard table, as set operations.

For one day and a natural key (analysis id, and the bucket or rate where the table has one):

* rows of other days are history and never touched;
* key computed and present: of its rows, the one with the smallest id is updated and keeps its `created_at`; the other
  copies are deleted;
* key only computed: inserted;
* key only present: all its rows are kept, unless the table names an owner of groups (`replaced`) and the owner was
  computed anew: then the rows are groups it no longer has, and are deleted.

Copies of one key may be many, so they are never brought together whole: the day is read and dealt once, by key and a
slice of the ids; the first row of a key is a map-side combined minimum, and each slice meets the computed row by itself.
"""

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions import day_window
from ..session import written

# A power of two: a key that holds most of the day's rows is dealt out as this many slices.
_SLICES = 1024


@dataclass(frozen=True)
class Dashboard:
    """A dashboard table. An update refreshes the measures; the client label stays that of the day's first row."""

    name: str
    keys: tuple[str, ...]
    measures: tuple[str, ...]
    replaced: tuple[str, ...] = ()

    @property
    def columns(self) -> tuple[str, ...]:
        label = () if "cliente" in self.keys else ("cliente",)
        return ("id", *self.keys, *label, *self.measures, "created_at")


def todays_rows(state: DataFrame, as_of: date) -> DataFrame:
    """Rows of the day, by the partition column where the table has one, else by creation time."""
    if "snapshot_date" in state.columns:
        return state.where(F.col("snapshot_date") == F.lit(as_of))
    return state.where(day_window(F.col("created_at"), as_of))


def _matched(
    computed: DataFrame, today: DataFrame, keys: Sequence[str], slices: int, replaced: Sequence[str] = ()
) -> DataFrame:
    """Every row of today next to the computed row of its key, and the computed rows that have none.

    Computed keys are never null. Rows of today with a null key, which another writer may have left, are kept. Each frame
    is read once, so no job or scan runs twice. Adds today's other columns as `_old_<name>` and the `action`; the caller
    has to use all of them, or both uses of the day are pruned to different columns and share nothing. With `replaced`
    the computed frame is used twice, so it is written to the shared folder first.
    """
    keys = list(keys)
    if replaced:
        computed = written(computed, "computed")
    old = {c: F.col(c).alias(f"_old_{c}") for c in today.columns if c not in keys}
    # The one shuffle of the day's rows. Both uses below take all of its columns, so that they share it and its scan.
    dealt = today.select(
        *keys, *old.values(), F.xxhash64("id").bitwiseAND(F.lit(slices - 1)).alias("_slice")
    ).repartition(*keys, "_slice")
    whole = F.struct(F.col("_old_id").isNull().alias("last"), "_old_id", *[f"_old_{c}" for c in old if c != "id"])
    present = (
        dealt.groupBy(*keys, "_slice").agg(F.min(whole).alias("_first"))
        .groupBy(*keys).agg(F.min("_first").alias("_first"), F.collect_set("_slice").alias("_slices"))  # `slices` at most
        .select(*keys, "_slices", F.col("_first._old_id").alias("_survivor"), F.lit(True).alias("_present"))
    )
    # One row per slice that the key has rows in; a key that is not present has one, which no row is in.
    per_slice = (
        computed.withColumn("_computed", F.lit(True))
        .join(present, keys, "full")
        .withColumn("_slice", F.explode(F.coalesce(F.col("_slices"), F.array(F.lit(0).cast("long")))))
        .drop("_slices")
    )
    # A null key finds neither its computed row nor itself: its rows come out alone.
    matched = per_slice.join(dealt.withColumn("_row", F.lit(True)), [*keys, "_slice"], "full").where(
        F.col("_row").isNotNull() | F.col("_present").isNull()
    )
    if replaced:
        owners = computed.select(*replaced).distinct().withColumn("_anew", F.lit(True))
        matched = matched.join(owners, list(replaced), "left")
    else:
        matched = matched.withColumn("_anew", F.lit(False))
    action = (
        F.when(F.col("_computed").isNull(), F.when(F.col("_anew"), "delete").otherwise("keep"))
        .when(F.col("_row").isNull(), "insert")
        .when(F.col("_old_id").eqNullSafe(F.col("_survivor")), "update")
        .otherwise("delete")
    )
    return matched.withColumn("action", action).drop("_anew")


def plan_merge(
    computed: DataFrame,
    today: DataFrame,
    keys: Sequence[str],
    slices: int = _SLICES,
    replaced: Sequence[str] = (),
) -> DataFrame:
    """One row per affected table row: `id` (null on insert), the computed columns, and the `action`."""
    values = [c for c in computed.columns if c not in keys]
    matched = _matched(computed, today.select("id", *keys), keys, slices, replaced)
    return matched.select(F.col("_old_id").alias("id"), *keys, *values, "action")


def _new_id(keys: Sequence[str], as_of: date) -> Column:
    """Stable id for an inserted row. It only has to be unique within its key and day."""
    return F.abs(F.shiftright(F.xxhash64(*keys, F.lit(as_of.isoformat())), 1))


def _merged_rows(computed: DataFrame, today: DataFrame, dashboard: Dashboard, as_of: date) -> DataFrame:
    """The day's rows with their `action`, the deleted ones among them."""
    keys = dashboard.keys
    kept, new = F.col("action") == "keep", F.col("action") == "insert"
    columns = {
        "id": F.coalesce(F.col("_old_id"), _new_id(keys, as_of)),
        **{m: F.when(kept, F.col(f"_old_{m}")).otherwise(F.col(m)) for m in dashboard.measures},
        "created_at": F.coalesce(F.col("_old_created_at"), F.lit(as_of).cast("timestamp_ntz")),
    }
    if "cliente" not in keys:
        columns["cliente"] = F.when(new, F.col("cliente")).otherwise(F.col("_old_cliente"))
    matched = _matched(computed, today.select(*dashboard.columns), keys, _SLICES, dashboard.replaced)
    return matched.select(*[columns.get(c, F.col(c)).alias(c) for c in dashboard.columns], "action")


def _live(merged: DataFrame) -> DataFrame:
    return merged.where(F.col("action") != "delete").drop("action")


def merged_day(computed: DataFrame, today: DataFrame, dashboard: Dashboard, as_of: date) -> DataFrame:
    """The day's rows after the merge."""
    return _live(_merged_rows(computed, today, dashboard, as_of))


def stored_schema(dashboard: Dashboard, types: Mapping[str, str]) -> str:
    """Columns of the dashboard's table; `types` are those of its keys and measures."""
    types = {**types, "id": "bigint", "cliente": "string", "created_at": "timestamp_ntz", "snapshot_date": "date"}
    return ", ".join(f"`{c}` {types[c]}" for c in (*dashboard.columns, "snapshot_date"))


def empty_dashboard(spark: SparkSession, dashboard: Dashboard, types: Mapping[str, str]) -> DataFrame:
    columns = (column.split(" ", 1) for column in stored_schema(dashboard, types).split(", `"))
    return spark.range(0).select(*[F.lit(None).cast(kind).alias(name.strip("`")) for name, kind in columns])


def _stored(spark: SparkSession, computed: DataFrame, dashboard: Dashboard, path: str) -> DataFrame:
    """The dashboard table at `path`, or an empty one before the first refresh."""
    types = {f.name: f.dataType.simpleString() for f in computed.schema}
    try:
        return spark.read.schema(stored_schema(dashboard, types)).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
    return empty_dashboard(spark, dashboard, types)


def merge_counts(computed: DataFrame, today: DataFrame, dashboard: Dashboard, as_of: date) -> tuple[DataFrame, Observation]:
    """The day's rows after the merge, and how many rows each action touches, counted as they are written.

    A task counts once however often it is run.
    """
    counts = [F.count_if(F.col("action") == a).alias(a) for a in ("insert", "update", "delete", "keep")]
    seen = Observation()
    return _live(_merged_rows(computed, today, dashboard, as_of).observe(seen, *counts)), seen


def apply_merge(
    spark: SparkSession, computed: DataFrame, dashboard: Dashboard, path: str, as_of: date
) -> dict[str, int]:
    """Merge `computed` into the table at `path` and return how many rows each action touched.

    One write, of the one day's partition. Files of the day are replaced only when the write commits, so lost
    tasks and executors are re-run against unchanged input. The actions are counted in the writing stage, where a
    task counts once however often it is run.
    """
    today = todays_rows(_stored(spark, computed, dashboard, path), as_of)
    live, seen = merge_counts(computed, today, dashboard, as_of)
    (
        live.withColumn("snapshot_date", F.lit(as_of))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("snapshot_date")
        .parquet(path)
    )
    return dict(seen.get)
