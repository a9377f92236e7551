"""Full table sync: make the target hold exactly the source's users.

* id in both: update the target row with the smallest row id, delete its copies;
* id only in the source: insert; id only in the target: delete all its rows;
* id more than once in the source, or without the required email: a reject, so the surviving target row is kept as it
  is;
* source rows without an id: rejects too. They may stand for any user, so while there are some, nobody is deleted;
* target rows without a readable row id or user id: kept as they are. A user who has only such rows is not inserted again;
* target rows that could not be read at all are dead letters: their raw text goes to a table of its own.
"""

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..schemas import CORRUPT

_VALUES = ("email", "status", "license_plates")
_OLD = tuple(f"_old_{v}" for v in _VALUES)
# Broken rows are told apart by content only, so that many of them are dealt out over this many tasks.
_SPREAD = 256


def target_ids(target: DataFrame) -> DataFrame:
    """Every user id the target holds, with its copies."""
    return target.select("id_user_sb")


def _by_id(source: DataFrame) -> DataFrame:
    # With a single row the minimum is that row's value, so this needs no second pass over the source.
    return source.groupBy("id").agg(*[F.min(v).alias(v) for v in _VALUES], F.count(F.lit(1)).alias("rows"))


def _fault() -> Column:
    return F.when(F.col("id").isNull(), "missing id").when(F.col("rows") > 1, "repeated id").when(F.col("email").isNull(), "missing email")


def rejected_users(source: DataFrame, target: DataFrame | None = None) -> DataFrame:
    """Source ids the sync leaves alone, with their number of rows and the reason.

    With the `target` also those whose only target rows have no readable row id.
    """
    reason = _fault()
    by_id = source.groupBy("id").agg(F.min("email").alias("email"), F.count(F.lit(1)).alias("rows"))
    if target is not None:
        held = target.groupBy(F.col("id_user_sb").alias("id")).agg(F.count("id").alias("_readable"))
        by_id = by_id.join(held, "id", "left")
        reason = F.coalesce(reason, F.when(F.col("_readable") == 0, "unreadable target row"))
    return by_id.select("id", "rows", reason.alias("reason")).where(F.col("reason").isNotNull())


def _broken() -> Column:
    return F.col("id_user_sb").isNull() | F.col("id").isNull()


def _nothing_read(target: DataFrame) -> Column:
    """Rows of which only the raw text is left."""
    if CORRUPT not in target.columns:
        return F.lit(False)
    empty = F.coalesce(*[F.col(c).cast("string") for c in ("id", "id_user_sb", *_VALUES)]).isNull()
    return F.col(CORRUPT).isNotNull() & empty


def dead_letters(target: DataFrame) -> DataFrame:
    """Raw text of target rows that could not be read, or not in full, with what was read of their ids."""
    if CORRUPT not in target.columns:
        target = target.withColumn(CORRUPT, F.lit(None).cast("string"))
    lost = target.where(F.col(CORRUPT).isNotNull())
    reason = F.when(F.col("id_user_sb").isNull(), "unreadable").when(F.col("id").isNull(), "unreadable row id").otherwise("unreadable field")
    return lost.select("id", "id_user_sb", reason.alias("reason"), F.col(CORRUPT).alias("text"))


def _matched(source: DataFrame, target: DataFrame, old: tuple[str, ...] = _OLD) -> DataFrame:
    """Every target row and every new user with its `action`, the new values and those of the `old` ones asked for.

    No job is started here. The target is shuffled once, on what tells its rows apart; that shuffle serves both the
    survivors and the rows themselves, so a much copied user is no hot key. The source is aggregated once: whether some of
    its ids are null is read off the same aggregate, as a value of the plan.
    """
    copies = target.where(~_nothing_read(target)).select(
        F.col("id_user_sb").alias("id"), F.col("id").alias("target_id"), *[F.col(v).alias(o) for v, o in zip(_VALUES, _OLD)]
    )
    broken = F.col("id").isNull() | F.col("target_id").isNull()
    spread = F.when(broken, F.pmod(F.xxhash64("id", "target_id", *_OLD), F.lit(_SPREAD))).otherwise(F.lit(0).cast("long"))
    held = copies.select("id", "target_id", *old, spread.alias("_spread")).repartition("id", "target_id", "_spread")
    # Whole rows go into the minimum, and the null test stays above it, so that both uses of `held` are the same shuffle.
    survivors = held.groupBy("id").agg(
        F.min(F.when(~broken, F.struct("target_id", *old, "_spread"))).alias("_first"), F.count(F.lit(1)).alias("_copies")
    )
    by_id = _by_id(source)
    some_null = by_id.agg(F.max(F.struct(F.col("id").isNull().alias("none"), *_VALUES, "rows")).alias("last")).select(
        F.coalesce(F.col("last.none"), F.lit(False))
    )
    in_target = F.col("_first").isNotNull()
    action = (
        F.when(F.col("id").isNull(), F.lit(None))
        .when(F.col("rows").isNull(), F.when(in_target, F.when(some_null.scalar(), "keep").otherwise("delete")))
        .when(_fault().isNotNull(), F.when(in_target, "keep"))
        .when(in_target, "update")
        .when(F.col("_copies").isNull(), "insert")
    )
    decided = (
        by_id.join(survivors, "id", "full")
        .withColumn("_action", action)
        .where(F.col("_action").isNotNull())
        .select(
            "id", F.col("_first.target_id").alias("target_id"), F.col("_first._spread").alias("_spread"), "_action",
            *[F.when(F.col("_action").isin("insert", "update"), F.col(v)).alias(v) for v in _VALUES],
        )
    )
    rest = F.when(F.col("id").isNull() | F.col("target_id").isNull(), "keep").otherwise("delete")
    return decided.join(held, ["id", "target_id", "_spread"], "full").select(
        "id", "target_id", F.coalesce("_action", rest).alias("action"), *_VALUES, *old
    )


def plan_sync(source: DataFrame, target: DataFrame) -> DataFrame:
    """One row per affected row: user `id`, `target_id` (null on insert), `action` and the new values."""
    return _matched(source, target, old=())


def _new_id() -> Column:
    return F.abs(F.shiftright(F.xxhash64("id"), 1))


def _after(matched: DataFrame) -> DataFrame:
    new = F.col("action").isin("insert", "update")
    return matched.where(F.col("action") != "delete").select(
        F.when(F.col("action") == "insert", _new_id()).otherwise(F.col("target_id")).alias("id"),
        F.col("id").alias("id_user_sb"),
        *[F.when(new, F.col(v)).otherwise(F.col(o)).alias(v) for v, o in zip(_VALUES, _OLD)],
    )


def synced(actions: DataFrame, target: DataFrame) -> DataFrame:
    """The target's rows after the sync."""
    live = actions.where((F.col("action") == "insert") | (F.col("action") != "delete") & F.col("id").isNotNull() & F.col("target_id").isNotNull())
    old = target.select(
        F.col("id_user_sb").alias("id"), F.col("id").alias("target_id"), *[F.col(v).alias(o) for v, o in zip(_VALUES, _OLD)]
    )
    broken = target.where(_broken() & ~_nothing_read(target))
    return _after(live.join(old, ["id", "target_id"], "left")).unionByName(broken.select("id", "id_user_sb", *_VALUES))


def apply_sync(source: DataFrame, target: DataFrame, path: str, letters: str | None = None) -> dict[str, int]:
    """Write the synced table to a new `path` and return how many rows each action touched.

    The old table stays as it was until readers move on. Unreadable target rows go to the new folder `letters` as JSON,
    first, so that no text is lost; without that folder the first such row fails the job.
    """
    if letters:
        dead_letters(target).write.json(letters)
    elif CORRUPT in target.columns:
        failed = F.raise_error(F.lit("the target has unreadable rows: name a folder for dead letters")).cast("boolean")
        target = target.where(F.when(F.col(CORRUPT).isNull(), True).otherwise(failed))
    counts = [F.count_if(F.col("action") == a).alias(a) for a in ("insert", "update", "delete", "keep")]
    seen = Observation()
    _after(_matched(source, target).observe(seen, *counts)).write.mode("errorifexists").parquet(path)
    return dict(seen.get)
