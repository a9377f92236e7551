"""Input contract and preview."""

from collections.abc import Sequence
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..schemas import CORRUPT, WRONG_TYPE
from ..session import shared_folder


def _reason(df: DataFrame, required: Sequence[str]) -> Column:
    """Why a row breaks the contract, or null. Unreadable text is named first, then wrong types, then missing fields."""
    checks = [F.when(F.col(CORRUPT).isNotNull(), "unreadable")] if CORRUPT in df.columns else []
    if WRONG_TYPE in df.columns:  # such a value was read as null
        checks += [F.when(F.array_contains(WRONG_TYPE, name), f"wrong type {name}") for name in required]
    checks += [F.when(F.col(name).isNull(), f"missing {name}") for name in required]
    return F.coalesce(*checks, F.lit(None).cast("string"))


def _accepted(df: DataFrame, required: Sequence[str]) -> DataFrame:
    # Spelled as plain null tests, so that they reach the scan.
    for name in required:
        df = df.where(F.col(name).isNotNull())
    df = df.where(F.col(CORRUPT).isNull()) if CORRUPT in df.columns else df
    return df.drop(CORRUPT, WRONG_TYPE)


def split_contract(df: DataFrame, required: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows that keep the contract, and the others with the `reason`.

    `required` lists the fields the job uses. Both frames are lazy, so a job that only uses the first pays one scan.
    """
    valid = _accepted(df, required)
    rejects = df.withColumn("reason", _reason(df, required)).where(F.col("reason").isNotNull())
    return valid, rejects


def enforce_contract(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Strict form: the first bad row that is read fails the job."""
    reason = _reason(df, required)
    failed = F.raise_error(F.concat(F.lit("input contract broken: "), reason)).cast("boolean")
    return df.where(F.when(reason.isNull(), True).otherwise(failed)).drop(CORRUPT, WRONG_TYPE)


def split_once(
    df: DataFrame, required: Sequence[str], name: str, wanted: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame, Observation]:
    """Like `split_contract`, out of one read of `df`: rows and rejects are written side by side to the shared folder.

    Rows that only lack one of the `wanted` fields are accepted and among the rejects, as some figures leave them out. The
    observation holds rows per reason and those `accepted`, counted as they are written.
    """
    reason = _reason(df, [*required, *(w for w in wanted if w not in required)])
    whole = _reason(df, required).isNull()
    marked = df.withColumns({"reason": reason, "accepted": whole})
    fields = dict.fromkeys((*required, *wanted))
    reasons = ["unreadable", *[f"{kind} {f}" for kind in ("wrong type", "missing") for f in fields]]
    seen = Observation()
    counts = [F.count_if(F.col("reason") == r).alias(r) for r in reasons]
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid4()}"
    marked.observe(seen, F.count_if("accepted").alias("accepted"), *counts).write.partitionBy("accepted").parquet(path)
    stored = df.sparkSession.read.schema(marked.schema).parquet(path)
    rows = stored.where(F.col("accepted")).drop("accepted", "reason", CORRUPT, WRONG_TYPE)
    return rows, stored.where(F.col("reason").isNotNull()).drop("accepted"), seen


def reject_counts(df: DataFrame, required: Sequence[str]) -> DataFrame:
    _, rejects = split_contract(df, required)
    return rejects.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def preview(df: DataFrame, fraction: float = 0.5, rows: int = 10, seed: int | None = None) -> DataFrame:
    """A few random rows to look at."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed).limit(rows)


def _drawn(df: DataFrame, rows: int, seed: int) -> list[Column]:
    """Draws with replacement among the distinct rows: each is the row with the greatest hash of its own."""
    whole = F.struct(*df.columns)
    return [F.max_by(whole, F.xxhash64(F.lit(seed + i), *df.columns)).alias(f"row_{i}") for i in range(rows)]


def drawn_rows(df: DataFrame, rows: int = 10, seed: int = 0) -> DataFrame:
    """`rows` random rows, from one aggregation of fixed size; none of an empty frame."""
    picked = df.agg(*_drawn(df, rows, seed))
    return picked.select(F.inline(F.filter(F.array(*picked.columns), lambda row: row.isNotNull())))


def previewed(df: DataFrame, seen: Observation, rows: int = 10, seed: int = 0) -> DataFrame:
    """`df`, whose next action also leaves random rows of it in `seen`: the preview rides on the job's own scan."""
    return df.observe(seen, *_drawn(df, rows, seed))


def preview_of(seen: Observation) -> list[dict]:
    """The distinct rows that `previewed` left."""
    rows = [row.asDict() for row in seen.get.values() if row is not None]
    return [row for i, row in enumerate(rows) if row not in rows[:i]]
