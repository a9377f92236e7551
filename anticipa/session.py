"""Session settings and the shared working folder."""

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", app: str = "anticipa", **conf: str) -> SparkSession:
    """Session for tests and benches; on a cluster use the session the cluster gives you."""
    settings = {
        "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "8g",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: the one set for the session.

    Only a local session without the setting gets a folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    folder = tempfile.mkdtemp(prefix="anticipa-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def written(df: DataFrame, name: str, **options: str) -> DataFrame:
    """`df` as a table in the shared folder: computed once, and read back instead of recomputed."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid4()}"
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.parquet(path)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the session's queries in here go when each ends, not when the driver happens to collect its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)
