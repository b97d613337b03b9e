"""Session helpers: shared scratch folder and scoped settings."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(
    name: str, cpus: int | str = "*", memory: str = "8g", shared: str | None = None
) -> SparkSession:
    """A session for tests and the benchmark; clusters bring their own.

    ``shared`` is the folder for intermediate data.
    """
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if shared:
        builder = builder.config("spark.checkpoint.dir", shared)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder in its warehouse.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    made = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_shared"
    context.setCheckpointDir(made)
    return made


@contextmanager
def session_conf(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Apply session settings to the actions inside the block, then restore them."""
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def session_like(spark: SparkSession) -> SparkSession:
    """A session of its own with the same settings, catalog and context.

    Settings changed in it, and its temporary views, are not seen by others.
    """
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key):
            own.conf.set(key, value)
    return own


def moved_to(df: DataFrame, session: SparkSession) -> DataFrame:
    """The same rows, computed under another session of the application.

    They pass through a global view, which holds the plan and no data.
    """
    if df.sparkSession is session:
        return df
    name = f"moved_{uuid.uuid4().hex}"
    df.createGlobalTempView(name)
    moved = session.table(f"global_temp.{name}")
    moved.schema  # analysed here, so that the view can go
    session.catalog.dropGlobalTempView(name)
    return moved


@contextmanager
def few_listing_tasks(spark: SparkSession) -> Iterator[None]:
    """List a partitioned table's folders with a few tasks per core.

    By default every folder is a task of its own, and starting it takes longer
    than the listing.
    """
    tasks = 4 * spark.sparkContext.defaultParallelism
    with session_conf(
        spark, {"spark.sql.sources.parallelPartitionDiscovery.parallelism": str(tasks)}
    ):
        yield
