"""Session defaults and the shared folder that cuts lineage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Only for local sessions that name no folder: there, driver and executors are one process.
LOCAL_FOLDER = "file:/tmp/checkpoints/gridtally"

# Rows of text that go to Python at a time.
TEXT_ROWS = 1000
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_passing: list[list[str]] = []


def build_session(app: str = "gridtally", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators expect; `conf` wins over the defaults."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # lets the CSV reader take Korean code pages (CP949, EUC-KR)
        "spark.sql.legacy.javaCharsets": "true",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def text_batches(spark: SparkSession) -> None:
    """Have this session send few rows to Python at a time, from now on.

    Spark's 10,000 are made for numbers. Of long texts they are tens of MB, of which JVM and Python hold several
    copies for each core. A session that asks for fewer rows keeps them; no result depends on it.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= TEXT_ROWS:
        spark.conf.set(name, str(TEXT_ROWS))


@contextmanager
def passing_shuffles(spark: SparkSession) -> Iterator[None]:
    """What a run inside has shuffled is removed when that run ends, not when the driver next collects garbage.

    For runs whose result is a copy or on the driver: shuffled files of steps long done would else lie beside it.
    """
    before = spark.conf.get(SHUFFLES_GO, None)
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLES_GO)
        else:
            spark.conf.set(SHUFFLES_GO, before)


def scratch_root(spark: SparkSession) -> str:
    """This application's folder below the one that the cluster names in spark.checkpoint.dir."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local") or "cluster" in spark.sparkContext.master:
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        root = LOCAL_FOLDER
    return f"{root.rstrip('/')}/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write `df` once to the shared folder and read it back.

    The copy survives lost executors, is read column by column, and its file size lets the
    planner decide whether a join side is small enough to broadcast. `release` removes it.
    """
    path = scratch_path(df.sparkSession, label)
    for made in _passing:
        made.append(path)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder that `scratch_path` has named; one that is gone is no matter."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def folders(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a pattern with stars, on any file system that Spark reads."""
    pattern = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    found = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(pattern)
    return [str(f.getPath()) for f in found or []]


def release(*frames: DataFrame) -> None:
    """Remove copies made by `materialize`; nothing that still reads them may be run afterwards."""
    for df in frames:
        remove(df.sparkSession, df._scratch_path)


@contextmanager
def passing_copies(spark: SparkSession) -> Iterator[list[str]]:
    """Copies that `materialize` makes inside are removed at the end; results must be written by then.

    Yields their paths so far; one that is taken out of the list stays.
    """
    made: list[str] = []
    _passing.append(made)
    try:
        yield made
    finally:
        _passing[:] = [paths for paths in _passing if paths is not made]
        for path in made:
            remove(spark, path)


def release_all(spark: SparkSession) -> None:
    """Remove every copy this application has made, once its results have been read."""
    remove(spark, scratch_root(spark))
