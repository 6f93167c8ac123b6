"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows of one part of a table that a fit passes over; its vectors take some hundred megabytes in memory.
ROWS_PER_PART = 1_000_000

_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(app_name: str = "farekit", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution, skew-join splitting and UTC dates.

    Names in ``conf`` use ``__`` for dots: ``spark__driver__memory="8g"``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in _SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``; on one machine also a folder of the warehouse.

    A cluster without the setting is refused: its warehouse may be the driver's own folder.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not configured and not (sc.master == "local" or sc.master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    folder = configured or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_farekit"
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(folder)
    return folder.rstrip("/")


_scopes: list[list[str]] = []


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Remove, at the end, whatever was staged inside. For jobs: their results are written elsewhere."""
    paths: list[str] = []
    _scopes.append(paths)
    try:
        yield
    finally:
        _scopes.remove(paths)
        configuration = spark.sparkContext._jsc.hadoopConfiguration()
        for path in paths:
            place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(configuration).delete(place, True)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path for one table or model in the shared folder."""
    app = spark.sparkContext.applicationId
    path = f"{shared_dir(spark)}/farekit/{app}/{label}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    return path


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stage(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Write an aggregated table to the shared folder and read it back.

    This cuts the lineage durably, so later stages survive lost executors,
    and it gives the optimizer the table's true size. A small table is then
    broadcast under ``spark.sql.autoBroadcastJoinThreshold``; a larger one
    takes part in a sort-merge join whose two inputs are plain exchanges, the
    shape in which adaptive execution can split a hot key. The shuffles that
    made it go as soon as it is written, not when the driver next collects its garbage.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.options(**options).parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before) if before is not None else spark.conf.unset(_CLEANUP)
    return spark.read.schema(df.schema).parquet(path)


def stage_by_key(df: DataFrame, label: str, key: str) -> DataFrame:
    """Stage a table that several passes of a fit will read, dealt out evenly by its key."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return stage(df.repartition(parts, key), label)


def stage_bucketed(df: DataFrame, label: str, key: str, parts: int | None = None) -> DataFrame:
    """Stage a table bucketed by a key, for joins and cogroups by it that then leave its rows where they are.

    The number of buckets is the session's number of shuffle partitions, unless given.
    """
    spark = df.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"farekit_{uuid.uuid4().hex}"
    writer = df.write.format("parquet").bucketBy(parts, key).option("path", scratch_path(spark, label))
    writer.saveAsTable(name)
    try:
        return spark.table(name)
    finally:
        # The catalogue's entry only: the files stay, and what was read from it keeps its layout.
        spark.sql(f"DROP TABLE {name}")


@contextmanager
def even_parts(df: DataFrame) -> Iterator[DataFrame]:
    """All rows in equal parts, as many as the cores or a multiple of them, kept on disk for the passes of a fit.

    Files are read back in parts by size, whose number the cores need not
    divide: 16 parts on 12 cores take two turns in every round of a fit. Rows
    and their order in a part follow from the rows and the number of cores
    alone, so a part that is made again is the same, and so is what a bagged
    tree samples.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    turns = max(1, -(-df.count() // (cores * ROWS_PER_PART)))
    dealt = df.repartition(cores * turns, *df.columns)
    dealt = dealt.sortWithinPartitions(F.xxhash64(*df.columns), *df.columns).persist(StorageLevel.DISK_ONLY)
    try:
        yield dealt
    finally:
        dealt.unpersist()
