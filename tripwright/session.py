"""Session defaults the engine relies on."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


# HotSpot does not compile methods above this size; they run interpreted, some ten times slower.
_JIT_METHOD_LIMIT = "8000"
_HUGE_METHOD = "spark.sql.codegen.hugeMethodLimit"
_SPARK_DEFAULT = "65535"


def configure(spark: SparkSession) -> SparkSession:
    """Settings for the engine's wide projections, left alone where the user chose others.

    Text parsing and request scoring generate long code. With the limit at HotSpot's, a stage that
    outgrows it runs operator by operator in methods that do get compiled.
    """
    if spark.conf.get(_HUGE_METHOD, _SPARK_DEFAULT) == _SPARK_DEFAULT:
        spark.conf.set(_HUGE_METHOD, _JIT_METHOD_LIMIT)
    return spark


def local_session(app: str = "tripwright", cpus: int | str = 8, **conf: str) -> SparkSession:
    """Session for tests and benchmarks on one machine; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the one the cluster names in ``spark.checkpoint.dir``.

    Only where that setting is absent on a local master (tests) is a temporary folder made; on a
    cluster an absent setting is an error, since a machine-local folder would lose data.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    made = tempfile.mkdtemp(prefix="tripwright-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


@contextmanager
def stored(frame: DataFrame, label: str) -> Iterator[DataFrame]:
    """The frame as a table in the shared folder, for jobs that read it many times.

    It survives lost executors, and later scans read only the columns and row groups they need. The
    table is dropped on leaving.
    """
    spark = frame.sparkSession
    path = new_workspace(spark, label)
    frame.write.parquet(path)
    try:
        yield spark.read.parquet(path)
    finally:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def written(frame: DataFrame, label: str) -> DataFrame:
    """The frame as a table in the shared folder that outlives this call, for plans built on it."""
    path = new_workspace(frame.sparkSession, label)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Scratch:
    """Tables in the shared folder that are dropped one by one, or all on leaving, and leave no shuffle files behind."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.paths = spark, {}

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_: object) -> None:
        for frame in [f for f, _ in self.paths.values()]:
            self.drop(frame)

    def written(self, frame: DataFrame, label: str, keep: bool = False) -> DataFrame:
        """The frame as a closely packed table; with ``keep`` it outlives this object."""
        path, before = new_workspace(self.spark, label), self.spark.conf.get(_CLEANUP, None)
        self.spark.conf.set(_CLEANUP, "true")
        try:
            frame.write.option("compression", "zstd").parquet(path)
        finally:
            self.spark.conf.unset(_CLEANUP) if before is None else self.spark.conf.set(_CLEANUP, before)
        table = self.spark.read.schema(frame.schema).parquet(path)
        if not keep:
            self.paths[id(table)] = table, path
        return table

    def drop(self, table: DataFrame) -> None:
        _, path = self.paths.pop(id(table), (None, None))
        if path is not None:
            target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(target, True)


def new_workspace(spark: SparkSession, label: str) -> str:
    """A path no other run uses, under the shared folder."""
    return f"{shared_dir(spark)}/tripwright/{label}-{uuid.uuid4().hex}"

