"""Session helpers: table access, the shared checkpoint folder, lineage cuts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cpus: int = 8, partitions: int = 8) -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("adloom")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def file_versions(df: DataFrame) -> list[tuple[str, int, int]]:
    """(path, bytes, time of change) of the files behind a table."""
    out = []
    for path in sorted(df.inputFiles()):
        place, system = _place(df.sparkSession, path)
        status = system.getFileStatus(place)
        out.append((path, status.getLen(), status.getModificationTime()))
    return out


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder all executors share. The session's own setting wins; a folder of
    this machine is made only where nothing is set, as in local tests."""
    context = spark.sparkContext
    present = context._jsc.sc().getCheckpointDir()
    if present.isDefined():
        return present.get()
    wanted = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not wanted:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        wanted = tempfile.mkdtemp(prefix="adloom-checkpoint-")
    context.setCheckpointDir(wanted)
    return wanted


def cut(df: DataFrame) -> DataFrame:
    """Write df as a table in the shared folder and go on from its files: short lineage, safe if executors are lost.

    The shuffles that made df are removed as soon as it is written, so a job of many steps holds the disk of one. The table is removed by
    free(), and what is left when the driver ends.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    delete_at_end(spark, path)
    done = spark.read.schema(df.schema).parquet(path)
    done._written_to = path
    return done


def free(*tables: DataFrame | None) -> None:
    """Remove tables that cut() wrote and nothing reads any more."""
    for t in tables:
        path = getattr(t, "_written_to", None)
        if path:
            place, system = _place(t.sparkSession, path)
            system.delete(place, True)


def delete_at_end(spark: SparkSession, path: str) -> None:
    place, system = _place(spark, path)
    system.deleteOnExit(place)


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())
