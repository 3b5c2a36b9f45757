"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and benches; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("creditweave")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # Call sites of column expressions cost more than small plans do.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for cut lineage, as the cluster names it.

    A machine-local folder is chosen only when nothing is configured *and* the
    session is a single JVM; on a cluster the missing setting is an error.
    """
    sc = spark.sparkContext
    folder = sc.getCheckpointDir()
    if folder is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not sc.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
            folder = tempfile.mkdtemp(prefix="creditweave-")
            # Nobody named it, nobody else knows it: it goes with the process.
            atexit.register(shutil.rmtree, folder, ignore_errors=True)
        sc.setCheckpointDir(folder)
        folder = sc.getCheckpointDir()
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Every later branch then sees the same rows, also after executors are lost,
    reads only the columns it needs, and is planned with the table's real size.
    """
    path = scratch_path(df.sparkSession, "pinned")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Settings that keep down what a job has on disk at once.
LEAN_DISK = {
    # Shuffle files go when their query ends, not when the driver happens to collect garbage.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
}


@contextmanager
def lean_disk(*sessions: SparkSession) -> Iterator[None]:
    """Queries made and run inside leave no shuffle files behind and write Parquet that is packed tighter."""
    before = [(s, name, s.conf.get(name, None)) for s in sessions for name in LEAN_DISK]
    try:
        for session, name, _ in before:
            session.conf.set(name, LEAN_DISK[name])
        yield
    finally:
        for session, name, value in reversed(before):
            session.conf.unset(name) if value is None else session.conf.set(name, value)


def remove(spark: SparkSession, paths: list[str]) -> None:
    """Delete ``paths`` and what is below them, on whatever file system they are."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        folder = jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(conf).delete(folder, True)
