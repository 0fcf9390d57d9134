"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(app: str = "tideline", cores: str | int = "*", **conf: str) -> SparkSession:
    """A local session with the settings the library is tested with."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.shuffle.partitions", "8")
        # The JVM never compiles methods above 8000 bytes, so larger generated ones are slow.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of its own; on a cluster a
    machine-local path would be lost with its executor, so that is refused.
    """
    sc = spark.sparkContext
    base = spark.conf.get(CHECKPOINT_KEY, None) or sc.getCheckpointDir()
    if base:
        return base
    if not sc.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder every executor can reach")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="tideline-"))
    return sc.getCheckpointDir()


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/tideline/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame once to the shared folder and read it back.

    Later uses scan the result instead of repeating the work, also after lost executors,
    and Spark knows its true size when it chooses how to join it.
    """
    path = owned(fresh_path(df.sparkSession, name))
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_written: list[list[str]] = []


def owned(path: str) -> str:
    """Have the innermost ``scratch`` block, if there is one, remove this path."""
    if _written:
        _written[-1].append(path)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Remove on leaving what was stored for intermediate use inside.

    Results are lazy and read those copies, so they must be written or collected before
    the block ends. Blocks may be nested; each removes its own.
    """
    _written.append([])
    try:
        yield
    finally:
        for path in _written.pop():
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
