"""Session settings and the one way this library keeps an intermediate result."""

from __future__ import annotations

import tempfile
import uuid
from types import TracebackType

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

# For tables of tens of terabytes: ``spark_session(**LARGE_TABLES)``. Shuffles start with enough partitions for the largest
# of them (customers times a few values) and adaptive execution merges what turns out small.
LARGE_TABLES = {
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
}


def spark_session(app_name: str = "txrisk", **conf: str) -> SparkSession:
    """A session with the settings every job here relies on; ``conf`` adds to or replaces them."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Recording the call site of every column expression doubles the time to build wide projections.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **conf,
    }
    builder = SparkSession.builder.appName(app_name)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def materialise(df: DataFrame) -> DataFrame:
    """``df``, computed at most once, for results that several later jobs read.

    Where the cluster names a shared folder in ``spark.checkpoint.dir`` the rows become a Parquet table in it: lineage is
    cut, a lost executor costs a re-read, and later jobs prune columns. Elsewhere the frame is persisted (lazily), and
    lost blocks are recomputed from lineage. ``release`` gives the storage back; a table that cannot be written whole leaves
    nothing behind.
    """
    folder = df.sparkSession.conf.get("spark.checkpoint.dir", None)
    if not folder:
        return df.persist(StorageLevel.MEMORY_AND_DISK)
    path = f"{folder.rstrip('/')}/txrisk-{uuid.uuid4().hex}"
    try:
        df.write.parquet(path)
    except BaseException:
        _delete(df.sparkSession, path)
        raise
    made = df.sparkSession.read.schema(df.schema).parquet(path)
    made._scratch_path = path
    _READERS[path] = 1
    return made


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path that the driver and all executors see: below ``spark.checkpoint.dir``; on one machine a temporary folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="txrisk-")
    return f"{folder.rstrip('/')}/txrisk-{name}-{uuid.uuid4().hex}"


def retain(df: DataFrame) -> DataFrame:
    """One more reader of a frame from ``materialise``: it takes one more ``release`` to give it back."""
    path = getattr(df, "_scratch_path", None)
    if path in _READERS:
        _READERS[path] += 1
    return df


def release(df: DataFrame) -> None:
    """Give back a frame from ``materialise``: persisted blocks at once, a table when its last reader releases it.

    Frames derived from it must not be computed afterwards. Any other frame is left alone.
    """
    path = getattr(df, "_scratch_path", None)
    if path in _READERS:
        _READERS[path] -= 1
        if not _READERS[path]:
            del _READERS[path]
            _delete(df.sparkSession, path)
    elif path is None and df.is_cached:
        df.unpersist()


class Scratch:
    """Owner of the intermediate results of a job, which end with it: ``with Scratch() as own: table = own.keep(df)``.

    All that it has kept is released at its end, also after an error, the latest first. ``retain`` a frame that lives on.
    """

    def __init__(self) -> None:
        self._kept: list[DataFrame] = []

    def keep(self, df: DataFrame) -> DataFrame:
        self._kept.append(materialise(df))
        return self._kept[-1]

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, kind: type[BaseException] | None, error: BaseException | None, trace: TracebackType | None) -> None:
        while self._kept:
            release(self._kept.pop())


# How many readers each table of ``materialise`` has.
_READERS: dict[str, int] = {}


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
