"""What the operators of this subpackage share: the shared folder, kept tables, words, and the tables by name."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Callable
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SMALL = 1_000_000  # rows of two numbers that may go to every executor
KEYS = 4_000_000  # rows of one number

# One folder per driver process below the shared folder, removed when the driver ends.
_RUN = f"txrisk-llm-{uuid.uuid4().hex}"
_FOLDERS: dict[str, str] = {}
# The paths that the innermost ``settled`` deletes.
_WITHIN: ContextVar[list[str] | None] = ContextVar("within", default=None)


def shared_folder(spark: SparkSession) -> str:
    """A folder that the driver and all executors see: below ``spark.checkpoint.dir``; on one machine a temporary one."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        if "" not in _FOLDERS:
            _FOLDERS[""] = "file://" + tempfile.mkdtemp(prefix="txrisk-llm-")
        base = _FOLDERS[""]
    folder = f"{base.rstrip('/')}/{_RUN}"
    if folder not in _FOLDERS:
        _FOLDERS[folder] = folder
        atexit.register(_remove, spark, folder)
    return folder


def _remove(spark: SparkSession, folder: str) -> None:
    # Best effort at the end of the driver; the cluster's own clean-up of the shared folder covers a driver that dies.
    try:
        remove(spark, folder)
    except Exception:  # noqa: BLE001 - the session may be gone already
        pass


def remove(spark: SparkSession, path: str) -> None:
    """Delete a path of the shared folder with whatever file system it is on."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other call gets."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    if (within := _WITHIN.get()) is not None:
        within.append(path)
    return path


def written(df: DataFrame, path: str) -> DataFrame:
    """``df`` written once as a Parquet table at ``path``, and read from there."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as a Parquet table in the shared folder: lineage is cut and lost executors cost a re-read."""
    return written(df, new_path(df.sparkSession, name))


def small(df: DataFrame, rows: int = SMALL) -> DataFrame:
    """``df``, a kept table of two or three numbers or short names a row, to be sent to every executor if it has at most ``rows`` rows."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def settled(spark: SparkSession, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The frame that ``build`` returns, written as a table; all paths made on the way to it are deleted, after an error as well.

    Ended shuffles give their disk back when the driver collects garbage, so that is asked for here instead of twice an hour.
    """
    path, paths = new_path(spark, name), []
    token = _WITHIN.set(paths)
    try:
        return written(build(), path)
    except BaseException:
        paths.append(path)
        raise
    finally:
        _WITHIN.reset(token)
        for used in paths:
            remove(spark, used)
        spark._jvm.System.gc()


def full_uri(path: str) -> str:
    """``path`` with a scheme, as the file systems of pyarrow want it."""
    return path if ":/" in path else f"file://{path}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(df: DataFrame, column: str = "text") -> Column:
    """The column of ``df``; null becomes empty."""
    return F.coalesce(df[column].cast("string"), F.lit(""))
