"""Tables in the folder that all machines share: what cuts a plan, lives as long as it is needed, and survives lost executors."""

from __future__ import annotations

import json
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_OPEN = threading.local()
_LOCAL: dict[str, str] = {}
_MADE: set[str] = set()


def top_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; only a session on one machine (local) may leave that unset and gets a folder of its own."""
    top = spark.conf.get("spark.checkpoint.dir", None)
    if top:
        return top.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL:
        _LOCAL[app] = "file://" + tempfile.mkdtemp(prefix="rosterloom-")
    return _LOCAL[app]


def _session_folder(spark: SparkSession) -> str:
    """The session's own folder below the shared one, which goes when the session's JVM ends."""
    path = f"{top_folder(spark)}/rosterloom-{spark.sparkContext.applicationId}"
    if path not in _MADE:
        fs, at = _fs(spark, path)
        fs.mkdirs(at)
        fs.deleteOnExit(at)
        _MADE.add(path)
    return path


def shared_dir(spark: SparkSession, name: str = "table") -> str:
    """The name of a new folder that all machines share. It goes with the innermost open `scratch`, or else with the session."""
    path = f"{_session_folder(spark)}/{name}-{uuid.uuid4().hex}"
    folders = getattr(_OPEN, "folders", None)
    if folders:
        folders[-1].append(path)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Folders that are named inside go when the block ends, well or badly: what is to stay is written before that to a folder named outside."""
    folders = vars(_OPEN).setdefault("folders", [])
    folders.append([])
    try:
        yield
    finally:
        for path in folders.pop():
            delete(spark, path)


def written(df: DataFrame, *parts: str, path: str | None = None) -> DataFrame:
    """df as a table in the shared folder: later steps read it instead of running its plan again, and lost executors take nothing with them."""
    spark = df.sparkSession
    path = path or shared_dir(spark)
    out = df.write.option("compression", "zstd")
    (out.partitionBy(*parts) if parts else out).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# small files -------------------------------------------------------------------------------------


def _fs(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def delete(spark: SparkSession, path: str) -> bool:
    fs, at = _fs(spark, path)
    return fs.delete(at, True)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder, none if it isn't there."""
    fs, at = _fs(spark, path)
    return sorted(x.getPath().getName() for x in fs.listStatus(at)) if fs.exists(at) else []


def put_json(spark: SparkSession, path: str, value) -> None:
    put_bytes(spark, path, json.dumps(value).encode())


def put_bytes(spark: SparkSession, path: str, data: bytes) -> None:
    """A small file, there whole or not at all: written beside its place and renamed."""
    fs, at = _fs(spark, path)
    _, beside = _fs(spark, f"{path}.{uuid.uuid4().hex}.tmp")
    out = fs.create(beside, True)
    try:
        out.write(bytearray(data))
    finally:
        out.close()
    if fs.exists(at):
        fs.delete(at, False)
    if not fs.rename(beside, at):
        raise OSError(f"{path} can't be put in place")


def get_json(spark: SparkSession, path: str):
    rows = spark.read.text(path, wholetext=True).select(F.col("value")).collect()
    return json.loads(rows[0][0])
