"""Session settings and the shared folder that jobs may cut lineage into."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NullType


def local_session(cores: str = "*", app: str = "snapledger", **conf: str) -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_LOCAL_FOLDERS: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: on a cluster a
    machine-local folder would be lost together with its executor.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[app] = tempfile.mkdtemp(prefix="spark-snapledger-", dir="/tmp")
    return _LOCAL_FOLDERS[app]


_OPEN = threading.local()


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Owns what ``cut`` writes meanwhile, and deletes it at the end: for work that itself ends with a write.

    Tables that are cut outside of any such block belong to whoever reads the result, and stay in the shared folder.
    """
    owned: list[str] = []
    outer, _OPEN.owned = getattr(_OPEN, "owned", None), owned
    try:
        yield
    finally:
        _OPEN.owned = outer
        for path in owned:
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def cut(df: DataFrame) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, read by column, and no retry replays what came before it."""
    spark, path = df.sparkSession, f"{shared_dir(df.sparkSession)}/cut-{uuid.uuid4().hex}"
    empty = {f.name: f.dataType for f in df.schema.fields if isinstance(f.dataType, NullType)}
    held = df.drop(*empty) if empty else df
    held.write.parquet(path)
    if getattr(_OPEN, "owned", None) is not None:
        _OPEN.owned.append(path)
    found = spark.read.schema(held.schema).parquet(path)
    return found.withColumns({c: F.lit(None) for c in empty}).select(*df.columns) if empty else found
