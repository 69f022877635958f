"""Tables written to the shared folder, so that what is read more than once is computed once and survives lost executors."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from snapledger.session import shared_dir


def stored(df: DataFrame) -> DataFrame:
    """``df`` as a parquet table of its own in the shared folder."""
    path = f"{shared_dir(df.sparkSession)}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.stored_path = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``stored`` wrote, once nothing reads them any more."""
    for df in tables:
        jvm = df.sparkSession._jvm
        conf = df.sparkSession._jsc.hadoopConfiguration()
        path = jvm.org.apache.hadoop.fs.Path(df.stored_path)
        path.getFileSystem(conf).delete(path, True)
