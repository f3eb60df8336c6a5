"""Places that every executor can reach, taken from the running session."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The shared folder that the cluster names in ``spark.checkpoint.dir``.

    Only a local session that names none gets a folder of its own, as in tests.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    if not context.getCheckpointDir():
        context.setCheckpointDir(tempfile.mkdtemp(prefix="strataline-"))
    return context.getCheckpointDir()


#: Removes the shuffle files of a query when it ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


#: Bounds what a Python worker gets at once, for rows that hold whole texts or sets.
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
_WHILE_WRITING = {_CLEANUP: "true", _BATCH: "8m"}


def materialise(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder once and read it back: cuts lineage, survives lost executors.

    With ``by`` each value of that column has a folder of its own, which tasks can read by files.read_part().
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    before = {k: spark.conf.get(k, None) for k in _WHILE_WRITING}
    try:
        for k, v in _WHILE_WRITING.items():
            spark.conf.set(k, v)
        (df.write.partitionBy(by) if by else df.write).parquet(path)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    out = spark.read.schema(df.schema).parquet(path)
    if by:  # it comes last
        out = out.select(*df.columns)
    out.__dict__["_written_to"] = path
    return out


def written_to(df: DataFrame) -> str:
    """The folder of a table that materialise() wrote."""
    return df.__dict__["_written_to"]


def discard(*tables: DataFrame) -> None:
    """Delete tables that materialise() wrote and that nothing will read again."""
    for df in tables:
        context = df.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(written_to(df))
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
