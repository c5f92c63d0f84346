"""Reliable cut of long or reused plans."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder named by the session; only a local session may get its own."""
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return
    shared = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if shared is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        shared = tempfile.mkdtemp(prefix="lexmill-checkpoint-")
    sc.setCheckpointDir(shared)


def cut(df: DataFrame) -> DataFrame:
    """Write the rows to the shared folder and read them back.

    The plan is computed once, later branches scan the files, and a lost executor loses nothing.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir().rstrip('/')}/cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._cut_path = path
    return out


def forget(*frames: DataFrame) -> None:
    """Delete the files of results of ``cut`` that nothing reads any more, such as an earlier round."""
    for df in frames:
        path = getattr(df, "_cut_path", None)
        if path:
            jvm = df.sparkSession._jvm
            target = jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(target, True)
