"""Session settings and the lineage cut used by the iterative operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime settings that keep the operators fast.  All of them may be changed at
# any time by the caller; none of them changes a result.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # packed vector blocks are wide rows: keep the batches sent to Python small
    "spark.sql.execution.arrow.maxBytesPerBatch": "64m",
}


def build_session(app: str = "feedloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings above; on a cluster the master comes from spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names for checkpoints; only local runs may fall back."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    if not spark.sparkContext.master.startswith(("local[", "local*")) and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="feedloom-")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir()


_SCRATCH = "feedloom.scratch"


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """Inside, tables written by `cut` go to a folder of their own, which is deleted at the end, also after an error.

    Use up the results inside, or write them to a table: a DataFrame that reads a cut table cannot be read later on.
    """
    before = spark.conf.get(_SCRATCH, None)
    folder = f"{before or shared_folder(spark)}/scratch-{uuid.uuid4().hex}"
    spark.conf.set(_SCRATCH, folder)
    try:
        yield folder
    finally:
        if before is None:
            spark.conf.unset(_SCRATCH)
        else:
            spark.conf.set(_SCRATCH, before)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def cut(df: DataFrame) -> DataFrame:
    """Write `df` once to the shared folder and read it back.

    Used between the rounds of iterative operators: the plan stays short, a lost
    executor never replays earlier rounds, and the reader has real table sizes, so
    the next join can be planned from them.
    """
    spark = df.sparkSession
    path = f"{spark.conf.get(_SCRATCH, None) or shared_folder(spark)}/cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
