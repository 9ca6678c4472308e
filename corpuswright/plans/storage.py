"""Tables kept between the steps of a job, in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; a folder of this machine where it is unset and the session has no other machine (as in tests).

    A session with executors elsewhere must name a folder that all of them share, or this is an error: each would write to a
    disk of its own, and what one wrote the others would miss.
    """
    found = spark.conf.get("spark.checkpoint.dir", "") or spark.sparkContext.getConf().get("spark.checkpoint.dir", "")
    if not found:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError(f"spark.checkpoint.dir is unset: on {master} it must name a folder that the driver and all executors share")
        found = f"file://{tempfile.mkdtemp(prefix='corpuswright-')}"
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows, written to the shared folder as Parquet and read back: computed once, and lineage ends there."""
    path = f"{shared_dir(df.sparkSession)}/corpuswright/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Bytes of a file's rows that a task gets at most, where rows of few files are dealt out.
TASK_BYTES = 4_000_000


def spread(df: DataFrame) -> DataFrame:
    """The rows, dealt to more tasks where a table has fewer files than the session has cores: a file may be one row group,
    which a single task reads and works on alone."""
    files, cores = len(df.inputFiles()), df.sparkSession.sparkContext.defaultParallelism
    wanted = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()) // TASK_BYTES
    return df.repartition(wanted) if files < cores and wanted > files else df
