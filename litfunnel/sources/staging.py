"""Tables between two jobs, in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

FOLDER = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder that FOLDER names. A local session without one, where all is one machine, gets one;
    on a cluster a folder of one machine would be read by nobody, so that is an error."""
    found = spark.conf.get(FOLDER, None)
    if not found:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError(f"{FOLDER} must name a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="litfunnel-tables-")
        spark.conf.set(FOLDER, found)
    return found


def written(df: DataFrame, label: str) -> DataFrame:
    """df as a Parquet table of its own: later jobs read the same rows, whichever executors are lost."""
    path = f"{shared_folder(df.sparkSession)}/tables/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.table_path = path
    return out


def removed(df: DataFrame) -> None:
    """Delete a table of written() that no later job reads."""
    jvm = df.sparkSession._jvm
    path = jvm.org.apache.hadoop.fs.Path(df.table_path)
    path.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def unused(prefix: str = "c") -> str:
    """A column name that no table has."""
    return f"_{prefix}_{uuid.uuid4().hex}"
