"""Where intermediate tables go: the shared folder named by the session."""

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="broadsheet-")


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``, which every executor can reach.

    Only a local session, where driver and executors are one process, may go
    without the setting; it then gets a folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = _local_folder()
    return folder.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path of the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stored(frame: DataFrame, name: str = "table") -> DataFrame:
    """The frame, computed once and read back as a table of the shared folder.

    Cuts the lineage: what follows is planned on a table of known size, and a
    lost executor does not bring back the work behind it.
    """
    spark = frame.sparkSession
    path = fresh_path(spark, name)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)
