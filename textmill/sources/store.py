"""Tables written in the shared folder, to cut lineage and to compute a stage once."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


_USED: set[str] = set()


def _swept(spark: SparkSession) -> None:
    """What an application wrote goes when its Python ends, if its session is still there."""
    try:
        clean(spark)
    except Exception:  # noqa: BLE001  the session was stopped before: the folder is left to its owner
        pass


def shared_folder(spark: SparkSession) -> str:
    """This application's part of the folder in ``spark.checkpoint.dir``, removed when its Python ends.

    In local mode a temporary folder stands in where the session names none, and goes when Python ends.  On a
    cluster a machine-local folder would not be shared, so there the setting is needed."""
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not folder:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        made = tempfile.mkdtemp(prefix="textmill-")
        atexit.register(shutil.rmtree, made, True)
        folder = f"file://{made}"
        spark.conf.set("spark.checkpoint.dir", folder)
    if sc.applicationId not in _USED:
        _USED.add(sc.applicationId)
        atexit.register(_swept, spark)
    return f"{folder.rstrip('/')}/textmill-{sc.applicationId}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as a table in the shared folder and read again.

    A lost executor costs nothing beyond its running tasks: what was written stays."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clean(spark: SparkSession) -> bool:
    """Remove all that this application has written in the shared folder.  Results that read it must be used first."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(shared_folder(spark))
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
