"""Session helpers: settings every plan relies on and the shared folder for cut lineage."""

from __future__ import annotations

import io
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(app: str = "palimpsest", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution, UTC and Arrow on; anything given in conf wins."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # stages here do much work for each byte, so small shuffles stay spread over the cores
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "128k",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        **conf,
    }
    return builder.config(map=settings).getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share.

    It is read from spark.checkpoint.dir; only where that is unset, as in tests, a
    temporary folder of this machine is used and remembered for the session.
    """
    context = spark.sparkContext
    set_dir = context._jsc.sc().getCheckpointDir()
    if set_dir.isDefined():
        return set_dir.get()
    wanted = context.getConf().get(CHECKPOINT_CONF, None)
    if not wanted:
        if not context.master.startswith("local[") and context.master != "local":
            raise ValueError(f"{CHECKPOINT_CONF} must name a folder all executors share")
        wanted = "file://" + tempfile.mkdtemp(prefix="palimpsest-")
    context.setCheckpointDir(wanted)
    return context._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """The same rows with their lineage cut: written once to the shared folder, read from there."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(folder, f"{name}.parquet"))


def stored(df: DataFrame) -> DataFrame:
    """The same rows written as a table to the shared folder and read from there: lineage cut, columns prunable."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.parquet(path)


def put(spark: SparkSession, name: str, content: bytes) -> str:
    """Write a file to the shared folder; gives its path."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/{name}")
    file = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(path)
    try:
        file.write(content)
    finally:
        file.close()
    return path.toString()


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Hand the package to the executors once, where their Python isn't known to find it by its path."""
    package = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(package)
    application = spark.sparkContext.applicationId
    if application in _shipped or root in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        return
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as file:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    file.write(full, os.path.relpath(full, root))
    spark.sparkContext.addPyFile(put(spark, f"package-{uuid.uuid4().hex}.zip", buffer.getvalue()))
    _shipped.add(application)


def clear(spark: SparkSession) -> None:
    """Delete the tables that stored() wrote, once no DataFrame over them is needed."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(shared_dir(spark))
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for status in fs.listStatus(root):
        if status.getPath().getName().startswith("stored-"):
            fs.delete(status.getPath(), True)
