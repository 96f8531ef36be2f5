"""Session factory and the helpers that cut lineage durably."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """A session with the engine's defaults; on a cluster the master comes from the submit command."""
    builder = SparkSession.builder.appName("folioframe")
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: the checkpoint folder, which is set from
    spark.checkpoint.dir. Where that is unset, a local session gets a folder of its machine and a
    cluster's is refused."""
    context = spark.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        folder = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
        if not folder:
            if not context.master.startswith("local") or context.master.startswith("local-cluster"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            folder = f"file://{tempfile.mkdtemp(prefix='folioframe-checkpoint-')}"
        context.setCheckpointDir(folder)
    return context._jsc.sc().getCheckpointDir().get()


def durable(df: DataFrame) -> DataFrame:
    """Cut the lineage at a reliable checkpoint: the rows survive the loss of any executor."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def ship(spark: SparkSession) -> None:
    """Give the executors' Python workers this package, once per application: the driver
    serves a zip of it, so nothing has to be installed on the nodes."""
    context = spark.sparkContext
    if getattr(context, "_folioframe_shipped", False):
        return
    root = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="folioframe-")
    archive = os.path.join(folder, "folioframe.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for file in sorted(root.rglob("*.py")):
            out.write(file, f"folioframe/{file.relative_to(root)}")
    context.addPyFile(archive)
    context._folioframe_shipped = True
