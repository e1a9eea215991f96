"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Split hot join partitions even where that costs one more shuffle downstream.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A fact partitioned by a part of the join keys need not be shuffled again.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.session.timeZone": "UTC",
    # HotSpot leaves methods beyond 8000 bytes of bytecode to its interpreter: stages of many wide expressions are compiled
    # in pieces instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}
#: The settings that also hold in a session that was built by others.
OWN_SETTINGS = ("spark.sql.codegen.hugeMethodLimit",)


def build_session(app: str = "partflow", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def hold_settings(spark: SparkSession) -> None:
    """Sets OWN_SETTINGS in a given session."""
    for key in OWN_SETTINGS:
        spark.conf.set(key, SETTINGS[key])


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a private one in local mode only."""
    context = spark.sparkContext
    folder = context.getCheckpointDir() or context.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        folder = tempfile.mkdtemp(prefix="partflow-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame) -> DataFrame:
    """Materialise ``df`` reliably, so that later reads see the very same rows."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
