"""Session settings, table access and the shared checkpoint folder."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "accuracy_daily", "customer", "dim_location", "dim_variable", "dlq_record", "documents", "embeddings", "events",
    "forecast", "iem_asos_sample", "lineitem", "mix_target", "nation", "observation", "open_meteo_forecast_response",
    "orders", "part", "region", "supplier",
)


def build_session(app: str = "skyloom", cores: str | int = "*", memory: str = "8g", partitions: int = 8, **conf: str) -> SparkSession:
    """A local session with the settings every job here relies on; on a cluster the submitter's settings hold instead."""
    b = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a data folder, with the session pinned to UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``; a temporary one is set only where it is unset and the master is this machine."""
    sc = spark.sparkContext
    got = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not got:
        if not re.fullmatch(r"local(\[[^,\]]*(,\d+)?\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        got = os.path.join(tempfile.gettempdir(), "skyloom-checkpoints")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(got)
    return got
