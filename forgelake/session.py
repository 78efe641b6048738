"""Session settings and the shared folder for written intermediate tables."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession

from forgelake.errors import SettingError


def local_session(cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and benches; a cluster brings its own settings."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share (spark.checkpoint.dir).

    Only where the session names none and runs in one process, as in tests, one
    below the warehouse folder is set; a cluster without one is an error, so it
    never gets a machine-local folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        held = spark.sparkContext._jsc.sc().getCheckpointDir()
        folder = held.get() if held.isDefined() else None
    if not folder:
        if not re.fullmatch(r"local(?:\[[^-\]]*\])?", spark.conf.get("spark.master", "")):
            raise SettingError("spark.checkpoint.dir must name a folder that all executors share")
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_shared"
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """Cuts the lineage: writes df as Parquet into the shared folder, reads it back.

    The files outlive executors, so a lost executor costs no recomputation of
    what lies before this point.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
