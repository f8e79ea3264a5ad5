"""Session settings, table reading, lineage cutting."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def session(app: str = "mnemoweave", cores: int | str = 8, **conf: str) -> SparkSession:
    """A local session with the engine's settings (UTC, ANSI, AQE). Clusters bring their own session."""
    b = SparkSession.builder.master(f"local[{cores}]").appName(app)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    for k, v in (settings | conf).items():
        b = b.config(k, v)
    return b.getOrCreate()


def ship(spark: SparkSession) -> None:
    """Gives the package to the executors' Python, once per context, through the driver's own file service."""
    sc = spark.sparkContext
    if getattr(sc, "_mnemoweave_shipped", False):
        return
    here = Path(__file__).resolve().parent
    target = os.path.join(tempfile.mkdtemp(), "mnemoweave.zip")
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted(here.rglob("*.py")):
            z.write(f, f"mnemoweave/{f.relative_to(here)}")
    sc.addPyFile(target)
    sc._mnemoweave_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the project's tables."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """df over all cores where its files give fewer splits than there are: one small file is one split, however much work
    its rows need. Larger inputs are left as they are, so nothing is shuffled there."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def checkpointed(df: DataFrame, eager: bool = True) -> DataFrame:
    """df with its lineage cut through reliable files in ``spark.checkpoint.dir``.

    The folder named by the cluster is used as it is; where none is set, a temporary one is made in local runs and tests,
    and it is an error on a cluster. Files are shared, so the loss of an executor loses nothing.
    """
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        named = sc.getConf().get("spark.checkpoint.dir") or df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not named and not sc.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(named or os.path.join(tempfile.gettempdir(), f"mnemoweave-{uuid.uuid4().hex}"))
    return df.checkpoint(eager)
