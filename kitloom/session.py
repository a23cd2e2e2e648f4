"""Session, table and checkpoint helpers shared by every operator."""

from __future__ import annotations

import os
import tempfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
#: A union of sides that are hashed alike claims to be hashed so too, but adaptive execution may merge the sides' partitions
#: differently; groups, windows and folds after it would then see parts of a key. So unions claim nothing.
UNION_CONF = "spark.sql.unionOutputPartitioning"


def build_session(app: str = "kitloom", master: str = "local[*]", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A session with the settings the engine is written for: UTC, AQE with skew joins, Arrow."""
    builder = (
        SparkSession.builder.appName(app)
        .master(master)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config(UNION_CONF, "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    session = builder.getOrCreate()
    prepare(session)
    return session


def make_importable(spark: SparkSession) -> None:
    """Let Python workers find this package where only the driver's own path leads to it."""
    environment, root = spark.sparkContext.environment, str(Path(__file__).resolve().parent.parent)
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *paths])


def prepare(spark: SparkSession) -> None:
    """What every session must have before an operator runs, whoever built it."""
    make_importable(spark)
    if spark.conf.get(UNION_CONF, "false") != "false":
        spark.conf.set(UNION_CONF, "false")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder the cluster names; on one machine without a name, as in tests, a private one."""
    sc = spark.sparkContext
    named = spark.conf.get(CHECKPOINT_CONF, None) or sc.getConf().get(CHECKPOINT_CONF, None)
    if sc._jsc.sc().getCheckpointDir().isDefined():
        return
    if not named and not sc.master.startswith("local"):
        raise RuntimeError(f"{CHECKPOINT_CONF} must name a folder that all executors share")
    sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="kitloom-checkpoint-"))


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write df to the checkpoint folder and go on from the files, which outlive any executor."""
    prepare(df.sparkSession)
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def empty_like(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema)
