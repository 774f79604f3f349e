"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# What the jobs rely on.  Everything else (executor sizes, shuffle partitions,
# file split sizes) is the cluster's business and left as the cluster set it.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings the jobs need to an existing session."""
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cpus: int | str = "*", name: str = "broadsheet") -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    partitions = "8" if cpus == "*" else str(cpus)
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.ui.showConsoleProgress", "false")
        .config(SPREAD, "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as ``spark.checkpoint.dir`` names it.

    Only a local session may fall back to a temporary folder: on a cluster such
    a folder exists on one machine and its content is lost with that machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if not named:
        named = sc.getCheckpointDir()
    if not named:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        named = tempfile.mkdtemp(prefix="broadsheet-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(named)
    return named


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A path under the shared folder that no other job writes to."""
    return f"{shared_dir(spark).rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def materialise(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and continue from the stored result.

    A reliable checkpoint survives the loss of executors, unlike a cached copy.
    """
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


SPREAD = "spark.broadsheet.spread"


def spread(df: DataFrame) -> DataFrame:
    """Use all cores on an input of few files, in sessions that ask for it.

    The benchmark and the tests do, because their tables are single files.  On a
    cluster file splits decide.
    """
    spark = df.sparkSession
    if spark.conf.get(SPREAD, "false") != "true":
        return df
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def settled(df: DataFrame) -> DataFrame:
    """``df`` with its columns computed here, once, in code of their own.

    Two things the optimizer does not see otherwise.  A later filter on a
    computed column would sink below the projections and repeat them all in its
    condition.  And a long chain of expressions becomes one Java method beyond
    8000 bytes, which the JVM only interprets: three times slower on the
    cleaning steps.  An observation stops both, but not column pruning.
    """
    return df.observe(f"settled-{uuid.uuid4().hex}", F.count(F.lit(1)).alias("rows"))
