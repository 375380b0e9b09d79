"""Session defaults and the shared folder for cut lineage."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOCAL_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
}


#: Arrow data of long texts that goes to a Python worker at a time.
BATCH_BYTES = 8 << 20


def local_session(cores: str = "8", app: str = "rankloom", memory: str = "8g", **conf: str) -> SparkSession:
    """A session for tests and benchmarks; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", cores if cores.isdigit() else "8")
    )
    for key, value in {**LOCAL_DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only in local mode."""
    context = spark.sparkContext
    folder = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = tempfile.mkdtemp(prefix="rankloom-checkpoint-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialize ``df`` in the shared folder, so later branches read one fixed copy."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def run_folder(spark: SparkSession, name: str) -> str:
    """A new folder for one run, below the shared one."""
    return f"{shared_dir(spark)}/rankloom-{name}-{uuid.uuid4().hex}"


def small_batches(df: DataFrame) -> DataFrame:
    """The same rows, for a function over Arrow batches: these hold at most ``BATCH_BYTES`` each, a setting of the session
    from then on. Spark's own bound of 64 MB is held several times over by each core, in the JVM and in its Python worker."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    digits, unit = re.fullmatch(r"(-?\d+)([kmgtp]?)b?", conf.get(key).lower()).groups()
    if not 0 < int(digits) << 10 * " kmgtp".index(unit or " ") <= BATCH_BYTES:
        conf.set(key, str(BATCH_BYTES))
    return df


def rebalanced(df: DataFrame, *columns: str) -> DataFrame:
    """Rows brought together by the partition columns of a table to be written: few files per
    value, and the rows of a large value split over tasks (adaptive rebalance)."""
    return df.hint("rebalance", *[F.col(c) for c in columns]) if columns else df


def stored(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """Write ``df`` once as a table in the shared folder and read it back: later uses share one
    computation, prune its columns and partitions, and survive the loss of executors."""
    path = run_folder(df.sparkSession, name)
    rebalanced(df, *partition_by).write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)
