"""Session settings and lineage cuts shared by all jobs."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Results depend on these two; every job pins them.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

# Planning defaults. A cluster's own values win: they are only set by `build_session`.
PLANNING_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app_name: str = "tickerloom", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**PLANNING_CONF, **REQUIRED_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_semantics(spark: SparkSession) -> SparkSession:
    """Set the result-relevant options on a session somebody else created."""
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)
    return spark


def checkpoint_folder(spark: SparkSession) -> str:
    """The folder `checkpoint()` writes to.

    The cluster names a shared folder in `spark.checkpoint.dir`. Without one, only
    a local-mode session gets a folder of its own; on a cluster that is an error,
    since a machine-local folder would not outlive its executor.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = context.getCheckpointDir()
    if configured:
        if current is None:
            context.setCheckpointDir(configured)
        return configured
    if current is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tickerloom-checkpoint-"))
        current = context.getCheckpointDir()
    return current


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage behind an expensive stage with a reliable checkpoint."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str) -> DataFrame:
    """`df` as a compressed table in the shared folder, for stages that are read several times or by column."""
    spark = df.sparkSession
    path = f"{checkpoint_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="tickerloom-package-")) / "tickerloom.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)
