"""Session helpers: a tuned local session for tests, and lineage cuts in the shared folder."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", partitions: int = 8, name: str = "tidemark") -> SparkSession:
    """A session for tests and benches; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only in local mode."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    current = spark.sparkContext.getCheckpointDir()
    if current is None:
        if not named:
            if not spark.sparkContext.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
            named = tempfile.mkdtemp(prefix="tidemark-")
        spark.sparkContext.setCheckpointDir(named)
        current = spark.sparkContext.getCheckpointDir()
    return named or current


def materialize(df: DataFrame) -> DataFrame:
    """Cut the lineage of a frame that several branches read; survives executor loss."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for one hand-over table below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Hash-partition by keys into the session's shuffle partitions.

    Used ahead of per-key numerical work: the rows are few and the work is heavy, so the
    adaptive merging of small partitions must not put all keys into one task. A
    following groupBy on the same keys reuses the partitioning.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def ship_package(spark: SparkSession) -> None:
    """Send the package to the Python workers once per context, so that they can import it from any folder."""
    context = spark.sparkContext
    if getattr(context, "_tidemark_shipped", False):
        return
    top = Path(__file__).resolve().parent
    if top.parent.suffix != ".zip":
        held = tempfile.mkdtemp(prefix="tidemark-package-")
        archive = Path(held) / f"tidemark-{uuid.uuid4().hex}.zip"
        with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
            for source in sorted(top.rglob("*.py")):
                out.write(source, source.relative_to(top.parent).as_posix())
        context.addPyFile(str(archive))
    context._tidemark_shipped = True
