"""Session settings and written cut points."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def get_spark(app: str = "paygrain", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on and UTC as its zone; keyword settings win."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    base = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
    }
    return b.config(map=base | {k.replace("__", "."): v for k, v in conf.items()}).getOrCreate()


def ship(spark: SparkSession) -> SparkSession:
    """Make this package importable in the Python workers of the session, once per session."""
    sc = spark.sparkContext
    if not getattr(sc, "_paygrain_shipped", False):
        at = Path(__file__).resolve().parent
        to = Path(tempfile.mkdtemp(prefix="paygrain-")) / "paygrain.zip"
        with zipfile.ZipFile(to, "w", zipfile.ZIP_DEFLATED) as z:
            for p in sorted(at.rglob("*.py")):
                z.write(p, f"paygrain/{p.relative_to(at)}")
        sc.addPyFile(str(to))
        # long texts must not add up to huge Arrow batches
        if not spark.conf.isModifiable("spark.sql.execution.arrow.maxBytesPerBatch"):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
        else:
            spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(32 << 20))
        sc._paygrain_shipped = True
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, or the one set on the context. Only a local master, where
    every executor is this process, may go without: it gets a temporary folder."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if at:
        return at
    own = spark.sparkContext._jsc.sc().getCheckpointDir()
    if own.isDefined():
        return own.get()
    if spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    made = "file://" + tempfile.mkdtemp(prefix="paygrain-")
    spark.sparkContext.setCheckpointDir(made)
    return made


def _written(spark: SparkSession) -> str:
    """This application's folder of written tables; it is deleted when the driver's JVM ends."""
    sc = spark.sparkContext
    if not getattr(sc, "_paygrain_written", None):
        sc._paygrain_written = f"{shared_dir(spark)}/paygrain-{sc.applicationId}"
        path = sc._jvm.org.apache.hadoop.fs.Path(sc._paygrain_written)
        fs = path.getFileSystem(sc._jsc.hadoopConfiguration())
        fs.mkdirs(path)
        fs.deleteOnExit(path)
    return sc._paygrain_written


def folder(spark: SparkSession, name: str) -> str:
    """A new, empty folder in the shared one, for files of this application."""
    at = f"{_written(spark)}/{name}-{uuid.uuid4().hex}"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(at)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(path)
    return at


def materialise(df: DataFrame, name: str, tight: bool = False, by: Sequence[str] = ()) -> DataFrame:
    """Write df once as Parquet in the shared folder and read it back.

    Cuts the lineage and lets several consumers share one computation; the files survive the loss of executors.
    tight: zstd in place of snappy, for tables that are written once and read few times. by: columns of few values that
    name the folders, so that a reader of one value reads its folder alone.
    """
    at = f"{_written(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.partitionBy(*by).option("compression", "zstd" if tight else "snappy").parquet(at)
    return df.sparkSession.read.schema(df.schema).parquet(at)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
