"""Monthly intake as a stream: new files are taken once, in micro-batches; events in windows with a watermark.

An extension of the file-level increments: the checkpoint of a query takes the place of a registry of new files (changed
files still need the registry of sources.files)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..functions.dates import period_of_file


def monthly_files(spark: SparkSession, folder: str, schema: StructType, fmt: str = "parquet", files_per_batch: int = 50) -> DataFrame:
    """A stream of the rows of new files MM_YYYY..., with FICHIER, MOIS, ANNEE."""
    s = spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", files_per_batch).option("recursiveFileLookup", True)
    d = s.load(folder).withColumn("FICHIER", F.col("_metadata.file_name"))
    m, a = period_of_file(F.col("FICHIER"))
    return d.withColumn("MOIS", m).withColumn("ANNEE", a)


def take_new(stream: DataFrame, out: str, checkpoint: str, partition_by: tuple[str, ...] = ("ANNEE", "MOIS")) -> StreamingQuery:
    """Append what is new to a partitioned table and end. Run again, it takes only files that came since."""
    return stream.writeStream.format("parquet").partitionBy(*partition_by).option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out)


def for_each_batch(stream: DataFrame, checkpoint: str, use: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """Hand every micro-batch to use(batch, number) and end; a batch may come again after a failure, under its number."""
    return stream.writeStream.foreachBatch(use).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, at: str = "ts", key: str = "event_type", value: str = "value", width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """n and total per tumbling window and key; on a stream, rows later than the watermark are left out."""
    d = events.withWatermark(at, late) if events.isStreaming else events
    g = d.groupBy(F.window(at, width).alias("_w"), key).agg(F.count("*").alias("n"), F.sum(value).alias("total"))
    return g.select(F.col("_w.start").alias("start"), key, "n", "total")
