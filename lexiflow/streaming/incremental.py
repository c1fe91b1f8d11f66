"""Incremental parsing: pages that arrive are parsed once and merged into the tables of entries and errors.

The stream's checkpoint is the record of what is done. Each batch writes to a folder named by its number, so a batch that runs again writes
the same; readers take the latest batch of each file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.text import basename
from ..schema import ENTRY
from ..sources.extract import entries


def parse_pages(spark: SparkSession, folder: str, target: str, checkpoint: str, suffix: str = ".html", files_per_batch: int = 1000) -> StreamingQuery:
    """Starts a stream that takes all pages there are and stops; start it again for those that came since."""
    raw = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").option("pathGlobFilter", f"*{suffix}").option("maxFilesPerTrigger", files_per_batch).load(folder)
    pages = raw.select(F.url_decode(basename(F.col("path"))).alias("file"), F.try_validate_utf8(F.col("content").cast("string")).alias("html"))

    def put(batch: DataFrame, number: int) -> None:
        entries(batch).write.mode("overwrite").parquet(f"{target}/batch={number}")

    return pages.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest(spark: SparkSession, target: str) -> DataFrame:
    """(file, entry, error): what the latest batch said of each file."""
    rows = spark.read.parquet(target).select("file", "batch", F.to_json("entry").alias("doc"), "error")
    best = rows.groupBy("file").agg(F.max_by(F.struct("doc", "error"), "batch").alias("r"))
    return best.select("file", F.from_json("r.doc", ENTRY).alias("entry"), F.col("r.error").alias("error"))
