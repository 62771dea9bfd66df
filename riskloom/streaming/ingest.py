"""Resumable landing of raw documents: chunks add up to what one run would give."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from riskloom.sources.documents import DOCUMENT_GLOB, stem_of
from riskloom.sources.tables import read_table

LANDED_SCHEMA = "stem string, raw string, batch bigint"


def stream_documents(
    spark: SparkSession, path: str, glob: str = DOCUMENT_GLOB, files_per_batch: int | None = None
) -> DataFrame:
    """Stream of ``stem, raw``: every new document file of a folder."""
    reader = spark.readStream.option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    raw = reader.text(path, wholetext=True)
    return raw.select(
        stem_of(F.col("_metadata.file_name")).alias("stem"),
        F.col("_metadata.file_path").alias("path"),
        F.col("value").alias("raw"),
    )


def land_batch(batch: DataFrame, batch_id: int, target: str) -> None:
    """Append the batch's unseen documents as ``target/batch=<id>``.

    The batch replaces its own folder, so a retried batch writes the same once more; documents that
    arrived in any other batch are dropped. What is already there is narrowed to the stems of this
    batch first: one column scanned, and no shuffle of the landed table while the batch's stems are
    small enough for Catalyst to broadcast.
    """
    # Of several documents of one stem the first by path is taken (without paths, by a hash of the text);
    # only names and paths are shuffled before the join.
    place = F.col("path") if "path" in batch.columns else F.xxhash64("raw")
    placed = batch.select("stem", "raw", place.alias("place"))
    first = placed.groupBy("stem").agg(F.min("place").alias("place"))
    fresh = placed.join(first, ["stem", "place"], "left_semi").select("stem", "raw")
    if "path" not in batch.columns:  # equal rows are left
        fresh = fresh.dropDuplicates(["stem"])
    landed = read_table(batch.sparkSession, target)
    if landed is not None:
        seen = (
            landed.where(F.col("batch") != batch_id)
            .select("stem")
            .join(batch.select("stem"), "stem", "left_semi")
        )
        fresh = fresh.join(seen, "stem", "left_anti")
    fresh.write.mode("overwrite").parquet(f"{target}/batch={batch_id}")


def ingest(documents: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Land everything available now and stop; a restart goes on from the checkpoint.

    Batch folders are numbered by the stream's own batches. A new checkpoint starts numbering at 0
    again, so its batches are shifted past the folders that exist when it starts.
    """
    spark = documents.sparkSession
    first = _first_batch(spark, target, checkpoint)
    return (
        documents.writeStream.foreachBatch(
            lambda batch, batch_id: land_batch(batch, first + batch_id, target)
        )
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _first_batch(spark: SparkSession, target: str, checkpoint: str) -> int:
    """Number of the stream's batch 0, kept next to the checkpoint so that restarts agree.

    It is written before the first batch starts; a write that broke off is simply made again.
    """
    kept = f"{checkpoint.rstrip('/')}-first-batch"
    known = read_table(spark, kept)
    if known is not None:
        return known.first().first
    landed = read_table(spark, target)
    last = None if landed is None else landed.agg(F.max("batch")).first()[0]
    first = 0 if last is None else last + 1
    spark.range(1).select(F.lit(first).cast("bigint").alias("first")).coalesce(1).write.mode("overwrite").parquet(kept)
    return first


def landed_documents(spark: SparkSession, target: str) -> DataFrame:
    """``stem, raw`` of everything landed."""
    return spark.read.schema(LANDED_SCHEMA).parquet(target).select("stem", "raw")
