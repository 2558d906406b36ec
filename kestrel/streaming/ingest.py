"""Message stream -> decode -> prefix join -> mirror rows -> listing.

The source is a directory of message files read as a stream; each micro-batch
is handled in ``foreachBatch``:
  * undecodable messages go to a dead-letter table (P6, the "nack");
  * the distinct directories of the decoded messages are joined to the object listing (J2), which is
    partitioned by top directory: the batch's directories prune its partitions (dynamic partition pruning), of the
    listing and of the content alike;
  * the objects of each directory (K7), and the messages that name it, are written under
    ``batch_id=<id>`` with dynamic partition overwrite, so a retried batch replaces its own output
    instead of duplicating it;
  * the checkpoint is the acknowledgement: a batch is re-run until it commits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.operators import objects as O


def _write_batch(out: DataFrame, path: str, batch_id: int) -> None:
    (out.withColumn("batch_id", F.lit(int(batch_id))).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path))


def batch_mirror(good: DataFrame, listing_path: str) -> DataFrame:
    """The mirror rows of a batch's directories, read from the partitions of their top directories only."""
    spark = good.sparkSession
    dirs = (good.select(O.strip_trailing_slash(F.col("path")).alias("_dir")).distinct()
            .withColumn("part", O.listing_part(F.col("_dir"))))
    listing, content = (spark.read.parquet(f"{listing_path}/{t}") for t in ("listing", "content"))
    return O.mirror_objects(dirs, listing, content, more=["part"])


def message_handler(listing_path: str, mirror_path: str, dead_path: str):
    """The per-batch callback (user code runs per micro-batch, errors fail the batch -> retry).
    ``listing_path``: tables of ``operators.objects.write_listing``."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        good, bad = O.decode_messages(batch)
        _write_batch(bad.select("message_id", "body", "error"), dead_path, batch_id)
        _write_batch(good.select("message_id", "path"), f"{mirror_path}/messages", batch_id)
        _write_batch(batch_mirror(good, listing_path), f"{mirror_path}/objects", batch_id)
    return handle


def mirrored(spark: SparkSession, mirror_path: str) -> DataFrame:
    """(message_id, path, relative_path, length, content) of what batches have mirrored."""
    m, o = (spark.read.parquet(f"{mirror_path}/{t}") for t in ("messages", "objects"))
    rows = m.withColumn("dir", O.strip_trailing_slash(F.col("path"))).join(o, ["dir", "batch_id"])
    return rows.select("message_id", "path", "relative_path", "length", "content")


def run_object_ingest(spark: SparkSession, source_dir: str, listing_path: str, out_dir: str, checkpoint: str,
                      max_files_per_trigger: int = 1000) -> dict:
    """Process every message file present under ``source_dir`` (availableNow) and stop."""
    stream = (spark.readStream.schema("message_id string, body string")
              .option("maxFilesPerTrigger", max_files_per_trigger).json(source_dir))
    q = (stream.writeStream.foreachBatch(message_handler(listing_path, f"{out_dir}/mirror", f"{out_dir}/dead_letter"))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return {"mirror": f"{out_dir}/mirror", "dead_letter": f"{out_dir}/dead_letter"}
