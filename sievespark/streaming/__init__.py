"""Streams of pose files: the reference model has no streaming operators, only resume by file.

Reading a growing folder once per new file is the one streaming form of that.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sievespark.functions.scalar import file_stem, pose_score, split_blocks


def new_poses(spark: SparkSession, folder: str, handle: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Hands each batch of files not seen before to ``handle`` (poses, batch number), then stops."""
    files = spark.readStream.format("text").option("wholetext", "true").option("pathGlobFilter", "*.sdf").option("recursiveFileLookup", "true").load(folder)
    rows = files.select(F.input_file_name().alias("path"), "value")
    blocks = rows.select("path", file_stem(F.col("path")).alias("compound_id"), F.posexplode(split_blocks(F.col("value"))).alias("pose_idx", "block"))
    scored = blocks.withColumn("score", pose_score(F.col("block")))
    return scored.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
