"""Sinks: stage tables, record files in rank order, run summaries."""

from __future__ import annotations

import io
import itertools
import json
import os
import tarfile
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievespark.functions.scalar import add_properties, chunk_index
from sievespark.session import cut_lineage, drop
from sievespark.sources.schemas import TABLES


#: Where a table's columns are written; readers of the table pass it over.
LAYOUT = "_layout"


def write_stage_table(df: DataFrame, name: str, path: str, partition_by: Sequence[str] = ()) -> None:
    """Parquet with the declared columns in order, partitioned where asked; replaces what is there."""
    cols = [F.col(f.name).cast(f.dataType) for f in TABLES[name]]
    extra = [c for c in partition_by if c not in TABLES[name].names]
    df.select(*extra, *cols).write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def add_to_stage_table(df: DataFrame, name: str, path: str, first: bool) -> None:
    """The same as one growing table: the first part replaces what is there, others are added."""
    df.select(*[F.col(f.name).cast(f.dataType) for f in TABLES[name]]).write.mode("overwrite" if first else "append").parquet(path)


def write_csv(df: DataFrame, name: str, path: str) -> None:
    """The same as CSV with a header, at the edge of the system."""
    df.select(*[F.col(f.name).cast(f.dataType) for f in TABLES[name]]).write.mode("overwrite").csv(path, header=True)


def write_ranked_blocks(df: DataFrame, path: str, rank: str = "rank", block: str = "block", per_file: int = 50_000) -> None:
    """Blocks in rank order, one folder a part of ``per_file`` ranks; each part is written by one task."""
    parts = df.select(chunk_index(F.col(rank), per_file).alias("part"), F.col(rank).alias("__rank"), F.regexp_replace(F.col(block), r"\r?\n\z", "").alias("value"))
    placed = parts.repartition("part").sortWithinPartitions("part", "__rank").select("part", "value")
    placed.write.mode("overwrite").partitionBy("part").text(path)  # each block keeps its one last line end


def write_tagged_blocks(df: DataFrame, path: str, tags: dict[str, Column], rank: str = "rank", block: str = "block", per_file: int = 50_000) -> None:
    """Blocks with properties added before their terminators."""
    write_ranked_blocks(df.select(F.col(rank), add_properties(F.col(block), tags).alias(block)), path, rank, block, per_file)


def write_summary(df: DataFrame, path: str) -> None:
    """A one-row aggregate as ``name: value`` lines."""
    row = df.limit(2).collect()
    if len(row) != 1:
        raise ValueError("a summary is one row")
    lines = [(f"{k}: {v}",) for k, v in row[0].asDict().items()]
    df.sparkSession.createDataFrame(lines, "value string").coalesce(1).write.mode("overwrite").text(path)


def write_single_file(df: DataFrame, path: str, rank: str = "rank", block: str = "block") -> None:
    """All blocks in rank order as one text file, for tools that read no other; bounded by what one task writes."""
    write_ranked_blocks(df, path, rank, block, per_file=1 << 62)


def write_archive(df: DataFrame, path: str, name: str = "name", text: str = "text", extra: dict[str, str] | None = None) -> int:
    """Rows as files of a gzip archive on the driver, streamed row by row; ``extra`` maps names to texts. Returns the files."""
    n = 0
    with tarfile.open(path + ".partial", "w:gz") as tar:
        for file, content in itertools.chain((extra or {}).items(), df.orderBy(name).select(name, text).toLocalIterator()):
            data = content.encode()
            info = tarfile.TarInfo(file)
            info.size = len(data)
            tar.addfile(info, io.BytesIO(data))
            n += 1
    os.replace(path + ".partial", path)
    return n


def write_part(df: DataFrame, root: str, name: str, parts: Sequence[str], by: str = "conformation") -> None:
    """Write the table ``name`` below ``root``, partitioned by ``by``; only ``parts`` are replaced, those without a row emptied.

    The columns are written beside it, so a table without a row can be read too.
    """
    spark, path = df.sparkSession, f"{root.rstrip('/')}/{name}"
    rows = cut_lineage(df.where(F.col(by).isin(*parts)))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)
    layout = T.StructType([*(f for f in rows.schema if f.name != by), rows.schema[by]])
    spark.createDataFrame([(layout.json(),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/{LAYOUT}")
    there = {r[0] for r in read_part(spark, root, name, parts).select(by).distinct().collect()}
    held = {r[0] for r in rows.select(by).distinct().collect()}  # as many as parts
    for gone in sorted(there - held):
        at = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{by}={spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(gone)}")
        at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(at, True)
    drop(rows)


def read_part(spark: SparkSession, root: str, name: str, parts: Sequence[str] | None = None, by: str = "conformation") -> DataFrame:
    """The table ``name`` below ``root``; of ``parts`` only these folders are read."""
    path = f"{root.rstrip('/')}/{name}"
    layout = T.StructType.fromJson(json.loads(spark.read.text(f"{path}/{LAYOUT}").first()["value"]))
    rows = spark.read.schema(layout).parquet(path)
    return rows if parts is None else rows.where(F.col(by).isin(*parts))
