"""Poses kept by compound: bucketed tables that are joined without moving them, and read in part.

A store is one Parquet table, partitioned by its ``by`` columns (a conformation) and bucketed by
compound. Its layout is written beside it, so any session can open it. Joins by compound leave the
store where it is; a lookup of few compounds reads only the files of the buckets that they are in.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sievespark.operators.names import unused
from sievespark.session import cut_lineage

KEY = "compound_id"
LAYOUT = "_layout"


def _fs(spark: SparkSession, path: str):  # noqa: ANN202
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def write_store(poses: DataFrame, path: str, buckets: int = 200, by: Sequence[str] = ("conformation",)) -> None:
    """Write ``poses`` as a store; a store that is there is replaced.

    Rows are dealt by bucket first, so that each bucket of a partition is one sorted file. Use about
    as many buckets as make files of 100 MB to 1 GB.
    """
    spark = poses.sparkSession
    name = f"pose_store_{uuid.uuid4().hex}"
    rows = poses.repartition(buckets, KEY)
    rows.write.mode("overwrite").partitionBy(*by).bucketBy(buckets, KEY).sortBy(KEY).option("path", path).saveAsTable(name)
    spark.sql(f"drop table {name}")  # an external table: its files stay
    layout = json.dumps({"buckets": buckets, "by": list(by), "schema": rows.schema.jsonValue()})
    spark.createDataFrame([(layout,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path.rstrip('/')}/{LAYOUT}")


class PoseStore:
    """A store that was written before."""

    def __init__(self, spark: SparkSession, path: str):
        from pyspark.sql.types import StructType

        self.spark, self.path = spark, path.rstrip("/")
        layout = json.loads(spark.read.text(f"{self.path}/{LAYOUT}").first()["value"])
        self.buckets, self.by, self.schema = layout["buckets"], layout["by"], StructType.fromJson(layout["schema"])
        self.name = f"pose_store_{uuid.uuid4().hex}"
        quoted = lambda c: f"`{c.replace('`', '``')}`"
        columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in [*(f for f in self.schema if f.name not in self.by), *(self.schema[c] for c in self.by)])
        parts = f"partitioned by ({', '.join(map(quoted, self.by))}) " if self.by else ""
        spark.sql(f"create table {self.name} ({columns}) using parquet {parts}clustered by ({KEY}) sorted by ({KEY}) into {self.buckets} buckets location '{self.path}'")
        if self.by:
            spark.sql(f"msck repair table {self.name}")

    def close(self) -> None:
        """Forget the table; its files stay."""
        self.spark.sql(f"drop table if exists {self.name}")

    def poses(self) -> DataFrame:
        """All poses, known to be bucketed: a join or grouping by compound does not move them."""
        return self.spark.read.table(self.name)

    def bucket(self, df: DataFrame) -> Column:
        """The bucket of each row of ``df``, as the writer deals them."""
        return F.pmod(F.hash(df[KEY].cast(self.schema[KEY].dataType)), F.lit(self.buckets))

    def files(self, hits: DataFrame) -> list[str]:
        """The files whose partition and bucket ``hits`` names (at most buckets times partitions)."""
        named = hits.select(*[F.col(c).cast("string").alias(c) for c in self.by], self.bucket(hits).alias("bucket")).distinct().collect()  # at most a row a file
        wanted = {(tuple(r[c] for c in self.by), r["bucket"]) for r in named}
        found = []
        root, fs = _fs(self.spark, self.path)
        every = fs.listFiles(root, True)
        while every.hasNext():
            path = every.next().getPath()
            text = str(path.toString())
            if not path.getName().endswith(".parquet") or f"/{LAYOUT}/" in text:
                continue
            inside = dict(p.split("=", 1) for p in text.split("/") if "=" in p)
            values = tuple(self._value(inside.get(c)) for c in self.by)
            number = int(path.getName().rsplit("_", 1)[-1].split(".", 1)[0])
            if (values, number) in wanted:
                found.append(text)
        return sorted(found)

    def _value(self, text: str | None) -> str | None:
        if text is None or text == "__HIVE_DEFAULT_PARTITION__":
            return None
        return self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName(text)

    def fetch(self, hits: DataFrame, columns: Sequence[str] = ("block",), part: float = 0.5) -> DataFrame:
        """``hits`` (compound_id, pose_idx and the store's ``by``) with ``columns`` of their poses; hits without a pose fall out.

        Where hits lie in up to ``part`` of the files only those are read; else the store is joined
        in its buckets, and the hits go to them.
        """
        hits = cut_lineage(hits)
        keys = [*self.by, KEY, "pose_idx"]
        files = self.files(hits)
        if not files:
            poses = self.poses().limit(0)
        elif len(files) <= part * self.buckets * max(1, hits.select(*self.by).distinct().count() if self.by else 1):
            poses = self.spark.read.schema(self.schema).option("basePath", self.path).parquet(*files)
        else:
            poses = self.poses()
        names = unused([*hits.columns, *columns], *[f"pose_{i}" for i in range(len(keys))])
        poses = poses.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], *columns)
        # Only the compound is a key of the join: with more keys the buckets would no longer do, and both sides be moved.
        cond = F.lit(True)
        for k, n in zip(keys, names):
            cond &= hits[k] == F.col(n) if k == KEY else (hits[k] <= F.col(n)) & (hits[k] >= F.col(n))
        return hits.join(poses, cond).drop(*names)
