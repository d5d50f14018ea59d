"""Resuming by content: a ledger of what was done, to which bytes, with which parameters.

Work goes in batches. A batch's results and its ledger entries are written to one folder under a
name that readers pass over, which is then renamed: a batch is there as a whole or not at all. An
entry is (path, length, digest, parameters, error). A file is done if its latest entry has no error
and names the bytes it has now and the parameters asked for. Changed files, files that failed and
files done with other parameters are done again; results of files that are gone, or done anew, are
no longer read.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievespark.session import cut_lineage

#: The column of results that says which batch they are of.
MARK = "ledger_batch"
ENTRY = "path string, length long, digest string, parameters string, error string, batch long"


def listed(spark: SparkSession, folder: str, pattern: str = "*.sdf") -> DataFrame:
    """(path, length, digest, content) of every file below ``folder``."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(folder)
    return files.select("path", "length", F.sha2("content", 256).alias("digest"), "content")


class Ledger:
    """A folder of batches, each with ``entries`` and ``results``."""

    def __init__(self, spark: SparkSession, folder: str, **parameters: object):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.parameters = json.dumps(parameters, sort_keys=True, default=str)
        self._at = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._at(self.folder).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())

    def batches(self) -> list[str]:
        """Names of the committed batches, in the order of their numbers."""
        root = self._at(self.folder)
        if not self._fs.exists(root):
            return []
        names = [str(s.getPath().getName()) for s in self._fs.listStatus(root)]
        return sorted(n for n in names if n.startswith("batch-"))

    def entries(self) -> DataFrame:
        """The latest entry of every file that was ever tried."""
        names = self.batches()
        if not names:
            return self.spark.createDataFrame([], ENTRY)
        rows = self.spark.read.schema(ENTRY).parquet(*[f"{self.folder}/{n}/entries" for n in names])
        latest = F.max_by(F.struct("length", "digest", "parameters", "error", "batch"), "batch").alias("e")
        return rows.groupBy("path").agg(latest).select("path", "e.*")

    def todo(self, files: DataFrame) -> DataFrame:
        """The rows of ``files`` (path, length, digest, ...) that are not done with these bytes and parameters."""
        done = self.entries().where(F.col("error").isNull() & (F.col("parameters") == self.parameters)).select("path", "length", "digest")
        return files.join(done, ["path", "length", "digest"], "left_anti")

    def commit(self, entries: DataFrame, results: DataFrame | None) -> str | None:
        """Add a batch: entries (path, length, digest, error) and results (path, ...). Its name, or none if there was nothing."""
        names = self.batches()
        number = int(names[-1].split("-")[1]) + 1 if names else 0
        rows = entries.select("path", "length", "digest", F.lit(self.parameters).alias("parameters"), F.col("error").cast("string").alias("error"), F.lit(number).cast("long").alias("batch"))
        return None if rows.isEmpty() else self._put(number, rows, results)

    def _put(self, number: int, entries: DataFrame, results: DataFrame | None) -> str:
        hidden, name = f"{self.folder}/_batch-{uuid.uuid4().hex}", f"batch-{number:09d}"
        entries.write.parquet(f"{hidden}/entries")
        if results is not None:
            results.withColumn(MARK, F.lit(number).cast("long")).write.parquet(f"{hidden}/results")
        if self._fs.exists(self._at(f"{self.folder}/{name}")) or not self._fs.rename(self._at(hidden), self._at(f"{self.folder}/{name}")):
            self._fs.delete(self._at(hidden), True)
            raise RuntimeError(f"another run has committed {name}")
        return name

    def run(self, files: DataFrame, work: Callable[[DataFrame], DataFrame], again: bool = True) -> int:
        """Do what is to be done: ``work`` gets the open files and returns rows with path and error (null where all went well).

        A file with any row of an error has failed. Results of files without a row are empty, not
        failed. With ``again`` false, files whose latest entry is a failure on the same bytes and
        parameters are left. Returns the number of files tried.
        """
        open_ = self.todo(files)
        if not again:
            failed = self.entries().where(F.col("error").isNotNull() & (F.col("parameters") == self.parameters)).select("path", "length", "digest")
            open_ = open_.join(failed, ["path", "length", "digest"], "left_anti")
        open_ = cut_lineage(open_)
        rows = cut_lineage(work(open_))
        bad = rows.where(F.col("error").isNotNull()).groupBy("path").agg(F.min("error").alias("error"))
        entries = open_.select("path", "length", "digest").join(bad, "path", "left")
        self.commit(entries, rows.join(bad.select("path"), "path", "left_anti"))
        return open_.count()

    def _live(self, done: DataFrame) -> DataFrame | None:
        """Result rows of the batches that ``done`` (path, batch) names, with their MARK; none if no batch has any."""
        names = [n for n in self.batches() if self._fs.exists(self._at(f"{self.folder}/{n}/results"))]
        if not names:
            return None
        rows = self.spark.read.option("mergeSchema", "true").parquet(*[f"{self.folder}/{n}/results" for n in names])
        live = done.select(F.col("path").alias("done_path"), F.col("batch").alias("done_batch"))
        return rows.join(live, (F.col("path") == F.col("done_path")) & (F.col(MARK) == F.col("done_batch")), "left_semi")

    def results(self, files: DataFrame | None = None) -> DataFrame | None:
        """Rows of the files that are done; with ``files`` only of those that are there with these bytes. None if no batch has any."""
        done = self.entries().where(F.col("error").isNull() & (F.col("parameters") == self.parameters))
        if files is not None:
            done = done.join(files.select("path", "length", "digest"), ["path", "length", "digest"], "left_semi")
        live = self._live(done)
        return None if live is None else live.drop(MARK)

    def compact(self) -> None:
        """Write the latest entries and the results that belong to them as one batch, then remove the older ones.

        If that is broken off, batches that say the same stay beside each other; readers take the latest.
        """
        names = self.batches()
        if len(names) < 2:
            return
        entries = cut_lineage(self.entries())
        live = self._live(entries.where(F.col("error").isNull()))
        number = int(names[-1].split("-")[1]) + 1
        self._put(number, entries.withColumn("batch", F.lit(number).cast("long")), live)
        for old in names:
            self._fs.delete(self._at(f"{self.folder}/{old}"), True)
