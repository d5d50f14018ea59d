"""Session factory and the shared-folder helpers every operator may use."""

from __future__ import annotations

import atexit
import gc
import shutil
import tempfile
import time
import uuid
import weakref

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: Paths of the tables that are still there, by the DataFrame that reads them.
_TABLES: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def build_session(app: str = "sievespark", master: str | None = None, **conf: object) -> SparkSession:
    """A session with adaptive execution, UTC time and Arrow transfer; ``conf`` overrides."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    }
    for key, value in {**defaults, **{k.replace("__", "."): str(v) for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables; columns and filters are pushed into the Parquet scan."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """This application's folder below ``spark.checkpoint.dir``; a local one only where that is unset."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        folder = sc.getConf().get("spark.checkpoint.dir")
        if not folder and not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        if not folder:
            folder = tempfile.mkdtemp(prefix="sievespark-checkpoint-")
            atexit.register(shutil.rmtree, folder, ignore_errors=True)
        sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` once as a table in the shared folder and go on from there.

    Lost executors cost at most the stage in hand. :func:`drop` removes a table that nothing reads
    any more; the rest stays as long as the shared folder does.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _TABLES[out] = path
    return out


def cut_and_count(df: DataFrame) -> tuple[DataFrame, int]:
    """The same, and the number of its rows, counted on the way."""
    seen = Observation()
    out = cut_lineage(df.observe(seen, F.count(F.lit(1)).alias("n")))
    return out, int(seen.get.get("n") or 0)


def drop(*tables: DataFrame) -> None:
    """Remove tables of :func:`cut_lineage`, and :func:`release` the shuffle files behind them."""
    for table in tables:
        path = _TABLES.pop(table, None)
        if path:
            jvm = table.sparkSession._jvm
            folder = jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(table.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)
    if tables:
        release(tables[0].sparkSession)


def release(spark: SparkSession, wait: float = 0.0) -> None:
    """Let the JVM's cleaner remove the shuffle files of what is finished.

    The cleaner goes by garbage collection, which a driver with a large heap may not see for hours.
    What was finished last outlives the first collection; where its files are large, a second one
    ``wait`` seconds later removes them too.
    """
    gc.collect()  # the driver's Python holds on to plans too
    spark._jvm.System.gc()
    if wait:
        time.sleep(wait)
        spark._jvm.System.gc()
