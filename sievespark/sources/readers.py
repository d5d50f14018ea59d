"""Readers of pose files, tables, receptor lines and torsion rules."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievespark.functions.scalar import file_stem, pose_score, property_map, split_blocks
from sievespark.operators.ranking import ranked
from sievespark.sources.schemas import TABLES


def first_match(spark: SparkSession, pattern: str) -> str:
    """The first path, in order of names, that a glob pattern meets; an error if there is none."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).globStatus(path) or []
    names = sorted(str(f.getPath()) for f in found)
    if not names:
        raise FileNotFoundError(pattern)
    return names[0]


def read_poses(spark: SparkSession, folder: str, numbered: bool = False) -> DataFrame:
    """(path, compound_id, pose_idx, block, score) of every *.sdf below ``folder``; one file a compound.

    ``numbered`` adds ``seq``, the file's place in order of paths, which decides ties of scores.
    """
    files = spark.read.text(folder, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.sdf").select(F.input_file_name().alias("path"), "value")
    blocks = files.select("path", file_stem(F.col("path")).alias("compound_id"), F.posexplode_outer(split_blocks(F.col("value"))).alias("pose_idx", "block"))
    scored = blocks.withColumn("score", pose_score(F.col("block")))
    if not numbered:
        return scored
    return scored.join(ranked(files.select(F.col("path")).distinct(), ["path"], name="seq"), "path")


def read_conformations(spark: SparkSession, folders: dict[str, str], numbered: bool = False) -> DataFrame:
    """(conformation, ...) of :func:`read_poses`, a folder for each conformation."""
    parts = [read_poses(spark, folder, numbered).withColumn("conformation", F.lit(name)) for name, folder in folders.items()]
    return reduce(DataFrame.unionByName, parts)


def read_tagged(spark: SparkSession, path: str, key: str | None = None, numbered: bool = False) -> DataFrame:
    """(block, properties) of large files of many compounds, split at their terminators while reading.

    ``numbered`` adds ``seq``, the block's place over all parts in order of their names; a block
    without the property ``key`` is an error.
    """
    text = spark.read.text(path, lineSep="$$$$\n")
    place = [F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("at")] if numbered else []
    rows = text.select("value", *place).where(F.trim("value") != "").select(F.concat("value", F.lit("$$$$\n")).alias("block"), *(["path", "start", "at"] if numbered else []))
    if numbered:
        rows = ranked(rows, ["path", "start", "at"], name="seq").select("block", "seq")
    rows = rows.withColumn("properties", property_map(F.col("block")))
    if key and not rows.where(F.try_element_at("properties", F.lit(key)).isNull()).isEmpty():
        raise ValueError(f"a block has no property {key}")
    return rows


def read_stage_table(spark: SparkSession, name: str, path: str) -> DataFrame:
    """A stage's table from CSV with its declared schema; blanks are null."""
    return spark.read.schema(TABLES[name]).csv(path, header=True)


def read_receptor(spark: SparkSession, path: str) -> DataFrame:
    """Lines in file order: (line_no, value)."""
    text = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", r"\r?\n")).alias("line_no", "value"))
    return text.where("value <> ''")


def read_torsion_rules(spark: SparkSession, path: str) -> DataFrame:
    """(rule, class, smarts, method, bins, angles) in order of evaluation: all classes, the general one last.

    A rule library is one small file; it is parsed once and its order is kept.
    """
    import xml.etree.ElementTree as ET

    text = spark.read.text(path, wholetext=True).first()["value"]
    rows: list[tuple] = []
    tops = [c for c in ET.fromstring(text) if c.tag == "hierarchyClass"]
    for top in [c for c in tops if c.get("name") != "GG"] + [c for c in tops if c.get("name") == "GG"]:
        for rule in top.iter("torsionRule"):
            bins = [{k: float(b.get(k)) for k in ("energy", "lower", "upper")} for b in rule.iter("bin") if b.get("energy") is not None]
            angles = [{k: float(a.get(k)) for k in ("theta_0", "tolerance2", "beta_1", "beta_2")} for a in rule.iter("angle") if a.get("theta_0") is not None]
            rows.append((len(rows), top.get("name"), rule.get("smarts"), rule.get("method"), bins, angles))
    bin_ = "array<struct<energy:double,lower:double,upper:double>>"
    angle = "array<struct<theta_0:double,tolerance2:double,beta_1:double,beta_2:double>>"
    return spark.createDataFrame(rows, f"rule int, class string, smarts string, method string, bins {bin_}, angles {angle}")
