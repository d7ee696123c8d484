"""Facts about files, by Spark's readers: the newest, the first that holds anything, compression, small JSON."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def listed(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """(path, name, size, modified) of the files under a folder whose names fit; contents are not read."""
    rows = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(folder)
    return rows.select("path", F.substring_index("path", "/", -1).alias("name"), F.col("length").alias("size"), F.col("modificationTime").alias("modified"))


def newest(files: DataFrame, otherwise: str) -> str:
    """The path of the file changed last; `otherwise` where there is none. Names do not count: numbers in them differ in width."""
    return files.agg(F.max_by("path", "modified").alias("p")).first().p or otherwise


def first_filled(files: DataFrame, ranked: Sequence[str]) -> str | None:
    """The first path of `ranked` that is there and not empty; None if none is."""
    rank = F.array_position(F.array(*(F.lit(p) for p in ranked)), F.col("path"))
    return files.where("size > 0").withColumn("_k", rank).where("_k > 0").agg(F.min_by("path", "_k").alias("p")).first().p


def salvageable(files: DataFrame) -> str | None:
    """The most complete repeat library of the last RM_* folder: the whole one, else by round, latest first, else none."""
    part = lambda p: F.regexp_extract("path", p, 1)
    rows = files.where("size > 0").withColumn("run", part(r"/(RM_[^/]*)/")).where("run <> ''")
    rows = rows.withColumn("round", part(r"/(round-[^/]*)/[^/]+$")).withColumn("kind", F.array_position(F.array(*(F.lit(x) for x in ("consensi.fa.classified", "consensi.fa", "refined-cons.fa"))), F.col("name")))
    last = files.agg(F.max(part(r"/(RM_[^/]*)/")).alias("r")).first().r
    whole = (F.col("round") == "") & (F.col("name") == "consensi.fa") & F.col("path").rlike(r"/RM_[^/]*/consensi\.fa$")
    rows = rows.where((F.col("run") == (last or "")) & (whole | ((F.col("round") != "") & (F.col("kind") > 0))))
    order = rows.select("path", F.when(F.col("round") == "", 0).otherwise(1).alias("a"), "round", "kind").orderBy("a", F.desc("round"), "kind")
    first = order.first()
    return first.path if first else None


def is_gzipped(spark: SparkSession, path: str) -> bool:
    """Whether a file begins with the bytes 1f 8b, whatever its name; two bytes are read."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(target)
    try:
        return (stream.read(), stream.read()) == (0x1F, 0x8B)
    finally:
        stream.close()


def read_json(spark: SparkSession, path: str) -> DataFrame:
    """A cache or manifest that is one JSON document; a document that cannot be parsed gives no row."""
    rows = spark.read.option("multiLine", "true").option("mode", "PERMISSIVE").json(path)
    return rows.where("false") if rows.columns == ["_corrupt_record"] else rows.drop("_corrupt_record")
