"""Tool outputs: junction tables, KO lists, logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

JUNCTIONS = "chrom string, intron_start long, intron_end long, strand int, motif int, annotated int, unique long, multi long, overhang int"


def read_junctions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, sep="\t", schema=JUNCTIONS)


def ko_list(rows: DataFrame) -> DataFrame:
    """(k_number, threshold, score_type, definition) from (line_no, value): the header and rows of under 12 columns are passed
    over, '-' is no threshold, the last row of a KO counts."""
    cols = F.split("value", "\t")
    rows = rows.where("line_no > 0").withColumn("_c", cols).where(F.size("_c") >= 12)
    last = F.row_number().over(Window.partitionBy(F.get("_c", 0)).orderBy(F.desc("line_no")))
    rows = rows.withColumn("_k", last).where("_k = 1")
    return rows.select(F.get("_c", 0).alias("k_number"), F.expr("try_cast(_c[1] as double)").alias("threshold"), F.get("_c", 2).alias("score_type"), F.get("_c", 11).alias("definition"))


def mapping_rate(rows: DataFrame, least: float = 75.0) -> DataFrame:
    """(unique, multiple, total, low) percentages from a mapper's final log (value)."""
    share = lambda name: F.max(F.when(F.col("value").contains(name), F.expr("try_cast(regexp_extract(value, '([0-9.]+)%', 1) as double)")))
    out = rows.agg(F.coalesce(share("Uniquely mapped reads %"), F.lit(0.0)).alias("unique"), F.coalesce(share("% of reads mapped to multiple loci"), F.lit(0.0)).alias("multiple"))
    return out.withColumn("total", F.col("unique") + F.col("multiple")).withColumn("low", F.col("total") < least)


def names(rows: DataFrame) -> DataFrame:
    """(name): lines that aren't blank or comments."""
    return rows.select(F.trim("value").alias("name")).where("name <> '' and not startswith(name, '#')")
