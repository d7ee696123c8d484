"""A stored annotation: features laid out by where they lie, so that overlap joins over it move no rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from genespark.functions.columns import overlap_bp, overlaps
from genespark.operators.intervals import bins_of, level_of, width_of
from genespark.operators.lineage import fresh_path

PLACE = ("chrom", "strand", "level_", "bin_")


def buckets_for(rows: int, least: int = 64, full: int = 200_000) -> int:
    """Buckets for tables of up to `rows` features: `least`, doubled until a bucket, which is one task, holds `full` features at most."""
    n = least
    while n * full < rows:
        n *= 2
    return n


def store(features: DataFrame, name: str, *, buckets: int = 64, width: int = 2000, copies: int = 4, top: int = 3, path: str | None = None) -> None:
    """Writes features (chrom, strand, start, end, type, ...) as table `name`, bucketed by chromosome, strand and bin, and partitioned by type.

    A feature has a row in the bins of its own level and in those of the wider ones up to `top` that it touches; what is too long for
    the last level touches more of its bins. Tables that are joined must agree in buckets, width, copies and top. Each
    bucket is one file a type and one task's work: buckets_for() has their number grow with the features. The files lie at `path`, by default in the shared folder of this run. Features without a position are left out.
    """
    own = F.least(level_of(F.col("start"), F.col("end"), width, copies), F.lit(top))
    rows = features.withColumn("own_", own).withColumn("x_", F.explode(bins_of(F.col("start"), F.col("end"), F.sequence(F.col("own_"), F.lit(top)), width)))
    rows = rows.select(*features.columns, "own_", F.col("x_.level").alias("level_"), F.col("x_.bin").alias("bin_"))
    laid = rows.repartition(buckets, *PLACE)  # by the hash that decides on the bucket
    laid.write.format("parquet").option("path", path or fresh_path(features.sparkSession)).partitionBy("type").bucketBy(buckets, *PLACE).sortBy(*PLACE).saveAsTable(name)


def stored(spark: SparkSession, name: str, *types: str, width: int = 2000) -> DataFrame:
    """The features of a table, each once; other types' files are not read."""
    rows = spark.table(name)
    rows = rows.where(F.col("type").isin(*types)) if types else rows
    first = F.floor(F.col("start") / width_of(F.col("own_"), width))
    return rows.where((F.col("level_") == F.col("own_")) & (F.col("bin_") == first)).drop("own_", "level_", "bin_")


def overlapping(spark: SparkSession, left: str, right: str, types: tuple[Sequence[str], Sequence[str]] = ((), ()), width: int = 2000, prefixes: tuple[str, str] = ("l_", "r_")) -> DataFrame:
    """Pairs of stored features on one strand that overlap, as intervals.interval_join has them, of the given types (none: all).

    Buckets of equal number are joined where they lie: neither table is moved.
    """
    a, b = prefixes

    def side(name: str, kinds: Sequence[str], prefix: str) -> DataFrame:
        rows = spark.table(name)
        rows = rows.where(F.col("type").isin(*kinds)) if kinds else rows
        return rows.select(*(F.col(c).alias(prefix + c) for c in rows.columns)).hint("merge")

    lhs, rhs = side(left, types[0], a), side(right, types[1], b)
    s1, e1, s2, e2 = F.col(a + "start"), F.col(a + "end"), F.col(b + "start"), F.col(b + "end")
    on = F.lit(True)
    for c in PLACE:
        on &= F.col(a + c) == F.col(b + c)
    on &= overlaps(s1, e1, s2, e2) & (F.col(a + "level_") == F.greatest(a + "own_", b + "own_"))
    on &= F.col(a + "bin_") == F.floor(F.greatest(s1, s2) / width_of(F.col(a + "level_"), width))
    own = {p + c for p in prefixes for c in ("own_", "level_", "bin_")}
    out = lhs.join(rhs, on)
    return out.select(*(c for c in out.columns if c not in own), overlap_bp(s1, e1, s2, e2).alias("bp"))
