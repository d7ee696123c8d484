"""Checks of data while they are written: metrics are observed in the job that writes, and held against a table of limits."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Limit:
    """`metric`, an aggregate over the rows written, must exceed `above`."""

    name: str
    metric: Column
    above: float


def _lines(test: Column) -> Column:
    return F.count_if(test)


# How large the inputs of a test run must be at least.
TEST_DATA = {
    "genome": lambda: Limit("genome", F.coalesce(F.sum(F.octet_length("value") + 1), F.lit(0)), 1_000_000),
    "proteins": lambda: Limit("proteins", _lines(F.startswith("value", F.lit(">"))), 1000),
    "reference": lambda: Limit("reference", _lines(F.contains(F.col("value"), F.lit("\tgene\t"))), 100),
}


def write_observed(rows: DataFrame, path: str, limits: Sequence[Limit], how: str = "parquet") -> DataFrame:
    """Writes `rows` and gives (name, found, above, ok) of each limit, from metrics of that one job: the rows are not read again.

    Without limits nothing is observed. An empty table has the metrics of no rows.
    """
    spark = rows.sparkSession
    schema = "name string, found double, above double, ok boolean"
    if not limits:
        rows.write.format(how).save(path)
        return spark.createDataFrame([], schema)
    seen = Observation()
    rows.observe(seen, *(x.metric.cast("double").alias(x.name) for x in limits)).write.format(how).save(path)
    found = seen.get
    return spark.createDataFrame([(x.name, found.get(x.name), float(x.above), found.get(x.name) is not None and found[x.name] > x.above) for x in limits], schema)


def require(results: DataFrame) -> None:
    """ValueError that names the limits that don't hold; results has one row a limit."""
    bad = [f"{r.name}: {r.found} is not above {r.above}" for r in results.where("not ok").collect()]
    if bad:
        raise ValueError("; ".join(bad))


def read_pairs(names: DataFrame, accessions: int) -> DataFrame:
    """(forward, backward, ok): files (name) of paired reads, <run>_1 and <run>_2, and whether there are as many of each as accessions."""
    one = lambda k: F.count_if(F.col("name").rlike(rf"^SRR.*_{k}\.fastq\.gz$"))
    return names.agg(one(1).alias("forward"), one(2).alias("backward")).withColumn("ok", F.least("forward", "backward") >= accessions)
