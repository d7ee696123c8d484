"""Cutting long lineages."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession

_roots: dict[str, tuple[SparkSession, str]] = {}


def _root(spark: SparkSession) -> str:
    """A folder of our own in that of spark.checkpoint.dir; a temporary one in local mode where the session names none."""
    sc = spark.sparkContext
    if sc.applicationId not in _roots:
        base = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
        known = sc._jsc.sc().getCheckpointDir()
        if not base and known.isDefined():
            base = known.get()
        if not base:
            if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
                raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
            base = "file://" + tempfile.mkdtemp(prefix="genespark-")
        _roots[sc.applicationId] = (spark, f"{base}/genespark-core-{uuid.uuid4().hex}")
    return _roots[sc.applicationId][1]


def fresh_path(spark: SparkSession) -> str:
    """A new path in the shared folder; it goes with the others at the end."""
    return f"{_root(spark)}/{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """`df`, computed once and written as Parquet to the shared folder: what is read again does not grow the plan."""
    path = fresh_path(df.sparkSession)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_observed(df: DataFrame, metrics: dict[str, Column]) -> tuple[DataFrame, dict]:
    """cut(), and aggregates over the rows that come with the same job."""
    seen = Observation()
    out = cut(df.observe(seen, *(m.alias(k) for k, m in metrics.items())))
    return out, seen.get


@atexit.register
def release() -> None:
    """Delete this process's tables of sessions that still run; call it once their readers are done."""
    for spark, path in list(_roots.values()):
        sc = spark.sparkContext
        if sc._jsc is not None:
            try:
                target = sc._jvm.org.apache.hadoop.fs.Path(path)
                target.getFileSystem(sc._jsc.hadoopConfiguration()).delete(target, True)
            except Exception:  # noqa: BLE001  the JVM may be gone at exit
                pass
    _roots.clear()
