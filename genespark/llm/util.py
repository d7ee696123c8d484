"""Shared plumbing: scratch tables in the shared folder, and Arrow scans over whole texts."""

from __future__ import annotations

import atexit
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

WS = r"\x20\x09-\x0D"
_roots: dict[str, tuple[SparkSession, str]] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; where the session names none, one of our own is set, in local mode only."""
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not base:
        known = sc._jsc.sc().getCheckpointDir()
        if known.isDefined():
            base = known.get()
        elif not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        else:
            base = "file://" + tempfile.mkdtemp(prefix="genespark-")
            sc.setCheckpointDir(base)
    return base


def _root(spark: SparkSession) -> str:
    app = spark.sparkContext.applicationId
    if app not in _roots:
        _roots[app] = (spark, f"{shared_dir(spark)}/genespark-{uuid.uuid4().hex}")
    return _roots[app][1]


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write `df` as Parquet in the shared folder and read it back: cuts lineage and survives lost executors."""
    path = f"{_root(df.sparkSession)}/{tag}-{uuid.uuid4().hex[:8]}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out


def discard(df: DataFrame) -> None:
    """Delete the files of a table made by materialize(), once nothing reads them any more."""
    if path := getattr(df, "_scratch_path", None):
        _delete(df.sparkSession, path)


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


@atexit.register
def cleanup() -> None:
    """Delete this process's scratch tables of sessions that still run."""
    for spark, path in list(_roots.values()):
        if spark.sparkContext._jsc is not None:
            try:
                _delete(spark, path)
            except Exception:  # noqa: BLE001  the JVM may be gone at exit
                pass
    _roots.clear()


def join_hot(rows: DataFrame, table: DataFrame, on: dict[str, str], count: str, most: int = 4096) -> DataFrame:
    """`rows` with the columns of `table`, which has one row for each key; `on` names the key's column in each. A row without a match is left out.

    `count` holds for how many rows a key is met. The keys of more than one row in `most`, so at most `most` keys, are
    broadcast; the rest are shuffled, and none of those brings more than that share of the rows to a task. Null keys are equal.
    `table` should be a stored one: it is read three times.
    """
    total = table.agg(F.coalesce(F.sum(count), F.lit(0))).first()[0]
    hot = F.col(count) * most > F.lit(total)
    right = table.select(*(F.col(b).alias(f"key_{a}") for a, b in on.items()), *(F.col(c) for c in table.columns if c not in on.values()))

    def fits(left: DataFrame, keys: DataFrame) -> Column:
        test = F.lit(True)
        for a in on:
            test &= left[a].eqNullSafe(keys[f"key_{a}"])
        return test

    often, rest = F.broadcast(right.where(hot)), right.where(~hot)
    shuffled = rows.join(often, fits(rows, often), "left_anti")
    joined = shuffled.join(rest, fits(shuffled, rest), "inner")
    return rows.join(often, fits(rows, often), "inner").unionByName(joined).drop(*(f"key_{a}" for a in on), count)


def crc_mod(col: str, n: int) -> Column:
    """crc32 of the id as text, modulo n; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")) % n


def ascii_lower(col: Column) -> Column:
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


class Texts:
    """UTF-8 bytes of some rows' texts; a null text is empty and marked in `null`."""

    def __init__(self, column: pa.Array):
        column = column.cast(pa.large_string())
        n = len(column)
        offsets = np.frombuffer(column.buffers()[1], np.int64, n + 1, column.offset * 8) if n else np.zeros(1, np.int64)
        data = column.buffers()[2]
        self.data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
        self.offsets, self.n = offsets, n
        self.null = np.asarray(column.is_null())
        # a null slot may cover bytes in a foreign buffer: lengths decide
        self.lengths = np.where(self.null, 0, np.diff(offsets)) if n else np.zeros(0, np.int64)

    def bytes(self, i: int) -> bytes:
        return self.data[self.offsets[i] : self.offsets[i] + self.lengths[i]].tobytes()

    def joined(self, lead: bytes = b"", tail: bytes = b"") -> tuple[np.ndarray, np.ndarray]:
        """One buffer of lead + text + tail for each row, and the start of each row's text."""
        parts = []
        for i in range(self.n):
            parts += (lead, self.bytes(i), tail)
        starts = np.cumsum(self.lengths + len(lead) + len(tail)) - self.lengths - len(tail)
        return np.frombuffer(b"".join(parts), np.uint8), starts


def pieces(batches: Iterator[pa.RecordBatch], text: int, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """Slices whose texts hold at most `most_bytes` together, or one row: memory is bounded by the longest text."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.nan_to_num(pc.binary_length(batch.column(text)).to_numpy(zero_copy_only=False).astype(float))
        at, total = 0, 0.0
        for i, size in enumerate(sizes):
            if i > at and total + size > most_bytes:
                yield batch.slice(at, i - at)
                at, total = i, 0.0
            total += size
        yield batch.slice(at, batch.num_rows - at)


def map_text(df: DataFrame, text: str, make: Callable[[], Callable[..., list[pa.Array]]], fields: Sequence[tuple[str, str]], keep: Sequence[str] | None = None, args: Sequence[str] = (), most_bytes: int = 1 << 21) -> DataFrame:
    """Columns `keep` of `df` (default: all), with result columns from whole texts.

    `make()` runs once a task and returns the function from some rows' texts (and their columns `args`) to one
    Arrow array for each of `fields` (name, DDL type). A result column replaces a kept column of its name.
    """
    names = {n for n, _ in fields}
    keep = [c for c in (df.columns if keep is None else keep) if c not in names]
    inner = [F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)] + [F.col(f"`{text}`").cast("string").alias("t")]
    at = len(keep)
    source = df.select(*inner, *(F.col(f"`{c}`").alias(f"a{i}") for i, c in enumerate(args)))
    schema = T.StructType([*source.schema.fields[:at], *T.StructType.fromDDL(", ".join(f"r{i} {t}" for i, (_, t) in enumerate(fields))).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = make()
        for part in pieces(batches, at, most_bytes):
            arrays = of(Texts(part.column(at)), *part.columns[at + 1 :])
            yield pa.RecordBatch.from_arrays([*part.columns[:at], *arrays], [f"k{i}" for i in range(at)] + [f"r{i}" for i in range(len(arrays))])

    out = source.mapInArrow(run, schema)
    return out.toDF(*keep, *(n for n, _ in fields))


def lists(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """An Arrow list column from concatenated values and the length of each list."""
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), pa.array(values))


def mix64(x: np.ndarray) -> np.ndarray:
    """A finaliser that spreads 64-bit values (xor-shift-multiply)."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished steps: it does so when the driver's garbage is collected."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
