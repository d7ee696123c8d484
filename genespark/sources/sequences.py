"""FASTA in and out."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from genespark.operators.tiles import TILE


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """(header, chrom, seq): records are split by '\\n>'; chrom is the header up to the first blank."""
    rows = spark.read.option("lineSep", "\n>").text(path).where("value <> ''")
    body = F.regexp_replace("value", "^>", "")
    header = F.substring_index(body, "\n", 1)
    seq = F.regexp_replace(F.substring(body, F.length(header) + 1, F.length(body)), r"[\r\n]", "")
    return rows.select(F.trim(header).alias("header"), F.get(F.split(F.trim(header), r"\s+"), 0).alias("chrom"), seq.alias("seq"))


def _gathered(rows: DataFrame, size: int) -> DataFrame:
    """(file, split_, k, from_, at_, head_, text_) of lines (file, split_, value) in the order of the file: a row for each header, and one for each
    stretch of up to `size` letters below it.

    k numbers the headers of a split from 1 on (0: what comes before the first), from_ is how many letters of the split, and at_ how many
    since its last header, come before the row. Lines lie one after another in a batch, so a stretch is cut from it as a whole.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, k, count, at = None, 0, 0, 0
        for batch in batches:
            if not len(batch):
                continue
            value, splits, files = batch.column("value").cast(pa.large_string()), batch.column("split_").to_numpy(), batch.column("file").dictionary_encode()
            ends = np.frombuffer(value.buffers()[1], np.int64, len(value) + 1, value.offset * 8)
            data = memoryview(value.buffers()[2] or b"")
            names, number = files.dictionary.to_pylist(), files.indices.to_numpy()
            heads = pc.starts_with(value, ">").to_numpy(zero_copy_only=False)
            fresh = np.flatnonzero((np.diff(splits) != 0) | (np.diff(number) != 0)) + 1
            at_head = np.flatnonzero(heads)
            cuts = np.unique(np.concatenate(([0], fresh, at_head, at_head + 1, [len(batch)])))
            out: list[tuple] = []
            for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                where = (names[number[i]], int(splits[i]))
                if where != now:
                    now, k, count, at = where, 0, 0, 0
                text = bytes(data[ends[i] : ends[j]]).decode()
                if heads[i]:
                    k, at = k + 1, 0
                    out.append((*where, k, count, 0, text, ""))
                    continue
                text = text.replace("\r", "")
                for x in range(0, len(text), size):
                    piece = text[x : x + size]
                    out.append((*where, k, count, at, None, piece))
                    count, at = count + len(piece), at + len(piece)
            columns = zip(*out, strict=True) if out else [[]] * len(kind)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, kind, strict=True)], schema=kind)

    kind = pa.schema([("file", pa.string()), ("split_", pa.int64()), ("k", pa.int64()), ("from_", pa.int64()), ("at_", pa.int64()), ("head_", pa.string()), ("text_", pa.string())])
    return rows.mapInArrow(run, "file string, split_ long, k long, from_ long, at_ long, head_ string, text_ string")


def read_tiles(spark: SparkSession, path: str, size: int = TILE, over: int = 1) -> DataFrame:
    """(file, record, header, chrom, n, tile, piece): FASTA records in tiles of `size` bases with `over` of what follows, as tiled() cuts them.

    The file is read by lines in splits, so a chromosome is never one row. Two things must be known of a line: its record and how
    many bases of the record come before it. Both are counted within a split as it is read, then summed over one row a split; the
    last header of a split is handed on to those after it. Letters are moved once, into their tiles, in stretches of lines. Lines before the
    first header belong to no record; carriage returns are left off; an empty record has one empty tile. Records of equal headers stay apart
    by their number.
    """
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split_"), "value")
    rows = _gathered(lines, size).withColumn("len_", F.length("text_").cast("long"))
    before = Window.partitionBy("file").orderBy("split_").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    splits = rows.groupBy("file", "split_").agg(F.max("k").alias("r_"), F.sum("len_").alias("b_"), F.max(F.when(F.col("k") > 0, F.col("from_") - F.col("at_"))).alias("last_"))
    splits = splits.withColumn("r0_", F.coalesce(F.sum("r_").over(before), zero)).withColumn("b0_", F.coalesce(F.sum("b_").over(before), zero))
    # the bases of the file before the record that is open where the split begins; none: there is no such record
    splits = splits.withColumn("open_", F.last(F.col("b0_") + F.col("last_"), ignorenulls=True).over(before))
    rows = rows.join(F.broadcast(splits.select("file", "split_", "r0_", "b0_", "open_")), ["file", "split_"]).where("k > 0 or open_ is not null")
    at = F.when(F.col("k") > 0, F.col("at_")).otherwise(F.col("b0_") + F.col("from_") - F.col("open_"))
    rows = rows.select("file", (F.col("r0_") + F.col("k")).alias("record"), "head_", "text_", "len_", at.alias("at_"))
    facts = rows.groupBy("file", "record").agg(F.sum("len_").alias("n"), F.trim(F.substring(F.max("head_"), 2, 1 << 30)).alias("header"))
    first, final = F.greatest(F.floor((F.col("at_") - over) / size), zero), F.greatest(F.floor((F.col("at_") + F.col("len_") - 1) / size), zero)
    parts = rows.withColumn("tile", F.explode(F.sequence(F.least(first, final), final)))
    low, high = F.greatest(F.col("at_"), F.col("tile") * size), F.least(F.col("at_") + F.col("len_"), F.col("tile") * size + size + over)
    parts = parts.select("file", "record", "tile", low.alias("low_"), F.substring(F.col("text_"), (low - F.col("at_") + 1).cast("int"), F.greatest(high - low, zero).cast("int")).alias("part_"))
    tiles = parts.groupBy("file", "record", "tile").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("low_", "part_"))), lambda x: x["part_"]), "").alias("piece"))
    return tiles.join(facts, ["file", "record"]).select("file", "record", "header", F.get(F.split("header", r"\s+"), 0).alias("chrom"), "n", "tile", "piece")


def fasta_text(sequences: DataFrame, name: str = "chrom", seq: str = "seq", width: int = 60) -> DataFrame:
    """(value): one row a record, '>' and the sequence in lines of `width`; a null sequence is an empty one."""
    return sequences.select(F.concat(F.lit(">"), F.col(name), F.lit("\n"), F.regexp_replace(F.coalesce(seq, F.lit("")), f"(.{{{width}}})(?=.)", "$1\n")).alias("value"))


def by_length(sequences: DataFrame) -> DataFrame:
    """Upper-cased, longest first."""
    return sequences.withColumn("seq", F.upper("seq")).orderBy(F.desc(F.length("seq")), "chrom")


def check(sequences: DataFrame) -> None:
    if not sequences.limit(1).count():
        raise ValueError("no sequence")
