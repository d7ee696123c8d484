"""Open reading frames: splicing, codon scan, longest ORF, mapping back to the genome, translation."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from genespark.functions import codons
from genespark.functions.columns import reverse_complement
from genespark.operators.hierarchy import five_to_three
from genespark.operators.intervals import merge_overlapping_genes
from genespark.operators.lineage import cut
from genespark.operators.tiles import entering, tiled


#: Bases a tile holds from which parts are cut.
CUT = 4096


def spliced(parts: DataFrame, contigs: DataFrame, parent: str = "parent_id", tile: int = CUT) -> DataFrame:
    """(id, chrom, start, strand, seq): the parts' sequences in order, reverse-complemented on the minus strand; case is kept.

    contigs: chrom, seq; they are joined as tiles of `tile` bases, by chrom and tile. Bases beyond a contig are left
    off; parts on a contig that isn't there, or wholly beyond it, give nothing. In a tile without letters of several bytes a
    part is found at its byte; else letters are counted from the tile's first one.
    """
    rows = parts.select("chrom", "strand", "start", "end", F.col(parent).alias("id"), F.monotonically_increasing_id().alias("_k"))
    rows = rows.withColumn("tile", F.explode(F.sequence(F.expr(f"(greatest(start, 1) - 1) div {tile}"), F.expr(f"(greatest(`end`, 1) - 1) div {tile}"))))
    tiles = tiled(contigs, tile).withColumn("plain_", F.octet_length("piece") == F.length("piece"))
    rows = rows.join(tiles, ["chrom", "tile"]).where("start <= n")
    base = F.col("tile") * tile
    low, high = F.greatest(F.col("start") - base, F.lit(1).cast("long")), F.least(F.col("end") - base, F.lit(tile).cast("long"))
    at, many = low.cast("int"), F.greatest(high - low + 1, F.lit(0).cast("long")).cast("int")
    piece = rows.withColumn("_piece", F.when(F.col("plain_"), F.substring(F.col("piece").cast("binary"), at, many).cast("string")).otherwise(F.substring("piece", at, many)))
    joined = piece.groupBy("id", "chrom", "strand").agg(F.min("start").alias("start"), F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("start", "end", "_k", "tile", "_piece"))), lambda x: x["_piece"]), "").alias("_whole"))
    return joined.select("id", "chrom", "start", "strand", F.when(F.col("strand") == "-", reverse_complement(F.col("_whole"))).otherwise(F.col("_whole")).alias("seq"))


def translated(sequences: DataFrame, code: int = 1, seq: str = "seq") -> DataFrame:
    return sequences.withColumn("protein", codons.translate(F.col(seq), code))


#: Bases a row of a codon scan holds.
SCAN = 16_384


def codon_hits(sequences: DataFrame, code: int = 1, tile: int = SCAN) -> DataFrame:
    """(id, seqlen, pos, strand, codon, frame): start and stop codons, each kind from left to right without overlap.

    sequences: id, seq, strand, or tiles of sequences of `tile` bases (4 at least) with two bases more (id, strand, n, tile, piece).
    pos is 1-based, frame (pos - 1) mod 3.

    A sequence is scanned tile by tile. A match that begins in one tile may end in the next, so a tile can be entered
    with 0, 1 or 2 of its bases taken. Which is the case depends on all tiles before; so each tile is scanned for all three
    cases, which gives the step from case to case, and the steps are combined along the sequence. Tiles are stored, as both passes
    read them; a sequence of one tile takes no part in the first.
    """
    if tile < 4:
        raise ValueError("a tile holds four bases at least")
    named = sequences.select(F.struct("id", "strand").alias("of"), *(c for c in sequences.columns if c in ("seq", "n", "tile", "piece")))
    rows = cut(tiled(named, tile, 2, "of").select("of", "tile", "n", F.regexp_replace(F.upper("piece"), "#", "N").alias("piece")))

    patterns = {"start": "|".join(codons.starts(code)), "stop": "|".join(codons.stops(code))}

    def marked(kind: str, taken: Column) -> Column:
        """The tile after its first bases that are taken. A regular expression's matches are leftmost and do not overlap: each is marked."""
        return F.regexp_replace(F.substring("piece", taken + 1, F.lit(tile + 2)), patterns[kind], "#..")

    def taken_next(kind: str, taken: int) -> Column:
        """How many bases of the next tile the last match takes: it then begins at this tile's last base or the one before."""
        m = marked(kind, F.lit(taken))
        return F.when(F.substring(m, tile - taken, 1) == "#", 2).when(F.substring(m, tile - 1 - taken, 1) == "#", 1).otherwise(0)

    # both kinds in one state, 3 x starts + stops
    each = rows.where(F.col("n") > tile).select("of", "tile", *(F.array(*(taken_next(kind, t) for t in range(3))).alias(kind) for kind in patterns))
    state = entering(each, ["of"], "tile", F.flatten(F.transform("start", lambda a: F.transform("stop", lambda b: 3 * a + b))), 9)
    long = rows.where(F.col("n") > tile).join(state, ["of", "tile"], "left").withColumn("state", F.coalesce("state", F.lit(0)))
    known = rows.where(F.col("n") <= tile).withColumn("state", F.lit(0)).unionByName(long)
    taken = {"start": F.expr("state div 3").cast("int"), "stop": F.col("state") % 3}
    found = known.select("of", "n", "tile", *(taken[k].alias(f"{k}_taken") for k in patterns), *(marked(k, taken[k]).alias(k) for k in patterns))
    return _marks(found, tile).select("of.id", F.col("n").cast("int").alias("seqlen"), F.col("pos").cast("int").alias("pos"), "of.strand", "codon", ((F.col("pos") - 1) % 3).cast("int").alias("frame"))


def _marks(rows: DataFrame, tile: int) -> DataFrame:
    """(of, n, codon, pos): a row for each '#' in the columns start and stop; their first base is the one after those taken.

    A tile's places come back from Python as one list a kind.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for kind in ("start", "stop"):
                text = Texts(batch.column(kind))
                hits = np.flatnonzero(text.data == ord("#"))
                row = np.searchsorted(text.ends, hits, "right")
                begin = batch.column("tile").to_numpy() * tile + batch.column(f"{kind}_taken").to_numpy()
                pos = hits - text.starts[row] + 1 + begin[row]
                ends = np.searchsorted(row, np.arange(len(batch) + 1))
                places = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(pos, pa.int64()))
                yield pa.RecordBatch.from_arrays([batch.column("of"), batch.column("n"), pa.array([kind] * len(batch), pa.string()), places], ["of", "n", "codon", "places"])

    schema = T.StructType([rows.schema["of"], rows.schema["n"], *T.StructType.fromDDL("codon string, places array<long>").fields])
    return rows.mapInArrow(run, schema).select("of", "n", "codon", F.explode("places").alias("pos"))


class Texts:
    """The bytes of an Arrow column of strings, and where each begins and ends; a null is empty."""

    def __init__(self, column: pa.Array):
        column = column.fill_null("").cast(pa.large_string())
        offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
        self.data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
        self.starts, self.ends = offsets[:-1] - offsets[0], offsets[1:] - offsets[0]


def longest_orfs(hits: DataFrame, min_len: int = 90, min_share: float = 0.5, block: int = 1 << 20) -> DataFrame:
    """(id, seqlen, start, stop, strand, frame, orflen): the longest ORF of each (id, strand).

    A start reaches to the next stop downstream in its frame; orflen is stop - start and must exceed min_len and
    min_share of the sequence. Ties: the first start in a frame; of frames, the one whose first codon comes first.

    The next stop is looked for within blocks of `block` bases, and beyond a block's last stop in one row for each block,
    so a task holds no more than a block of a sequence's frame.
    """
    hits = cut(hits)  # read by blocks' facts and by what is within them
    frame = ["id", "strand", "frame"]
    stop = F.when(F.col("codon") == "stop", F.col("pos"))
    rows = hits.withColumn("block_", F.expr(f"pos div {block}"))
    # backwards: a frame that grows is kept up row by row, one that shrinks is read anew for each row
    later = Window.partitionBy(*frame).orderBy(F.desc("block_")).rowsBetween(Window.unboundedPreceding, -1)
    facts = rows.groupBy(*frame, "block_").agg(F.min(stop).alias("own_"), F.min("pos").alias("low_"))
    facts = facts.select(*(F.col(c).alias(f"{c}_") for c in frame), F.col("block_").alias("b_"), F.min("own_").over(later).alias("later_"), F.min("low_").over(Window.partitionBy(*frame)).alias("first_"))
    on = F.col("block_") == F.col("b_")
    for c in frame:
        on &= F.col(c).eqNullSafe(F.col(f"{c}_"))
    ahead = Window.partitionBy(*frame, "block_").orderBy(F.desc("pos")).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("near_", F.min(stop).over(ahead)).where("codon = 'start'").join(facts, on)
    rows = rows.withColumn("stop_", F.coalesce("near_", "later_")).withColumn("orflen", F.col("stop_") - F.col("pos"))
    rows = rows.where((F.col("orflen") > min_len) & (F.col("orflen") / F.col("seqlen") > min_share))
    row = F.struct("seqlen", F.col("pos").alias("start"), (F.col("stop_") + 2).alias("stop"), "frame", "orflen")
    best = rows.groupBy("id", "strand").agg(F.max_by(row, F.struct("orflen", -F.col("first_"), -F.col("pos"))).alias("x"))
    return best.select("id", "x.seqlen", "x.start", "x.stop", "strand", "x.frame", "x.orflen")


def map_to_genome(orfs: DataFrame, exons: DataFrame, minus_strand_compat: bool = True, parent: str = "parent_id", tie: str = "id") -> DataFrame:
    """CDS rows (chrom, strand, start, end, phase, id, parent_id) of ORFs on transcripts.

    Each exon covers a stretch of its transcript (lengths summed 5' to 3'); what the ORF shares with it is
    mapped back. With minus_strand_compat the ORF's last base is left off on the minus strand.
    """
    w = Window.partitionBy(parent).orderBy(five_to_three(), tie).rowsBetween(Window.unboundedPreceding, -1)
    length = F.col("end") - F.col("start") + 1
    rows = exons.withColumn("_before", F.coalesce(F.sum(length).over(w), F.lit(0).cast("long"))).withColumn("_len", length)
    rows = rows.join(orfs.select(F.col("id").alias("_t"), F.col("start").alias("_from"), F.col("stop").alias("_to")), F.col(parent) == F.col("_t"))
    to = F.when(F.col("strand") == "-", F.col("_to") - (1 if minus_strand_compat else 0)).otherwise(F.col("_to"))
    # half-open, from 0, within the exon
    low, high = F.greatest(F.col("_from") - 1 - F.col("_before"), F.lit(0).cast("long")), F.least(to - F.col("_before"), F.col("_len"))
    rows = rows.withColumn("_low", low).withColumn("_high", high).where("_low < _high")
    minus = F.col("strand") == "-"
    out = rows.select("chrom", "strand", F.when(minus, F.col("end") - F.col("_high") + 1).otherwise(F.col("start") + F.col("_low")).alias("start"), F.when(minus, F.col("end") - F.col("_low")).otherwise(F.col("start") + F.col("_high") - 1).alias("end"), F.regexp_replace("id", "exon", "CDS").alias("id"), F.col(parent).alias("parent_id"))
    before = F.coalesce(F.sum(F.col("end") - F.col("start") + 1).over(Window.partitionBy("parent_id").orderBy(five_to_three(), "id").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long"))
    return out.withColumn("phase", F.pmod(-before, F.lit(3).cast("long")))


def transcript_orfs(exons: DataFrame, contigs: DataFrame, code: int = 1, min_len: int = 90, min_share: float = 0.5, parent: str = "parent_id") -> dict[str, DataFrame]:
    """genes, mrnas and cds of assembled transcripts: spliced, scanned, the longest ORF mapped back, overlapping genes merged.

    exons: chrom, strand, start, end, id, parent_id (the transcript); contigs: chrom, seq. A transcript without an ORF
    beyond both limits keeps its gene and mRNA and has no CDS.
    """
    sequences = spliced(exons, contigs, parent)
    cds = map_to_genome(longest_orfs(codon_hits(sequences, code), min_len, min_share), exons, parent=parent)
    genes = exons.groupBy("chrom", "strand", F.col(parent).alias("id")).agg(F.min("start").alias("start"), F.max("end").alias("end"))
    mrnas = genes.select("chrom", "strand", F.concat("id", F.lit("_mRNA")).alias("id"), F.col("id").alias("parent_id"), "start", "end")
    kept, moved = merge_overlapping_genes(genes, mrnas)
    return {"genes": kept, "mrnas": moved, "cds": cds.withColumn("parent_id", F.concat("parent_id", F.lit("_mRNA")))}
