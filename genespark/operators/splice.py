"""Splice junctions, hints and related summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from genespark.functions.columns import splice_code
from genespark.operators.tiles import TILE, tiled

# Junction motif numbers, strands, and the kinds that need no configuration.
MOTIFS = {1: "GT-AG", 2: "CT-AC", 3: "GC-AG", 4: "CT-GC", 5: "AT-AC", 6: "GT-AT"}
STRANDS = {0: ".", 1: "+", 2: "-"}
BUILTIN = ("gtag", "gcag")
NORMAL, PERMISSIVE = (10, 50, 0.01), (1, 1, 0.0)


def _lookup(values: dict, column: str, otherwise: str):
    table = F.create_map(*(F.lit(x) for k, v in values.items() for x in (k, v)))
    return F.coalesce(F.try_element_at(table, F.col(column).cast("int")), F.lit(otherwise))


def tally(junctions: DataFrame, contigs: DataFrame | None = None, tile: int = TILE) -> DataFrame:
    """(type, count, unique_reads): by motif; motif 0 by the intron's outer dinucleotides on the plus strand.

    junctions: chrom, intron_start, intron_end, motif, unique. contigs: chrom, seq. An unknown contig or an end beyond it: 'unknown'.
    """
    named = junctions.where("motif <> 0").select(_lookup(MOTIFS, "motif", "unknown").alias("type"), F.lit(1).cast("long").alias("n"), "unique")
    span = ["chrom", "intron_start", "intron_end"]
    # junctions of one span have one type
    rows = junctions.where("motif = 0").groupBy(*span).agg(F.count(F.lit(1)).alias("n"), F.sum("unique").alias("unique"))
    if contigs is not None:
        # both ends meet the tiles in one join; tiles hold one base of the next, so two bases never lie in different ones
        at = F.explode(F.array(*(F.struct(F.lit(k).alias("end"), p.alias("at")) for k, p in ((0, F.col("intron_start") - 1), (1, F.col("intron_end") - 2)))))
        ends = rows.select(*span, "n", "unique", at.alias("x")).select(*span, F.col("n").alias("n_"), "unique", "x.end", "x.at", F.expr(f"x.at div {tile}").alias("tile"))
        ends = ends.join(tiled(contigs, tile), ["chrom", "tile"], "left")
        two = F.when(F.col("intron_end") <= F.col("n"), F.upper(F.substring("piece", (F.pmod("at", F.lit(tile)) + 1).cast("int"), F.lit(2))))
        rows = ends.groupBy(*span).agg(F.first("n_").alias("n"), F.first("unique").alias("unique"), F.max(F.when(F.col("end") == 0, two)).alias("a"), F.max(F.when(F.col("end") == 1, two)).alias("b"))
        inner = F.coalesce(F.concat("a", F.lit("-"), "b"), F.lit("unknown"))
    else:
        inner = F.lit("unknown")
    rows = named.unionByName(rows.select(inner.alias("type"), "n", "unique"))
    return rows.groupBy("type").agg(F.sum("n").alias("count"), F.sum("unique").cast("long").alias("unique_reads"))


def extra_types(summary: DataFrame, permissive: bool = False) -> DataFrame:
    """(code): splice kinds frequent enough to be allowed besides the built-in ones."""
    count, unique, share = PERMISSIVE if permissive else NORMAL
    total = F.sum("count").over(Window.partitionBy())
    rows = summary.withColumn("_share", F.col("count") / total).where((F.col("count") >= count) & (F.col("unique_reads") >= unique) & (F.col("_share") >= share))
    return rows.select(splice_code(F.col("type")).alias("code")).where(F.col("code").isNotNull() & ~F.col("code").isin(*BUILTIN)).distinct()


def intron_hints(junctions: DataFrame) -> DataFrame:
    """Introns as hints; multiplicity is unique plus multiple reads."""
    mult = F.col("unique") + F.col("multi")
    return junctions.select("chrom", F.lit("STAR").alias("source"), F.lit("intron").alias("type"), F.col("intron_start").alias("start"), F.col("intron_end").alias("end"), mult.cast("string").alias("score"), _lookup(STRANDS, "strand", ".").alias("strand"), F.lit(".").alias("frame"), F.format_string("mult=%d;pri=4;src=E", mult.cast("long")).alias("attributes"))


def repeat_hints(rows: DataFrame) -> DataFrame:
    """Repeats as nonexonpart hints."""
    return rows.withColumn("type", F.lit("nonexonpart")).withColumn("attributes", F.lit("src=RM"))


def transcript_hints(exons: DataFrame) -> DataFrame:
    """Exons of assembled transcripts as hints, grouped by transcript."""
    return exons.withColumn("type", F.lit("exon")).withColumn("attributes", F.concat(F.lit("pri=3;src=E;group="), F.col("parent_id")))


def enough_introns(hints: DataFrame, least: int = 150) -> DataFrame:
    """(n, use_hints): intron hints and whether they suffice."""
    n = F.count_if(F.col("type") == "intron")
    return hints.agg(n.alias("n"), (n >= least).alias("use_hints"))


def intron_lengths(rows: DataFrame) -> DataFrame:
    """(length, n): histogram of end - start of all rows."""
    return rows.where("start is not null and end is not null").groupBy((F.col("end") - F.col("start")).alias("length")).agg(F.count(F.lit(1)).alias("n"))


def introns_per_gene(genes: DataFrame, cds: DataFrame) -> DataFrame:
    """(introns, genes, per_gene, many): all CDS of a gene count once, isoforms included; many above 0.25."""
    n = cds.groupBy(F.col("gene_id").alias("_g")).agg(F.count(F.lit(1)).alias("_n"))
    rows = genes.join(n, F.col("id") == F.col("_g"), "left").agg(F.sum(F.greatest(F.coalesce("_n", F.lit(0).cast("long")) - 1, F.lit(0).cast("long"))).alias("introns"), F.count(F.lit(1)).alias("genes"))
    rows = rows.withColumn("per_gene", F.coalesce(F.try_divide(F.col("introns"), F.col("genes")), F.lit(0.0)))
    return rows.withColumn("many", F.col("per_gene") > 0.25)


def gene_length_limit(genes: DataFrame) -> DataFrame:
    """(limit): mean plus two sample deviations of abs(end - start), each truncated."""
    length = F.abs(F.col("end") - F.col("start"))
    return genes.agg((F.avg(length).cast("long") + 2 * F.coalesce(F.stddev_samp(length), F.lit(0.0)).cast("long")).alias("limit"))


def summary_text(tallied: DataFrame) -> DataFrame:
    """(value): a tally as one JSON object, most frequent types first (equal ones by name); a few hundred types at most."""
    order = F.struct((-F.col("count")).alias("n"), "type", "unique_reads")
    entry = lambda x: F.format_string('  "%s": {\n    "count": %d,\n    "unique_reads": %d\n  }', x["type"], -x["n"], x["unique_reads"])
    entries = F.array_join(F.transform(F.sort_array(F.collect_list(order)), entry), ",\n")
    return tallied.agg(F.when(F.count(F.lit(1)) > 0, F.concat(F.lit("{\n"), entries, F.lit("\n}"))).otherwise("{}").alias("value"))


def summary_json(tallied: DataFrame) -> str:
    """The text of summary_text()."""
    return summary_text(tallied).first().value
