"""Gene -> mRNA -> exon/CDS hierarchies: completion, phases, naming, introns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from genespark.functions.columns import first_word, swap_kind


def complete(features: DataFrame) -> DataFrame:
    """Adds what a whole set lacks: an mRNA for each gene, a CDS for each exon, or an exon for each CDS.

    features: chrom, source, type, start, end, strand, frame, id, parent_id. Which parts are missing is decided
    by the types in the whole set, by one row of flags that every branch is joined with.
    """
    kinds = features.agg(F.collect_set("type").alias("kinds"))
    have = lambda t: F.array_contains("kinds", t)
    flags = F.broadcast(kinds.select((~have("mRNA") & have("gene")).alias("no_mrna"), (~have("CDS") & have("exon")).alias("no_cds"), (~have("exon") & have("CDS")).alias("no_exon")))
    rows = features.join(flags)
    cols = features.columns
    mrna = rows.where("no_mrna and type = 'gene'").withColumn("parent_id", F.col("id")).withColumn("id", F.concat("id", F.lit("_mRNA"))).withColumn("type", F.lit("mRNA"))
    frame = F.when(F.col("strand") == "-", F.pmod(F.col("start") - 1, F.lit(3))).otherwise(F.pmod(F.col("end") + 1, F.lit(3)))
    cds = rows.where("no_cds and type = 'exon'").withColumn("id", swap_kind(F.col("id"), "exon", "CDS")).withColumn("type", F.lit("CDS")).withColumn("frame", frame.cast("string"))
    exon = rows.where("no_exon and type = 'CDS'").withColumn("id", swap_kind(F.col("id"), "CDS|cds", "exon")).withColumn("type", F.lit("exon")).withColumn("frame", F.lit("."))
    return features.unionByName(mrna.select(*cols)).unionByName(cds.select(*cols)).unionByName(exon.select(*cols))


def five_to_three(start: str = "start", strand: str = "strand") -> Column:
    """Orders parts of a feature in the direction of transcription."""
    return F.when(F.col(strand) == "-", -F.col(start)).otherwise(F.col(start))


def fix_phases(cds: DataFrame, parent: str = "parent_id", tie: str = "id") -> DataFrame:
    """Adds phase: bases to skip to the next codon, from the lengths of the CDS parts before (closed form of the recurrence)."""
    w = Window.partitionBy(parent).orderBy(five_to_three(), tie).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(F.col("end") - F.col("start") + 1).over(w), F.lit(0).cast("long"))
    return cds.withColumn("phase", F.pmod(-before, F.lit(3).cast("long")))


def locus_tags(genes: DataFrame, name: str, chunk: int = 10_000_000) -> DataFrame:
    """Adds tag: <name>_00001, ... over genes by (chrom, start, id).

    Numbers are global: counts of (chrom, chunk of bases) are summed over one row a chunk, and added to the place
    within the chunk, so the genes themselves never meet in one task.
    """
    rows = genes.withColumn("_chunk", F.floor(F.col("start") / chunk))
    total = rows.groupBy("chrom", "_chunk").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("chrom", "_chunk").rowsBetween(Window.unboundedPreceding, -1)
    total = total.select("chrom", "_chunk", F.coalesce(F.sum("_n").over(before), F.lit(0).cast("long")).alias("_before"))
    own = F.row_number().over(Window.partitionBy("chrom", "_chunk").orderBy("start", "id"))
    return rows.join(total, ["chrom", "_chunk"]).withColumn("tag", F.concat(F.lit(name + "_"), F.format_string("%05d", own + F.col("_before")))).select(*genes.columns, "tag")


def prettify(genes: DataFrame, mrnas: DataFrame, parts: DataFrame, name: str) -> DataFrame:
    """New ids for a whole hierarchy: type, id, parent_id, locus_tag, old_id.

    mRNAs are <gene>.mRNA.<n>, their parts <mRNA>:<type>:<n>, each numbered by start; exons come before CDS.
    """
    tagged = locus_tags(genes, name)
    gene = tagged.select("id", "tag")
    m = mrnas.join(gene.withColumnRenamed("id", "_g"), F.col("parent_id") == F.col("_g"))
    m = m.withColumn("new_id", F.concat("tag", F.lit(".mRNA."), F.row_number().over(Window.partitionBy("tag").orderBy("start", "id")).cast("string")))
    p = parts.join(m.select(F.col("id").alias("_m"), F.col("new_id").alias("mrna"), "tag"), F.col("parent_id") == F.col("_m"))
    number = F.row_number().over(Window.partitionBy("mrna", "type").orderBy("start", "id")).cast("string")
    return (
        tagged.select(F.lit("gene").alias("type"), F.col("tag").alias("id"), F.lit(None).cast("string").alias("parent_id"), F.col("tag").alias("locus_tag"), F.col("id").alias("old_id"))
        .unionByName(m.select(F.lit("mRNA").alias("type"), F.col("new_id").alias("id"), F.col("tag").alias("parent_id"), F.col("tag").alias("locus_tag"), F.col("id").alias("old_id")))
        .unionByName(p.select("type", F.concat_ws(":", "mrna", "type", number).alias("id"), F.col("mrna").alias("parent_id"), F.col("tag").alias("locus_tag"), F.col("id").alias("old_id")))
    )


def introns(cds: DataFrame, parent: str = "parent_id", tie: str = "id") -> DataFrame:
    """Gaps between consecutive parts by start: id <parent>:intron:<n>. Overlapping parts give empty or negative gaps, which match nothing."""
    w = Window.partitionBy(parent).orderBy("start", tie)
    out = cds.withColumn("_next", F.lead("start").over(w)).withColumn("_n", F.row_number().over(w)).where("_next is not null")
    return out.select("chrom", "strand", (F.col("end") + 1).alias("start"), (F.col("_next") - 1).alias("end"), F.concat_ws(":", parent, F.lit("intron"), F.col("_n").cast("string")).alias("id"), F.col(parent).alias("parent_id"))


def gene_bounds(cds: DataFrame, gene: str = "gene_id") -> DataFrame:
    """Genes as spans of all their CDS; genes without CDS are not made."""
    return cds.groupBy("chrom", "strand", gene).agg(F.min("start").alias("start"), F.max("end").alias("end"), F.count(F.lit(1)).alias("n_cds"))


def strip_contig_names(features: DataFrame) -> DataFrame:
    return features.withColumn("chrom", first_word(F.col("chrom")))


def cds_hints(features: DataFrame) -> DataFrame:
    """CDS rows as hints: type CDSpart, priority 1, source P, grouped by parent."""
    return features.where("type = 'CDS'").withColumn("type", F.lit("CDSpart")).withColumn("attributes", F.concat(F.lit("pri=1;src=P;group="), F.col("parent_id")))


def keep_types(features: DataFrame, kinds: tuple[str, ...], source: str | None = None) -> DataFrame:
    """Rows of the given types, with their source set."""
    out = features.where(F.col("type").isin(*kinds))
    return out.withColumn("source", F.lit(source)) if source else out


def exon_roles(exons: DataFrame, parent: str = "parent_id", tie: str = "id") -> DataFrame:
    """Adds role: Esngl, Einit, Exon or Eterm by place and strand; from and to are swapped on the minus strand."""
    w = Window.partitionBy(parent)
    k, n = F.row_number().over(w.orderBy(five_to_three(), tie)), F.count(F.lit(1)).over(w)
    role = F.when(n == 1, "Esngl").when(k == 1, "Einit").when(k == n, "Eterm").otherwise("Exon")
    return exons.withColumn("role", role).withColumn("from", F.when(F.col("strand") == "-", F.col("end")).otherwise(F.col("start"))).withColumn("to", F.when(F.col("strand") == "-", F.col("start")).otherwise(F.col("end")))
