"""Gene finders' and aligners' features brought to one hierarchy, and the inputs made from them for later steps.

features: as sources.gff.features() gives them (chrom, source, type, start, end, strand, id, parent_id, ...).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from genespark.operators.graph import with_parents
from genespark.operators.hierarchy import complete, exon_roles, strip_contig_names
from genespark.operators.intervals import nonoverlapping_genes, nonoverlapping_models
from genespark.sources.gff import combined

# fixed values: evidence files, their class, source and which of the weights (protein, prediction, transcript) they take
EVIDENCE = (
    ("prot.gff3", "PROTEIN", "prot_align", 0),
    ("augustus.gff3", "ABINITIO_PREDICTION", "augustus", 1),
    ("snap.gff3", "ABINITIO_PREDICTION", "snap", 1),
    ("genemark.gff3", "ABINITIO_PREDICTION", "genemark", 1),
    ("codingquarry.gff3", "ABINITIO_PREDICTION", "codingquarry", 1),
    ("nr_transcripts.gff3", "TRANSCRIPT", "PASA-assembly", 2),
)


def _child(kind: str = "_mRNA"):
    return F.concat("parent_id", F.lit(kind))


def transcript_models(features: DataFrame) -> DataFrame:
    """Transcripts become mRNAs <gene>_mRNA, their parts hang below those, a gene with a parent takes its id.

    Features without a parent keep the id they have; a part without one has none afterwards either.
    """
    kind = F.col("type")
    new_id = F.when(kind == "transcript", F.coalesce(_child(), F.col("id"))).when(kind == "gene", F.coalesce("parent_id", "id")).otherwise(F.col("id"))
    parent = F.when(kind == "gene", F.lit(None).cast("string")).when(kind == "transcript", F.col("parent_id")).otherwise(_child())
    return features.withColumns({"id": new_id, "parent_id": parent, "type": F.when(kind == "transcript", "mRNA").otherwise(kind)})


def protein_alignments(features: DataFrame) -> DataFrame:
    """Aligned proteins: lower-case 'cds' becomes CDS <parent>:<id>, the source prot_align."""
    low = F.col("type") == "cds"
    return features.withColumns({"id": F.when(low, F.concat_ws(":", "parent_id", "id")).otherwise(F.col("id")), "type": F.when(low, "CDS").otherwise(F.col("type")), "source": F.lit("prot_align")})


def threaded_models(features: DataFrame) -> DataFrame:
    """Genes and exons only, the exons below <gene>_mRNA, the source prot_align."""
    rows = features.where(F.col("type").isin("gene", "exon"))
    return rows.withColumns({"parent_id": F.when(F.col("type") == "exon", _child()).otherwise(F.col("parent_id")), "source": F.lit("prot_align")})


def coding_models(features: DataFrame, source: str) -> DataFrame:
    """CDS below <gene>_mRNA; the source is set."""
    return features.withColumns({"parent_id": F.when(F.col("type") == "CDS", _child()).otherwise(F.col("parent_id")), "source": F.lit(source)})


def normalize(features: DataFrame, *, parse=None, post=None, add_missing: bool = True, fix_contigs: bool = False) -> DataFrame:
    """`parse`, missing levels, `post` and contig names, in this order; each step is left out if not asked for."""
    cols = ["chrom", "source", "type", "start", "end", "strand", "frame", "id", "parent_id"]
    rows = features.transform(parse) if parse else features
    rows = complete(rows.select(*cols)) if add_missing else rows
    rows = rows.transform(post) if post else rows
    return strip_contig_names(rows) if fix_contigs else rows


def running_number(rows: DataFrame, order: str = "line_no", chunk: int = 100_000) -> DataFrame:
    """Adds n: 1, 2, ... by `order` (a number) over all rows; ties take any order.

    Counts of ranges of `chunk` are summed over one row a range, so the rows never meet in one task.
    """
    part = rows.withColumn("_chunk", F.floor(F.col(order) / chunk))
    sums = part.groupBy("_chunk").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col("_chunk").alias("_c"), F.coalesce(F.sum("_n").over(before), F.lit(0).cast("long")).alias("_before"))
    own = F.row_number().over(Window.partitionBy("_chunk").orderBy(order))
    return part.withColumn("_own", own).join(sums, F.col("_chunk").eqNullSafe(F.col("_c"))).select(*rows.columns, (F.col("_own") + F.col("_before")).alias("n"))


def assembled_exons(features: DataFrame) -> DataFrame:
    """Every row of an assembly as an exon <transcript>:exon:<n> of its transcript (its id), numbered over the whole file; a row without id belongs to ''."""
    transcript = F.coalesce("id", F.lit(""))
    rows = running_number(features.withColumn("_t", transcript)).withColumns({"source": F.lit("PASA-assembly"), "type": F.lit("exon"), "parent_id": F.col("_t")})
    return rows.withColumn("id", F.concat("_t", F.lit(":exon:"), F.col("n").cast("string"))).drop("_t", "n")


def evidence_weights(files: DataFrame, weights: tuple[int, int, int] = (2, 1, 3)) -> DataFrame:
    """(name, kind, source, weight, prediction) for files (name): unknown names have no weight, but count as predictions."""
    known = files.sparkSession.createDataFrame([(n, k, s, weights[w]) for n, k, s, w in EVIDENCE], "_n string, kind string, source string, weight int")
    apart = [n for n, k, _, _ in EVIDENCE if k != "ABINITIO_PREDICTION"]
    return files.join(F.broadcast(known), F.col("name") == F.col("_n"), "left").select("name", "kind", "source", "weight", (~F.col("name").isin(*apart)).alias("prediction"))


def patch_consensus(consensus: DataFrame, orfs: DataFrame) -> DataFrame:
    """The consensus with all features of those ORF genes that overlap none of its genes and have CDS.

    Both: chrom, strand, start, end, type, id, gene_id (the gene that a feature belongs to; a gene's own id).
    """
    gene = lambda df: df.where("type = 'gene'")
    new = nonoverlapping_genes(gene(orfs), gene(consensus), orfs.where("type = 'CDS'").select("gene_id"))
    return consensus.unionByName(orfs.join(new.select(F.col("id").alias("gene_id")), "gene_id", "left_semi").select(*consensus.columns))


def patch_models(consensus: DataFrame, orfs: DataFrame) -> DataFrame:
    """The same for features as sources.gff.features() gives them, with several parents and any depth: what ORF genes bring is merged in.

    Features that agree in all but attributes become one; an id that the consensus has otherwise gets a number.
    """
    new = nonoverlapping_models(orfs, consensus.where("type = 'gene'")).dropDuplicates(["row_"])
    both = with_parents(consensus).withColumn("part_", F.lit(0)).unionByName(with_parents(new.select(*orfs.columns)).withColumn("part_", F.lit(1)), allowMissingColumns=True)
    return combined(both, "merge", ("part_", "line_no")).drop("part_")


def zff_lines(exons: DataFrame, contigs: DataFrame, parent: str = "parent_id", tie: str = "id") -> DataFrame:
    """(chrom, position, mrna, k, value): '>contig' and its exons by role; ordering by all but value gives the file.

    contigs: chrom, position; those without exons are listed, exons of other contigs are not.
    """
    roles = exon_roles(exons, parent, tie).withColumn("k", F.row_number().over(Window.partitionBy(parent).orderBy("start", tie)))
    line = F.concat(F.col("role"), F.lit("  "), F.concat_ws(" ", F.col("from").cast("string"), F.col("to").cast("string"), parent))
    rows = roles.select("chrom", F.col(parent).alias("mrna"), "k", line.alias("value")).join(contigs.select("chrom", "position"), "chrom")
    heads = contigs.select("chrom", "position", F.lit("").alias("mrna"), F.lit(0).alias("k"), F.concat(F.lit(">"), "chrom").alias("value"))
    return heads.unionByName(rows.select(*heads.columns))


def split_size(contigs: DataFrame, cpus: int) -> DataFrame:
    """(total, size): bases of all contigs (chrom, seq), and of a split for 2 `cpus` tasks, 1 at least."""
    total = F.coalesce(F.sum(F.length("seq").cast("long")), F.lit(0).cast("long"))
    return contigs.agg(total.alias("total")).withColumn("size", F.greatest(F.lit(1).cast("long"), F.expr(f"total div {2 * cpus}")))
