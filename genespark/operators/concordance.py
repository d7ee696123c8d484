"""Gene models that independent sources agree on, and their union."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from genespark.operators.intervals import cut_with_levels, interval_join, levels_of, same_span
from genespark.operators.lineage import cut

WEAK = 250


def boundaries_match(a: Column, b: Column, tolerance: int = 3) -> Column:
    """Arrays of (start, end), sorted by start: inner ends agree within `tolerance`; the first start and last end are free."""
    n = F.size(a)
    near = F.zip_with(a, b, lambda x, y: F.struct(F.abs(x["start"] - y["start"]).alias("s"), F.abs(x["end"] - y["end"]).alias("e")))
    at = F.transform(near, lambda d, i: ((i == 0) | (d["s"] <= tolerance)) & ((i == n - 1) | (d["e"] <= tolerance)))
    return (n == F.size(b)) & F.forall(at, lambda ok: ok)


def with_parts(mrnas: DataFrame, cds: DataFrame) -> DataFrame:
    """mRNAs that have CDS, with the sorted array of their parts."""
    parts = cds.groupBy(F.col("parent_id").alias("_m")).agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("parts"))
    return mrnas.join(parts, F.col("id") == F.col("_m")).drop("_m")


def concordant_genes(a: tuple[DataFrame, DataFrame], b: tuple[DataFrame, DataFrame], width: int = 2000) -> DataFrame:
    """gene_id of a's genes of which some mRNA agrees with some mRNA of b. a, b: (mRNAs with parent_id, CDS)."""
    pairs = interval_join(with_parts(*a), with_parts(*b), width=width, levels=tuple(levels_of(a[0], b[0], width=width)))
    same = same_span(F.col("l_start"), F.col("l_end"), F.col("r_start"), F.col("r_end"))
    return pairs.where(same & boundaries_match(F.col("l_parts"), F.col("r_parts"))).select(F.col("l_parent_id").alias("gene_id")).distinct()


def nonredundant(*sources: DataFrame) -> DataFrame:
    """Union of genes by id: the earliest source that has an id keeps it; adds prio. Two or three sources."""
    if len(sources) not in (2, 3):
        raise ValueError("two or three sources")
    rows = reduce(DataFrame.unionByName, (s.withColumn("prio", F.lit(i)) for i, s in enumerate(sources)))
    first = F.row_number().over(Window.partitionBy("id").orderBy("prio"))
    return rows.withColumn("_k", first).where("_k = 1").drop("_k")


def descendants(kept: DataFrame, features: DataFrame) -> DataFrame:
    """Features (prio, gene_id) of the genes that nonredundant() kept."""
    return features.join(kept.select("prio", F.col("id").alias("gene_id")), ["prio", "gene_id"], "left_semi")


def supported(models: list[tuple[DataFrame, DataFrame, DataFrame]], width: int = 2000, tolerance: int = 3) -> DataFrame:
    """Genes on which two of the sources agree: for three sources the union of pairwise agreements (0,1), (0,2), (2,1).

    models: (genes, mRNAs with parent_id, CDS). All sources' mRNAs are put into bins together and joined with themselves, so they are moved once,
    not once for each other source.
    """
    if len(models) not in (2, 3):
        raise ValueError("two or three sources")
    needed = ("chrom", "strand", "start", "end", "id", "parent_id")
    rows = reduce(DataFrame.unionByName, (with_parts(m.select(*needed), cds).drop("id").withColumn("source", F.lit(i)) for i, (_, m, cds) in enumerate(models)))
    rows = rows.withColumn("parts", F.flatten(F.transform("parts", lambda x: F.array(x["start"] - F.col("start"), x["end"] - F.col("start")))))  # small numbers, which pack well
    rows, found = cut_with_levels(rows, width)
    pairs = interval_join(rows, rows, width=width, levels=(found, found)).where("l_source < r_source")
    same = same_span(F.col("l_start"), F.col("l_end"), F.col("r_start"), F.col("r_end"))
    # the gene is that of the first source; of the last where it agrees with the second
    first = F.col("l_source") == 0
    gene = F.when(first, F.col("l_parent_id")).otherwise(F.col("r_parent_id"))
    n = F.size("l_parts")
    apart = F.zip_with("l_parts", "r_parts", lambda x, y: F.abs(x - y + F.col("l_start") - F.col("r_start")))
    near = (n == F.size("r_parts")) & F.forall(F.transform(apart, lambda d, i: (d <= tolerance) | (i == 0) | (i == n - 1)), lambda ok: ok)  # as boundaries_match
    agreed = pairs.where(same & near).select(gene.alias("id"), F.when(first, F.col("r_source") - 1).otherwise(2).alias("prio")).distinct()
    agreed = cut(agreed)  # read for each pair of sources
    by = (0, 0, 2)
    kept = [models[i][0].join(agreed.where(F.col("prio") == k).select("id"), "id", "left_semi") for k, i in enumerate(by[: 1 if len(models) == 2 else 3])]
    return kept[0] if len(kept) == 1 else nonredundant(*kept)


def training_set(genes: DataFrame) -> DataFrame:
    """n, size (a quarter, 1 at least) and flank (half the mean of end - start) of a training set."""
    return genes.agg(F.count(F.lit(1)).alias("n"), F.greatest(F.lit(1).cast("long"), F.floor(F.count(F.lit(1)) / 4)).alias("size"), (F.avg(F.col("end") - F.col("start")) / 2).cast("int").alias("flank"))


def source_counts(genes: DataFrame, source: str = "source") -> DataFrame:
    """Genes of each source; weak marks fewer than 250 where there are three sources."""
    counts = genes.groupBy(source).agg(F.count(F.lit(1)).alias("n"))
    sources = F.count(F.lit(1)).over(Window.partitionBy())
    return counts.withColumn("weak", (sources == 3) & (F.col("n") < WEAK))
