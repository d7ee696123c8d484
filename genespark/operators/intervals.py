"""Interval joins, clusters and prefixes. Coordinates are 1-based and inclusive."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from genespark.functions.columns import overlap_bp, overlaps
from genespark.operators.graph import hierarchy
from genespark.operators.lineage import cut_observed


#: Each level's bins are FACTOR times as wide as those of the level before.
FACTOR, LEVELS = 4, 14


def level_of(start: Column, end: Column, width: int, copies: int) -> Column:
    """The finest level of which an interval touches at most `copies` + 1 bins; the last takes what is longer still."""
    steps = [F.when(end - start >= copies * width * FACTOR**k, 1).otherwise(0) for k in range(LEVELS - 1)]
    return reduce(lambda a, b: a + b, steps)


def width_of(level: Column, width: int) -> Column:
    """The width of a level's bins."""
    return F.get(F.array(*(F.lit(width * FACTOR**k).cast("long") for k in range(LEVELS))), level)


def bins_of(start: Column, end: Column, levels: Column, width: int) -> Column:
    """An array of (level, bin): the bins that an interval touches at each of the levels."""
    at = lambda level: F.transform(F.sequence(F.floor(start / width_of(level, width)), F.floor(end / width_of(level, width))), lambda b: F.struct(level.alias("level"), b.alias("bin")))
    return F.flatten(F.transform(levels, at))


def levels_of(*sides: DataFrame, start: str = "start", end: str = "end", width: int = 2000, copies: int = 4) -> list[list[int]]:
    """The levels that each side has, from one job over them all."""
    parts = [x.select(F.lit(i).alias("side"), level_of(F.col(start), F.col(end), width, copies).alias("level")) for i, x in enumerate(sides)]
    found = {r.side: sorted(r.levels) for r in reduce(DataFrame.unionByName, parts).groupBy("side").agg(F.collect_set("level").alias("levels")).collect()}
    return [found.get(i, []) for i in range(len(sides))]


def cut_with_levels(df: DataFrame, width: int = 2000, copies: int = 4) -> tuple[DataFrame, list[int]]:
    """The rows stored, and their levels, which are observed as they are written."""
    tests = {f"level_{k}": F.count_if(level_of(F.col("start"), F.col("end"), width, copies) == k) for k in range(LEVELS)}
    out, seen = cut_observed(df, tests)
    return out, [k for k in range(LEVELS) if seen.get(f"level_{k}")]


def _binned(df: DataFrame, other: Sequence[int], keys: Sequence[str], side: str, start: str, end: str, width: int, copies: int, flat: bool) -> DataFrame:
    """A row for each bin touched, at the row's own level and at the wider ones among `other`. Flat: all is of level 0. Rows with a null key have none."""
    df = df.dropna(subset=list(keys)) if keys else df
    s, e, own = F.col(start), F.col(end), F.col(f"own_{side}")
    cols = [F.col(c).alias(f"{side}{c}") for c in df.columns]
    if flat:
        return df.select(*cols, F.explode(F.sequence(F.floor(s / width), F.floor(e / width))).alias(f"bin_{side}"))
    levels = F.array_union(F.array(own), F.filter(F.array(*(F.lit(x) for x in other)), lambda x: x > own))
    binned = df.withColumn(f"own_{side}", level_of(s, e, width, copies)).select(*cols, own, F.explode(bins_of(s, e, levels, width)).alias("x"))
    return binned.select("*", F.col("x.level").alias(f"level_{side}"), F.col("x.bin").alias(f"bin_{side}")).drop("x")


def interval_join(left: DataFrame, right: DataFrame, *, keys: Sequence[str] = ("chrom", "strand"), start: str = "start", end: str = "end", prefixes: tuple[str, str] = ("l_", "r_"), width: int = 2000, slack: int = 0, copies: int = 4, levels: tuple[Sequence[int], Sequence[int]] | None = None) -> DataFrame:
    """Pairs of rows with equal keys whose intervals overlap (after widening the left one by `slack`).

    Bins have levels, each FACTOR times as wide as the one before, from `width` bases on. A row lies in the finest level
    of which it touches at most `copies` + 1 bins, and is looked for in the wider levels that the other side has (in one or a few bins
    of each): so a feature of megabases is copied a few times, not once for every `width` bases, and one of 50 bases no more
    often. A pair meets at the wider of its two levels, and there in the bin of its later start only, so no distinct
    is needed. Which `levels` the sides have is found by a job over their ends unless it is given (more than there are do no
    harm). Columns get the prefixes; bp is the overlap. Null keys match nothing. The bins are join keys that adaptive execution may
    split where one is crowded.
    """
    a, b = prefixes
    if slack:
        left = left.withColumn("_s", F.col(start) - slack).withColumn("_e", F.col(end) + slack)
        ls, le = "_s", "_e"
    else:
        ls, le = start, end
    if levels is None:
        levels = levels_of(left.select(F.col(ls).alias("start"), F.col(le).alias("end")), right.select(F.col(start).alias("start"), F.col(end).alias("end")), width=width, copies=copies)
    flat = not any(x for side in levels for x in side)
    lhs = _binned(left, levels[1], keys, a, ls, le, width, copies, flat)
    rhs = _binned(right, levels[0], keys, b, start, end, width, copies, flat)
    s1, e1, s2, e2 = F.col(a + ls), F.col(a + le), F.col(b + start), F.col(b + end)
    on = (F.col(f"bin_{a}") == F.col(f"bin_{b}")) & overlaps(s1, e1, s2, e2)
    if not flat:
        on &= (F.col(f"level_{a}") == F.col(f"level_{b}")) & (F.col(f"level_{a}") == F.greatest(f"own_{a}", f"own_{b}"))
    on &= F.col(f"bin_{a}") == F.floor(F.greatest(s1, s2) / (width if flat else width_of(F.col(f"level_{a}"), width)))
    for k in keys:
        on &= F.col(a + k) == F.col(b + k)
    out = lhs.join(rhs, on)
    return out.select(*(a + c for c in left.columns if c not in ("_s", "_e")), *(b + c for c in right.columns), overlap_bp(F.col(a + start), F.col(a + end), F.col(b + start), F.col(b + end)).alias("bp"))


def _matched(left: DataFrame, right: DataFrame, id_cols: Sequence[str], **options) -> DataFrame:
    return interval_join(left, right.select(*dict.fromkeys([*options.get("keys", ("chrom", "strand")), options.get("start", "start"), options.get("end", "end")])), **options).select(*(F.col(f"l_{c}").alias(c) for c in id_cols)).distinct()


def interval_semi(left: DataFrame, right: DataFrame, id_cols: Sequence[str] = ("id",), **options) -> DataFrame:
    """Rows of `left` that overlap some row of `right`. id_cols identify a row of left."""
    return left.join(_matched(left, right, id_cols, **options), list(id_cols), "left_semi").select(*left.columns)


def interval_anti(left: DataFrame, right: DataFrame, id_cols: Sequence[str] = ("id",), **options) -> DataFrame:
    """Rows of `left` that overlap no row of `right`."""
    return left.join(_matched(left, right, id_cols, **options), list(id_cols), "left_anti").select(*left.columns)


def running_max_end(df: DataFrame, keys: Sequence[str] = ("chrom", "strand"), order: Sequence[str] = ("start", "id"), end: str = "end", chunk: int = 1_000_000) -> DataFrame:
    """Adds max_end, the largest end so far in the given order, whose first column is a position.

    Two levels: within chunks of `chunk` bases of that column, and a window over one row a chunk for what comes before.
    """
    rows = df.withColumn("_chunk", F.floor(F.col(order[0]) / chunk))
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    reach = rows.groupBy(*keys, "_chunk").agg(F.max(end).alias("_far")).select(*(F.col(k).alias(f"_{k}") for k in keys), F.col("_chunk").alias("_c"), F.max("_far").over(before).alias("_before"))
    on = F.col("_chunk").eqNullSafe(F.col("_c"))
    for k in keys:
        on &= F.col(k).eqNullSafe(F.col(f"_{k}"))
    inside = Window.partitionBy(*keys, "_chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.join(reach, on).withColumn("max_end", F.greatest(F.max(end).over(inside), "_before")).select(*df.columns, "max_end")


def clusters(df: DataFrame, keys: Sequence[str] = ("chrom", "strand"), order: Sequence[str] = ("start", "id"), start: str = "start", end: str = "end", chunk: int = 1_000_000) -> DataFrame:
    """Adds cluster_start, cluster_end, size and first_id: chains of overlapping features (touching joins, adjacent doesn't).

    Two levels, so that a whole chromosome never is one task: the running maximum is taken within chunks of `chunk`
    bases, and what earlier chunks reach comes from a window over one row a chunk.
    """
    rows = df.withColumn("_chunk", F.floor(F.col(start) / chunk))
    reach = rows.groupBy(*keys, "_chunk").agg(F.max(end).alias("_far"))
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    reach = reach.select(*keys, "_chunk", F.max("_far").over(before).alias("_before"))
    rows = rows.join(reach, [*keys, "_chunk"])
    inside = Window.partitionBy(*keys, "_chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    far = F.greatest(F.max(end).over(inside), F.col("_before"))
    rows = rows.withColumn("_new", F.coalesce(F.col(start) > far, F.lit(True)))
    # the start of the cluster a row is in: the last new start at or before it, again by chunks
    upto = Window.partitionBy(*keys, "_chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_own", F.max(F.when(F.col("_new"), F.col(start))).over(upto))
    last = rows.where("_new").groupBy(*keys, "_chunk").agg(F.max(start).alias("_last"))
    chunks = rows.select(*keys, "_chunk").distinct().join(last, [*keys, "_chunk"], "left")
    chunks = chunks.select(*keys, "_chunk", F.max("_last").over(before).alias("_open"))
    rows = rows.join(chunks, [*keys, "_chunk"]).withColumn("cluster_start", F.coalesce("_own", "_open"))
    facts = rows.groupBy(*keys, "cluster_start").agg(F.max(end).alias("cluster_end"), F.count(F.lit(1)).alias("size"), F.min_by(order[-1], F.struct(*order)).alias("first_id"))
    return rows.drop("_chunk", "_before", "_new", "_own", "_open").join(facts, [*keys, "cluster_start"]).select(*df.columns, "cluster_start", "cluster_end", "size", "first_id")


def merge_overlapping_genes(genes: DataFrame, mrnas: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(genes, mrnas): of each cluster the first gene stays, not widened, and takes the others' mRNAs."""
    found = clusters(genes)
    kept = found.where(F.col("id") == F.col("first_id")).select(*genes.columns)
    renamed = found.select(F.col("id").alias("_old"), F.col("first_id").alias("_new"))
    moved = mrnas.join(renamed, F.col("parent_id") == F.col("_old"), "left")
    return kept, moved.withColumn("parent_id", F.coalesce("_new", "parent_id")).select(*mrnas.columns)


def nonoverlapping_genes(source: DataFrame, target: DataFrame, cds_genes: DataFrame) -> DataFrame:
    """Source genes that overlap no target gene on their strand and have a CDS (cds_genes: column gene_id)."""
    return interval_anti(source, target).join(cds_genes.select(F.col("gene_id").alias("id")).distinct(), "id", "left_semi").select(*source.columns)


def nonoverlapping_models(features: DataFrame, target: DataFrame) -> DataFrame:
    """Of `features` (chrom, strand, start, end, type, id, parents or parent_id), the genes that overlap no gene of `target` on their
    strand and have a CDS at any depth, each with all its descendants. Adds gene_id and row_; what lies below two such genes has two rows."""
    known = hierarchy(features)
    genes = known.rows.where("type = 'gene'")
    new = nonoverlapping_genes(genes, target, known.holding("gene", "CDS").withColumnRenamed("id", "gene_id"))
    below = known.under("gene").join(new.select(F.col("id").alias("ancestor")), "ancestor", "left_semi")
    cols = [*features.columns, "row_"]
    return new.select(*cols, F.col("id").alias("gene_id")).unionByName(below.select(*cols, F.col("ancestor").alias("gene_id")))


def same_span(s1: Column, e1: Column, s2: Column, e2: Column, tolerance: float = 0.05) -> Column:
    """Starts and ends differ by at most `tolerance` of the longer span (spans as end - start, 1 at least)."""
    allowed = F.lit(tolerance) * F.greatest(e1 - s1, e2 - s2, F.lit(1).cast("long"))
    return (F.abs(s1 - s2) <= allowed) & (F.abs(e1 - e2) <= allowed)
