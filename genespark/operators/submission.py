"""Clean-up of annotated features for submission."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genespark.functions.columns import clean_product
from genespark.operators.graph import Hierarchy, hierarchy, with_parents
from genespark.operators.lineage import cut
from genespark.sources.gff import as_text, placed, placed_text

INFERENCES = 3
SEVERITIES = ("FATAL", "ERROR", "WARNING", "INFO")


def drop_set(genes: DataFrame, mrnas: DataFrame, cds: DataFrame) -> DataFrame:
    """(id, kind): mRNAs without CDS, and genes without an mRNA that has one (genes without any mRNA too).

    genes: id; mrnas: id and parents (or parent_id); cds: parents (or parent_id).
    """
    nil = F.lit(None).cast("string")
    rows = genes.select("id", F.lit("gene").alias("type"), F.array().cast("array<string>").alias("parents"))
    rows = rows.unionByName(with_parents(mrnas).select("id", F.lit("mRNA").alias("type"), "parents")).unionByName(with_parents(cds).select(nil.alias("id"), F.lit("CDS").alias("type"), "parents"))
    return without_cds(hierarchy(rows))


def without_cds(known: Hierarchy) -> DataFrame:
    """(id, kind): mRNAs without CDS at any depth, and genes without an mRNA that has one."""
    coding = known.holding("mRNA", "CDS")
    rows = known.rows.where("id is not null")
    mrna = rows.where("type = 'mRNA'")
    bare = mrna.join(coding, "id", "left_anti").select("id", F.lit("mRNA").alias("kind"))
    kept = known.under("gene", mrna.join(coding, "id", "left_semi").select(*rows.columns)).select(F.col("ancestor").alias("id")).distinct()
    return bare.unionByName(rows.where("type = 'gene'").join(kept, "id", "left_anti").select("id", F.lit("gene").alias("kind")))


def clean(features: DataFrame) -> DataFrame:
    """Features with clean product, at most three inferences, KEGG references moved to the note; adds what was changed.

    features: product, inference, dbxref, note (arrays of strings, nullable). Adds n_organism, n_fragment (products),
    n_capped (1 if inferences were cut) and n_kegg (references moved). An empty dbxref becomes null. A second
    pass changes nothing.
    """
    cleaned = F.transform("product", clean_product)
    kegg = F.filter("dbxref", lambda x: x.startswith("KEGG:"))
    rest = F.filter("dbxref", lambda x: ~x.startswith("KEGG:"))
    n_kegg = F.when(F.col("dbxref").isNull(), 0).otherwise(F.size(kegg))
    rows = features.withColumn("_c", cleaned)
    rows = rows.withColumn("n_organism", F.coalesce(F.size(F.filter("_c", lambda x: x["organism"])), F.lit(0))).withColumn("n_fragment", F.coalesce(F.size(F.filter("_c", lambda x: x["fragment"])), F.lit(0)))
    rows = rows.withColumn("n_organism", F.greatest("n_organism", F.lit(0))).withColumn("n_fragment", F.greatest("n_fragment", F.lit(0)))
    rows = rows.withColumn("product", F.transform("_c", lambda x: x["text"])).drop("_c")
    rows = rows.withColumn("n_capped", F.coalesce((F.size("inference") > INFERENCES).cast("int"), F.lit(0))).withColumn("inference", F.slice("inference", 1, INFERENCES))
    rows = rows.withColumn("n_kegg", n_kegg).withColumn("note", F.when(n_kegg > 0, F.concat(F.coalesce("note", F.array().cast("array<string>")), kegg)).otherwise(F.col("note")))
    return rows.withColumn("dbxref", F.when(F.size(rest) > 0, rest))


def report(cleaned: DataFrame, dropped: DataFrame) -> DataFrame:
    """One row of six counters, over the features that stay."""
    counts = cleaned.agg(*(F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(n) for c, n in (("n_organism", "products"), ("n_fragment", "fragments"), ("n_capped", "inferences"), ("n_kegg", "kegg"))))
    gone = dropped.agg(F.count_if(F.col("kind") == "mRNA").alias("mrnas"), F.count_if(F.col("kind") == "gene").alias("genes"))
    return counts.join(F.broadcast(gone))  # one row each


def validation_counts(lines: DataFrame) -> DataFrame:
    """(severity, n) of lines (value) that begin with a severity and a colon; every severity has a row."""
    found = lines.select(F.regexp_extract("value", "^(FATAL|ERROR|WARNING|INFO):", 1).alias("severity")).where("severity <> ''").groupBy("severity").agg(F.count(F.lit(1)).alias("n"))
    session = lines.sparkSession
    every = session.range(1).select(F.explode(F.array(*(F.lit(s) for s in SEVERITIES))).alias("severity"))
    return every.join(found, "severity", "left").select("severity", F.coalesce("n", F.lit(0).cast("long")).alias("n"))


def header_duplicates(records: DataFrame) -> DataFrame:
    """The first record of each header line (header, seq, line_no)."""
    first = records.groupBy("header").agg(F.min_by(F.struct("seq", "line_no"), "line_no").alias("x"))
    return first.select("header", "x.seq", "x.line_no")


def release(features: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(lines, report) of a GFF3 for submission: without what has no CDS, attributes cleaned, in hierarchical order.

    features: as sources.gff.features gives them. lines (value) begin with the version; other attributes keep their place.
    A part of several mRNAs is written, and what was cleaned in it counted, below each that stays.
    """
    names = {"product": "product", "inference": "inference", "dbxref": "Dbxref", "note": "Note"}
    cleaned = clean(features.withColumns({c: F.try_element_at("attributes", F.lit(k)) for c, k in names.items()}))
    value = lambda k, v: F.coalesce(*(F.when(k == key, F.coalesce(F.col(c), F.array().cast("array<string>"))) for c, key in names.items()), v)
    stay = F.map_filter(F.transform_values("attributes", value), lambda k, v: (F.size(v) > 0) | ~k.isin(*names.values()))
    fresh = F.when(F.col("note").isNotNull() & ~F.map_contains_key("attributes", "Note"), F.create_map(F.lit("Note"), F.col("note"))).otherwise(F.create_map().cast("map<string,array<string>>"))
    cleaned = cleaned.withColumn("attributes", F.map_concat(stay, fresh))
    # cleaned row by row and put into lines before anything is moved
    known = hierarchy(as_text(cleaned, "n_organism", "n_fragment", "n_capped", "n_kegg"))
    dropped = cut(without_cds(known))
    # only genes and mRNAs are dropped: the parts, which are the bulk, need not be moved for that
    upper = F.coalesce(F.col("type").isin("gene", "mRNA"), F.lit(False))
    kept = known.rows.where(upper).join(dropped.select(F.col("id").alias("_i"), F.col("kind").alias("_t")), (F.col("id") == F.col("_i")) & (F.col("type") == F.col("_t")), "left_anti").unionByName(known.rows.where(~upper))
    # what hangs on dropped mRNAs only, or on nothing, has no place: it is neither written nor counted. The lines are not stored
    # for the report, which reads the few counters beside them
    rows = placed(Hierarchy(kept, known.above))
    head = features.sparkSession.range(1).select(F.lit("##gff-version 3").alias("value"))
    return head.unionByName(placed_text(rows)), report(rows, dropped)
