"""GFF3 and GTF: text rows to typed features and back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from genespark.functions.columns import attribute_map, attribute_text, first_value, fixed, gtf_map, raw_attribute
from genespark.operators.graph import Hierarchy, hierarchy, with_parents
from genespark.operators.lineage import cut


def lines(spark: SparkSession, paths: str | list[str], parts: bool = False) -> DataFrame:
    """(file, line_no, value) of text files, from 0 on, cut at a '##FASTA' line.

    Files are read in splits. Spark numbers the rows of a split in order, and a window over one row a split adds the lines
    of the splits before it, so no file is ever one row or one task, and no line is moved: the rows of splits are few, and are
    sent to the lines. With `parts`, the files are those of one text that Spark has written in order (part-00000, ...): numbers
    and cut go over all of them.
    """
    rows = spark.read.text(paths).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_at"), F.monotonically_increasing_id().alias("_n"), "value")
    mark = F.when(F.startswith("value", F.lit("##FASTA")), F.col("_n"))
    splits = rows.groupBy("file", "_at").agg(F.min("_n").alias("_first"), F.count(F.lit(1)).alias("_size"), F.min(mark).alias("_mark"))
    text = Window.partitionBy(F.lit(0) if parts else F.col("file"))
    # a part's number may have more digits than another's
    before = text.orderBy(F.length("file"), "file", "_at").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("_before", F.coalesce(F.sum("_size").over(before), F.lit(0).cast("long")) - F.col("_first")).withColumn("_stop", F.min(F.col("_mark") + F.col("_before")).over(text))
    rows = rows.join(F.broadcast(splits.select("file", "_at", "_before", "_stop")), ["file", "_at"]).withColumn("line_no", F.col("_n") + F.col("_before"))
    return rows.where("_stop is null or line_no < _stop").select("file", "line_no", "value")


def features(rows: DataFrame, dialect: str = "gff3") -> DataFrame:
    """Typed features from (line_no, value): comments and rows of under nine columns are passed over.

    chrom, source, type, start, end, score, strand, frame, attributes (map of arrays), id, parents, parent_id (the first), line_no.
    """
    cols = F.split("value", "\t")
    rows = rows.where(~F.col("value").startswith("#")).withColumn("_c", cols).where(F.size("_c") >= 9)
    part = lambda i: F.get(F.col("_c"), i)
    attributes = attribute_map(part(8)) if dialect == "gff3" else gtf_map(part(8))
    out = rows.select(part(0).alias("chrom"), part(1).alias("source"), part(2).alias("type"), F.expr("try_cast(_c[3] as bigint)").alias("start"), F.expr("try_cast(_c[4] as bigint)").alias("end"), part(5).alias("score"), part(6).alias("strand"), part(7).alias("frame"), attributes.alias("attributes"), *(c for c in ("file", "line_no") if c in rows.columns))
    return out.withColumn("id", first_value(F.col("attributes"), "ID")).withColumn("parents", F.try_element_at("attributes", F.lit("Parent"))).withColumn("parent_id", F.get("parents", 0))


def models(rows: DataFrame) -> DataFrame:
    """Only genes, mRNAs and CDS with an id, as comparison reads them: chrom, strand, start, end, type, id, parent_id, line_no.

    Ids and the first parent are taken as they are written, without URL-decoding.
    """
    part = lambda i: F.get(F.col("_c"), i)
    rows = rows.where(~F.col("value").startswith("#")).withColumn("_c", F.split("value", "\t")).where((F.size("_c") >= 9) & part(2).isin("gene", "mRNA", "CDS"))
    out = rows.select(part(0).alias("chrom"), part(6).alias("strand"), F.expr("try_cast(_c[3] as bigint)").alias("start"), F.expr("try_cast(_c[4] as bigint)").alias("end"), part(2).alias("type"), raw_attribute(part(8), "ID").alias("id"), F.substring_index(raw_attribute(part(8), "Parent"), ",", 1).alias("parent_id"), "line_no")
    return out.where("id is not null")


def from_gtf(rows: DataFrame) -> DataFrame:
    """GTF features as a GFF3 hierarchy: transcripts become mRNAs; ids and parents come from gene_id and transcript_id."""
    gene, transcript = first_value(F.col("attributes"), "gene_id"), first_value(F.col("attributes"), "transcript_id")
    kept = rows.where(F.col("type").isin("gene", "mRNA", "transcript", "exon", "CDS"))
    kind = F.col("type")
    upper = kind.isin("mRNA", "transcript")
    return kept.withColumn("id", F.when(kind == "gene", gene).when(upper, transcript)).withColumn("parent_id", F.when(upper, gene).when(kind.isin("exon", "CDS"), transcript)).withColumn("type", F.when(upper, "mRNA").otherwise(kind))


def grouped_exons(rows: DataFrame) -> DataFrame:
    """Rows whose attribute is a bare group name: exons <group>_exon_<n>, numbered in file order."""
    group = F.regexp_extract(F.get(F.split("value", "\t"), 8), r"^([^;\s]+)", 1)
    base = rows.where(~F.col("value").startswith("#") & (F.size(F.split("value", "\t")) >= 9)).withColumn("group", group)
    n = F.row_number().over(Window.partitionBy("group").orderBy("line_no"))
    part = lambda i: F.get(F.split("value", "\t"), i)
    return base.select(part(0).alias("chrom"), F.lit("exon").alias("type"), F.expr("try_cast(split(value, '\\t')[3] as bigint)").alias("start"), F.expr("try_cast(split(value, '\\t')[4] as bigint)").alias("end"), part(6).alias("strand"), F.concat_ws("_", "group", F.lit("exon"), n.cast("string")).alias("id"), F.col("group").alias("parent_id"))


def unique_ids(rows: DataFrame, order: Sequence[str] = ("line_no",)) -> DataFrame:
    """Ids that repeat get _1, _2, ... from their second line on, in file order. Rows without an id stay as they are, out of the window."""
    k = F.row_number().over(Window.partitionBy("id").orderBy(*order)) - 1
    named = rows.where("id is not null").withColumn("id", F.when(k > 0, F.concat_ws("_", "id", k.cast("string"))).otherwise(F.col("id")))
    return named.unionByName(rows.where("id is null"))


#: The columns besides id and attributes that tell whether features of one id are the same.
FIELDS = ("chrom", "source", "type", "start", "end", "score", "strand", "frame")


def merge_same(rows: DataFrame, order: Sequence[str] = ("line_no",), fields: Sequence[str] = FIELDS) -> DataFrame:
    """Features of one id that agree in `fields` become one, with the union of their attributes; those that differ get _1, _2, ... in order.

    Values of an attribute are a set in ascending order; ID, Name and Parent come first, other attributes by name. Other columns
    are those of the first row by `order`. Nulls in `fields` are equal. Rows without an id stay as they are, as do those whose id
    does not repeat. Rows are moved once, by id, and what follows stays there; rows that repeat a feature's attributes are
    gathered once, however many they are.
    """
    fields = [f for f in fields if f in rows.columns]
    # a row without an id has a number instead: it meets no other
    key = ["id", "none_"]
    same = [*key, *fields]
    at = F.struct(*order)
    moved = rows.withColumn("none_", F.when(F.col("id").isNull(), F.monotonically_increasing_id())).repartition(*key)
    rest = F.struct(*(c for c in rows.columns if c not in ("id", *fields)))
    whole = moved.groupBy(*same).agg(F.count(F.lit(1)).alias("n_"), F.min(at).alias("at_"), F.min_by(rest, at).alias("row_"), F.flatten(F.collect_set(F.map_entries("attributes"))).alias("all_"))
    k = F.row_number().over(Window.partitionBy(*key).orderBy("at_", *fields)) - 1
    whole = whole.withColumn("k_", k).withColumn("alone_", F.sum("n_").over(Window.partitionBy(*key)) == 1)
    rank = lambda name: F.coalesce(F.nullif(F.array_position(F.array(F.lit("ID"), F.lit("Name"), F.lit("Parent")), name), F.lit(0).cast("long")), F.lit(4).cast("long"))
    names = F.sort_array(F.transform(F.array_distinct(F.transform("all_", lambda x: x["key"])), lambda name: F.struct(rank(name).alias("r"), name.alias("key"))))
    values = lambda name: F.flatten(F.transform(F.filter("all_", lambda x: x["key"] == name), lambda x: F.coalesce(x["value"], F.array().cast("array<string>"))))
    merged = F.map_from_entries(F.transform(names, lambda x: F.struct(x["key"], F.sort_array(F.array_distinct(F.filter(values(x["key"]), lambda v: v.isNotNull()))))))
    whole = whole.withColumn("attributes_", F.when(~F.col("alone_"), merged))
    parents = F.try_element_at("attributes_", F.lit("Parent"))
    made = {"attributes": F.col("attributes_"), "parents": parents, "parent_id": F.get(parents, 0)}
    named = F.when(F.col("k_") > 0, F.concat_ws("_", "id", F.col("k_").cast("string"))).otherwise(F.col("id"))

    def column(c: str):
        if c == "id":
            return named.alias(c)
        if c in fields:
            return F.col(c)
        own = F.col(f"row_.{c}")
        return F.when(F.col("alone_"), own).otherwise(made[c]).alias(c) if c in made else own.alias(c)

    return whole.select(*(column(c) for c in rows.columns))


def keep_last(rows: DataFrame, order: Sequence[str] = ("line_no",)) -> DataFrame:
    """Of features that share an id the last by `order` stays, as a whole. Rows without an id stay."""
    last = rows.where("id is not null").groupBy("id").agg(F.max_by(F.struct(*rows.columns), F.struct(*order)).alias("x"))
    return last.select("x.*").unionByName(rows.where("id is null"))


def combined(rows: DataFrame, strategy: str = "create_unique", order: Sequence[str] = ("line_no",)) -> DataFrame:
    """Features with ids that repeat made one set: create_unique (unique_ids), merge (merge_same) or replace (keep_last)."""
    if strategy == "create_unique":
        return unique_ids(rows, order)
    if strategy == "merge":
        return merge_same(rows, order)
    if strategy == "replace":
        return keep_last(rows, order)
    raise ValueError(f"no way to combine features called {strategy}")


def count_type(rows: DataFrame, kind: str) -> DataFrame:
    """(n): rows whose third column is `kind`."""
    return rows.agg(F.count_if(~F.col("value").startswith("#") & (F.get(F.split("value", "\t"), 2) == kind)).alias("n"))


def summary(rows: DataFrame) -> DataFrame:
    """(genes, mrnas, with_inference) of features."""
    mrna = F.col("type") == "mRNA"
    return rows.agg(F.count_if(F.col("type") == "gene").alias("genes"), F.count_if(mrna).alias("mrnas"), F.count_if(mrna & F.map_contains_key("attributes", "inference")).alias("with_inference"))


def head_facts(rows: DataFrame, n: int = 10) -> DataFrame:
    """(file, n, lacking): the features of each file, and how many of its first `n` lack start, end or attributes. Without `file` all are one file, called ''."""
    rows = rows.withColumn("file", F.col("file") if "file" in rows.columns else F.lit(""))
    total = rows.groupBy("file").agg(F.count(F.lit(1)).alias("n"))
    first = rows.withColumn("k_", F.row_number().over(Window.partitionBy("file").orderBy("line_no"))).where(F.col("k_") <= n)
    whole = F.col("start").isNotNull() & F.col("end").isNotNull() & (F.size("attributes") > 0)
    return total.join(first.groupBy("file").agg(F.count_if(~F.coalesce(whole, F.lit(False))).alias("lacking")), "file")


def check(rows: DataFrame, n: int = 10) -> None:
    """ValueError unless there are features and the first `n` of each file have start, end and an attribute."""
    facts = head_facts(rows, n).agg(F.count(F.lit(1)).alias("files"), F.sum("lacking").alias("lacking")).first()
    if not facts.files:
        raise ValueError("no features")
    if facts.lacking:
        raise ValueError("a feature lacks start, end or attributes")


def placed(known: Hierarchy) -> DataFrame:
    """The rows that belong into a file, with `at`, their place: genes by contig and start, below each its mRNAs by start, and of each the exons, then the CDS.

    A feature with several parents has a row below each; how many levels lie between a gene, its mRNAs and their parts
    doesn't matter. Anything else is left off. Equal places go by the order of the rows read.
    """
    c, place = F.col, lambda **keys: F.struct(*(v.alias(k) for k, v in keys.items()))
    own = known.rows.columns
    gene = known.rows.where("type = 'gene'")
    at_gene = gene.where("id is not null").select(c("id").alias("ancestor"), c("chrom").alias("g_chrom"), c("start").alias("g_start"))
    mrna = known.under("gene", known.rows.where("type = 'mRNA'")).join(at_gene, "ancestor")
    spot = mrna.where("id is not null").select(c("id").alias("mrna"), c("start").alias("m_start"), c("ancestor").alias("gene"), "g_chrom", "g_start")
    seats = known.above.join(spot, c("ancestor") == c("mrna")).select(c("id").alias("via_"), "mrna", "m_start", "gene", "g_chrom", "g_start")
    deep = c("via_") != c("mrna")
    seats = cut(seats.withColumn("ways_", F.count_if(~deep).over(Window.partitionBy("mrna"))))
    part = known.rows.where(c("type").isin("exon", "CDS")).withColumn("via_", F.explode("parents"))
    several = F.size("parents") > 1
    seen = seats.agg(F.max("ways_").alias("ways"), F.count_if(deep).alias("deep")).first()
    # a part meets an mRNA twice only through what lies between the two, or if an mRNA has several rows: else no line is moved to tell this
    twice = (seen.ways or 0) > 1 or bool(seen.deep) and not part.where(several).select("via_").join(seats.where(deep).select("via_"), "via_", "left_semi").isEmpty()
    part = part.join(seats.drop("ways_"), "via_")
    if twice:
        part = part.where(~several).unionByName(part.where(several).dropDuplicates(["row_", "gene", "mrna"]))
    nil, zero = F.lit(None), F.lit(0)
    return (
        gene.select(*own, place(chrom=c("chrom"), g_start=c("start"), gene=c("id"), m_start=nil.cast("long"), mrna=nil.cast("string"), kind=zero, start=c("start"), row=c("row_")).alias("at"))
        .unionByName(mrna.select(*own, place(chrom=c("g_chrom"), g_start=c("g_start"), gene=c("ancestor"), m_start=c("start"), mrna=c("id"), kind=zero + 1, start=c("start"), row=c("row_")).alias("at")))
        .unionByName(part.select(*own, place(chrom=c("g_chrom"), g_start=c("g_start"), gene=c("gene"), m_start=c("m_start"), mrna=c("mrna"), kind=F.when(c("type") == "exon", 2).otherwise(3), start=c("start"), row=c("row_")).alias("at")))
    )


def as_text(rows: DataFrame, *more: str) -> DataFrame:
    """What placed() needs of features (id, type, chrom, start, parents), with `value`, their GFF3 line, and columns `more`.

    A line is a fraction of its typed columns and maps: this is what joins and sorts move.
    """
    line = F.concat_ws("\t", "chrom", "source", "type", F.col("start").cast("string"), F.col("end").cast("string"), "score", "strand", "frame", attribute_text(F.col("attributes")))
    return with_parents(rows).select("id", "type", "chrom", "start", "parents", line.alias("value"), *more)


def placed_text(rows: DataFrame) -> DataFrame:
    """(value): the lines of placed() rows of as_text() in order. They are moved once, by place into ranges, each sorted for itself."""
    return rows.select("at", "value").orderBy("at").select("value")


def hierarchical_text(rows: DataFrame) -> DataFrame:
    """(value): the lines of features in the order of placed()."""
    return placed_text(placed(hierarchy(as_text(rows))))


def record_text(records: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """(value): tab-separated records; nulls are empty, fractions have six places."""
    kinds = dict(records.dtypes)
    cells = [F.coalesce(fixed(F.col(c)) if kinds[c] == "double" else F.col(c).cast("string"), F.lit("")) for c in columns]
    cells = [F.when(F.col(c).isNull(), F.lit("")).otherwise(x) for c, x in zip(columns, cells, strict=True)]
    return records.select(F.concat_ws("\t", *cells).alias("value"))
