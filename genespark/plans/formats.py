"""Named queries over files and texts around an annotation: written, read back and held against SQL over the tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from genespark.functions.columns import bar, percent
from genespark.operators import compare, concordance, evidence, functional, hierarchy, splice, status, submission
from genespark.operators.lineage import fresh_path
from genespark.plans import bridge
from genespark.plans.bridge import CONTIGS_SQL, MRNAS_SQL
from genespark.plans.catalog import BASE, HITS, JUNCTIONS, MANY, ONE, TALLY, Query, _genes, _hits, _junctions, _ko, _many, _pair
from genespark.sources import gff, sequences, tables

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
TAB = "chr(9)"


def query(name: str, sql: str):
    def add(f: Query) -> Query:
        QUERIES[name], ORACLES[name] = f, sql
        return f

    return add


def _text(value: Column | str) -> Column:
    return (F.col(value) if isinstance(value, str) else value).cast("string")


def _models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Genes, mRNAs and CDS as features."""
    parts = bridge.cds(spark, sf_dir, once=True)
    nil = F.lit(None).cast("string")
    one = lambda df, kind, parent: df.select("chrom", F.lit("lab").alias("source"), F.lit(kind).alias("type"), "start", "end", F.lit(".").alias("score"), "strand", F.lit(".").alias("frame"), "id", parent.alias("parent_id"))
    return one(bridge.genes(parts), "gene", nil).unionByName(one(bridge.mrnas(parts), "mRNA", F.col("parent_id"))).unionByName(one(parts, "CDS", F.col("parent_id")))


FEATURES = f"""{BASE}, {MRNAS_SQL}, feature AS (SELECT chrom, 'gene' AS type, s, e, strand, id, NULL AS parent_id FROM genes
UNION ALL SELECT chrom, 'mRNA', s, e, strand, id, parent_id FROM mrnas UNION ALL SELECT chrom, 'CDS', s, e, strand, id, parent_id FROM cds)"""


def _gff_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of a GFF3 file: ids that are encoded, given twice or have two parents, stray '%', comments and short rows."""
    code = lambda c: F.replace(F.col(c), F.lit(".m"), F.lit("%2Em"))
    identity = F.concat(F.when(F.col("type") == "gene", "ID=first;ID=").otherwise("ID="), code("id"))
    parent = F.concat(F.lit(";Parent="), code("parent_id"), F.when(F.col("type") == "CDS", ",other").otherwise(""))
    attributes = F.concat(identity, F.coalesce(parent, F.lit("")), F.when(F.col("type") == "CDS", ";Note=50% identity,a%2Cb").otherwise(""))
    rows = _models(spark, sf_dir).select(F.concat_ws("\t", "chrom", "source", "type", _text("start"), _text("end"), "score", "strand", "frame", attributes).alias("value"))
    notes = bridge.table(spark, sf_dir, "region").select(F.explode(F.array(F.concat(F.lit("# "), "r_name"), F.lit("short\trow"))).alias("value"))
    return rows.unionByName(notes)


def _read_gff(spark: SparkSession, sf_dir: str, rows: DataFrame | None = None) -> DataFrame:
    path = fresh_path(spark)
    # a part is what one task has written: packed, it is read by one
    (_gff_lines(spark, sf_dir) if rows is None else rows).write.option("compression", "gzip").text(path)
    return gff.lines(spark, path)


@query("gff3_features", f"{FEATURES} SELECT chrom, 'lab' AS source, type, s AS start, e AS stop, strand, id, parent_id, CASE WHEN type = 'CDS' THEN '50% identity|a,b' END AS note FROM feature")
def gff3_features(spark, sf_dir):
    rows = gff.features(_read_gff(spark, sf_dir))
    return rows.select("chrom", "source", "type", "start", F.col("end").alias("stop"), "strand", "id", "parent_id", F.array_join(F.try_element_at("attributes", F.lit("Note")), "|").alias("note"))


@query("comparison_models", f"{FEATURES} SELECT chrom, strand, type, s AS start, e AS stop, replace(id, '.m', '%2Em') AS id, replace(parent_id, '.m', '%2Em') AS parent_id FROM feature")
def comparison_models(spark, sf_dir):
    return gff.models(_read_gff(spark, sf_dir)).select("chrom", "strand", "type", "start", F.col("end").alias("stop"), "id", "parent_id")


@query("type_count", f"{FEATURES} SELECT count(*) AS n FROM feature WHERE type = 'mRNA'")
def type_count(spark, sf_dir):
    return gff.count_type(_read_gff(spark, sf_dir), "mRNA")


@query("gff3_summary", f"{FEATURES} SELECT count(*) FILTER (WHERE type = 'gene') AS genes, count(*) FILTER (WHERE type = 'mRNA') AS mrnas, count(*) FILTER (WHERE type = 'mRNA' AND id LIKE '%.m1') AS with_inference FROM feature")
def gff3_summary(spark, sf_dir):
    more = F.when(F.col("id").endswith(".m1"), ";inference=x").otherwise("")
    rows = _models(spark, sf_dir).select(F.concat_ws("\t", "chrom", "source", "type", _text("start"), _text("end"), "score", "strand", "frame", F.concat(F.lit("ID="), "id", more)).alias("value"))
    return gff.summary(gff.features(_read_gff(spark, sf_dir, rows)))


@query("gtf_hierarchy", f"""{FEATURES} SELECT type, s AS start, e AS stop, CASE WHEN type <> 'CDS' THEN id END AS id, parent_id FROM feature""")
def gtf_hierarchy(spark, sf_dir):
    gene = F.regexp_extract(F.coalesce("parent_id", "id"), r"^([^.]+)", 1)
    transcript = F.when(F.col("type") == "mRNA", F.col("id")).when(F.col("type") == "CDS", F.col("parent_id"))
    kinds = F.when(F.col("type") == "gene", F.array(F.lit("gene"))).when(F.col("type") == "mRNA", F.array(F.lit("transcript"))).otherwise(F.array(F.lit("CDS"), F.lit("stop_codon")))
    attributes = F.concat(F.lit('gene_id "'), gene, F.lit('";'), F.coalesce(F.concat(F.lit(' transcript_id "'), transcript, F.lit('";')), F.lit("")))
    rows = _models(spark, sf_dir).select("*", F.explode(kinds).alias("kind")).select(F.concat_ws("\t", "chrom", "source", "kind", _text("start"), _text("end"), "score", "strand", "frame", attributes).alias("value"))
    return gff.from_gtf(gff.features(_read_gff(spark, sf_dir, rows), "gtf")).select("type", "start", F.col("end").alias("stop"), "id", "parent_id")


@query("grouped_exon_lines", f"{BASE} SELECT chrom, 'exon' AS type, s AS start, e AS stop, strand, parent_id || '_exon_' || row_number() OVER (PARTITION BY parent_id ORDER BY g * 1000 + rn) AS id, parent_id FROM cds")
def grouped_exon_lines(spark, sf_dir):
    line = F.concat_ws("\t", "chrom", F.lit("SNAP"), F.lit("Exon"), _text("start"), _text("end"), F.lit("."), "strand", F.lit("."), "parent_id")
    rows = bridge.cds(spark, sf_dir).select((F.col("g") * 1000 + F.col("rn")).alias("line_no"), line.alias("value"))
    return gff.grouped_exons(rows).select("chrom", "type", "start", F.col("end").alias("stop"), "strand", "id", "parent_id")


@query("ko_list_rows", """SELECT 'K' || (p_partkey % 33) AS k_number, CASE WHEN p_partkey % 5 > 0 THEN p_partkey + 0.5::DOUBLE END AS threshold, CASE WHEN p_partkey % 2 = 0 THEN 'full' ELSE 'domain' END AS score_type, 'enzyme ' || p_partkey AS definition
FROM part WHERE p_partkey % 7 > 0 QUALIFY row_number() OVER (PARTITION BY p_partkey % 33 ORDER BY p_partkey DESC) = 1""")
def ko_list_rows(spark, sf_dir):
    k = F.col("p_partkey")
    cells = [F.concat(F.lit("K"), _text(k % 33)), F.when(k % 5 > 0, F.concat(_text(k), F.lit(".5"))).otherwise("-"), F.when(k % 2 == 0, "full").otherwise("domain")]
    line = F.when(k % 7 > 0, F.concat_ws("\t", *cells, *(F.lit("x") for _ in range(8)), F.concat(F.lit("enzyme "), _text(k)))).otherwise(F.concat_ws("\t", *cells))
    return tables.ko_list(bridge.table(spark, sf_dir, "part").select(k.alias("line_no"), line.alias("value")))


@query("junction_table", f"WITH {JUNCTIONS} SELECT chrom, CAST(a AS BIGINT) AS intron_start, CAST(b AS BIGINT) AS intron_end, CAST(strand AS INTEGER) AS strand, CAST(motif AS INTEGER) AS motif, CAST(uniq AS BIGINT) AS unique_reads, CAST(multi AS BIGINT) AS multi FROM junctions")
def junction_table(spark, sf_dir):
    path = fresh_path(spark)
    _junctions(spark, sf_dir).select("chrom", "intron_start", "intron_end", "strand", "motif", F.lit(0), "unique", "multi", F.lit(30)).write.csv(path, sep="\t")
    return tables.read_junctions(spark, path).select("chrom", "intron_start", "intron_end", "strand", "motif", F.col("unique").alias("unique_reads"), "multi")


@query("mapping_log", """WITH m AS (SELECT max(p_size + 0.25::DOUBLE) FILTER (WHERE p_partkey % 2 = 0) AS u, max(p_size % 7 + 0.5::DOUBLE) FILTER (WHERE p_partkey % 2 = 1) AS v FROM part)
SELECT coalesce(u, 0) AS "unique", coalesce(v, 0) AS multiple, coalesce(u, 0) + coalesce(v, 0) AS total, coalesce(u, 0) + coalesce(v, 0) < 75 AS low FROM m""")
def mapping_log(spark, sf_dir):
    size = F.col("p_size")
    line = F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit("  Uniquely mapped reads % |\t"), _text(size), F.lit(".25%"))).otherwise(F.concat(F.lit("  % of reads mapped to multiple loci |\t"), _text(size % 7), F.lit(".5%")))
    return tables.mapping_rate(bridge.table(spark, sf_dir, "part").select(line.alias("value")))


@query("listed_names", "SELECT trim(p_name) AS name FROM part WHERE p_partkey % 3 = 1 AND trim(p_name) <> '' AND NOT starts_with(trim(p_name), '#')")
def listed_names(spark, sf_dir):
    k = F.col("p_partkey") % 3
    line = F.when(k == 0, F.concat(F.lit("# "), "p_name")).when(k == 1, F.concat(F.lit("  "), "p_name", F.lit(" "))).otherwise("   ")
    return tables.names(bridge.table(spark, sf_dir, "part").select(line.alias("value")))


@query("validation_counts", """SELECT severity, count(o_orderkey) AS n FROM (VALUES ('FATAL'), ('ERROR'), ('WARNING'), ('INFO')) t(severity)
LEFT JOIN orders ON severity = CASE o_custkey % 4 WHEN 0 THEN 'ERROR' WHEN 1 THEN 'WARNING' WHEN 3 THEN 'INFO' END GROUP BY severity""")
def validation_counts(spark, sf_dir):
    c = F.col("o_custkey") % 4
    line = F.when(c == 0, "ERROR: a").when(c == 1, "WARNING: b").when(c == 2, "see ERROR: c").otherwise("INFO:")
    return submission.validation_counts(bridge.table(spark, sf_dir, "orders").select(line.alias("value")))


def _named_contigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bridge.contigs(spark, sf_dir).select(F.concat("chrom", F.lit(" contig")).alias("name"), "seq")


@query("fasta_lines", f"WITH {CONTIGS_SQL} SELECT '>' || chrom || ' contig' || chr(10) || rtrim(regexp_replace(coalesce(seq, ''), '(.{{60}})', '\\1' || chr(10), 'g'), chr(10)) AS value FROM contigs")
def fasta_lines(spark, sf_dir):
    return sequences.fasta_text(_named_contigs(spark, sf_dir), "name")


@query("fasta_records", f"WITH {CONTIGS_SQL} SELECT chrom || ' contig' AS header, chrom, coalesce(seq, '') AS seq FROM contigs")
def fasta_records(spark, sf_dir):
    path = fresh_path(spark)
    sequences.fasta_text(_named_contigs(spark, sf_dir), "name").write.text(path)
    return sequences.read_fasta(spark, path)


@query("hierarchical_gff3", f"""{FEATURES} SELECT concat_ws({TAB}, chrom, 'lab', type, s, e, '.', strand, '.', 'ID=' || id || coalesce(';Parent=' || parent_id, '')) AS value FROM feature""")
def hierarchical_gff3(spark, sf_dir):
    own = F.create_map(F.lit("ID"), F.array("id"))
    attributes = F.when(F.col("parent_id").isNull(), own).otherwise(F.map_concat(own, F.create_map(F.lit("Parent"), F.array("parent_id"))))
    return gff.hierarchical_text(_models(spark, sf_dir).withColumn("attributes", attributes))


def _cells(*cells: str) -> str:
    return f" || {TAB} || ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in cells)


@query("details_tsv", f"""{ONE}, hits AS (SELECT c.*, g.chrom, c.classification IN ('exact', 'inexact') AS hit FROM classes c JOIN genes g ON g.id = c.ref_id)
SELECT {_cells("prediction", "'gene'", "classification", "ref_id", "CASE WHEN hit THEN pid END", "chrom", "strand", "rs", "re", "CASE WHEN hit THEN ps END", "CASE WHEN hit THEN pe END", "CASE WHEN hit THEN bp END", "CASE WHEN hit THEN printf('%.6f', sn) END", "CASE WHEN hit THEN printf('%.6f', sp) END", "CASE WHEN hit THEN printf('%.6f', 2 * sn * sp / (sn + sp)) END", "CASE WHEN hit THEN CASE WHEN strand = '+' THEN ps - rs ELSE re - pe END END", "CASE WHEN hit THEN CASE WHEN strand = '+' THEN pe - re ELSE rs - ps END END")} AS value FROM hits
UNION ALL SELECT {_cells("prediction", "'gene'", "'novel'", "NULL", "id", "chrom", "strand", "NULL", "NULL", "s", "e", *["NULL"] * 6)} FROM pred WHERE id IN (SELECT pred_id FROM novel)""")
def details_tsv(spark, sf_dir):
    return gff.record_text(compare.classify_genes(*_pair(spark, sf_dir)), ("prediction", *compare.RECORD))


@query("matched_gene_means", f"""{MANY}, m AS (SELECT *, 2 * sn * sp / (sn + sp) AS f, CASE WHEN strand = '+' THEN ps - rs ELSE re - pe END AS b5, CASE WHEN strand = '+' THEN pe - re ELSE rs - ps END AS b3 FROM classes WHERE classification IN ('exact', 'inexact'))
SELECT prediction, round(avg(sn), 6) AS mean_sn, round(avg(sp), 6) AS mean_sp, round(avg(f), 6) AS mean_gene_f1, round(median(f), 6) AS median_f1, count(*) FILTER (WHERE f >= 0.99) AS perfect, round(avg(abs(b5)) FILTER (WHERE classification = 'inexact'), 6) AS mean_5p, median(abs(b5)) FILTER (WHERE classification = 'inexact') AS median_5p,
 round(avg(abs(b3)) FILTER (WHERE classification = 'inexact'), 6) AS mean_3p, median(abs(b3)) FILTER (WHERE classification = 'inexact') AS median_3p FROM m GROUP BY prediction""")
def matched_gene_means(spark, sf_dir):
    out = compare.gene_stats(compare.classify_genes(*_many(spark, sf_dir)))
    return out.select("prediction", *(F.round(c, 6).alias(c) for c in ("mean_sn", "mean_sp", "mean_gene_f1", "median_f1")), "perfect", F.round("mean_5p", 6).alias("mean_5p"), "median_5p", F.round("mean_3p", 6).alias("mean_3p"), "median_3p")


def _described(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("event_id") % 5
    evalue = F.when(n == 0, 1e-30).when(n == 1, 0.5).when(n == 2, 0.005).when(n == 3, 0.01).otherwise(0.001)
    accession = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("PF"), _text(F.col("event_id") % 90), F.lit(".3"))).when(F.col("event_id") % 3 == 1, "")
    return _hits(spark, sf_dir).withColumns({"evalue": evalue, "description": F.concat("hit_id", F.lit(" protein")), "accession": accession})


DESCRIBED = HITS + """, d AS (SELECT *, hit_id || ' protein' AS description, CASE event_id % 5 WHEN 0 THEN 1e-30 WHEN 1 THEN 0.5::DOUBLE WHEN 2 THEN 0.005::DOUBLE WHEN 3 THEN 0.01::DOUBLE ELSE 0.001::DOUBLE END AS evalue, CASE WHEN event_id % 3 = 0 THEN 'PF' || (event_id % 90) ELSE hit_id END AS pf FROM hits),
homology AS (SELECT query_id, CASE WHEN min_by(evalue, hit_rank) <= 0.01::DOUBLE THEN min_by(description, hit_rank) ELSE 'hypothetical protein' END AS product, coalesce(string_agg('similar to AA sequence:UniProtKB:' || hit_id, '|' ORDER BY hit_rank) FILTER (WHERE evalue <= 0.01::DOUBLE), '') AS inference FROM d GROUP BY query_id),
domains AS (SELECT query_id, string_agg('protein motif:PFAM:' || pf, '|' ORDER BY hit_rank) AS pfam FROM d WHERE evalue <= 0.01::DOUBLE GROUP BY query_id),
texts AS (SELECT query_id, string_agg(hit_id || ': ' || description || ' (' || printf('%.2e', evalue) || ')' || CASE WHEN evalue >= 0.001::DOUBLE THEN ' [marginal hit]' ELSE '' END, ' ;; ' ORDER BY hit_rank) AS text FROM d GROUP BY query_id)"""


@query("homology_products", f"{DESCRIBED} SELECT * FROM homology")
def homology_products(spark, sf_dir):
    return functional.homology_annotation(_described(spark, sf_dir)).withColumn("inference", F.array_join("inference", "|"))


@query("pfam_inferences", f"{DESCRIBED} SELECT * FROM domains")
def pfam_inferences(spark, sf_dir):
    return functional.pfam_annotation(_described(spark, sf_dir)).withColumn("pfam", F.array_join("pfam", "|"))


@query("hit_texts", f"{DESCRIBED} SELECT * FROM texts")
def hit_texts(spark, sf_dir):
    return functional.hit_text(_described(spark, sf_dir))


@query("fasta_headers", f"{DESCRIBED} SELECT c_custkey AS id, concat_ws(' ;; ', a.text, 'length=' || length(c_name), b.pfam) AS header, c_name AS seq FROM customer LEFT JOIN texts a ON a.query_id = c_custkey LEFT JOIN domains b ON b.query_id = c_custkey")
def fasta_headers(spark, sf_dir):
    hits = _described(spark, sf_dir)
    pfam = functional.pfam_annotation(hits).select("query_id", F.array_join("pfam", "|").alias("text"))
    return functional.fasta_headers(bridge.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("seq")), functional.hit_text(hits), pfam)


@query("annotated_features", f"""{FEATURES}, {DESCRIBED.removeprefix("WITH ")}, keyed AS (SELECT *, CASE type WHEN 'mRNA' THEN id WHEN 'CDS' THEN parent_id END AS key FROM feature)
SELECT type, id, CASE WHEN key IS NOT NULL THEN coalesce(product, 'hypothetical protein') END AS product, CASE WHEN inference IS NOT NULL OR pfam IS NOT NULL THEN concat_ws('|', nullif(inference, ''), pfam) END AS inference, CASE WHEN key IS NOT NULL THEN id END AS locus_tag
FROM keyed LEFT JOIN homology a ON key = 'g' || a.query_id || '.m0' LEFT JOIN domains b ON key = 'g' || b.query_id || '.m0'""")
def annotated_features(spark, sf_dir):
    hits = _described(spark, sf_dir).withColumn("query_id", F.concat(F.lit("g"), _text("query_id"), F.lit(".m0")))
    rows = functional.annotate_features(_models(spark, sf_dir), functional.homology_annotation(hits), functional.pfam_annotation(hits))
    return rows.select("type", "id", "product", F.array_join("inference", "|").alias("inference"), "locus_tag")


KO = HITS + """, ko AS (SELECT DISTINCT event_type AS k, CASE WHEN length(event_type) % 3 > 0 THEN length(event_type) * 10.0 END AS threshold, CASE WHEN length(event_type) % 2 = 0 THEN 'full' ELSE 'domain' END AS score_type FROM events WHERE event_type IS NOT NULL AND event_type <> 'refund'),
s AS (SELECT query_id, hit_id, hit_rank, threshold, CASE WHEN score_type = 'full' THEN score ELSE score / 2 END AS score FROM hits JOIN ko ON hit_id = k),
b AS (SELECT *, row_number() OVER (PARTITION BY query_id, hit_id ORDER BY score DESC, hit_rank) AS n, coalesce(threshold IS NOT NULL AND score >= threshold, FALSE) AS good FROM s),
best AS (SELECT *, '1.1.1.' || length(hit_id) AS ec FROM b WHERE n = 1)"""


def _ko_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = _hits(spark, sf_dir).select("query_id", "hit_id", "hit_rank", F.col("score").alias("full_score"), F.lit(1e-5).alias("full_evalue"), (F.col("score") / 2).alias("dom_score"), F.lit(1e-5).alias("dom_evalue"))
    return functional.ko_hits(hits, _ko(spark, sf_dir))


@query("ko_products", KO + """, first AS (SELECT *, row_number() OVER (PARTITION BY query_id, ec ORDER BY score DESC, hit_rank) AS m FROM best WHERE good),
ecs AS (SELECT query_id, string_agg(ec, '|' ORDER BY score DESC, hit_rank) AS ec_number FROM first WHERE m = 1 GROUP BY query_id),
rest AS (SELECT query_id, coalesce(first(hit_id || ' enzyme' ORDER BY score DESC, hit_rank) FILTER (WHERE good), 'hypothetical protein') AS product, string_agg('KEGG:' || hit_id, '|' ORDER BY score DESC, hit_rank) FILTER (WHERE good) AS dbxref, string_agg('protein motif:KOFAM:' || hit_id, '|' ORDER BY score DESC, hit_rank) FILTER (WHERE good) AS inference FROM best GROUP BY query_id)
SELECT rest.query_id, product, ec_number, dbxref, inference FROM rest LEFT JOIN ecs USING (query_id)""")
def ko_products(spark, sf_dir):
    rows = functional.ko_annotation(_ko_hits(spark, sf_dir))
    return rows.select("query_id", "product", *(F.array_join(c, "|").alias(c) for c in ("ec_number", "dbxref", "inference")))


@query("ko_texts", KO + " SELECT query_id, string_agg(hit_id || ': ' || hit_id || ' enzyme (1.00e-05)' || CASE WHEN good THEN '' ELSE ' [marginal KO hit]' END, ' ;; ' ORDER BY hit_rank) AS text FROM best GROUP BY query_id")
def ko_texts(spark, sf_dir):
    return functional.ko_text(_ko_hits(spark, sf_dir))


def _part(spark: SparkSession, sf_dir: str, value: Column) -> DataFrame:
    return bridge.table(spark, sf_dir, "part").select(value.alias("value"))


@query("accession_list", "SELECT 'ACC' || p_partkey AS accession FROM part WHERE p_partkey % 2 = 0")
def accession_list(spark, sf_dir):
    k = F.col("p_partkey")
    return status.accessions(_part(spark, sf_dir, F.when(k % 2 == 0, F.concat(F.lit("> ACC"), _text(k), F.lit(" x"), "p_name")).otherwise("ACGT>")))


COUNTED = "SELECT count(*) FILTER (WHERE p_partkey % {m} = 0) AS n, count(*) FILTER (WHERE p_partkey % {m} = 0) < {least} AS few FROM part"


@query("transcript_count", COUNTED.format(m=2, least=1000))
def transcript_count(spark, sf_dir):
    return status.transcripts_counted(_part(spark, sf_dir, F.when(F.col("p_partkey") % 2 == 0, ">t").otherwise("A>")))


@query("training_count", COUNTED.format(m=3, least=501))
def training_count(spark, sf_dir):
    return status.training_counted(_part(spark, sf_dir, F.when(F.col("p_partkey") % 3 == 0, "LOCUS a").otherwise(" LOCUS")))


@query("intron_line_count", COUNTED.format(m=4, least=5000))
def intron_line_count(spark, sf_dir):
    return status.introns_counted(_part(spark, sf_dir, F.when(F.col("p_partkey") % 4 == 0, "1 2").otherwise("# x")))


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("n_nationkey")
    line = F.when(k == 3, "tag:  12 (0.25)").when(k == 7, "taa:   3 (0.5)").when(k == 11, "tga: 1  (0.125)").otherwise(F.concat(F.lit("tat: "), _text(k)))
    return bridge.table(spark, sf_dir, "nation").select(k.cast("long").alias("line_no"), line.alias("value"))


@query("stop_shares", "SELECT CAST(row_number() OVER (ORDER BY n_nationkey) AS INTEGER) AS k, CASE n_nationkey WHEN 3 THEN '0.25' WHEN 7 THEN '0.5' ELSE '0.125' END AS share FROM nation WHERE n_nationkey IN (3, 7, 11)")
def stop_shares(spark, sf_dir):
    return status.stop_shares(_log(spark, sf_dir))


@query("patched_parameters", "SELECT CAST(n_nationkey AS BIGINT) AS line_no, CASE n_nationkey WHEN 1 THEN '/c/amberprob 0.25 # a' WHEN 2 THEN '/c/ochreprob 0.5 # b' WHEN 9 THEN '/c/opalprob 0.125' ELSE 'x  ' || n_name END AS value FROM nation")
def patched_parameters(spark, sf_dir):
    k = F.col("n_nationkey")
    line = F.when(k == 1, "/c/amberprob   0.33 # a").when(k == 2, "/c/ochreprob 0.33   # b").when(k == 9, "/c/opalprob\t0.34").otherwise(F.concat(F.lit("x  "), "n_name", F.lit("  ")))
    return status.with_stop_shares(bridge.table(spark, sf_dir, "nation").select(k.cast("long").alias("line_no"), line.alias("value")), status.stop_shares(_log(spark, sf_dir)))


@query("intron_distribution", "SELECT printf('%f', max(n_nationkey) + 0.5::DOUBLE) || ' 3.250000 4.000000' AS value FROM nation")
def intron_distribution(spark, sf_dir):
    k = F.col("n_nationkey")
    return status.intron_distribution(bridge.table(spark, sf_dir, "nation").select(k.alias("line_no"), F.concat(F.lit("introns  fit of "), _text(k), F.lit(".5  7 3.25 4 x y z")).alias("value")))


@query("contig_names", f"{FEATURES} SELECT chrom, id FROM feature")
def contig_names(spark, sf_dir):
    return hierarchy.strip_contig_names(_models(spark, sf_dir).withColumn("chrom", F.concat("chrom", F.lit(" length=9 x")))).select("chrom", "id")


@query("cds_hints", f"{BASE} SELECT 'CDSpart' AS type, id, 'pri=1;src=P;group=' || parent_id AS attributes FROM cds")
def cds_hints(spark, sf_dir):
    return hierarchy.cds_hints(_models(spark, sf_dir)).select("type", "id", "attributes")


@query("protein_alignments", f"{FEATURES} SELECT type, CASE WHEN type = 'CDS' THEN parent_id || ':' || id ELSE id END AS id, 'prot_align' AS source FROM feature")
def protein_alignments(spark, sf_dir):
    low = F.when(F.col("type") == "CDS", "cds").otherwise(F.col("type"))
    return evidence.protein_alignments(_models(spark, sf_dir).withColumn("type", low)).select("type", "id", "source")


@query("threaded_models", f"{FEATURES} SELECT CASE WHEN type = 'CDS' THEN 'exon' ELSE type END AS type, id, parent_id || '_mRNA' AS parent_id, 'prot_align' AS source FROM feature WHERE type <> 'mRNA'")
def threaded_models(spark, sf_dir):
    exon = F.when(F.col("type") == "CDS", "exon").otherwise(F.col("type"))
    return evidence.threaded_models(_models(spark, sf_dir).withColumn("type", exon)).select("type", "id", "parent_id", "source")


@query("kept_types", f"{FEATURES} SELECT type, id, 'new' AS source FROM feature WHERE type IN ('gene', 'CDS')")
def kept_types(spark, sf_dir):
    return hierarchy.keep_types(_models(spark, sf_dir), ("gene", "CDS"), "new").select("type", "id", "source")


@query("coding_models", f"{BASE}, k AS (SELECT *, row_number() OVER (PARTITION BY gene_id ORDER BY g * 1000 + rn) - 1 AS k FROM cds) SELECT gene_id || CASE WHEN k > 0 THEN '_' || k ELSE '' END AS id, gene_id || '_mRNA' AS parent_id, 'finder' AS source FROM k")
def coding_models(spark, sf_dir):
    rows = bridge.cds(spark, sf_dir).select((F.col("g") * 1000 + F.col("rn")).alias("line_no"), F.lit("CDS").alias("type"), F.lit("lab").alias("source"), F.col("gene_id").alias("id"), F.col("gene_id").alias("parent_id"))
    return gff.unique_ids(evidence.coding_models(rows, "finder")).select("id", "parent_id", "source")


@query("normalized_models", f"""{BASE} SELECT chrom, 'gene' AS type, id, NULL AS parent_id FROM genes UNION ALL SELECT chrom, 'mRNA', id || '_mRNA', id FROM genes
UNION ALL SELECT chrom, 'CDS', id, gene_id || '_mRNA' FROM cds UNION ALL SELECT chrom, 'exon', id || ':exon', gene_id || '_mRNA' FROM cds""")
def normalized_models(spark, sf_dir):
    parts = bridge.cds(spark, sf_dir)
    shape = lambda df, kind, parent: df.select(F.concat("chrom", F.lit(" x")).alias("chrom"), F.lit("lab").alias("source"), F.lit(kind).alias("type"), "start", "end", "strand", F.lit(".").alias("frame"), "id", parent.alias("parent_id"))
    rows = shape(bridge.genes(parts), "gene", F.lit(None).cast("string")).unionByName(shape(parts, "CDS", F.col("gene_id")))
    return evidence.normalize(rows, parse=lambda df: evidence.coding_models(df, "finder"), fix_contigs=True).select("chrom", "type", "id", "parent_id")


@query("repeat_hints", f"{BASE} SELECT 'nonexonpart' AS type, id, 'src=RM' AS attributes FROM genes")
def repeat_hints(spark, sf_dir):
    return splice.repeat_hints(_genes(spark, sf_dir)).select("type", "id", "attributes")


@query("transcript_hints", f"{BASE} SELECT 'exon' AS type, id, 'pri=3;src=E;group=' || parent_id AS attributes FROM cds")
def transcript_hints(spark, sf_dir):
    return splice.transcript_hints(bridge.cds(spark, sf_dir)).select("type", "id", "attributes")


@query("hint_gate", "SELECT count(*) FILTER (WHERE o_custkey % 3 > 0) AS n, count(*) FILTER (WHERE o_custkey % 3 > 0) >= 150 AS use_hints FROM orders")
def hint_gate(spark, sf_dir):
    return splice.enough_introns(bridge.table(spark, sf_dir, "orders").select(F.when(F.col("o_custkey") % 3 > 0, "intron").otherwise("exonpart").alias("type")))


@query("source_counts", f"{BASE}, n AS (SELECT 's' || CASE WHEN g % 50 = 0 THEN 2 ELSE g % 2 END AS source, count(*) AS n FROM genes GROUP BY 1) SELECT source, n, (SELECT count(*) FROM n) = 3 AND n < 250 AS weak FROM n")
def source_counts(spark, sf_dir):
    g = F.col("g")
    return concordance.source_counts(_genes(spark, sf_dir).withColumn("source", F.concat(F.lit("s"), _text(F.when(g % 50 == 0, 2).otherwise(g % 2)))))


@query("prettified_ids", f"""{BASE}, {MRNAS_SQL}, t AS (SELECT id, 'TEST_' || lpad(CAST(row_number() OVER (ORDER BY chrom, s, id) AS VARCHAR), 5, '0') AS tag FROM genes),
m AS (SELECT m.id, tag, tag || '.mRNA.' || row_number() OVER (PARTITION BY tag ORDER BY s, m.id) AS new_id FROM mrnas m JOIN t ON t.id = m.parent_id)
SELECT 'gene' AS type, tag AS id, NULL AS parent_id, tag AS locus_tag, id AS old_id FROM t UNION ALL SELECT 'mRNA', new_id, tag, tag, id FROM m
UNION ALL SELECT 'CDS', new_id || ':CDS:' || row_number() OVER (PARTITION BY new_id ORDER BY s, c.id), new_id, tag, c.id FROM cds c JOIN m ON m.id = c.parent_id""")
def prettified_ids(spark, sf_dir):
    parts = bridge.cds(spark, sf_dir)
    return hierarchy.prettify(bridge.genes(parts), bridge.mrnas(parts), parts.withColumn("type", F.lit("CDS")), "TEST")


@query("splice_summary", f"""{TALLY} SELECT '{{' || chr(10) || string_agg('  "' || type || '": {{' || chr(10) || '    "count": ' || count || ',' || chr(10) || '    "unique_reads": ' || unique_reads || chr(10) || '  }}', ',' || chr(10) ORDER BY count DESC, type) || chr(10) || '}}' AS value FROM tally""")
def splice_summary(spark, sf_dir):
    return splice.summary_text(splice.tally(_junctions(spark, sf_dir), bridge.contigs(spark, sf_dir)))


@query("percent_bars", "SELECT p_partkey, printf('%.1f', p_size / 50.0::DOUBLE * 100) || '%' AS percent, '[' || repeat('#', CAST(trunc(p_size / 50.0::DOUBLE * 20) AS INTEGER)) || repeat('.', 20 - CAST(trunc(p_size / 50.0::DOUBLE * 20) AS INTEGER)) || ']' AS bar FROM part")
def percent_bars(spark, sf_dir):
    share = F.col("p_size") / F.lit(50.0)
    return bridge.table(spark, sf_dir, "part").select("p_partkey", percent(share).alias("percent"), bar(share).alias("bar"))
