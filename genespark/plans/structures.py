"""Named queries over hierarchies, merged sources, tiles, stored features and checks, each with SQL over the tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from genespark.operators import checks, evidence, functional, graph, intervals, selection, status, submission
from genespark.operators.lineage import cut, fresh_path
from genespark.plans import bridge
from genespark.plans.bridge import CONTIGS_SQL, MRNAS_SQL, predicted_sql, second_sql
from genespark.plans.catalog import BASE, OVER, Query, _genes, _pair
from genespark.plans.formats import DESCRIBED, _described, _models, _named_contigs, _read_gff, _text
from genespark.sources import files, gff, sequences, store

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
TAB = "chr(9)"


def query(name: str, sql: str):
    def add(f: Query) -> Query:
        QUERIES[name], ORACLES[name] = f, sql
        return f

    return add


def _shared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Genes, mRNAs, CDS and parts of CDS; every second CDS has two mRNAs as parents, of which one may be missing."""
    return _shared_of(bridge.cds(spark, sf_dir, once=True))


def _shared_of(parts: DataFrame) -> DataFrame:
    none = F.array().cast("array<string>")
    one = lambda df, kind, parents: df.select("chrom", "strand", "start", "end", F.lit(kind).alias("type"), "id", parents.alias("parents"), "g", F.col("rn") if "rn" in df.columns else F.lit(None).cast("int").alias("rn"))
    both = F.array(F.concat("gene_id", F.lit(".m0")), F.concat("gene_id", F.lit(".m1")))
    cds = one(parts, "CDS", F.when(F.col("rn") % 2 == 0, both).otherwise(F.array("parent_id")))
    bits = one(parts.where(F.col("rn") % 3 == 0).withColumn("up", F.col("id")).withColumn("id", F.concat(F.lit("k"), "id")), "part", F.array("up"))
    return one(bridge.genes(parts), "gene", none).unionByName(one(bridge.mrnas(parts), "mRNA", F.array("parent_id"))).unionByName(cds).unionByName(bits)


def _lines(features: DataFrame, more=None) -> DataFrame:
    attributes = F.concat(F.lit("ID="), "id", F.when(F.size("parents") > 0, F.concat(F.lit(";Parent="), F.array_join("parents", ","))).otherwise(""), F.lit("") if more is None else more)
    return features.select(F.concat_ws("\t", "chrom", F.lit("lab"), "type", _text("start"), _text("end"), F.lit("."), "strand", F.lit("."), attributes).alias("value"))


SHARED = f"""{BASE.replace("WITH", "WITH RECURSIVE", 1)}, {MRNAS_SQL},
feature AS (SELECT 'gene' AS type, id, chrom, strand, s, e, CAST([] AS VARCHAR[]) AS ups, g, NULL AS rn FROM genes UNION ALL SELECT 'mRNA', id, chrom, strand, s, e, [parent_id], g, NULL FROM mrnas
  UNION ALL SELECT 'CDS', id, chrom, strand, s, e, CASE WHEN rn % 2 = 0 THEN [gene_id || '.m0', gene_id || '.m1'] ELSE [parent_id] END, g, rn FROM cds UNION ALL SELECT 'part', 'k' || id, chrom, strand, s, e, [id], g, rn FROM cds WHERE rn % 3 = 0),
edge AS (SELECT id, unnest(ups) AS up FROM feature),
below AS (SELECT id, up AS ancestor, CAST(1 AS BIGINT) AS distance FROM edge UNION SELECT b.id, e.up, b.distance + 1 FROM below b JOIN edge e ON e.id = b.ancestor)"""


def _line_sql(more: str = "''") -> str:
    return f"concat_ws({TAB}, f.chrom, 'lab', f.type, f.s, f.e, '.', f.strand, '.', 'ID=' || f.id || CASE WHEN len(f.ups) > 0 THEN ';Parent=' || array_to_string(f.ups, ',') ELSE '' END || {more})"


@query("descendants", f"{SHARED} SELECT f.type, b.id, b.ancestor, min(b.distance) AS distance FROM below b JOIN genes g ON g.id = b.ancestor JOIN feature f ON f.id = b.id GROUP BY ALL")
def descendants(spark, sf_dir):
    return graph.descendants(_shared(spark, sf_dir))


@query("shared_parts_gff3", f"{SHARED} SELECT {_line_sql()} AS value FROM feature f WHERE type IN ('gene', 'mRNA') UNION ALL SELECT {_line_sql()} FROM feature f JOIN edge USING (id) JOIN mrnas m ON m.id = edge.up WHERE type = 'CDS'")
def shared_parts_gff3(spark, sf_dir):
    return gff.hierarchical_text(gff.features(_read_gff(spark, sf_dir, _lines(_shared(spark, sf_dir)))))


@query("released_gff3", f"""{SHARED}, alive AS (SELECT f.*, edge.up FROM feature f JOIN edge USING (id) JOIN mrnas m ON m.id = edge.up WHERE type = 'CDS' AND f.g % 4 > 0),
coding AS (SELECT DISTINCT up FROM alive)
SELECT '##gff-version 3' AS value UNION ALL SELECT {_line_sql("CASE WHEN rn % 2 = 0 THEN ';inference=a,b,c' ELSE '' END")} FROM alive f
UNION ALL SELECT {_line_sql("';product=kinase'")} FROM feature f WHERE type = 'mRNA' AND id IN (SELECT up FROM coding)
UNION ALL SELECT {_line_sql()} FROM feature f WHERE type = 'gene' AND id IN (SELECT parent_id FROM mrnas WHERE id IN (SELECT up FROM coding))""")
def released_gff3(spark, sf_dir):
    rows = _shared(spark, sf_dir).where("g % 4 > 0 or type in ('gene', 'mRNA')")
    more = F.when(F.col("type") == "mRNA", ";product=kinase (Fragment) OS=x OX=1").when((F.col("type") == "CDS") & (F.col("rn") % 2 == 0), ";inference=a,b,c,d").otherwise("")
    return submission.release(gff.features(_read_gff(spark, sf_dir, _lines(rows, more))))[0]


@query("nonoverlapping_models", f"""{SHARED}, {predicted_sql('pred')}, new AS (SELECT id FROM genes a WHERE NOT EXISTS (SELECT 1 FROM pred b WHERE {OVER}))
SELECT 'gene' AS type, id, id AS gene_id FROM new WHERE id IN (SELECT ancestor FROM below JOIN cds USING (id)) UNION ALL SELECT DISTINCT f.type, f.id, b.ancestor FROM feature f JOIN below b USING (id) JOIN new ON new.id = b.ancestor""")
def nonoverlapping_models(spark, sf_dir):
    parts = bridge.cds(spark, sf_dir, once=True)
    pred = bridge.predicted_genes(cut(bridge.genes(parts)))
    return intervals.nonoverlapping_models(_shared_of(parts), pred).select("type", "id", "gene_id")


def _two_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CDS of two sources under the same ids, some at other places, with notes and parents of their own."""
    parts = bridge.cds(spark, sf_dir, once=True)

    def source(df: DataFrame, k: int, notes, ups) -> DataFrame:
        at = F.map_from_arrays(F.array(F.lit("ID"), F.lit("Note"), F.lit("Parent")), F.array(F.array("id"), notes, ups))
        return df.select("chrom", F.lit("lab").alias("source"), F.lit("CDS").alias("type"), "start", "end", F.lit(".").alias("score"), "strand", F.lit(".").alias("frame"), at.alias("attributes"), "id", ups.alias("parents"), F.get(ups, 0).alias("parent_id"), F.lit(k).alias("file"), (F.col("g") * 1000 + F.col("rn")).alias("line_no"))

    rn = F.col("rn")
    first = source(parts, 0, F.array(F.concat(F.lit("a"), _text(rn % 3))), F.array("parent_id"))
    return first.unionByName(source(bridge.second_source(parts, 11, 9), 1, F.array(F.lit("b"), F.concat(F.lit("a"), _text(rn % 2))), F.array("parent_id", F.concat("gene_id", F.lit(".m0")))))


TWO = f"""{BASE}, {second_sql('other', 11, 9)}, every AS (SELECT id, s, e, 0 AS src, ['a' || (rn % 3)] AS notes, [parent_id] AS ups FROM cds UNION ALL SELECT id, s, e, 1, ['b', 'a' || (rn % 2)], [parent_id, gene_id || '.m0'] FROM other)"""


@query("merged_features", f"""{TWO}, same AS (SELECT id, s, e, min(src) AS src, list_sort(list_distinct(flatten(list(notes)))) AS notes, list_sort(list_distinct(flatten(list(ups)))) AS ups FROM every GROUP BY id, s, e),
counted AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY src) - 1 AS k FROM same)
SELECT id || CASE WHEN k > 0 THEN '_' || k ELSE '' END AS id, s AS start, e AS stop, array_to_string(notes, '|') AS note, array_to_string(ups, '|') AS parents FROM counted""")
def merged_features(spark, sf_dir):
    rows = gff.combined(_two_sources(spark, sf_dir), "merge", ("file", "line_no"))
    return rows.select("id", "start", F.col("end").alias("stop"), F.array_join(F.try_element_at("attributes", F.lit("Note")), "|").alias("note"), F.array_join("parents", "|").alias("parents"))


@query("replaced_features", f"{TWO} SELECT id, s AS start, e AS stop, array_to_string(notes, '|') AS note FROM every QUALIFY row_number() OVER (PARTITION BY id ORDER BY src DESC) = 1")
def replaced_features(spark, sf_dir):
    rows = gff.combined(_two_sources(spark, sf_dir), "replace", ("file", "line_no"))
    return rows.select("id", "start", F.col("end").alias("stop"), F.array_join(F.try_element_at("attributes", F.lit("Note")), "|").alias("note"))


@query("patched_models", f"""{BASE}, {MRNAS_SQL}, {predicted_sql('pred')}, new AS (SELECT id FROM genes a WHERE NOT EXISTS (SELECT 1 FROM pred b WHERE {OVER}))
SELECT 'gene' AS type, id, s AS start FROM pred UNION ALL SELECT 'gene', id, s FROM genes WHERE id IN (SELECT id FROM new) UNION ALL SELECT 'mRNA', id, s FROM mrnas WHERE parent_id IN (SELECT id FROM new) UNION ALL SELECT 'CDS', id, s FROM cds WHERE gene_id IN (SELECT id FROM new)""")
def patched_models(spark, sf_dir):
    def shape(df: DataFrame) -> DataFrame:
        at = F.create_map(F.lit("ID"), F.array("id"), F.lit("Parent"), F.col("parents"))
        return df.select("chrom", "strand", "start", "end", "type", "id", "parents", at.alias("attributes"), F.xxhash64("id").alias("line_no"))

    parts = bridge.cds(spark, sf_dir, once=True)
    pred = bridge.predicted_genes(cut(bridge.genes(parts)))
    old = pred.withColumn("type", F.lit("gene")).withColumn("parents", F.array().cast("array<string>"))
    return evidence.patch_models(shape(old), shape(_shared_of(parts).where("type <> 'part'"))).select("type", "id", "start")


@query("fasta_tiles", f"WITH {CONTIGS_SQL}, sized AS (SELECT chrom, coalesce(seq, '') AS seq, length(coalesce(seq, '')) AS n FROM contigs), cut AS (SELECT chrom, seq, n, unnest(range(0, greatest(1, (n + 999) // 1000))) AS tile FROM sized) SELECT chrom || ' contig' AS header, chrom, n, tile, substr(seq, 1000 * tile + 1, 1002) AS piece FROM cut")
def fasta_tiles(spark, sf_dir):
    path = fresh_path(spark)
    sequences.fasta_text(_named_contigs(spark, sf_dir), "name").write.text(path)
    return sequences.read_tiles(spark, path, 1000, 2).select("header", "chrom", "n", "tile", "piece")


def _stretched(genes: DataFrame, by: dict[int, int], shift: int = 0) -> DataFrame:
    times = F.coalesce(*(F.when(F.col("g") % k == 0, v) for k, v in by.items()), F.lit(1)).cast("long")
    return genes.select("chrom", "strand", (F.col("start") + shift).alias("start"), (F.col("start") + shift + (F.col("end") - F.col("start")) * times).alias("end"), "id")


def _stretched_sql(name: str, by: dict[int, int], shift: int = 0) -> str:
    return f"{name} AS (SELECT chrom, strand, s + {shift} AS s, s + {shift} + (e - s) * CASE {' '.join(f'WHEN g % {k} = 0 THEN {v}' for k, v in by.items())} ELSE 1 END AS e, id FROM genes)"


LONG = ({211: 5000, 23: 40}, {307: 20_000, 101: 300})


@query("mixed_length_overlaps", f"{BASE}, {_stretched_sql('x', LONG[0])}, {_stretched_sql('y', LONG[1], 37)} SELECT a.id AS l_id, b.id AS r_id, least(a.e, b.e) - greatest(a.s, b.s) + 1 AS bp FROM x a JOIN y b ON {OVER}")
def mixed_length_overlaps(spark, sf_dir):
    """Features of some hundred bases to 14 megabases."""
    genes = cut(_genes(spark, sf_dir))
    return intervals.interval_join(_stretched(genes, LONG[0]), _stretched(genes, LONG[1], 37), width=500).select("l_id", "r_id", "bp")


@query("stored_overlap_join", f"{BASE}, {predicted_sql('pred')} SELECT a.id AS ref_id, b.id AS pred_id, least(a.e, b.e) - greatest(a.s, b.s) + 1 AS bp FROM genes a JOIN pred b ON {OVER}")
def stored_overlap_join(spark, sf_dir):
    """Genes and mRNAs of two annotations are stored; their genes are joined."""
    genes, pred = _pair(spark, sf_dir)
    run = uuid.uuid4().hex[:12]
    buckets = store.buckets_for(2 * genes.count(), 8)  # of two types; there are about as many predictions
    for name, rows in ((f"ref_{run}", genes), (f"pred_{run}", pred)):
        typed = rows.select("chrom", "strand", "start", "end", "id", F.explode(F.array(F.lit("gene"), F.lit("mRNA"))).alias("type"))
        store.store(typed, name, buckets=buckets, top=2)
    out = store.overlapping(spark, f"ref_{run}", f"pred_{run}", (("gene",), ("gene",)))
    return out.select(F.col("l_id").alias("ref_id"), F.col("r_id").alias("pred_id"), "bp")


@query("input_limits", f"""{BASE}, {CONTIGS_SQL}, found AS (SELECT 'genome' AS name, sum(length(chrom) + 9 + length(coalesce(seq, '')) + greatest(0, (length(coalesce(seq, '')) - 1) // 60) + 1) AS found, 1000000 AS above FROM contigs
UNION ALL SELECT 'proteins', count(*), 1000 FROM contigs UNION ALL SELECT 'reference', count(*), 100 FROM genes)
SELECT name, CAST(found AS DOUBLE) AS found, CAST(above AS DOUBLE) AS above, found > above AS ok FROM found""")
def input_limits(spark, sf_dir):
    """What a test run reads is written, and measured by the job that writes it."""
    fasta = sequences.fasta_text(_named_contigs(spark, sf_dir), "name")
    genes = _lines(_shared(spark, sf_dir).where("type <> 'part'"))
    written = [checks.write_observed(rows, fresh_path(spark), [checks.TEST_DATA[k]()], "text") for k, rows in (("genome", fasta), ("proteins", fasta), ("reference", genes))]
    return written[0].unionByName(written[1]).unionByName(written[2])


@query("read_pairs", "SELECT count(*) FILTER (WHERE p_partkey % 3 = 0) AS forward, count(*) FILTER (WHERE p_partkey % 3 = 1) AS backward, least(count(*) FILTER (WHERE p_partkey % 3 = 0), count(*) FILTER (WHERE p_partkey % 3 = 1)) >= 2 AS ok FROM part")
def read_pairs(spark, sf_dir):
    k = F.col("p_partkey")
    return checks.read_pairs(bridge.table(spark, sf_dir, "part").select(F.concat(F.lit("SRR"), _text(k), F.lit("_"), _text(k % 3 + 1), F.lit(".fastq.gz")).alias("name")), 2)


@query("exact_medians", "SELECT l_returnflag, l_linestatus, median(CAST(l_extendedprice AS DOUBLE)) AS price, median(CAST(l_quantity AS DOUBLE)) AS quantity, median(CAST(l_partkey AS DOUBLE)) FILTER (WHERE l_partkey % 2 = 0) AS even_part FROM lineitem GROUP BY 1, 2")
def exact_medians(spark, sf_dir):
    part = F.col("l_partkey")
    return selection.medians(bridge.table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"], {"price": F.col("l_extendedprice"), "quantity": F.col("l_quantity"), "even_part": F.when(part % 2 == 0, part)})


@query("numbered_lines", f"""{BASE}, l AS (SELECT g * 1000 + rn AS k, concat_ws({TAB}, chrom, id, s) AS value FROM cds) SELECT row_number() OVER (ORDER BY k) - 1 AS line_no, value FROM l""")
def numbered_lines(spark, sf_dir):
    """Lines of one text in their order, without what follows its sequence mark; it is written in parts, as it is sorted."""
    path = fresh_path(spark)
    own = bridge.cds(spark, sf_dir).select((F.col("g") * 1000 + F.col("rn")).alias("k"), F.concat_ws("\t", "chrom", "id", _text("start")).alias("value"))
    after = bridge.table(spark, sf_dir, "nation").select((F.lit(2) ** 50).cast("long").alias("k"), F.explode(F.array(F.lit("##FASTA"), F.col("n_name"))).alias("value"))
    own.unionByName(after).orderBy("k", "value").select("value").write.text(path)
    return gff.lines(spark, path, parts=True).select("line_no", "value")


@query("input_heads", f"{BASE} SELECT chrom, count(*) AS n, count(*) FILTER (WHERE k <= 10 AND (s % 7 = 0 OR e % 11 = 0)) AS lacking FROM (SELECT *, row_number() OVER (PARTITION BY chrom ORDER BY g * 1000 + rn) AS k FROM cds) GROUP BY chrom")
def input_heads(spark, sf_dir):
    """Whether the first features of each file have what is asked of them; a file a chromosome."""
    start, end = F.when(F.col("start") % 7 > 0, F.col("start")), F.when(F.col("end") % 11 > 0, F.col("end"))
    rows = bridge.cds(spark, sf_dir).select(F.col("chrom").alias("file"), (F.col("g") * 1000 + F.col("rn")).alias("line_no"), start.alias("start"), end.alias("end"), F.create_map(F.lit("ID"), F.array("id")).alias("attributes"))
    return gff.head_facts(rows).withColumnRenamed("file", "chrom")


@query("json_manifest", "SELECT s_suppkey AS name, CASE WHEN s_suppkey % 3 = 0 THEN 'failed' ELSE 'completed' END AS status FROM supplier")
def json_manifest(spark, sf_dir):
    """One JSON document over several lines, written and read back."""
    path = fresh_path(spark)
    k = F.col("s_suppkey")
    step = F.struct(k.alias("name"), F.when(k % 3 == 0, "failed").otherwise("completed").alias("status"))
    text = F.regexp_replace(F.to_json(F.struct(F.sort_array(F.collect_list(step)).alias("steps"))), r"\},", "},\n  ")
    bridge.table(spark, sf_dir, "supplier").agg(text.alias("value")).write.text(path)
    return files.read_json(spark, path).select(F.explode("steps").alias("x")).select("x.name", "x.status")


@query("annotated_gff3", f"""{BASE}, {MRNAS_SQL}, {DESCRIBED.removeprefix("WITH ")}, feature AS (SELECT chrom, 'gene' AS type, s, e, strand, id, NULL AS parent_id, NULL AS key FROM genes UNION ALL SELECT chrom, 'mRNA', s, e, strand, id, parent_id, id FROM mrnas UNION ALL SELECT chrom, 'CDS', s, e, strand, id, parent_id, parent_id FROM cds),
told AS (SELECT f.*, coalesce(product, 'hypothetical protein') AS product, concat_ws(',', nullif(replace(inference, '|', ','), ''), replace(pfam, '|', ',')) AS inference FROM feature f LEFT JOIN homology a ON key = 'g' || a.query_id || '.m0' LEFT JOIN domains b ON key = 'g' || b.query_id || '.m0')
SELECT concat_ws({TAB}, chrom, 'lab', type, s, e, '.', strand, '.', 'ID=' || id || coalesce(';Parent=' || parent_id, '') || CASE WHEN key IS NULL THEN '' ELSE ';product=' || product || CASE WHEN inference <> '' THEN ';inference=' || inference ELSE '' END || ';locus_tag=' || id END) AS value FROM told""")
def annotated_gff3(spark, sf_dir):
    hits = _described(spark, sf_dir).withColumn("query_id", F.concat(F.lit("g"), _text("query_id"), F.lit(".m0")))
    own = F.when(F.col("parent_id").isNull(), F.array().cast("array<string>")).otherwise(F.array("parent_id"))
    rows = _models(spark, sf_dir).withColumn("parents", own)
    return functional.annotate_lines(gff.features(_read_gff(spark, sf_dir, _lines(rows))), hits, hits)


@query("output_errors", """SELECT 's' || p_partkey AS step, CASE WHEN p_partkey % 5 = 0 THEN 'missing' WHEN p_size % 4 = 0 THEN 'empty' ELSE 'unparseable' END AS state FROM part WHERE p_partkey % 2 = 0 AND (p_partkey % 5 = 0 OR p_size % 4 = 0 OR p_partkey % 3 > 0)""")
def output_errors(spark, sf_dir):
    k = F.col("p_partkey")
    rows = bridge.table(spark, sf_dir, "part").select(k.alias("k"), "p_size", F.concat(F.lit("/out/"), _text(k), F.lit(".gff3")).alias("path"))
    steps = rows.select(F.concat(F.lit("s"), _text("k")).alias("step"), F.when(F.col("k") % 2 == 0, "completed").otherwise("running").alias("status"), F.col("path").alias("output"))
    there = rows.where("k % 5 > 0").select("path", (F.col("p_size") % 4).cast("long").alias("size"))
    return status.output_errors(steps, there, rows.where("k % 3 = 0").select("path")).select("step", "state")
