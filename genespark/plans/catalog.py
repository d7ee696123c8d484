"""Named queries over the driver's tables, each with equivalent SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from genespark.functions.columns import clean_product, ec_numbers, without_ec
from genespark.operators import compare, concordance, evidence, functional, hierarchy, intervals, orf, splice, status, submission
from genespark.operators.lineage import cut
from genespark.plans import bridge
from genespark.plans.bridge import CONTIGS_SQL, GENES_SQL, MRNAS_SQL, cds_sql, predicted_sql, second_sql
from genespark.sources import sequences

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
BASE = f"WITH {cds_sql()}, {GENES_SQL}"
OVER = "a.chrom = b.chrom AND a.strand = b.strand AND a.s <= b.e AND b.s <= a.e"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add


def _genes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bridge.genes(bridge.cds(spark, sf_dir))


def _pred(spark: SparkSession, sf_dir: str, label: str = "p1", drop: int = 11) -> DataFrame:
    return bridge.predicted_genes(_genes(spark, sf_dir), label, drop)


def _pair(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(genes, predictions); the genes, which both are read from several times, are computed once."""
    genes = cut(_genes(spark, sf_dir))
    return genes, bridge.predicted_genes(genes)


@query("interval_overlap_join", f"{BASE}, {predicted_sql('pred')} SELECT a.id AS ref_id, b.id AS pred_id, least(a.e, b.e) - greatest(a.s, b.s) + 1 AS bp FROM genes a JOIN pred b ON {OVER}")
def interval_overlap_join(spark, sf_dir):
    out = intervals.interval_join(*_pair(spark, sf_dir))
    return out.select(F.col("l_id").alias("ref_id"), F.col("r_id").alias("pred_id"), "bp")


@query("interval_semi", f"{BASE}, {predicted_sql('pred')} SELECT id, s AS start FROM genes a WHERE EXISTS (SELECT 1 FROM pred b WHERE {OVER})")
def interval_semi(spark, sf_dir):
    return intervals.interval_semi(_genes(spark, sf_dir), _pred(spark, sf_dir)).select("id", "start")


@query("interval_anti", f"{BASE}, {predicted_sql('pred')} SELECT id, s AS start FROM genes a WHERE NOT EXISTS (SELECT 1 FROM pred b WHERE {OVER})")
def interval_anti(spark, sf_dir):
    return intervals.interval_anti(_genes(spark, sf_dir), _pred(spark, sf_dir)).select("id", "start")


DENSE = f"WITH {cds_sql(150)}, {GENES_SQL}"
CLUSTERED = """,
far AS (SELECT *, max(e) OVER (PARTITION BY chrom, strand ORDER BY s, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS far FROM genes),
flag AS (SELECT *, CASE WHEN far IS NULL OR s > far THEN 1 ELSE 0 END AS new FROM far),
numbered_clusters AS (SELECT *, sum(new) OVER (PARTITION BY chrom, strand ORDER BY s, id ROWS UNBOUNDED PRECEDING) AS k FROM flag),
clusters AS (SELECT *, min(s) OVER c AS cluster_start, max(e) OVER c AS cluster_end, count(*) OVER c AS size, first_value(id) OVER (PARTITION BY chrom, strand, k ORDER BY s, id) AS first_id FROM numbered_clusters WINDOW c AS (PARTITION BY chrom, strand, k))"""


@query("overlap_clusters", f"{DENSE}{CLUSTERED} SELECT id, cluster_start, cluster_end, size FROM clusters WHERE size > 1")
def overlap_clusters(spark, sf_dir):
    out = intervals.clusters(bridge.genes(bridge.cds(spark, sf_dir, 150)), chunk=10_000)
    return out.where("size > 1").select("id", "cluster_start", "cluster_end", "size")


@query("merge_clusters_reparent", f"{DENSE}, {MRNAS_SQL}{CLUSTERED} SELECT m.id, c.first_id AS parent_id FROM mrnas m JOIN clusters c ON m.parent_id = c.id")
def merge_clusters_reparent(spark, sf_dir):
    parts = bridge.cds(spark, sf_dir, 150)
    return intervals.merge_overlapping_genes(bridge.genes(parts), bridge.mrnas(parts))[1].select("id", "parent_id")


@query("running_max_end", f"{DENSE} SELECT id, max(e) OVER (PARTITION BY chrom, strand ORDER BY s, id ROWS UNBOUNDED PRECEDING) AS max_end FROM genes")
def running_max_end(spark, sf_dir):
    return intervals.running_max_end(bridge.genes(bridge.cds(spark, sf_dir, 150))).select("id", "max_end")


INTRONS = """,
gaps AS (SELECT chrom, strand, parent_id, e + 1 AS s, lead(s) OVER w - 1 AS e, row_number() OVER w AS n FROM cds WINDOW w AS (PARTITION BY parent_id ORDER BY s, id)),
introns AS (SELECT chrom, strand, parent_id, s, e, parent_id || ':intron:' || n AS id FROM gaps WHERE e IS NOT NULL)"""


@query("derive_introns", f"{BASE}{INTRONS} SELECT id, parent_id, s AS start, e AS stop FROM introns")
def derive_introns(spark, sf_dir):
    return hierarchy.introns(bridge.cds(spark, sf_dir)).select("id", "parent_id", "start", F.col("end").alias("stop"))


@query("cds_phase", f"""{BASE} SELECT id, CAST((3 - coalesce(sum(e - s + 1) OVER (PARTITION BY parent_id ORDER BY CASE WHEN strand = '-' THEN -s ELSE s END, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) % 3) % 3 AS BIGINT) AS phase FROM cds""")
def cds_phase(spark, sf_dir):
    return hierarchy.fix_phases(bridge.cds(spark, sf_dir)).select("id", "phase")


@query("locus_tags", f"{BASE} SELECT id, 'TEST_' || lpad(CAST(row_number() OVER (ORDER BY chrom, s, id) AS VARCHAR), CAST(greatest(5, length(CAST(row_number() OVER (ORDER BY chrom, s, id) AS VARCHAR))) AS INTEGER), '0') AS tag FROM genes")
def locus_tags(spark, sf_dir):
    return hierarchy.locus_tags(_genes(spark, sf_dir), "TEST", chunk=100_000).select("id", "tag")


@query("feature_counts", f"{BASE}, {MRNAS_SQL} SELECT 'gene' AS type, count(*) AS n FROM genes UNION ALL SELECT 'mRNA', count(*) FROM mrnas UNION ALL SELECT 'CDS', count(*) FROM cds")
def feature_counts(spark, sf_dir):
    return _features(spark, sf_dir).groupBy("type").agg(F.count(F.lit(1)).alias("n"))


def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = bridge.cds(spark, sf_dir)
    cols = ["chrom", F.lit("bridge").alias("source"), "type", "start", "end", "strand", F.lit(".").alias("frame"), "id", "parent_id"]
    gene = bridge.genes(parts).withColumn("type", F.lit("gene")).withColumn("parent_id", F.lit(None).cast("string")).select(*cols)
    mrna = bridge.mrnas(parts).withColumn("type", F.lit("mRNA")).select(*cols)
    return gene.unionByName(mrna).unionByName(parts.withColumn("type", F.lit("CDS")).select(*cols))


@query("feature_count_diff", f"""{BASE}, {second_sql('other', 11, 9)}, a AS (SELECT 'CDS' AS type, count(*) AS n FROM cds UNION ALL SELECT 'gene', count(*) FROM genes), b AS (SELECT 'CDS' AS type, count(*) AS n FROM other)
SELECT coalesce(a.type, b.type) AS type, coalesce(a.n, 0) AS n_a, coalesce(b.n, 0) AS n_b, coalesce(b.n, 0) - coalesce(a.n, 0) AS diff FROM a FULL JOIN b ON a.type = b.type""")
def feature_count_diff(spark, sf_dir):
    parts = bridge.cds(spark, sf_dir)
    count = lambda df: df.groupBy("type").agg(F.count(F.lit(1)).alias("n"))
    a = count(_features(spark, sf_dir).where("type <> 'mRNA'"))
    b = count(bridge.second_source(parts, 11, 9).withColumn("type", F.lit("CDS")))
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long"))
    out = a.withColumnRenamed("n", "x").join(b.withColumnRenamed("n", "y"), "type", "full")
    return out.select("type", zero(F.col("x")).alias("n_a"), zero(F.col("y")).alias("n_b"), (zero(F.col("y")) - zero(F.col("x"))).alias("diff"))


@query("gene_bounds_from_cds", f"{BASE} SELECT gene_id, min(s) AS start, max(e) AS stop, count(*) AS n_cds FROM cds GROUP BY chrom, strand, gene_id")
def gene_bounds_from_cds(spark, sf_dir):
    return hierarchy.gene_bounds(bridge.cds(spark, sf_dir)).select("gene_id", "start", F.col("end").alias("stop"), "n_cds")


@query("complete_hierarchy", f"""{BASE} SELECT 'gene' AS type, id, NULL AS parent_id FROM genes UNION ALL SELECT 'CDS', id, gene_id FROM cds
UNION ALL SELECT 'mRNA', id || '_mRNA', id FROM genes UNION ALL SELECT 'exon', id || ':exon', gene_id FROM cds""")
def complete_hierarchy(spark, sf_dir):
    rows = _features(spark, sf_dir).where("type <> 'mRNA'").withColumn("parent_id", F.regexp_replace("parent_id", r"\.m\d$", ""))
    return hierarchy.complete(rows).select("type", "id", "parent_id")


@query("exon_roles", f"""{BASE}, k AS (SELECT *, row_number() OVER (PARTITION BY parent_id ORDER BY CASE WHEN strand = '-' THEN -s ELSE s END, id) AS k, count(*) OVER (PARTITION BY parent_id) AS n FROM cds)
SELECT id, CASE WHEN n = 1 THEN 'Esngl' WHEN k = 1 THEN 'Einit' WHEN k = n THEN 'Eterm' ELSE 'Exon' END AS role, CASE WHEN strand = '-' THEN e ELSE s END AS from_pos, CASE WHEN strand = '-' THEN s ELSE e END AS to_pos FROM k""")
def exon_roles(spark, sf_dir):
    return hierarchy.exon_roles(bridge.cds(spark, sf_dir)).select("id", "role", F.col("from").alias("from_pos"), F.col("to").alias("to_pos"))


def _source(spark: SparkSession, sf_dir: str, drop: int | None = None, nudge: int = 9, parts: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    parts = bridge.cds(spark, sf_dir) if parts is None else parts
    if drop:
        parts = bridge.second_source(parts, drop, nudge)
    return bridge.genes(parts), bridge.mrnas(parts), parts.select("chrom", "strand", "start", "end", "id", "parent_id")


def _listed(name: str, source: str) -> str:
    return f"{name} AS (SELECT chrom, strand, gene_id, parent_id AS id, min(s) AS s, max(e) AS e, list(s ORDER BY s, e) AS ss, list(e ORDER BY s, e) AS es FROM {source} GROUP BY ALL)"


SAME = """a.chrom = b.chrom AND a.strand = b.strand AND a.s <= b.e AND b.s <= a.e AND len(a.ss) = len(b.ss)
 AND abs(a.s - b.s) <= 0.05 * greatest(a.e - a.s, b.e - b.s, 1) AND abs(a.e - b.e) <= 0.05 * greatest(a.e - a.s, b.e - b.s, 1)
 AND len(list_filter(range(1, len(a.ss) + 1), lambda i: (i > 1 AND abs(a.ss[i] - b.ss[i]) > 3) OR (i < len(a.ss) AND abs(a.es[i] - b.es[i]) > 3))) = 0"""


@query("concordant_models", f"{BASE}, {second_sql('other', 11, 9)}, {_listed('x', 'cds')}, {_listed('y', 'other')} SELECT DISTINCT a.gene_id FROM x a JOIN y b ON {SAME}")
def concordant_models(spark, sf_dir):
    parts = bridge.cds(spark, sf_dir, once=True)
    return concordance.concordant_genes(_source(spark, sf_dir, parts=parts)[1:], _source(spark, sf_dir, 11, parts=parts)[1:])


THREE = f"{BASE}, {second_sql('o1', 11, 9)}, {second_sql('o2', 7, 8)}, {_listed('x', 'cds')}, {_listed('y', 'o1')}, {_listed('z', 'o2')}"


@query("supported_models", f"""{THREE}, found AS (SELECT a.gene_id, 0 AS prio FROM x a JOIN y b ON {SAME} UNION SELECT a.gene_id, 1 FROM x a JOIN z b ON {SAME} UNION SELECT a.gene_id, 2 FROM z a JOIN y b ON {SAME})
SELECT gene_id AS id, CAST(min(prio) AS INTEGER) AS prio FROM found GROUP BY gene_id""")
def supported_models(spark, sf_dir):
    parts = bridge.cds(spark, sf_dir, once=True)
    return concordance.supported([_source(spark, sf_dir, *own, parts=parts) for own in ((), (11,), (7, 8))]).select("id", "prio")


@query("nonredundant_union", f"""{BASE}, {second_sql('o1', 11, 9)}, {second_sql('o2', 7, 8)}, rows_ AS (
  SELECT gene_id, min(s) AS start, 0 AS prio FROM o1 GROUP BY gene_id UNION ALL SELECT gene_id, min(s), 1 FROM o2 GROUP BY gene_id UNION ALL SELECT gene_id, min(s), 2 FROM cds GROUP BY gene_id)
SELECT gene_id AS id, arg_min(start, prio) AS start, CAST(min(prio) AS INTEGER) AS prio FROM rows_ GROUP BY gene_id""")
def nonredundant_union(spark, sf_dir):
    sources = (_source(spark, sf_dir, 11)[0], _source(spark, sf_dir, 7, 8)[0], _source(spark, sf_dir)[0])
    return concordance.nonredundant(*sources).select("id", "start", "prio")


@query("training_set_stats", f"{BASE} SELECT count(*) AS n, greatest(1, count(*) // 4) AS size, CAST(trunc(avg(e - s) / 2) AS INTEGER) AS flank FROM genes")
def training_set_stats(spark, sf_dir):
    return concordance.training_set(_genes(spark, sf_dir))


def classes_sql(pred: str, name: str = "classes") -> str:
    return f""",
ov AS (SELECT b.prediction, a.id AS rid, a.s AS rs, a.e AS re, a.strand, b.id AS pid, b.s AS ps, b.e AS pe, least(a.e, b.e) - greatest(a.s, b.s) + 1 AS bp FROM genes a JOIN {pred} b ON {OVER}),
c1 AS (SELECT *, bp / (re - rs + 1) AS cr, bp / (pe - ps + 1) AS cp FROM ov),
c2 AS (SELECT *, count(*) FILTER (WHERE cr > 0.5) OVER (PARTITION BY prediction, pid) >= 2 AS merging FROM c1),
c3 AS (SELECT *, max(CASE WHEN merging AND cr > 0.5 THEN 1 ELSE 0 END) OVER (PARTITION BY prediction, rid) = 1 AS merged FROM c2),
c4 AS (SELECT *, NOT merged AND count(*) FILTER (WHERE cp >= 0.5) OVER (PARTITION BY prediction, rid) >= 2 AS frag FROM c3),
c5 AS (SELECT *, merging OR max(CASE WHEN frag AND cp >= 0.5 THEN 1 ELSE 0 END) OVER (PARTITION BY prediction, pid) = 1 AS excluded FROM c4),
c6 AS (SELECT *, row_number() OVER (PARTITION BY prediction, rid ORDER BY excluded, bp DESC, ps, pid) AS k FROM c5),
labels AS (SELECT DISTINCT prediction FROM {pred}),
{name} AS (
  SELECT l.prediction, g.id AS ref_id, CASE WHEN c.rid IS NULL THEN 'missing' WHEN c.merged THEN 'merged' WHEN c.frag THEN 'fragmented' WHEN c.excluded THEN 'missing' WHEN g.s = c.ps AND g.e = c.pe THEN 'exact' ELSE 'inexact' END AS classification,
         g.strand, g.s AS rs, g.e AS re, c.pid, c.ps, c.pe, c.bp, c.cr AS sn, c.cp AS sp
  FROM genes g CROSS JOIN labels l LEFT JOIN c6 c ON c.rid = g.id AND c.prediction = l.prediction AND c.k = 1),
novel AS (SELECT prediction, id AS pred_id FROM {pred} b WHERE NOT EXISTS (SELECT 1 FROM ov WHERE ov.pid = b.id AND ov.prediction = b.prediction))"""


ONE = f"{BASE}, {predicted_sql('pred')}{classes_sql('pred')}"
MANY_PRED = f"{predicted_sql('q1')}, {predicted_sql('q2', 'p2', 5)}, {predicted_sql('q3', 'p3', 23)}, pred AS (SELECT * FROM q1 UNION ALL SELECT * FROM q2 UNION ALL SELECT * FROM q3)"
MANY = f"{BASE}, {MANY_PRED}{classes_sql('pred')}"


def _many(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    genes = cut(_genes(spark, sf_dir))
    return genes, bridge.predicted_genes(genes).unionByName(bridge.predicted_genes(genes, "p2", 5)).unionByName(bridge.predicted_genes(genes, "p3", 23))


@query("gene_classification", f"{ONE} SELECT classification, count(*) AS n FROM (SELECT classification FROM classes UNION ALL SELECT 'novel' FROM novel) GROUP BY classification")
def gene_classification(spark, sf_dir):
    return compare.classify_genes(*_pair(spark, sf_dir)).groupBy("classification").agg(F.count(F.lit(1)).alias("n"))


@query("gene_records", f"""{ONE} SELECT ref_id, classification, CASE WHEN hit THEN pid END AS pred_id, coalesce(CASE WHEN hit THEN bp END, 0) AS overlap_bp, CASE WHEN hit THEN round(sn, 6) END AS sn, CASE WHEN hit THEN round(sp, 6) END AS sp
FROM (SELECT *, classification IN ('exact', 'inexact') AS hit FROM classes)""")
def gene_records(spark, sf_dir):
    out = compare.classify_genes(*_pair(spark, sf_dir)).where("classification <> 'novel'")
    return out.select("ref_id", "classification", "pred_id", F.coalesce("overlap_bp", F.lit(0).cast("long")).alias("overlap_bp"), F.round("sn", 6).alias("sn"), F.round("sp", 6).alias("sp"))


@query("gene_stats", f"""{MANY}, n AS (SELECT prediction, count(*) AS novel FROM novel GROUP BY 1), c AS (
  SELECT prediction, count(*) FILTER (WHERE classification = 'exact') AS exact, count(*) FILTER (WHERE classification = 'inexact') AS inexact, count(*) FILTER (WHERE classification = 'missing') AS missing, count(*) FILTER (WHERE classification = 'merged') AS merged, count(*) FILTER (WHERE classification = 'fragmented') AS fragmented
  FROM classes GROUP BY 1), r AS (SELECT *, (exact + inexact) / (exact + inexact + missing + merged + fragmented) AS sens, (exact + inexact) / (exact + inexact + coalesce(novel, 0)) AS prec FROM c LEFT JOIN n USING (prediction))
SELECT prediction, exact, inexact, missing, merged, fragmented, coalesce(novel, 0) AS novel, round(sens, 6) AS sensitivity, round(prec, 6) AS precision, round(2 * sens * prec / (sens + prec), 6) AS f1 FROM r""")
def gene_stats(spark, sf_dir):
    out = compare.gene_stats(compare.classify_genes(*_many(spark, sf_dir)))
    return out.select("prediction", "exact", "inexact", "missing", "merged", "fragmented", "novel", *(F.round(c, 6).alias(c) for c in ("sensitivity", "precision", "f1")))


@query("boundary_diffs", f"""{ONE} SELECT ref_id, CASE WHEN strand = '+' THEN ps - rs ELSE re - pe END AS boundary_5p, CASE WHEN strand = '+' THEN pe - re ELSE rs - ps END AS boundary_3p FROM classes WHERE classification = 'inexact'""")
def boundary_diffs(spark, sf_dir):
    return compare.classify_genes(*_pair(spark, sf_dir)).where("classification = 'inexact'").select("ref_id", "boundary_5p", "boundary_3p")


def _binned(name: str, source: str) -> str:
    return f"{name} AS MATERIALIZED (SELECT id, chrom, strand, s, e, unnest(range(s // 2000, e // 2000 + 1)) AS bin FROM {source})"


@query("novel_predictions", f"{BASE}, {predicted_sql('pred')}, {_binned('gb', 'genes')}, {_binned('pb', 'pred')}, hit AS MATERIALIZED (SELECT DISTINCT b.id FROM pb b JOIN gb a USING (chrom, strand, bin) WHERE a.s <= b.e AND b.s <= a.e) SELECT id AS pred_id FROM pred WHERE id NOT IN (SELECT id FROM hit)")
def novel_predictions(spark, sf_dir):
    return compare.classify_genes(*_pair(spark, sf_dir)).where("classification = 'novel'").select("pred_id")


POWERSET = f"""{MANY}, kinds AS (SELECT ref_id, prediction, CASE WHEN classification IN ('exact', 'inexact') THEN 'match' ELSE classification END AS kind FROM classes),
grid AS (SELECT r.id AS ref_id, k.class FROM genes r CROSS JOIN (VALUES ('match'), ('missing'), ('merged'), ('fragmented')) k(class)),
sets AS (SELECT g.ref_id, g.class, coalesce(string_agg(x.prediction, ',' ORDER BY x.prediction), '') AS labels FROM grid g LEFT JOIN kinds x ON x.ref_id = g.ref_id AND x.kind = g.class GROUP BY 1, 2)
SELECT class, labels, count(*) AS n FROM sets GROUP BY 1, 2"""


@query("powerset_agreement", POWERSET)
def powerset_agreement(spark, sf_dir):
    records = compare.classify_genes(*_many(spark, sf_dir))
    return compare.agreement(records, ["p1", "p2", "p3"]).select("class", F.array_join("labels", ",").alias("labels"), "n")


@query("powerset_buckets", f"SELECT class, CASE len(string_split(labels, ',')) WHEN 3 THEN 'all' WHEN 2 THEN 'other' ELSE CASE WHEN labels = '' THEN 'none' ELSE 'unique' END END AS bucket, CAST(sum(n) AS BIGINT) AS n FROM ({POWERSET}) GROUP BY ALL")
def powerset_buckets(spark, sf_dir):
    records = compare.classify_genes(*_many(spark, sf_dir))
    return compare.agreement_buckets(compare.agreement(records, ["p1", "p2", "p3"]), 3)


def _cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = bridge.cds(spark, sf_dir, once=True)
    genes, mrnas, cds = _source(spark, sf_dir, parts=parts)
    pg, pm, pc = (x.withColumn("prediction", F.lit("p1")) for x in _source(spark, sf_dir, 11, parts=parts))
    return compare.compare({"genes": cut(genes), "mrnas": mrnas, "cds": cds}, {"genes": pg, "mrnas": pm, "cds": pc})


def _gaps(name: str, source: str) -> str:
    return f"{name} AS (SELECT * FROM (SELECT chrom, strand, parent_id, e + 1 AS s, lead(s) OVER w - 1 AS e, parent_id || ':intron:' || row_number() OVER w AS id FROM {source} WINDOW w AS (PARTITION BY parent_id ORDER BY s, id)) WHERE e IS NOT NULL)"


def _match(n: str, parents: str, ref: str, pred: str) -> str:
    """Up to eight lines a side: every way to give each line of the shorter side one of the longer, the greatest total wins,
    then the first in order. Beyond: overlaps are walked from the greatest on, one is kept if both of its lines are free."""
    return f"""
{n}_r AS (SELECT rp, pp, x.* FROM {parents} JOIN {ref} x ON x.parent_id = rp), {n}_p AS (SELECT rp, pp, x.* FROM {parents} JOIN {pred} x ON x.parent_id = pp),
{n}_o AS (SELECT rp, pp, r.id AS rid, p.id AS pid, r.s AS rs, r.e AS re, p.s AS ps, p.e AS pe, least(r.e, p.e) - greatest(r.s, p.s) + 1 AS bp FROM {n}_r r JOIN {n}_p p USING (rp, pp) WHERE r.chrom = p.chrom AND r.strand = p.strand AND r.s <= p.e AND p.s <= r.e AND least(r.e, p.e) >= greatest(r.s, p.s)),
{n}_k AS (SELECT *, dense_rank() OVER (PARTITION BY rp, pp ORDER BY rs, re, rid) AS a, dense_rank() OVER (PARTITION BY rp, pp ORDER BY ps, pe, pid) AS b FROM {n}_o),
{n}_big AS (SELECT rp, pp FROM (SELECT rp, pp FROM {n}_r GROUP BY rp, pp HAVING count(*) > 8 UNION SELECT rp, pp FROM {n}_p GROUP BY rp, pp HAVING count(*) > 8)),
{n}_s AS (SELECT rp, pp, rid, pid, a, b, row_number() OVER (PARTITION BY rp, pp ORDER BY bp DESC, a, b) AS z FROM {n}_k JOIN {n}_big USING (rp, pp)),
{n}_g AS (SELECT rp, pp, CAST(0 AS BIGINT) AS z, CAST([] AS BIGINT[]) AS ua, CAST([] AS BIGINT[]) AS ub, CAST(NULL AS VARCHAR) AS rid, CAST(NULL AS VARCHAR) AS pid FROM {n}_big
  UNION ALL SELECT rp, pp, z, CASE WHEN free THEN list_append(ua, a) ELSE ua END, CASE WHEN free THEN list_append(ub, b) ELSE ub END, CASE WHEN free THEN rid END, CASE WHEN free THEN pid END
  FROM (SELECT s.*, g.ua, g.ub, NOT list_contains(g.ua, s.a) AND NOT list_contains(g.ub, s.b) AS free FROM {n}_g g JOIN {n}_s s ON s.rp = g.rp AND s.pp = g.pp AND s.z = g.z + 1)),
{n}_n AS (SELECT rp, pp, max(a) AS na, max(b) AS nb FROM {n}_k WHERE (rp, pp) NOT IN (SELECT (rp, pp) FROM {n}_big) GROUP BY rp, pp),
{n}_c AS (SELECT rp, pp, rid, pid, bp, CASE WHEN na <= nb THEN a ELSE b END AS i, CASE WHEN na <= nb THEN b ELSE a END AS j FROM {n}_k JOIN {n}_n USING (rp, pp)),
{n}_w AS (SELECT rp, pp, least(na, nb) AS n, greatest(na, nb) AS m, CAST(0 AS BIGINT) AS done, CAST(0 AS BIGINT) AS total, CAST([] AS BIGINT[]) AS path FROM {n}_n
  UNION ALL SELECT w.rp, w.pp, w.n, w.m, w.done + 1, CAST(w.total + coalesce(c.bp, 0) AS BIGINT), list_append(w.path, t.j) FROM {n}_w w JOIN range(1, 9) t(j) ON t.j <= w.m AND NOT list_contains(w.path, t.j) LEFT JOIN {n}_c c ON c.rp = w.rp AND c.pp = w.pp AND c.i = w.done + 1 AND c.j = t.j WHERE w.done < w.n),
{n}_b AS (SELECT rp, pp, path, row_number() OVER (PARTITION BY rp, pp ORDER BY total DESC, path) AS z FROM {n}_w WHERE done = n),
{n}_m AS (SELECT rp, pp, rid, pid FROM {n}_b JOIN {n}_c USING (rp, pp) WHERE z = 1 AND path[i] = j UNION ALL SELECT rp, pp, rid, pid FROM {n}_g WHERE rid IS NOT NULL),
{n}_t AS (SELECT '{n}' AS level, (SELECT count(*) FROM {n}_m) AS tp, (SELECT count(*) FROM {n}_r WHERE (rp, pp, id) NOT IN (SELECT (rp, pp, rid) FROM {n}_m)) AS fn, (SELECT count(*) FROM {n}_p WHERE (rp, pp, id) NOT IN (SELECT (rp, pp, pid) FROM {n}_m)) AS fp)"""


CASCADE = f"""{BASE.replace("WITH", "WITH RECURSIVE", 1)}, {MRNAS_SQL}, {second_sql("other", 11, 9)},
pred AS (SELECT chrom, strand, gene_id AS id, min(s) AS s, max(e) AS e, 'p1' AS prediction FROM other GROUP BY chrom, strand, gene_id),
pred_mrnas AS (SELECT chrom, strand, parent_id AS id, gene_id AS parent_id, min(s) AS s, max(e) AS e FROM other GROUP BY chrom, strand, parent_id, gene_id){classes_sql("pred")},
{_gaps("ref_gaps", "cds")}, {_gaps("pred_gaps", "other")},
hits AS (SELECT ref_id AS rp, pid AS pp FROM classes WHERE classification IN ('exact', 'inexact')),{_match("mrna", "hits", "mrnas", "pred_mrnas")},
inside AS (SELECT DISTINCT rid AS rp, pid AS pp FROM mrna_m),{_match("cds", "inside", "cds", "other")},{_match("intron", "inside", "ref_gaps", "pred_gaps")},
parts AS (SELECT * FROM mrna_t UNION ALL SELECT * FROM cds_t UNION ALL SELECT * FROM intron_t)"""


@query("subfeature_match", f"""{CASCADE}, every AS (SELECT 'gene' AS level, classification, count(*) AS n FROM (SELECT classification FROM classes UNION ALL SELECT 'novel' FROM novel) GROUP BY classification
UNION ALL SELECT level, 'match', tp FROM parts UNION ALL SELECT level, 'missing', fn FROM parts UNION ALL SELECT level, 'fp', fp FROM parts) SELECT * FROM every WHERE n > 0""")
def subfeature_match(spark, sf_dir):
    return _cascade(spark, sf_dir).groupBy("level", "classification").agg(F.count(F.lit(1)).alias("n"))


@query("f1_by_level", f"""{CASCADE}, every AS (SELECT * FROM parts UNION ALL SELECT 'gene', count(*) FILTER (WHERE classification IN ('exact', 'inexact')), count(*) FILTER (WHERE classification NOT IN ('exact', 'inexact')), (SELECT count(*) FROM novel) FROM classes)
SELECT level, round(2 * tp / (2 * tp + fn + fp), 6) AS p1 FROM every""")
def f1_by_level(spark, sf_dir):
    out = compare.f1_by_level(_cascade(spark, sf_dir), ["p1"])
    return out.select("level", F.round("p1", 6).alias("p1"))


TABLE_11 = {"start": "TTG|CTG|ATT|ATC|ATA|ATG|GTG", "stop": "TAA|TAG|TGA"}
TABLE_1 = {"start": "TTG|CTG|ATG", "stop": "TAA|TAG|TGA"}


def _scan_sql(codons: dict[str, str]) -> str:
    # a pattern's matches are leftmost and do not overlap: they are marked in one pass and listed in another
    kind = lambda k: f"SELECT chrom AS id, length(seq) AS seqlen, '{k}' AS codon, string_split(regexp_replace(seq, '{codons[k]}', '#..', 'g'), '') AS m FROM contigs WHERE seq IS NOT NULL"
    return f"""WITH {CONTIGS_SQL}, marked AS ({kind('start')} UNION ALL {kind('stop')}),
walk AS (SELECT id, seqlen, codon, p FROM (SELECT id, seqlen, codon, unnest(m) AS c, generate_subscripts(m, 1) AS p FROM marked) WHERE c = '#')"""


def _transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bridge.contigs(spark, sf_dir).select(F.col("chrom").alias("id"), "seq", F.lit("+").alias("strand"))


@query("codon_scan", f"{_scan_sql(TABLE_11)} SELECT id, CAST(p AS INTEGER) AS pos, codon, CAST((p - 1) % 3 AS INTEGER) AS frame FROM walk")
def codon_scan(spark, sf_dir):
    return orf.codon_hits(_transcripts(spark, sf_dir), 11).select("id", "pos", "codon", "frame")


@query("longest_orf", f"""{_scan_sql(TABLE_1)},
h AS (SELECT id, seqlen, p, codon, (p - 1) % 3 AS frame, min(CASE WHEN codon = 'stop' THEN p END) OVER (PARTITION BY id, (p - 1) % 3 ORDER BY p ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS stop, min(p) OVER (PARTITION BY id, (p - 1) % 3) AS first FROM walk),
b AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY stop - p DESC, first, p) AS k FROM h WHERE codon = 'start' AND stop - p > 60 AND (stop - p) / seqlen > 0.1)
SELECT id, CAST(p AS INTEGER) AS start, CAST(stop + 2 AS INTEGER) AS stop, CAST(frame AS INTEGER) AS frame, CAST(stop - p AS INTEGER) AS orflen FROM b WHERE k = 1""")
def longest_orf(spark, sf_dir):
    hits = orf.codon_hits(_transcripts(spark, sf_dir), 1)
    return orf.longest_orfs(hits, 60, 0.1).select("id", "start", "stop", "frame", "orflen")


def _exons(contigs: DataFrame) -> DataFrame:
    """Three exons in each 200 bases of every contig (chrom, n), to its last base; on the minus strand for odd ids."""
    n = F.col("n")
    strand = F.when(F.substring("chrom", -1, 1).cast("int") % 2 == 1, "-").otherwise("+")
    tiles = contigs.where(n >= 4).select("chrom", strand.alias("strand"), "n", F.explode(F.sequence(F.lit(0).cast("long"), F.expr("(n - 1) div 200"))).alias("tile"))
    spans = F.array(*(F.struct((200 * F.col("tile") + a).alias("start"), F.least(200 * F.col("tile") + b, F.col("n")).alias("end"), (3 * F.col("tile") + k).alias("k")) for k, (a, b) in enumerate(((4, 60), (71, 130), (141, 197)))))
    rows = tiles.select("chrom", "strand", "n", F.explode(spans).alias("x")).where("x.start <= n")
    return rows.select("chrom", "strand", "x.start", "x.end", F.concat(F.lit("t"), "chrom", F.lit(":exon:"), F.col("x.k").cast("string")).alias("id"), F.concat(F.lit("t"), "chrom").alias("parent_id"))


EXONS_SQL = f"""WITH {CONTIGS_SQL},
tiles AS (SELECT chrom, seq, length(seq) AS n, unnest(range(0, (length(seq) - 1) // 200 + 1)) AS tile FROM contigs WHERE length(seq) >= 4),
exons AS (SELECT chrom, seq, CASE WHEN CAST(right(chrom, 1) AS INTEGER) % 2 = 1 THEN '-' ELSE '+' END AS strand, 3 * tile + x.k AS k, 200 * tile + x.a AS s, least(200 * tile + x.b, n) AS e FROM tiles CROSS JOIN (VALUES (0, 4, 60), (1, 71, 130), (2, 141, 197)) x(k, a, b) WHERE 200 * tile + x.a <= n),
whole AS (SELECT 't' || chrom AS id, strand, string_agg(substr(seq, s, e - s + 1), '' ORDER BY s) AS w FROM exons GROUP BY ALL),
spliced AS (SELECT id, strand, CASE WHEN strand = '-' THEN translate(reverse(w), 'ACGT', 'TGCA') ELSE w END AS seq FROM whole)"""


@query("spliced_sequence", f"{EXONS_SQL} SELECT id, strand, seq FROM spliced")
def spliced_sequence(spark, sf_dir):
    contigs = bridge.contigs(spark, sf_dir, once=True)
    return orf.spliced(_exons(contigs), contigs).select("id", "strand", "seq")


@query("translate_cds", f"""{EXONS_SQL}, bases AS (SELECT unnest(['T', 'C', 'A', 'G']) AS b, generate_subscripts(['T', 'C', 'A', 'G'], 1) - 1 AS k),
code AS (SELECT x.b || y.b || z.b AS codon, substr('FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG', CAST(16 * x.k + 4 * y.k + z.k + 1 AS BIGINT), 1) AS aa FROM bases x, bases y, bases z),
steps AS (SELECT id, p, substr(seq, 3 * p + 1, 3) AS codon FROM spliced, LATERAL (SELECT unnest(range(0, length(seq) // 3)) AS p) r)
SELECT spliced.id, coalesce(string_agg(aa, '' ORDER BY p), '') AS protein FROM spliced LEFT JOIN (steps JOIN code USING (codon)) x ON x.id = spliced.id GROUP BY spliced.id""")
def translate_cds(spark, sf_dir):
    contigs = bridge.contigs(spark, sf_dir, once=True)
    return orf.translated(orf.spliced(_exons(contigs), contigs), 1).select("id", "protein")


@query("orf_to_genome", f"""{EXONS_SQL},
orfs AS (SELECT 't' || chrom AS id, 1 AS f, sum(e - s + 1) AS t FROM exons GROUP BY chrom),
placed AS (SELECT 't' || chrom AS id, 't' || chrom || ':CDS:' || k AS cid, strand, s, e, coalesce(sum(e - s + 1) OVER (PARTITION BY chrom ORDER BY CASE WHEN strand = '-' THEN -s ELSE s END ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM exons),
cut AS (SELECT p.*, greatest(f - 1 - before, 0) AS low, least(t - CASE WHEN p.strand = '-' THEN 1 ELSE 0 END - before, e - s + 1) AS high FROM placed p JOIN orfs o ON p.id = o.id),
mapped AS (SELECT id AS parent_id, cid, strand, CASE WHEN strand = '-' THEN e - high + 1 ELSE s + low END AS s, CASE WHEN strand = '-' THEN e - low ELSE s + high - 1 END AS e FROM cut WHERE low < high)
SELECT cid AS id, parent_id, CAST(s AS BIGINT) AS start, CAST(e AS BIGINT) AS stop, CAST((3 - coalesce(sum(e - s + 1) OVER (PARTITION BY parent_id ORDER BY CASE WHEN strand = '-' THEN -s ELSE s END ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) % 3) % 3 AS BIGINT) AS phase FROM mapped""")
def orf_to_genome(spark, sf_dir):
    """An ORF from each transcript's first base to its last."""
    exons = _exons(bridge.contigs(spark, sf_dir, once=True))
    orfs = exons.groupBy(F.col("parent_id").alias("id")).agg(F.lit(1).cast("long").alias("start"), F.sum(F.col("end") - F.col("start") + 1).alias("stop"))
    return orf.map_to_genome(orfs, exons).select("id", "parent_id", "start", F.col("end").alias("stop"), "phase")


@query("transcript_orfs", f"""{EXONS_SQL},
marked AS (SELECT id, strand, length(seq) AS seqlen, k, string_split(regexp_replace(seq, pattern, '#..', 'g'), '') AS m FROM spliced CROSS JOIN (VALUES ('start', '{TABLE_1['start']}'), ('stop', '{TABLE_1['stop']}')) t(k, pattern)),
places AS (SELECT id, strand, seqlen, k, p FROM (SELECT id, strand, seqlen, k, unnest(m) AS c, generate_subscripts(m, 1) AS p FROM marked) WHERE c = '#'),
h AS (SELECT *, min(CASE WHEN k = 'stop' THEN p END) OVER (PARTITION BY id, (p - 1) % 3 ORDER BY p ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS stop, min(p) OVER (PARTITION BY id, (p - 1) % 3) AS first FROM places),
b AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY stop - p DESC, first, p) AS n FROM h WHERE k = 'start' AND stop - p > 90 AND (stop - p) / seqlen > 0.5),
orfs AS (SELECT id, p AS f, stop + 2 AS t FROM b WHERE n = 1),
placed AS (SELECT 't' || chrom AS id, 't' || chrom || ':CDS:' || k AS cid, strand, s, e, coalesce(sum(e - s + 1) OVER (PARTITION BY chrom ORDER BY CASE WHEN strand = '-' THEN -s ELSE s END ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM exons),
cut AS (SELECT p.*, greatest(f - 1 - before, 0) AS low, least(t - CASE WHEN p.strand = '-' THEN 1 ELSE 0 END - before, e - s + 1) AS high FROM placed p JOIN orfs o ON p.id = o.id)
SELECT cid AS id, id || '_mRNA' AS parent_id, CAST(CASE WHEN strand = '-' THEN e - high + 1 ELSE s + low END AS BIGINT) AS start, CAST(CASE WHEN strand = '-' THEN e - low ELSE s + high - 1 END AS BIGINT) AS stop FROM cut WHERE low < high""")
def transcript_orfs(spark, sf_dir):
    contigs = bridge.contigs(spark, sf_dir, once=True)
    return orf.transcript_orfs(_exons(contigs), contigs)["cds"].select("id", "parent_id", "start", F.col("end").alias("stop"))


def _hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window

    rank = F.row_number().over(Window.partitionBy("user_id").orderBy(F.desc("value"), "event_id"))
    return bridge.table(spark, sf_dir, "events").where("user_id is not null and value is not null").select(F.col("user_id").alias("query_id"), F.col("event_type").alias("hit_id"), rank.alias("hit_rank"), F.col("value").alias("score"), "event_id")


HITS = """WITH hits AS (SELECT user_id AS query_id, event_type AS hit_id, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS hit_rank, value AS score, event_id FROM events WHERE user_id IS NOT NULL AND value IS NOT NULL)"""


@query("best_hit_per_query", f"{HITS} SELECT query_id, hit_id, score FROM hits WHERE hit_rank = 1")
def best_hit_per_query(spark, sf_dir):
    return functional.best_hits(_hits(spark, sf_dir)).select("query_id", "hit_id", "score")


@query("domain_hits_greedy", HITS.replace("WITH", "WITH RECURSIVE", 1) + """, dom AS (SELECT query_id, hit_rank, event_id * 37 % 5000 AS a, event_id * 37 % 5000 + event_id % 40 AS b FROM hits),
walk AS (SELECT query_id, hit_rank, a, b, b AS done, TRUE AS kept FROM dom WHERE hit_rank = 1
  UNION ALL SELECT d.query_id, d.hit_rank, d.a, d.b, CASE WHEN d.a > w.done THEN d.b ELSE w.done END, d.a > w.done FROM walk w JOIN dom d ON d.query_id = w.query_id AND d.hit_rank = w.hit_rank + 1)
SELECT query_id, CAST(hit_rank AS INTEGER) AS hit_rank, a AS dom_start, b AS dom_end FROM walk WHERE kept""")
def domain_hits_greedy(spark, sf_dir):
    start = F.col("event_id") * 37 % 5000
    return functional.domain_hits(_hits(spark, sf_dir).withColumn("dom_start", start).withColumn("dom_end", start + F.col("event_id") % 40)).select("query_id", "hit_rank", "dom_start", "dom_end")


def _ko(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = bridge.table(spark, sf_dir, "events").where("event_type is not null and event_type <> 'refund'").select(F.col("event_type").alias("k_number")).distinct()
    return kinds.select("k_number", F.when(F.length("k_number") % 3 > 0, F.length("k_number") * 10.0).alias("threshold"), F.when(F.length("k_number") % 2 == 0, "full").otherwise("domain").alias("score_type"), F.concat("k_number", F.lit(" enzyme [EC:1.1.1."), F.length("k_number").cast("string"), F.lit(" n.n.n.n]")).alias("definition"))


@query("ko_threshold", HITS + """, ko AS (SELECT DISTINCT event_type AS k, CASE WHEN length(event_type) % 3 > 0 THEN length(event_type) * 10.0 END AS threshold, CASE WHEN length(event_type) % 2 = 0 THEN 'full' ELSE 'domain' END AS score_type FROM events WHERE event_type IS NOT NULL AND event_type <> 'refund'),
s AS (SELECT query_id, hit_id, hit_rank, threshold, CASE WHEN score_type = 'full' THEN score ELSE score / 2 END AS score FROM hits JOIN ko ON hit_id = k),
b AS (SELECT *, row_number() OVER (PARTITION BY query_id, hit_id ORDER BY score DESC, hit_rank) AS n FROM s)
SELECT query_id, hit_id, round(score, 6) AS score, coalesce(threshold IS NOT NULL AND score >= threshold, FALSE) AS above_threshold, 'EC' || length(hit_id) AS ec FROM b WHERE n = 1""")
def ko_threshold(spark, sf_dir):
    hits = _hits(spark, sf_dir).select("query_id", "hit_id", "hit_rank", F.col("score").alias("full_score"), F.lit(0.0).alias("full_evalue"), (F.col("score") / 2).alias("dom_score"), F.lit(0.0).alias("dom_evalue"))
    out = functional.ko_hits(hits, _ko(spark, sf_dir))
    return out.select("query_id", "hit_id", F.round("score", 6).alias("score"), "above_threshold", F.concat(F.lit("EC"), F.substring_index(F.array_join("ec_numbers", "|"), ".", -1)).alias("ec"))


@query("ec_extract", """SELECT p_partkey, trim(p_name || ' kinase') AS text, CASE WHEN p_partkey % 3 = 0 THEN '1.1.1.' || p_size || '|2.7.1.-' WHEN p_partkey % 3 = 1 THEN '' ELSE '3.4.21.n' || p_size END AS ecs FROM part""")
def ec_extract(spark, sf_dir):
    size = F.col("p_size").cast("string")
    tag = F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit(" [EC:1.1.1."), size, F.lit(" 2.7.1.-,1.1.1."), size, F.lit("]"))).when(F.col("p_partkey") % 3 == 1, F.lit(" [EC:n.n.n.n]")).otherwise(F.concat(F.lit(" [EC:3.4.21.n"), size, F.lit("]")))
    text = F.concat("p_name", F.lit(" kinase"), tag)
    return bridge.table(spark, sf_dir, "part").select("p_partkey", without_ec(text).alias("text"), F.array_join(ec_numbers(text), "|").alias("ecs"))


@query("product_cleanup", """SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN 'hypothetical protein' ELSE trim(p_name) END AS product, p_partkey % 2 = 0 OR p_partkey % 5 = 0 AS organism, p_partkey % 3 = 0 AND p_partkey % 5 <> 0 AS fragment FROM part""")
def product_cleanup(spark, sf_dir):
    k = F.col("p_partkey")
    text = F.when(k % 5 == 0, " OS=org OX=1").otherwise(F.concat("p_name", F.when(k % 3 == 0, " (Fragment)").otherwise(""), F.when(k % 2 == 0, " OS=Homo sapiens OX=9606").otherwise("")))
    return bridge.table(spark, sf_dir, "part").withColumn("c", clean_product(text)).select("p_partkey", F.col("c.text").alias("product"), F.col("c.organism").alias("organism"), F.col("c.fragment").alias("fragment"))


@query("inference_cap", """SELECT p_partkey, CAST(least(3, p_size) AS INTEGER) AS n_inference, CAST(CASE WHEN p_size > 3 THEN 1 ELSE 0 END AS INTEGER) AS n_capped, CAST(p_size AS INTEGER) AS n_kegg FROM part WHERE p_size > 0""")
def inference_cap(spark, sf_dir):
    many = F.transform(F.sequence(F.lit(1), F.col("p_size")), lambda i: F.concat(F.lit("KEGG:"), i.cast("string")))
    rows = bridge.table(spark, sf_dir, "part").where("p_size > 0").select("p_partkey", F.array("p_name").alias("product"), many.alias("inference"), F.array_append(many, F.lit("InterPro:1")).alias("dbxref"), F.lit(None).cast("array<string>").alias("note"))
    return submission.clean(rows).select("p_partkey", F.size("inference").alias("n_inference"), "n_capped", "n_kegg")


@query("drop_cdsless", f"""{BASE}, {MRNAS_SQL}, left_ AS (SELECT * FROM cds WHERE g % 4 <> 0 OR l_odd = 1), bare AS (SELECT id FROM mrnas WHERE id NOT IN (SELECT parent_id FROM left_))
SELECT id, 'mRNA' AS kind FROM bare UNION ALL SELECT id, 'gene' FROM genes WHERE id NOT IN (SELECT parent_id FROM mrnas WHERE id IN (SELECT parent_id FROM left_))""".replace("l_odd = 1", "right(parent_id, 1) = '1'"))
def drop_cdsless(spark, sf_dir):
    genes, mrnas, cds = _source(spark, sf_dir, parts=bridge.cds(spark, sf_dir, once=True))
    g = F.regexp_extract("id", r"^c(\d+)_", 1).cast("long")
    return submission.drop_set(genes, mrnas, cds.where((g % 4 != 0) | F.col("parent_id").endswith("1")))


@query("cleanup_report", """SELECT CAST(count(*) FILTER (WHERE p_partkey % 2 = 0) AS BIGINT) AS products, CAST(count(*) FILTER (WHERE p_partkey % 3 = 0) AS BIGINT) AS fragments, CAST(count(*) FILTER (WHERE p_size > 3) AS BIGINT) AS inferences, CAST(count(*) AS BIGINT) AS kegg FROM part WHERE p_size > 0""")
def cleanup_report(spark, sf_dir):
    k = F.col("p_partkey")
    text = F.concat("p_name", F.when(k % 3 == 0, " (Fragment)").otherwise(""), F.when(k % 2 == 0, " OS=org").otherwise(""))
    rows = bridge.table(spark, sf_dir, "part").where("p_size > 0").select(F.array(text).alias("product"), F.transform(F.sequence(F.lit(1), F.col("p_size")), lambda i: i.cast("string")).alias("inference"), F.array(F.lit("KEGG:x")).alias("dbxref"), F.array(F.lit("n")).alias("note"))
    none = spark.range(0).select(F.lit("").alias("id"), F.lit("").alias("kind"))
    return submission.report(submission.clean(rows), none).select("products", "fragments", "inferences", "kegg")


def _junctions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Junctions over all contigs and all of their bases; an intron in eight ends beyond its contig."""
    docs = bridge.contigs(spark, sf_dir).select("chrom", F.length("seq").cast("long").alias("n"))
    k, c = F.col("o_orderkey").cast("long"), F.col("o_custkey").cast("long")
    many = bridge.table(spark, sf_dir, "documents").agg(F.greatest(F.count(F.lit(1)), F.lit(1).cast("long")).alias("many"))  # one row
    rows = bridge.table(spark, sf_dir, "orders").join(F.broadcast(many)).select(k.alias("k"), c.alias("c"), F.concat(F.lit("d"), (k % F.col("many")).cast("string")).alias("chrom"))
    k, c, n = F.col("k"), F.col("c"), F.coalesce("n", F.lit(0).cast("long"))
    start = 1 + (k * 7919 + c * 104729) % F.greatest(n, F.lit(1).cast("long"))
    size = F.when(k % 8 == 0, n).otherwise((c * 31 + k * 17) % F.greatest(n - start, F.lit(1).cast("long")))
    return rows.join(docs, "chrom", "left").select("chrom", start.alias("intron_start"), (start + F.greatest(size, F.lit(1).cast("long"))).alias("intron_end"), (c % 3).alias("strand"), (k % 7).alias("motif"), (1 + k % 50).alias("unique"), (c % 5).alias("multi"))


JUNCTIONS = f"""{CONTIGS_SQL}, sized AS (SELECT chrom, length(seq) AS n FROM contigs),
placed AS (SELECT o_orderkey AS k, o_custkey AS c, 'd' || (o_orderkey % (SELECT greatest(1, count(*)) FROM contigs)) AS chrom FROM orders),
starts AS (SELECT p.*, coalesce(n, 0) AS n, 1 + (k * 7919 + c * 104729) % greatest(coalesce(n, 0), 1) AS a FROM placed p LEFT JOIN sized USING (chrom)),
junctions AS (SELECT chrom, a, a + greatest(CASE WHEN k % 8 = 0 THEN n ELSE (c * 31 + k * 17) % greatest(n - a, 1) END, 1) AS b, c % 3 AS strand, k % 7 AS motif, 1 + k % 50 AS uniq, c % 5 AS multi FROM starts)"""
TALLY = f"""WITH {JUNCTIONS},
kinds AS (SELECT CASE motif WHEN 1 THEN 'GT-AG' WHEN 2 THEN 'CT-AC' WHEN 3 THEN 'GC-AG' WHEN 4 THEN 'CT-GC' WHEN 5 THEN 'AT-AC' WHEN 6 THEN 'GT-AT' ELSE CASE WHEN seq IS NOT NULL AND b <= length(seq) THEN upper(substr(seq, a, 2) || '-' || substr(seq, b - 1, 2)) ELSE 'unknown' END END AS type, uniq FROM junctions LEFT JOIN contigs USING (chrom)),
tally AS (SELECT type, count(*) AS count, CAST(sum(uniq) AS BIGINT) AS unique_reads FROM kinds GROUP BY type)"""


@query("splice_tally", f"{TALLY} SELECT type, count, unique_reads FROM tally")
def splice_tally(spark, sf_dir):
    return splice.tally(_junctions(spark, sf_dir), bridge.contigs(spark, sf_dir))


@query("splice_filter", f"{TALLY} SELECT DISTINCT lower(replace(type, '-', '')) AS code FROM tally, (SELECT sum(count) AS total FROM tally) WHERE count >= 10 AND unique_reads >= 50 AND count / total >= 0.01 AND regexp_full_match(type, '..-..') AND lower(replace(type, '-', '')) NOT IN ('gtag', 'gcag')")
def splice_filter(spark, sf_dir):
    return splice.extra_types(splice.tally(_junctions(spark, sf_dir), bridge.contigs(spark, sf_dir)))


@query("intron_hints", f"WITH {JUNCTIONS} SELECT chrom, a AS start, b AS stop, CASE strand WHEN 1 THEN '+' WHEN 2 THEN '-' ELSE '.' END AS strand, 'mult=' || (uniq + multi) || ';pri=4;src=E' AS attributes FROM junctions")
def intron_hints(spark, sf_dir):
    return splice.intron_hints(_junctions(spark, sf_dir)).select("chrom", "start", F.col("end").alias("stop"), "strand", "attributes")


@query("intron_length_hist", f"{BASE}{INTRONS} SELECT e - s AS length, count(*) AS n FROM introns GROUP BY 1")
def intron_length_hist(spark, sf_dir):
    return splice.intron_lengths(hierarchy.introns(bridge.cds(spark, sf_dir)))


@query("introns_per_gene", f"{BASE}, n AS (SELECT gene_id, count(*) AS n FROM cds GROUP BY 1) SELECT CAST(sum(n - 1) AS BIGINT) AS introns, count(*) AS genes, round(sum(n - 1) / count(*), 6) AS per_gene, sum(n - 1) / count(*) > 0.25 AS many FROM n")
def introns_per_gene(spark, sf_dir):
    parts = bridge.cds(spark, sf_dir)
    return splice.introns_per_gene(bridge.genes(parts), parts).withColumn("per_gene", F.round("per_gene", 6))


@query("gene_length_limit", f"{BASE} SELECT CAST(trunc(avg(e - s)) AS BIGINT) + 2 * CAST(trunc(stddev_samp(e - s)) AS BIGINT) AS \"limit\" FROM genes")
def gene_length_limit(spark, sf_dir):
    return splice.gene_length_limit(_genes(spark, sf_dir))


@query("dedupe_by_header", "SELECT url AS header, min(page_id) AS line_no FROM pages GROUP BY url")
def dedupe_by_header(spark, sf_dir):
    rows = bridge.table(spark, sf_dir, "pages").select(F.col("url").alias("header"), F.col("html").alias("seq"), F.col("page_id").alias("line_no"))
    return submission.header_duplicates(rows).select("header", "line_no")


@query("contig_sort", f"WITH {CONTIGS_SQL} SELECT chrom, upper(seq) AS seq, length(seq) AS length FROM contigs ORDER BY length(seq) DESC, chrom")
def contig_sort(spark, sf_dir):
    return sequences.by_length(bridge.contigs(spark, sf_dir)).select("chrom", "seq", F.length("seq").cast("long").alias("length"))


@query("nonoverlapping_genes", f"{BASE}, {predicted_sql('pred')} SELECT a.id FROM genes a WHERE NOT EXISTS (SELECT 1 FROM pred b WHERE {OVER}) AND a.id IN (SELECT gene_id FROM cds)")
def nonoverlapping_genes(spark, sf_dir):
    parts = bridge.cds(spark, sf_dir)
    return intervals.nonoverlapping_genes(bridge.genes(parts), _pred(spark, sf_dir), parts.select("gene_id")).select("id")


@query("transcript_models", f"{BASE} SELECT 'gene' AS type, id, NULL AS parent_id FROM genes UNION ALL SELECT 'mRNA', id || '_mRNA', id FROM genes UNION ALL SELECT 'CDS', id, gene_id || '_mRNA' FROM cds")
def transcript_models(spark, sf_dir):
    parts = bridge.cds(spark, sf_dir)
    gene = bridge.genes(parts).select(F.lit("gene").alias("type"), F.concat(F.lit("x"), "id").alias("id"), F.col("id").alias("parent_id"))
    transcript = bridge.genes(parts).select(F.lit("transcript").alias("type"), F.lit("").alias("id"), F.col("id").alias("parent_id"))
    cds = parts.select(F.lit("CDS").alias("type"), "id", F.col("gene_id").alias("parent_id"))
    return evidence.transcript_models(gene.unionByName(transcript).unionByName(cds))


@query("running_exon_ids", "SELECT 'd' || (doc_id % 97) || ':exon:' || row_number() OVER (ORDER BY doc_id) AS id, 'd' || (doc_id % 97) AS parent_id FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL)")
def running_exon_ids(spark, sf_dir):
    rows = bridge.table(spark, sf_dir, "documents").where("doc_id is not null").select(F.col("doc_id").alias("line_no")).distinct()
    return evidence.assembled_exons(rows.withColumn("id", F.concat(F.lit("d"), (F.col("line_no") % 97).cast("string")))).select("id", "parent_id")


@query("evidence_weights", """WITH files AS (SELECT DISTINCT CASE p_partkey % 9 WHEN 0 THEN 'prot.gff3' WHEN 1 THEN 'augustus.gff3' WHEN 2 THEN 'snap.gff3' WHEN 3 THEN 'nr_transcripts.gff3' ELSE 'other' || (p_partkey % 9) || '.gff3' END AS name FROM part)
SELECT name, CASE WHEN name = 'prot.gff3' THEN 'PROTEIN' WHEN name IN ('augustus.gff3', 'snap.gff3') THEN 'ABINITIO_PREDICTION' WHEN name = 'nr_transcripts.gff3' THEN 'TRANSCRIPT' END AS kind,
 CASE name WHEN 'prot.gff3' THEN 2 WHEN 'augustus.gff3' THEN 1 WHEN 'snap.gff3' THEN 1 WHEN 'nr_transcripts.gff3' THEN 3 END AS weight, name NOT IN ('prot.gff3', 'nr_transcripts.gff3') AS prediction FROM files""")
def evidence_weights(spark, sf_dir):
    k = F.col("p_partkey") % 9
    name = F.when(k == 0, "prot.gff3").when(k == 1, "augustus.gff3").when(k == 2, "snap.gff3").when(k == 3, "nr_transcripts.gff3").otherwise(F.concat(F.lit("other"), k.cast("string"), F.lit(".gff3")))
    return evidence.evidence_weights(bridge.table(spark, sf_dir, "part").select(name.alias("name")).distinct()).select("name", "kind", "weight", "prediction")


@query("patched_consensus", f"""{BASE}, {predicted_sql('pred')}, fresh AS (SELECT a.id FROM genes a WHERE NOT EXISTS (SELECT 1 FROM pred b WHERE {OVER}))
SELECT 'gene' AS type, id FROM pred UNION ALL SELECT 'gene', id FROM fresh UNION ALL SELECT 'CDS', id FROM cds WHERE gene_id IN (SELECT id FROM fresh)""")
def patched_consensus(spark, sf_dir):
    parts = bridge.cds(spark, sf_dir)
    cols = ["chrom", "strand", "start", "end", "type", "id", "gene_id"]
    gene = lambda df: df.withColumn("type", F.lit("gene")).withColumn("gene_id", F.col("id")).select(*cols)
    orfs = gene(bridge.genes(parts)).unionByName(parts.withColumn("type", F.lit("CDS")).select(*cols))
    return evidence.patch_consensus(gene(_pred(spark, sf_dir)), orfs).select("type", "id")


@query("zff_listing", f"""{BASE}, contigs AS (SELECT 'chr' || k AS chrom, k AS position FROM range(0, 27) t(k)),
k AS (SELECT *, row_number() OVER (PARTITION BY parent_id ORDER BY s, id) AS k, row_number() OVER (PARTITION BY parent_id ORDER BY CASE WHEN strand = '-' THEN -s ELSE s END, id) AS r, count(*) OVER (PARTITION BY parent_id) AS n FROM cds)
SELECT chrom, position, '' AS mrna, 0 AS k, '>' || chrom AS value FROM contigs
UNION ALL SELECT chrom, position, parent_id, CAST(k AS INTEGER), CASE WHEN n = 1 THEN 'Esngl' WHEN r = 1 THEN 'Einit' WHEN r = n THEN 'Eterm' ELSE 'Exon' END || '  ' || CASE WHEN strand = '-' THEN e || ' ' || s ELSE s || ' ' || e END || ' ' || parent_id FROM k JOIN contigs USING (chrom)""")
def zff_listing(spark, sf_dir):
    contigs = spark.range(27).select(F.concat(F.lit("chr"), F.col("id").cast("string")).alias("chrom"), F.col("id").alias("position"))
    return evidence.zff_lines(bridge.cds(spark, sf_dir), contigs)


@query("genome_split_size", f"WITH {CONTIGS_SQL} SELECT CAST(sum(length(seq)) AS BIGINT) AS total, CAST(greatest(1, sum(length(seq)) // 16) AS BIGINT) AS size FROM contigs")
def genome_split_size(spark, sf_dir):
    return evidence.split_size(bridge.contigs(spark, sf_dir), 8)


@query("step_status", """WITH steps AS (SELECT 's' || o_custkey AS prefix, CASE WHEN o_orderkey % 29 = 0 THEN 'failed' WHEN o_orderkey % 31 = 0 THEN 'running' WHEN o_custkey % 3 = 0 THEN 'pending' ELSE 'completed' END AS status FROM orders)
SELECT prefix, CASE WHEN bool_or(status = 'failed') THEN 'failed' WHEN bool_or(status = 'running') THEN 'running' WHEN bool_and(status = 'completed') THEN 'completed' ELSE 'running' END AS status FROM steps GROUP BY prefix""")
def step_status(spark, sf_dir):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    state = F.when(k % 29 == 0, "failed").when(k % 31 == 0, "running").when(c % 3 == 0, "pending").otherwise("completed")
    return status.step_status(bridge.table(spark, sf_dir, "orders").select(F.concat(F.lit("s"), c.cast("string")).alias("prefix"), state.alias("status")))


@query("database_status", """SELECT 'p' || p_partkey AS name, CASE WHEN p_partkey % 7 = 0 THEN 'missing' WHEN p_partkey % 5 = 0 THEN 'unlisted' WHEN p_size % 2 = 0 THEN 'ok' ELSE 'corrupted' END AS state, p_partkey % 7 <> 0 AND p_partkey % 5 <> 0 AND p_size % 2 = 0 AS ok FROM part""")
def database_status(spark, sf_dir):
    k = F.col("p_partkey")
    rows = bridge.table(spark, sf_dir, "part").select("p_partkey", "p_size", F.concat(F.lit("p"), k.cast("string")).alias("name"), F.concat(F.lit("f"), k.cast("string")).alias("file"))
    manifest = rows.where(k % 5 != 0).select("name", F.lit("0").alias("md5"))
    files = rows.where(k % 7 != 0).select("file", (F.col("p_size") % 2).cast("string").alias("md5"))
    return status.database_status(rows.select("name", "file"), manifest, files)


@query("comparison_labels", r"""WITH n AS (SELECT page_id AS position, 'run' || (page_id % 40) || CASE WHEN page_id % 2 = 0 THEN '.gff3' ELSE '.v1.gff' END AS file FROM pages), s AS (SELECT position, regexp_replace(file, '\.[^.]+$', '') AS stem FROM n)
SELECT position, CASE WHEN count(*) OVER (PARTITION BY stem) > 1 THEN stem || '_' || row_number() OVER (PARTITION BY stem ORDER BY position) ELSE stem END AS label FROM s""")
def comparison_labels(spark, sf_dir):
    k = F.col("page_id")
    path = F.concat(F.lit("/out/run"), (k % 40).cast("string"), F.when(k % 2 == 0, ".gff3").otherwise(".v1.gff"))
    return status.labels(bridge.table(spark, sf_dir, "pages").select(k.alias("position"), path.alias("path")))
