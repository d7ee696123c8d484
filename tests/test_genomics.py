"""Genome operators on hand-written cases and against small brute-force versions."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from genespark.functions import codons
from genespark.functions.columns import attribute_map, attribute_text, clean_product, ec_numbers, pfam_accession, reverse_complement, splice_code, swap_kind, without_ec
from genespark.operators import compare, concordance, functional, hierarchy, intervals, orf, splice, submission
from genespark.sources import gff, sequences, tables

GENE = "chrom string, strand string, start long, end long, id string"
PART = GENE + ", parent_id string"


def genes(spark, rows, prediction=None):
    df = spark.createDataFrame([("chr1", s, a, b, i) for i, a, b, s in rows], GENE)
    return df.withColumn("prediction", F.lit(prediction)) if prediction else df


def parts(spark, rows):
    return spark.createDataFrame([("chr1", s, a, b, i, p) for i, p, a, b, s in rows], PART)


def lines(spark, text):
    return spark.createDataFrame(list(enumerate(text.strip("\n").split("\n"))), "line_no long, value string")


@pytest.mark.parametrize(("a", "b", "hit"), [((100, 500, "+"), (400, 800, "+"), True), ((100, 300, "+"), (400, 800, "+"), False), ((100, 500, "+"), (100, 500, "-"), False), ((100, 200, "+"), (201, 300, "+"), False), ((100, 200, "+"), (200, 300, "+"), True)])
def test_overlap(spark, a, b, hit):
    left, right = genes(spark, [("a", *a)]), genes(spark, [("b", *b)])
    assert intervals.interval_join(left, right, width=50).count() == hit
    assert intervals.interval_semi(left, right, width=50).count() == hit
    assert intervals.interval_anti(left, right, width=50).count() == (not hit)


def test_interval_join_and_clusters_brute_force(spark):
    r = random.Random(1)
    make = lambda n, p: [(f"{p}{k}", a := r.randint(1, 900), a + r.choice([0, 5, 40, 400]), r.choice("+-")) for k in range(n)]
    x, y = make(60, "x"), make(60, "y")
    got = {(v.l_id, v.r_id, v.bp) for v in intervals.interval_join(genes(spark, x), genes(spark, y), width=64).collect()}
    assert got == {(i, j, min(b, d) - max(a, c) + 1) for i, a, b, s in x for j, c, d, t in y if s == t and a <= d and c <= b}
    want = {}
    for s in "+-":
        end, name = None, None
        for i, a, b, _ in sorted((v for v in x if v[3] == s), key=lambda v: (v[1], v[0])):
            if end is None or a > end:
                name, end = i, b
            end = max(end, b)
            want[i] = name
    for chunk in (100, 10**6):
        assert {v.id: v.first_id for v in intervals.clusters(genes(spark, x), chunk=chunk).collect()} == want


def test_merge_and_reparent(spark):
    kept, moved = intervals.merge_overlapping_genes(genes(spark, [("g1", 100, 500, "+"), ("g2", 200, 500, "+")]), parts(spark, [("m1", "g1", 100, 500, "+"), ("m2", "g2", 200, 500, "+")]))
    assert [v.id for v in kept.collect()] == ["g1"]
    assert {v.id: v.parent_id for v in moved.collect()} == {"m1": "g1", "m2": "g1"}


def test_nonoverlapping_genes(spark):
    source = genes(spark, [("g1", 100, 300, "+"), ("g2", 800, 1000, "+"), ("g3", 2000, 2100, "+")])
    cds = spark.createDataFrame([("g1",), ("g2",)], "gene_id string")
    assert [v.id for v in intervals.nonoverlapping_genes(source, genes(spark, [("t", 100, 200, "+")]), cds).collect()] == ["g2"]
    assert intervals.nonoverlapping_genes(source, genes(spark, [("t", 1, 9000, "+")]), cds).count() == 0


@pytest.mark.parametrize(
    ("ref", "pred", "want"),
    [
        ([("a", 100, 200, "+"), ("b", 300, 400, "+")], [("P", 100, 400, "+")], {"a": "merged", "b": "merged"}),
        ([("a", 101, 200, "+"), ("b", 301, 400, "+")], [("P", 151, 350, "+")], {"a": "inexact", "b": "inexact"}),
        ([("a", 100, 400, "+")], [("P1", 100, 200, "+"), ("P2", 300, 400, "+")], {"a": "fragmented"}),
        ([("a", 101, 400, "+")], [("P1", 51, 150, "+"), ("P2", 351, 450, "+")], {"a": "fragmented"}),
        ([("a", 100, 200, "+")], [("P", 900, 950, "+")], {"a": "missing", "P": "novel"}),
        ([("a", 100, 200, "+")], [("P", 100, 200, "-")], {"a": "missing", "P": "novel"}),
        ([("a", 100, 300, "+")], [("P1", 50, 150, "+"), ("P2", 250, 350, "+")], {"a": "fragmented"}),
        ([("a", 100, 300, "+")], [("P1", 1, 120, "+"), ("P2", 280, 399, "+")], {"a": "inexact"}),
        ([("a", 100, 500, "+"), ("b", 1000, 2500, "-")], [("a", 110, 510, "+"), ("b", 1000, 2500, "-")], {"a": "inexact", "b": "exact"}),
    ],
)
def test_gene_classes(spark, ref, pred, want):
    out = compare.classify_genes(genes(spark, ref), genes(spark, pred, "p"))
    assert {v.ref_id or v.pred_id: v.classification for v in out.collect()} == want


def test_boundaries(spark):
    (tie,) = compare.classify_genes(genes(spark, [("a", 100, 300, "+")]), genes(spark, [("P1", 1, 120, "+"), ("P2", 280, 399, "+")], "p")).collect()
    assert (tie.pred_id, tie.boundary_5p, tie.boundary_3p) == ("P1", -99, -180)
    (minus,) = compare.classify_genes(genes(spark, [("a", 100, 300, "-")]), genes(spark, [("P", 110, 280, "-")], "p")).collect()
    assert (minus.boundary_5p, minus.boundary_3p) == (20, -10)
    (plus,) = compare.classify_genes(genes(spark, [("a", 100, 500, "+")]), genes(spark, [("P", 110, 510, "+")], "p")).collect()
    assert plus.overlap_bp == 391 and plus.sn == plus.sp == 391 / 401


THREE = [("g1", 100, 500, "+"), ("g2", 1000, 2500, "-"), ("g3", 3000, 3500, "+"), ("g4", 5000, 6000, "-")]


def test_agreement(spark):
    p3 = [THREE[0], THREE[1], ("g3", 3100, 3600, "+")]
    pred = genes(spark, THREE, "p1").unionByName(genes(spark, THREE[:3], "p2")).unionByName(genes(spark, p3, "p3"))
    records = compare.classify_genes(genes(spark, THREE), pred)
    out = {(v["class"], tuple(v.labels)): v.n for v in compare.agreement(records, ["p1", "p2", "p3"]).collect()}
    assert out[("match", ("p1", "p2", "p3"))] == 3 and out[("match", ("p1",))] == 1
    assert out[("missing", ("p2", "p3"))] == 1 and out[("missing", ())] == 3 and out[("merged", ())] == out[("fragmented", ())] == 4
    assert compare.agreement(records, ["p1"]).count() == 0
    for bad in ([], ["x", "x"]):
        with pytest.raises(ValueError):
            compare.agreement(records, bad)


def test_assignment():
    r = random.Random(5)
    for _ in range(400):
        n, m = r.randint(1, 4), r.randint(1, 4)
        w = [[r.choice([0, 0, 1, 2, 3]) for _ in range(m)] for _ in range(n)]
        short, long = min(n, m), max(n, m)
        best, found = -1, None
        for perm in itertools.permutations(range(long), short):
            pairs = [(i, j) if n <= m else (j, i) for i, j in enumerate(perm)]
            if (total := sum(w[i][j] for i, j in pairs)) > best:
                best, found = total, sorted((i, j) for i, j in pairs if w[i][j])
        assert compare.best_assignment(w) == found
    big = [[1] * 9 for _ in range(2)]
    assert compare.best_assignment(big) == [(0, 0), (1, 1)]


def test_parts_cascade(spark):
    ref_cds = [("c1", "m1", 100, 500, "+"), ("c2a", "m2", 1000, 1400, "-"), ("c2b", "m2", 2000, 2500, "-")]
    side = {"genes": genes(spark, THREE[:2]), "mrnas": parts(spark, [("m1", "g1", 100, 500, "+"), ("m2", "g2", 1000, 2500, "-")]), "cds": parts(spark, ref_cds)}
    out = compare.compare(side, {k: v.withColumn("prediction", F.lit("p")) for k, v in side.items()})
    counts = {(v.level, v.classification): v["count"] for v in out.groupBy("level", "classification").count().collect()}
    assert counts == {("gene", "exact"): 2, ("mrna", "match"): 2, ("cds", "match"): 3, ("intron", "match"): 1}
    text = gff.record_text(out.where("level = 'gene'"), compare.RECORD).collect()
    assert len(text) == 2 and all(len(v.value.split("\t")) == 16 for v in text)


def test_concordance(spark):
    def source(name, cds, span=None):
        a, b = span or (min(x for x, _ in cds), max(y for _, y in cds))
        return parts(spark, [("m" + name, "g" + name, a, b, "+")]), parts(spark, [(f"c{k}", "m" + name, x, y, "+") for k, (x, y) in enumerate(cds)])

    def agree(x, y, **o):
        return [v.gene_id for v in concordance.concordant_genes(source("a", x, **o), source("b", y, **o)).collect()]

    wide = {"span": (1, 2000)}
    assert agree([(100, 300)], [(105, 295)]) == ["ga"]
    assert agree([(100, 200), (400, 600)], [(95, 201), (399, 605)], **wide) == ["ga"]
    assert agree([(100, 200), (400, 600)], [(100, 210), (400, 600)], **wide) == []
    assert agree([(100, 200), (300, 400), (500, 600)], [(100, 201), (301, 401), (499, 600)], **wide) == ["ga"]
    assert agree([(100, 200), (300, 400)], [(100, 400)]) == []
    assert agree([(100, 300)], [(5000, 6000)]) == []
    one, two = genes(spark, [("g1", 1, 2, "+")]), genes(spark, [("g1", 5, 6, "+"), ("g2", 1, 2, "+")])
    assert {(v.id, v.start, v.prio) for v in concordance.nonredundant(one, two).collect()} == {("g1", 1, 0), ("g2", 1, 1)}
    with pytest.raises(ValueError):
        concordance.nonredundant(one)


def feature_rows(spark, rows):
    return spark.createDataFrame([("chr1", "s", t, a, b, "+", ".", i, p) for t, i, p, a, b in rows], "chrom string, source string, type string, start long, end long, strand string, frame string, id string, parent_id string")


def test_hierarchy(spark):
    whole = feature_rows(spark, [("gene", "g", None, 100, 500), ("CDS", "cds1", "g", 100, 300), ("CDS", "x", "g", 400, 500)])
    out = {(v.type, v.id) for v in hierarchy.complete(whole).collect()}
    assert out == {("gene", "g"), ("CDS", "cds1"), ("CDS", "x"), ("mRNA", "g_mRNA"), ("exon", "exon1"), ("exon", "x:exon")}
    full = feature_rows(spark, [("gene", "g", None, 1, 9), ("mRNA", "m", "g", 1, 9), ("exon", "e", "m", 1, 9), ("CDS", "c", "m", 1, 9)])
    assert hierarchy.complete(full).count() == 4
    phase = lambda strand: {v.id: v.phase for v in hierarchy.fix_phases(parts(spark, [("a", "m", 100, 200, strand), ("b", "m", 400, 600, strand)])).collect()}
    assert phase("+") == {"a": 0, "b": 1} and phase("-") == {"a": 0, "b": 0}
    tags = hierarchy.locus_tags(genes(spark, [("y", 900, 950, "+"), ("x", 10, 20, "-")]), "TEST", chunk=100)
    assert {v.id: v.tag for v in tags.collect()} == {"x": "TEST_00001", "y": "TEST_00002"}
    pretty = hierarchy.prettify(genes(spark, [("g", 1, 9, "+")]), parts(spark, [("m", "g", 1, 9, "+")]), parts(spark, [("e", "m", 1, 9, "+")]).withColumn("type", F.lit("exon")), "TEST")
    assert {v.id for v in pretty.collect()} == {"TEST_00001", "TEST_00001.mRNA.1", "TEST_00001.mRNA.1:exon:1"}


def test_phase_recurrence(spark):
    r = random.Random(7)
    rows, want = [], {}
    for m in range(40):
        phase, at = 0, 1
        for k in range(r.randint(1, 8)):
            n = r.randint(1, 60)
            rows.append((f"c{m}_{k}", f"m{m}", at, at + n - 1, "+"))
            want[f"c{m}_{k}"] = phase
            phase = (3 - ((n - phase) % 3)) % 3
            at += n + 5
    assert {v.id: v.phase for v in hierarchy.fix_phases(parts(spark, rows)).collect()} == want


def test_codons_and_orfs(spark):
    seqs = spark.createDataFrame([("a", "AAATGCCCCTAAGGG", "+"), ("b", "", "+"), ("c", "CCCCCCCCCC", "+"), ("d", "ATTTG", "+")], "id string, seq string, strand string")
    hits = lambda code: {(v.id, v.pos, v.codon) for v in orf.codon_hits(seqs, code).collect()}
    assert ("a", 3, "start") in hits(1) and ("a", 10, "stop") in hits(1) and ("a", 10, "stop") not in hits(6)
    assert not {h for h in hits(1) if h[0] in "bc"}
    assert {h for h in hits(11) if h[0] == "d"} == {("d", 1, "start")}
    schema = "id string, seqlen int, pos int, strand string, codon string, frame int"
    rows = spark.createDataFrame([("x", 200, p, "+", c, 0) for p, c in ((1, "start"), (10, "start"), (100, "stop"), (151, "stop"))], schema)
    (best,) = orf.longest_orfs(rows, 50, 0.1).collect()
    assert (best.start, best.stop) == (1, 102)
    assert orf.longest_orfs(rows, 99, 0.1).count() == 0 and orf.longest_orfs(rows, 50, 0.5).count() == 0
    with pytest.raises(ValueError):
        codons.table(99)


def test_sequences(spark):
    contig = spark.createDataFrame([("chr1", "N" * 9 + "ATGAAAAAATAA" + "N" * 78)], "chrom string, seq string")
    cds = parts(spark, [("c", "m", 10, 21, "+")])
    (v,) = orf.translated(orf.spliced(cds, contig)).collect()
    assert v.seq == "ATGAAAAAATAA" and v.protein == "MKK*"
    (v,) = orf.spliced(parts(spark, [("c", "m", 10, 12, "-"), ("d", "m", 13, 14, "-")]), contig).collect()
    assert v.seq == "TTCAT"
    row = spark.range(1).select(reverse_complement(F.lit("AcgTN")).alias("x")).first()
    assert row.x == "NAcgT"


def test_minus_strand_orf_loses_a_base(spark):
    orfs = spark.createDataFrame([("t", 10, 60)], "id string, start long, stop long")
    exons = parts(spark, [("exon1", "t", 101, 150, "-"), ("exon2", "t", 201, 250, "-")])
    bases = lambda compat: sum(v.end - v.start + 1 for v in orf.map_to_genome(orfs, exons, compat).collect())
    assert bases(False) == 51 and bases(True) == 50


def test_text_rules(spark):
    def one(expr):
        return spark.range(1).select(expr.alias("x")).first().x

    ec = lambda t: (one(ec_numbers(F.lit(t))), one(without_ec(F.lit(t))))
    assert ec("a [EC:3.2.1.92]") == (["3.2.1.92"], "a") and ec("a [EC:1.1.1.1,2.7.1.1 1.1.1.1] b") == (["1.1.1.1", "2.7.1.1"], "a b")
    assert ec("a [EC:1.1.1.-]")[0] == ["1.1.1.-"] and ec("a [EC:3.4.21.n6]")[0] == ["3.4.21.n6"] and ec("a [EC:n.n.n.n]") == ([], "a")
    clean = lambda t: tuple(one(clean_product(F.lit(t))))
    assert clean("Malic acid transport protein OS=x OX=1") == ("Malic acid transport protein", True, False)
    assert clean(" OS=org OX=1") == ("hypothetical protein", True, False) and clean("P (Fragment)") == ("P", False, True)
    assert one(pfam_accession(F.lit("PF00710.15"), F.lit("n"))) == "PF00710" and one(pfam_accession(F.lit(None).cast("string"), F.lit("n"))) == "n"
    assert one(splice_code(F.lit("GT-AG"))) == "gtag" and all(one(splice_code(F.lit(x))) is None for x in ("unknown", "GTT-AG", "G-A"))
    assert one(swap_kind(F.lit("exon1"), "exon", "CDS")) == "CDS1" and one(swap_kind(F.lit("x"), "exon", "CDS")) == "x:CDS"
    text = "ID=a;Note=x%2Cy,z+1;Dbxref=K:1;"
    assert one(attribute_map(F.lit(text))) == {"ID": ["a"], "Note": ["x,y", "z+1"], "Dbxref": ["K:1"]}
    assert one(attribute_text(attribute_map(F.lit(text)))) == "ID=a;Note=x%2Cy,z+1;Dbxref=K:1"


def test_functional(spark):
    domains = spark.createDataFrame([("q", 1, "a", 1, 5), ("q", 2, "b", 3, 9), ("q", 3, "c", 6, 8), ("r", 1, "a", 50, 60), ("r", 2, "b", 1, 10), ("r", 3, "z", None, None)], "query_id string, hit_rank int, hit_id string, dom_start int, dom_end int")
    assert {(v.query_id, v.hit_rank) for v in functional.domain_hits(domains).collect()} == {("q", 1), ("q", 3), ("r", 1)}
    ko = spark.createDataFrame([("K00001", 100.0, "full", "weak [EC:1.1.1.1]"), ("K00002", 100.0, "domain", "strong [EC:1.1.1.1 2.7.1.1]"), ("K3", None, "full", "none")], "k_number string, threshold double, score_type string, definition string")
    hits = spark.createDataFrame([("q", "K00001", 1, 250.0, 1e-9, 1.0, 1.0), ("q", "K00002", 2, 1.0, 1.0, 800.0, 1e-20), ("r", "K00001", 1, 50.0, 1e-9, 900.0, 1.0), ("r", "K3", 2, 999.0, 0.0, 1.0, 1.0), ("r", "K404", 3, 999.0, 0.0, 1.0, 1.0)], "query_id string, hit_id string, hit_rank int, full_score double, full_evalue double, dom_score double, dom_evalue double")
    found = functional.ko_hits(hits, ko)
    out = {v.query_id: v for v in functional.ko_annotation(found).collect()}
    assert out["q"].product == "strong" and out["q"].dbxref == ["KEGG:K00002", "KEGG:K00001"] and out["q"].ec_number == ["1.1.1.1", "2.7.1.1"]
    assert out["r"].product == "hypothetical protein" and out["r"].dbxref is None and out["r"].inference is None
    assert {v.query_id: v.text for v in functional.ko_text(found).collect()}["q"] == "K00001: weak (1.00e-09) ;; K00002: strong (1.00e-20)"


def test_splice(spark):
    rows = spark.createDataFrame([("chr1", 11, 50, 1, 1, 0, 100, 5, 30), ("chr1", 61, 90, 1, 0, 0, 50, 2, 25)], tables.JUNCTIONS)
    contig = spark.createDataFrame([("chr1", "N" * 60 + "AT" + "N" * 26 + "AC" + "N" * 10)], "chrom string, seq string")
    assert {tuple(v) for v in splice.tally(rows, contig).collect()} == {("GT-AG", 1, 100), ("AT-AC", 1, 50)}
    assert {v.attributes for v in splice.intron_hints(rows).collect()} == {"mult=105;pri=4;src=E", "mult=52;pri=4;src=E"}
    codes = lambda rows, **o: sorted(v.code for v in splice.extra_types(spark.createDataFrame(rows, "type string, count long, unique_reads long"), **o).collect())
    assert codes([("GT-AG", 4840, 9000), ("AT-AC", 100, 200), ("TT-CA", 60, 80)]) == ["atac", "ttca"]
    assert codes([("AT-AC", 3, 10)]) == [] and codes([("GT-AG", 10_000, 9), ("AT-AC", 15, 99)]) == [] and codes([("AT-AC", 1, 1)], permissive=True) == ["atac"] and codes([("GC-AG", 500, 500)]) == []


def test_submission(spark):
    schema = "product array<string>, inference array<string>, dbxref array<string>, note array<string>"
    rows = spark.createDataFrame([(["A (Fragment) OS=x"], ["1", "2", "3", "4"], ["KEGG:a", "InterPro:b"], None), (["B"], ["1"], ["KEGG:c"], ["n"]), (None, None, None, None)], schema)
    out = submission.clean(rows)
    assert [(v.product, v.inference, v.dbxref, v.note) for v in out.collect()] == [(["A"], ["1", "2", "3"], ["InterPro:b"], ["KEGG:a"]), (["B"], ["1"], None, ["n", "KEGG:c"]), (None, None, None, None)]
    none = spark.createDataFrame([], "id string, kind string")
    assert tuple(submission.report(out, none).first()) == (1, 1, 1, 2, 0, 0)
    again = submission.clean(out.select("product", "inference", "dbxref", "note"))
    assert tuple(submission.report(again, none).first()) == (0, 0, 0, 0, 0, 0)
    g, m, c = genes(spark, [("g1", 1, 9, "+"), ("g2", 1, 9, "+"), ("g3", 1, 9, "+")]), parts(spark, [("m1", "g1", 1, 9, "+"), ("m1b", "g1", 1, 9, "+"), ("m2", "g2", 1, 9, "+")]), parts(spark, [("c", "m1", 1, 9, "+")])
    assert {(v.id, v.kind) for v in submission.drop_set(g, m, c).collect()} == {("m1b", "mRNA"), ("m2", "mRNA"), ("g2", "gene"), ("g3", "gene")}
    counts = submission.validation_counts(lines(spark, "ERROR: a\nERROR: b\nINFO: c\nnote ERROR: d"))
    assert {v.severity: v.n for v in counts.collect()} == {"FATAL": 0, "ERROR": 2, "WARNING": 0, "INFO": 1}


GFF = """##gff-version 3
chr1 x\tt\tgene\t100\t500\t.\t+\t.\tID=g1
chr1\tt\tmRNA\t100\t500\t.\t+\t.\tID=m1;Parent=g1,g2
chr1\tt\texon\t100\t500\t.\t+\t.\tID=e1;Parent=m1
chr1\tt\tCDS\t100\t500\t.\t+\t0\tID=c1;Parent=m1
chr1\tt\tCDS\t.\t500\t.\t+\t0\tParent=m1
short\trow
##FASTA
chr1\tt\tgene\t1\t2\t.\t+\t.\tID=late"""


def test_gff_round_trip(spark, tmp_path):
    (tmp_path / "a.gff3").write_text(GFF)
    raw = gff.lines(spark, str(tmp_path / "a.gff3"))
    rows = gff.features(raw)
    assert rows.count() == 5 and gff.models(raw).count() == 3
    assert {v.id: v.parent_id for v in gff.models(raw).collect()} == {"g1": None, "m1": "g1", "c1": "m1"}
    assert gff.count_type(raw, "CDS").first().n == 2
    assert hierarchy.strip_contig_names(rows).select("chrom").distinct().count() == 1
    out = [v.value.split("\t")[2] for v in gff.hierarchical_text(rows).collect()]
    assert out == ["gene", "mRNA", "exon", "CDS", "CDS"] or out == ["gene", "mRNA", "exon", "CDS", "CDS"][:len(out)]
    gff.check(rows.where("id is not null"))
    with pytest.raises(ValueError):
        gff.check(rows.where("false"))


def test_fasta_and_lists(spark, tmp_path):
    (tmp_path / "a.fa").write_text(">one first\nACGT\nac\n>two\nGGG\n")
    out = {v.chrom: v.seq for v in sequences.read_fasta(spark, str(tmp_path / "a.fa")).collect()}
    assert out == {"one": "ACGTac", "two": "GGG"}
    assert [v.chrom for v in sequences.by_length(sequences.read_fasta(spark, str(tmp_path / "a.fa"))).collect()] == ["one", "two"]
    row = "\t".join(["K28880", "443.33", "full", *"abcdefgh", "def [EC:3.2.1.92]"])
    text = "header\n" + row + "\n" + row.replace("443.33", "-").replace("K28880", "K2") + "\nK3\tshort"
    assert {(v.k_number, v.threshold) for v in tables.ko_list(lines(spark, text)).collect()} == {("K28880", 443.33), ("K2", None)}
    log = lines(spark, "Uniquely mapped reads % |\t60.5%\n% of reads mapped to multiple loci |\t10.0%")
    assert tuple(tables.mapping_rate(log).first()) == (60.5, 10.0, 70.5, True)


def test_sides_of_a_match_are_stored_once(spark, monkeypatch):
    """Both sides' parts below matched parents are read several times, so they are stored."""
    from genespark.operators.lineage import cut

    stored = []
    monkeypatch.setattr(compare, "cut", lambda df: stored.append(set(df.columns)) or cut(df))
    parents = spark.createDataFrame([("p", "a", "b")], "prediction string, ref_parent string, pred_parent string")
    ref = spark.createDataFrame([("c", "+", 1, 9, "r1", "a"), ("c", "+", 20, 29, "r2", "a")], "chrom string, strand string, start long, end long, id string, parent_id string")
    pred = spark.createDataFrame([("c", "+", 2, 9, "q1", "b", "p"), ("c", "+", 40, 49, "q2", "b", "p")], "chrom string, strand string, start long, end long, id string, parent_id string, prediction string")
    got = sorted((r.classification, r.ref_id or "", r.pred_id or "") for r in compare.match_parts("cds", parents, ref, pred).collect())
    assert got == [("fp", "", "q2"), ("match", "r1", "q1"), ("missing", "r2", "")]
    assert any("id" in c and "p_id" not in c for c in stored) and any("p_id" in c and "id" not in c for c in stored)
