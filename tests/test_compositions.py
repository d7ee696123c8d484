"""Annotated and released GFF3, ORFs of transcripts end to end, files, summaries and step outputs."""

import gzip
import json
import os
import random

from genespark.operators import functional, orf, splice, status, submission
from genespark.sources import files, gff

GFF = """##gff-version 3
c\ts\tgene\t1\t90\t.\t+\t.\tID=g1;Note=kept
c\ts\tmRNA\t1\t90\t.\t+\t.\tID=m1;Parent=g1;product=Kinase OS=Homo sapiens;inference=a,b,c,d;Dbxref=KEGG:K1,X:2
c\ts\texon\t1\t90\t.\t+\t.\tID=e1;Parent=m1
c\ts\tCDS\t1\t90\t.\t+\t0\tID=c1;Parent=m1;Dbxref=KEGG:K2
c\ts\tmRNA\t1\t80\t.\t+\t.\tID=m2;Parent=g1
c\ts\texon\t1\t80\t.\t+\t.\tID=e2;Parent=m2
c\ts\tgene\t200\t290\t.\t-\t.\tID=g2
c\ts\tmRNA\t200\t290\t.\t-\t.\tID=m3;Parent=g2
"""


def features(spark, tmp_path):
    (tmp_path / "in.gff3").write_text(GFF)
    return gff.features(gff.lines(spark, str(tmp_path / "in.gff3")))


def test_release(spark, tmp_path):
    lines, report = submission.release(features(spark, tmp_path))
    got = [r.value for r in lines.collect()]
    assert got[0] == "##gff-version 3" and [x.split("\t")[2] for x in got[1:]] == ["gene", "mRNA", "exon", "CDS"]
    assert got[2].split("\t")[8] == "ID=m1;Parent=g1;product=Kinase;inference=a,b,c;Dbxref=X:2;Note=KEGG:K1"
    assert got[4].split("\t")[8] == "ID=c1;Parent=m1;Note=KEGG:K2" and got[1].endswith("ID=g1;Note=kept")
    assert report.first().asDict() == {"products": 1, "fragments": 0, "inferences": 1, "kegg": 2, "mrnas": 2, "genes": 1}


def test_annotation(spark, tmp_path):
    hits = spark.createDataFrame([("m1", 1, "P1", "Some enzyme", 1e-30), ("m1", 2, "P2", "Other", 0.5), ("m2", 1, "P3", "Weak", 0.9)], "query_id string, hit_rank int, hit_id string, description string, evalue double")
    domains = spark.createDataFrame([("m1", 1, "Dom", "d", 1e-5, "PF1.3"), ("m1", 2, "Far", "f", 0.2, "PF2.1")], "query_id string, hit_rank int, hit_id string, description string, evalue double, accession string")
    got = {x.value.split("\t")[2] + x.value.split("\t")[8].split(";")[0]: x.value.split("\t")[8] for x in functional.annotate_lines(features(spark, tmp_path), hits, domains).collect()}
    assert got["mRNAID=m1"] == "ID=m1;Parent=g1;Dbxref=KEGG:K1,X:2;product=Some enzyme;inference=similar to AA sequence:UniProtKB:P1,protein motif:PFAM:PF1;locus_tag=m1"
    assert "product=hypothetical protein" in got["mRNAID=m2"] and "product=Some enzyme" in got["CDSID=c1"] and got["geneID=g1"] == "ID=g1;Note=kept"


def test_transcript_orfs(spark):
    """A planted ORF over two exons on either strand is found, mapped back, and overlapping transcripts share a gene."""
    r = random.Random(1)
    inner = "".join(r.choice(["GCC", "GAC", "AAC", "GGC"]) for _ in range(60))
    coding = "ATG" + inner + "TAA"
    left, right = coding[:80], coding[80:]
    plus = "CC" + left + "CCCCC" + right + "CC"
    comp = str.maketrans("ACGT", "TGCA")
    contigs = spark.createDataFrame([("p", plus), ("m", plus[::-1].translate(comp)), ("n", "C" * 300)], "chrom string, seq string")
    n = len(plus)
    spans = [(3, 82), (88, 87 + len(right))]
    rows = [("p", "+", a, b, f"t1:exon:{k}", "t1") for k, (a, b) in enumerate(spans)] + [("m", "-", n + 1 - b, n + 1 - a, f"t2:exon:{k}", "t2") for k, (a, b) in enumerate(spans)] + [("p", "+", 10, 40, "t3:exon:0", "t3"), ("n", "+", 1, 300, "t4:exon:0", "t4")]
    out = orf.transcript_orfs(spark.createDataFrame(rows, "chrom string, strand string, start long, end long, id string, parent_id string"), contigs)
    cds = sorted((x.parent_id, x.start, x.end) for x in out["cds"].collect())
    assert cds == sorted([("t1_mRNA", *spans[0]), ("t1_mRNA", *spans[1]), *(("t2_mRNA", n + 1 - b + (k == 1), n + 1 - a) for k, (a, b) in enumerate(spans))])
    assert sorted(x.id for x in out["genes"].collect()) == ["t1", "t2", "t4"]
    assert {x.id: x.parent_id for x in out["mrnas"].collect()} == {"t1_mRNA": "t1", "t2_mRNA": "t2", "t3_mRNA": "t1", "t4_mRNA": "t4"}


def test_files(spark, tmp_path):
    for k, name in enumerate(("db.updates.9999.gff3", "db.updates.10000.gff3", "old.gff3")):
        (tmp_path / name).write_text("x")
        os.utime(tmp_path / name, (1_700_000_000 + (100 if k == 0 else k), 1_700_000_000 + (100 if k == 0 else k)))
    found = files.listed(spark, str(tmp_path), "*updates.*.gff3")
    assert files.newest(found, "raw").endswith("9999.gff3") and files.newest(found.where("false"), "raw") == "raw"
    for run, name, text in (("RM_1", "round-9/consensi.fa", ">a"), ("RM_2", "round-1/refined-cons.fa", ">a"), ("RM_2", "round-2/consensi.fa", ">a"), ("RM_2", "round-2/consensi.fa.classified", ""), ("RM_2", "consensi.fa", "")):
        path = tmp_path / "lib" / run / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text)
    lib = files.listed(spark, str(tmp_path / "lib"))
    assert files.salvageable(lib).endswith("RM_2/round-2/consensi.fa") and files.salvageable(lib.where("false")) is None
    (tmp_path / "lib/RM_2/consensi.fa").write_text(">b")
    lib = files.listed(spark, str(tmp_path / "lib"))
    assert files.salvageable(lib).endswith("RM_2/consensi.fa")
    paths = [r.path for r in lib.orderBy("path").collect()]
    assert files.first_filled(lib, ["nowhere", *paths[::-1]]) == next(p for p in paths[::-1] if "classified" not in p)
    (tmp_path / "a.txt").write_bytes(gzip.compress(b"x"))
    assert files.is_gzipped(spark, str(tmp_path / "a.txt")) and not files.is_gzipped(spark, str(tmp_path / "old.gff3"))
    (tmp_path / "m.json").write_text(json.dumps({"steps": {"a": {"status": "completed"}}}, indent=1))
    assert files.read_json(spark, str(tmp_path / "m.json")).first().steps.a.status == "completed"
    (tmp_path / "bad.json").write_text("{not")
    assert files.read_json(spark, str(tmp_path / "bad.json")).count() == 0


def test_summaries(spark):
    rows = spark.createDataFrame([("GT-AG", 5, 9), ("AT-AC", 7, 1), ("CT-AC", 5, 2)], "type string, count long, unique_reads long")
    assert list(json.loads(splice.summary_json(rows)).items()) == [("AT-AC", {"count": 7, "unique_reads": 1}), ("CT-AC", {"count": 5, "unique_reads": 2}), ("GT-AG", {"count": 5, "unique_reads": 9})]
    steps = spark.createDataFrame([("a", "completed", "/a.gff3"), ("b", "completed", "/b.txt"), ("c", "running", "/c"), ("d", "completed", None), ("e", "completed", "/e.gff"), ("f", "completed", "/f.gff")], "step string, status string, output string")
    there = spark.createDataFrame([("/b.txt", 0), ("/e.gff", 4), ("/f.gff", 4)], "path string, size long")
    out = status.output_errors(steps, there, spark.createDataFrame([("/f.gff",)], "path string"))
    assert {(x.step, x.state) for x in out.collect()} == {("a", "missing"), ("b", "empty"), ("e", "unparseable")}
