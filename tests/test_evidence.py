"""Evidence and status operators on hand-written cases."""

from pyspark.sql import functions as F

from genespark.operators import evidence, status

FEATURE = "chrom string, source string, type string, start long, end long, strand string, frame string, id string, parent_id string"


def features(spark, rows):
    return spark.createDataFrame([("chr1", "t", k, a, b, s, ".", i, p) for k, i, p, a, b, s in rows], FEATURE)


def lines(spark, text):
    return spark.createDataFrame(list(enumerate(text.strip("\n").split("\n"))), "line_no long, value string")


def ids(df):
    return {(v.type, v.id, v.parent_id) for v in df.collect()}


def test_hierarchies(spark):
    rows = features(spark, [("gene", "x", "g", 1, 9, "+"), ("gene", "h", None, 1, 9, "+"), ("transcript", "", "g", 1, 9, "+"), ("CDS", "c", "g", 1, 9, "+"), ("CDS", "d", None, 1, 9, "+")])
    assert ids(evidence.transcript_models(rows)) == {("gene", "g", None), ("gene", "h", None), ("mRNA", "g_mRNA", "g"), ("CDS", "c", "g_mRNA"), ("CDS", "d", None)}
    assert ids(evidence.coding_models(rows.where("type = 'CDS'"), "cq")) == {("CDS", "c", "g_mRNA"), ("CDS", "d", None)}
    low = evidence.protein_alignments(features(spark, [("cds", "c", "m", 1, 9, "+"), ("mRNA", "m", "g", 1, 9, "+")]))
    assert ids(low) == {("CDS", "m:c", "m"), ("mRNA", "m", "g")} and {v.source for v in low.collect()} == {"prot_align"}
    assert ids(evidence.threaded_models(features(spark, [("gene", "g", None, 1, 9, "+"), ("exon", "e", "g", 1, 9, "+"), ("tss", "t", "g", 1, 9, "+")]))) == {("gene", "g", None), ("exon", "e", "g_mRNA")}
    out = evidence.normalize(features(spark, [("gene", "g", None, 1, 9, "+"), ("exon", "exon1", "g_mRNA", 1, 9, "+")]).withColumn("chrom", F.lit("c 1")), parse=evidence.threaded_models, fix_contigs=True)
    assert {(v.type, v.chrom) for v in out.collect()} == {("gene", "c"), ("mRNA", "c"), ("exon", "c"), ("CDS", "c")}
    assert evidence.normalize(rows.where("false")).count() == 0


def test_running_number(spark):
    rows = spark.range(0, 1000, 7).select(F.col("id").alias("line_no"))
    out = evidence.running_number(rows, chunk=50).orderBy("line_no").collect()
    assert [v.n for v in out] == list(range(1, len(out) + 1))
    made = evidence.assembled_exons(spark.createDataFrame([(5, "a"), (6, None), (9, "a")], "line_no long, id string"))
    assert {(v.id, v.parent_id) for v in made.collect()} == {("a:exon:1", "a"), (":exon:2", ""), ("a:exon:3", "a")}


def test_weights_and_split(spark):
    out = evidence.evidence_weights(spark.createDataFrame([("prot.gff3",), ("snap.gff3",), ("mine.gff3",)], "name string"), (5, 6, 7))
    assert {(v.name, v.weight, v.prediction) for v in out.collect()} == {("prot.gff3", 5, False), ("snap.gff3", 6, True), ("mine.gff3", None, True)}
    contigs = spark.createDataFrame([("a", "ACGTA"), ("b", "AC")], "chrom string, seq string")
    assert tuple(evidence.split_size(contigs, 1).first()) == (7, 3) and tuple(evidence.split_size(contigs.where("false"), 4).first()) == (0, 1)


def test_patch_and_zff(spark):
    kind = "chrom string, strand string, start long, end long, type string, id string, gene_id string"
    old = spark.createDataFrame([("c", "+", 1, 50, "gene", "g", "g")], kind)
    orfs = spark.createDataFrame([("c", "+", 40, 60, "gene", "a", "a"), ("c", "+", 40, 60, "CDS", "ac", "a"), ("c", "-", 40, 60, "gene", "b", "b"), ("c", "-", 40, 60, "CDS", "bc", "b"), ("c", "+", 90, 99, "gene", "n", "n")], kind)
    assert {v.id for v in evidence.patch_consensus(old, orfs).collect()} == {"g", "b", "bc"}
    exons = spark.createDataFrame([("c", "-", 1, 5, "e1", "m"), ("c", "-", 9, 12, "e2", "m"), ("c", "+", 30, 40, "e3", "s"), ("x", "+", 1, 2, "e4", "o")], "chrom string, strand string, start long, end long, id string, parent_id string")
    contigs = spark.createDataFrame([("d", 0), ("c", 1)], "chrom string, position long")
    out = [v.value for v in evidence.zff_lines(exons, contigs).orderBy("position", "mrna", "k").collect()]
    assert out == [">d", ">c", "Eterm  5 1 m", "Einit  12 9 m", "Esngl  30 40 s"]


def test_status(spark):
    steps = spark.createDataFrame([("a", "completed"), ("a", "failed"), ("b", "completed"), ("c", "completed"), ("c", "pending"), ("d", "running"), ("e", None)], "prefix string, status string")
    assert {tuple(v) for v in status.step_status(steps).collect()} == {("a", "failed"), ("b", "completed"), ("c", "running"), ("d", "running"), ("e", "running")}
    assert status.status_of(steps, "none").first().status == "pending" and status.status_of(steps, "b").first().status == "completed"
    registry = spark.createDataFrame([("p", "p.hmm"), ("u", "u.fa"), ("k", "k.hmm"), ("z", "z")], "name string, file string")
    manifest = spark.createDataFrame([("p", "1"), ("k", "2"), ("z", "3")], "name string, md5 string")
    files = spark.createDataFrame([("p.hmm", "1"), ("u.fa", "1"), ("k.hmm", "9")], "file string, md5 string")
    assert {v.name: v.state for v in status.database_status(registry, manifest, files).collect()} == {"p": "ok", "u": "unlisted", "k": "corrupted", "z": "missing"}
    assert status.database_status(registry, manifest, files, F.col("name").isin("p")).count() == 1


def test_logs(spark):
    assert tuple(status.training_counted(lines(spark, "LOCUS a\nx\nLOCUS b")).first()) == (2, True)
    assert tuple(status.transcripts_counted(lines(spark, ">a b\nAC\n>c")).first()) == (2, True)
    assert tuple(status.introns_counted(lines(spark, "#h\n1\n2")).first()) == (2, True)
    assert [v.accession for v in status.accessions(lines(spark, ">a b\nAC\n>c")).collect()] == ["a", "c"]
    log = lines(spark, "tag: 10 (0.25)\nother\ntaa: 3 (0.5)\ntga: 9 (0.25)")
    shares = status.stop_shares(log)
    assert [v.share for v in shares.orderBy("k").collect()] == ["0.25", "0.5", "0.25"]
    config = lines(spark, "/c/amberprob 0.33 # x\nkeep  this\n/c/ochreprob 0.33\n/c/opalprob  0.34")
    out = [v.value for v in status.with_stop_shares(config, shares).orderBy("line_no").collect()]
    assert out == ["/c/amberprob 0.25 # x", "keep  this", "/c/ochreprob 0.5", "/c/opalprob 0.25"]
    assert [v.share for v in status.stop_shares(log, 6).collect()] == ["0", "0", "1"]
    assert status.intron_distribution(lines(spark, "x\nintrons\ta b 1 2 3.5 p q r")).first().value == "1.000000 3.500000"
    assert status.intron_distribution(lines(spark, "none")).first().value == ""
    paths = spark.createDataFrame([(0, "/a/x.gff3"), (1, "/b/y.gff3"), (2, "/c/x.gff"), (3, ".hidden")], "position int, path string")
    assert {v.position: v.label for v in status.labels(paths).collect()} == {0: "x_1", 1: "y", 2: "x_2", 3: ".hidden"}
