"""Contig queries over whole texts against plain loops over texts much longer than 600 characters."""

import random
import re
import time
from collections import Counter

import pytest

from genespark.functions import codons
from genespark.operators import orf, splice
from genespark.plans import catalog

CODE = str.maketrans("abcdefghijklmnopqrstuvwxyz", "acgtacgtacgtacgtacgtacgtac")


@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    r = random.Random(8)
    rows = [(i, "".join(r.choice("abcdefgh iéK.") for _ in range(n))) for i, n in enumerate((0, 2, 30, 599, 700, 2500, 9000))] + [(7, None)]
    at = str(tmp_path_factory.mktemp("whole"))
    spark.createDataFrame(rows, "doc_id long, text string").write.mode("overwrite").parquet(f"{at}/documents.parquet")
    spark.createDataFrame([(k, 3 * k + 1) for k in range(3000)], "o_orderkey long, o_custkey long").write.mode("overwrite").parquet(f"{at}/orders.parquet")
    return at, {f"d{i}": re.sub("[^a-z]", "", (t or "").lower()).translate(CODE).upper() for i, t in rows}


def walk(seq, code):
    out = []
    for kind, wanted in (("start", codons.starts(code)), ("stop", codons.stops(code))):
        p = 0
        while p + 3 <= len(seq):
            hit = seq[p : p + 3] in wanted
            if hit:
                out.append((p + 1, kind, p % 3))
            p += 3 if hit else 1
    return out


def test_codons_and_orfs(spark, made):
    at, seqs = made
    assert sorted(tuple(r) for r in catalog.codon_scan(spark, at).collect()) == sorted((c, *h) for c, s in seqs.items() for h in walk(s, 11))
    want = {}
    for c, s in seqs.items():
        hits = sorted(walk(s, 1))
        spans = [(next((q for q, k, f in hits if k == "stop" and f == frame and q > p), 0) - p) for p, kind, frame in hits if kind == "start"]
        if max(spans, default=0) > max(60, len(s) / 10):
            want[c] = max(spans)
    got = {r.id: r.orflen for r in catalog.longest_orf(spark, at).collect()}
    assert got == want and want


def test_exons(spark, made):
    at, seqs = made
    comp = str.maketrans("ACGT", "TGCA")
    exons = {c: [(200 * t + a, min(200 * t + b, len(s))) for t in range(len(s) // 200 + 1) for a, b in ((4, 60), (71, 130), (141, 197)) if 200 * t + a <= len(s)] for c, s in seqs.items()}
    want = {}
    for c, s in seqs.items():
        if exons[c]:
            w = "".join(s[a - 1 : b] for a, b in exons[c])
            want["t" + c] = w[::-1].translate(comp) if int(c[-1]) % 2 else w
    assert {r.id: r.seq for r in catalog.spliced_sequence(spark, at).collect()} == want
    table = codons.table(1)
    assert {r.id: r.protein for r in catalog.translate_cds(spark, at).collect()} == {i: "".join(table[w[p : p + 3]] for p in range(0, len(w) - 2, 3)) for i, w in want.items()}
    got = sorted((r.parent_id, r.start, r.stop) for r in catalog.orf_to_genome(spark, at).collect())
    placed = []
    for c, e in exons.items():
        for k, (a, b) in enumerate(e):
            a += int(c[-1]) % 2 and not k  # the ORF loses its last base on the minus strand
            if a <= b:
                placed.append(("t" + c, a, b))
    assert got == sorted(placed)


def test_contigs_and_junctions(spark, made):
    at, seqs = made
    rows = [tuple(r) for r in catalog.contig_sort(spark, at).collect() if r.seq is not None]
    assert rows == sorted(((c, s, len(s)) for c, s in seqs.items() if c != "d7"), key=lambda x: (-x[2], x[0]))
    total = sum(map(len, seqs.values()))
    assert tuple(catalog.genome_split_size(spark, at).first()) == (total, total // 16)
    motifs = {1: "GT-AG", 2: "CT-AC", 3: "GC-AG", 4: "CT-GC", 5: "AT-AC", 6: "GT-AT"}
    want, far = Counter(), 0
    for r in catalog._junctions(spark, at).collect():
        s = seqs[r.chrom]
        inside = r.chrom != "d7" and r.intron_end <= len(s)
        far += inside and r.intron_start > 600
        want[motifs.get(r.motif) or (f"{s[r.intron_start - 1 : r.intron_start + 1]}-{s[max(r.intron_end - 2, 0) : r.intron_end]}" if inside else "unknown")] += 1
    assert far and {r.type: r["count"] for r in catalog.splice_tally(spark, at).collect()} == want
    allowed = catalog.splice_filter(spark, at).collect()
    assert {r.code for r in allowed} >= {"ctac", "ctgc", "atac", "gtat"}


def test_nonoverlapping_genes_takes_all(spark):
    at = "/root/testdata/sf0.001"
    genes, pred = catalog._genes(spark, at).collect(), catalog._pred(spark, at).collect()
    want = {g.id for g in genes if not any(g.chrom == p.chrom and g.strand == p.strand and g.start <= p.end and p.start <= g.end for p in pred)}
    got = {r.id for r in catalog.nonoverlapping_genes(spark, at).collect()}
    assert got == want and any(int(i[1:]) % 2 for i in got) and any(int(i[1:]) % 2 == 0 for i in got)


def test_tiles(spark):
    """Parts and junctions that lie across tiles give the same as with one tile."""
    r = random.Random(3)
    seqs = {c: "".join(r.choice("ACGTn") for _ in range(n)) for c, n in (("a", 1000), ("b", 97), ("c", 0))}
    contigs = spark.createDataFrame(list(seqs.items()), "chrom string, seq string")
    parts = [(r.choice("abx"), r.choice("+-"), s, s + r.randint(0, 60), f"t{k % 40}") for k in range(300) for s in (r.randint(1, 1000),)]
    parts = [(c, s, a, b, f"{p}{c}{s}") for c, s, a, b, p in parts]
    rows = spark.createDataFrame(parts + parts[:5], "chrom string, strand string, start long, end long, parent_id string")
    one, many = (sorted(map(tuple, orf.spliced(rows, contigs, tile=t).collect())) for t in (5000, 16))
    want = {}
    for c, s, a, b, p in sorted(parts + parts[:5], key=lambda x: (x[2], x[3])):
        if seqs.get(c) and a <= len(seqs[c]):
            want.setdefault((p, c, s), []).append(seqs[c][a - 1 : b])
    comp = str.maketrans("ACGTn", "TGCAn")
    assert {(x[0], x[1], x[3]): x[4] for x in many} == {k: "".join(v)[::-1].translate(comp) if k[2] == "-" else "".join(v) for k, v in want.items()}
    assert [(x[0], x[4]) for x in one] == [(x[0], x[4]) for x in many]
    cuts = [(r.choice("abcx"), a, a + r.randint(1, 300), r.randint(0, 2), 1) for _ in range(400) for a in (r.randint(1, 900),)]
    junctions = spark.createDataFrame(cuts, "chrom string, intron_start long, intron_end long, motif int, unique long")
    got = {x.type: x["count"] for x in splice.tally(junctions, contigs, tile=16).collect()}
    name = lambda c, a, b, m: {1: "GT-AG", 2: "CT-AC"}.get(m) or (f"{seqs[c][a - 1 : a + 1]}-{seqs[c][b - 2 : b]}".upper() if c in seqs and b <= len(seqs[c]) else "unknown")
    assert got == Counter(name(*x[:4]) for x in cuts)


def test_long_sequence(spark):
    """A sequence of a million bases takes seconds."""
    r = random.Random(4)
    seq = "".join(r.choices("ACGT", k=1_000_000))
    began = time.time()
    hits = orf.codon_hits(spark.createDataFrame([("x", seq, "+")], "id string, seq string, strand string"), 1).count()
    assert time.time() - began < 60 and hits == len(walk(seq, 1))
