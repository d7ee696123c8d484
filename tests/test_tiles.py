"""Contigs in tiles: FASTA read by lines, codon scans over tile ends, next stops over blocks; against whole sequences."""

import random
import re

import pytest
from pyspark.sql import functions as F

from genespark.functions import codons
from genespark.operators import orf, splice
from genespark.operators.tiles import entering, tiled
from genespark.sources import sequences


@pytest.fixture()
def small_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "1024", "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def plain_tiles(records, size, over):
    return sorted((h, len(s), t, s[t * size : t * size + size + over]) for h, s in records for t in range(max(1, -(-len(s) // size))))


@pytest.mark.parametrize(("size", "over", "end"), [(7, 2, "\n"), (64, 1, "\r\n"), (5000, 0, "\n")])
def test_fasta_in_splits(spark, tmp_path, small_splits, size, over, end):
    r = random.Random(size)
    records = [(f"s{k} of {n}", "".join(r.choice("ACGTacgtN") for _ in range(n))) for k, n in enumerate([3000, 0, 1, 64, 0, 7000, 128, 63, 2, 0])]
    lines = ["no record yet"]
    for h, s in records:
        width = r.choice([1, 13, 60, 4000])
        lines += [">" + h + " ", *(s[i : i + width] for i in range(0, len(s), width)), *[""] * r.choice([0, 2])]
    (tmp_path / "a.fa").write_bytes((end.join(lines) + end).encode())
    got = sequences.read_tiles(spark, str(tmp_path / "a.fa"), size, over)
    assert spark.read.text(str(tmp_path / "a.fa")).rdd.getNumPartitions() > 8
    rows = got.collect()
    assert sorted((v.header, v.n, v.tile, v.piece) for v in rows) == plain_tiles(records, size, over)
    assert {v.header: v.chrom for v in rows} == {h: h.split()[0] for h, _ in records}
    assert max(len(v.piece) for v in rows) <= size + over
    whole = spark.createDataFrame([(h, s) for h, s in records], "chrom string, seq string")
    assert sorted((v.chrom, v.n, v.tile, v.piece) for v in tiled(whole, size, over).collect()) == plain_tiles(records, size, over)


def test_equal_headers_and_empty_file(spark, tmp_path, small_splits):
    (tmp_path / "a.fa").write_text(">x\nAC\n>x\nGGT\n>\nT\n")
    assert sorted((v.record, v.header, v.n, v.piece) for v in sequences.read_tiles(spark, str(tmp_path / "a.fa"), 10, 1).collect()) == [(1, "x", 2, "AC"), (2, "x", 3, "GGT"), (3, "", 1, "T")]
    (tmp_path / "b.fa").write_text("")
    assert sequences.read_tiles(spark, str(tmp_path / "b.fa")).count() == 0


def plain_hits(seq, code):
    up = seq.upper()
    return sorted((m.start() + 1, k, m.start() % 3) for k, wanted in (("start", codons.starts(code)), ("stop", codons.stops(code))) for m in re.finditer("|".join(wanted), up))


@pytest.mark.parametrize("tile", [4, 5, 64, 65_536])
def test_codon_scan_over_tile_ends(spark, tile):
    r = random.Random(tile)
    seqs = {"r": "".join(r.choice("ACGT") for _ in range(3000)), "p": "ATG" * 300, "q": "C" + "TTGTTG" * 50 + "TAATAA" * 40, "z": "TTATTATTGATGATAG" * 70, "n": "ACG#TNatgtaa", "e": "", "s": "AT", "t": "TTG", "x": None}
    df = spark.createDataFrame([(k, s, "+") for k, s in seqs.items()], "id string, seq string, strand string")
    for code in (1, 11):
        got = {}
        for v in orf.codon_hits(df, code, tile).collect():
            got.setdefault(v.id, []).append((v.pos, v.codon, v.frame))
            assert v.seqlen == len(seqs[v.id]) and v.strand == "+"
        assert {k: sorted(v) for k, v in got.items()} == {k: h for k, s in seqs.items() if s and (h := plain_hits(s, code))}


def test_scan_of_tiles_from_a_file(spark, tmp_path, small_splits):
    r = random.Random(3)
    seq = "".join(r.choice("ACGT") for _ in range(9000))
    (tmp_path / "a.fa").write_text(">c\n" + "\n".join(seq[i : i + 70] for i in range(0, 9000, 70)) + "\n")
    tiles = sequences.read_tiles(spark, str(tmp_path / "a.fa"), 512, 2).withColumn("id", F.col("chrom")).withColumn("strand", F.lit("+"))
    assert sorted((v.pos, v.codon, v.frame) for v in orf.codon_hits(tiles, 1, 512).collect()) == plain_hits(seq, 1)
    junctions = spark.createDataFrame([("c", a, b, 0, 1) for a, b in [(1, 9), (512, 1024), (511, 513), (100, 9000), (5, 9001)]], "chrom string, intron_start long, intron_end long, motif int, unique int")
    whole = spark.createDataFrame([("c", seq)], "chrom string, seq string")
    assert sorted(map(tuple, splice.tally(junctions, tiles, 512).collect())) == sorted(map(tuple, splice.tally(junctions, whole).collect()))


def test_next_stop_over_blocks(spark):
    r = random.Random(4)
    rows = [(i, 900, p, "+", r.choice(["start", "start", "stop"]), (p - 1) % 3) for i in ("a", "b", None) for p in r.sample(range(1, 900), 120)]
    hits = spark.createDataFrame(rows, "id string, seqlen int, pos int, strand string, codon string, frame int")
    want = sorted(map(repr, orf.longest_orfs(hits, 5, 0.0, 1 << 20).collect()))
    assert want and all(sorted(map(repr, orf.longest_orfs(hits, 5, 0.0, b).collect())) == want for b in (3, 40))


@pytest.mark.parametrize("block", [1, 3, 1000])
def test_entering(spark, block):
    r = random.Random(block)
    steps = {k: [[r.randrange(3) for _ in range(3)] for _ in range(n)] for k, n in (("a", 40), ("b", 1), ("c", 7))}
    df = spark.createDataFrame([(k, i, s) for k, v in steps.items() for i, s in enumerate(v)], "k string, i long, s array<int>")
    want = {}
    for k, v in steps.items():
        now = 0
        for i, s in enumerate(v):
            want[k, i] = now
            now = s[now]
    assert {(v.k, v.i): v.state for v in entering(df, ["k"], "i", F.col("s"), 3, block).collect()} == want
