"""What several branches of a query read is made once."""

import re

from pyspark.sql import functions as F
import pytest

from genespark.operators import concordance, orf
from genespark.plans import catalog, structures
from genespark.sources import gff, sequences, store

DATA = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["supported_models", "patched_models", "nonoverlapping_models", "drop_cdsless", "descendants", "merged_features"])
def test_lines_are_numbered_once(spark, name):
    """All readers take the stored numbers; before, each moved and sorted all lines again."""
    assert "lineitem.parquet" not in plan({**catalog.QUERIES, **structures.QUERIES}[name](spark, DATA))


def test_merge_moves_rows_once(spark):
    rows = spark.createDataFrame([(1, "a", 5, {"ID": ["a"], "x": ["2", "1"]}), (2, "a", 5, {"x": ["3", None], "y": []}), (3, "a", None, {}), (4, None, 5, {"x": ["b", "a"]}), (5, None, 5, {}), (6, "b", 5, {"x": ["b", "a"]})], "line_no long, id string, start long, attributes map<string,array<string>>")
    out = gff.merge_same(rows)
    assert plan(out).count("Exchange hashpartitioning") == 1
    got = sorted(((v.line_no, v.id, v.attributes) for v in out.collect()))
    assert got == [(1, "a", {"ID": ["a"], "x": ["1", "2", "3"], "y": []}), (3, "a_1", {}), (4, None, {"x": ["b", "a"]}), (5, None, {}), (6, "b", {"x": ["b", "a"]})]


def test_supported_joins_sources_once(spark):
    """Sources agree in pairs as concordant_genes() says, inner ends within three bases; one join serves all pairs."""
    def source(*shifts):
        rows = [("c", "+", 1000 * g + 100 * k + 10 + (s if k else 0), 1000 * g + 100 * k + 60 + s, f"g{g}.m", f"g{g}", k) for g, s in enumerate(shifts) if s is not None for k in range(3)]
        cds = spark.createDataFrame([(c, t, a, b, f"{m}.{k}", m) for c, t, a, b, m, _, k in rows], "chrom string, strand string, start long, end long, id string, parent_id string")
        span = cds.groupBy("chrom", "strand", "parent_id").agg(F.min("start").alias("start"), F.max("end").alias("end"))
        mrnas = span.select("chrom", "strand", "start", "end", F.col("parent_id").alias("id"), F.substring_index("parent_id", ".", 1).alias("parent_id"))
        return mrnas.select("chrom", "strand", "start", "end", F.col("parent_id").alias("id")), mrnas, cds

    models = [source(0, 0, 0, None, 0), source(3, 4, 9, 0, None), source(6, 4, 2, 3, None)]
    out = concordance.supported(models)
    want = {}
    for prio, (i, j) in enumerate([(0, 1), (0, 2), (2, 1)]):
        for x in concordance.concordant_genes(models[i][1:], models[j][1:]).collect():
            want.setdefault(x.gene_id, prio)
    assert {x.id: x.prio for x in out.collect()} == want == {"g0": 0, "g1": 2, "g2": 1, "g3": 2}
    assert "parts" not in plan(out)


@pytest.mark.parametrize("name", ["spliced_sequence", "translate_cds", "codon_scan", "longest_orf", "transcript_orfs"])
def test_contigs_are_made_once(spark, name):
    """Contigs, or tiles of them, are stored; before, each reader made them from the texts again."""
    assert "documents.parquet" not in plan(catalog.QUERIES[name](spark, DATA))


def test_parts_of_tiles_with_other_letters(spark):
    """Parts are found by bytes only in tiles that have one a letter."""
    seq = "ACGT" * 5 + "éN" + "GATTACA" * 6
    contigs = spark.createDataFrame([("c", seq), ("d", seq.replace("é", "A"))], "chrom string, seq string")
    spans = [(1, 3), (19, 24), (22, 40), (41, 90)]
    parts = spark.createDataFrame([(c, "+", a, b, c) for c in "cd" for a, b in spans], "chrom string, strand string, start long, end long, parent_id string")
    got = {r.id: r.seq for r in orf.spliced(parts, contigs, tile=16).collect()}
    assert got == {c: "".join(s[a - 1 : b] for a, b in spans) for c, s in (("c", seq), ("d", seq.replace("é", "A")))}


def test_records_are_made_once(spark):
    """Means, medians and their keys read stored records; before, each classified all genes again."""
    assert "p_start" not in plan(catalog.QUERIES["gene_stats"](spark, DATA))


def test_buckets_grow(spark):
    assert [store.buckets_for(n, 8) for n in (0, 1_600_000, 1_600_001, 10**9)] == [8, 8, 16, 8192]


def test_fasta_lines_are_not_sorted(spark, tmp_path):
    """Letters are moved into tiles only; before, all lines were sorted by split first."""
    texts = {"a.fa": ">x one\nACGTA\nCG\n>y\n>z\nAAAéA\nCC\n\n", "b.fa": "lost\n>w\nGGG\n"}
    for name, text in texts.items():
        (tmp_path / name).write_text(text)
    out = sequences.read_tiles(spark, str(tmp_path), 4, 1)
    assert not re.search(r"\[file#\d+, split_#\d+L\]", "".join(x for x in plan(out).splitlines(True) if "Window" in x))
    got = sorted((r.file[-4:], r.record, r.header, r.chrom, r.n, r.tile, r.piece) for r in out.collect())
    assert got == [("a.fa", 1, "x one", "x", 7, 0, "ACGTA"), ("a.fa", 1, "x one", "x", 7, 1, "ACG"), ("a.fa", 2, "y", "y", 0, 0, ""), ("a.fa", 3, "z", "z", 7, 0, "AAAéA"), ("a.fa", 3, "z", "z", 7, 1, "ACC"), ("b.fa", 1, "w", "w", 3, 0, "GGG")]
