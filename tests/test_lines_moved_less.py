"""What files and releases write and move besides their lines."""

import glob

from pyspark.sql import functions as F

from genespark.operators import graph, submission
from genespark.operators.lineage import cut
from genespark.plans import formats
from genespark.sources import gff

HEAD = "c1\tt\t{}\t1\t99\t.\t+\t.\tID={}{}\n"


def read(spark, tmp_path, *rows):
    (tmp_path / "in.gff3").write_text("".join(HEAD.format(kind, i, f";Parent={p}" if p else "") for kind, i, p in rows))
    return gff.features(gff.lines(spark, str(tmp_path / "in.gff3")))


def ids(lines):
    return [v.value.split("\t")[8].split(";")[0][3:] for v in lines.collect() if "\t" in v.value]


def merged(lines):
    return "first(value" in lines._jdf.queryExecution().optimizedPlan().toString()


MODEL = [("gene", "g", ""), ("mRNA", "a", "g"), ("mRNA", "b", "g"), ("CDS", "x", "a,b"), ("part", "k", "x")]


def test_shared_parts_are_not_moved_again(spark, tmp_path):
    """Lines of parts with several mRNAs are told apart by moving them only where one could be written twice below an mRNA."""
    out = gff.hierarchical_text(read(spark, tmp_path, *MODEL))
    assert ids(out) == ["g", "a", "x", "b", "x"] and not merged(out)
    out = gff.hierarchical_text(read(spark, tmp_path, *MODEL, ("block", "m", "a"), ("exon", "e", "a,m")))
    assert ids(out) == ["g", "a", "e", "x", "b", "x"] and merged(out)
    out = gff.hierarchical_text(read(spark, tmp_path, *MODEL, ("mRNA", "a", "g")))
    assert sorted(ids(out)) == ["a", "a", "b", "g", "x", "x"] and merged(out)


def test_a_release_stores_its_lines_once(spark, tmp_path, monkeypatch):
    stored = []
    for module in (graph, gff, submission):
        monkeypatch.setattr(module, "cut", lambda df: stored.append(df.columns) or cut(df))
    lines, report = submission.release(read(spark, tmp_path, *MODEL, ("mRNA", "bare", "g"), ("gene", "h", ""), ("CDS", "lost", "bare2")))
    assert ids(lines) == ["g", "a", "x", "b", "x"] and (report.first().mrnas, report.first().genes) == (1, 1)
    assert len([c for c in stored if "value" in c]) == 1


def test_what_is_read_back_is_packed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(formats, "fresh_path", lambda _: str(tmp_path / "t"))
    rows = formats._read_gff(spark, "", spark.range(5).select(F.col("id").cast("string").alias("value")))
    assert sorted(r.value for r in rows.collect()) == list("01234")
    files = glob.glob(str(tmp_path / "t" / "part-*"))
    assert files and all(f.endswith(".gz") for f in files)
    assert cut(spark.range(3)).inputFiles()[0].endswith(".zstd.parquet")


def test_two_levels_are_stored_once(spark, tmp_path, monkeypatch):
    """Where no parent has a grandparent, pairs of parents are not moved again to look for what is above."""
    stored = []
    monkeypatch.setattr(graph, "cut", lambda df: stored.append(df._jdf.queryExecution().optimizedPlan().toString()) or cut(df))
    pairs = graph.reach(read(spark, tmp_path, *MODEL[:4]))
    assert sorted((v.id, v.ancestor, v.depth) for v in pairs.collect()) == [("a", "a", 0), ("a", "g", 1), ("b", "b", 0), ("b", "g", 1), ("g", "g", 0)]
    assert not any("min(depth" in p for p in stored)
