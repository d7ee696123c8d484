"""GFF3 files read in splits, attributes as written, genetic codes."""

import pytest
from pyspark.sql import functions as F

from genespark.functions import codons
from genespark.functions.columns import bar, fixed, percent
from genespark.sources import gff


def test_lines_in_splits(spark, tmp_path):
    """Numbers run through a file whatever its splits; '##FASTA' ends it; a blank line counts."""
    texts = {"a": [f"c{i}\tx\tgene\t{i}\t{i + 5}\t.\t+\t.\tID=a{i}" for i in range(1, 400)] + ["", "##FASTA", ">s", "ACGT"], "b": ["# one", "two"] * 150, "c": ["only"]}
    for k, v in texts.items():
        (tmp_path / f"{k}.gff3").write_text("\n".join(v) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        rows = gff.lines(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    for k, v in texts.items():
        got = sorted((r.line_no, r.value) for r in rows if r.file.endswith(f"{k}.gff3"))
        assert got == list(enumerate(v[: v.index("##FASTA")] if "##FASTA" in v else v))
    (tmp_path / "empty").mkdir()
    (tmp_path / "empty/e.gff3").write_text("")
    assert gff.lines(spark, str(tmp_path / "empty")).collect() == []


def test_attributes_as_written(spark, tmp_path):
    """A stray '%' is kept; comparison reads ids raw, and the first parent."""
    (tmp_path / "x.gff3").write_text("c\ts\tgene\t1\t9\t.\t+\t.\tID=a%20b;Note=50% identity,x%2Cy\nc\ts\tmRNA\t1\t9\t.\t+\t.\tParent=a%20b,z;ID=m\nc\ts\tCDS\t1\t9\t.\t+\t0\tNote=none\nbad\n")
    raw = gff.lines(spark, str(tmp_path / "x.gff3"))
    first = gff.features(raw).orderBy("line_no").first()
    assert first.id == "a b" and first.attributes["Note"] == ["50% identity", "x,y"]
    assert [(r.id, r.parent_id) for r in gff.models(raw).orderBy("line_no").collect()] == [("a%20b", None), ("m", "a%20b")]


def test_repeated_ids(spark):
    rows = spark.createDataFrame([(0, "a"), (1, None), (2, "a"), (3, None), (4, "b"), (5, "a")], "line_no long, id string")
    assert [r.id for r in gff.unique_ids(rows).orderBy("line_no").collect()] == ["a", None, "a_1", None, "b", "a_2"]


def test_codes():
    for code in (9, 13, 14, 15, 16, 21, 22, 23, 24, 25, 27, 28, 29, 30, 31, 32, 33):
        assert len(codons.table(code)) == 64 and codons.stops(code) and "ATG" in codons.starts(code)
    assert codons.stops(6) == ["TGA"] and codons.stops(22) == ["TAA", "TCA", "TGA"] and codons.stops(28) == ["TAA", "TAG", "TGA"]
    assert codons.code_of("12") == 12 and codons.assembler_flag(6) == ["--GENETIC_CODE", "Tetrahymena"] and codons.assembler_flag(1) == codons.assembler_flag(9) == []
    assert codons.predictor_flag(26) == ["--gcode=26"] and codons.predictor_flag(1) == codons.predictor_flag(10) == []
    for bad in ("x", None, 7, 99):
        with pytest.raises(ValueError):
            codons.code_of(bad)


def test_six_places_are_those_of_the_exact_binary_value(spark):
    values = [p / q for q in (1, 3, 128, 384, 640, 896, 1000) for p in range(0, q + 1, 1 if q < 400 else 7)] + [-1 / 128, 123456.0000005, 0.9999995, 0.0000005]
    rows = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double").select("v", fixed(F.col("v")).alias("t")).collect()
    assert [r.t for r in rows] == [None if r.v is None else f"{r.v:.6f}" for r in rows]
    shares = spark.createDataFrame([(k / 800,) for k in range(801)], "v double").select("v", percent(F.col("v")).alias("p"), bar(F.col("v")).alias("b")).collect()
    assert all(r.p == f"{r.v * 100:.1f}%" and r.b == "[" + ("#" * int(r.v * 20)).ljust(20, ".") + "]" for r in shares)


def test_lines_of_parts(spark, tmp_path):
    """Parts that Spark has written are one text: numbers run through all, '##FASTA' in one ends those after it. No line is moved."""
    texts = [f"l{i}" for i in range(500)]
    rows = spark.createDataFrame([(i, v) for i, v in enumerate([*texts, "##FASTA", ">s", "ACGT"])], "k int, value string")
    rows.repartitionByRange(7, "k").sortWithinPartitions("k").select("value").write.text(str(tmp_path / "t"))
    old = {c: spark.conf.get(c) for c in ("spark.sql.files.maxPartitionBytes", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = gff.lines(spark, str(tmp_path / "t"), parts=True)
        assert sorted((r.line_no, r.value) for r in out.collect()) == list(enumerate(texts))
        assert "SortMergeJoin" not in gff.lines(spark, str(tmp_path / "t"))._jdf.queryExecution().executedPlan().toString()
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)
