"""Ids that repeat over files: merged, replaced, numbered; against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from genespark.operators import evidence
from genespark.sources import gff


def load(spark, tmp_path, *texts):
    for i, t in enumerate(texts):
        (tmp_path / f"{i}.gff3").write_text("\n".join("\t".join(["c1", "lab", *r[:1], str(r[1]), str(r[2]), ".", "+", ".", r[3]]) for r in t))
    return gff.features(gff.lines(spark, [str(tmp_path / f"{i}.gff3") for i in range(len(texts))]))


def test_merge(spark, tmp_path):
    rows = load(spark, tmp_path, [("gene", 1, 9, "ID=g;Note=b,a;Name=n"), ("CDS", 1, 5, "ID=c;Parent=m"), ("CDS", 1, 5, "Parent=m"), ("CDS", 1, 5, "Parent=m"), ("exon", 1, 1, "ID=e")], [("gene", 1, 9, "ID=g;Alias=z;Note=a,c"), ("CDS", 1, 5, "ID=c;Parent=k,m"), ("CDS", 1, 6, "ID=c;Parent=q"), ("CDS", 1, 6, "ID=c;Parent=r"), ("CDS", 1, 7, "ID=c")])
    merged = gff.combined(rows, "merge", ("file", "line_no")).withColumn("entries", F.map_entries("attributes"))
    got = {(v.id, v.end): ([tuple(x) for x in v.entries], v.parents, v.parent_id) for v in merged.collect() if v.id}
    assert got == {
        ("g", 9): ([("ID", ["g"]), ("Name", ["n"]), ("Alias", ["z"]), ("Note", ["a", "b", "c"])], None, None),
        ("c", 5): ([("ID", ["c"]), ("Parent", ["k", "m"])], ["k", "m"], "k"),
        ("c_1", 6): ([("ID", ["c"]), ("Parent", ["q", "r"])], ["q", "r"], "q"),
        ("c_2", 7): ([("ID", ["c"])], None, None),
        ("e", 1): ([("ID", ["e"])], None, None),
    }
    assert gff.combined(rows, "merge", ("file", "line_no")).where("id is null").count() == 2
    assert {(v.id, v.end) for v in gff.combined(rows, "replace", ("file", "line_no")).collect() if v.id} == {("g", 9), ("c", 7), ("e", 1)}
    assert {v.id for v in gff.combined(rows, order=("file", "line_no")).collect() if v.id} == {"g", "g_1", "c", "c_1", "c_2", "c_3", "c_4", "e"}
    with pytest.raises(ValueError):
        gff.combined(rows, "other")
    assert gff.combined(rows.where("false"), "merge").count() == 0


def test_merge_against_plain(spark):
    r = random.Random(6)
    rows = [(i, f"i{r.randrange(40)}" if r.random() < 0.9 else None, r.choice([1, 1, 2, None]), {k: [r.choice("abc") for _ in range(r.randrange(3))] for k in r.sample(["Note", "ID", "x"], r.randrange(3))}) for i in range(400)]
    df = spark.createDataFrame(rows, "line_no long, id string, start long, attributes map<string,array<string>>")
    groups: dict = {}
    for n, i, s, at in rows:
        if i is not None:
            own = groups.setdefault(i, {}).setdefault(s, (n, {}))[1]
            for k, v in at.items():
                own.setdefault(k, set()).update(v)
    want = {(f"{i}_{k}" if k else i, s, n): {a: sorted(v) for a, v in own.items()} for i, by in groups.items() for k, (s, (n, own)) in enumerate(sorted(by.items(), key=lambda x: x[1][0]))}
    single = {i for i in groups if sum(x[1] == i for x in rows) == 1}
    got = {(v.id, v.start, v.line_no): v.attributes if v.id not in single else {a: sorted(set(x)) for a, x in v.attributes.items()} for v in gff.merge_same(df).collect() if v.id}
    assert got == want
    last = {}
    for n, i, s, at in rows:
        if i is not None:
            last[i] = (n, s)
    assert {v.id: (v.line_no, v.start) for v in gff.keep_last(df).collect() if v.id} == last


def test_patch_models(spark, tmp_path):
    consensus = load(spark, tmp_path, [("gene", 1, 90, "ID=g"), ("mRNA", 1, 90, "ID=m;Parent=g"), ("CDS", 1, 90, "ID=c;Parent=m")])
    (tmp_path / "more").mkdir()
    orfs = load(spark, tmp_path / "more", [("gene", 200, 300, "ID=g"), ("mRNA", 200, 300, "ID=n;Parent=g"), ("mRNA", 200, 290, "ID=o;Parent=g"), ("CDS", 200, 250, "ID=d;Parent=n,o"), ("gene", 400, 500, "ID=bare"), ("gene", 50, 60, "ID=in"), ("CDS", 50, 60, "ID=z;Parent=in")])
    got = sorted((v.id, v.start) for v in evidence.patch_models(consensus, orfs).collect())
    assert got == [("c", 1), ("d", 200), ("g", 1), ("g_1", 200), ("m", 1), ("n", 200), ("o", 200)]
