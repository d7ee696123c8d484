"""Overlaps of mixed lengths, stored features, medians, limits, long lists of domain hits; against plain Python."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from genespark.operators import checks, functional, intervals, selection
from genespark.sources import gff, store

SPAN = "chrom string, strand string, start long, end long, id string, type string"


def mixed(r, n, tag):
    """Features of 50 bases to 5 megabases."""
    out = []
    for i in range(n):
        size = r.choice([50, 200, 900, 1500, 9000, 70_000, 900_000, 5_000_000]) + r.randrange(40)
        start = r.randrange(1, 6_000_000)
        out.append((r.choice(["c1", "c2"]), r.choice("+-"), start, start + size, f"{tag}{i}", r.choice(["gene", "mRNA"])))
    return out


def pairs(x, y):
    return {(a[4], b[4], min(a[3], b[3]) - max(a[2], b[2]) + 1) for a in x for b in y if a[:2] == b[:2] and a[2] <= b[3] and b[2] <= a[3]}


@pytest.mark.parametrize(("width", "copies"), [(500, 4), (2000, 1), (64, 2)])
def test_mixed_lengths(spark, width, copies):
    r = random.Random(width)
    x, y = mixed(r, 150, "x"), mixed(r, 150, "y")
    left, right = spark.createDataFrame(x, SPAN), spark.createDataFrame(y, SPAN)
    rows = intervals.interval_join(left, right, width=width, copies=copies).collect()
    assert len(rows) == len(pairs(x, y)) and {(v.l_id, v.r_id, v.bp) for v in rows} == pairs(x, y)
    levels = intervals.levels_of(left, right, width=width, copies=copies)
    assert all(len(v) > 3 for v in levels)
    most = intervals._binned(left, levels[1], ["chrom"], "l_", "start", "end", width, copies, False).groupBy("l_id").count().agg(F.max("count")).first()[0]
    assert most <= (copies + 1) + 2 * len(levels[1]) < 5_000_000 / width


def test_stored_features_are_joined_in_place(spark):
    r = random.Random(9)
    x, y = mixed(r, 120, "x"), mixed(r, 120, "y")
    for name, rows in (("left_features", x), ("right_features", y)):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        store.store(spark.createDataFrame(rows, SPAN), name, buckets=4, top=4)
    out = store.overlapping(spark, "left_features", "right_features")
    assert {(v.l_id, v.r_id, v.bp) for v in out.collect()} == pairs(x, y) and out.count() == len(pairs(x, y))
    genes = store.overlapping(spark, "left_features", "right_features", (("gene",), ("gene",)))
    plan = genes._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "PartitionFilters: [isnotnull(type" in plan
    assert {(v.l_id, v.r_id) for v in genes.collect()} == {p[:2] for p in pairs([a for a in x if a[5] == "gene"], [b for b in y if b[5] == "gene"])}
    assert sorted(v.id for v in store.stored(spark, "left_features", "gene").collect()) == sorted(a[4] for a in x if a[5] == "gene")
    for name in ("left_features", "right_features"):
        spark.sql(f"DROP TABLE {name}")


@pytest.mark.parametrize("cells", [3, 1024])
def test_medians(spark, cells):
    r = random.Random(cells)
    rows = [(k, r.choice([1.5, -2.0, 1e300, -1e300, 5e-324, 0.0, r.random()]), r.randrange(-5, 5), None) for k in ("a", "a", "b", None) for _ in range(101)] + [("one", 7.0, 3, None), ("none", None, None, None)]
    df = spark.createDataFrame(rows, "k string, x double, y long, z double")
    got = {v.k: (v.x, v.y, v.z) for v in selection.medians(df, ["k"], {c: F.col(c) for c in "xyz"}, cells).collect()}
    middle = lambda values: None if not values else sorted(values)[(len(values) - 1) // 2] * 0.5 + sorted(values)[len(values) // 2] * 0.5
    assert got == {k: tuple(middle([v[c] for v in rows if v[0] == k and v[c] is not None]) for c in (1, 2, 3)) for k in {v[0] for v in rows}}
    assert statistics.median([1, 2]) == 1.5 and selection.medians(df.where("false"), ["k"], {"x": F.col("x")}).count() == 0


def test_limits_seen_while_writing(spark, tmp_path):
    lines = spark.range(0, 1500).select(F.concat(F.lit(">p"), F.col("id").cast("string")).alias("value"))
    good = checks.write_observed(lines, str(tmp_path / "a"), [checks.TEST_DATA["proteins"]()], "text")
    assert good.first().asDict() == {"name": "proteins", "found": 1500.0, "above": 1000.0, "ok": True} and spark.read.text(str(tmp_path / "a")).count() == 1500
    checks.require(good)
    bad = checks.write_observed(lines.limit(7), str(tmp_path / "b"), [f() for f in checks.TEST_DATA.values()], "text")
    assert {(v.name, v.ok) for v in bad.collect()} == {("genome", False), ("proteins", False), ("reference", False)}
    with pytest.raises(ValueError, match="proteins"):
        checks.require(bad)
    none = checks.write_observed(lines.where("false"), str(tmp_path / "c"), [checks.TEST_DATA["genome"]()], "text")
    assert none.first().found == 0 and checks.write_observed(lines, str(tmp_path / "d"), []).count() == 0
    names = spark.createDataFrame([("SRR1_1.fastq.gz",), ("SRR1_2.fastq.gz",), ("SRR2_1.fastq.gz",), ("x_2.fastq.gz",)], "name string")
    assert tuple(checks.read_pairs(names, 1).first()) == (2, 1, True) and not checks.read_pairs(names, 2).first().ok


def test_many_domain_hits_of_one_query(spark):
    """10^5 hits of one query, and queries that end and begin within a batch."""
    r = random.Random(7)
    hits = [("big", k, "h", s, s + r.randrange(3)) for k, s in enumerate(sorted(r.randrange(1, 400_000) for _ in range(100_000)))]
    hits += [(q, k, "h", r.randrange(50), r.randrange(50, 90)) for q in ("a", "b", None) for k in range(30)] + [("a", 99, "h", None, 5)]
    want, end, now = [], None, ()
    for q, k, _, s, e in sorted((h for h in hits if h[3] is not None), key=lambda h: (h[0] is not None, h[0] or "", h[1])):
        if (q,) != now or s > end:
            want.append((q, k))
            now, end = (q,), e
    df = spark.createDataFrame(hits, "query_id string, hit_rank int, hit_id string, dom_start int, dom_end int")
    assert sorted((repr((v.query_id, v.hit_rank)) for v in functional.domain_hits(df).collect())) == sorted(map(repr, want))


def test_heads_of_files(spark):
    rows = [(f, i, i if (f, i) != ("b", 3) else None, 9, {"ID": ["x"]} if (f, i) != ("b", 20) else {}) for f in "ab" for i in range(25)]
    df = spark.createDataFrame(rows, "file string, line_no long, start long, end long, attributes map<string,array<string>>")
    assert {tuple(v) for v in gff.head_facts(df).collect()} == {("a", 25, 0), ("b", 25, 1)}
    gff.check(df.where("file = 'a'"))
    with pytest.raises(ValueError):
        gff.check(df)
