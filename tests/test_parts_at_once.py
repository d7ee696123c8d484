"""Sub-features of many pairs of parents are matched at once, as one pair after another would be."""

import random

import pytest
from pyspark.sql import functions as F

from genespark.operators import compare

LINE = "chrom string, strand string, start long, end long, id string, parent_id string"


def alone(ref, pred, times):
    """(classification, ref_id, pred_id, bp) of one pair of parents, through best_assignment."""
    over = {(a, b): min(a[3], b[3]) - max(a[2], b[2]) + 1 for a in set(ref) for b in set(pred) if None not in a[:4] + b[:4] and a[:2] == b[:2] and a[2] <= b[3] and b[2] <= a[3] and min(a[3], b[3]) >= max(a[2], b[2])}
    left, right = (sorted({x[k] for x in over}, key=lambda x: (x[2], x[3], x[4])) for k in (0, 1))
    found = compare.best_assignment([[over.get((a, b), 0) for b in right] for a in left], max(len(ref), len(pred)) * times <= compare.EXHAUSTIVE)
    hits = [(left[i], right[j]) for i, j in found]
    out = [("match", a[4], b[4], over[a, b]) for a, b in hits]
    out += [("missing", a[4], None, None) for a in ref for _ in range(times) if a[4] not in {x[4] for x, _ in hits}]
    return out + [("fp", None, b[4], None) for b in pred for _ in range(times) if b[4] not in {x[4] for _, x in hits}]


@pytest.mark.parametrize(("most", "held"), [(3, 1 << 21), (7, 5), (14, 40)])
def test_parts_of_many_parents(spark, monkeypatch, most, held):
    monkeypatch.setattr(compare, "HELD", held)
    r = random.Random(most)
    parents, ref, pred, want = [], [], [], []

    def side(up, tag):
        rows = []
        for k in range(r.randrange(most + 1)):
            start = r.randrange(1, 40 * most)
            rows.append((r.choice("cccd"), r.choice("+++-"), None if r.random() < 0.03 else start, start + r.choice([-2, 5, 20, 20, 60]), f"{tag}{up}.{r.randrange(max(k, 1)) if r.random() < 0.1 else k}", up))
        return rows + (rows[:1] if r.random() < 0.1 else [])

    for g in range(120):
        times = 2 if g % 40 == 0 else 1
        a, b = side(f"a{g}", "r"), side(f"b{g}", "p")
        parents += [("p", f"a{g}", f"b{g}")] * times
        ref, pred = ref + a, pred + [(*x, "p") for x in b]
        want += [(f"a{g}", f"b{g}", *x) for x in alone(a, b, times)]
    # lines that share an id but not their span are matched each for itself; below no parent or one without a match nothing is told
    ref, pred = [*ref, ("c", "+", 1, 50, "lost", None), ("c", "+", 1, 50, "else", "z")], [*pred, ("c", "+", 1, 50, "lost", None, "p")]
    out = compare.match_parts("cds", spark.createDataFrame(parents, "prediction string, ref_parent string, pred_parent string"), spark.createDataFrame(ref, LINE), spark.createDataFrame(pred, LINE + ", prediction string"))
    assert out._jdf.queryExecution().toString().split("== Physical Plan ==")[1].count("MapInArrow") == 1  # before, each reader of the matches made them again
    got = [(x.ref_parent, x.pred_parent, x.classification, x.ref_id, x.pred_id, x.overlap_bp) for x in out.collect()]
    key = lambda x: tuple("" if v is None else str(v) for v in x)
    assert sorted(got, key=key) == sorted(want, key=key) and len({x[2] for x in got}) == 3


def test_introns_between_stored_lines(spark):
    """As hierarchy.introns() makes them of the lines themselves; a name may be missing, a parent without lines has none."""
    from genespark.operators.hierarchy import introns

    rows = [("c", "+", 50, 60, "x", "a"), ("c", "+", 10, 20, "y", "a"), ("c", "+", 15, 30, None, "a"), ("c", "-", None, 3, "w", "b"), ("c", "-", 90, 99, "v", "b"), ("c", "+", 1, 2, "u", "d")]
    ref = spark.createDataFrame(rows, LINE)
    parents = spark.createDataFrame([("p", k, k) for k in "abde"], "prediction string, ref_parent string, pred_parent string")
    below = compare._gaps(compare._below(parents, ref, ref.withColumn("prediction", F.lit("p"))))
    want = sorted(tuple(v) for v in introns(ref).select("id", "chrom", "strand", "start", "end").na.fill(0).collect())
    for prefix in ("", "p_"):
        lists = below.select(F.explode(F.arrays_zip(*(F.col(prefix + c).alias(c) for c in compare.LINE))).alias("x")).select("x.*")
        assert sorted(tuple(v) for v in lists.na.fill(0).collect()) == want
