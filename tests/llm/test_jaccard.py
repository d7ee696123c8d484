"""Jaccard join against all pairs, with hot groups of near copies and shared passages."""

import random

import pytest

from genespark.llm import jaccard


def plain(rows, n=4, t=85):
    sets = []
    for i, text in rows:
        w = (text or "").encode().lower().split()
        sets.append((i, frozenset(tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))) if w else frozenset()))
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= t * len(x | y):
                root[find(a)] = find(b)
    least = {}
    for k, (i, s) in enumerate(sets):
        r = find(k)
        if i is not None:
            least[r] = min(least.get(r, i), i)
    return sorted(((i, len(s), i if not s else least.get(find(k))) for k, (i, s) in enumerate(sets)), key=str)


def corpus(seed):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdeé") for _ in range(r.randint(1, 9)))
    words = [word() for _ in range(3000)]
    prose = lambda n: [r.choice(words) for _ in range(n)]
    texts = [None, "", " \n\t", "One", "one", "a b c", "A  b\tc", "a b c d", "a b c d e", "x y " * 30, "x y " * 31]
    passage, base, short, long = prose(60), prose(150), prose(24), prose(1500)
    for source, copies, edits in ((base, 120, 6), (short, 40, 1), (long, 12, 40)):
        for _ in range(copies):
            w = list(source)
            for _ in range(r.randint(0, edits)):
                w[r.randrange(len(w))] = word()
            texts.append(" ".join(w))
    texts += [" ".join(prose(r.randint(0, 60)) + passage + prose(r.randint(0, 12))) for _ in range(80)]
    texts += [" ".join(prose(r.randint(1, 200))) for _ in range(40)] + [" ".join(base), " ".join(base).upper()]
    r.shuffle(texts)
    return [(i, x) for i, x in enumerate(texts)]


@pytest.mark.parametrize(("seed", "local", "block"), [(1, 8, 2000), (2, 2, 10)])
def test_against_all_pairs(spark, monkeypatch, seed, local, block):
    """A low bound for the frequent class sends copies and passages through token combinations, small blocks split their lists."""
    real = jaccard.frequent_cells
    monkeypatch.setattr(jaccard, "frequent_cells", lambda docs, **o: real(docs, **(o | {"local": local, "least": local + 1})))
    rows = corpus(seed)
    docs = spark.createDataFrame([(i, x, 1) for i, x in rows], "doc_id long, text string, node int").repartition(3)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.join_similar(docs, block=block).collect()), key=str)
    assert got == plain(rows)


def test_null_and_repeated_ids(spark):
    rows = [(None, "a b c d e f"), (None, "a b c d e f"), (5, "a b c d e f"), (5, "q r s t u"), (5, "q r s t u"), (None, "only null here now"), (7, None), (7, "")]
    out = jaccard.join_similar(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in out), key=str) == plain(rows)
    assert jaccard.join_similar(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_frequent_cells_reach_the_driver_packed(spark, monkeypatch):
    """Most of the 2^22 cells are frequent in some GB of text: as rows of their own they would fill the driver."""
    import numpy as np
    from pyspark.sql.classic.dataframe import DataFrame

    sent, plain_arrow = [], DataFrame.toArrow
    monkeypatch.setattr(DataFrame, "toPandas", lambda self: pytest.fail("cells as single rows"))
    monkeypatch.setattr(DataFrame, "toArrow", lambda self: sent.append(plain_arrow(self)) or sent[-1])
    docs = spark.createDataFrame([(f"{a} {b} {c} D", ) for a in "pqrst" for b in "uvwxyz" for c in "abc"], "text string")
    got = np.unpackbits(jaccard.frequent_cells(docs.unionByName(docs), text="text", n=4, local=1, least=1))
    tokens = np.concatenate(list(jaccard.token_lists([r.text.lower().encode() for r in docs.collect()], 4)))
    assert got[(tokens >> np.uint64(42)).astype(int)].all()
    every = jaccard.collect_cells(spark.range(1 << 22).selectExpr("cast(id as int) cell").where("cell % 3 = 0 or cell >= 4194240"))
    want = np.arange(1 << 22)
    assert (np.unpackbits(every).astype(bool) == ((want % 3 == 0) | (want >= 4194240))).all()
    assert max(t.num_rows for t in sent) <= 1 << 16
