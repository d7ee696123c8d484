"""Substring dedup against a brute-force dictionary of all windows."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from genespark.llm import suffix


def plain(texts, span):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(b[i : i + span] for b in raw for i in range(len(b) - span + 1))
    out = []
    for b in raw:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - span + 1):
            if seen[b[i : i + span]] > 1:
                gone[i : i + span] = True
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((len(b), int(gone.sum()), runs, hashlib.sha256(bytes(np.frombuffer(b, np.uint8)[~gone])).hexdigest()))
    return out


def corpus(span):
    r = random.Random(11)
    word = lambda: r.choice(["the", "of", "é", "tion", "ab", "x", "quelle", "and"]) + r.choice(["a", "b", "ing", "er", "ß"])
    prose = lambda n: " ".join(word() for _ in range(n))
    passage, long = prose(60), prose(400)
    texts = [None, "", "short", "a" * 1000, "ab" * 700, "b" * (span - 1), "c" * span, "d" * span, "d" * span, "e" * (span + 1)]
    texts += [prose(r.randint(1, 300)) for _ in range(20)]
    texts += [prose(r.randint(0, 40)) + passage[r.randint(0, 30) : r.randint(230, 320)] + prose(r.randint(0, 40)) for _ in range(60)]
    for _ in range(25):
        words = long.split()
        for _ in range(r.randint(0, 12)):
            words[r.randrange(len(words))] = word()
        texts.append(" ".join(words))
    texts += [long, long, long * 2, passage * 3]
    return texts


@pytest.mark.parametrize(("span", "hot"), [(200, 4096), (200, 10), (96, 4)])
def test_against_brute_force(spark, span, hot):
    texts = corpus(span)
    rows = [(None if i in (5, 6) else i if i != 8 else 7, t, i) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_bytes long").withColumnRenamed("n_bytes", "row")
    out = suffix.dedup_substrings(docs.repartition(5), span=span, hot=hot, salts=4).collect()
    got = {r.row: (r.n_bytes, r.n_removed, len(r.run_from), hashlib.sha256(r.kept).hexdigest()) for r in out}
    want = plain(texts, span)
    assert len(out) == len(texts)
    assert [got[i] for i in range(len(texts))] == want
    assert all(sum(b - a for a, b in zip(r.run_from, r.run_to, strict=True)) == r.n_removed for r in out)


def test_hot_group_of_near_copies(spark):
    """One passage in all documents, edited at random places: its anchors are hot, and only some of its windows repeat."""
    r = random.Random(2)
    base = "".join(r.choice("abcdefgh ") for _ in range(900))
    texts = [base] * 3
    for k in range(60):
        cut = [*base]
        for _ in range(r.randint(1, 4)):
            cut[r.randrange(len(cut))] = r.choice("XYZ")
        texts.append("".join(cut)[r.randint(0, 300) : r.randint(500, 900)] + f" end {k}")
    texts += ["ab" * 400 + base[:300], "z" * 700, "z" * 700 + base[400:]]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = plain(texts, 200)
    for hot, salts in ((4, 2), (8, 64), (4096, 4)):
        got = {x.doc_id: (x.n_bytes, x.n_removed, len(x.run_from), hashlib.sha256(x.kept).hexdigest()) for x in suffix.dedup_substrings(rows.repartition(3), hot=hot, salts=salts).collect()}
        assert [got[i] for i in range(len(texts))] == want


def test_very_long_text(spark):
    """A text of a million bytes, twice, and a stretch of it elsewhere."""
    r = random.Random(8)
    long = "".join(r.choice("abcdefghijklmnop ") for _ in range(1_000_000))
    rows = [(1, long), (2, long), (3, long[500_000:501_000] + "Q" * 150), (4, long[:150])]
    got = {x.doc_id: (x.n_bytes, x.n_removed) for x in suffix.dedup_substrings(spark.createDataFrame(rows, "doc_id long, text string"), keep=["doc_id"]).collect()}
    assert got == {1: (1_000_000, 1_000_000), 2: (1_000_000, 1_000_000), 3: (1150, 1000), 4: (150, 0)}


def test_empty_and_columns(spark):
    none = spark.createDataFrame([], "doc_id long, text string, kept string, row long, a long")
    assert suffix.dedup_substrings(none).collect() == []
    one = spark.createDataFrame([(1, "x" * 300, "y", 5, 6)], "doc_id long, text string, kept string, row long, a long")
    (r,) = suffix.dedup_substrings(one).collect()
    assert (r.row, r.a, r.n_removed, r.kept) == (5, 6, 300, b"")
