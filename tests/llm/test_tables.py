"""Mixing, line dedup, decontamination, language, toxicity and top-k against plain versions on small tables."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from genespark.llm import decontam, langid, linededup, mixing, topk, toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars long, n_words long, size long, target string"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, None, s, None, None, 3, "x") for i, t, s in rows], DOCS)


# mixing


def test_spread():
    assert mixing.spread([10, 10, 10], [3, 1, 2], 45, 2) == [20.0, pytest.approx(25 / 3), pytest.approx(50 / 3)]
    assert mixing.spread([0, 5], [3, 1], 7.5, 2) == [0.0, 7.5]
    assert mixing.spread([], [], 0, 2) == []


def brute_flow(patterns, quotas, repeats):
    """Least cost of a greatest flow, by trying all splits."""
    best = None
    sizes = [(m, z * repeats) for m, z in patterns]

    def walk(k, left, used):
        nonlocal best
        if k == len(sizes):
            total = sum(used)
            cost = sum(sum(max(0, min(z, u - e * z)) * e for e in range(repeats)) for (_, z), u in zip(patterns, used, strict=True))
            if best is None or (-total, cost) < best:
                best = (-total, cost)
            return
        members, cap = sizes[k]

        def split(i, left, spent):
            if i == len(members):
                walk(k + 1, left, [*used, spent])
                return
            for x in range(min(cap - spent, left[members[i]]) + 1):
                nxt = list(left)
                nxt[members[i]] -= x
                split(i + 1, nxt, spent + x)

        split(0, left, 0)

    walk(0, list(quotas), [])
    return best


def test_min_cost_flow():
    r = random.Random(2)
    for _ in range(30):
        n = r.randint(1, 3)
        patterns = [(sorted(r.sample(range(n), r.randint(1, n))), r.randint(0, 3)) for _ in range(r.randint(1, 3))]
        quotas = [r.randint(0, 5) for _ in range(n)]
        flow = mixing.route(patterns, quotas, 2)
        used = [sum(f) for f in flow]
        cost = sum(max(0, u - z) for (_, z), u in zip(patterns, used, strict=True))
        assert (-sum(used), cost) == brute_flow(patterns, quotas, 2)
        for s, q in enumerate(quotas):
            assert sum(x for (m, _), f in zip(patterns, flow, strict=True) for k, x in zip(m, f, strict=True) if k == s) <= q


def test_mix(spark):
    from pyspark.sql import functions as F

    r = random.Random(1)
    rows = [(i, " ".join("w" for _ in range(r.randint(0, 30))), r.choice(["b", "a", "é", None])) for i in range(800)] + [(3, "x y", "a"), (None, None, "a"), (None, "p q r", None)]
    run = lambda: mixing.mix(docs_of(spark, rows), F.array("source"), mixing.word_count("text"), weights=(3, 1, 2), share=1.5, buckets=16).collect()
    out = run()
    assert sorted(map(str, out)) == sorted(map(str, run()))
    assert len(out) == len(rows)
    size = Counter()
    for _, t, s in rows:
        size[s] += len((t or "").split())
    order = ["a", "b", "é", None]
    want = dict(zip(order, mixing.spread([size[s] for s in order], [3, 1, 2, 3], 1.5 * sum(size.values()), 2), strict=True))
    for s in order:
        own = [x for x in out if x.sources == ('["%s"]' % s if s else "[null]")]
        assert {x.source_size for x in own} == {size[s]} and {x.target for x in own} == {want[s]}
        assert abs(sum(x.taken for x in own) - want[s]) <= 16
    assert all(0 <= x.taken <= 2 * x.size for x in out)
    assert mixing.mix(docs_of(spark, []), F.array("source"), mixing.word_count("text")).collect() == []


def test_overlapping_sources(spark):
    rows = [(i, ["a"], 10) for i in range(10)] + [(100 + i, ["a", "b"], 10) for i in range(10)]
    df = spark.createDataFrame(rows, "doc_id long, m array<string>, z long")
    out = mixing.mix(df, df.m, df.z, quotas={"a": 100, "b": 100}).collect()
    assert all(r.copies == 1 for r in out)  # no repetition while unused tokens reach the quota


# line dedup


def test_cuckoo_filter():
    keys = np.random.default_rng(1).integers(-(2**63), 2**63 - 1, 50_000)
    f = linededup.CuckooFilter.build(keys)
    assert f.contains(keys).all()
    other = np.random.default_rng(2).integers(-(2**63), 2**63 - 1, 50_000)
    assert f.contains(other).mean() < 0.002
    g = linededup.CuckooFilter.load(f.dump())
    g.delete(keys[:25_000])
    assert g.contains(keys[25_000:]).all() and g.contains(keys[:25_000]).mean() < 0.002


def line_corpus():
    r = random.Random(3)
    common = ["The very same license line that is found in many documents %d" % k for k in range(4)] + ["é" * 40, "é" * 39, "short", ""]
    rows = []
    for i in range(40):
        lines = [r.choice(common) if r.random() < 0.5 else f"own line {i} {r.random()} and something to make it long enough" for _ in range(r.randint(1, 9))]
        lines = [(" \t" + x.upper() + "\r" if r.random() < 0.2 else x) for x in lines]
        rows.append((i, "\n".join(lines), "s"))
    return rows + [(50, None, "s"), (51, "", "s"), (52, "\n", "s"), (7, rows[7][1], "s"), (None, common[0], "s"), (None, common[0], "t")]


def plain_lines(rows, least=5):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate(low)
    held = {}
    for i, t, _ in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 40:
                held.setdefault(key(line), set()).add(i)
    hot = {k: max((x for x in v if x is not None), default=None) for k, v in held.items() if len(v) >= least}
    out = []
    for i, t, _ in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if key(x) not in hot or hot[key(x)] == i]
        out.append((str(i), len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out)


def test_line_dedup(spark):
    rows = line_corpus()
    docs = docs_of(spark, rows)
    out = linededup.dedup_lines(docs, linededup.build(docs), out_text="text").collect()
    assert sorted((str(r.doc_id), r.n_lines, r.n_dropped, r.text) for r in out) == plain_lines(rows)
    assert linededup.dedup_lines(docs_of(spark, []), linededup.build(docs_of(spark, []))).collect() == []


def test_line_index_is_reversible(spark):
    rows = line_corpus()
    later, gone = rows[20:], [r for r in rows if r[0] is not None and r[0] % 3 == 0]
    left = [r for r in rows if r not in gone]
    index = linededup.LineIndex.empty(linededup.postings(docs_of(spark, rows[:20])), 4).insert(linededup.postings(docs_of(spark, rows[:20])))
    index = index.insert(linededup.postings(docs_of(spark, later))).insert(linededup.postings(docs_of(spark, rows[:5])))
    index = index.delete(spark.createDataFrame(sorted({(r[0],) for r in gone}), "i long"))
    fresh = linededup.build(docs_of(spark, left), batches=1)
    facts = lambda x: sorted((r.k1, r.k2, r.n, r.last) for r in x.refs.collect())
    assert facts(index) == facts(fresh)
    keys = np.array([r.k1 for r in fresh.refs.collect()])
    held = {r.shard: linededup.CuckooFilter.load(r.cells) for r in index.filters.collect()}
    assert all(held[k % 4].contains(np.array([k]))[0] for k in keys.tolist())


def test_insertion_goes_into_the_filters(spark, monkeypatch):
    """A small batch changes the stored filters; only one that overflows is made anew; both hold all keys afterwards."""
    r = random.Random(5)
    rows = lambda a, b: linededup.postings(docs_of(spark, [(i, f"line {i} {r.random()} that is long enough to count as a key", "s") for i in range(a, b)]))
    made = []
    real = linededup.LineIndex._filters
    monkeypatch.setattr(linededup.LineIndex, "_filters", lambda self, refs: made.append(1) or real(self, refs))
    first = rows(0, 60)
    index = linededup.LineIndex.empty(first, 2).insert(first)
    index = index.insert(rows(60, 64))
    assert not made and index.filters.count() == 2
    index = index.insert(rows(64, 400))
    assert made
    keys = [x.k1 for x in index.refs.collect()]
    held = {x.shard: linededup.CuckooFilter.load(x.cells) for x in index.filters.collect()}
    assert len(keys) == 400 and all(held[k % 2].contains(np.array([k]))[0] for k in keys)


def test_shards_grow_with_the_index(spark):
    """Shards double before a batch that would overfill them; filters follow, and results equal a build from scratch."""
    rows = line_corpus()
    first, later = rows[:10], rows[10:]
    index = linededup.LineIndex.empty(linededup.postings(docs_of(spark, first)), 1, keys_a_shard=8).insert(linededup.postings(docs_of(spark, first)))
    before = index.shards
    index = index.insert(linededup.postings(docs_of(spark, later)))
    assert index.shards > before > 1 and index.refs.count() <= index.shards * 8
    held = {r.shard: linededup.CuckooFilter.load(r.cells) for r in index.filters.collect()}
    assert all(r.shard == r.k1 % index.shards and held[r.shard].contains(np.array([r.k1]))[0] for r in index.refs.collect())
    out = linededup.dedup_lines(docs_of(spark, rows), index).collect()
    assert sorted((str(r.doc_id), r.n_lines, r.n_dropped, r.text) for r in out) == plain_lines(rows)


def test_hot_lines_in_both_ways_of_the_join(spark, monkeypatch):
    """Lines that are broadcast, shuffled, or some of each lose the same copies; deletion too."""
    rows = line_corpus()
    docs = docs_of(spark, rows)
    index = linededup.build(docs)
    real = linededup.join_hot
    for most in (1, 30, 10**9):
        monkeypatch.setattr(linededup, "join_hot", lambda *a, most=most: real(*a, most=most))
        out = linededup.dedup_lines(docs, index).collect()
        assert sorted((str(r.doc_id), r.n_lines, r.n_dropped, r.text) for r in out) == plain_lines(rows)
        left = [r for r in rows if r[0] is None or r[0] % 2]
        rest = index.delete(spark.createDataFrame(sorted({(r[0],) for r in rows if r not in left}), "i long"))
        out = linededup.dedup_lines(docs_of(spark, left), rest).collect()
        assert sorted((str(r.doc_id), r.n_lines, r.n_dropped, r.text) for r in out) == plain_lines(left)


# decontamination


def plain_hits(docs, items, window=13):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = lambda t: word.findall((t or "").translate(low))
    windows = {}
    for i, t in items:
        w = words(t)
        for k in range(max(1, len(w) - window + 1) if w else 0):
            windows.setdefault(tuple(w[k : k + window]), set()).add(i)
    out = []
    for i, t, _ in docs:
        w, hit, found = words(t), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if (own := windows.get(tuple(w[k : k + n]))) is not None:
                    hit |= set(range(k, k + n))
                    found |= {str(x) for x in own if x is not None}
        out.append((str(i), len(w), len(hit), ",".join(sorted(found))))
    return sorted(out)


@pytest.mark.parametrize("most_bytes", [64 << 20, 200])
def test_decontamination(spark, most_bytes):
    r = random.Random(9)
    vocabulary = ["a", "be", "the", "Éa", "x1", "longer", "word", "of"]
    prose = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    items = [(k, prose(r.randint(10, 30))) for k in range(12)] + [(20, "tiny"), (21, "two words!"), (22, ""), (23, None), (None, prose(15)), (3, prose(14)), (24, "a-b_c"), (25, "of")]
    rows = [(i, prose(r.randint(0, 80)), "s") for i in range(60)]
    rows += [(100 + k, f"{prose(5)} {(t or '').upper()}, {prose(40)};{t}", "s") for k, (_, t) in enumerate(items)] + [(200, None, "s"), (201, " .,", "s"), (1, "tiny-tiny", "s"), (5, rows[5][1], "s")]
    out = decontam.find_contamination(docs_of(spark, rows), spark.createDataFrame(items, "item_id long, text string"), most_bytes=most_bytes).collect()
    assert sorted((str(x.doc_id), x.n_words, x.n_hit, ",".join(x["items"])) for x in out) == plain_hits(rows, items)
    assert all(sum(b - a for a, b in zip(x.hit_from, x.hit_to, strict=True)) == x.n_hit for x in out)
    assert decontam.find_contamination(docs_of(spark, rows[:3]), spark.createDataFrame([], "item_id long, text string")).where("n_hit > 0").count() == 0


# language


def test_language(spark):
    r = random.Random(4)
    parts = {"aa": ["the", "ing", "wh", "th", "on"], "bb": ["eux", "oi", "que", "ré", "ai"], "cc": ["sch", "ung", "keit", "der", "zu"]}
    prose = lambda k, n: " ".join("".join(r.choice(parts[k]) for _ in range(r.randint(1, 3))) for _ in range(n))
    rows = [(i, prose(k := r.choice("abc") * 2, r.randint(5, 80)), k if i % 4 else None) for i in range(300)]
    mixed = [(1000, prose("aa", 60) + " " + prose("bb", 40), None), (1001, None, None), (1002, "123 !?", None), (1003, "", None), (1004, "字", None)]
    df = spark.createDataFrame(rows + mixed, "doc_id long, text string, lang string")
    out = {x.doc_id: x for x in langid.identify(df, langid.train(df)).collect()}
    truth = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    again = {x.doc_id: x for x in langid.identify(truth, langid.train(truth.where("lang is not null"))).collect()}
    right = sum(again[i].lang_pred == next(k for k in parts if any(t.split()[0].startswith(p) for p in parts[k])) for i, t, _ in rows)
    assert right >= 0.97 * len(rows)
    assert set(out[1000].langs) == {"aa", "bb"} and abs(out[1000].score - 0.6) < 0.1
    assert [(out[i].lang_pred, out[i].score) for i in (1001, 1002, 1003)] == [("und", 0.0)] * 3
    assert out[1004].lang_pred in parts and 0 <= out[1004].score <= 1
    none = langid.train(df.where("false"))
    assert {x.lang_pred for x in langid.identify(df, none).collect()} == {"und"}


# toxicity


def test_isotonic():
    x, y = toxicity.isotonic(np.array([3.0, 1, 2, 4]), np.array([1.0, 0, 1, 0]))
    assert list(y) == sorted(y) and y[0] == 0 and abs(y[-1] - 2 / 3) < 1e-9


def test_toxicity(spark):
    r = random.Random(8)
    prose = lambda n: [r.choice(["the", "of", "tion", "whe", "reou", "and", "you", "ent"]) for _ in range(n)]
    rows, labels = [], []
    for i in range(900):
        w, toxic = prose(r.randint(20, 60)), i % 4 == 0
        if toxic:
            for bad in r.sample(["idiot", "zorgle", "blarg", "scum"], 3):
                w.insert(r.randrange(len(w)), bad)
        rows.append((i, " ".join(w)))
        labels.append((i, int(toxic)))
    df, lab = spark.createDataFrame([*rows, (5000, None), (5001, "")], "doc_id long, text string"), spark.createDataFrame([*labels, (None, 1), (3, None), (4, 1)], "doc_id long, toxic int")
    model = toxicity.train(df.where("doc_id % 3 <> 1"), lab.where("doc_id % 3 <> 1"))
    out = {x.doc_id: x for x in toxicity.score(df, model).collect()}
    held = [i for i in range(900) if i % 3 == 1]
    assert sum(out[i].predicted == (i % 4 == 0) for i in held) >= 0.97 * len(held)
    assert all(0 <= x.score <= 1 for x in out.values()) and out[5000].score == out[5001].score and out[5000].predicted == 0
    nothing = toxicity.train(df, lab.where("toxic = 0"))
    assert {x.score for x in toxicity.score(df, nothing).collect()} == {0.0}


# top-k


@pytest.mark.parametrize(("scale", "query_bytes", "block"), [(1.0, 1 << 20, 8192), (1.0, 200, 7), (3e8, 1 << 20, 50)])
def test_top_k(spark, scale, query_bytes, block):
    r = np.random.default_rng(6)
    rows = [(i, [float(np.float32(x)) for x in r.normal(size=6) * scale]) for i in range(120)]
    rows += [(200 + i, rows[3][1]) for i in range(9)] + [(300, None), (301, [1.0, None]), (302, [float("nan")] * 6), (303, [float("inf")] * 6), (304, []), (305, [0.5]), (None, [1.0] * 6), (7, rows[9][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    ask = df.where("vec_id % 10 = 0 or vec_id in (300, 304, 305)")
    out = topk.top_k(df, ask, 5, query_bytes=query_bytes, block_rows=block).collect()
    ints = [(i, [int(np.floor(x * 256)) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    want = []
    for q, v in ints:
        if q % 10 == 0 or q in (300, 304, 305):
            got = sorted((-min(max(sum(a * b for a, b in zip(v, w, strict=False)), -(2**63)), 2**63 - 1), i) for i, w in ints if i != q)[:5]
            want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(got)]
    assert sorted((x.query_id, x["rank"], x.vec_id, x.score) for x in out) == sorted(want)
    assert topk.top_k(df.where("false"), df.where("false")).collect() == []


def test_digest_of_nothing():
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0c442")
