"""Plain EM and plain tree growth against the vectorised ones; clashing columns, repeats, ties, empty tables, very long texts."""

import math
import random

import numpy as np
import pytest

from genespark.llm import decontam, jaccard, langid, linededup, mixing, pii, secrets, suffix, topk, toxicity


def plain_em(model, text, penalty=2.0):
    """Shares of one text, word by word and language by language."""
    grams, first, _ = langid.trigrams([text], model.bits)
    k = len(model.langs)
    edges = [*first.tolist(), len(grams)]
    words = []
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        logs = [sum(float(model.logp[g, j]) for g in grams[a:b]) for j in range(k)]
        words.append([math.exp(x - max(logs)) for x in logs])

    def em(pi, times):
        for _ in range(times):
            total = [0.0] * k
            for w in words:
                part = [x * y for x, y in zip(w, pi, strict=True)]
                s = max(sum(part), 1e-30)
                total = [t + x / s for t, x in zip(total, part, strict=True)]
            pi = [t / len(words) for t in total]
        return pi, sum(math.log(max(sum(x * y for x, y in zip(w, pi, strict=True)), 1e-30)) for w in words)

    pi, fit = em([1 / k] * k, 12)
    while sum(x > 0 for x in pi) > 1:
        out = -min((x, -j) for j, x in enumerate(pi) if x > 0)[1]
        trial = [0.0 if j == out else x for j, x in enumerate(pi)]
        trial, got = em([x / sum(trial) for x in trial], 4)
        if got < fit - penalty * math.log1p(len(words)):
            break
        pi, fit = trial, got
    return pi


def test_mixture_against_plain_em(spark):
    r = random.Random(4)
    parts = {"aa": ["the", "ing", "wh", "th", "on"], "bb": ["eux", "oi", "que", "ré", "ai"], "cc": ["sch", "ung", "keit", "der", "zu"]}
    prose = lambda k, n: " ".join("".join(r.choice(parts[k]) for _ in range(r.randint(1, 3))) for _ in range(n))
    docs = [(i, prose(k, 60), k) for i in range(60) for k in ("aa bb cc".split()[i % 3],)]
    model = langid.train(spark.createDataFrame(docs, "doc_id long, text string, lang string"))
    texts = [prose("aa", 30), prose("bb", 3), prose("aa", 20) + " " + prose("cc", 25), " ".join(prose(k, 9) for k in parts), "wh", "xyz 12 é"]
    raw = [t.encode() for t in texts]
    shares, _ = langid.infer(model, raw)
    for t, got in zip(raw, shares, strict=True):
        assert np.allclose(got, plain_em(model, t), atol=2e-3), t
    with pytest.raises(ValueError):
        langid.train(spark.createDataFrame(docs, "doc_id long, text string, lang string"), most_bytes=1000)


def plain_trees(x, y, rounds, depth, rate, ridge, edges):
    """The margin of each row, by trying every split of every node."""
    code = [[int(np.searchsorted(edges[f], v, "left")) for f, v in enumerate(row)] for row in x]
    p0 = min(max(sum(y) / len(y), 1e-4), 1 - 1e-4)
    margin = [math.log(p0 / (1 - p0))] * len(y)
    for _ in range(rounds):
        p = [1 / (1 + math.exp(-m)) for m in margin]
        nodes = {0: list(range(len(y)))}
        for _ in range(depth):
            split = {}
            for node, rows in nodes.items():
                sums = lambda own: (sum(y[i] - p[i] for i in own), sum(p[i] * (1 - p[i]) for i in own))
                best = None
                gt, ht = sums(rows)
                for f in range(len(edges)):
                    for b in range(len(edges[f]) + 1):
                        gl, hl = sums([i for i in rows if code[i][f] <= b])
                        gain = gl**2 / (hl + ridge) + (gt - gl) ** 2 / (ht - hl + ridge)
                        if best is None or gain > best[0] + 1e-9:
                            best = (gain, f, b)
                _, f, b = best
                split[2 * node] = [i for i in rows if code[i][f] <= b]
                split[2 * node + 1] = [i for i in rows if code[i][f] > b]
            nodes = split
        for rows in nodes.values():
            g, h = sum(y[i] - p[i] for i in rows), sum(p[i] * (1 - p[i]) for i in rows)
            for i in rows:
                margin[i] += rate * g / (h + ridge)
    return margin


def test_trees_against_plain_growth():
    r = np.random.default_rng(3)
    x = r.normal(size=(80, 3))
    y = ((x[:, 0] > 0.3) ^ (x[:, 2] > 0.1) | (r.random(80) < 0.1)).astype(float)
    trees = toxicity.Trees.fit(x, y, rounds=3, depth=2, rate=0.3, bins=8, ridge=1.0)
    assert np.allclose(trees.margin(x), plain_trees(x.tolist(), y.tolist(), 3, 2, 0.3, 1.0, trees.edges), atol=1e-9)


SHOUT = "IDIOT MORON SCUM"


@pytest.fixture(scope="module")
def toxic(spark):
    r = random.Random(8)
    rows = [(i, " ".join([r.choice(["the", "of", "and", "you", "ent"]) for _ in range(40)] + (["idiot", "scum", "moron"] if i % 4 == 0 else []))) for i in range(400)]
    return toxicity.train(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)], "doc_id long, toxic int"))


def test_clashing_columns_repeats_and_empty_tables(spark, toxic):
    same = "the word of you and ent " * 5
    rows = [(1, same, "s", "p", ["x"], [2.0], 7), (1, same, "s", "p", ["x"], [2.0], 7), (None, same + "idiot scum", "s", "p", None, None, 8), (2, None, None, None, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, score string, predicted string, langs array<string>, shares array<double>, rank long").withColumnRenamed("predicted", "lang_pred")
    out = toxicity.score(df.withColumnRenamed("lang_pred", "predicted"), toxic).collect()
    assert len(out) == 4 and len({x.score for x in out if x.doc_id == 1}) == 1 and all(isinstance(x.score, float) and x.predicted in (0, 1) and x["rank"] in (7, 8, None) for x in out)
    model = langid.train(spark.createDataFrame([(same, "aa"), ("eux oi que", "bb")], "text string, lang string"))
    out = langid.identify(df, model).collect()
    assert [x.lang_pred for x in sorted(out, key=lambda x: str(x.doc_id))] == ["aa", "aa", "und", "aa"] and all(x["rank"] in (7, 8, None) for x in out)
    tie = langid.train(spark.createDataFrame([("abc", "bb"), ("abc", "aa")], "text string, lang string"))
    assert langid.identify(spark.createDataFrame([("abc",)], "text string"), tie).first().lang_pred == "aa"
    for none in (toxicity.score(df.where("false").drop("score"), toxic), langid.identify(df.where("false"), model)):
        assert none.collect() == []
    vectors = spark.createDataFrame([(i, [1.0, 2.0], 5, "q", "s") for i in (1, 2, 2, 3)], "vec_id long, embedding array<double>, rank long, query_id string, score string")
    got = [(x.query_id, x["rank"], x.vec_id) for x in topk.top_k(vectors, vectors.where("vec_id = 1"), 5).collect()]
    assert sorted(got) == [(1, 1, 2), (1, 2, 2), (1, 3, 3)]


def test_components_beyond_a_long(spark):
    """Scores of opposite signs cancel before they are held at the ends of a long."""
    big = 2.0**60
    rows = [(50, [big, big, 1.0]), (1, [big, -big, 3.0]), (2, [big, big, 0.0]), (3, [-big, -big, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert [(x.vec_id, x.score) for x in topk.top_k(df, df.where("vec_id = 50"), 5).orderBy("rank").collect()] == [(2, 2**63 - 1), (1, 3 * 65536), (3, -(2**63))]


def test_very_long_texts(spark, toxic):
    """A text of two million characters through every operator on texts."""
    from pyspark.sql import functions as F

    r = random.Random(1)
    line = lambda: " ".join("".join(r.choice("abcdefghij") for _ in range(r.randint(2, 7))) for _ in range(12))
    lines = [line() for _ in range(28_000)]
    long = "\n".join(lines)
    shout = long + " you " + SHOUT
    rows = [(1, long), (2, long + " mail me@example.org token=abcdefgh1"), (3, shout), (4, "short")] + [(10 + k, lines[5] + f"\nown {k}") for k in range(5)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).cache()
    by = lambda out: {x.doc_id: x for x in out.collect()}
    out = by(jaccard.join_similar(df))
    assert out[1].component_id == out[2].component_id == out[3].component_id == 1 and out[4].component_id == 4
    out = by(suffix.dedup_substrings(df, keep=["doc_id"]))
    assert out[1].n_removed == len(long) and out[4].n_removed == 0
    out = by(linededup.dedup_lines(df, linededup.build(df), keep=["doc_id"], out_text="kept"))
    assert out[14].n_dropped == 0 and out[10].n_dropped == 1 and out[1].n_lines == 28_000 and out[1].n_dropped >= 1
    bench = spark.createDataFrame([("i", " ".join(lines[100:102]))], "item_id string, text string")
    out = by(decontam.find_contamination(df, bench, keep=["doc_id"]))
    assert out[1].n_hit == 24 and out[1].n_words == 28_000 * 12 and out[4].n_hit == 0
    assert by(pii.find_pii(df, keep=["doc_id"]))[2].n_email == 1
    assert len(by(secrets.scan(df, keep=["doc_id"]))[2]["assign"]) == 1
    assert all(0 <= x.score <= 1 for x in toxicity.score(df, toxic, keep=["doc_id"]).collect())
    model = langid.train(df.withColumn("lang", F.lit("aa")))
    assert by(langid.identify(df, model, keep=["doc_id"]))[3].lang_pred == "aa"
    assert by(mixing.mix(df, F.array(F.lit("s")), mixing.word_count("text")))[1]["size"] == 28_000 * 12


def test_line_dedup_with_clashing_names_and_long_texts(spark):
    """Kept columns called n_lines, n_dropped and kept are replaced; a long line and a long text are read whole."""
    line = "a line that five documents hold, with more than forty signs"
    long = "x" * 3_000_000
    rows = [(i, f"own {i}\n{line}\n" + (long if i < 6 else ""), "a", "b", "c") for i in range(7)] + [(7, None, "a", "b", "c"), (8, "\n".join(["short"] * 200_000), "a", "b", "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_lines string, n_dropped string, kept string")
    out = {x.doc_id: x for x in linededup.dedup_lines(docs, linededup.build(docs), out_text="kept").collect()}
    assert {i: (x.n_lines, x.n_dropped) for i, x in out.items()} == {**{i: (3, 2) for i in range(5)}, 5: (3, 1), 6: (3, 0), 7: (1, 0), 8: (200_000, 0)}
    assert out[0].kept == "own 0" and out[5].kept == f"own 5\n{long}" and out[6].kept == rows[6][1] and out[7].kept == "" and out[8].kept == rows[8][1]
